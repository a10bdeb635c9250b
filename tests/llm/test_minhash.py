import collections
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from daybook.llm import minhash, shingles
from tests.llm.conftest import ODD_TEXTS
from tests.llm.test_linking import closure


def brute_set(text, n):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return set()
    return {tuple(words[i:i + n]) for i in range(len(words) - n + 1)} if len(words) >= n else {tuple(words)}


def brute(texts, n, percent=80):
    sets = {i: brute_set(t, n) for i, t in texts.items()}
    df = collections.Counter(x for s in sets.values() for x in s)
    shared = collections.defaultdict(list)
    edges = []
    for i in sorted(sets):
        s = sorted(sets[i], key=lambda x: (df[x], x))
        # A partner at 0.8 shares one of the rarest fifth of the shingles.
        near = {j for x in s[: len(s) - (percent * len(s) + 99) // 100 + 1] for j in shared[x]}
        for j in near:
            common = len(sets[i] & sets[j])
            if 100 * common >= percent * (len(sets[i]) + len(sets[j]) - common):
                edges.append((i, j))
        for x in s:
            shared[x].append(i)
    return sets, closure(sets, edges)


def check(rows, texts, n):
    sets, label = brute(texts, n)
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in rows}
    assert got == {i: (len(sets[i]), label[i], label[i] == i) for i in texts}


def near_copies(seed=1, groups=12):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(5000)]
    texts, i = {}, 0
    for g in range(groups):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([12, 60, 300]))]
        for _ in range(rng.choice([1, 3, 30])):
            words = base[:]
            for _ in range(rng.randint(0, max(1, len(base) // 25))):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
            texts[i := i + rng.randint(1, 9)] = " ".join(words)
    return texts


@pytest.mark.parametrize("n", [2, 5])
def test_against_brute_force(make_docs, n):
    texts = near_copies()
    check(minhash.classify(make_docs(list(texts.items())), n, 80).collect(), texts, n)


def test_odd_texts_copies_and_empty_table(make_docs):
    texts = {i: t for i, t in ODD_TEXTS if i is not None} | {20: "X\tY", 21: "x y", 22: "x  y\v", 23: "x y x y"}
    out = minhash.classify(make_docs([*texts.items(), (None, "x y")]), 2, 80).collect()
    check([r for r in out if r.doc_id is not None], texts, 2)
    lost = [r for r in out if r.doc_id is None]
    assert len(lost) == 1 and lost[0].component_id is None and lost[0].kept
    assert minhash.classify(make_docs([]), 2, 80).collect() == []
    assert len(minhash.classify(make_docs([(1, "a b"), (1, "a b")]), 2, 80).collect()) == 2


def test_drop_keeps_columns_and_one_of_each_group(make_docs):
    texts = near_copies(2, 6)
    docs = make_docs([*texts.items(), (None, "no id"), (10_000, None)])
    out = minhash.drop_near_duplicates(docs, 5, 80)
    assert out.columns == docs.columns
    _, label = brute(texts, 5)
    assert sorted(r.doc_id for r in out.collect() if r.doc_id is not None) == sorted({*label.values(), 10_000})
    assert minhash.drop_near_duplicates(make_docs([]), 5, 80).count() == 0


def test_registered_query(spark):
    from daybook.llm.registered import QUERIES
    sf = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    check(QUERIES["op3_minhash"](spark, sf).collect(), texts, 2)


def test_tensored_banding_misses_few():
    """Chance to meet in no table, at the similarity bound: measured on random sets."""
    rng = np.random.default_rng(5)
    missed, trials = 0, 4000
    for lo in range(0, trials, 500):
        sets = []
        for _ in range(500):
            common = rng.integers(0, 1 << 63, 160, dtype=np.uint64)
            sets += [np.append(common, rng.integers(0, 1 << 63, 20, dtype=np.uint64)) for _ in range(2)]
        hashes = shingles.mix(np.concatenate(sets))
        offsets = np.arange(0, len(hashes) + 1, 180)
        v = shingles.min_hashes(hashes, offsets, minhash.COLLECTIONS * minhash.ROWS, minhash.SEED)
        same = (v[0::2] == v[1::2]).reshape(500, minhash.COLLECTIONS, minhash.ROWS).all(axis=2).sum(axis=1)
        missed += int((same < 2).sum())
    assert missed <= 3


def test_word_hashes_ignore_layout():
    col = pa.array(["Ab  c\t", "", "ab c", "  ab\rc", "abc", "É ab"])
    raw, offsets = shingles.text_bytes(col)
    words, counts = shingles.word_hashes(raw, offsets)
    per = [tuple(words[a:b]) for a, b in zip(counts[:-1], counts[1:])]
    assert per[0] == per[2] == per[3] and per[1] == () and len(per[4]) == 1 and per[5][1] == per[0][0]
    sliced = shingles.text_bytes(col.slice(2, 2))
    assert [*shingles.word_hashes(*sliced)[0]] == [*per[2], *per[3]]


def test_drop_tells_rows_apart_by_place(make_docs):
    """Unlike texts under one id, and rows without id, are documents of their own."""
    words = [f"w{i}" for i in range(60)]
    a, b, c = " ".join(words), " ".join(reversed(words)), " ".join(f"x{w}" for w in words)
    rows = [(3, a), (9, a + " extra"), (9, b), (None, c), (None, c + " more"), (None, "alone without id"), (4, "same row"), (4, "same row")]
    left = collections.Counter(r.text for r in minhash.drop_near_duplicates(make_docs(rows), 5, 80).collect())
    assert left.pop(c, 0) + left.pop(c + " more", 0) == 1
    assert left == collections.Counter([a, b, "alone without id", "same row"])
