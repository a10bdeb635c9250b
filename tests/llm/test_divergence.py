import collections
import random
import re

import pytest

from daybook.llm import divergence
from tests.llm.conftest import DOCS, ODD_TEXTS


def brute(rows, least_docs, ranks):
    docs, count, groups = collections.Counter(), collections.Counter(), set()
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        words = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", low)
        docs.update((lang, w) for w in set(words))
        count.update((lang, source, w) for w in words)
    out = set()
    for lang in {g[0] for g in groups}:
        kept = [w for (x, w), n in docs.items() if x == lang and n >= least_docs]
        sources = sorted(s for x, s in groups if x == lang)
        tally = {s: {w: count[lang, s, w] for w in kept} for s in sources}
        whole = {w: sum(tally[s][w] for s in sources) for w in kept}

        def shares(t):
            total = sum(t.values()) + 5 * len(kept)
            return {w: 1 + 10 ** 9 * (n + 5) // total for w, n in t.items()}
        q, p = shares(whole), {s: shares(tally[s]) for s in sources}
        for s in sources:
            pair = sorted((-sum(abs(p[s][w] - p[o][w]) for w in kept), o.encode()) for o in sources if o != s)
            term = sorted((q[w] - p[s][w], w.encode()) for w in kept if tally[s][w] and p[s][w] > q[w])[:ranks]
            for part, items in (("pair", pair), ("term", term)):
                out |= {(lang, s, part, i.decode(), -v, r) for r, (v, i) in enumerate(items, 1)}
    return out


@pytest.fixture()
def audited(spark):
    from daybook.llm.common import prepare

    def run(rows, least_docs, ranks=50):
        prepare(spark)
        docs = spark.createDataFrame([(i % 7, t, lang, s, None) for i, (t, lang, s) in enumerate(rows)], DOCS)
        for name in ("term", "n", "docs", "p", "q", "block", "base", "total", "terms", "item", "value", "rank"):
            docs = docs.selectExpr("*", f"doc_id * 7 as `{name}`")
        got = [tuple(r) for r in divergence.audit(docs, least_docs, ranks).collect()]
        assert len(set(got)) == len(got)
        return set(got)
    return run


def random_rows(n, seed):
    rng = random.Random(seed)
    words = ["the", "The", "of", "naïve", "Ünder", "über", "😀", "it's", "a1b", "x_y"] + [f"w{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(60)]
    rows = []
    for _ in range(n):
        lang, source = rng.choice(["en", "de", None]), rng.choice(["s1", "s2", "s2", "s2", "t,", "", None, "ß"])
        some = words if source != "s1" else words[:20]
        rows.append((" ".join(rng.choice(some) for _ in range(rng.choice([0, 1, 5, 40]))), lang, source))
    return rows + [("", "de", "nothing"), ("12 34", "de", "digits"), (None, "fr", "only"), ("rare words here", "it", "a"), ("other", "it", "b")]


@pytest.mark.parametrize("least_docs", [1, 5, 30])
def test_against_brute_force(audited, least_docs):
    rows = random_rows(300, least_docs)
    assert audited(rows, least_docs) == brute(rows, least_docs, 50)


def test_several_blocks_and_flushes(audited, monkeypatch):
    # The settings reach the driver's plan; the workers count with their own HELD.
    monkeypatch.setattr(divergence, "POSTINGS", 16)
    monkeypatch.setattr(divergence, "PER_SOURCE", 2)
    rows = random_rows(300, 9)
    assert audited(rows, 2, 3) == brute(rows, 2, 3)


def test_counts_are_emitted_when_many_are_held(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(divergence, "HELD", 10)
    texts = [" ".join(f"w{chr(97 + i)}{chr(97 + j)}" for j in range(8)) for i in range(20)] * 2
    batch = pa.RecordBatch.from_arrays([pa.array(texts), pa.array(["en"] * 40), pa.array(["s"] * 40)], ["text", "lang", "source"])
    out = list(divergence._count(iter([batch])))
    assert len(out) > 10 and sum(r["n"] for b in out for r in b.to_pylist()) == 320
    assert sum(r["docs"] for b in out for r in b.to_pylist()) == 320


def test_odd_texts(audited):
    rows = [(t, "en" if i else None, f"s{(i or 0) % 3}") for i, t in ODD_TEXTS]
    assert audited(rows, 1) == brute(rows, 1, 50)


def test_empty(audited):
    assert audited([], 1) == set()
