import collections
import random

import numpy as np
import pyarrow as pa

from daybook.llm import lines, shingles
from tests.llm.conftest import ODD_TEXTS
from tests.llm.test_linking import closure


def brute(texts, percent=80):
    """{(doc_id, line): kept (doc_id, line)} of all non-blank lines."""
    where = {}
    for i, t in texts.items():
        for k, line in enumerate((t or "").encode().split(b"\n")):
            if line.strip(b" \t\v\f\r"):
                where[(i, k)] = line
    first = {}
    for at in sorted(where):
        first.setdefault(where[at], at)
    classes = list(first)
    n = lines.SHINGLE
    sets = [{x[j:j + n] for j in range(len(x) - n + 1)} if len(x) >= n else {x} for x in classes]
    shared, edges = collections.defaultdict(list), []
    for k, s in enumerate(sets):
        common = collections.Counter(j for x in s for j in shared[x])
        edges += [(j, k) for j, c in common.items() if 100 * c >= percent * (len(s) + len(sets[j]) - c)]
        for x in s:
            shared[x].append(k)
    label = closure(range(len(classes)), edges)
    index = {c: k for k, c in enumerate(classes)}
    return {at: first[classes[label[index[x]]]] for at, x in where.items()}


def check(rows, texts):
    want = brute(texts)
    got = {(r.doc_id, r.line): (r.keep_doc_id, r.keep_line) for r in rows}
    assert got == want
    assert all(r.kept == (got[(r.doc_id, r.line)] == (r.doc_id, r.line)) for r in rows)


def texts_with_repeats(seed=3):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 9)))
    pool = [" ".join(word() for _ in range(rng.choice([1, 4, 30]))) for _ in range(60)]
    out = {}
    for i in range(80):
        own = []
        for _ in range(rng.randint(0, 6)):
            line = rng.choice(pool) if rng.random() < 0.5 else " ".join(word() for _ in range(20))
            if rng.random() < 0.3 and len(line) > 100:
                at = rng.randrange(len(line))
                line = line[:at] + rng.choice("xyz") + line[at + 1:]
            own.append(line)
        out[i * 3] = "\n".join(own)
    return out


def test_against_brute_force(make_docs):
    texts = texts_with_repeats()
    check(lines.classify(make_docs(list(texts.items()))).collect(), texts)


def test_odd_texts(make_docs):
    texts = {i: t for i, t in ODD_TEXTS if i is not None and i != 9} | {30: "dup\n\ndup\r\n dup", 31: "\n\n", 32: "dup"}
    check(lines.classify(make_docs(list(texts.items()))).collect(), texts)
    assert lines.classify(make_docs([])).collect() == []
    assert lines.classify(make_docs([(1, None)])).collect() == []


def test_drop_rewrites_only_what_loses_lines(make_docs):
    texts = texts_with_repeats(4) | {900: None, 901: "", 902: "\n \n"}
    keep = brute(texts)
    docs = make_docs([*texts.items(), (None, "a line without an id")])
    out = lines.drop_repeated_lines(docs)
    assert out.columns == docs.columns
    got = {r.doc_id: r.text for r in out.collect()}
    for i, t in texts.items():
        want = t if t is None else "\n".join(x for k, x in enumerate(t.split("\n")) if keep.get((i, k), (i, k)) == (i, k))
        assert got[i] == want
    assert got[None] == "a line without an id"
    assert lines.drop_repeated_lines(make_docs([])).count() == 0


def test_registered_query(spark):
    from daybook.llm.registered import QUERIES
    sf = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    check(QUERIES["op4_fuzzy_lines"](spark, sf).collect(), texts)


def test_one_changed_letter_in_short_lines_of_any_script(make_docs):
    """A line of 60 characters with one changed letter has similarity 51/61 in shingles of five
    characters, and the same in scripts of two and three bytes a letter."""
    rng = random.Random(11)
    texts, want = {}, {}
    for k, alphabet in enumerate(["abcdefghijklmnopqrstuvw", "абвгдежзийклмнопрстуфхц", "日本語文字列比較行編集写真学校電車時間問題", "😀😁😂😃😄😅😆😇😈😉😊😋😌😍😎😏"]):
        for i in range(40):
            line = "".join(rng.choice(alphabet) for _ in range(60))
            at = rng.randrange(20, 40)
            a, b = (k * 40 + i) * 2, (k * 40 + i) * 2 + 1
            texts[a], texts[b] = line, line[:at] + "x" + line[at + 1:]
            want[a] = want[b] = a
    got = {r.doc_id: r.keep_doc_id for r in lines.classify(make_docs(list(texts.items()))).collect()}
    # The keys of a pair at 51/61 meet with a chance of 0.9999.
    assert sum(got[i] == want[i] for i in texts) >= len(texts) - 1


def test_shingles_are_code_points(make_docs):
    """The sets are those of Python's code points, also in texts that mix scripts and short lines."""
    texts = ["ab\nabc é\nGrüße aus Köln\n😀\n\n日本語文字列\nabcde", "", "plain\nabcd", "é\nabcde", "abcde"]
    found = lines.Lines(pa.array(texts))
    n = lines.SHINGLE
    names = {}
    sets = [x for at, to in found.chunks() for x in lines._split(*found.sets(at, to))]
    for doc, number, items in zip(found.text, found.number, sets, strict=True):
        line = texts[doc].split("\n")[number]
        want = {line[j:j + n] for j in range(len(line) - n + 1)} if len(line) >= n else {line}
        assert len(items) == len(want)
        for x in [line] if len(want) == 1 else []:
            assert names.setdefault(line, int(items[0])) == int(items[0])
    assert len(set(names.values())) == len(names)
    assert shingles.characters(found.raw, found.begins)[0].dtype != found.raw.dtype


def row_brute(rows):
    """Texts left of each row, told apart by position: first by (doc_id, nulls first, position)."""
    order = sorted(range(len(rows)), key=lambda k: (rows[k][0] is not None, rows[k][0] or 0, k))
    keep = brute({n: rows[k][1] for n, k in enumerate(order)})
    out = [None] * len(rows)
    for n, k in enumerate(order):
        out[k] = "\n".join(x for j, x in enumerate(rows[k][1].split("\n")) if keep.get((n, j), (n, j)) == (n, j))
    return out


def test_rows_with_equal_and_without_ids_lose_their_own_lines_only(make_docs):
    rows = [(1, "a line that two documents share with each other\nsome line of its own, first document"),
            (9, "only here: the first row that has the number nine\na line that two documents share with each other"),
            (9, "second row of number nine, its first line is unique\nand its second line is found nowhere else too"),
            (None, "no id: unique line of the first row without one\nshared by rows without any id at all"),
            (None, "shared by rows without any id at all\nno id, but another unique line in the second one"),
            (None, "third row without an id, found nowhere else"),
            (12, "equal rows, line one of them\nequal rows, line two of them"), (12, "equal rows, line one of them\nequal rows, line two of them")]
    got = sorted((r.doc_id or 0, r.text) for r in lines.drop_repeated_lines(make_docs(rows)).collect())
    want = sorted((i or 0, t) for (i, _), t in zip(rows, row_brute(rows)))
    if got != want:  # which of two equal rows, or of two without id, comes first is the table's layout
        flat = lambda x: sorted(line for _, t in x for line in t.split("\n") if line)
        assert flat(got) == flat(want)
        assert [t for i, t in got if i == 9] == [t for i, t in want if i == 9]
    assert len(lines.classify(make_docs(rows)).collect()) == 15


def test_place_of_rows_read_from_files(spark, make_docs, tmp_path):
    texts = texts_with_repeats(6)
    path = str(tmp_path / "docs")
    make_docs(list(texts.items()), extra=False).repartition(5).write.parquet(path)
    docs = spark.read.parquet(path)
    check(lines.classify(docs).collect(), texts)
    check(lines.classify(docs.select("doc_id", "text").filter("doc_id >= 0")).collect(), texts)
    both = docs.union(docs.filter("doc_id < 0"))
    check(lines.classify(both).collect(), texts)


def test_recall_of_lines_at_the_bound():
    """Share of pairs at a similarity from 0.80 to 0.85 that share a key, by length of the lines."""
    rng = random.Random(12)
    letters = "abcdefghijklmnopqrstuvwxyz    "
    for size, edits in ((60, 1), (150, 3), (400, 8), (2000, 42)):
        pairs = []
        while len(pairs) < 1500:
            x = "".join(rng.choice(letters) for _ in range(size - 2)) + "ab"
            y = list(x)
            for _ in range(edits):
                y[rng.randrange(size)] = rng.choice("XYZ")
            y = "".join(y)
            a, b = ({t[j:j + 5] for j in range(size - 4)} for t in (x, y))
            if 80 <= 100 * len(a & b) / len(a | b) < 85:
                pairs += [x, y]
        _, keys = lines.Lines(pa.array(pairs)).signatures()
        met = (keys[0::2] == keys[1::2]).any(axis=1)
        assert len(met) == len(pairs) // 2 and met.mean() > 0.995, (size, met.mean())
