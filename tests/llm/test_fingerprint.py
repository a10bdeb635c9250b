import hashlib
import random

from pyspark.sql import functions as F

from daybook.llm import fingerprint as fp
from tests.llm.conftest import ODD_TEXTS


def prints(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r.f for r in df.select("i", fp.of_text(F.col("t")).alias("f")).orderBy("i").collect()]


def test_order_independent_and_additive(spark):
    paras = [f"Paragraph {i}. It has clauses, some of them." for i in range(300)] + ["again", "again"]
    mixed = paras[:]
    random.Random(1).shuffle(mixed)
    whole, other, less, one, empty = prints(spark, ["\n".join(paras), "\n".join(mixed), "\n".join(paras[:-1]), "again", ""])
    assert whole == other and whole != less and empty == [0] * fp.LANES
    df = spark.createDataFrame([(whole, less, one)], "w array<long>, l array<long>, o array<long>")
    r = df.select(fp.add(F.col("l"), F.col("o")).alias("a"), fp.subtract(F.col("w"), F.col("o")).alias("s"),
                  fp.subtract(F.col("o"), F.col("o")).alias("z")).first()
    assert r.a == whole and r.s == less and r.z == empty


def test_paragraph_vector_is_what_insertion_adds(spark):
    r = spark.createDataFrame([("one, two. three",)], "t string").select(
        fp.of_paragraph(F.col("t")).alias("p"), fp.of_text(F.col("t")).alias("t")).first()
    assert r.p == r.t


def brute(texts):
    """{doc_id: (n_chars, sha of edited)} for distinct ids."""
    ids = sorted((i for i in texts if i is not None), reverse=True)
    out = {}
    for k, i in enumerate(ids):
        t, nxt = texts[i] or "", texts[ids[(k + 1) % len(ids)]] or ""
        half = len(t) // 2
        out[i] = (len(t), hashlib.sha256((t[:len(t) - half] + nxt[:half]).encode()).hexdigest())
    return out


def check(rows, texts):
    want = brute(texts)
    got = {r.doc_id: (r.n_chars, r.edited_sha256) for r in rows if r.doc_id is not None}
    assert got == want
    for r in rows:
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1


def test_odd_texts(make_docs):
    texts = dict(ODD_TEXTS)
    rows = fp.compare_with_next(make_docs(list(texts.items()))).collect()
    check(rows, texts)
    assert len(rows) == len(texts)


def test_many_ranges(make_docs):
    texts = {i * i: f"text {i}, with {i % 7} parts. " * (i % 5 + 1) for i in range(2600)}
    rows = fp.compare_with_next(make_docs(list(texts.items()))).collect()
    check(rows, texts)
    by = {r.doc_id: r for r in rows}
    same = {}
    for i, t in texts.items():
        same.setdefault(t, set()).add(by[i].fingerprint)
    assert all(len(s) == 1 for s in same.values()) and len({x for s in same.values() for x in s}) == len(same)


def test_one_row_repeated_rows_and_empty_table(make_docs):
    check(fp.compare_with_next(make_docs([(5, "one text. two")])).collect(), {5: "one text. two"})
    assert len(fp.compare_with_next(make_docs([(5, "a"), (5, "a"), (5, None)])).collect()) == 3
    assert fp.compare_with_next(make_docs([])).collect() == []


def test_likeness_orders(spark):
    from daybook.llm.registered import QUERIES
    rows = QUERIES["op2_fingerprints"](spark, "/root/testdata/sf0.001").collect()
    long = [r for r in rows if r.n_chars > 1000]
    assert sum(r.near_edited > r.near_next for r in long) >= 0.97 * len(long)
    assert 0.3 < sum(r.near_edited for r in long) / len(long) < 0.7
