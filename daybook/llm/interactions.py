"""Filter interaction audit: what five document filters remove alone, together and in every order.

A document fails some of the conditions ``A`` to ``E``; what a chain of filters does to it depends on
that set only.  ``A`` to ``D`` are read off the text in one scan.  ``E`` (the same text under a smaller
``doc_id``) is an existential self-join: the documents left-semi joined with themselves on the hash of
the text, the exact text, and a smaller ``doc_id``.  The ids it marks are united with the failures of
the other filters and aggregated to one combination of bits a document, and these to the counts of
each of the 32 combinations per part.  All 120 orders are worked out from these counts.

Scale: the scan leaves a few numbers a document, and its shuffles are of these.  Texts are shuffled
only for documents whose hash occurs under several ids (a sieve of fixed size lets others pass
only by chance), and the side of the smaller ids is combined to one row per text before its shuffle, so a
text that a third of all documents have is one row a task there, compared with once by each copy,
and its copies on the other side are rows that adaptive execution splits.  Combinations are at most
32 rows a part.

Defined cases: null text is empty (empty texts are identical to each other); null ``lang`` is the empty
part; a row without ``doc_id`` fails ``E`` never and makes no other fail it; rows that share a
``doc_id`` are judged each by its own text, and repeated rows count each; ``labels`` that name a
``doc_id`` several times mark it if one of them does; no documents: no rows; extra columns are ignored.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import Scratch, split_by, text_or_empty, written

FILTERS = "ABCDE"
SAME = FILTERS.index("E")
# The contract's conditions.
LEAST_WORDS = 200
DISTINCT_PERCENT = 50
CAPITALS_PERCENT = 3
SYMBOLS = r"[#$%&*|]"
WORD = r"[^\x20\x09-\x0D]+"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def own_failures(text: Column, words: Column) -> Column:
    """Bits of the conditions that a text fails by itself; ``words`` are its words."""
    n = F.size(words)
    capitals = F.length(text) - F.length(F.translate(text, CAPITALS, ""))
    failed = [n < LEAST_WORDS, 100 * F.size(F.array_distinct(words)) < DISTINCT_PERCENT * n,
              100 * capitals > CAPITALS_PERCENT * F.length(text), F.rlike(text, F.lit(SYMBOLS))]
    return sum((F.when(f, F.lit(1 << i)).otherwise(0) for i, f in enumerate(failed)), F.lit(0))


def _texts(docs: DataFrame) -> DataFrame:
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"),
                       text_or_empty().alias("text"))
    return rows.withColumn("hash", F.unhex(F.sha2(F.col("text").cast("binary"), 256)))


def repeated(texts: DataFrame, light: DataFrame) -> DataFrame:
    """Rows (doc_id, hash, part) of ``texts`` (doc_id, part, text, hash) whose text a smaller doc_id
    has too.  ``light`` has the same rows without text."""
    several = light.groupBy("hash").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).filter("low < high")
    several = written(several.select("hash", F.xxhash64("hash").alias("place")), "repeated-hashes")
    some, _ = split_by(texts.filter("doc_id is not null").withColumn("place", F.xxhash64("hash")), several, "place")
    some = some.join(several.select("hash"), "hash", "left_semi")
    # One row a text: whether any smaller id has it is whether the smallest is smaller.
    smaller = written(some.groupBy("hash", "text").agg(F.min("doc_id").alias("first")), "repeated-texts")
    same = [F.col("x.hash") == F.col("y.hash"), F.col("x.text") == F.col("y.text"), F.col("y.first") < F.col("x.doc_id")]
    return some.alias("x").join(smaller.alias("y"), same, "left_semi").select("doc_id", "hash", "part")


def combinations(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``part, bits, n, good, toxic``: how many documents of a part fail exactly the filters of
    ``bits``, and how many of these are labelled good and toxic."""
    texts = _texts(docs)
    words = texts.withColumn("words", F.regexp_extract_all("text", F.lit(WORD), F.lit(0)))
    light = written(words.select("doc_id", "part", "hash", own_failures(F.col("text"), F.col("words")).alias("bits")), "failures")
    union = light.select("*", F.lit(1).cast("long").alias("n")).unionByName(
        repeated(texts, light).select("*", F.lit(1 << SAME).alias("bits"), F.lit(0).cast("long").alias("n")))
    each = union.groupBy("doc_id", "hash", "part").agg(F.bit_or("bits").alias("bits"), F.sum("n").alias("n"))
    marks = (labels.filter("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
             .agg(F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic")))
    marked = each.join(marks, "doc_id", "left")
    return marked.groupBy("part", "bits").agg(
        F.sum("n").alias("n"), F.sum(F.col("n") * F.coalesce("good", F.lit(0))).alias("good"),
        F.sum(F.col("n") * F.coalesce("toxic", F.lit(0))).alias("toxic"))


def _bits(letters: Column) -> Column:
    each = F.filter(F.split(letters, ""), lambda c: c != "")
    return F.aggregate(each, F.lit(0), lambda a, c: a.bitwiseOR(F.element_at(F.create_map(*[
        F.lit(x) for i, f in enumerate(FILTERS) for x in (f, 1 << i)]), c)))


def in_every_order(tally: DataFrame) -> DataFrame:
    """The report from ``combinations``: a row per part, order of the filters and step."""
    parts = tally.groupBy("part").agg(F.collect_list(F.struct("bits", "n", "good", "toxic")).alias("of"))
    orders = F.array(*[F.lit("".join(p)) for p in permutations(FILTERS)])
    steps = (parts.select("part", "of", F.explode(orders).alias("filter_order"))
             .select("*", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))).alias("step"))
             .withColumn("before", _bits(F.substring("filter_order", F.lit(1), F.col("step") - 1)))
             .withColumn("own", _bits(F.substring("filter_order", F.col("step"), F.lit(1)))))

    def total(of: str | Column, which) -> Column:
        value = (lambda x: x[of]) if isinstance(of, str) else of
        return F.aggregate("of", F.lit(0).cast("long"), lambda a, x: a + F.when(which(x["bits"]), value(x)).otherwise(0))

    fails = lambda b: b.bitwiseAND(F.col("own")) != 0
    gone = lambda b: b.bitwiseAND(F.col("before")) != 0
    removed = lambda b: fails(b) & ~gone(b)
    # Of a document's failed filters each comes first in an equal share of all orders.
    all_orders = F.size(orders)
    share = lambda x: x["n"] * (all_orders / F.bit_count(x["bits"])).cast("long")
    return steps.select(
        "part", "filter_order", "step", total("n", lambda b: ~fails(b) & ~gone(b)).alias("kept"),
        total("n", removed).alias("removed"), total("n", lambda b: fails(b) & gone(b)).alias("redundant"),
        total("n", lambda b: b == F.col("own")).alias("unique_fails"), total("good", removed).alias("good_lost"),
        total("toxic", removed).alias("toxic_lost"), total(share, fails).alias("shapley"))


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``part, filter_order, step`` and the counts of ``COUNTS``."""
    with Scratch(docs.sparkSession) as scratch:
        return in_every_order(scratch.keep(combinations(docs, labels), "combinations"))
