"""Homomorphic document fingerprints.

A text is a multiset of paragraphs (its non-empty lines).  Every paragraph is hashed to one wide
vector, and a document's fingerprint is the sum of its paragraphs' vectors, lane by lane, modulo a
power of two.  So equal texts have equal fingerprints, the order of paragraphs doesn't matter, and
a paragraph is inserted or deleted by adding or subtracting its vector.  The vector has two parts:

* ``WIDE`` lanes modulo 2^60, hashed from the whole paragraph: these tell different multisets apart;
* ``2 x 63`` narrow lanes modulo 2^20, three to a long, with a random bit per sentence of the
  paragraph, plus the number of sentences.  ``2 * bit sum - sentences`` is a sum of random signs, so
  the squared difference of two fingerprints estimates how many sentences they don't share:
  ``likeness = 1 - |a - b|^2 / (|a|^2 + |b|^2)``, clipped to 0..1 (standard error about 0.1).

Only DataFrame functions.  A fingerprint is folded within its row, without a shuffle, so neither a
hot source nor a group of copies meets in a task.  :func:`with_neighbours` needs the next document's
whole text: the table is cut into ranges of ``doc_id`` at quantiles, and the first row of a range is
also sent to the range before it, so one shuffle of the texts serves a window per range.  The cuts
go through the driver: ``MAX_RANGES`` numbers at most, whatever the corpus.

Defined cases: null or empty text has no paragraphs and the zero fingerprint; two zero fingerprints
have likeness 1, zero and non-zero 0; rows that share a ``doc_id`` are ordered by text; rows without
``doc_id`` come last; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daybook.llm.common import let, text_or_empty

WIDE = 8
SHIFTS = 21
FIELDS = (0, 21, 42)
WIDE_MASK = (1 << 60) - 1
BITS = sum(1 << f for f in FIELDS)
#: 20 bits kept of each 21-bit field; the spare bit takes the carry, which is dropped.
NARROW_MASK = sum(((1 << 20) - 1) << f for f in FIELDS)
COUNT_MASK = (1 << 20) - 1
LANES = WIDE + 2 * SHIFTS + 1
ROWS_PER_RANGE = 1000
MAX_RANGES = 20_000


def paragraphs(text: Column) -> Column:
    return F.filter(F.split(text, r"\r?\n"), lambda p: F.length(F.trim(p)) > 0)


def sentences(paragraph: Column) -> Column:
    """Sentences and clauses: the units that likeness counts."""
    return F.split(paragraph, r"(?<=[.,!?;:]) +")


def _masks() -> Column:
    return F.lit([WIDE_MASK] * WIDE + [NARROW_MASK] * 2 * SHIFTS + [COUNT_MASK])


def zero() -> Column:
    return F.array_repeat(F.lit(0).cast("long"), LANES)


def add(a: Column, b: Column) -> Column:
    """Lane-wise sum of two fingerprints (arrays of ``LANES`` longs)."""
    return F.transform(F.arrays_zip(a.alias("a"), b.alias("b"), _masks().alias("m")),
                       lambda x: (x["a"] + x["b"]).bitwiseAND(x["m"]))


def subtract(a: Column, b: Column) -> Column:
    """Fingerprint ``a`` without the paragraphs of ``b``: field-wise, borrowing from the spare bits."""
    guard = sum(1 << (f + 20) for f in FIELDS)
    guards = F.lit([1 << 60] * WIDE + [guard] * 2 * SHIFTS + [1 << 20])
    return F.transform(F.arrays_zip(a.alias("a"), b.alias("b"), _masks().alias("m"), guards.alias("g")),
                       lambda x: (x["a"].bitwiseOR(x["g"]) - x["b"]).bitwiseAND(x["m"]))


def _narrow(paragraph: Column) -> Column:
    """The narrow lanes of one paragraph: bit sums over its sentences, and their number."""
    def step(acc: Column, s: Column) -> Column:
        bits = let(F.struct(F.xxhash64(F.lit(1), s).alias("x"), F.xxhash64(F.lit(2), s).alias("y")),
                   lambda h: F.array(
                       *[F.shiftrightunsigned(h["x"], i).bitwiseAND(F.lit(BITS)) for i in range(SHIFTS)],
                       *[F.shiftrightunsigned(h["y"], i).bitwiseAND(F.lit(BITS)) for i in range(SHIFTS)],
                       F.lit(1).cast("long")))
        return F.zip_with(acc, bits, lambda a, b: (a + b).bitwiseAND(F.lit(NARROW_MASK)))
    return F.aggregate(sentences(paragraph), F.array_repeat(F.lit(0).cast("long"), 2 * SHIFTS + 1), step)


def _wide(paragraph: Column) -> Column:
    return let(F.struct(F.xxhash64(paragraph).alias("x"), F.xxhash64(F.lit(3), paragraph).alias("y")), lambda h: F.array(
        *[F.xxhash64(F.lit(i), h["x"], h["y"]).bitwiseAND(F.lit(WIDE_MASK)) for i in range(WIDE)]))


def of_paragraph(paragraph: Column) -> Column:
    """The vector of one paragraph: what inserting it adds to a fingerprint."""
    return F.concat(_wide(paragraph), _narrow(paragraph))


def of_text(text: Column) -> Column:
    """Sum of the paragraphs' vectors.  The two parts are folded apart, each by one masked addition
    a lane, which keeps the work per paragraph and per sentence small."""
    parts = paragraphs(text)
    wide = F.aggregate(F.transform(parts, _wide), F.array_repeat(F.lit(0).cast("long"), WIDE),
                       lambda a, v: F.zip_with(a, v, lambda x, y: (x + y).bitwiseAND(F.lit(WIDE_MASK))))
    narrow = F.aggregate(F.transform(parts, _narrow), F.array_repeat(F.lit(0).cast("long"), 2 * SHIFTS + 1),
                         lambda a, v: F.zip_with(a, v, lambda x, y: (x + y).bitwiseAND(F.lit(NARROW_MASK))))
    return F.concat(wide, narrow)


def to_hex(fp: Column) -> Column:
    """16 hex digits a lane."""
    return F.lower(F.array_join(F.transform(fp, lambda x: F.lpad(F.hex(x), 16, "0")), ""))


def signs(fp: Column) -> Column:
    """The narrow lanes as sums of random signs."""
    fields = F.flatten(F.transform(F.slice(fp, WIDE + 1, 2 * SHIFTS), lambda x: F.array(
        *[F.shiftrightunsigned(x, f).bitwiseAND(F.lit(COUNT_MASK)) for f in FIELDS])))
    return let(F.get(fp, F.lit(LANES - 1)), lambda n: F.transform(fields, lambda v: (2 * v - n).cast("double")))


def likeness(a: Column, b: Column) -> Column:
    """0 to 1 from two sign vectors (:func:`signs`)."""
    sums = F.aggregate(F.arrays_zip(a.alias("a"), b.alias("b")),
                       F.struct(F.lit(0.0).alias("d"), F.lit(0.0).alias("s")),
                       lambda t, x: F.struct((t["d"] + (x["a"] - x["b"]) * (x["a"] - x["b"])).alias("d"),
                                             (t["s"] + x["a"] * x["a"] + x["b"] * x["b"]).alias("s")))
    return let(sums, lambda t: F.when(t["s"] == 0, F.lit(1.0)).otherwise(
        F.greatest(F.lit(0.0), 1 - t["d"] / t["s"])))


def _cuts(ids: DataFrame) -> list[int]:
    """The greatest ids of the ranges, descending: at most ``MAX_RANGES`` ids that occur."""
    rows = ids.count()
    n = max(1, min(MAX_RANGES, rows // ROWS_PER_RANGE))
    got = ids.agg(F.percentile_approx("doc_id", [i / n for i in range(1, n + 1)], max(10_000, 10 * n))).collect()[0][0]
    return sorted(set(got or ()), reverse=True)


def _range_of(doc_id: Column, cuts: list[int]) -> Column:
    """Index of the range ``(cuts[i + 1], cuts[i]]`` that holds ``doc_id``, by bisection."""
    bounds = F.lit(cuts) if cuts else F.array().cast("array<bigint>")
    state = F.struct(F.lit(0).alias("lo"), F.lit(len(cuts)).alias("hi"))

    def halve(a: Column, _: Column) -> Column:
        mid = F.shiftright(a["lo"] + a["hi"], 1)
        at_least = F.get(bounds, mid) >= doc_id
        return F.when(a["lo"] >= a["hi"], a).otherwise(F.struct(
            F.when(at_least, mid + 1).otherwise(a["lo"]).alias("lo"), F.when(at_least, a["hi"]).otherwise(mid).alias("hi")))

    steps = F.lit(list(range(len(cuts).bit_length() + 1)))
    return F.aggregate(steps, state, halve)["lo"] - 1


def with_next(docs: DataFrame, carried: list[str]) -> DataFrame:
    """``docs`` with ``next``, a struct of the ``carried`` columns of the next document in
    descending ``doc_id`` (ties by text); after the last comes the first.  Rows without ``doc_id``
    are outside the order: their ``next`` is null."""
    named = docs.filter(F.col("doc_id").isNotNull())
    cuts = _cuts(named.select("doc_id"))
    at = _range_of(F.col("doc_id"), cuts)
    heads = F.lit(cuts) if cuts else F.array().cast("array<bigint>")
    placed = named.withColumn("_range", at)
    copies = F.when(F.get(heads, F.col("_range")) == F.col("doc_id"), F.array(
        F.struct(F.col("_range").alias("r"), F.lit(False).alias("copy")),
        F.struct(F.pmod(F.col("_range") - 1, F.lit(max(1, len(cuts)))).alias("r"), F.lit(True).alias("copy")),
    )).otherwise(F.array(F.struct(F.col("_range").alias("r"), F.lit(False).alias("copy"))))
    spread = placed.select("*", F.explode(copies).alias("_to")).select(
        *docs.columns, F.col("_to.r").alias("_range"), F.col("_to.copy").alias("_copy"))
    order = Window.partitionBy("_range").orderBy("_copy", F.desc("doc_id"), "text")
    following = F.lead(F.struct(*carried), 1).over(order)
    linked = spread.withColumn("next", following).filter(~F.col("_copy")).drop("_range", "_copy")
    loose = docs.filter(F.col("doc_id").isNull()).withColumn("next", F.lit(None).cast(linked.schema["next"].dataType))
    return linked.unionByName(loose)


def edited_text(text: Column, n: Column, next_text: Column) -> Column:
    """``text`` with its last ``n // 2`` code points replaced by the first as many of ``next_text``."""
    half = F.shiftright(n, 1)
    return F.concat(F.substring(text, F.lit(1), n - half), F.substring(next_text, F.lit(1), half))


def compare_with_next(docs: DataFrame) -> DataFrame:
    """``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next``."""
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    pairs = with_next(base.withColumn("fp", of_text(F.col("text"))), ["text", "fp"])
    edited = pairs.withColumn("n", F.length("text")).withColumn(
        "edited", edited_text(F.col("text"), F.col("n"), F.coalesce("next.text", F.lit(""))))
    marked = edited.select(
        "doc_id", "n", "fp", F.coalesce("next.fp", zero()).alias("next_fp"), of_text(F.col("edited")).alias("edited_fp"),
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"))
    own = let(signs(F.col("fp")), lambda s: F.struct(
        likeness(s, signs(F.col("edited_fp"))).alias("edited"), likeness(s, signs(F.col("next_fp"))).alias("next")))
    return (marked.withColumn("near", own)
            .select("doc_id", F.col("n").cast("long").alias("n_chars"), "edited_sha256", to_hex(F.col("fp")).alias("fingerprint"),
                    to_hex(F.col("edited_fp")).alias("edited_fingerprint"),
                    F.col("near.edited").alias("near_edited"), F.col("near.next").alias("near_next")))
