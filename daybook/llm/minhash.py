"""Near-duplicate documents by MinHash with tensored banding.

A document's set is its distinct shingles of ``words`` consecutive words (lower-cased A-Z).
``COLLECTIONS`` small collections of ``ROWS`` min-hash values each are computed, and a table key is
formed for every *pair* of collections.  So ``COLLECTIONS * (COLLECTIONS - 1) / 2`` tables of
``2 * ROWS`` values each need only ``COLLECTIONS * ROWS`` min-hash computations, about the square
root's order of what separate bands would take.  Two documents meet in a table unless fewer than
two of their collections agree; at similarity 0.8 with 13 collections of 2 values that has a chance
of 4e-5, at 0.85 3e-6.  Candidates are confirmed on the full sets of 64-bit shingle hashes.

Scale: documents with equal sets (exact copies, however many) are one class before any key is
formed; keys are linked by :mod:`linking`, which deals the rows of one key to several tasks and
never forms all pairs of a group.  Full sets are computed only for documents of pairs that may be near.

Defined cases: null, empty or word-less text: empty set, linked with nothing, a component of its
own; a text of fewer words than a shingle is one shingle; every row is a document, told apart by its
place in the table, whether its ``doc_id`` is null or repeated; in :func:`classify` a component is named by its
smallest ``doc_id``, rows of that id are kept, and rows without id take no part; :func:`drop_near_duplicates` keeps
one row of each component, the first by (doc_id, place; rows without id last); extra columns are ignored
or pass through.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm import linking, shingles
from daybook.llm.common import Scratch, Sieve, numbered, split_by, text_or_empty, written

COLLECTIONS = 13
ROWS = 2
SEED = 20
PARTS = [f"part{c}" for c in range(COLLECTIONS)]
WHERE = ["doc_id", "file", "place"]
SIGNED = [*WHERE, "h1", "h2", "size", *PARTS]


def _hashed(column: pa.Array, words: int) -> tuple[np.ndarray, np.ndarray]:
    raw, offsets = shingles.text_bytes(column)
    return shingles.shingle_hashes(*shingles.word_hashes(raw, offsets), words)


def _signatures(batches: Iterator[pa.RecordBatch], words: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        hashes, offsets = _hashed(batch.column("text"), words)
        values = shingles.min_hashes(hashes, offsets, COLLECTIONS * ROWS, SEED).astype(np.uint64)
        parts = np.zeros((len(batch), COLLECTIONS), np.uint64)
        for r in range(ROWS):
            parts = shingles.mix(parts + values[:, r::ROWS] + np.uint64(r + 1))
        h1, h2 = (np.zeros(len(batch), np.uint64) for _ in range(2))
        sizes = np.zeros(len(batch), np.int64)
        for i in range(len(batch)):
            s = shingles.mix(np.unique(hashes[offsets[i]:offsets[i + 1]]))
            h1[i] = s.sum(dtype=np.uint64)
            h2[i] = shingles.mix(s ^ np.uint64(0x5555555555555555)).sum(dtype=np.uint64)
            sizes[i] = len(s)
        longs = [h1.view(np.int64), h2.view(np.int64), sizes, *parts.view(np.int64).T]
        yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in WHERE], *[pa.array(np.ascontiguousarray(x)) for x in longs]], SIGNED)


def _wanted(batches: Iterator[pa.RecordBatch], words: int, sieve, facts: bool) -> Iterator[pa.RecordBatch]:
    """Place and facts, or full set, of the rows that may be wanted."""
    for batch in batches:
        places = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("file", "place")]
        batch = batch.filter(pa.array(sieve.value(*places)))
        if not len(batch):
            continue
        hashes, offsets = _hashed(batch.column("text"), words)
        items = [np.unique(hashes[a:b]) for a, b in zip(offsets[:-1], offsets[1:])]
        if facts:
            bits = [linking.parities(shingles.mix(s), np.zeros(len(s), np.int64), 1)[0] for s in items]
            found = [pa.array([len(s) for s in items], pa.int64()), *[pa.array(np.ascontiguousarray(x)) for x in np.array(bits).T]]
        else:
            found = [pa.array([s.view(np.int64) for s in items], pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays([batch.column("file"), batch.column("place"), *found], ["file", "place", *(linking.FACTS if facts else ["items"])])


def _labelled(docs: DataFrame, words: int, percent: int, takes_part: str = "true") -> tuple[DataFrame, DataFrame]:
    """Numbered ``docs``, and for each row ``WHERE``, ``size`` and ``label``, the number of its component
    (null for empty sets and rows that take no part)."""
    rows = numbered(docs)
    with Scratch(docs.sparkSession) as scratch:
        texts = rows.select(F.col("row.doc_id").cast("long").alias("doc_id"), "file", "place", text_or_empty(F.col("row.text")).alias("text"))
        signed = texts.mapInArrow(lambda it: _signatures(it, words), ", ".join(f"{c} long" for c in SIGNED))
        signed = written(signed, "signatures")
        # Facts and parts are the same in all rows of a class.
        classes = signed.filter("size > 0").filter(takes_part).groupBy("h1", "h2").agg(
            F.min(F.struct("file", "place")).alias("at"), *[F.min(c).alias(c) for c in ("size", *PARTS)])
        classes = written(classes.withColumn("id", F.monotonically_increasing_id()), "classes")

        def found(ids: DataFrame, facts: bool) -> DataFrame:
            wanted = split_by(classes.select("id", "at"), ids, "id")[0].join(ids, "id")
            wanted = written(wanted.select("id", "at.file", "at.place"), "wanted")
            sieve = Sieve.build(wanted.select("file", "place"))
            names = [f"{c} long" for c in linking.FACTS] if facts else ["items array<long>"]
            some = texts.select("file", "place", "text").mapInArrow(
                lambda it: _wanted(it, words, sieve, facts), ", ".join(["file long, place long", *names]))
            return some.join(wanted, ["file", "place"]).drop("file", "place")

        keys = F.array(*[F.xxhash64(F.lit(t), i, j) for t, (i, j) in enumerate(combinations(PARTS, 2))])
        keyed = classes.select("id", "size", F.explode(keys).alias("key"))
        linked = linking.link(keyed, lambda ids: found(ids, True),
                              lambda ids: written(found(ids, False), "items"),
                              lambda both: linking.similar_sets(both, percent), percent)
        named = classes.select("id", "h1", "h2").join(linked, "id", "left").select("h1", "h2", F.coalesce("label", "id").alias("label"))
        keyed = signed.select(*WHERE, "size", F.when(F.expr(f"size > 0 and {takes_part}"), F.col("h1")).alias("h1"), "h2")
        return rows, scratch.keep(keyed.join(named, ["h1", "h2"], "left").select(*WHERE, "size", "label"), "labelled")


def classify(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept``."""
    _, labelled = _labelled(docs, words, percent, "doc_id is not null")
    least = labelled.filter("label is not null").groupBy("label").agg(F.min("doc_id").alias("least"))
    named = labelled.join(least, "label", "left").withColumn(
        "component_id", F.when(F.col("label").isNull(), F.col("doc_id")).otherwise(F.col("least")))
    return named.select("doc_id", F.col("size").alias("n_shingles"), "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def drop_near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` without the rows that are not the first of their component."""
    rows, labelled = _labelled(docs, words, percent)
    order = F.struct(F.col("doc_id").isNull().alias("none"), *WHERE)
    several = labelled.filter("label is not null")
    first = several.groupBy("label").agg(F.min(order).alias("first"), F.count("*").alias("n")).filter("n > 1")
    gone = several.join(first, "label").filter(~order.eqNullSafe(F.col("first"))).select("file", "place", F.xxhash64("file", "place").alias("at"))
    gone = written(gone, "near-duplicates")
    may, stay = split_by(rows.withColumn("at", F.xxhash64("file", "place")), gone, "at")
    left = may.join(gone.drop("at"), ["file", "place"], "left_anti")
    return stay.select("row").unionByName(left.select("row")).select("row.*")
