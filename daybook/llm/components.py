"""Connected components of a link table by alternating star contraction.

Every round points each node's larger neighbours at its smallest one, then each node's smaller
neighbours at the smallest of them; the links end as one star per component, centred on the
component's smallest id.  The rounds needed grow with the logarithm of a component's extent, not
with its size.  Each round is written to the shared checkpoint folder.  Minima are combined before
the shuffle and the joins are plain equi-joins, so adaptive execution can split the rows of a hub.
The number of tasks is left to adaptive execution.  Before the first round every task contracts its own
links, a bounded number at a time, to stars: components whose links lie in one task are finished by that.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import Scratch, written

#: Links that a task contracts at a time.
BLOCK = 1 << 20


def _large_star(links: DataFrame) -> DataFrame:
    """``links``: (u, v) with u > v."""
    both = links.union(links.select("v", "u"))
    least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    # For u: every neighbour above u points at u's least neighbour (or at u itself).
    return (links.select(F.col("v").alias("u"), F.col("u").alias("v")).join(least, "u")
            .select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct())


def _small_star(links: DataFrame) -> DataFrame:
    least = links.groupBy("u").agg(F.min("v").alias("m"))
    joined = links.join(least, "u")
    return (joined.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(least.select("u", F.col("m").alias("v"))).distinct())


def _stars(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The stars of the components of some links: every node but the smallest, and the smallest."""
    nodes, at = np.unique(np.concatenate((u, v)), return_inverse=True)
    a, b = at[:len(u)], at[len(u):]
    label = np.arange(len(nodes))
    while True:
        x, y = label[a], label[b]
        if (x == y).all():
            break
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while not (label == (least := label[label])).all():
            label = least
    rest = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[rest], nodes[label[rest]]


def _own_stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[tuple[np.ndarray, ...]] = []

    def out() -> pa.RecordBatch:
        stars = _stars(*map(np.concatenate, zip(*held)))
        return pa.RecordBatch.from_arrays([pa.array(x) for x in stars], ["u", "v"])

    for batch in batches:
        held.append(tuple(c.to_numpy() for c in batch.columns))
        if sum(len(u) for u, _ in held) >= BLOCK:
            yield out()
            held = []
    if held:
        yield out()


def _mark(links: DataFrame) -> tuple:
    r = links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).collect()[0]
    return r[0], r[1]


def components(links: DataFrame) -> DataFrame:
    """(id, label) of every id in ``links`` (a, b): the label is the smallest id of its component."""
    with Scratch(links.sparkSession) as scratch:
        return scratch.keep(_contracted(links), "components")


def _contracted(links: DataFrame) -> DataFrame:
    now = written(links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
                  .mapInArrow(_own_stars, "u long, v long").distinct(), "links")
    mark = _mark(now)
    while mark[0]:
        now = written(_small_star(_large_star(now)), "links")
        before, mark = mark, _mark(now)
        if mark == before:
            break
    stars = now.select(F.col("u").alias("id"), F.col("v").alias("label"))
    return stars.union(stars.select(F.col("label").alias("id"), "label").distinct())
