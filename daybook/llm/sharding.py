"""Placement of documents on shards through a permutation-filled lookup table.

Every shard has its own preference order over the slots of a prime-sized table: slot
``(offset + i * skip) mod size`` for ``i = 0, 1, ...`` with offset and skip hashed from the shard's
name.  The shards take turns, each claiming its most preferred free slot, until the table is full;
shares differ by at most one slot, and removing a shard leaves most other slots as they were.  A
row goes to the shard that owns slot ``hash(key) mod size``: one lookup, no shuffle, no state.

Scale: the table's size is a parameter (65,537 slots by default, whatever the corpus), so
broadcasting it is safe.  The key is hashed per row, so a source or language that holds a third of
all rows still spreads over all shards.

Defined cases: a null key counts as the empty string; rows with equal keys share a shard; extra
columns pass through, but ``slot`` and ``shard`` replace columns of those names.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TABLE_SIZE = 65_537
SHARDS = 64


def shard_names(n: int) -> list[str]:
    return [f"shard-{i:05d}" for i in range(n)]


def _number(name: str, salt: str) -> int:
    return int(hashlib.md5(f"{salt}:{name}".encode()).hexdigest()[:15], 16)


def fill_table(names: list[str], size: int = TABLE_SIZE) -> np.ndarray:
    """``table[slot]`` is the index of the owning shard."""
    if size < 2 or any(size % d == 0 for d in range(2, int(size ** 0.5) + 1)):
        raise ValueError("the table size must be prime")
    if not 0 < len(names) <= size or len(set(names)) < len(names):
        raise ValueError("shard names must be distinct, at least one and at most one per slot")
    steps = np.arange(size, dtype=np.int64)
    orders = [(_number(n, "offset") % size + steps * (_number(n, "skip") % (size - 1) + 1)) % size for n in names]
    table = np.full(size, -1, np.int32)
    at = [0] * len(names)
    filled = 0
    while True:
        for i, order in enumerate(orders):
            while table[order[at[i]]] >= 0:
                at[i] += 1
            table[order[at[i]]] = i
            filled += 1
            if filled == size:
                return table


def slot_of(key: Column, size: int = TABLE_SIZE) -> Column:
    digest = F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary"))
    return F.pmod(F.conv(F.substring(digest, 1, 15), 16, 10).cast("long"), F.lit(size))


def place(df: DataFrame, key: str, names: list[str], size: int = TABLE_SIZE) -> DataFrame:
    """``df`` with ``slot`` and ``shard`` (index into ``names``)."""
    table = df.sparkSession.createDataFrame(
        [(s, int(i)) for s, i in enumerate(fill_table(names, size))], "slot long, shard int")
    keyed = df.drop("slot", "shard").withColumn("slot", slot_of(F.col(key), size))
    return keyed.join(F.broadcast(table), "slot")


def write_shards(df: DataFrame, key: str, names: list[str], path: str, size: int = TABLE_SIZE) -> None:
    """One folder per shard.  ``rebalance`` lets adaptive execution split a large shard's rows over
    several files."""
    place(df, key, names, size).hint("rebalance", "shard").write.partitionBy("shard").parquet(path)
