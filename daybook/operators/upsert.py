"""Upsert semantics as DataFrame expressions (what the target holds after the write).

``delete+insert`` by a key: delete every target row whose key occurs in the batch, then insert the
**whole** batch.  The key need not be unique (an order has several lines): all lines of a touched
order are replaced by the batch's lines.  Keys absent from the batch are not deleted; a NULL key
never matches (equi-join semantics, like ``key IN (SELECT key ...)``).

Never ``dropDuplicates(key)`` and never a key-matched MERGE: both lose lines.

The anti-join is a shuffle on the key at scale; AQE's skew-join handling splits a hot key's
partition (nothing is repartitioned by hand, which would switch that off).  ``sources.warehouse`` applies these to stored, partitioned tables and scopes the
rewrite to the touched partitions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from daybook import schemas as S


def merged_columns(target: DataFrame, batch: DataFrame) -> list[str]:
    """``on_schema_change=append_new_columns``: the target's columns, then the batch's new ones.
    Nothing is dropped; rows from either side get NULL for the columns they lack."""
    return list(target.columns) + [c for c in batch.columns if c not in target.columns]


def append_new_columns(target: DataFrame, batch: DataFrame) -> DataFrame:
    """Insert-only union under the schema-evolution rule."""
    out = target.unionByName(batch, allowMissingColumns=True)
    return out.select(*merged_columns(target, batch))


def delete_insert(target: DataFrame, batch: DataFrame, key: str) -> DataFrame:
    keys = batch.select(key).distinct()
    kept = target.join(keys, on=key, how="left_anti")
    return append_new_columns(kept.select(*target.columns), batch)


def replace_days(target: DataFrame, batch: DataFrame, key: str = S.ORDER_DATE) -> DataFrame:
    """delete+insert by ``order_date``: the days present in the batch are replaced."""
    return delete_insert(target, batch, key)
