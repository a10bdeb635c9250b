"""Staging: source rows -> fixed nine-column order-line table.

``order_date`` is re-derived from the timestamp (``DATE(order_timestamp)``) rather than trusted from
the source.  v1 keeps rows with a NULL timestamp (they form a NULL day); v2 drops them and, when
incremental, keeps only days on or after ``from_date`` (inclusive, no upper bound).

A pure projection and filter: no shuffle.  Both predicates reach the Parquet scan
(``to_date(ts) >= d`` is pushed as a timestamp range).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook import schemas as S
from daybook.functions.dates import date_lit


def stage(transactions: DataFrame, *, drop_null_timestamp: bool, from_date=None,
          extra_columns: Sequence[str] = ()) -> DataFrame:
    df = transactions
    if drop_null_timestamp:
        df = df.filter(F.col(S.ORDER_TS).isNotNull())
    if from_date is not None:
        df = df.filter(F.to_date(F.col(S.ORDER_TS)) >= date_lit(from_date))
    cols = [F.to_date(F.col(S.ORDER_TS)).alias(S.ORDER_DATE)]
    cols += [F.col(c) for c in S.STAGING_COLUMNS[1:]]
    cols += [F.col(c) for c in extra_columns]
    return df.select(*cols)


def stage_v1(transactions: DataFrame, extra_columns: Sequence[str] = ()) -> DataFrame:
    """Full-batch staging (rebuilt every run, NULL timestamps kept)."""
    return stage(transactions, drop_null_timestamp=False, extra_columns=extra_columns)


def stage_v2(transactions: DataFrame, from_date=None, extra_columns: Sequence[str] = ()) -> DataFrame:
    """Incremental staging batch; ``from_date=None`` is the first run or a full refresh."""
    return stage(transactions, drop_null_timestamp=True, from_date=from_date, extra_columns=extra_columns)
