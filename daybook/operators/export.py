"""Partitioned export of transactions in the ``year=/month=/date=`` layout.

Rows with no order date, no revenue or non-positive revenue are left out.  The write uses dynamic
partition overwrite: a rerun replaces the partitions it touches and leaves all others.  Before the
write, a ``rebalance`` on the partition keys lets AQE size the output: a hot day is split across
several tasks (and files), small days are coalesced, and each task writes few partitions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook import schemas as S

# The exported columns.
EXPORT_COLUMNS = (S.ORDER_ID, S.BUYER_ID, S.ORDER_DATE, S.ORDER_TS, S.PRODUCT_ID, S.QUANTITY,
                  S.UNIT_PRICE, S.REVENUE, S.PAYMENT_METHOD)


def export_valid(df: DataFrame) -> DataFrame:
    rev = F.col(S.REVENUE)
    return df.filter(F.col(S.ORDER_DATE).isNotNull() & rev.isNotNull() & (rev > 0))


def export_frame(transactions: DataFrame) -> DataFrame:
    """Valid rows with their partition keys (year, month, day of month) derived from order_date."""
    d = F.col(S.ORDER_DATE)
    return export_valid(transactions).select(
        *[F.col(c) for c in EXPORT_COLUMNS],
        F.year(d).alias("year"), F.month(d).alias("month"), F.dayofmonth(d).alias("date"))


def export_partition_counts(exported: DataFrame) -> DataFrame:
    return exported.groupBy(*S.PARTITION_KEYS).agg(F.count(F.lit(1)).alias("row_count"))


def partitioned_export(transactions: DataFrame, path: str) -> None:
    frame = export_frame(transactions)
    (frame.hint("rebalance", *S.PARTITION_KEYS)
     .write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic")
     .partitionBy(*S.PARTITION_KEYS)
     .parquet(path))
