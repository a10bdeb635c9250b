"""Adapters from the shared test tables to the transaction schema (fixture preparation).

* ``E`` - ``events``: one line per order (event).
* ``L`` - ``lineitem`` joined to ``orders`` on the order key: a true multi-line order, so
  ``order_id`` is not unique, as in the store-transaction source.

Keys stay bigint; no operator depends on the key type.  The lineitem/orders join is a plain
equi-join left to Catalyst and AQE (sort-merge at scale, a broadcast only when the runtime size of
``orders`` is under the checked threshold); it is input preparation, not an engine operator.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook import schemas as S

# The dates that leave 14 days in the window with the prior day present.
EVENTS_FROM_DATE = "2024-01-17"
LINES_FROM_DATE = "2001-07-19"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def events_as_transactions(events: DataFrame) -> DataFrame:
    return events.select(
        F.col("event_id").alias(S.ORDER_ID),
        F.col("user_id").alias(S.BUYER_ID),
        F.to_date("ts").alias(S.ORDER_DATE),
        F.col("ts").alias(S.ORDER_TS),
        F.lit(0).cast("long").alias(S.PRODUCT_ID),
        F.lit(1).cast("long").alias(S.QUANTITY),
        F.col("value").alias(S.UNIT_PRICE),
        F.col("value").alias(S.REVENUE),
        F.col("event_type").alias(S.PAYMENT_METHOD),
    )


def unit_price_from_total(total_col: str, qty_col: str):
    """Total / quantity rounded half-up to cents, in exact integer arithmetic."""
    cents = F.rint(F.col(total_col) * 100).cast("long")
    q = F.col(qty_col).cast("long")
    return F.when(q > 0, F.floor((cents * 2 + q) / (q * 2)) / 100.0)


def lines_as_transactions(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    li = lineitem.select("l_orderkey", "l_partkey", "l_quantity", "l_extendedprice")
    od = orders.select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    j = li.join(od, li["l_orderkey"] == od["o_orderkey"], "inner")
    return j.select(
        F.col("l_orderkey").alias(S.ORDER_ID),
        F.col("o_custkey").alias(S.BUYER_ID),
        F.to_date("o_orderdate").alias(S.ORDER_DATE),
        F.col("o_orderdate").alias(S.ORDER_TS),
        F.col("l_partkey").alias(S.PRODUCT_ID),
        F.col("l_quantity").cast("long").alias(S.QUANTITY),
        unit_price_from_total("l_extendedprice", "l_quantity").alias(S.UNIT_PRICE),
        F.col("l_extendedprice").alias(S.REVENUE),
        F.col("o_orderpriority").alias(S.PAYMENT_METHOD),
    )


def events_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events_as_transactions(table(spark, sf_dir, "events"))


def lines_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines_as_transactions(table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders"))
