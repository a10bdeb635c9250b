"""Daily metrics kept up by merging batches of new rows: a late row costs what it adds, not its day.

Distinct counts can't be added, but distinct *keys* can be merged.  The state is one day-partitioned table
with, for every day, its distinct (kind, key) pairs, kinds being orders and buyers, and a ``sum`` row per
batch: the batch's revenue in exact units and how many pairs it was the first to bring.  A batch's pairs
meet the stored pairs of the days and key buckets it touches; those that are new are appended with the
batch's ``sum`` rows by one write.  A day's revenue, orders and buyers are the sums of its ``sum`` rows.

Scale: an update reads the batch and, of the touched days, the pairs of the touched buckets (files are
sorted by kind, bucket and key, and the bucket filter reaches the scan); order lines are never read
again.  Pairs are merged by key, hash-partitioned on (day, kind, key), so a day that holds a third of all rows
is spread.  Metrics read only ``sum`` rows: one per day and batch.  To the driver come days and at most
``BUCKETS`` bucket numbers.

Defined cases: an update is all or nothing (the table's day list switches once), and one whose ``batch``
name the state holds already changes nothing, so a stopped run is repeated safely.  Rows are only ever
added: a source that restates or deletes rows needs the day rebuilt.  Null keys count as none, null and
non-finite amounts add nothing, rows without a day have a day of their own.  Equal rows add their revenue each.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook import schemas as S
from daybook.functions.money import from_parts, from_units, unit_parts
from daybook.sources.fs import delete_path
from daybook.sources.warehouse import Warehouse

STATE = "distinct_state"
BUCKETS = 256
ORDER, BUYER, SUM = "order", "buyer", "sum"
PAIR = ["kind", "bucket", "key"]


class DistinctState:
    """The state below ``warehouse_root``."""

    def __init__(self, spark: SparkSession, warehouse_root: str):
        self.spark = spark
        self.root = f"{warehouse_root.rstrip('/')}/__state__"
        self.table = Warehouse(spark, self.root)

    def sums(self) -> DataFrame:
        return self.table.read(STATE).filter(F.col("kind") == SUM)

    def update(self, batch: str, staged: DataFrame) -> list:
        """Merge the rows of a batch; the days it touched (none if it was merged before)."""
        if self.table.exists(STATE) and not self.sums().filter(F.col("batch") == batch).isEmpty():
            return []
        held = f"{self.root}/__batch__{uuid.uuid4().hex[:12]}"

        def written(df: DataFrame, name: str) -> DataFrame:
            df.write.parquet(f"{held}/{name}")
            return self.spark.read.schema(df.schema).parquet(f"{held}/{name}")
        try:
            high, low = unit_parts(S.REVENUE)
            totals = written(staged.groupBy(S.ORDER_DATE).agg(F.sum(high).alias("high"), F.sum(low).alias("low")), "totals")
            days = [r[0] for r in totals.select(S.ORDER_DATE).collect()]  # one row per day
            if not days:
                return []
            keys = F.array(*[F.struct(F.lit(kind).alias("kind"), F.col(c).cast("string").alias("key"))
                             for kind, c in ((ORDER, S.ORDER_ID), (BUYER, S.BUYER_ID))])
            pairs = (staged.select(S.ORDER_DATE, F.inline(keys)).filter(F.col("key").isNotNull()).distinct()
                     .withColumn("bucket", F.pmod(F.xxhash64("key"), F.lit(BUCKETS)).cast("int")))
            if self.table.exists(STATE):
                pairs = self._unknown(written(pairs, "pairs"), days)
            fresh = written(pairs, "fresh")
            counts = fresh.groupBy(S.ORDER_DATE).agg(F.count_if(F.col("kind") == ORDER).alias("orders"),
                                                     F.count_if(F.col("kind") == BUYER).alias("buyers"))
            t, c = totals.alias("t"), counts.alias("c")
            sums = t.join(c, F.col(f"t.{S.ORDER_DATE}").eqNullSafe(F.col(f"c.{S.ORDER_DATE}")), "left").select(
                "t.*", *[F.coalesce(f"c.{n}", F.lit(0)).cast("long").alias(n) for n in ("orders", "buyers")],
                F.lit(SUM).alias("kind"), F.lit(batch).alias("batch"))
            rows = fresh.unionByName(sums, allowMissingColumns=True)
            self.table.append_days(STATE, rows, days, sort_by=tuple(PAIR))
            return days
        finally:
            delete_path(self.spark, held)

    def _unknown(self, pairs: DataFrame, days: list) -> DataFrame:
        """The pairs that the state doesn't hold."""
        buckets = sorted(r[0] for r in pairs.select("bucket").distinct().collect())
        known = self.table.read(STATE, days=days).filter(F.col("kind").isin(ORDER, BUYER) & F.col("bucket").isin(buckets))
        p, k = pairs.alias("p"), known.alias("k")
        same = F.col(f"p.{S.ORDER_DATE}").eqNullSafe(F.col(f"k.{S.ORDER_DATE}"))
        for c in PAIR:
            same &= F.col(f"p.{c}") == F.col(f"k.{c}")
        return p.join(k, same, "left_anti")

    def daily_metrics(self) -> DataFrame:
        """(order_date, daily_revenue, daily_orders, daily_buyers) of all rows merged so far."""
        return self.sums().groupBy(S.ORDER_DATE).agg(
            from_units(from_parts(F.sum("high"), F.sum("low"))).alias(S.DAILY_REVENUE),
            F.sum("orders").alias(S.DAILY_ORDERS), F.sum("buyers").alias(S.DAILY_BUYERS))
