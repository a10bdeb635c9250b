"""Summary reports over the metric and staging tables (dashboard and dataset profile queries).

Statistics that are not exact in floating point (means, medians, percentiles, deviations) are
rounded to 6 decimals so that results compare across engines.  Percentiles are the exact,
interpolated ``percentile`` (not ``approx_percentile`` and not ``DataFrame.summary()``, whose
percentiles are approximate); they run over the metric table, one row per day.  ``line_statistics``
describes order lines, whose percentiles are found by counting (``operators.selection``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook import schemas as S
from daybook.functions.money import from_parts, from_units, money_sum, round_stat, unit_parts, wide_units
from daybook.operators.selection import QUARTILES, exact_percentiles, measure_values

MEASURES = (S.DAILY_REVENUE, S.DAILY_ORDERS, S.DAILY_BUYERS)
LINE_MEASURES = (S.QUANTITY, S.UNIT_PRICE, S.REVENUE)


def metric_overview(metric: DataFrame) -> DataFrame:
    """Record count, date range, total revenue and total orders of a metric table."""
    return metric.agg(
        F.count(F.lit(1)).alias("record_count"),
        F.min(S.ORDER_DATE).alias("first_date"),
        F.max(S.ORDER_DATE).alias("last_date"),
        from_units(F.sum(wide_units(S.DAILY_REVENUE))).alias("total_revenue"),
        F.sum(S.DAILY_ORDERS).cast("long").alias("total_orders"),
    )


def metric_statistics(metric: DataFrame, measures=MEASURES) -> DataFrame:
    """Mean, median, max and min of each measure, one row."""
    aggs = []
    for m in measures:
        aggs += [
            round_stat(F.avg(m)).alias(f"mean_{m}"),
            round_stat(F.median(m)).alias(f"median_{m}"),
            F.max(m).alias(f"max_{m}"),
            F.min(m).alias(f"min_{m}"),
        ]
    return metric.agg(*aggs)


def metric_describe(metric: DataFrame, measures=MEASURES) -> DataFrame:
    """count, mean, sample std, min, 25/50/75% (exact, interpolated), max; one row per measure."""
    long = metric.select(*[F.col(m).cast("double").alias(m) for m in measures]).unpivot(
        [], list(measures), "measure", "value")
    v = F.col("value")
    return long.groupBy("measure").agg(
        F.count(v).alias("count"),
        round_stat(F.avg(v)).alias("mean"),
        round_stat(F.stddev_samp(v)).alias("std"),
        F.min(v).alias("min"),
        round_stat(F.percentile(v, 0.25)).alias("p25"),
        round_stat(F.percentile(v, 0.5)).alias("p50"),
        round_stat(F.percentile(v, 0.75)).alias("p75"),
        F.max(v).alias("max"),
    )


def line_statistics(staged: DataFrame, measures=LINE_MEASURES) -> DataFrame:
    """``metric_describe`` for order lines, of any number: one row per measure, as many scans as the
    slowest percentile takes rounds (seven at most), no task with more than counts."""
    values = staged.select(*measure_values(measures))
    aggs = []
    for i, m in enumerate(measures):
        aggs += [F.count(m).alias(f"n_{i}"), F.min(m).alias(f"low_{i}"), F.max(m).alias(f"high_{i}"),
                 round_stat(money_sum(m) / F.count(m)).alias(f"mean_{i}"), round_stat(F.stddev_samp(m)).alias(f"std_{i}")]
    row = values.agg(*aggs).first()
    extents = {m: (row[f"n_{i}"], row[f"low_{i}"], row[f"high_{i}"]) for i, m in enumerate(measures)}
    percentiles = exact_percentiles(staged, measures, QUARTILES, extents)
    described = [(m, row[f"n_{i}"], row[f"mean_{i}"], row[f"std_{i}"], row[f"low_{i}"], *percentiles[m], row[f"high_{i}"])
                 for i, m in enumerate(measures)]
    shape = "measure string, count long, mean double, std double, min double, p25 double, p50 double, p75 double, max double"
    return staged.sparkSession.createDataFrame(described, shape).withColumns(
        {p: round_stat(p) for p in ("p25", "p50", "p75")})


def dataset_profile(staged: DataFrame) -> DataFrame:
    """Row count, distinct orders / buyers / products and total revenue of the line items."""
    return staged.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_distinct(S.ORDER_ID).alias("total_orders"),
        F.count_distinct(S.BUYER_ID).alias("total_buyers"),
        F.count_distinct(S.PRODUCT_ID).alias("total_products"),
        money_sum(S.REVENUE).alias("total_revenue"),
    )


def avg_order_value(staged: DataFrame) -> DataFrame:
    """Mean over orders of the order's revenue: a two-level aggregate (per order, then global).
    The per-order step pre-aggregates map-side, so a very large order costs one row per task."""
    high, low = unit_parts(S.REVENUE)
    per_order = staged.groupBy(S.ORDER_ID).agg(F.sum(high).alias("high"), F.sum(low).alias("low"))
    return per_order.agg(
        F.count(F.lit(1)).alias("order_count"),
        round_stat(from_units(from_parts(F.sum("high"), F.sum("low"))) / F.count("high")).alias("avg_order_value"),
    )


def rows_per_day(staged: DataFrame) -> DataFrame:
    return staged.groupBy(S.ORDER_DATE).agg(F.count(F.lit(1)).alias("row_count"))


def latest_days(metric: DataFrame, n: int = 30) -> DataFrame:
    """Top-k by date (``ORDER BY order_date DESC LIMIT n``): a TakeOrderedAndProject, each task keeps
    only its n newest rows."""
    return metric.orderBy(F.col(S.ORDER_DATE).desc()).limit(n)


def first_days(metric: DataFrame, n: int = 10) -> DataFrame:
    return metric.orderBy(F.col(S.ORDER_DATE).asc()).limit(n)


def trend_series(metric: DataFrame) -> DataFrame:
    """The ordered daily series (presentation order only)."""
    return metric.select(*[c for c in S.RUNNING_COLUMNS if c in metric.columns]).orderBy(S.ORDER_DATE)


def running_series(metric: DataFrame) -> DataFrame:
    return metric.select(S.ORDER_DATE, S.RUNNING_REVENUE).orderBy(S.ORDER_DATE)


def storage_footprint(spark: SparkSession, path: str) -> DataFrame:
    """Files and megabytes of the Parquet files under ``path``: a distributed listing
    (``binaryFile`` with only path and length selected never reads file content)."""
    return _files(spark, path).agg(*_footprint())


def partition_footprint(spark: SparkSession, path: str) -> DataFrame:
    """Files and megabytes per ``year/month/date`` folder."""
    keys = [F.regexp_extract("path", f"/{k}=([0-9]+)/", 1).cast("int").alias(k) for k in S.PARTITION_KEYS]
    return _files(spark, path).groupBy(*keys).agg(*_footprint())


def _footprint() -> list:
    return [F.count(F.lit(1)).alias("file_count"), F.round(F.sum("length") / (1024.0 * 1024.0), 6).alias("size_mb")]


def _files(spark: SparkSession, path: str) -> DataFrame:
    return (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
            .option("pathGlobFilter", "*.parquet").load(path).select("path", "length"))
