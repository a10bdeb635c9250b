"""Data quality and audit: not-null column tests, run previews, rejected-row report.

Every report is one aggregation pass per table (conditional counts), then an ``unpivot`` into
rows: no per-column jobs, nothing collected.  ``BatchWatch`` needs no pass: it takes the same figures
of an incremental batch from the job that writes it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from daybook import schemas as S
from daybook.functions.dates import date_lit, parse_date, partition_date
from daybook.functions.money import MONEY_SCALE, finite, to_units

# The declared not_null column tests per model.  ``running_revenue`` is also declared
# on agg_daily_revenue_v2, which never produces that column; that check is left out.
_DAILY = (S.ORDER_DATE, S.DAILY_REVENUE, S.DAILY_ORDERS)
_RUNNING = (S.ORDER_DATE, S.DAILY_REVENUE, S.DAILY_ORDERS, S.DAILY_BUYERS, S.RUNNING_REVENUE)
NOT_NULL_CHECKS: dict[str, tuple[str, ...]] = {
    "stg_orders_v1": (S.ORDER_ID, S.BUYER_ID, S.ORDER_DATE, S.ORDER_TS, S.PRODUCT_ID, S.QUANTITY,
                      S.UNIT_PRICE, S.REVENUE, S.PAYMENT_METHOD),
    "stg_orders_v2": (S.ORDER_ID, S.BUYER_ID, S.ORDER_DATE, S.ORDER_TS, S.PRODUCT_ID, S.QUANTITY,
                      S.UNIT_PRICE, S.REVENUE, S.PAYMENT_METHOD),
    "agg_daily_revenue_v1": _DAILY,
    "agg_daily_revenue_v2": _DAILY,
    "agg_daily_revenue_v3": _RUNNING,
    "agg_daily_revenue_py_v1": _DAILY,
    "agg_daily_revenue_py_v2": _DAILY,
    "agg_daily_revenue_py_v3": _RUNNING,
}


def null_counts(df: DataFrame, model: str, columns: Sequence[str]) -> DataFrame:
    """One pass: NULL count per declared column.  A declared column the table lacks fails its
    check (NULL count)."""
    counts = [(F.count_if(F.col(c).isNull()) if c in df.columns else F.lit(None)).cast("long").alias(c)
              for c in columns]
    long = df.agg(*counts).unpivot([], list(columns), "column_name", "null_count")
    return long.select(
        F.lit(model).alias("model"),
        F.col("column_name"),
        F.col("null_count"),
        F.coalesce(F.col("null_count") == 0, F.lit(False)).alias("passed"),
    )


def not_null_report(tables: Mapping[str, DataFrame], checks: Mapping[str, Sequence[str]] = NOT_NULL_CHECKS) -> DataFrame:
    """(model, column_name, null_count, passed) for every declared check of the given tables."""
    parts = [null_counts(df, name, checks[name]) for name, df in tables.items() if name in checks]
    if not parts:
        raise ValueError("no table with declared checks given")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _valid() -> Column:
    return F.col(S.ORDER_TS).isNotNull() & F.col(S.REVENUE).isNotNull() & (F.col(S.REVENUE) > 0)


def _valid_source_rows(source: DataFrame) -> DataFrame:
    return source.filter(_valid())


def run_previews(rows: DataFrame, day: Column, requests: Sequence[tuple[str, str, object]]) -> DataFrame:
    """(model, mode, from_date, row_count, day_count) of several runs that read the same rows, in one
    pass: ``requests`` are (model, mode, from_date or None)."""
    aggs, structs = [], []
    for i, (model, mode, from_date) in enumerate(requests):
        d = parse_date(from_date) if from_date is not None else None
        if d is None:
            aggs += [F.count(F.lit(1)).alias(f"r{i}"), F.lit(None).cast("long").alias(f"d{i}")]
        else:
            hit = day >= date_lit(d)
            aggs += [F.count_if(hit).alias(f"r{i}"), F.count_distinct(F.when(hit, day)).alias(f"d{i}")]
        structs.append(F.struct(F.lit(model).alias("model"), F.lit(mode).alias("mode"), F.lit(d).cast("date").alias("from_date"),
                                F.col(f"r{i}").alias("row_count"), F.col(f"d{i}").alias("day_count")))
    return rows.agg(*aggs).select(F.inline(F.array(*structs)))


def preview_source(source: DataFrame, requests: Sequence[tuple[str, str, object]]) -> DataFrame:
    """Rows (and days, when windowed) about to be staged.  Counts only valid rows (timestamp and
    revenue present, revenue > 0), as the reference's preview does, although staging keeps rows with
    non-positive revenue: the preview can undercount what is processed."""
    return run_previews(_valid_source_rows(source), F.to_date(F.col(S.ORDER_TS)), requests)


def preview_staging(staged: DataFrame, requests: Sequence[tuple[str, str, object]]) -> DataFrame:
    """Rows (and days, when windowed) of the staging table that metric models are about to read."""
    return run_previews(staged, F.col(S.ORDER_DATE), requests)


def run_mode(incremental_model: bool, target_exists: bool, full_refresh: bool) -> str:
    if incremental_model and not full_refresh:
        return "incremental" if target_exists else "first_run"
    return "full_refresh"


# Rejection reasons; the first three are the export's validity filter.
REJECT_REASONS = ("null_order_date", "null_revenue", "non_positive_revenue")


def reject_conditions(columns: Sequence[str]) -> dict[str, Column]:
    """Reason -> condition, for a source with these columns (see ``rejected_rows``)."""
    rev = F.col(S.REVENUE)
    day = F.col(S.ORDER_DATE) if S.ORDER_DATE in columns else F.to_date(F.col(S.ORDER_TS))
    conds = {
        "null_order_date": day.isNull(),
        "null_revenue": rev.isNull(),
        "non_positive_revenue": rev <= 0,
        "nan_revenue": rev.isNotNull() & finite(rev).isNull(),
        "sub_cent_revenue": to_units(S.REVENUE) != F.rint(finite(rev) * 100).cast("long") * (MONEY_SCALE // 100),
        "revenue_mismatch": to_units(S.UNIT_PRICE) * F.col(S.QUANTITY) != to_units(S.REVENUE),
    }
    if all(k in columns for k in S.PARTITION_KEYS):
        conds["partition_mismatch"] = F.col(S.ORDER_TS).isNotNull() & ~F.coalesce(
            partition_date() == F.to_date(F.col(S.ORDER_TS)), F.lit(False))
    conds["export_rejected_total"] = day.isNull() | rev.isNull() | (rev <= 0)
    return {reason: F.coalesce(c, F.lit(False)) for reason, c in conds.items()}


_BY_EXPORT = [*REJECT_REASONS, "export_rejected_total"]


def rejected_rows(transactions: DataFrame) -> DataFrame:
    """(reason, row_count, rejected_by_export) in one pass.  Beyond the export filter it reports
    rows whose revenue differs from round(quantity * unit_price, 2), is no number (NaN, infinite:
    left out of sums) or has parts of a cent and, for a Hive-partitioned source, rows stored under a
    partition other than their timestamp's day (which a day-aligned window read would miss)."""
    conds = reject_conditions(transactions.columns)
    wide = transactions.agg(*[F.count_if(c).alias(k) for k, c in conds.items()])
    long = wide.unpivot([], list(conds), "reason", "row_count")
    return long.select("reason", F.col("row_count").cast("long").alias("row_count"),
                       F.col("reason").isin(_BY_EXPORT).alias("rejected_by_export"))


class BatchWatch:
    """Figures of the source rows of an incremental staging batch, observed while the batch is written:
    the preview, the declared not-null tests and the rejected rows, without a scan of their own.

    ``rows`` takes the place of the source rows below the staging projection; the figures are there once a
    job over it is done.  They are exact if the rows are written by the stage that observes them, as a batch
    is (no shuffle follows the projection): a task that is run again then counts once.  Days are counted
    with a bitmap of days since the window's start, 4 KB a task; should rows be dated beyond its span,
    ``preview`` counts the days in a pass of its own."""

    SPAN = 32_767  # days of the bitmap

    def __init__(self, window_rows: DataFrame, model: str, from_date):
        self.window, self.model, self.from_date = window_rows, model, parse_date(from_date)
        self.observation = Observation()
        self.reasons = reject_conditions(window_rows.columns)
        self.columns = NOT_NULL_CHECKS[model]
        day = F.to_date(F.col(S.ORDER_TS))
        staged = {S.ORDER_DATE: day}
        since = F.datediff(day, date_lit(self.from_date))
        # A null position sets no bit.
        days = F.bitmap_construct_agg(F.when(_valid() & since.between(0, self.SPAN), since.cast("long")))
        self.rows = window_rows.observe(
            self.observation,
            F.count(F.lit(1)).alias("rows"),
            F.count_if(_valid()).alias("valid"),
            days.alias("days"),
            F.count_if(_valid() & (since > self.SPAN)).alias("far"),
            *[F.count_if(staged.get(c, F.col(c)).isNull()).alias(f"null {c}") for c in self.columns],
            *[F.count_if(c).alias(f"rejected {r}") for r, c in self.reasons.items()])

    @property
    def figures(self) -> dict:
        return self.observation.get

    def _count(self, name: str) -> int:
        return int(self.figures.get(name) or 0)

    @property
    def misplaced(self) -> int | None:
        """Rows outside the folder of their day; None for a source without day folders."""
        return self._count("rejected partition_mismatch") if "partition_mismatch" in self.reasons else None

    def preview(self) -> DataFrame:
        """What ``preview_source`` gives for the run."""
        if self._count("far"):
            return preview_source(self.window, [(self.model, "incremental", self.from_date)])
        days = sum(byte.bit_count() for byte in self.figures.get("days") or b"")
        return self.window.sparkSession.createDataFrame([(self.model, "incremental", self.from_date, self._count("valid"), days)],
                                          "model string, mode string, from_date date, row_count long, day_count long")

    def not_null(self) -> DataFrame:
        """What ``null_counts`` gives for the batch."""
        rows = [(self.model, c, self._count(f"null {c}"), self._count(f"null {c}") == 0) for c in self.columns]
        return self.window.sparkSession.createDataFrame(rows, "model string, column_name string, null_count long, passed boolean")

    def rejected(self) -> DataFrame:
        """What ``rejected_rows`` gives for the window's source rows."""
        rows = [(r, self._count(f"rejected {r}"), r in _BY_EXPORT) for r in self.reasons]
        return self.window.sparkSession.createDataFrame(rows, "reason string, row_count long, rejected_by_export boolean")
