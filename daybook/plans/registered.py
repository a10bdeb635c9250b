"""Registered queries: one per operator or result shape, each ``(spark, sf_dir) -> DataFrame``.

They run over the whole test tables through two adapters (``sources.adapters``):
E = ``events`` (one line per order) and L = ``lineitem`` joined to ``orders`` (multi-line orders).
Most queries express the stored state an incremental run starts from as the DataFrame an earlier
run would have written, and the merge as a DataFrame (what the table holds after the write).  The
``stored_run_*`` queries run the real thing: a first run and a 14-day incremental run of the stored
models, with writes into a scratch warehouse under ``spark.checkpoint.dir``, returning the table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook import schemas as S
from daybook.functions.dates import date_lit, default_from_date, parse_date
from daybook.operators import arrow, export, metrics, quality, reports, staging, upsert
from daybook.plans.runs import MODELS, Project, not_null_checks
from daybook.session import scratch_path
from daybook.sources import adapters as A
from daybook.sources.distinct_state import DistinctState
from daybook.sources.ledger import SourceLedger
from daybook.sources.transactions import read_transactions
from daybook.sources.warehouse import Warehouse

EF = A.EVENTS_FROM_DATE  # window start for E
LF = A.LINES_FROM_DATE   # window start for L
# Fixed values of the fixtures: the earlier run's cut for the staging upsert on L, the day removed
# to open a calendar gap on E, and the late-arrival rule on E (held back from the first run).
L_EARLIER_RUN_CUT = "2001-07-26"
E_GAP_DAY = "2024-01-16"


def late_rows():
    """Rows of E that arrive late: held back from the first run (every tenth event id)."""
    return (F.col(S.ORDER_ID) % 10) == 0


def _before(df: DataFrame, day) -> DataFrame:
    return df.filter(F.col(S.ORDER_DATE) < date_lit(day))


# --- staging -------------------------------------------------------------------------------------

def stg_full(spark: SparkSession, d: str) -> DataFrame:
    return staging.stage_v1(A.lines_source(spark, d))


def stg_incremental_window(spark: SparkSession, d: str) -> DataFrame:
    return staging.stage_v2(A.lines_source(spark, d), from_date=LF)


def stg_delete_insert(spark: SparkSession, d: str) -> DataFrame:
    """Staging after two runs: the first saw days before the cut, the second re-stages from LF.
    Orders in [LF, cut) are in both; all their lines are replaced, none duplicated."""
    src = A.lines_source(spark, d)
    target = staging.stage_v2(_before(src, L_EARLIER_RUN_CUT))
    batch = staging.stage_v2(src, from_date=LF)
    return upsert.delete_insert(target, batch, S.ORDER_ID)


# --- daily metrics -------------------------------------------------------------------------------

def daily_revenue_full(spark, d):
    return metrics.daily_revenue(staging.stage_v1(A.lines_source(spark, d)))


def daily_revenue_full_events(spark, d):
    return metrics.daily_revenue(staging.stage_v1(A.events_source(spark, d)))


def daily_revenue_window(spark, d):
    return metrics.daily_revenue(staging.stage_v2(A.lines_source(spark, d), LF), LF)


def daily_revenue_window_events(spark, d):
    return metrics.daily_revenue(staging.stage_v2(A.events_source(spark, d), EF), EF)


def _events_first_run_without_late(spark, d):
    src = A.events_source(spark, d)
    return src, src.filter(~late_rows())


def daily_delete_insert(spark, d):
    """v2 metric table after a first run without the late rows and an incremental run from EF:
    window days are replaced by complete values, older days keep the first run's values."""
    src, early = _events_first_run_without_late(spark, d)
    target = metrics.daily_revenue(staging.stage_v2(early))
    batch = metrics.daily_revenue(staging.stage_v2(src, EF), EF)
    return upsert.replace_days(target, batch)


def daily_running_full(spark, d):
    return metrics.daily_running_full(staging.stage_v2(A.lines_source(spark, d)))


def daily_running_full_events(spark, d):
    return metrics.daily_running_full(staging.stage_v2(A.events_source(spark, d)))


def _incremental(src: DataFrame, from_date, seed: str) -> DataFrame:
    staged = staging.stage_v2(src)
    target = metrics.daily_running_full(_before(staged, from_date))
    return metrics.daily_running_incremental(staging.stage_v2(src, from_date), target, from_date, seed)


def daily_running_incremental(spark, d):
    return _incremental(A.lines_source(spark, d), LF, "exact")


def daily_running_incremental_events(spark, d):
    return _incremental(A.events_source(spark, d), EF, "exact")


def _gap_source(spark, d):
    src = A.events_source(spark, d)
    return src.filter(F.col(S.ORDER_DATE) != date_lit(E_GAP_DAY))


def seed_latest_gap(spark, d):
    return _incremental(_gap_source(spark, d), EF, "latest")


def seed_exact_gap(spark, d):
    return _incremental(_gap_source(spark, d), EF, "exact")


def _late_runs(spark, d):
    """First run over E without the late rows, then the late rows arrive and an incremental run
    from EF re-stages the window (delete+insert by order_id) and re-derives its days."""
    src, early = _events_first_run_without_late(spark, d)
    staged_1 = staging.stage_v2(early)
    metric_1 = metrics.daily_running_full(staged_1)
    batch = staging.stage_v2(src, EF)
    staged_2 = upsert.delete_insert(staged_1, batch, S.ORDER_ID)
    window = metrics.daily_running_incremental(staged_2, metric_1, EF, "exact")
    metric_2 = upsert.replace_days(metric_1, window)
    return staged_2, metric_2


def late_in_window(spark, d):
    return _late_runs(spark, d)[1]


def late_out_of_window(spark, d):
    return _late_runs(spark, d)[0]


# --- Arrow variants (the Python models) ----------------------------------------------------------

def daily_arrow_batches(spark, d):
    return metrics.running_total(arrow.daily_metrics_batches(staging.stage_v2(A.events_source(spark, d))))


def daily_arrow_batches_lines(spark, d):
    return metrics.running_total(arrow.daily_metrics_batches(staging.stage_v2(A.lines_source(spark, d))))


def daily_arrow_grouped(spark, d):
    return metrics.running_total(arrow.daily_metrics_grouped(staging.stage_v2(A.events_source(spark, d))))


def daily_arrow_grouped_lines(spark, d):
    return metrics.running_total(arrow.daily_metrics_grouped(staging.stage_v2(A.lines_source(spark, d))))


def daily_arrow_v1_lines(spark, d):
    return arrow.daily_metrics_batches(staging.stage_v1(A.lines_source(spark, d)), with_buyers=False)


def daily_arrow_v2_window(spark, d):
    return arrow.daily_metrics_batches(staging.stage_v2(A.lines_source(spark, d), LF), LF, with_buyers=False)


def daily_arrow_incremental(spark, d):
    src = A.events_source(spark, d)
    staged = staging.stage_v2(src)
    target = metrics.running_total(arrow.daily_metrics_batches(_before(staged, EF)))
    new = arrow.daily_metrics_batches(staging.stage_v2(src, EF), EF)
    return metrics.seeded_running_total(new, metrics.select_seed(target, EF, "exact"))


# --- unions and schema evolution -----------------------------------------------------------------

def union_by_name(spark, d):
    staged = staging.stage_v2(A.events_source(spark, d))
    target = metrics.daily_running_full(_before(staged, EF))
    return metrics.continuity_view(staging.stage_v2(A.events_source(spark, d), EF), target, EF, "exact")


def schema_append(spark, d):
    """A v2-shaped table receives a batch with one more column (daily_buyers): replaced days carry
    it, old rows get NULL."""
    staged = staging.stage_v2(A.events_source(spark, d))
    target = metrics.daily_revenue(staged)
    batch = metrics.daily_metrics(staged, EF)
    return upsert.replace_days(target, batch)


def stored_schema_append(spark, d):
    """The same on a stored day-partitioned table, whose day list keeps the schema."""
    staged = staging.stage_v2(A.events_source(spark, d))
    wh = Warehouse(spark, scratch_path(spark, "schema-wh"))
    wh.write_full("agg", metrics.daily_revenue(staged), S.ORDER_DATE)
    wh.replace_days("agg", metrics.daily_metrics(staged, EF), S.ORDER_DATE)
    return wh.read("agg")


# --- reports -------------------------------------------------------------------------------------

def _lines_metric(spark, d):
    return metrics.daily_running_full(staging.stage_v2(A.lines_source(spark, d)))


def latest_30_days(spark, d):
    return reports.latest_days(_lines_metric(spark, d), 30)


def head_10(spark, d):
    return reports.first_days(_lines_metric(spark, d), 10)


def limit_100(spark, d):
    return reports.first_days(_lines_metric(spark, d), 100)


def trend_series(spark, d):
    return reports.trend_series(_lines_metric(spark, d))


def running_series(spark, d):
    return reports.running_series(_lines_metric(spark, d))


def metric_overview(spark, d):
    return reports.metric_overview(_lines_metric(spark, d))


def metric_statistics(spark, d):
    return reports.metric_statistics(_lines_metric(spark, d))


def metric_describe(spark, d):
    return reports.metric_describe(_lines_metric(spark, d))


def line_statistics(spark, d):
    """Count, mean, deviation, extremes and exact quartiles of every line of L."""
    return reports.line_statistics(staging.stage_v1(A.lines_source(spark, d)))


def dataset_profile(spark, d):
    return reports.dataset_profile(staging.stage_v1(A.lines_source(spark, d)))


def avg_order_value(spark, d):
    return reports.avg_order_value(staging.stage_v1(A.lines_source(spark, d)))


def rows_per_day(spark, d):
    return reports.rows_per_day(staging.stage_v1(A.lines_source(spark, d)))


# --- quality and audit ---------------------------------------------------------------------------

def run_preview_source(spark, d):
    """Previews of an incremental, a first and a full run over the source, in one pass."""
    return quality.preview_source(A.lines_source(spark, d), [
        ("stg_orders_v2", quality.run_mode(True, True, False), LF),
        ("stg_orders_v2", quality.run_mode(True, False, False), None),
        ("stg_orders_v1", quality.run_mode(False, True, False), None)])


def run_preview_staging(spark, d):
    src = A.lines_source(spark, d)
    return quality.preview_staging(staging.stage_v2(src), [
        ("agg_daily_revenue_v3", quality.run_mode(True, True, False), LF),
        ("agg_daily_revenue_v2", quality.run_mode(True, True, True), None),
    ]).unionByName(quality.preview_staging(staging.stage_v1(src), [
        ("agg_daily_revenue_v1", quality.run_mode(False, True, False), None)]))


def model_tables(spark, d) -> dict[str, DataFrame]:
    """All eight models built from L as full runs, each a stored table: the staging tables are read
    back by the metric models, so the source's join runs once per staging model."""
    def stored(name: str, df: DataFrame) -> DataFrame:
        path = scratch_path(spark, name)
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    src = A.lines_source(spark, d)
    stg1, stg2 = stored("stg_orders_v1", staging.stage_v1(src)), stored("stg_orders_v2", staging.stage_v2(src))
    return {
        "stg_orders_v1": stg1,
        "stg_orders_v2": stg2,
        "agg_daily_revenue_v1": metrics.daily_revenue(stg1),
        "agg_daily_revenue_v2": metrics.daily_revenue(stg2),
        "agg_daily_revenue_v3": metrics.daily_running_full(stg2),
        "agg_daily_revenue_py_v1": arrow.daily_metrics_batches(stg1, with_buyers=False),
        "agg_daily_revenue_py_v2": arrow.daily_metrics_batches(stg2, with_buyers=False),
        "agg_daily_revenue_py_v3": metrics.running_total(arrow.daily_metrics_batches(stg2)),
    }


def not_null_report(spark, d):
    return quality.not_null_report(model_tables(spark, d))


def rejected_rows(spark, d):
    return quality.rejected_rows(A.lines_source(spark, d))


def rejected_rows_events(spark, d):
    return quality.rejected_rows(A.events_source(spark, d))


# --- export and partitioned scan -----------------------------------------------------------------

def _exported_events(spark, d) -> str:
    path = scratch_path(spark, "export")
    export.partitioned_export(A.events_source(spark, d), path)
    return path


def export_partitions(spark, d):
    """Rows per partition of the written export."""
    return export.export_partition_counts(spark.read.parquet(_exported_events(spark, d)))


def export_read_back(spark, d):
    """Every row of the written export, with its partition keys."""
    return spark.read.parquet(_exported_events(spark, d))


def export_rerun(spark, d):
    """A second export of the window's days, with changed revenue: it replaces the partitions it
    touches and leaves the others."""
    path = _exported_events(spark, d)
    again = A.events_source(spark, d).filter(F.col(S.ORDER_DATE) >= date_lit(EF))
    changed = F.when(F.col(S.ORDER_ID) % 3 == 0, F.col(S.REVENUE) * 2).otherwise(F.col(S.REVENUE))
    export.partitioned_export(again.withColumn(S.REVENUE, changed), path)
    return spark.read.parquet(path)


def partition_pruned_scan(spark, d):
    """Export E in the Hive layout, then read the window back as a source declared day-aligned: the
    partition-date bound prunes directories, the timestamp bound is pushed into the other files."""
    path = _exported_events(spark, d)
    return staging.stage_v2(read_transactions(spark, path, from_date=EF, day_aligned=True), from_date=EF)


def _unaligned_events(spark, d) -> str:
    """A source whose rows lie in other days' folders (every third order a month early) or in NULL
    folders (every fifth)."""
    frame = export.export_frame(A.events_source(spark, d))
    early = F.add_months(S.ORDER_DATE, -1)
    folder = F.when(F.col(S.ORDER_ID) % 5 == 0, F.lit(None).cast("date")).when(F.col(S.ORDER_ID) % 3 == 0, early).otherwise(
        F.col(S.ORDER_DATE))
    placed = frame.withColumns({"year": F.year(folder), "month": F.month(folder), "date": F.dayofmonth(folder)})
    path = scratch_path(spark, "unaligned")
    placed.write.partitionBy(*S.PARTITION_KEYS).parquet(path)
    return path


def unaligned_partition_scan(spark, d):
    """The window read of a source whose rows lie in other folders: none may be missed."""
    return staging.stage_v2(read_transactions(spark, _unaligned_events(spark, d), from_date=EF), from_date=EF)


def misplaced_row_ledger(spark, d):
    """Per day, the rows of that source outside their day's folder, and those that a window read pruned by
    folder would lose: from the ledger, so also in files that such a read never opens."""
    ledger = SourceLedger(spark, _unaligned_events(spark, d), scratch_path(spark, "placed"))
    ledger.refresh()
    return ledger.misplaced(EF)


def _arrival_files(df: DataFrame, path: str) -> None:
    """Files as they arrive: folders tell the load, not the day; a file holds a range of time."""
    (df.repartitionByRange(12, S.ORDER_TS).sortWithinPartitions(S.ORDER_TS).write.mode("append").parquet(path))


def zone_mapped_scan(spark, d):
    """The window read of a source whose folders say nothing of the day: the ledger's zone map picks the
    files of three loads that hold rows of the window."""
    rows, path = A.events_source(spark, d), scratch_path(spark, "loads")
    for load in range(3):
        _arrival_files(rows.filter(F.col(S.ORDER_ID) % 3 == load), f"{path}/load={load}")
    ledger = SourceLedger(spark, path, scratch_path(spark, "zones"))
    ledger.refresh()
    return staging.stage_v2(ledger.read_window(EF), from_date=EF)


def late_row_ledger(spark, d):
    """The late rows arrive as a load of their own; a window run takes those of its window and the ledger
    names the days before it that lack rows since."""
    src, early = _events_first_run_without_late(spark, d)
    path, root = scratch_path(spark, "loads"), scratch_path(spark, "ledger-wh")
    project = Project(spark, None, root, ledger=SourceLedger(spark, path, root))
    _arrival_files(early, f"{path}/load=1")
    project.run_model("stg_orders_v2")
    _arrival_files(src.filter(late_rows()), f"{path}/load=2")
    return project.run_model("stg_orders_v2", from_date=EF).late_days


def daily_distinct_state(spark, d):
    """E in three batches, so that a buyer's orders of a day are spread over all of them: the metric from
    the merged state, order lines read once."""
    staged = staging.stage_v2(A.events_source(spark, d))
    state = DistinctState(spark, scratch_path(spark, "state-wh"))
    for batch in range(3):
        state.update(f"load-{batch}", staged.filter(F.col(S.ORDER_ID) % 3 == batch))
    return metrics.running_total(state.daily_metrics())


def exported_footprint(spark, d):
    """Per partition of the written export: its rows, and that it has files and bytes."""
    path = _exported_events(spark, d)
    rows = export.export_partition_counts(spark.read.parquet(path))
    sizes = reports.partition_footprint(spark, path)
    return rows.join(sizes, list(S.PARTITION_KEYS), "left").select(
        *S.PARTITION_KEYS, "row_count", F.coalesce(F.col("file_count") > 0, F.lit(False)).alias("has_files"),
        F.coalesce(F.col("size_mb") > 0, F.lit(False)).alias("has_bytes"))


# --- stored-model runs (real writes into a scratch warehouse) -------------------------------------

class _Arrivals:
    """The source as successive runs see it: rows become visible between runs."""

    def __init__(self, df: DataFrame):
        self.df = df

    def __call__(self, from_date) -> DataFrame:
        return self.df


def _two_runs(spark, first_rows: DataFrame, all_rows: DataFrame, from_date, version=3, engine="sql",
              seed="exact") -> Project:
    feed = _Arrivals(first_rows)
    project = Project(spark, feed, scratch_path(spark, "runs-wh"))
    project.run(version=version, engine=engine)
    feed.df = all_rows
    project.run(version=version, from_date=from_date, engine=engine, seed=seed)
    return project


def stored_run_incremental_v3(spark, d):
    """First run on the days before 2024-01-24, then a 14-day run once the rest arrived: the stored
    table equals the full result."""
    src = A.events_source(spark, d)
    project = _two_runs(spark, _before(src, "2024-01-24"), src, EF)
    return project.warehouse.read("agg_daily_revenue_v3")


def stored_run_incremental_py_v3(spark, d):
    src = A.events_source(spark, d)
    project = _two_runs(spark, _before(src, "2024-01-24"), src, EF, engine="arrow")
    return project.warehouse.read("agg_daily_revenue_py_v3")


def stored_run_incremental_v2(spark, d):
    src = A.events_source(spark, d)
    project = _two_runs(spark, _before(src, "2024-01-24"), src, EF, version=2)
    return project.warehouse.read("agg_daily_revenue_v2")


def stored_run_late_rows(spark, d):
    """First run without the late rows; they arrive before the 14-day run."""
    src, early = _events_first_run_without_late(spark, d)
    return _two_runs(spark, early, src, EF).warehouse.read("agg_daily_revenue_v3")


def stored_run_late_rows_staging(spark, d):
    src, early = _events_first_run_without_late(spark, d)
    return _two_runs(spark, early, src, EF).warehouse.read("stg_orders_v2")


def stored_full_refresh_v3(spark, d):
    """An earlier run on part of the rows, then a full refresh of both stored models."""
    src = A.events_source(spark, d)
    feed = _Arrivals(_before(src, "2024-01-24"))
    project = Project(spark, feed, scratch_path(spark, "runs-wh"))
    project.run(version=3)
    feed.df = src
    project.run(version=3, from_date=EF, full_refresh=True)
    return project.warehouse.read("agg_daily_revenue_v3")


def stored_run_v1(spark, d):
    """The batch models, run twice: the second run rebuilds both tables."""
    src = A.events_source(spark, d)
    feed = _Arrivals(_before(src, "2024-01-24"))
    project = Project(spark, feed, scratch_path(spark, "runs-wh"))
    project.run(version=1)
    feed.df = src
    project.run(version=1)
    return project.warehouse.read("agg_daily_revenue_v1")


def _upserted_lines(spark, d, key_index: bool) -> DataFrame:
    """Stored staging over L (several lines per order), then a batch that re-stages the window with
    orders moved back by a year, days emptied by that, and restated lines."""
    src = A.lines_source(spark, d)
    feed = _Arrivals(src)
    project = Project(spark, feed, scratch_path(spark, "upsert-wh"), key_index=key_index)
    project.run_model("stg_orders_v2")
    moved = F.when(F.col(S.ORDER_ID) % 7 == 0, F.col(S.ORDER_TS) - F.expr("INTERVAL 1 YEAR")).otherwise(F.col(S.ORDER_TS))
    restated = F.when(F.col(S.PRODUCT_ID) % 5 == 0, F.col(S.REVENUE) + 1).otherwise(F.col(S.REVENUE))
    batch = src.filter(F.to_date(S.ORDER_TS) >= date_lit(LF)).withColumns({S.ORDER_TS: moved, S.REVENUE: restated})
    project.warehouse.delete_insert("stg_orders_v2", staging.stage_v2(batch), S.ORDER_ID)
    return project.warehouse.read("stg_orders_v2")


def stored_upsert_lines_direct(spark, d):
    return _upserted_lines(spark, d, key_index=False)


def stored_upsert_lines_index(spark, d):
    return _upserted_lines(spark, d, key_index=True)


def _flawed_events(spark, d) -> DataFrame:
    """E with amounts missing (every seventh order), negative (every eleventh) or not those of the unit
    price, and payment methods missing (every thirteenth)."""
    i, src = F.col(S.ORDER_ID), A.events_source(spark, d)
    revenue = F.when(i % 7 == 0, F.lit(None).cast("double")).when(i % 11 == 0, -F.col(S.REVENUE)).otherwise(F.col(S.REVENUE))
    return src.withColumns({S.REVENUE: revenue, S.PAYMENT_METHOD: F.when(i % 13 != 0, F.col(S.PAYMENT_METHOD))})


def stored_run_report(spark, d):
    """What an incremental staging run reports of its window, observed by the job that writes the batch:
    preview, declared tests and rejected rows as (report, item, row_count)."""
    src = _flawed_events(spark, d)
    feed = _Arrivals(_before(src, "2024-01-24"))
    project = Project(spark, feed, scratch_path(spark, "report-wh"))
    project.run_model("stg_orders_v2")
    feed.df = src
    report = project.run_model("stg_orders_v2", from_date=EF, preview=True)
    preview = report.preview.unpivot([], ["row_count", "day_count"], "item", "n")
    return (preview.select(F.lit("preview").alias("report"), "item", F.col("n").alias("row_count"))
            .unionByName(report.not_null.select(F.lit("not_null").alias("report"), F.col("column_name").alias("item"),
                                                F.col("null_count").alias("row_count")))
            .unionByName(report.rejected.select(F.lit("rejected").alias("report"), F.col("reason").alias("item"), "row_count")))


def _all_models(spark, d) -> Project:
    project = Project(spark, _Arrivals(A.events_source(spark, d)), scratch_path(spark, "all-wh"))
    for name in MODELS:
        project.run_model(name)
    return project


def stored_not_null_report(spark, d):
    """The declared tests over the eight stored tables of E: one scan each."""
    return not_null_checks(_all_models(spark, d))


def stored_views(spark, d):
    """The stored metric table through its SQL view: the newest seven days."""
    src = A.events_source(spark, d)
    project = Project(spark, _Arrivals(src), scratch_path(spark, "views-wh"))
    project.run(version=3)
    project.warehouse.register_views()
    return spark.sql(f"SELECT {', '.join(S.RUNNING_COLUMNS)} FROM agg_daily_revenue_v3 ORDER BY order_date DESC LIMIT 7")


def stored_previews(spark, d):
    """Previews of runs over a partitioned source and stored tables: two whose target exists, one
    whose target doesn't."""
    path = _exported_events(spark, d)
    project = Project(spark, lambda fd: read_transactions(spark, path, fd, day_aligned=True), scratch_path(spark, "previews-wh"),
                      day_aligned=True)
    project.run(version=3)
    parts = [project.preview(m, project.mode(m, False), EF)
             for m in (MODELS[n] for n in ("stg_orders_v2", "agg_daily_revenue_v3", "agg_daily_revenue_py_v3"))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def default_window_run(spark, d):
    """The window that the project default gives for the run date 2024-01-31: 14 days back."""
    first = default_from_date(today=parse_date("2024-01-31"))
    return metrics.daily_revenue(staging.stage_v2(A.events_source(spark, d), first), first)


def typed_empty_window(spark, d):
    """A window without rows: the Arrow model's result is empty and keeps its column types."""
    staged = staging.stage_v2(A.events_source(spark, d), "2030-01-01")
    return metrics.running_total(arrow.daily_metrics_batches(staged, "2030-01-01"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "stg_full": stg_full,
    "stg_incremental_window": stg_incremental_window,
    "stg_delete_insert": stg_delete_insert,
    "daily_revenue_full": daily_revenue_full,
    "daily_revenue_full_events": daily_revenue_full_events,
    "daily_revenue_window": daily_revenue_window,
    "daily_revenue_window_events": daily_revenue_window_events,
    "daily_delete_insert": daily_delete_insert,
    "daily_running_full": daily_running_full,
    "daily_running_full_events": daily_running_full_events,
    "daily_running_incremental": daily_running_incremental,
    "daily_running_incremental_events": daily_running_incremental_events,
    "seed_latest_gap": seed_latest_gap,
    "seed_exact_gap": seed_exact_gap,
    "late_in_window": late_in_window,
    "late_out_of_window": late_out_of_window,
    "daily_arrow_batches": daily_arrow_batches,
    "daily_arrow_batches_lines": daily_arrow_batches_lines,
    "daily_arrow_grouped": daily_arrow_grouped,
    "daily_arrow_grouped_lines": daily_arrow_grouped_lines,
    "daily_arrow_v1_lines": daily_arrow_v1_lines,
    "daily_arrow_v2_window": daily_arrow_v2_window,
    "daily_arrow_incremental": daily_arrow_incremental,
    "union_by_name": union_by_name,
    "schema_append": schema_append,
    "stored_schema_append": stored_schema_append,
    "latest_30_days": latest_30_days,
    "head_10": head_10,
    "limit_100": limit_100,
    "running_series": running_series,
    "metric_overview": metric_overview,
    "metric_statistics": metric_statistics,
    "metric_describe": metric_describe,
    "line_statistics": line_statistics,
    "dataset_profile": dataset_profile,
    "avg_order_value": avg_order_value,
    "rows_per_day": rows_per_day,
    "run_preview_source": run_preview_source,
    "run_preview_staging": run_preview_staging,
    "not_null_report": not_null_report,
    "rejected_rows": rejected_rows,
    "rejected_rows_events": rejected_rows_events,
    "export_partitions": export_partitions,
    "partition_pruned_scan": partition_pruned_scan,
    "exported_footprint": exported_footprint,
    "stored_run_incremental_v3": stored_run_incremental_v3,
    "stored_run_incremental_py_v3": stored_run_incremental_py_v3,
    "stored_run_incremental_v2": stored_run_incremental_v2,
    "stored_run_late_rows": stored_run_late_rows,
    "stored_run_late_rows_staging": stored_run_late_rows_staging,
    "trend_series": trend_series,
    "export_read_back": export_read_back,
    "export_rerun": export_rerun,
    "unaligned_partition_scan": unaligned_partition_scan,
    "zone_mapped_scan": zone_mapped_scan,
    "late_row_ledger": late_row_ledger,
    "misplaced_row_ledger": misplaced_row_ledger,
    "stored_run_report": stored_run_report,
    "daily_distinct_state": daily_distinct_state,
    "stored_full_refresh_v3": stored_full_refresh_v3,
    "stored_run_v1": stored_run_v1,
    "stored_upsert_lines_direct": stored_upsert_lines_direct,
    "stored_upsert_lines_index": stored_upsert_lines_index,
    "stored_not_null_report": stored_not_null_report,
    "stored_views": stored_views,
    "stored_previews": stored_previews,
    "default_window_run": default_window_run,
    "typed_empty_window": typed_empty_window,
}
