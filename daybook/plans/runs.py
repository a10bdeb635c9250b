"""Model runs: build a model's DataFrame for the chosen mode and write it with its strategy.

Models (the reference's eight):

=========================  ==============  =======================  ======================
model                      materialised    key                      reads
=========================  ==============  =======================  ======================
stg_orders_v1              table           -                        source
stg_orders_v2              incremental     order_id (not unique)    source
agg_daily_revenue_v1       table           -                        stg_orders_v1
agg_daily_revenue_v2       incremental     order_date               stg_orders_v2
agg_daily_revenue_v3       incremental     order_date               stg_orders_v2 + itself
agg_daily_revenue_py_v*    same as v*      same                     Arrow-batch variants
=========================  ==============  =======================  ======================

An incremental model runs incrementally iff its table exists and no full refresh is asked;
otherwise it is built from everything (first run / full refresh).  ``from_date`` is an explicit
argument (``functions.dates.default_from_date`` gives the project default, run date minus 14).
``run`` is two calls in order (staging, then metrics); there is no model graph.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook import schemas as S
from daybook.functions.dates import parse_date
from daybook.operators import arrow, metrics, quality, staging
from daybook.sources.ledger import SourceLedger
from daybook.sources.transactions import has_day_folders, window_rows
from daybook.sources.warehouse import Warehouse, WriteResult

SourceFn = Callable[[object], DataFrame]  # from_date or None -> transactions frame


@dataclass(frozen=True)
class Model:
    name: str
    incremental: bool
    key: str | None
    version: int
    staging: str | None = None  # the staging model that a metric model reads; None: reads the source
    engine: str = "sql"  # "sql" (native plan) or "arrow" (Arrow-batch variant)


# The reference's model names and their configuration.
MODELS: dict[str, Model] = {
    "stg_orders_v1": Model("stg_orders_v1", False, None, 1),
    "stg_orders_v2": Model("stg_orders_v2", True, S.ORDER_ID, 2),
    "agg_daily_revenue_v1": Model("agg_daily_revenue_v1", False, None, 1, "stg_orders_v1"),
    "agg_daily_revenue_v2": Model("agg_daily_revenue_v2", True, S.ORDER_DATE, 2, "stg_orders_v2"),
    "agg_daily_revenue_v3": Model("agg_daily_revenue_v3", True, S.ORDER_DATE, 3, "stg_orders_v2"),
    "agg_daily_revenue_py_v1": Model("agg_daily_revenue_py_v1", False, None, 1, "stg_orders_v1", "arrow"),
    "agg_daily_revenue_py_v2": Model("agg_daily_revenue_py_v2", True, S.ORDER_DATE, 2, "stg_orders_v2", "arrow"),
    "agg_daily_revenue_py_v3": Model("agg_daily_revenue_py_v3", True, S.ORDER_DATE, 3, "stg_orders_v2", "arrow"),
}


@dataclass
class RunReport:
    model: str
    mode: str
    from_date: object
    partitions_written: int
    partitions_dropped: int
    seconds: float
    preview: DataFrame | None = field(default=None, repr=False)
    misplaced_rows: int | None = None  # day-aligned source: window rows outside their day's folder
    files_read: int | None = None  # source with a ledger: files of the window
    late_rows: int | None = None  # source with a ledger: rows of older days that the table lacks by now
    late_days: DataFrame | None = field(default=None, repr=False)  # ... day by day
    not_null: DataFrame | None = field(default=None, repr=False)  # incremental staging: tests of the batch
    rejected: DataFrame | None = field(default=None, repr=False)  # incremental staging: rejected source rows


class Project:
    """A source of transactions and a warehouse folder.  ``day_aligned`` declares that every source
    row lies in the folder of its day; ``key_index`` gives the staging table a key index.  With a
    ``ledger`` the source may be None: a staging run brings the ledger up to date, reads the files that
    its window needs, and reports the older days that have changed since the table took them."""

    def __init__(self, spark: SparkSession, source: SourceFn | None, warehouse_root: str,
                 key_index: bool = False, key_buckets: int | None = None, day_aligned: bool = False,
                 ledger: SourceLedger | None = None):
        if source is None and ledger is None:
            raise ValueError("a source or a ledger is needed")
        self.spark = spark
        self.ledger = ledger
        self.source = source or ledger.read_window
        self.day_aligned = day_aligned
        self.warehouse = Warehouse(spark, warehouse_root, key_index=key_index, key_buckets=key_buckets)

    def mode(self, model: Model, full_refresh: bool) -> str:
        return quality.run_mode(model.incremental, self.warehouse.exists(model.name), full_refresh)

    # -- model frames (no writes) -----------------------------------------------------------------

    def staging_frame(self, model: Model, mode: str, from_date) -> tuple[DataFrame, bool]:
        """The staging frame, and whether its source is laid out by day (declared, and the Hive
        ``year/month/date`` columns are present), in which case each scan task holds about one day
        and the full build can write without a shuffle."""
        window = None if model.version == 1 or mode != "incremental" else from_date
        src = self.source(window)
        day_aligned = self.day_aligned and has_day_folders(src)
        if model.version == 1:
            return staging.stage_v1(src), day_aligned
        return staging.stage_v2(src, from_date=window), day_aligned

    def metric_frame(self, model: Model, mode: str, from_date, seed: str) -> DataFrame:
        window = from_date if mode == "incremental" else None
        staged = self.warehouse.read(model.staging, from_date=window)
        if model.engine == "arrow":
            days = arrow.daily_metrics_batches(staged, window, with_buyers=model.version == 3)
        elif model.version == 3:
            days = metrics.daily_metrics(staged, window)
        else:
            days = metrics.daily_revenue(staged, window)
        if model.version != 3:
            return days
        if window is None:
            return metrics.running_total(days)
        target = self.warehouse.read(model.name)  # rewritten whole each time: one schema
        seeded = metrics.seeded_running_total(days, metrics.select_seed(target, window, seed))
        # The seed day is re-emitted with its stored values; leaving it out of the write gives the
        # same table and rewrites only the window's days.
        return seeded.filter(seeded[S.ORDER_DATE] >= parse_date(window))

    # -- runs -------------------------------------------------------------------------------------

    def run_model(self, name: str, from_date=None, full_refresh: bool = False, seed: str = "latest",
                  preview: bool = False) -> RunReport:
        model = MODELS[name]
        t0 = time.time()
        mode = self.mode(model, full_refresh)
        if mode == "incremental" and from_date is None:
            raise ValueError(f"{name}: an incremental run needs from_date")
        ledger = self.ledger if model.staging is None else None
        window = from_date if mode == "incremental" else None
        if ledger is not None:
            ledger.refresh()
        prev = watch = None
        wh = self.warehouse
        if model.staging is None and mode == "incremental":
            # The window's source rows are read once: the job that writes the batch observes them.
            watch = quality.BatchWatch(window_rows(self.source(window), window), name, window)
        elif preview:
            prev = self.preview(model, mode, from_date)
        if watch is not None:
            res = wh.delete_insert(name, staging.stage_v2(watch.rows, from_date=window), model.key, S.ORDER_DATE)
            prev = watch.preview() if preview else None
        elif model.staging is None:
            frame, day_aligned = self.staging_frame(model, mode, from_date)
            res = wh.write_full(name, frame, S.ORDER_DATE, rebalance=not day_aligned)
        else:
            frame = self.metric_frame(model, mode, from_date, seed)
            if mode == "incremental":
                res = wh.replace_days(name, frame)
            else:
                wh.write_full(name, frame)
                res = WriteResult(name, wh.read(name).count())
        report = RunReport(name, mode, parse_date(from_date) if from_date else None,
                           res.partitions_written, res.partitions_dropped, 0.0, prev)
        if watch is not None:
            report.misplaced_rows = watch.misplaced if self.day_aligned else None
            report.not_null, report.rejected = watch.not_null(), watch.rejected()
        if ledger is not None:
            ledger.record(name, window)
            report.files_read = len(ledger.window_files(window))
            report.late_days = ledger.changed_days(name)
            late = report.late_days.filter("dropped_rows > 0").agg(F.coalesce(F.sum("dropped_rows"), F.lit(0)).alias("n"))
            report.late_rows = late.first().n
        report.seconds = round(time.time() - t0, 3)
        return report

    def preview(self, model: Model, mode: str, from_date) -> DataFrame:
        window = from_date if mode == "incremental" else None
        request = [(model.name, mode, window)]
        if model.staging is None:
            return quality.preview_source(self.source(window), request)
        schema = S.staging_schema()
        staged = self.warehouse.read_or_empty(model.staging, schema)
        return quality.preview_staging(staged, request)

    def refresh_days(self, name: str, days, seed: str = "latest") -> None:
        """Re-derive a metric model's given days from staging; the running total is summed up again
        from the stored day series, from the earliest of them on."""
        model, wh = MODELS[name], self.warehouse
        days = [d for d in days if d is not None]
        if not days:
            return
        staged = wh.read(model.staging, days=days)
        if model.engine == "arrow":
            fresh = arrow.daily_metrics_batches(staged, None, with_buyers=model.version == 3)
        else:
            fresh = metrics.daily_metrics(staged) if model.version == 3 else metrics.daily_revenue(staged)
        if not wh.exists(name):
            wh.write_full(name, metrics.running_total(fresh) if model.version == 3 else fresh)
            return
        stored, first = wh.read(name), min(days)
        gone = F.col(S.ORDER_DATE).isin(sorted(days))
        if model.version == 3:
            # One row per calendar day: the series is small whatever the source.
            later = stored.filter((F.col(S.ORDER_DATE) >= F.lit(first)) & ~gone).select(*S.RUNNING_COLUMNS[:-1])
            series = later.unionByName(fresh.select(*later.columns))
            fresh = metrics.seeded_running_total(series, metrics.select_seed(stored, first, seed))
            fresh = fresh.filter(F.col(S.ORDER_DATE) >= F.lit(first))
            gone = F.col(S.ORDER_DATE) >= F.lit(first)
        wh.write_full(name, stored.filter(~gone).unionByName(fresh))

    def run(self, version: int = 3, from_date=None, full_refresh: bool = False, seed: str = "latest",
            engine: str = "sql") -> list[RunReport]:
        """Staging then the metric model of a version (what ``+agg_daily_revenue_v<n>`` selects)."""
        metric = f"agg_daily_revenue_{'py_' if engine == 'arrow' else ''}v{version}"
        stg = MODELS[metric].staging
        return [self.run_model(stg, from_date, full_refresh, seed),
                self.run_model(metric, from_date, full_refresh, seed)]


def not_null_checks(project: Project) -> DataFrame:
    """The declared not-null tests over every stored model table."""
    wh = project.warehouse
    tables = {name: wh.read(name, merge_schema=name.startswith("stg_")) for name in MODELS if wh.exists(name)}
    return quality.not_null_report(tables)
