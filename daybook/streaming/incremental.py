"""Structured Streaming trigger for the incremental models.

New Parquet files arriving in the Hive-partitioned source are picked up by the file stream source
(the processed-file log lives in the checkpoint location, so each file is handled once).  For each
micro-batch, ``foreachBatch``:

1. finds the days the new rows touch (at most one per calendar day: a bounded collect);
2. re-stages the **complete** source rows of those days (the micro-batch alone holds only the new
   files, and replacing an order's lines by a partial set would drop lines) and applies them to
   ``stg_orders_v2`` by delete+insert on ``order_id``;
3. re-derives the metric model's rows of the days whose staging rows changed (those days, and days
   that orders moved away from), and sums the running total up again over the stored day series.

Every step is the batch operator of the same model, so a replayed micro-batch (after a failure
between the write and the checkpoint commit) rewrites the same rows: the sink is idempotent.
Late rows of any age are absorbed (the window follows the data instead of the clock), and an old
row costs its own day, not everything since: for a source declared day-aligned the touched days
become partition predicates, else a timestamp filter that the scan pushes down.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from daybook import schemas as S
from daybook.operators import staging
from daybook.plans.runs import MODELS, Project
from daybook.sources.transactions import day_rows, normalise_timestamp


def touched_days(new_rows: DataFrame) -> list:
    days = new_rows.select(F.to_date(F.col(S.ORDER_TS)).alias("d")).where(F.col("d").isNotNull()).distinct()
    return sorted(r[0] for r in days.collect())


def process_new_rows(project: Project, new_rows: DataFrame, metric_model: str = "agg_daily_revenue_v3",
                     seed: str = "latest") -> list:
    """Apply one batch of newly arrived source rows to staging and the metric model."""
    days = touched_days(normalise_timestamp(new_rows))
    if not days:
        return []
    wh = project.warehouse
    stg_name = MODELS[metric_model].staging
    source = day_rows(project.source(days[0]), days, day_aligned=project.day_aligned)
    complete = staging.stage_v2(source)
    changed = days
    if wh.exists(stg_name):
        changed = wh.delete_insert(stg_name, complete, S.ORDER_ID, S.ORDER_DATE).days
    else:
        wh.write_full(stg_name, complete, S.ORDER_DATE, rebalance=not project.day_aligned)
    project.refresh_days(metric_model, changed, seed)
    return days


def start_incremental_stream(project: Project, source_path: str, source_schema: T.StructType,
                             checkpoint_location: str, metric_model: str = "agg_daily_revenue_v3",
                             available_now: bool = True, processing_time: str | None = None,
                             seed: str = "latest") -> StreamingQuery:
    """Start the file-triggered incremental runs.  ``available_now`` processes what has arrived
    and stops (a scheduled run); otherwise it polls every ``processing_time``.
    ``checkpoint_location`` holds the log of processed files: a restart with the same one goes on
    where the last start stopped."""
    spark = project.spark
    stream = spark.readStream.schema(source_schema).parquet(source_path)

    def on_batch(batch_df: DataFrame, epoch_id: int) -> None:
        process_new_rows(project, batch_df, metric_model, seed)

    writer = (stream.writeStream.foreachBatch(on_batch)
              .option("checkpointLocation", checkpoint_location))
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()
