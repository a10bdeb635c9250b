"""File-triggered incremental runs: two arrivals of source files give the full result."""

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook import schemas as S
from daybook.operators import export, metrics, staging
from daybook.plans.runs import Project
from daybook.sources import adapters as A
from daybook.sources.transactions import partitioned_source_schema, read_transactions
from daybook.streaming.incremental import start_incremental_stream
from tests.conftest import SF_SMALL


def test_stream_of_new_files_matches_full_rebuild(spark, tmp_path):
    src_path = str(tmp_path / "source")
    events = A.events_source(spark, SF_SMALL)
    late = (F.col(S.ORDER_ID) % 10) == 0
    first = events.filter((F.col(S.ORDER_DATE) < F.lit(dt.date(2024, 1, 20))) & ~late)
    export.partitioned_export(first, src_path)

    project = Project(spark, lambda fd: read_transactions(spark, src_path, fd, day_aligned=True), str(tmp_path / "wh"),
                      day_aligned=True)
    schema = partitioned_source_schema(T.LongType())
    ckpt = str(tmp_path / "stream")
    q = start_incremental_stream(project, src_path, schema, checkpoint_location=ckpt)
    q.awaitTermination(300)
    got1 = project.warehouse.read("agg_daily_revenue_v3")
    assert got1.count() == first.select(S.ORDER_DATE).distinct().count()

    # New files arrive: later days plus late rows for old days (written as extra files).
    rest = events.filter((F.col(S.ORDER_DATE) >= F.lit(dt.date(2024, 1, 20))) | late)
    rest_frame = export.export_frame(rest)
    rest_frame.write.mode("append").partitionBy("year", "month", "date").parquet(src_path)
    q = start_incremental_stream(project, src_path, schema, checkpoint_location=ckpt)
    q.awaitTermination(300)

    want = metrics.daily_running_full(staging.stage_v2(events))
    cols = list(S.RUNNING_COLUMNS)
    got = sorted(map(tuple, project.warehouse.read("agg_daily_revenue_v3").select(*cols).collect()))
    assert got == sorted(map(tuple, want.select(*cols).collect()))
    assert project.warehouse.read("stg_orders_v2").count() == events.count()


def test_touched_days_cost_only_their_days(spark, tmp_path):
    """A late row for an old day: only that day (and the day an order left) is staged and aggregated
    again; later days keep their rows and get a new running total."""
    from daybook.streaming.incremental import process_new_rows

    events = A.events_source(spark, SF_SMALL)
    late = F.col(S.ORDER_ID) == events.filter(F.col(S.ORDER_DATE) == F.lit(dt.date(2024, 1, 3))).first()[S.ORDER_ID]
    path = str(tmp_path / "source")
    export.partitioned_export(events.filter(~late), path)
    project = Project(spark, lambda fd: read_transactions(spark, path, fd, day_aligned=True), str(tmp_path / "wh"), day_aligned=True)
    project.run(version=3)
    before = project.warehouse.version("stg_orders_v2")
    new = export.export_frame(events.filter(late))
    new.write.mode("append").partitionBy("year", "month", "date").parquet(path)
    seen = []
    real = project.warehouse.delete_insert
    project.warehouse.delete_insert = lambda *a, **k: seen.append(r := real(*a, **k)) or r
    assert process_new_rows(project, new) == [dt.date(2024, 1, 3)]
    assert [r.days for r in seen] == [[dt.date(2024, 1, 3)]] and project.warehouse.version("stg_orders_v2") == before
    cols = list(S.RUNNING_COLUMNS)
    got = sorted(map(tuple, project.warehouse.read("agg_daily_revenue_v3").select(*cols).collect()))
    want = metrics.daily_running_full(staging.stage_v2(events))
    assert got == sorted(map(tuple, want.select(*cols).collect()))


def test_stream_needs_its_checkpoint():
    import inspect
    p = inspect.signature(start_incremental_stream).parameters["checkpoint_location"]
    assert p.default is inspect.Parameter.empty
