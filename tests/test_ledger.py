import datetime as dt

import pytest
from pyspark.sql import functions as F

from daybook import schemas as S
from daybook.plans.runs import Project
from daybook.sources import adapters as A
from daybook.sources.ledger import SourceLedger
from tests.conftest import SF_SMALL


@pytest.fixture()
def events(spark):
    return A.events_source(spark, SF_SMALL)


def load(df, path, files=6, mode="append"):
    df.repartitionByRange(files, S.ORDER_TS).write.mode(mode).parquet(path)


def by_day(df):
    return {r.day: tuple(r)[1:] for r in df.collect()}


def test_only_new_files_are_read_and_the_window_skips_files(spark, events, tmp_path):
    root = str(tmp_path / "a source")
    load(events.filter("order_id % 2 = 0"), f"{root}/load=1")
    ledger = SourceLedger(spark, root, str(tmp_path / "wh"))
    first = ledger.refresh()
    assert first > 3 and ledger.refresh() == 0
    load(events.filter("order_id % 2 = 1"), f"{root}/load=2")
    second = ledger.refresh()
    assert second > 3 and ledger.refresh() == 0
    window = ledger.read_window(A.EVENTS_FROM_DATE)
    assert 0 < len(window.inputFiles()) < first + second
    want = events.filter(F.col(S.ORDER_DATE) >= A.EVENTS_FROM_DATE)
    assert window.select(*want.columns).exceptAll(want).isEmpty() and window.count() == want.count()
    assert sum(r.rows for r in ledger.days().collect()) == events.count()
    assert ledger.read_window("2100-01-01").count() == 0


def test_changed_and_removed_files(spark, events, tmp_path):
    root = str(tmp_path / "src")
    load(events, f"{root}/load=1")
    load(events.limit(20), f"{root}/load=2", files=1)
    ledger = SourceLedger(spark, root, str(tmp_path / "wh"))
    ledger.refresh()
    ledger.record("t")
    assert ledger.changed_days("t").count() == 0
    changed = events.limit(20).withColumn(S.REVENUE, F.col(S.REVENUE) + 1)
    load(changed, f"{root}/load=2", files=1, mode="overwrite")
    assert ledger.refresh() == 1
    days = by_day(ledger.changed_days("t"))
    touched = {r[0] for r in changed.select(S.ORDER_DATE).distinct().collect()}
    assert set(days) == touched and all(stored == now and late == 0 for stored, now, late in days.values())
    load(changed.limit(0), f"{root}/load=2", files=1, mode="overwrite")
    ledger.refresh()
    assert sum(late for _, _, late in by_day(ledger.changed_days("t")).values()) == -20
    assert ledger.refresh() == 0


def test_late_rows_of_older_days_are_named(spark, events, tmp_path):
    root, wh = str(tmp_path / "src"), str(tmp_path / "wh")
    project = Project(spark, None, wh, ledger=SourceLedger(spark, root, wh))
    late = (F.col(S.ORDER_ID) % 10) == 0
    load(events.filter(~late), f"{root}/load=1")
    report = project.run_model("stg_orders_v2")
    assert report.late_rows == 0 and report.late_days.count() == 0
    load(events.filter(late), f"{root}/load=2")
    report = project.run_model("stg_orders_v2", from_date=A.EVENTS_FROM_DATE)
    older = events.filter(late & (F.col(S.ORDER_DATE) < A.EVENTS_FROM_DATE))
    assert report.late_rows == older.count() > 0
    want = {r[0]: r[1] for r in older.groupBy(S.ORDER_DATE).count().collect()}
    got = by_day(report.late_days)
    assert {d: x[2] for d, x in got.items()} == want
    stored = {r[0]: r[1] for r in project.warehouse.read("stg_orders_v2").groupBy(S.ORDER_DATE).count().collect()}
    assert all(stored[d] == x[0] for d, x in got.items())
    # A longer window takes them in.
    report = project.run_model("stg_orders_v2", from_date="2024-01-01")
    assert report.late_rows == 0 and project.warehouse.read("stg_orders_v2").count() == events.count()


def test_rows_without_a_timestamp_and_an_empty_file(spark, events, tmp_path):
    root = str(tmp_path / "src")
    load(events.limit(3).withColumn(S.ORDER_TS, F.lit(None).cast("timestamp_ntz")).coalesce(1), root, files=1)
    events.limit(0).coalesce(1).write.mode("append").parquet(root)
    ledger = SourceLedger(spark, root, str(tmp_path / "wh"))
    ledger.refresh()
    assert ledger.refresh() == 0
    assert by_day(ledger.days().select("day", "rows")) == {None: (3,)}
    ledger.record("t")
    load(events.limit(2).withColumn(S.ORDER_TS, F.lit(dt.datetime(2020, 1, 1)).cast("timestamp_ntz")), root, files=1)
    ledger.refresh()
    assert by_day(ledger.changed_days("t")) == {dt.date(2020, 1, 1): (0, 2, 2)}


def test_empty_target_is_typed(spark, tmp_path):
    from daybook.sources.warehouse import Warehouse

    schema = S.staging_schema()
    empty = Warehouse(spark, str(tmp_path / "wh")).read_or_empty("stg_orders_v2", schema)
    assert empty.schema == schema and empty.count() == 0
