"""Metrics from merged batches equal those of all rows, and an update reads what it touches."""

import datetime as dt
import glob

import pyarrow.parquet as pq
import pytest
from pyspark.sql import types as T

from daybook import schemas as S
from daybook.operators import metrics
from daybook.sources import distinct_state
from daybook.sources.distinct_state import STATE, DistinctState

SCHEMA = T.StructType([T.StructField(S.ORDER_DATE, T.DateType()), T.StructField(S.ORDER_ID, T.StringType()),
                       T.StructField(S.BUYER_ID, T.LongType()), T.StructField(S.REVENUE, T.DoubleType())])


def batch(seed, n=120):
    """Rows over four days and none, with repeated rows, null keys, null and non-finite amounts."""
    out = []
    for i in range(n):
        x = (i * 7919 + seed * 104729) % 1009
        out.append((None if x % 13 == 0 else dt.date(2024, 5, 1 + x % 4), None if x % 17 == 0 else f"o{x % 40}",
                    None if x % 11 == 0 else x % 23, None if x % 19 == 0 else float("nan") if x % 29 == 0 else x / 100))
    return out + out[:5]


def same(state, spark, rows):
    got = sorted(map(tuple, state.daily_metrics().collect()), key=str)
    assert got == sorted(map(tuple, metrics.daily_metrics(spark.createDataFrame(rows, SCHEMA)).collect()), key=str)


def test_batches_merge_to_the_metrics_of_all_rows(spark, wh_root):
    state, rows = DistinctState(spark, wh_root), []
    for n, b in enumerate([batch(1), batch(2, 30), [], batch(3, 1), batch(1)]):
        state.update(f"b{n}", spark.createDataFrame(b, SCHEMA))
        rows += b
        same(state, spark, rows)
    # Pairs are held once.
    pairs = state.table.read(STATE).filter("kind <> 'sum'").select(S.ORDER_DATE, "kind", "key")
    assert pairs.count() == pairs.distinct().count()


def test_a_batch_counts_once_and_a_stopped_one_not_at_all(spark, wh_root, monkeypatch):
    state = DistinctState(spark, wh_root)
    assert state.update("a", spark.createDataFrame(batch(1), SCHEMA))
    assert state.update("a", spark.createDataFrame(batch(1), SCHEMA)) == []
    same(state, spark, batch(1))
    with monkeypatch.context() as m:
        def stop(*a):
            raise RuntimeError("stopped")
        m.setattr(state.table, "_point", stop)  # everything written, nothing switched
        with pytest.raises(RuntimeError):
            state.update("b", spark.createDataFrame(batch(2), SCHEMA))
    same(state, spark, batch(1))
    state.update("b", spark.createDataFrame(batch(2), SCHEMA))
    same(state, spark, batch(1) + batch(2))
    assert not glob.glob(f"{state.root}/__batch__*")


def test_days_of_many_batches_are_made_one(spark, wh_root):
    state, rows = DistinctState(spark, wh_root), []
    append = state.table.append_days
    state.table.append_days = lambda *a, **k: append(*a, **k, most=2)
    for n in range(4):
        state.update(str(n), spark.createDataFrame(batch(n, 20), SCHEMA))
        rows += batch(n, 20)
    same(state, spark, rows)
    assert max(len(r) for r in state.table.stored(STATE).days.revisions.values()) == 2


def test_a_late_row_reads_its_day_and_bucket_and_no_order_lines(spark, wh_root):
    state = DistinctState(spark, wh_root)
    state.update("a", spark.createDataFrame(batch(1, 400), SCHEMA))
    before = state.table.stored(STATE).days.revisions
    late = [(dt.date(2024, 5, 2), "late", 5, 1.0)]
    assert state.update("b", spark.createDataFrame(late, SCHEMA)) == [late[0][0]]
    after = state.table.stored(STATE).days.revisions
    assert {v for v in after if after[v] != before[v]} == {"2024-05-02"} and len(after["2024-05-02"]) == 2
    same(state, spark, batch(1, 400) + late)
    pairs = spark.createDataFrame([(late[0][0], "order", "late", 3)], "order_date date, kind string, key string, bucket int")
    plan = state._unknown(pairs, [late[0][0]])._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(bucket,3)" in plan or "In(bucket, [3])" in plan or "bucket = 3" in plan
    assert "order_date=2024-05-02" in "".join(f for f in state.table.read(STATE, days=[late[0][0]]).inputFiles())
    assert all("2024-05-02" in f for f in state.table.read(STATE, days=[late[0][0]]).inputFiles())


def test_files_are_sorted_by_bucket(spark, wh_root):
    state = DistinctState(spark, wh_root)
    state.update("a", spark.createDataFrame(batch(1, 5), SCHEMA))
    state.update("b", spark.createDataFrame(batch(2, 900), SCHEMA))
    seen = 0
    for r in {r for held in state.table.stored(STATE).days.revisions.values() for r in held}:
        for path in glob.glob(f"{state.table.path(STATE)}/*/day_revision={r}/*.parquet"):
            got = pq.ParquetFile(path).read(columns=["kind", "bucket"]).to_pylist()
            order = [(x["kind"], x["bucket"] or 0) for x in got]
            assert order == sorted(order)
            seen += len(order)
    assert seen > 50 and distinct_state.BUCKETS == 256
