"""Hand-made edge fixtures: non-unique delete keys, NULLs, moved orders, schema evolution,
nanosecond timestamps, invalid revenue, partition pruning."""

import datetime as dt
import os

import pyarrow as pa
import pytest
import pyarrow.parquet as pq
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook import schemas as S
from daybook.operators import arrow, export, metrics, quality, staging, upsert
from daybook.plans.runs import Project
from daybook.session import apply_conf, checkpoint_root
from daybook.sources import adapters as A
from daybook.sources.transactions import misplaced_rows, read_transactions
from daybook.sources.warehouse import Warehouse
from tests.conftest import SF_SMALL

SCHEMA = S.staging_schema(T.StringType())
D1, D2, D3 = dt.date(2024, 3, 1), dt.date(2024, 3, 2), dt.date(2024, 3, 3)


def line(order, product, day, revenue=10.0, buyer="b1"):
    ts = dt.datetime.combine(day, dt.time(9, 0))
    return (day, order, buyer, ts, product, 1, revenue, revenue, "cash")


def frame(spark, lines):
    return spark.createDataFrame(lines, SCHEMA)


def keyset(df):
    return sorted((r.order_id, r.product_id, r.revenue, r.order_date) for r in df.collect())


@pytest.mark.parametrize("key_index", [False, True])
def test_non_unique_delete_key(spark, tmp_path, key_index):
    target = frame(spark, [line("o1", 1, D1), line("o1", 2, D1), line("o2", 1, D1)])
    batch = frame(spark, [line("o1", 1, D1, 11.0), line("o1", 3, D1), line("o3", 1, D1)])
    want = [("o1", 1, 11.0, D1), ("o1", 3, 10.0, D1), ("o2", 1, 10.0, D1), ("o3", 1, 10.0, D1)]
    assert keyset(upsert.delete_insert(target, batch, S.ORDER_ID)) == want
    wh = Warehouse(spark, str(tmp_path), key_index=key_index, key_buckets=4)
    wh.write_full("stg", target, S.ORDER_DATE)
    wh.delete_insert("stg", batch, S.ORDER_ID)
    assert keyset(wh.read("stg")) == want


@pytest.mark.parametrize("key_index", [False, True])
def test_moved_order_empties_old_partition(spark, tmp_path, key_index):
    wh = Warehouse(spark, str(tmp_path), key_index=key_index, key_buckets=4)
    wh.write_full("stg", frame(spark, [line("o1", 1, D1), line("o1", 2, D1), line("o2", 1, D2)]), S.ORDER_DATE)
    res = wh.delete_insert("stg", frame(spark, [line("o1", 1, D3), line("o1", 2, D3)]), S.ORDER_ID)
    assert res.partitions_dropped == 1
    assert wh.days("stg") == [D2, D3]
    assert keyset(wh.read("stg")) == [("o1", 1, 10.0, D3), ("o1", 2, 10.0, D3), ("o2", 1, 10.0, D2)]
    wh.delete_insert("stg", frame(spark, [line("o2", 1, D2)]), S.ORDER_ID)  # its folder goes with the next write
    assert not os.path.exists(os.path.join(wh.path("stg"), f"order_date={D1.isoformat()}"))
    assert keyset(wh.read("stg")) == [("o1", 1, 10.0, D3), ("o1", 2, 10.0, D3), ("o2", 1, 10.0, D2)]


def test_vanished_day_is_kept(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path))
    m = metrics.daily_revenue(frame(spark, [line("o1", 1, D1), line("o2", 1, D2)]))
    wh.write_full("agg", m)
    wh.replace_days("agg", metrics.daily_revenue(frame(spark, [line("o3", 1, D2, 5.0)])))
    got = {r.order_date: r.daily_revenue for r in wh.read("agg").collect()}
    assert got == {D1: 10.0, D2: 5.0}
    # same semantics on a day-partitioned table (dynamic partition overwrite)
    wh.write_full("aggp", m, S.ORDER_DATE)
    wh.replace_days("aggp", metrics.daily_revenue(frame(spark, [line("o3", 1, D2, 5.0)])), S.ORDER_DATE)
    assert {r.order_date: r.daily_revenue for r in wh.read("aggp").collect()} == got


def test_added_column_backfills_null(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path))
    staged = frame(spark, [line("o1", 1, D1, buyer="a"), line("o2", 1, D2, buyer="b")])
    wh.write_full("agg", metrics.daily_revenue(staged))
    wh.replace_days("agg", metrics.daily_metrics(staged.filter(F.col(S.ORDER_DATE) == D2)))
    got = {r.order_date: r.daily_buyers for r in wh.read("agg", merge_schema=True).collect()}
    assert got == {D1: None, D2: 1}
    pure = upsert.replace_days(metrics.daily_revenue(staged), metrics.daily_metrics(staged, D2))
    assert {r.order_date: r.daily_buyers for r in pure.collect()} == got


def test_rebuild_may_read_the_table_it_replaces(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path))
    wh.write_full("t", frame(spark, [line("o1", 1, D1), line("o2", 1, D2)]))
    wh.write_full("t", wh.read("t").withColumn(S.REVENUE, F.col(S.REVENUE) * 2))
    assert sorted(r.revenue for r in wh.read("t").collect()) == [20.0, 20.0]


def test_null_timestamp_and_all_null_revenue(spark):
    rows = [line("o1", 1, D1), (None, "o2", "b2", None, 1, 1, 5.0, 5.0, "cash"),
            (D2, "o3", "b3", dt.datetime(2024, 3, 2, 10), 1, 1, None, None, "cash")]
    src = frame(spark, rows)
    v1 = {r.order_date: r for r in metrics.daily_revenue(staging.stage_v1(src)).collect()}
    assert set(v1) == {D1, D2, None}
    assert v1[None].daily_revenue == 5.0
    assert v1[D2].daily_revenue is None and v1[D2].daily_orders == 1
    v2 = {r.order_date for r in metrics.daily_revenue(staging.stage_v2(src)).collect()}
    assert v2 == {D1, D2}


def test_invalid_revenue_rejected_by_export_kept_by_staging(spark):
    src = frame(spark, [line("o1", 1, D1, 0.0), line("o2", 1, D1, -3.0), line("o3", 1, D1, 4.0)])
    assert staging.stage_v2(src).count() == 3
    assert export.export_frame(src).count() == 1
    prev = quality.preview_source(src, [("stg_orders_v2", "full_refresh", None)]).first()
    assert prev.row_count == 1
    reasons = {r.reason: r.row_count for r in quality.rejected_rows(src).collect()}
    assert reasons["non_positive_revenue"] == 2 and reasons["export_rejected_total"] == 2


def test_nanosecond_parquet_timestamps(spark, tmp_path):
    part = tmp_path / "src" / "year=2024" / "month=3" / "date=1"
    part.mkdir(parents=True)
    ts = pa.array([1709283600123456789, 1709290800000000000], pa.timestamp("ns"))
    tbl = pa.table({"order_id": ["o1", "o2"], "buyer_id": ["b1", "b2"],
                    "order_date": pa.array([D1, D1], pa.date32()), "order_timestamp": ts,
                    "product_id": pa.array([1, 2], pa.int64()), "quantity": pa.array([1, 1], pa.int64()),
                    "unit_price": [1.5, 2.5], "revenue": [1.5, 2.5], "payment_method": ["cash", "paypal"]})
    pq.write_table(tbl, str(part / "store_transactions_0.parquet"), coerce_timestamps=None,
                   use_deprecated_int96_timestamps=False, version="2.6")
    df = read_transactions(spark, str(tmp_path / "src"))
    assert isinstance(df.schema[S.ORDER_TS].dataType, T.TimestampNTZType)
    got = sorted(r[0] for r in df.select(S.ORDER_TS).collect())
    assert got == [dt.datetime(2024, 3, 1, 9, 0, 0, 123456), dt.datetime(2024, 3, 1, 11, 0)]
    assert staging.stage_v2(df).count() == 2


def test_i10_partition_pruned_read(spark, tmp_path):
    path = str(tmp_path / "export")
    src = A.events_source(spark, SF_SMALL)
    export.partitioned_export(src, path)
    pruned = read_transactions(spark, path, from_date=A.EVENTS_FROM_DATE, day_aligned=True)
    unpruned = read_transactions(spark, path).filter(
        F.to_date(S.ORDER_TS) >= F.lit(dt.date(2024, 1, 17)))
    cols = list(S.STAGING_COLUMNS)
    assert sorted(map(tuple, staging.stage_v2(pruned).select(*cols).collect())) == \
        sorted(map(tuple, staging.stage_v2(unpruned).select(*cols).collect()))
    files_read = pruned.select("_metadata.file_path").distinct().count()
    assert files_read < read_transactions(spark, path).select("_metadata.file_path").distinct().count()
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "make_date" in plan
    # rerun replaces the touched partitions only: the row count stays
    export.partitioned_export(src, path)
    assert read_transactions(spark, path).count() == export.export_frame(src).count()


def test_window_reads_list_only_window_folders(spark, tmp_path):
    days = [dt.date(2024, 1, 5), dt.date(2024, 2, 10), dt.date(2024, 3, 1), dt.date(2024, 3, 2)]
    src = frame(spark, [line(f"o{i}", 1, d) for i, d in enumerate(days)])
    path = str(tmp_path / "src")
    export.partitioned_export(src, path)
    windowed = read_transactions(spark, path, from_date="2024-03-02", day_aligned=True)
    assert len(windowed.inputFiles()) == 2  # March folder only: both March days listed, one read
    assert [r.order_id for r in windowed.collect()] == ["o3"]
    wh = Warehouse(spark, str(tmp_path / "wh"))
    wh.write_full("stg", staging.stage_v2(src), S.ORDER_DATE)
    win = wh.read("stg", from_date="2024-02-10")
    assert len(win.inputFiles()) == 3
    assert sorted(r.order_id for r in win.collect()) == ["o1", "o2", "o3"]


def test_added_column_survives_later_staging_upserts(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path))
    wh.write_full("stg", frame(spark, [line("o1", 1, D1), line("o2", 1, D2)]), S.ORDER_DATE)
    extra = frame(spark, [line("o2", 1, D2, 7.0)]).withColumn("channel", F.lit("web"))
    wh.delete_insert("stg", extra, S.ORDER_ID)            # D2 now has a column D1 lacks
    wh.delete_insert("stg", frame(spark, [line("o1", 1, D1, 3.0)]), S.ORDER_ID)  # rewrite D1 only
    got = {r.order_id: (r.revenue, r.channel) for r in wh.read("stg", merge_schema=True).collect()}
    assert got == {"o1": (3.0, None), "o2": (7.0, "web")}


@pytest.mark.parametrize("key_index", [False, True])
def test_moved_order_leaves_other_orders_of_its_old_day(spark, tmp_path, key_index):
    wh = Warehouse(spark, str(tmp_path), key_index=key_index, key_buckets=4)
    wh.write_full("stg", frame(spark, [line("o1", 1, D1), line("o1", 2, D1), line("o4", 1, D1),
                                       line("o2", 1, D2)]), S.ORDER_DATE)
    res = wh.delete_insert("stg", frame(spark, [line("o1", 1, D3)]), S.ORDER_ID)
    assert (res.partitions_written, res.partitions_dropped) == (2, 0)  # D1 rewritten, D3 new; D2 untouched
    assert keyset(wh.read("stg")) == [("o1", 1, 10.0, D3), ("o2", 1, 10.0, D2), ("o4", 1, 10.0, D1)]


def test_missing_declared_column_fails_its_check(spark):
    staged = frame(spark, [line("o1", 1, D1)]).drop(S.PAYMENT_METHOD)
    rows = {r.column_name: (r.null_count, r.passed) for r in
            quality.null_counts(staged, "stg_orders_v2", (S.ORDER_ID, S.PAYMENT_METHOD)).collect()}
    assert rows == {S.ORDER_ID: (0, True), S.PAYMENT_METHOD: (None, False)}


def test_nanosecond_longs_convert_exactly(spark):
    from daybook.sources.transactions import normalise_timestamp
    vals = [1709283600123456789, 1709283600123456001, 1709283600000000999, -1000001, 1709283600999999999]
    df = spark.createDataFrame([(v,) for v in vals], "order_timestamp long")
    got = [r[0] for r in normalise_timestamp(df).collect()]
    assert got == [dt.datetime(1970, 1, 1) + dt.timedelta(microseconds=v // 1000) for v in vals]


def test_rows_outside_their_days_folder_are_read(spark, tmp_path):
    """Not declared day-aligned: only the timestamp decides.  Declared: NULL folders are still read,
    and rows in another day's folder are counted."""
    rows = [("o1", D1, D1), ("o2", D2, D2), ("o3", D3, None), ("o4", D3, dt.date(2024, 2, 1))]
    src = frame(spark, [line(o, 1, d) for o, d, _ in rows])
    folder = spark.createDataFrame([(o, f) for o, _, f in rows], "order_id string, f date")
    placed = src.join(folder, "order_id").withColumns(
        {"year": F.year("f"), "month": F.month("f"), "date": F.dayofmonth("f")}).drop("f")
    path = str(tmp_path / "src")
    placed.write.partitionBy("year", "month", "date").parquet(path)
    ids = lambda df: sorted(r.order_id for r in df.collect())
    assert ids(read_transactions(spark, path, from_date="2024-03-02")) == ["o2", "o3", "o4"]
    declared = read_transactions(spark, path, from_date="2024-03-02", day_aligned=True)
    assert ids(declared) == ["o2", "o3"]
    assert misplaced_rows(read_transactions(spark, path)) == 2
    reasons = {r.reason: r.row_count for r in quality.rejected_rows(read_transactions(spark, path)).collect()}
    assert reasons["partition_mismatch"] == 2
    project = Project(spark, lambda fd: read_transactions(spark, path, fd, day_aligned=True), str(tmp_path / "wh"), day_aligned=True)
    project.run_model("stg_orders_v2")
    assert project.run_model("stg_orders_v2", from_date="2024-03-02").misplaced_rows == 1


def test_null_folders_of_older_months_are_listed(spark, tmp_path):
    path = str(tmp_path / "src")
    rows = spark.createDataFrame([("a", D3, 2024, 1, None), ("b", D3, 2023, None, 5), ("c", D3, None, 2, 2), ("d", D1, 2024, 1, 9)],
                                 "order_id string, d date, year int, month int, date int")
    rows.withColumn(S.ORDER_TS, F.col("d").cast("timestamp_ntz")).drop("d").write.partitionBy("year", "month", "date").parquet(path)
    got = read_transactions(spark, path, from_date="2024-03-01", day_aligned=True)
    assert sorted(r.order_id for r in got.collect()) == ["a", "b", "c"]


def test_parts_of_a_cent_add_up_and_nan_is_reported(spark):
    small = frame(spark, [line(f"o{i}", 1, D1, 0.004) for i in range(1000)])
    assert [r.daily_revenue for r in metrics.daily_revenue(small).collect()] == [4.0]
    for df in (arrow.daily_metrics_batches(small), arrow.daily_metrics_grouped(small)):
        assert [r.daily_revenue for r in df.collect()] == [4.0]
    odd = frame(spark, [line("o1", 1, D1, float("nan")), line("o2", 1, D1, float("inf")), line("o3", 1, D1, 2.5), line("o4", 1, D1, 0.004)])
    for df in (metrics.daily_metrics(odd), arrow.daily_metrics_batches(odd), arrow.daily_metrics_grouped(odd)):
        r = df.first()
        assert (r.daily_revenue, r.daily_orders) == (2.504, 4)
    reasons = {r.reason: r.row_count for r in quality.rejected_rows(odd).collect()}
    assert reasons["nan_revenue"] == 2 and reasons["sub_cent_revenue"] == 1


@pytest.mark.parametrize("key_index", [False, True])
def test_rows_without_a_day_are_a_partition(spark, tmp_path, key_index):
    def undated(order, revenue):
        return (None, order, "b", None, 1, 1, revenue, revenue, "cash")
    wh = Warehouse(spark, str(tmp_path), key_index=key_index, key_buckets=2)
    wh.write_full("stg", frame(spark, [undated("n1", 1.0), undated("n2", 2.0), line("o1", 1, D1)]), S.ORDER_DATE)
    wh.delete_insert("stg", frame(spark, [undated("n3", 3.0)]), S.ORDER_ID)
    wh.delete_insert("stg", frame(spark, [undated("n1", 5.0), line("o2", 1, D2)]), S.ORDER_ID)
    wh.delete_insert("stg", frame(spark, [line("n2", 1, D2)]), S.ORDER_ID)  # gets its day later
    got = sorted((r.order_id, r.revenue, r.order_date) for r in wh.read("stg").collect())
    assert got == [("n1", 5.0, None), ("n2", 10.0, D2), ("n3", 3.0, None), ("o1", 10.0, D1), ("o2", 10.0, D2)]


def test_null_keys_survive_an_upsert(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path))
    wh.write_full("stg", frame(spark, [line(None, 1, D1), line("o1", 1, D1)]), S.ORDER_DATE)
    wh.delete_insert("stg", frame(spark, [line("o1", 2, D1), line(None, 3, D1)]), S.ORDER_ID)
    assert sorted((r.order_id or "", r.product_id) for r in wh.read("stg").collect()) == [("", 1), ("", 3), ("o1", 2)]


def test_window_without_rows_keeps_the_schema(spark):
    staged = staging.stage_v2(frame(spark, [line("o1", 1, D1)]), "2030-01-01")
    for df in (arrow.daily_metrics_batches(staged), arrow.daily_metrics_grouped(staged), metrics.daily_metrics(staged)):
        assert df.collect() == [] and [f.dataType.simpleString() for f in df.schema] == ["date", "double", "bigint", "bigint"]


class Stop(Exception):
    pass


@pytest.mark.parametrize("step", ["parquet", "replace_small", "delete_path"])
def test_stopped_rebuild_leaves_the_old_or_the_new_table(spark, tmp_path, monkeypatch, step):
    from daybook.sources import warehouse as W
    wh = Warehouse(spark, str(tmp_path), key_index=True, key_buckets=2)
    wh.write_full("stg", frame(spark, [line("o1", 1, D1), line("o2", 1, D2)]), S.ORDER_DATE)
    wh.delete_insert("stg", frame(spark, [line("o3", 1, D1)]), S.ORDER_ID)  # builds the key index

    def stop(*a, **k):
        raise Stop
    with monkeypatch.context() as m:
        if step == "parquet":
            m.setattr(wh, "_switch", stop)  # data written, pointer not yet replaced
        else:
            m.setattr(W, step, stop)
        with pytest.raises(Stop):
            wh.write_full("stg", frame(spark, [line("o9", 1, D3)]), S.ORDER_DATE)
    new = step == "delete_path"
    assert wh.exists("stg")
    assert sorted(r.order_id for r in wh.read("stg").collect()) == (["o9"] if new else ["o1", "o2", "o3"])
    # An order moves: a stale or foreign index would leave it on both days.
    wh.delete_insert("stg", frame(spark, [line("o9" if new else "o1", 1, dt.date(2024, 5, 1))]), S.ORDER_ID)
    got = sorted((r.order_id, r.order_date.month) for r in wh.read("stg").collect())
    assert got == ([("o9", 5)] if new else [("o1", 5), ("o2", 3), ("o3", 3)])
    wh.write_full("stg", frame(spark, [line("o5", 1, D1)]), S.ORDER_DATE)
    assert len([x for x in os.listdir(wh.folder("stg")) if not x.startswith(("_", "."))]) == 1  # nothing left over


def test_half_built_index_is_not_trusted(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path), key_index=True, key_buckets=2)
    wh.write_full("stg", frame(spark, [line("a", 1, dt.date(2024, 1, 5)), line("b", 1, D1)]), S.ORDER_DATE)
    os.makedirs(f"{wh.folder('stg')}/keys-{wh.version('stg')}-b2")  # what a stopped build might leave
    assert not wh.has_key_index("stg")
    wh.delete_insert("stg", frame(spark, [line("a", 1, D3)]), S.ORDER_ID)
    assert keyset(wh.read("stg")) == [("a", 1, 10.0, D3), ("b", 1, 10.0, D1)]


def test_small_batch_keeps_the_index(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path), key_index=True, key_buckets=2)
    wh.write_full("stg", frame(spark, [line("a", 1, D1)]), S.ORDER_DATE)
    wh.delete_insert("stg", frame(spark, [line("b", 1, D1)]), S.ORDER_ID)
    plain = Warehouse(spark, str(tmp_path))  # a later session that doesn't ask for an index
    assert plain.has_key_index("stg")
    plain.delete_insert("stg", frame(spark, [line("c", 1, D2)]), S.ORDER_ID)
    assert plain.has_key_index("stg")
    plain.delete_insert("stg", frame(spark, [line("c", 1, dt.date(2024, 7, 1))]), S.ORDER_ID)
    assert keyset(plain.read("stg")) == [("a", 1, 10.0, D1), ("b", 1, 10.0, D1), ("c", 1, 10.0, dt.date(2024, 7, 1))]


def test_rewrite_join_can_split_a_hot_key(spark, tmp_path):
    """The plan that the upsert writes with, on a table where one key holds two thirds of the rows."""
    wh = Warehouse(spark, str(tmp_path))
    rows = spark.range(30_000).selectExpr(
        "date_add(DATE'2024-03-01', int(id % 8)) AS order_date", "IF(id % 3 > 0, 'hot', concat('o', id)) AS order_id", "uuid() AS buyer_id",
        "TIMESTAMP_NTZ'2024-03-01 09:00:00' AS order_timestamp", "id AS product_id", "1L AS quantity", "rand(1) AS unit_price",
        "rand(2) AS revenue", "'cash' AS payment_method")
    wh.write_full("stg", rows, S.ORDER_DATE)
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        stored = wh.read("stg")
        spark.range(0, 30_000, 3).selectExpr("concat('o', id) AS order_id").write.parquet(str(tmp_path / "keys"))  # stored keys
        joined = stored.join(spark.read.parquet(str(tmp_path / "keys")), S.ORDER_ID, "left_anti")
        assert len(joined.collect()) == 20_000
        assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_shared_folder_is_required_on_a_cluster():
    class Fake:
        class sparkContext:  # noqa: N801
            master = "spark://host:7077"

            @staticmethod
            def getCheckpointDir():
                return None

            @staticmethod
            def getConf():
                return {}
    with pytest.raises(RuntimeError):
        checkpoint_root(Fake)


def test_refused_setting_stops_the_session(spark):
    class Conf:
        def set(self, k, v):
            raise ValueError(k)

        def get(self, k, default=None):
            return "America/Lima"

    class Fake:
        conf = Conf()
    with pytest.raises(RuntimeError):
        apply_conf(Fake)
