"""Day-partitioned tables: the days of one write change together, and the day list keeps the schema."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook import schemas as S
from daybook.sources import warehouse as W
from daybook.sources.warehouse import Warehouse

DAY = [dt.date(2024, 3, d) for d in range(1, 8)]
SCHEMA = T.StructType([T.StructField(S.ORDER_ID, T.StringType()), T.StructField(S.ORDER_DATE, T.DateType()),
                       T.StructField(S.REVENUE, T.DoubleType())])
OLD = [("o1", DAY[0], 1.0), ("o2", DAY[0], 2.0), ("o3", DAY[1], 3.0), ("o4", None, 4.0), (None, DAY[2], 5.0)]
#: o1 and o2 leave their day empty, o3 moves, o4 gets a day, o6 has none.
BATCH = [("o1", DAY[3], 10.0), ("o2", DAY[3], 20.0), ("o3", DAY[2], 30.0), ("o4", DAY[1], 40.0), ("o6", None, 60.0)]
NEW = BATCH + [(None, DAY[2], 5.0)]


class Stop(Exception):
    pass


def rows(df):
    return sorted(map(tuple, df.select(*SCHEMA.names).collect()), key=str)


def table(spark, root, **kw):
    wh = Warehouse(spark, str(root), **kw)
    wh.write_full("stg", spark.createDataFrame(OLD, SCHEMA), S.ORDER_DATE)
    return wh


def upsert(spark, wh, batch=BATCH):
    return wh.delete_insert("stg", spark.createDataFrame(batch, SCHEMA), S.ORDER_ID)


def folders(wh):
    root = wh.path("stg")
    return {(d, r) for d in os.listdir(root) if d.startswith("order_date=") for r in os.listdir(f"{root}/{d}") if "=" in r}


def named(wh):
    return {(f"order_date={v}", f"{W.REVISION}={r}") for v, held in wh.stored("stg").days.revisions.items() for r in held}


@pytest.mark.parametrize("key_index", [False, True])
def test_days_change_together_wherever_a_write_stops(spark, tmp_path, monkeypatch, key_index):
    """Every call that touches a file is, in turn, the one at which the write stops."""
    stopped = 0
    for step in range(100):
        wh = table(spark, tmp_path / str(step), key_index=key_index, key_buckets=2)
        calls = iter(range(step, -1, -1))

        def counted(fn, calls=calls):
            def call(*a, **k):
                if next(calls, 0) == 0:
                    raise Stop
                return fn(*a, **k)
            return call
        with monkeypatch.context() as m:
            for owner, name in ((W, "replace_small"), (W, "path_exists"), (W, "delete_path"), (wh, "_write_days")):
                m.setattr(owner, name, counted(getattr(owner, name)))
            try:
                upsert(spark, wh)
            except Stop:
                stopped += 1
            else:
                break
        got = rows(wh.read("stg"))
        assert got in (rows(spark.createDataFrame(OLD, SCHEMA)), rows(spark.createDataFrame(NEW, SCHEMA))), step
        # Run again: the result is the new table, and two writes on nothing else is left.
        upsert(spark, wh)
        assert rows(wh.read("stg")) == rows(spark.createDataFrame(NEW, SCHEMA))
        if step % 5 == 0:
            upsert(spark, wh)
            wh._clear(wh.stored("stg"))
            assert folders(wh) == named(wh)
            assert [x for x in os.listdir(wh.path("stg")) if x.startswith(W.DAYS)] != []
    assert stopped > 5


def test_a_reader_that_began_before_the_write_sees_no_mix(spark, tmp_path):
    wh = table(spark, tmp_path)
    before = wh.read("stg")
    res = upsert(spark, wh)
    assert (res.partitions_written, res.partitions_dropped) == (4, 1)
    assert rows(before) == rows(spark.createDataFrame(OLD, SCHEMA))
    assert rows(wh.read("stg")) == rows(spark.createDataFrame(NEW, SCHEMA))
    assert wh.days("stg") == [DAY[1], DAY[2], DAY[3], None]


def test_added_columns_come_from_the_list_without_opening_a_file(spark, tmp_path):
    wh = table(spark, tmp_path)
    batch = spark.createDataFrame([("o9", DAY[4], 9.0)], SCHEMA)
    wh.delete_insert("stg", batch.withColumn("channel", F.lit("web")), S.ORDER_ID)
    wh.delete_insert("stg", batch.withColumn(S.ORDER_ID, F.lit("o8")), S.ORDER_ID)  # lacks the column: it stays
    sc = spark.sparkContext
    sc.setJobGroup("footers", "reading a table")
    try:
        df = wh.read("stg", merge_schema=True)
        assert list(sc.statusTracker().getJobIdsForGroup("footers")) == []
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    assert {r.order_id: r.channel for r in df.collect()} == {"o1": None, "o2": None, "o3": None, "o4": None, None: None,
                                                              "o9": "web", "o8": None}


def test_a_column_of_another_type_is_refused_before_anything_is_written(spark, tmp_path):
    wh = table(spark, tmp_path)
    batch = spark.createDataFrame([("o1", DAY[4], "ten")], "order_id string, order_date date, revenue string")
    before = folders(wh)
    for write in (lambda: wh.delete_insert("stg", batch, S.ORDER_ID), lambda: wh.replace_days("stg", batch, S.ORDER_DATE)):
        with pytest.raises(TypeError, match="revenue is double in the table, string in the batch"):
            write()
    assert folders(wh) == before and rows(wh.read("stg")) == rows(spark.createDataFrame(OLD, SCHEMA))
    with pytest.raises(ValueError, match="partitioned by order_date"):
        wh.write_full("stg", batch, "revenue")


def test_empty_tables_and_windows(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path))
    wh.write_full("stg", spark.createDataFrame([], SCHEMA), S.ORDER_DATE)
    assert wh.days("stg") == [] and wh.read("stg").collect() == [] and set(wh.read("stg").columns) == set(SCHEMA.names)
    upsert(spark, wh, OLD)
    assert rows(wh.read("stg")) == rows(spark.createDataFrame(OLD, SCHEMA))
    assert wh.read("stg", from_date="2030-01-01").collect() == []
    assert rows(wh.read("stg", days=[None, DAY[1]])) == [("o3", DAY[1], 3.0), ("o4", None, 4.0)]


def test_replaced_days_of_a_partitioned_table(spark, tmp_path):
    wh = table(spark, tmp_path)
    wh.replace_days("stg", spark.createDataFrame([("x", DAY[0], 7.0), ("y", None, 8.0)], SCHEMA), S.ORDER_DATE)
    assert rows(wh.read("stg")) == sorted([("x", DAY[0], 7.0), ("y", None, 8.0), ("o3", DAY[1], 3.0), (None, DAY[2], 5.0)], key=str)
