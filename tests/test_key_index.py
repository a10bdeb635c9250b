"""The bucketed key index of the staging upsert: same results, no shuffle of the history."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook import schemas as S
from daybook.sources.warehouse import INDEX_MONTH, Warehouse

SCHEMA = S.staging_schema(T.StringType())
DAYS = [dt.date(2024, 1, 30), dt.date(2024, 2, 3), dt.date(2024, 2, 4), dt.date(2024, 3, 1)]


def line(order, product, day, revenue=10.0):
    return (day, order, "b", dt.datetime.combine(day, dt.time(9)), product, 1, revenue, revenue, "cash")


def stored(wh):
    return sorted((r.order_id, r.product_id, r.revenue, r.order_date) for r in wh.read("stg").collect())


def scenario(spark, wh):
    wh.write_full("stg", spark.createDataFrame(
        [line("o1", 1, DAYS[0]), line("o1", 2, DAYS[0]), line("o2", 1, DAYS[1]), line("o3", 1, DAYS[2])], SCHEMA),
        S.ORDER_DATE)
    # o1 moves from January to March, o3 is restated, o4 is new
    wh.delete_insert("stg", spark.createDataFrame(
        [line("o1", 1, DAYS[3], 5.0), line("o3", 1, DAYS[2], 7.0), line("o4", 1, DAYS[3])], SCHEMA), S.ORDER_ID)
    return stored(wh)


WANT = [("o1", 1, 5.0, DAYS[3]), ("o2", 1, 10.0, DAYS[1]), ("o3", 1, 7.0, DAYS[2]), ("o4", 1, 10.0, DAYS[3])]


@pytest.mark.parametrize("path", ["index", "direct"])
def test_same_result_on_every_lookup_path(spark, tmp_path, path):
    wh = Warehouse(spark, str(tmp_path), key_index=(path == "index"), key_buckets=4)
    assert scenario(spark, wh) == WANT


def test_index_is_exact_after_upsert_and_reregisters(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path), key_index=True, key_buckets=4)
    scenario(spark, wh)
    tbl, n = wh.ensure_key_index("stg", S.ORDER_ID)
    assert n == 4
    pairs = sorted((r.key_hash, r.order_date) for r in spark.table(tbl).collect())
    keys = spark.createDataFrame([(o, d) for o, _, _, d in WANT], "k string, d date").select(F.xxhash64("k"), "d").distinct()
    assert pairs == sorted(tuple(r) for r in keys.collect())
    # a later session: the catalog entry is gone, the folder is found and registered again
    spark.sql(f"DROP TABLE {tbl}")
    wh2 = Warehouse(spark, str(tmp_path), key_index=True, key_buckets=16)  # bucket count from the folder
    tbl2, n2 = wh2.ensure_key_index("stg", S.ORDER_ID)
    assert (tbl2, n2) == (tbl, 4) and spark.table(tbl2).count() == len(pairs)
    wh2.delete_insert("stg", spark.createDataFrame([line("o2", 1, DAYS[3], 1.0)], SCHEMA), S.ORDER_ID)
    assert ("o2", 1, 1.0, DAYS[3]) in stored(wh2) and ("o2", 1, 10.0, DAYS[1]) not in stored(wh2)


def test_stale_index_pairs_are_harmless(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path), key_index=True, key_buckets=4)
    wh.write_full("stg", spark.createDataFrame([line("o1", 1, DAYS[0]), line("o2", 1, DAYS[1])], SCHEMA),
                  S.ORDER_DATE)
    tbl, n = wh.ensure_key_index("stg", S.ORDER_ID)
    stale = spark.createDataFrame([("o9", DAYS[0], DAYS[0].replace(day=1))], f"order_id string, order_date date, {INDEX_MONTH} date")
    stale = stale.select(F.xxhash64("order_id").alias("key_hash"), "order_date", INDEX_MONTH)
    stale.write.mode("append").insertInto(tbl)  # a pair with no stored row (as after an interrupted run)
    wh.delete_insert("stg", spark.createDataFrame([line("o9", 1, DAYS[2])], SCHEMA), S.ORDER_ID)
    assert stored(wh) == [("o1", 1, 10.0, DAYS[0]), ("o2", 1, 10.0, DAYS[1]), ("o9", 1, 10.0, DAYS[2])]


def test_history_lookup_does_not_shuffle_the_index(spark, tmp_path):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        wh = Warehouse(spark, str(tmp_path), key_index=True, key_buckets=4)
        wh.write_full("stg", spark.createDataFrame([line(f"o{i}", 1, DAYS[i % 4]) for i in range(40)], SCHEMA),
                      S.ORDER_DATE)
        tbl, n = wh.ensure_key_index("stg", S.ORDER_ID)
        keys = spark.createDataFrame([("o1",), ("o2",)], "order_id string").select(F.xxhash64("order_id").alias("key_hash"))
        keys = keys.repartition(n, "key_hash").distinct()
        q = spark.table(tbl).join(keys, "key_hash", "left_semi").select("order_date").distinct()
        plan = q._jdf.queryExecution().executedPlan().toString()
        assert "Bucketed: true" in plan
        # the index is the join's left child: nothing between the join and its scan may shuffle
        index_branch = plan[plan.index("SortMergeJoin"):plan.index(f"FileScan parquet spark_catalog.default.{tbl}")]
        assert "Exchange" not in index_branch
        assert "Exchange hashpartitioning(key_hash" in plan  # only the batch keys are shuffled
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
