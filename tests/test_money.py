"""Totals beyond the 9.2e12 that one bigint of millionths holds."""

import datetime as dt

from pyspark.sql import functions as F

from daybook.functions.money import money_sum
from daybook.operators import arrow, metrics, reports
from tests.test_edges import frame, line

DAYS = [dt.date(2024, 3, d) for d in (1, 2, 3, 4)]
LINES = [line(f"o{d.day}-{k}", 1, d, x) for d in DAYS for k, x in enumerate((4e12, 4.5e12, 4e12, 0.25, None))]
DAY = 12.5e12 + 0.25


def test_days_running_and_table_totals(spark):
    staged = frame(spark, LINES)
    days = metrics.daily_running_full(staged)
    got = sorted((r.order_date, r.daily_revenue, r.running_revenue) for r in days.collect())
    assert got == [(d, DAY, DAY * (k + 1)) for k, d in enumerate(DAYS)]
    more = metrics.daily_running_incremental(staged, days, DAYS[2]).collect()
    assert sorted((r.order_date, r.running_revenue) for r in more) == [(d, r) for d, _, r in got[1:]]
    assert reports.metric_overview(days).first().total_revenue == 4 * DAY
    assert reports.dataset_profile(staged).first().total_revenue == 4 * DAY
    assert reports.avg_order_value(staged).first().avg_order_value == 4 * DAY / 16


def test_arrow_variants(spark):
    staged = frame(spark, LINES)
    for days in (arrow.daily_metrics_batches(staged), arrow.daily_metrics_grouped(staged, buckets=2)):
        assert {r.order_date: r.daily_revenue for r in days.collect()} == dict.fromkeys(DAYS, DAY)


def test_parts_add_up_to_the_exact_sum(spark):
    values = [0.01, -0.01, 1.048576, -1.048576, 0.524288, -0.524288, 1.5e9, -7.25e9, 123456.789012, 0.000001, None, float("nan")]
    df = spark.createDataFrame([(x,) for x in values], "x double")
    want = df.filter(~F.isnan("x")).agg(F.sum(F.col("x").cast("decimal(38,6)")).cast("double")).first()[0]
    assert df.agg(money_sum("x")).first()[0] == want
    assert df.filter("x is null").agg(money_sum("x")).first()[0] is None
