"""Figures that an incremental staging run observes while it writes, against the reports of their own pass."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from daybook import schemas as S
from daybook.operators import quality, staging
from daybook.operators.export import partitioned_export
from daybook.plans.runs import Project
from daybook.sources import adapters as A
from daybook.sources.ledger import SourceLedger
from daybook.sources.transactions import read_transactions, window_rows
from tests.conftest import SF_SMALL

FROM = "2024-03-01"
ROWS = [  # order, buyer, timestamp, product, quantity, unit price, revenue, method
    ("a", "x", dt.datetime(2024, 3, 1), 1, 2, 5.0, 10.0, "card"),
    ("a", "x", dt.datetime(2024, 3, 1, 23, 59), 1, 2, 5.0, 10.0, "card"),
    ("b", None, dt.datetime(2024, 3, 2), None, 1, 5.0, -5.0, None),
    ("c", "y", dt.datetime(2024, 3, 5), 1, 1, 5.0, None, "card"),
    (None, "y", dt.datetime(2024, 3, 6), 1, 3, 5.0, 15.001, "card"),
    ("d", "y", dt.datetime(2024, 3, 6), 1, 3, 5.0, math.nan, "card"),
    ("e", "y", dt.datetime(2024, 2, 29), 1, 1, 5.0, 5.0, "card"),
    ("f", "y", None, 1, 1, 5.0, 5.0, "card"),
]
SHAPE = ("order_id string, buyer_id string, order_timestamp timestamp_ntz, product_id long, quantity long, "
         "unit_price double, revenue double, payment_method string")


def source(spark, rows=ROWS):
    return spark.createDataFrame(rows, SHAPE).withColumn(S.ORDER_DATE, F.to_date(S.ORDER_TS))


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def watched(src, path, from_date=FROM):
    watch = quality.BatchWatch(window_rows(src, from_date), "stg_orders_v2", from_date)
    staging.stage_v2(watch.rows, from_date).write.parquet(str(path))
    return watch


def check(src, watch, from_date=FROM):
    window = window_rows(src, from_date)
    assert rows(watch.preview()) == rows(quality.preview_source(window, [("stg_orders_v2", "incremental", from_date)]))
    assert rows(watch.rejected()) == rows(quality.rejected_rows(window))
    staged = staging.stage_v2(src, from_date)
    assert rows(watch.not_null()) == rows(quality.null_counts(staged, "stg_orders_v2", quality.NOT_NULL_CHECKS["stg_orders_v2"]))


@pytest.mark.parametrize("case", ["flawed", "empty", "before"])
def test_equals_the_reports(spark, tmp_path, case):
    src = source(spark, {"flawed": ROWS, "empty": [], "before": ROWS[-2:]}[case]).repartition(3)
    watch = watched(src, tmp_path / "batch")
    check(src, watch)
    assert watch.misplaced is None
    assert watch.figures["rows"] == {"flawed": 6, "empty": 0, "before": 0}[case]


def test_days_beyond_the_bitmap(spark, tmp_path):
    far = [("z", "y", dt.datetime(2024, 3, 1) + dt.timedelta(days=n), 1, 1, 5.0, 5.0, "card") for n in (32_767, 32_768, 60_000, 60_000)]
    near = source(spark, ROWS + far[:1])
    check(near, watched(near, tmp_path / "near"))
    src = source(spark, ROWS + far)
    watch = watched(src, tmp_path / "far")
    assert watch.figures["far"] == 3
    check(src, watch)


def test_a_run_reads_its_window_once(spark, tmp_path):
    """One call of the source, and its files' rows pass through the plan once."""
    path = str(tmp_path / "src")
    partitioned_export(A.events_source(spark, SF_SMALL), path)
    asked, seen = [], spark.sparkContext.accumulator(0)

    def feed(from_date):
        asked.append(from_date)
        src = read_transactions(spark, path, from_date, day_aligned=True)

        def counted(batches):
            for b in batches:
                seen.add(b.num_rows)
                yield b
        return src.mapInArrow(counted, src.schema) if from_date else src

    project = Project(spark, feed, str(tmp_path / "wh"), day_aligned=True)
    project.run_model("stg_orders_v2")
    asked.clear()
    report = project.run_model("stg_orders_v2", from_date=A.EVENTS_FROM_DATE, preview=True)
    window = read_transactions(spark, path, A.EVENTS_FROM_DATE)
    assert asked == [A.EVENTS_FROM_DATE] and seen.value == window.count() > 0
    assert report.misplaced_rows == 0
    assert rows(report.preview) == rows(quality.preview_source(window, [("stg_orders_v2", "incremental", A.EVENTS_FROM_DATE)]))
    assert rows(report.rejected) == rows(quality.rejected_rows(window))
    assert all(r.passed for r in report.not_null.collect()) and report.not_null.count() == 9


def test_the_ledger_sees_rows_that_pruning_hides(spark, tmp_path):
    src = source(spark, [r for r in ROWS if r[0] in ("a", "c", "e", "f")])
    folder = {"a": (2024, 3, 1), "c": (2024, 2, 5), "e": (None, None, None), "f": (2024, 3, 1)}
    placed = src.join(spark.createDataFrame([(k, *v) for k, v in folder.items()], "order_id string, year int, month int, date int"), "order_id")
    path = str(tmp_path / "a src")
    placed.repartition(1).write.partitionBy(*S.PARTITION_KEYS).parquet(path)
    ledger = SourceLedger(spark, path, str(tmp_path / "wh"))
    ledger.refresh()
    assert rows(ledger.misplaced(FROM)) == [(dt.date(2024, 2, 29), 1, 0), (dt.date(2024, 3, 5), 1, 1)]
    pruned = read_transactions(spark, path, FROM, day_aligned=True)
    assert {r.order_id for r in pruned.collect()} == {"a"}  # the hidden row is lost there
    assert ledger.misplaced("2024-02-01").agg(F.sum("hidden_rows")).first()[0] == 0
