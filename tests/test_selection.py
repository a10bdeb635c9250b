"""Exact percentiles by counting: against a sorted list, for any distribution."""

import math
import random
from fractions import Fraction

import pytest

from daybook.operators import selection
from daybook.operators.reports import line_statistics
from daybook.operators.selection import _cuts, _double, _position, exact_percentiles

FRACTIONS = (0.0, 0.01, 0.25, 0.5, 0.75, 0.999, 1.0)


def _plain(values, fraction):
    rows = sorted(v + 0.0 for v in values if v is not None and math.isfinite(v))
    if not rows:
        return None
    place = Fraction(fraction) * (len(rows) - 1)
    low, high = rows[math.floor(place)], rows[math.ceil(place)]
    return float(Fraction(low) + (Fraction(high) - Fraction(low)) * (place - math.floor(place)))


def _spread(rng):
    return rng.choice((-1, 1)) * 2.0 ** rng.uniform(-1000, 1000)


CASES = {
    "money": lambda r: [round(r.uniform(0.01, 90000), 2) for _ in range(3000)],
    "every_size": lambda r: [_spread(r) for _ in range(2000)],
    "one_value_dominates": lambda r: [7.25] * 2000 + [r.uniform(7, 8) for _ in range(500)],
    "neighbours": lambda r: [_double(_position(1.0) + r.randrange(50)) for _ in range(1000)],
    "extremes": lambda r: [1.7976931348623157e308, -1.7976931348623157e308, 5e-324, -5e-324, 0.0, -0.0, 1.0],
    "gaps": lambda r: [None, math.nan, math.inf, -math.inf, 3.5, -2.0, None],
    "one": lambda r: [42.0],
    "nothing": lambda r: [None, math.nan],
    "empty": lambda r: [],
}


@pytest.mark.parametrize("case", sorted(CASES))
def test_equals_the_sorted_list(spark, case):
    values = CASES[case](random.Random(case))
    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(5)
    assert exact_percentiles(df, ["v"], FRACTIONS)["v"] == [_plain(values, f) for f in FRACTIONS]


def test_measures_share_the_rounds(spark):
    rng = random.Random(5)
    rows = [(rng.randrange(50), rng.uniform(-1e6, 1e6), None if rng.random() < 0.3 else _spread(rng), "x") for _ in range(2000)]
    df = spark.createDataFrame(rows, "whole int, wide double, `odd.name` double, bin_0 string")
    df = df.withColumnRenamed("odd.name", "holes")
    found = exact_percentiles(df, ["whole", "wide", "holes"], FRACTIONS)
    for i, m in enumerate(("whole", "wide", "holes")):
        assert found[m] == [_plain([None if r[i] is None else float(r[i]) for r in rows], f) for f in FRACTIONS]


def test_few_cuts_give_the_same(spark, monkeypatch):
    monkeypatch.setattr(selection, "CUTS", 64)
    values = CASES["every_size"](random.Random(1))[:300]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    assert exact_percentiles(df, ["v"], (0.5,))["v"] == [_plain(values, 0.5)]


def test_cuts_hold_their_interval():
    for low, high in ((-1e300, 1e300), (-0.0, 5e-324), (1.0, _double(_position(1.0) + 3)), (-8.0, -2.0)):
        cuts = _cuts(low, high)
        assert cuts == sorted(set(cuts)) and cuts[0] == low and cuts[-1] > high
        assert len(cuts) <= selection.CUTS + 1


def test_counts_reach_the_driver_not_values(spark):
    """No plan of a round gathers values: what is collected is at most the intervals of the open ranks."""
    collected = []
    df = spark.range(20000).selectExpr("cast(id as double) * 1.37D as v")
    frame = type(df)
    plain = frame.collect

    def counting(self):
        rows = plain(self)
        collected.append(len(rows))
        return rows

    frame.collect = counting
    try:
        assert exact_percentiles(df, ["v"], (0.5,))["v"] == [_plain([i * 1.37 for i in range(20000)], 0.5)]
    finally:
        frame.collect = plain
    assert 2 <= len(collected) <= 7 and max(collected) <= selection.CUTS + 2


def test_line_statistics_of_an_empty_table(spark):
    df = spark.createDataFrame([], "quantity long, unit_price double, revenue double")
    rows = line_statistics(df).collect()
    assert [(r["measure"], r["count"]) for r in rows] == [("quantity", 0), ("unit_price", 0), ("revenue", 0)]
    assert all(r[c] is None for r in rows for c in ("mean", "std", "min", "p25", "p50", "p75", "max"))
