"""Daily revenue metrics: the three versions of the reference's metric model.

Aggregation plan (checked with ``explain``): ``SUM`` plus one ``COUNT(DISTINCT)`` is planned by
Catalyst as partial aggregate on ``(order_date, order_id)`` -> shuffle on that pair -> merge ->
partial on ``order_date`` -> shuffle on the day -> final.  With two distinct counts (v3) Catalyst
adds an ``Expand`` and the first shuffle is on ``(order_date, key, group id)``.  Either way the
first, large shuffle is keyed by the *pair*, never by the day alone, so a day holding a third of all
rows is spread over all reducers; the second shuffle carries at most one row per day per map task.

Running totals (W1/W2) are a window with no ``PARTITION BY``: it runs in one task, which is fine and
deliberate because its input is the aggregated day series (one row per calendar day; about 3,650
rows for ten years, independent of data volume).  Never apply it to line items.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daybook import schemas as S
from daybook.functions.dates import date_lit
from daybook.functions.money import from_units, money_sum, wide_units

SEED_RULES = ("latest", "exact")


def in_window(staged: DataFrame, from_date=None) -> DataFrame:
    if from_date is None:
        return staged
    return staged.filter(F.col(S.ORDER_DATE) >= date_lit(from_date))


def daily_revenue(staged: DataFrame, from_date=None) -> DataFrame:
    """v1/v2: (order_date, daily_revenue, daily_orders)."""
    return (
        in_window(staged, from_date)
        .groupBy(S.ORDER_DATE)
        .agg(
            money_sum(S.REVENUE).alias(S.DAILY_REVENUE),
            F.count_distinct(S.ORDER_ID).alias(S.DAILY_ORDERS),
        )
    )


def daily_metrics(staged: DataFrame, from_date=None) -> DataFrame:
    """v3 base: (order_date, daily_revenue, daily_orders, daily_buyers)."""
    return (
        in_window(staged, from_date)
        .groupBy(S.ORDER_DATE)
        .agg(
            money_sum(S.REVENUE).alias(S.DAILY_REVENUE),
            F.count_distinct(S.ORDER_ID).alias(S.DAILY_ORDERS),
            F.count_distinct(S.BUYER_ID).alias(S.DAILY_BUYERS),
        )
    )


def _cumulative(days: DataFrame, measure: str) -> Column:
    w = Window.orderBy(S.ORDER_DATE).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return from_units(F.sum(wide_units(measure)).over(w))


def running_total(days: DataFrame) -> DataFrame:
    """W1: cumulative daily revenue over the whole day series."""
    return days.select(*[F.col(c) for c in S.RUNNING_COLUMNS[:-1]],
                       _cumulative(days, S.DAILY_REVENUE).alias(S.RUNNING_REVENUE))


def select_seed(target: DataFrame, from_date, rule: str = "latest") -> DataFrame:
    """The stored row the running total continues from.

    ``exact``: the row at ``from_date - 1`` only (the reference's rule; with no sales that day the
    total restarts at zero).  ``latest``: the newest stored row before ``from_date``, which also
    bridges gaps in the calendar.  Both select from the metric table (one row per day).
    """
    d = date_lit(from_date)
    cols = [F.col(c) for c in S.RUNNING_COLUMNS]
    if rule == "exact":
        return target.filter(F.col(S.ORDER_DATE) == F.date_sub(d, 1)).select(*cols)
    if rule == "latest":
        return (target.filter(F.col(S.ORDER_DATE) < d)
                .orderBy(F.col(S.ORDER_DATE).desc()).limit(1).select(*cols))
    raise ValueError(f"seed rule must be one of {SEED_RULES}, got {rule!r}")


def seeded_running_total(new_days: DataFrame, seed: DataFrame) -> DataFrame:
    """W2: the window's days carry ``running_revenue = daily_revenue``, the seed row its stored
    total; union by name (the two sides list columns in different orders), then cumulate."""
    fresh = new_days.withColumn(S.RUNNING_REVENUE, F.col(S.DAILY_REVENUE))
    combined = fresh.unionByName(seed.select(*S.RUNNING_COLUMNS))
    return combined.select(*[F.col(c) for c in S.RUNNING_COLUMNS[:-1]],
                           _cumulative(combined, S.RUNNING_REVENUE).alias(S.RUNNING_REVENUE))


def daily_running_full(staged: DataFrame) -> DataFrame:
    """v3, first run or full refresh."""
    return running_total(daily_metrics(staged))


def daily_running_incremental(staged: DataFrame, target: DataFrame, from_date, seed: str = "latest") -> DataFrame:
    """v3, incremental: recompute whole days from ``from_date`` (distinct counts cannot be added to
    stored values), continue the running total from the seed row.  The output re-emits the seed."""
    return seeded_running_total(daily_metrics(staged, from_date), select_seed(target, from_date, seed))


def continuity_view(staged: DataFrame, target: DataFrame, from_date, seed: str = "exact") -> DataFrame:
    """Dashboard check: the seed row and the window's fresh days side by side (three columns),
    before the running total is re-derived."""
    cols = [S.ORDER_DATE, S.DAILY_REVENUE, S.RUNNING_REVENUE]
    fresh = daily_metrics(staged, from_date).withColumn(S.RUNNING_REVENUE, F.col(S.DAILY_REVENUE))
    return select_seed(target, from_date, seed).select(*cols).unionByName(fresh.select(*cols))
