"""Date parameters and date expressions.

Operators never read the clock: ``from_date`` is an explicit argument.  ``default_from_date`` is the
project default (run date minus 14 days), evaluated on the driver when a caller asks for it.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: length of the sliding reprocess window, in days (run date minus 14, inclusive).
DEFAULT_WINDOW_DAYS = 14

DateLike = "str | dt.date | dt.datetime"


def parse_date(value) -> dt.date:
    """'YYYY-MM-DD', date or datetime -> date."""
    if isinstance(value, dt.datetime):
        return value.date()
    if isinstance(value, dt.date):
        return value
    return dt.date.fromisoformat(str(value)[:10])


def default_from_date(today: dt.date | None = None, window_days: int = DEFAULT_WINDOW_DAYS) -> dt.date:
    today = today or dt.date.today()
    return today - dt.timedelta(days=window_days)


def date_lit(value) -> Column:
    return F.lit(parse_date(value))


def partition_date(year: str = "year", month: str = "month", day: str = "date") -> Column:
    """Calendar date of a Hive ``year=/month=/date=`` partition; only partition columns, so a filter
    on it is evaluated against directory names (partition pruning) and never touches file data."""
    return F.make_date(F.col(year), F.col(month), F.col(day))
