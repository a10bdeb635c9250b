from daybook.functions.dates import (
    DEFAULT_WINDOW_DAYS,
    date_lit,
    default_from_date,
    parse_date,
    partition_date,
)
from daybook.functions.money import from_units, money_sum, round_stat, to_units

__all__ = [
    "DEFAULT_WINDOW_DAYS",
    "date_lit",
    "default_from_date",
    "from_units",
    "money_sum",
    "parse_date",
    "partition_date",
    "round_stat",
    "to_units",
]
