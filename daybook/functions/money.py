"""Exact money arithmetic on JVM-side column expressions.

Summing money as doubles makes the last bits depend on the order in which partial sums meet, which
varies with partitioning.  Amounts are therefore summed as counts of a fixed unit, which is exact and
order-free.  The unit is ``10^-MONEY_DECIMALS``, four decimals finer than the two that money in the
data model carries, so parts of a cent add up too; anything finer is rounded per line.

A count is summed as two ``bigint`` parts, the multiple of ``2^LOW_BITS`` next to it and the rest,
which stays in the codegen'd long-arithmetic fast path (a ``decimal(28,6)`` aggregation buffer would
not: precision above 18 is stored as variable-length bytes).  The parts meet in a decimal after the
sum; sums of lines up to about 9.6e18 fit, over up to 1.7e13 lines.  Sums of a few rows (running
totals, totals over days) are formed in decimals and are bounded by 1e25.  Beyond either bound the
query fails, it never wraps.  The
final division is done on decimals and rounded to a double once, so results equal
``CAST(SUM(CAST(x AS DECIMAL(38,6))) AS DOUBLE)`` in any SQL engine.

NaN and infinite amounts are no amounts: sums skip them like NULL, and ``quality.rejected_rows``
reports them.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY_DECIMALS = 6
MONEY_SCALE = 10 ** MONEY_DECIMALS  # units per 1.0
LOW_BITS = 20


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def finite(c: Column | str) -> Column:
    """The amount, or NULL if it is NaN or infinite."""
    c = _col(c)
    return F.when(F.abs(c) < F.lit(float("inf")), c)


def to_units(c: Column | str) -> Column:
    """Amount -> exact bigint units (NULL stays NULL). ``rint`` is a plain Math.rint, unlike
    ``round`` which goes through BigDecimal per row."""
    return F.rint(finite(c) * MONEY_SCALE).cast("long")


def unit_parts(c: Column | str) -> tuple[Column, Column]:
    """Amount -> its units as two bigint parts, the multiples of ``2^LOW_BITS`` and the rest; every
    step is exact in doubles."""
    units = F.rint(finite(c) * MONEY_SCALE)
    high = F.rint(units * 2.0 ** -LOW_BITS)
    return high.cast("long"), (units - high * 2.0 ** LOW_BITS).cast("long")


def from_parts(high: Column, low: Column) -> Column:
    """Two parts, or their sums -> units as a decimal."""
    return high.cast("decimal(20,0)") * F.lit(Decimal(1 << LOW_BITS)) + low.cast("decimal(20,0)")


def wide_units(c: Column | str) -> Column:
    """Amount -> units as a decimal, whose sums have room for any total."""
    return from_parts(*unit_parts(c))


def from_units(c: Column | str) -> Column:
    return (_col(c).cast("decimal(31,0)") * F.lit(Decimal(1).scaleb(-MONEY_DECIMALS))).cast("double")


def money_sum(c: Column | str) -> Column:
    """SUM of a money column: NULLs skipped, all-NULL group gives NULL (SQL semantics)."""
    high, low = unit_parts(c)
    return from_units(from_parts(F.sum(high), F.sum(low)))


def round_stat(c: Column | str, digits: int = 6) -> Column:
    """Means, percentiles and deviations differ between engines in the last bits; round them."""
    return F.round(_col(c).cast("double"), digits)
