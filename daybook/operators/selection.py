"""Exact percentiles of large columns by narrowing a histogram.

``percentile`` and ``median`` keep a column's distinct values in one aggregation buffer: right for a
metric table with a row per day, not for order lines.  Here the value at a rank is found by counting.
The doubles between the smallest and the greatest value are cut into ``CUTS`` intervals of equally many
*representable* doubles (doubles are ordered like the integers of their bits); each round counts the
values per interval and goes on inside the interval that holds the rank, from its smallest to its
greatest value that occurs.  A round leaves 1/``CUTS`` of the representable values, so 64 bits take at
most seven rounds whatever the distribution, and an interval of one value ends at once, so ties cost
nothing.

A round is one scan that reads the measures, with map-side counts: at most ``CUTS + 2`` intervals a
rank reach a shuffle or the driver, never a value per row, and no task holds the column.  All ranks of
all measures share the rounds.  From the second round on only rows inside an open interval are counted,
and their range is a filter that a Parquet scan can push down.

Defined cases: NULL, NaN and infinite values take no part; -0.0 counts as 0.0; a measure without values
gives NULL for every percentile; an empty table is all such measures.  Integers and decimals are taken
as doubles.
"""

from __future__ import annotations

import bisect
import math
import struct
from collections.abc import Iterable, Sequence
from fractions import Fraction
from functools import reduce

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.functions.money import finite

CUTS = 1024
QUARTILES = (0.25, 0.5, 0.75)


def _position(x: float) -> int:
    """The place of a finite double among all doubles: an order-preserving integer."""
    bits = struct.unpack("<q", struct.pack("<d", x))[0]
    return bits if bits >= 0 else -(bits & 0x7FFFFFFFFFFFFFFF)


def _double(position: int) -> float:
    bits = position if position >= 0 else -position | (1 << 63)
    return struct.unpack("<d", struct.pack("<Q", bits))[0]


def _cuts(low: float, high: float) -> list[float]:
    """Ends of the intervals of [low, high]: low, about CUTS more, and the double after high."""
    first, last = _position(low), _position(high)
    inner = {first + (last + 1 - first) * i // CUTS for i in range(CUTS)}
    return [_double(p) for p in sorted(inner | {last + 1})]


def measure_values(measures: Iterable[str]) -> list[Column]:
    """The measures as finite doubles, everything else NULL."""
    return [(finite(F.col(m).cast("double")) + F.lit(0.0)).alias(m) for m in measures]


class _Search:
    """The ranks still sought in one measure: per open interval (low, high, values below it)."""

    def __init__(self, count: int, low: float, high: float, ranks: Iterable[int]):
        self.found: dict[int, float] = {}
        self.open: dict[tuple[float, float, int], list[int]] = {}
        for rank in set(ranks):
            self._place(rank, low, high, 0)

    def _place(self, rank: int, low: float, high: float, below: int) -> None:
        if low == high:
            self.found[rank] = low
        else:
            self.open.setdefault((low, high, below), []).append(rank)

    def splits(self) -> list[float]:
        ends = {c for low, high, _ in self.open for c in _cuts(low, high)}
        return [-math.inf, *sorted(e for e in ends if math.isfinite(e)), math.inf]

    def inside(self, value: Column) -> Column:
        return reduce(Column.__or__, [value.between(low, high) for low, high, _ in self.open])

    def narrow(self, bins: list[tuple[float, float, int]]) -> None:
        """``bins``: (smallest, greatest, count) of the counted intervals, ascending."""
        sought, self.open = self.open, {}
        starts = [b[0] for b in bins]
        for (low, high, below), ranks in sought.items():
            seen, at = below, bisect.bisect_left(starts, low)
            for rank in sorted(ranks):
                while seen + bins[at][2] <= rank:
                    seen += bins[at][2]
                    at += 1
                self._place(rank, bins[at][0], bins[at][1], seen)


def values_at(values: DataFrame, ranks: dict[str, tuple[int, float, float, Sequence[int]]]) -> dict[str, dict[int, float]]:
    """The values at ascending ``ranks`` (from 0): ``ranks`` gives per column of ``values`` (finite doubles
    or NULL) its count, smallest and greatest value, and the ranks sought."""
    searches = {m: _Search(*sought) for m, sought in ranks.items()}
    while active := {m: s for m, s in searches.items() if s.open}:
        names = list(active)
        rows = values.filter(reduce(Column.__or__, [s.inside(F.col(m)) for m, s in active.items()]))
        binned = Bucketizer(inputCols=names, outputCols=[f"bin_{i}" for i in range(len(names))],
                            splitsArray=[active[m].splits() for m in names]).transform(rows.select(*names))
        pairs = F.array(*[F.struct(F.lit(i).alias("measure"), F.col(f"bin_{i}").alias("bin"),
                                   F.when(active[m].inside(F.col(m)), F.col(m)).alias("value"))
                          for i, m in enumerate(names)])
        counted = (binned.select(F.inline(pairs)).filter(F.col("value").isNotNull()).groupBy("measure", "bin")
                   .agg(F.min("value").alias("low"), F.max("value").alias("high"), F.count("value").alias("n")).collect())
        for i, m in enumerate(names):
            active[m].narrow(sorted((r.low, r.high, r.n) for r in counted if r.measure == i))
    return {m: s.found for m, s in searches.items()}


def _ends(fraction: float, count: int) -> tuple[int, int, Fraction]:
    """The two ranks that a percentile lies between, and how far it is from the first."""
    place = Fraction(fraction) * (count - 1)
    low = math.floor(place)
    return low, math.ceil(place), place - low


def exact_percentiles(df: DataFrame, measures: Sequence[str], fractions: Sequence[float] = QUARTILES,
                      extents: dict[str, tuple[int, float, float]] | None = None) -> dict[str, list[float | None]]:
    """Interpolated percentiles (``percentile_cont``) of each measure, in the order of ``fractions``.
    ``extents``: count, smallest and greatest value per measure where the caller has them; else one
    more scan finds them."""
    values = df.select(*measure_values(measures))
    if extents is None:
        row = values.agg(*[f(m).alias(f"{name}_{i}") for i, m in enumerate(measures)
                           for name, f in (("n", F.count), ("low", F.min), ("high", F.max))]).first()
        extents = {m: (row[f"n_{i}"], row[f"low_{i}"], row[f"high_{i}"]) for i, m in enumerate(measures)}
    sought = {m: (*extents[m], [r for f in fractions for r in _ends(f, extents[m][0])[:2]])
              for m in measures if extents[m][0]}
    found = values_at(values, sought)

    def percentile(m: str, fraction: float) -> float | None:
        if m not in found:
            return None
        low, high, share = _ends(fraction, extents[m][0])
        a, b = found[m][low], found[m][high]
        return a if a == b else float(Fraction(a) + (Fraction(b) - Fraction(a)) * share)

    return {m: [percentile(m, f) for f in fractions] for m in measures}
