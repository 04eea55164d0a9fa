"""Exact values at given ranks of a column, for all ranks together and without sorting it in one task.

A pass draws a bracket around every rank from approximate percentiles; the next one counts exactly what lies below,
on and inside each bracket. A rank that falls on a bound, whatever its number of repeats, is found; of a small bracket
the same pass also gives what is strictly inside; a large one is narrowed again, with those of the other ranks.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A bracket is read out when at most this many values are expected inside.
SORT_AT_MOST = 50_000
# Of approximate percentiles; a bracket spans four parts of it on either side of its rank, more than they can err.
ACCURACY, MARGIN = 10_000, 4


@dataclass
class _Search:
    """A wanted rank among the values strictly between two bounds (None: unbounded), ``total`` of them."""

    rank: int
    total: int
    low: float | None = None
    high: float | None = None
    value: float | None = None
    found: bool = False

    def inside(self) -> Column:
        v = F.col("v")
        above = v > F.lit(self.low) if self.low is not None else v.isNotNull()
        return above & (v < F.lit(self.high)) if self.high is not None else above


def shares_around(share: float) -> list[float]:
    """The percentages that bracket a share of the values."""
    return [max(0.0, share - MARGIN / ACCURACY), min(1.0, share + MARGIN / ACCURACY)]


def _narrowed(numbers: DataFrame, searches: list[_Search], edges: list[Sequence[float]]) -> None:
    """One pass for all searches: exact counts at their edges, and small brackets whole."""
    measures = []
    for i, (s, (low, high)) in enumerate(zip(searches, edges)):
        v, own = F.col("v"), s.inside()
        between = own & (v > F.lit(low)) & (v < F.lit(high))
        expected = s.total * 2 * (MARGIN + 1) / ACCURACY
        few = s.total <= SORT_AT_MOST or expected <= SORT_AT_MOST
        counts = [F.count_if(own & (v < F.lit(low))), F.count_if(own & (v <= F.lit(low))), F.count_if(between), F.count_if(own & (v <= F.lit(high)))]
        values = F.sort_array(F.collect_list(F.when(between, v))) if few else F.lit(None).cast("array<double>")
        inner = F.get(values, F.lit(s.rank) - counts[1])
        measures += [c.alias(f"{name}{i}") for name, c in zip("abcd", counts)] + [inner.alias(f"v{i}"), F.lit(few).alias(f"few{i}")]
    row = numbers.agg(*measures).first()
    for i, (s, (low, high)) in enumerate(zip(searches, edges)):
        below, upto_low, between, upto_high = (row[f"{name}{i}"] for name in "abcd")
        if below <= s.rank < upto_low:
            s.value, s.found = low, True
        elif upto_low <= s.rank < upto_low + between:
            if row[f"few{i}"]:
                s.value, s.found = row[f"v{i}"], True
            s.low, s.high, s.rank, s.total = low, high, s.rank - upto_low, between
        elif upto_low + between <= s.rank < upto_high:
            s.value, s.found = high, True
        elif s.rank < below:  # the percentiles erred by more than they promise
            s.high, s.total = low, below
        else:
            s.low, s.rank, s.total = high, s.rank - upto_high, s.total - upto_high


def _search(numbers: DataFrame, searches: list[_Search], edges: list[Sequence[float]] | None = None) -> list[float]:
    """The values found for all searches; ``edges`` are the first brackets if they are known."""
    left = searches
    while left:
        if edges is None:
            drawn = [F.percentile_approx(F.when(s.inside(), F.col("v")), shares_around(s.rank / s.total), ACCURACY) for s in left]
            edges = list(numbers.agg(*[d.alias(str(i)) for i, d in enumerate(drawn)]).first())
        _narrowed(numbers, left, edges)
        left, edges = [s for s in left if not s.found], None
    return [s.value for s in searches]


def _numbers(df: DataFrame, column: str) -> DataFrame:
    return df.select(F.col(column).cast("double").alias("v")).filter(F.col("v").isNotNull())


def values_at_ranks(df: DataFrame, column: str, ranks: Sequence[int]) -> list[float]:
    """The values at 0-based ``ranks`` of the non-null values in ascending order."""
    numbers = _numbers(df, column)
    total = numbers.count()
    for rank in ranks:
        if not 0 <= rank < total:
            raise ValueError(f"rank {rank} is outside 0..{total - 1}")
    return _search(numbers, [_Search(rank, total) for rank in ranks])


def bracket_measures(number: Column, shares: Sequence[float]) -> list[Column]:
    """Two aggregates of a column, ``filled_numbers`` and ``edges``, from which ``percentiles_in`` goes on. So the first pass
    can be that of other aggregates."""
    wanted = [x for share in shares for x in shares_around(share)]
    return [F.count(number).alias("filled_numbers"), F.percentile_approx(number, wanted, ACCURACY).alias("edges")]


def percentiles_in(df: DataFrame, column: str, shares: Sequence[float], filled: int, edges: Sequence[float]) -> list[float | None]:
    """The percentiles, given what ``bracket_measures`` found."""
    if not filled:
        return [None] * len(shares)
    searches, brackets = [], []
    for i, share in enumerate(shares):
        place = share * (filled - 1)
        searches += [_Search(math.floor(place), filled), _Search(math.ceil(place), filled)]
        brackets += [edges[2 * i : 2 * i + 2]] * 2
    found = _search(_numbers(df, column), searches, brackets)
    result = []
    for share, low, high in zip(shares, found[::2], found[1::2]):
        place = share * (filled - 1)
        result.append(low + (high - low) * (place - math.floor(place)) if high != low else low)
    return result


def percentiles(df: DataFrame, column: str, shares: Sequence[float]) -> list[float | None]:
    """The percentiles with linear interpolation between neighbours, all from the same passes; None of an empty column."""
    filled, edges = df.agg(*bracket_measures(F.col(column).cast("double"), shares)).first()
    return percentiles_in(df, column, shares, filled, edges)


def percentile(df: DataFrame, column: str, share: float) -> float | None:
    return percentiles(df, column, [share])[0]
