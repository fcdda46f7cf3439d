"""Exact quantiles of columns of any length.

The built-in exact percentile keeps every distinct value of a column in one
task. Here approximate quantiles, whose rank error is bounded, only narrow the
value range that holds the wanted rank; counts decide exactly. Each round is one
aggregate over the pruned columns and shrinks a range several hundred times, so two
or three scans suffice for any table, and only a small rest is ever sorted.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from math import ceil, floor

from pyspark.sql import Column, DataFrame, functions as F

from catalog_star.functions import values

SMALL_RANGE = 20_000  # values one task may sort; has no influence on results
GRID = 501  # steps between approximate quantiles; odd, so that quartiles fall between them
ACCURACY = 5 * GRID


@dataclass
class _Search:
    """A wanted rank (from 0), and proven limits between which its value lies.

    ``first`` is the rank of the first value above ``low``, ``inside`` the number of
    values strictly between the limits; a limit of None is open. ``trial`` holds two
    estimated values within the limits, to be checked by counting.
    """

    column: str
    rank: int
    inside: int
    first: int = 0
    low: float | None = None
    high: float | None = None
    trial: tuple[float, float] | None = None
    found: float | None = None

    def task(self) -> tuple:
        """What the next round computes; equal tasks are computed once."""
        return (self.column, *(self.trial or (self.low, self.high)), self.trial is not None)

    def estimate(self, grid: list[float]) -> None:
        """Try the approximate quantiles on both sides of the rank."""
        step = floor((self.rank - self.first) / max(self.inside - 1, 1) * GRID)
        self.trial = (grid[max(step - 1, 0)], grid[min(step + 2, GRID)])

    def check(self, below: int, at_low: int, between: int, at_high: int) -> bool:
        """Move the limits to the part that holds the rank; true if it is the middle one."""
        low, high = self.trial
        self.trial = None
        end = self.first + self.inside
        starts = [self.first, below, below + at_low, below + at_low + between, below + at_low + between + at_high]
        part = max(i for i, start in enumerate(starts) if start <= self.rank)
        if part == 0:
            self.high, self.inside = low, below - self.first
        elif part == 1:
            self.found = low
        elif part == 2:
            self.low, self.high, self.first, self.inside = low, high, starts[2], between
        elif part == 3:
            self.found = high
        else:
            self.low, self.first, self.inside = high, starts[4], end - starts[4]
        return part == 2


def _value(column: str) -> Column:
    return values.ignore_nan(F.col(column).cast("double"))


def _between(column: str, low: float | None, high: float | None) -> Column:
    v = _value(column)
    if low is not None:
        v = F.when(_value(column) > low, v)
    if high is not None:
        v = F.when(_value(column) < high, v)
    return v


def _round(df: DataFrame, searches: list[_Search]) -> None:
    """One aggregate that counts around every trial and estimates within every range.

    A trial's two values are settled by their own counts, and the parts around them
    shrink, so each round makes progress even if a few values fill most rows or an
    estimate misses. A range that is likely to stay large is estimated in the same pass.
    """
    aggregates = []
    fractions = F.lit([i / GRID for i in range(GRID + 1)])
    tasks = {s.task(): s for s in searches}
    for n, ((column, low, high, counting), s) in enumerate(tasks.items()):
        inner = _between(column, low, high)
        if counting:
            v = _value(column)
            aggregates += [
                F.count_if(v < low).alias(f"below_{n}"),
                F.count_if(v == low).alias(f"at_low_{n}"),
                F.count(inner).alias(f"between_{n}"),
                (F.count_if(v == high) if low != high else F.lit(0)).cast("long").alias(f"at_high_{n}"),
            ]
        if not counting or s.inside * 3 / GRID > SMALL_RANGE / 2:
            aggregates.append(F.percentile_approx(inner, fractions, ACCURACY).alias(f"grid_{n}"))
    row = df.agg(*aggregates).first().asDict()
    position = {task: n for n, task in enumerate(tasks)}
    for s in searches:
        n = position[s.task()]
        grid = row.get(f"grid_{n}")
        if s.trial:
            middle = s.check(*(row[f"{part}_{n}"] for part in ("below", "at_low", "between", "at_high")))
            grid = grid if middle else None
        if grid and s.found is None and s.inside > SMALL_RANGE:
            s.estimate(grid)


def _pick(df: DataFrame, searches: list[_Search]) -> None:
    """Read the wanted values off ranges that are small enough to sort."""
    ranges = list(dict.fromkeys((s.column, s.low, s.high) for s in searches))
    sorted_values = [F.array_sort(F.collect_list(_between(*r))).alias(f"r_{n}") for n, r in enumerate(ranges)]
    wanted = [
        F.get(f"r_{ranges.index((s.column, s.low, s.high))}", F.lit(s.rank - s.first)).alias(f"v_{n}")
        for n, s in enumerate(searches)
    ]
    row = df.agg(*sorted_values).select(*wanted).first()
    for n, s in enumerate(searches):
        s.found = row[f"v_{n}"]


def exact_quantiles(
    df: DataFrame, counts: dict[str, int], fractions: Sequence[float]
) -> dict[str, list[float | None]]:
    """Linearly interpolated quantiles per column.

    ``counts`` holds each column's number of values (neither null nor NaN).
    """
    searches: dict[tuple[str, int], _Search] = {}
    for column, n in counts.items():
        for f in fractions if n else ():
            for rank in (floor((n - 1) * f), ceil((n - 1) * f)):
                searches.setdefault((column, rank), _Search(column, rank, n))
    while open_searches := [s for s in searches.values() if s.found is None]:
        large = [s for s in open_searches if s.trial or s.inside > SMALL_RANGE]
        if large:
            _round(df, large)
        else:
            _pick(df, open_searches)

    def interpolate(column: str, f: float) -> float | None:
        n = counts[column]
        if not n:
            return None
        place = (n - 1) * f
        low = searches[column, floor(place)].found
        high = searches[column, ceil(place)].found
        return low + (high - low) * (place - floor(place))

    return {c: [interpolate(c, f) for f in fractions] for c in counts}
