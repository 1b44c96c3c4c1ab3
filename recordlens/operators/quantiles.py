"""Exact quantiles of a column of any size, by narrowing brackets."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

IN_MEMORY_VALUES = 1_000_000
ACCURACY = 10_000
# Splitters are asked for at these distances from the wanted share of a bracket.
DISTANCES = (0.0, 0.0002, 0.0004, 0.002, 0.01, 0.1)


@dataclass
class _Bracket:
    """The ``count`` values between ``under`` and ``over``, one with the wanted rank."""

    rank: int
    count: int
    under: float | None = None
    over: float | None = None
    answer: float | None = None

    def inside(self) -> Column:
        """Whether x lies in the bracket; its ends do not."""
        inside = F.lit(True)
        if self.under is not None:
            inside = inside & (F.col("x") > F.lit(self.under))
        if self.over is not None:
            inside = inside & (F.col("x") < F.lit(self.over))
        return inside

    def values(self) -> Column:
        """x where it lies in the bracket, else null."""
        return F.when(self.inside(), F.col("x"))

    def splitters(self) -> Column:
        """Aggregate: approximate values around the wanted rank, and both extremes."""
        share = self.rank / self.count
        near = {min(max(share + s * d, 0.0), 1.0) for d in DISTANCES for s in (-1, 1)}
        values = self.values()
        approximate = F.percentile_approx(values, sorted(near), ACCURACY)
        return F.array_sort(
            F.array_distinct(F.concat(approximate, F.array(F.min(values), F.max(values))))
        )

    def counts(self, splitters: list[float]) -> Column:
        """Aggregate: how many values lie below, and how many up to, each splitter."""
        values = self.values()
        return F.array(
            *(
                F.array(F.count_if(values < F.lit(s)), F.count_if(values <= F.lit(s)))
                for s in splitters
            )
        )

    def narrow(self, splitters: list[float], counts: list[list[int]]) -> None:
        """Take the splitter that has the rank, or go on between two neighbours."""
        at = next(i for i, (_, upto) in enumerate(counts) if upto >= self.rank)
        below = counts[at][0]
        if below < self.rank:
            self.answer = splitters[at]
            return
        skipped = counts[at - 1][1]
        self.under, self.over = splitters[at - 1], splitters[at]
        self.rank, self.count = self.rank - skipped, below - skipped


def exact_quantiles(
    df: DataFrame,
    x: Column,
    probabilities: Sequence[float],
    *,
    in_memory: int = IN_MEMORY_VALUES,
) -> list[float | None]:
    """For each share p the smallest value of ``x`` that a share p does not exceed.

    Spark's own exact percentile holds every distinct value in one task. Here each
    round asks for approximate splitters around the wanted ranks, counts exactly
    how many values lie at or below each of them, and goes on inside the brackets
    that hold the ranks, until a splitter has the rank itself, as a frequent value
    soon does, or at most ``in_memory`` values are left. All shares go through the same jobs, two per round. Only a few numbers
    reach the driver, and the answers are exact however good the splitters are.

    Args:
        df: Input rows.
        x: Numeric expression; nulls are ignored. Values are compared as doubles, so
            whole numbers beyond 2**53 and long decimals are rounded first.
        probabilities: The wanted shares, each from 0 to 1.
        in_memory: How many values one task may sort at the end.

    Returns:
        One value per share, all ``None`` if ``x`` has no values.
    """
    values = df.select(x.cast("double").alias("x")).filter(F.col("x").isNotNull())
    n = values.count()
    if n == 0:
        return [None] * len(probabilities)
    brackets = [_Bracket(min(max(math.ceil(p * n), 1), n), n) for p in probabilities]

    def ask(about: list[_Bracket], *aggregates: Column):
        within = reduce(or_, (b.inside() for b in about))
        return values.filter(within).agg(*aggregates).first()

    while wide := [b for b in brackets if b.answer is None and b.count > in_memory]:
        splitters = ask(wide, *(b.splitters() for b in wide))
        counts = ask(wide, *(b.counts(s) for b, s in zip(wide, splitters)))
        for bracket, points, counted in zip(wide, splitters, counts):
            bracket.narrow(points, counted)

    small = [b for b in brackets if b.answer is None]
    if small:
        columns = {f"v{i}": b for i, b in enumerate(small)}
        found = (
            values.filter(reduce(or_, (b.inside() for b in small)))
            .select(*(b.values().alias(c) for c, b in columns.items()))
            .agg(*(_value_at(c, b) for c, b in columns.items()))
            .first()
        )
        for bracket, answer in zip(small, found):
            bracket.answer = answer
    return [b.answer for b in brackets]


def _value_at(column: str, bracket: _Bracket) -> Column:
    """Aggregate: the value with the bracket's rank among all values of ``column``."""
    share = (bracket.rank - 0.5) / bracket.count
    return F.expr(f"percentile_disc({share!r}D) WITHIN GROUP (ORDER BY {column})")
