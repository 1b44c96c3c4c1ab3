"""Summaries that are stored and merged: moments and quantile sketches per group.

A state is one row per group. Rows that arrive later get states of their own, and states
merge by an aggregation over them, so that nobody reads the old rows again. The detectors
of :mod:`recordlens.operators.anomaly` take states in place of a pass over the rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recordlens.functions.names import free_name, named
from recordlens.functions.numeric import finite
from recordlens.operators.guards import require_columns, require_numeric

MOMENTS = ("n", "mean", "rest", "m2")
SKETCH = ("n", "sketch")
SKETCH_K = 4096


def moment_states(df: DataFrame, column: str, by: Sequence[str] = ()) -> DataFrame:
    """Count, mean and sum of squared deviations per group: (by..., n, mean, rest, m2).

    Deviations are taken from a value of the group, so a large offset costs no digits; what
    of the mean does not fit into a double beside it is in ``rest``.
    Nulls, NaN and infinities are left out; a group without other values has n = 0 and
    nulls. Null is a group of its own.
    """
    require_numeric(df, column)
    _require_groups(df, by, MOMENTS)
    x = finite(df, column)
    start, value = (free_name(df, c) for c in ("start", "value"))
    keys = {c: free_name(df, f"its_{i}") for i, c in enumerate(by)}
    starts = df.groupBy(*(named(c).alias(k) for c, k in keys.items())).agg(F.min(x).alias(start))
    rows = df.select(*(named(c) for c in by), x.alias(value))
    if by:
        same = reduce(and_, (named(c).eqNullSafe(named(k)) for c, k in keys.items()))
        rows = rows.join(starts, same)
    else:
        rows = rows.withColumn(start, starts.scalar())
    return _moments(rows, by, named(value), named(start))


def _moments(rows: DataFrame, by: Sequence[str], x: Column, start: Column) -> DataFrame:
    off = x - start
    return _centred(rows, by, F.count(x), F.min(start), F.avg(off), F.var_pop(off) * F.count(x))


def _centred(
    rows: DataFrame, by: Sequence[str], n: Column, start: Column, shift: Column, m2: Column
) -> DataFrame:
    """States from aggregates; the mean is start + shift, of which a double leaves a rest."""
    own = "sums"
    while own in by:
        own += "_"
    sums = rows.groupBy(*(named(c) for c in by)).agg(
        F.struct(n.alias("n"), start.alias("start"), shift.alias("shift"), m2.alias("m2")).alias(own)
    )
    start, shift = named(own)["start"], named(own)["shift"]
    mean = start + shift
    return sums.select(
        *(named(c) for c in by),
        named(own)["n"].alias("n"),
        mean.alias("mean"),
        (shift - (mean - start)).alias("rest"),
        named(own)["m2"].alias("m2"),
    )


def _require_groups(df: DataFrame, by: Sequence[str], taken: Sequence[str]) -> None:
    require_columns(df, by)
    if clash := set(by) & set(taken):
        raise ValueError(f"a state has its own columns {sorted(clash)}; rename the group's")


def merge_moments(states: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One state per group out of several, e.g. of the union of two tables of states.

    The means are averaged as deviations from one of them, and what lies between them is
    added to the squares (Chan, Golub and LeVeque 1979).
    """
    require_columns(states, [*by, *MOMENTS])
    first = free_name(states, "first")
    n, off = F.col("n"), (F.col("mean") - named(first)) + F.col("rest")
    group = Window.partitionBy(*(named(c) for c in by))
    anchored = states.withColumn(first, F.min("mean").over(group))
    total, shift = F.sum("n"), F.sum(n * off) / F.nullif(F.sum("n"), F.lit(0))
    # The sum of n (off - shift)^2 without a second pass over the states.
    between = F.greatest(F.lit(0.0), F.sum(n * off * off) - total * shift * shift)
    return _centred(
        anchored, by, F.coalesce(total, F.lit(0)), F.min(first), shift, F.sum("m2") + between
    )


def spread_of(state: Column | None = None) -> Column:
    """The sample standard deviation of a state, null for fewer than two values."""
    n, m2 = (F.col(c) if state is None else state[c] for c in ("n", "m2"))
    return F.when(n > 1, F.sqrt(m2 / (n - 1)))


def quantile_sketches(
    df: DataFrame, column: str, by: Sequence[str] = (), *, k: int = SKETCH_K
) -> DataFrame:
    """A mergeable KLL sketch per group: (by..., n, sketch).

    Nulls, NaN and infinities are left out; a group without other values has n = 0 and an
    empty sketch. A larger ``k`` (8 to 65535) makes ranks more exact, see :func:`rank_error`.
    """
    require_numeric(df, column)
    _require_groups(df, by, SKETCH)
    x = finite(df, column)
    return df.groupBy(*(named(c) for c in by)).agg(
        F.count(x).alias("n"), F.kll_sketch_agg_double(x, F.lit(k)).alias("sketch")
    )


def merge_sketches(
    sketches: DataFrame, by: Sequence[str] = (), *, k: int = SKETCH_K
) -> DataFrame:
    """One sketch per group out of several; as exact as one sketch of all the rows."""
    require_columns(sketches, [*by, *SKETCH])
    return sketches.groupBy(*(named(c) for c in by)).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n"),
        F.kll_merge_agg_double("sketch", F.lit(k)).alias("sketch"),
    )


def sketch_quantile(share: float) -> Column:
    """The value of rank ``share`` in a row of sketches, null where it holds no values."""
    return F.when(F.col("n") > 0, F.kll_sketch_get_quantile_double("sketch", F.lit(float(share))))


def rank_error(k: int = SKETCH_K) -> float:
    """How far a quantile's rank may be off, as a share of all values, 99 times in 100.

    Published for KLL sketches as 2.296 / k^0.9723 for one quantile.
    """
    return 2.296 / k**0.9723
