"""Numeric anomaly detectors and the registry that finds them by name."""

from __future__ import annotations

from typing import Any, Protocol, runtime_checkable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordlens.functions.names import free_name, named
from recordlens.functions.numeric import fence_score, finite, z_score
from recordlens.operators.guards import require_columns, require_numeric
from recordlens.operators.quantiles import exact_quantiles
from recordlens.operators.states import (
    MOMENTS,
    SKETCH,
    merge_moments,
    merge_sketches,
    sketch_quantile,
    spread_of,
)
from recordlens.reports import AnomalyReport

SCORE = "anomaly_score"
DEFAULT_THRESHOLD = 3.0
DEFAULT_MULTIPLIER = 1.5


@runtime_checkable
class Detector(Protocol):
    """Anything with a ``name`` that flags rows of a numeric column."""

    name: str

    def detect(self, df: DataFrame, column: str) -> AnomalyReport:
        """Flag the unusual rows of ``column``."""
        ...


class GlobalDetector:
    """A detector that compares every row with one summary of the whole column.

    The summary is one row. It enters the scoring as a scalar subquery: no join,
    no shuffle of the rows, and the scan for it reads the one column only.
    """

    name: str
    cutoff: float

    @property
    def from_rows(self) -> bool:
        """Whether the summary is one aggregate of the rows, which others can share."""
        return True

    def summary(self, x: Column) -> Column:
        """Aggregate of the column as one struct."""
        raise NotImplementedError

    def deviation(self, x: Column, summary: Column) -> Column:
        """Score of one value against the summary."""
        raise NotImplementedError

    def summarise(self, df: DataFrame, x: Column) -> Column:
        """The summary of ``x`` over ``df``, usable as a column of any frame."""
        return df.agg(self.summary(x).alias("summary")).scalar()

    def score(self, df: DataFrame, column: str) -> DataFrame:
        """``df`` with the ``anomaly_score`` of every row."""
        require_numeric(df, column)
        x = finite(df, column)
        return df.withColumn(SCORE, self.deviation(x, self.summarise(df, x)))

    def detect(self, df: DataFrame, column: str) -> AnomalyReport:
        """The rows that score above the cutoff; lazy."""
        return report(self, self.score(df, column), column)


def report(detector: Any, scored: DataFrame, column: str) -> AnomalyReport:
    """Keep the rows of a scored frame that lie above the detector's cutoff.

    A null is never flagged; saying so lets the scan skip nulls by itself.
    """
    flagged = scored.filter(
        named(column).isNotNull() & (F.col(SCORE) > F.lit(detector.cutoff))
    )
    return AnomalyReport(flagged, detector.name, column, detector.cutoff)


def mean_and_spread(x: Column) -> Column:
    """Mean and sample standard deviation of ``x`` as one struct."""
    return F.struct(F.mean(x).alias("mean"), F.stddev_samp(x).alias("spread"))


def state_summary() -> Column:
    """The same out of a row of :func:`moment_states`."""
    return F.struct(F.col("mean"), spread_of().alias("spread"))


class ZScoreDetector(GlobalDetector):
    """Flags values more than ``threshold`` standard deviations from the mean.

    With ``states``, a table of moment states of the column, rows are held against what
    is stored there instead of against themselves.
    """

    name = "zscore"

    def __init__(
        self, threshold: float | None = None, *, states: DataFrame | None = None
    ) -> None:
        self.threshold = DEFAULT_THRESHOLD if threshold is None else threshold
        self.cutoff = float(self.threshold)
        self.states = states

    @property
    def from_rows(self) -> bool:
        return self.states is None

    def summarise(self, df: DataFrame, x: Column) -> Column:
        if self.states is None:
            return super().summarise(df, x)
        merged = merge_moments(self.states.select(*MOMENTS))
        return merged.select(state_summary().alias("summary")).scalar()

    def summary(self, x: Column) -> Column:
        return mean_and_spread(x)

    def deviation(self, x: Column, summary: Column) -> Column:
        return z_score(x, summary["mean"], summary["spread"])


class IQRDetector(GlobalDetector):
    """Flags values beyond the Tukey fences ``q1 - k * iqr`` and ``q3 + k * iqr``.

    The score counts interquartile ranges beyond the nearer fence, so the cutoff
    is 0. The quartiles are approximate with the given ``accuracy`` in one lazy
    pass, or, with ``exact``, exact values of the column found by a few jobs, or, with
    ``sketches``, those of stored quantile sketches, merged.
    """

    name = "iqr"
    cutoff = 0.0

    def __init__(
        self,
        multiplier: float | None = None,
        *,
        accuracy: int = 10_000,
        exact: bool = False,
        sketches: DataFrame | None = None,
    ) -> None:
        if exact and sketches is not None:
            raise ValueError("quartiles are exact or come from sketches, not both")
        self.multiplier = DEFAULT_MULTIPLIER if multiplier is None else multiplier
        self.accuracy = accuracy
        self.exact = exact
        self.sketches = sketches

    @property
    def from_rows(self) -> bool:
        return not self.exact and self.sketches is None

    def summary(self, x: Column) -> Column:
        return F.struct(
            F.percentile_approx(x, 0.25, self.accuracy).alias("q1"),
            F.percentile_approx(x, 0.75, self.accuracy).alias("q3"),
        )

    def summarise(self, df: DataFrame, x: Column) -> Column:
        if self.sketches is not None:
            quartiles = F.struct(
                sketch_quantile(0.25).alias("q1"), sketch_quantile(0.75).alias("q3")
            )
            merged = merge_sketches(self.sketches.select(*SKETCH))
            return merged.select(quartiles.alias("summary")).scalar()
        if not self.exact:
            return super().summarise(df, x)
        q1, q3 = exact_quantiles(df, x, (0.25, 0.75))
        return F.struct(
            F.lit(q1).cast("double").alias("q1"), F.lit(q3).cast("double").alias("q3")
        )

    def deviation(self, x: Column, summary: Column) -> Column:
        return fence_score(x, summary["q1"], summary["q3"], self.multiplier)


class GaussianDetector:
    """Flags values more than ``threshold`` deviations from the mean of their group.

    The groups are summarised with map-side partial aggregation and joined back, in
    one lazy plan that writes nothing. Unlike a window that need not gather the rows of
    one group in one task: the summaries are small, so Spark broadcasts few of them and
    splits the rows of a large group at run time where it shuffles.

    With ``states``, a table of moment states by ``group_col``, rows are held against what
    is stored there; a group that is not stored has nothing to deviate from and scores 0.
    """

    name = "gaussian"

    def __init__(
        self,
        group_col: str,
        threshold: float | None = None,
        *,
        states: DataFrame | None = None,
    ) -> None:
        self.states = states
        self.group_col = group_col
        self.threshold = DEFAULT_THRESHOLD if threshold is None else threshold
        self.cutoff = float(self.threshold)

    def score(self, df: DataFrame, column: str) -> DataFrame:
        """``df`` with the ``anomaly_score`` of every row within its group."""
        require_numeric(df, column)
        require_columns(df, [self.group_col])
        group, stats = (free_name(df, c) for c in ("group", "stats"))
        x = finite(df, column)
        if self.states is None:
            groups = df.groupBy(named(self.group_col).alias(group)).agg(
                mean_and_spread(x).alias(stats)
            )
        else:
            groups = merge_moments(self.states, [self.group_col]).select(
                named(self.group_col).alias(group), state_summary().alias(stats)
            )
        summary = named(stats)
        same = named(self.group_col).eqNullSafe(named(group))
        return df.join(groups, same, "inner" if self.states is None else "left").select(
            *(named(c) for c in df.columns if c != SCORE),
            z_score(x, summary["mean"], summary["spread"]).alias(SCORE),
        )

    def detect(self, df: DataFrame, column: str) -> AnomalyReport:
        """The rows that score above the cutoff; lazy."""
        return report(self, self.score(df, column), column)


_KNOWN: dict[str, Any] = {}


def register_detector(detector: Any) -> Any:
    """Make a detector, or a class of detectors, available under its ``name``.

    Returns the argument, so it also works as a decorator. A name that is taken
    raises ``ValueError``.
    """
    if detector.name in _KNOWN:
        raise ValueError(f"detector {detector.name!r} is already registered")
    _KNOWN[detector.name] = detector
    return detector


def get_detector(name: str, **options: Any) -> Any:
    """The detector registered as ``name``, built with ``options`` if it is a class."""
    if name not in _KNOWN:
        raise KeyError(f"no detector {name!r}; available: {available_detectors()}")
    found = _KNOWN[name]
    if isinstance(found, type):
        return found(**options)
    if options:
        raise TypeError(f"detector {name!r} is already built and takes no options")
    return found


def available_detectors() -> list[str]:
    """Sorted names of all registered detectors."""
    return sorted(_KNOWN)


for _built_in in (ZScoreDetector, IQRDetector, GaussianDetector):
    register_detector(_built_in)
