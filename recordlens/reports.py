"""Results of the operators: lazy frames with their figures computed on demand."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordlens.storage import Workspace


@dataclass(frozen=True)
class AnomalyReport:
    """Rows flagged by one detector.

    Attributes:
        flagged: The flagged rows with their ``anomaly_score``; lazy.
        detector: Name of the detector.
        column: The scored column.
        threshold: Rows score above this to be flagged.
    """

    flagged: DataFrame
    detector: str
    column: str
    threshold: float

    @cached_property
    def n_flagged(self) -> int:
        """Number of flagged rows; counted when first asked for."""
        return self.flagged.count()


@dataclass(frozen=True)
class ResolutionReport:
    """Records mapped to entities.

    Attributes:
        clusters: One row per input record with its ``entity_id``; lazy.
        work: The written tables that ``clusters`` reads. ``close``, or leaving a
            ``with`` block, removes them.
    """

    clusters: DataFrame
    work: Workspace | None = field(default=None, repr=False, compare=False)

    def close(self) -> None:
        """Remove the written tables; ``clusters`` cannot be read afterwards."""
        if self.work is not None:
            self.work.forget_all_but()

    def __enter__(self) -> ResolutionReport:
        return self

    def __exit__(self, *_: object) -> None:
        self.close()

    @cached_property
    def _sizes(self) -> tuple[int, int]:
        counts = self.clusters.agg(F.count(F.lit(1)), F.count_distinct("entity_id"))
        return tuple(counts.first())

    @property
    def n_records(self) -> int:
        """Number of input records."""
        return self._sizes[0]

    @property
    def n_entities(self) -> int:
        """Number of different entities."""
        return self._sizes[1]


@dataclass(frozen=True)
class EvaluationMetrics:
    """Precision, recall and F1 against known truth; ``support`` is the true positives' total."""

    precision: float
    recall: float
    f1: float
    support: int

    @classmethod
    def from_counts(cls, *, tp: int, fp: int, fn: int) -> EvaluationMetrics:
        """Measures from a confusion count; a ratio without a denominator is 0.0."""

        def share(part: float, whole: float) -> float:
            return part / whole if whole else 0.0

        precision, recall = share(tp, tp + fp), share(tp, tp + fn)
        f1 = share(2 * precision * recall, precision + recall)
        return cls(precision, recall, f1, tp + fn)
