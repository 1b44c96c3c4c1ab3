"""Several detectors over one column, sharing the summaries they need."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordlens.functions.names import free_name, named
from recordlens.functions.numeric import finite
from recordlens.operators.anomaly import (
    SCORE,
    GlobalDetector,
    available_detectors,
    get_detector,
    report,
)
from recordlens.operators.guards import require_numeric
from recordlens.reports import AnomalyReport


def detect_anomalies(
    df: DataFrame, column: str, *, method: str = "zscore", **options: Any
) -> AnomalyReport:
    """Flag the unusual rows of ``column`` with the detector registered as ``method``.

    ``options`` go to the detector: ``threshold`` (zscore, gaussian), ``multiplier``
    (iqr), ``group_col`` (gaussian). An unknown method raises ``ValueError``.
    """
    if method not in available_detectors():
        raise ValueError(f"unknown method {method!r}; available: {available_detectors()}")
    return get_detector(method, **options).detect(df, column)


@dataclass(frozen=True)
class DetectionPipeline:
    """Runs ``detectors`` in order; of two with the same name the later one counts."""

    detectors: tuple[Any, ...]

    @property
    def _by_name(self) -> dict[str, Any]:
        return {d.name: d for d in self.detectors}

    def _summaries(self, df: DataFrame, x: Column) -> dict[str, Column]:
        """Literal summaries of the global detectors, all from one pass over ``x``."""
        summaries = {
            name: d.summarise(df, x)
            for name, d in self._by_name.items()
            if isinstance(d, GlobalDetector) and not d.from_rows
        }
        shared = {
            name: d
            for name, d in self._by_name.items()
            if isinstance(d, GlobalDetector) and name not in summaries
        }
        if shared:
            row = df.agg(*(d.summary(x).alias(name) for name, d in shared.items())).first()
            for name in shared:
                summaries[name] = F.struct(
                    *(
                        F.lit(value).cast("double").alias(field)
                        for field, value in row[name].asDict().items()
                    )
                )
        return summaries

    def run(self, df: DataFrame, column: str) -> dict[str, AnomalyReport]:
        """One report per detector name."""
        require_numeric(df, column)
        x = finite(df, column)
        summaries = self._summaries(df, x)
        reports = {}
        for name, detector in self._by_name.items():
            if name in summaries:
                score = detector.deviation(x, summaries[name])
                reports[name] = report(detector, df.withColumn(SCORE, score), column)
            else:
                reports[name] = detector.detect(df, column)
        return reports

    def totals(self, df: DataFrame, column: str) -> DataFrame:
        """How many rows each detector flags: (detector, n_flagged), from one scan.

        The global detectors' scores stand side by side; a detector of groups adds its
        summaries by a join. All flags are then counted in one aggregation.
        """
        require_numeric(df, column)
        x = finite(df, column)
        summaries = self._summaries(df, x)
        scored, scores = df.select("*"), {}
        for i, (name, detector) in enumerate(self._by_name.items()):
            score = free_name(scored, f"score_{i}")
            if name in summaries:
                scored = scored.withColumn(score, detector.deviation(x, summaries[name]))
            elif hasattr(detector, "score"):
                found = detector.score(scored, column)
                scored = found.withColumnRenamed(SCORE, score)
            else:
                raise TypeError(f"detector {name!r} gives no scores of single rows")
            scores[name] = named(score) > F.lit(detector.cutoff)
        flagged = {
            name: F.count_if(named(column).isNotNull() & over) for name, over in scores.items()
        }
        counted = scored.agg(F.struct(*(n.alias(f"n{i}") for i, n in enumerate(flagged.values()))).alias("n"))
        rows = F.array(
            *(
                F.struct(F.lit(name).alias("detector"), F.col(f"n.n{i}").alias("n_flagged"))
                for i, name in enumerate(flagged)
            )
        )
        return counted.select(F.inline(rows))


def flag_totals(reports: Mapping[str, AnomalyReport]) -> DataFrame:
    """How many rows each report flags: one row (detector, n_flagged) per report."""
    totals = [
        r.flagged.agg(F.count(F.lit(1)).alias("n_flagged")).select(
            F.lit(name).alias("detector"), "n_flagged"
        )
        for name, r in reports.items()
    ]
    return reduce(DataFrame.unionByName, totals)
