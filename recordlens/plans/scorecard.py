"""Detection and resolution on labelled data, scored in one table."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordlens.operators.anomaly import GaussianDetector, ZScoreDetector
from recordlens.operators.quality import flag_measures, pair_measures
from recordlens.plans.resolution import ResolutionPipeline
from recordlens.reports import EvaluationMetrics


@dataclass(frozen=True)
class Scorecard:
    """What the detectors and the resolver achieve on data with known truth.

    Attributes:
        n_txns: Transactions scored.
        zscore_flagged: Rows flagged by the global z-score.
        gaussian_flagged: Rows flagged by the per-customer z-score.
        zscore_metrics: Quality of the global z-score.
        gaussian_metrics: Quality of the per-customer z-score.
        n_records: Customer records resolved.
        n_entities: Entities they resolve to.
        resolution_metrics: Pairwise quality of the resolution.
    """

    n_txns: int
    zscore_flagged: int
    gaussian_flagged: int
    zscore_metrics: EvaluationMetrics
    gaussian_metrics: EvaluationMetrics
    n_records: int
    n_entities: int
    resolution_metrics: EvaluationMetrics


def scorecard(transactions: DataFrame, customers: DataFrame) -> DataFrame:
    """One row per capability: n_in, n_out, precision, recall, f1, support.

    ``n_out`` counts flagged rows for the detectors and entities for the resolver.
    """
    flagged = {
        "zscore": ZScoreDetector().detect(transactions, "amount").flagged,
        "gaussian": GaussianDetector("customer_id").detect(transactions, "amount").flagged,
    }
    rows = [
        _row(name, flag_measures(transactions, rows), "n_rows", "n_flagged")
        for name, rows in flagged.items()
    ]
    clusters = ResolutionPipeline().resolve(customers).clusters
    quality = pair_measures(clusters, customers)
    rows.append(_row("resolution", quality, "n_records", "n_entities"))
    return reduce(DataFrame.unionByName, rows)


def _row(capability: str, quality: DataFrame, n_in: str, n_out: str) -> DataFrame:
    return quality.select(
        F.lit(capability).alias("capability"),
        F.col(n_in).alias("n_in"),
        F.col(n_out).alias("n_out"),
        "precision",
        "recall",
        "f1",
        F.col("support").cast("decimal(38,0)").alias("support"),
    )


def run_scorecard(transactions: DataFrame, customers: DataFrame) -> Scorecard:
    """:func:`scorecard` as a plain object; collects its three rows."""
    rows = {r["capability"]: r for r in scorecard(transactions, customers).collect()}

    def metrics(capability: str) -> EvaluationMetrics:
        r = rows[capability]
        return EvaluationMetrics(r["precision"], r["recall"], r["f1"], int(r["support"]))

    return Scorecard(
        n_txns=rows["zscore"]["n_in"],
        zscore_flagged=rows["zscore"]["n_out"],
        gaussian_flagged=rows["gaussian"]["n_out"],
        zscore_metrics=metrics("zscore"),
        gaussian_metrics=metrics("gaussian"),
        n_records=rows["resolution"]["n_in"],
        n_entities=rows["resolution"]["n_out"],
        resolution_metrics=metrics("resolution"),
    )
