"""Data quality on Spark: anomaly detection, entity resolution and their evaluation."""

from recordlens.operators.anomaly import (
    Detector,
    GaussianDetector,
    IQRDetector,
    ZScoreDetector,
    available_detectors,
    get_detector,
    register_detector,
)
from recordlens.operators.components import connected_components
from recordlens.operators.matching import MatchScorer
from recordlens.operators.pairs import block_sizes, candidate_pairs, compare_pairs
from recordlens.operators.quality import (
    anomaly_metrics,
    cluster_measures,
    contingency,
    flag_measures,
    merge_contingency,
    pair_measures,
    pair_measures_of,
    pairwise_resolution_metrics,
    partition_measures,
)
from recordlens.operators.similar import similar_pairs
from recordlens.operators.states import (
    merge_moments,
    merge_sketches,
    moment_states,
    quantile_sketches,
    rank_error,
)
from recordlens.plans.detection import DetectionPipeline, detect_anomalies, flag_totals
from recordlens.plans.incremental import EntityStore
from recordlens.plans.resolution import ResolutionPipeline, resolve_entities
from recordlens.plans.scorecard import Scorecard, run_scorecard, scorecard
from recordlens.reports import AnomalyReport, EvaluationMetrics, ResolutionReport

__all__ = [
    "AnomalyReport",
    "DetectionPipeline",
    "Detector",
    "EntityStore",
    "EvaluationMetrics",
    "GaussianDetector",
    "IQRDetector",
    "MatchScorer",
    "ResolutionPipeline",
    "ResolutionReport",
    "Scorecard",
    "ZScoreDetector",
    "anomaly_metrics",
    "available_detectors",
    "block_sizes",
    "candidate_pairs",
    "cluster_measures",
    "compare_pairs",
    "connected_components",
    "contingency",
    "detect_anomalies",
    "flag_measures",
    "flag_totals",
    "get_detector",
    "merge_contingency",
    "merge_moments",
    "merge_sketches",
    "moment_states",
    "pair_measures",
    "pair_measures_of",
    "pairwise_resolution_metrics",
    "partition_measures",
    "quantile_sketches",
    "rank_error",
    "register_detector",
    "resolve_entities",
    "run_scorecard",
    "scorecard",
    "similar_pairs",
]
