"""Weighted match scores, and what a scorer's weights imply for the search."""

from __future__ import annotations

import math
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordlens.functions.names import named

DEFAULT_WEIGHTS = {"name_sim": 0.4, "email_exact": 0.3, "phone_exact": 0.2, "city_sim": 0.1}
EXACT_FEATURES = {"email_exact": "email", "phone_exact": "phone"}
GRADED_FEATURES = {"name_sim": "name", "city_sim": "city"}


@dataclass(frozen=True)
class Way:
    """Pairs of a block that agree on ``fields`` and are at least as similar as ``least``."""

    fields: tuple[str, ...] = ()
    least: Mapping[str, float] = field(default_factory=dict)


@dataclass(frozen=True)
class MatchScorer:
    """Weighted mean of comparison features; a pair matches from ``threshold`` on.

    Attributes:
        weights: Feature column to weight; not negative, not all zero. The sum
            runs in the given order, which settles the last bit of the score.
        threshold: Smallest score of a match.
    """

    weights: Mapping[str, float] = field(default_factory=lambda: dict(DEFAULT_WEIGHTS))
    threshold: float = 0.6

    def __post_init__(self) -> None:
        if any(not w >= 0 for w in self.weights.values()) or not self.total > 0:
            raise ValueError("weights must not be negative and must not all be zero")

    @property
    def total(self) -> float:
        """Sum of the weights, rounded once."""
        return math.fsum(self.weights.values())

    def blend(self, features: Mapping[str, Column]) -> Column:
        """The score of the given feature columns."""
        score = F.lit(0.0)
        for name, weight in self.weights.items():
            score = score + F.lit(float(weight)) * features[name]
        return score / F.lit(self.total)

    def passes(self, features: Mapping[str, Column]) -> Column:
        """Whether the given feature columns make a match."""
        return self.blend(features) >= F.lit(float(self.threshold))

    def score(self, compared: DataFrame) -> DataFrame:
        """``compared`` with ``match_score`` and the boolean ``is_match``."""
        return compared.withColumn(
            "match_score", self.blend({name: named(name) for name in self.weights})
        ).withColumn("is_match", F.col("match_score") >= F.lit(float(self.threshold)))

    def matches(self, compared: DataFrame) -> DataFrame:
        """The scored pairs that match."""
        return self.score(compared).filter(F.col("is_match"))

    def suffices(self, agreeing: Iterable[str]) -> bool:
        """Whether full agreement on these features alone makes a match.

        Same operations in the same order as :meth:`blend`, so both round alike.
        """
        agreeing = set(agreeing)
        score = 0.0
        for name, weight in self.weights.items():
            score = score + float(weight) * (1.0 if name in agreeing else 0.0)
        return score / self.total >= self.threshold

    def _weighted(self, features: Iterable[str]) -> list[str]:
        return [f for f in features if self.weights.get(f, 0) > 0]

    def certain_rules(self) -> list[tuple[str, ...]]:
        """The smallest feature sets whose full agreement already makes a match."""
        features = self._weighted({**EXACT_FEATURES, **GRADED_FEATURES})
        found: list[tuple[str, ...]] = []
        for size in range(len(features) + 1):
            for chosen in combinations(features, size):
                if not any(set(f) <= set(chosen) for f in found) and self.suffices(chosen):
                    found.append(chosen)
        return found

    def open_cases(self) -> list[tuple[str, ...]]:
        """Sets of agreeing exact features with which the similarities decide."""
        exact, graded = self._weighted(EXACT_FEATURES), self._weighted(GRADED_FEATURES)
        return [
            chosen
            for size in range(len(exact) + 1)
            for chosen in combinations(exact, size)
            if self.suffices([*chosen, *graded]) and not self.suffices(chosen)
        ]

    def least_similarities(self, agreeing: Iterable[str]) -> dict[str, float] | None:
        """The least graded features of a match that agrees on just these exact ones.

        None if no such pair matches. A feature that has to be 1.0 is exactly that: any
        smaller similarity of texts below 2**31 characters falls short of the threshold.
        Other values are a little too small rather than too large.
        """
        graded = self._weighted(GRADED_FEATURES)
        held = [*agreeing, *graded]
        if not self.suffices(held):
            return None
        least = {}
        for f in graded:
            rest = math.fsum(self.weights[g] for g in held if g != f)
            if not self._passes_at(held, f, 1.0 - 2.0**-31):
                least[f] = 1.0
            else:
                needed = (self.threshold * self.total - rest) / self.weights[f]
                least[f] = min(1.0, max(0.0, needed - 1e-9))
        return least

    def _passes_at(self, held: Iterable[str], graded: str, value: float) -> bool:
        held = set(held)
        score = 0.0
        for name, weight in self.weights.items():
            x = value if name == graded else 1.0 if name in held else 0.0
            score = score + float(weight) * x
        return score / self.total >= self.threshold

    def ways(self) -> list[Way]:
        """How two records of a block can come to match; each match goes at least one way.

        A way with fields is a join on them. The one without, if any, is of pairs that
        share no exact feature and are as similar as ``least`` says.
        """
        found = []
        exact = self._weighted(EXACT_FEATURES)
        for size in range(len(exact) + 1):
            for chosen in combinations(exact, size):
                least = self.least_similarities(chosen)
                if least is None:
                    continue
                equal = tuple(GRADED_FEATURES[f] for f, x in least.items() if x == 1.0)
                fields = tuple(EXACT_FEATURES[f] for f in chosen) + equal
                open_ = {GRADED_FEATURES[f]: x for f, x in least.items() if 0.0 < x < 1.0}
                if not fields and not open_:
                    return [Way()]
                found.append(Way(fields, {} if fields else open_))
        # A join on fewer fields finds all that one on more of them does.
        joins = {w.fields for w in found if w.fields}
        return [
            w for w in found if not any(set(j) < set(w.fields) for j in joins)
        ]

    def evidence(self) -> tuple[str, ...]:
        """Fields of which a matching pair must share one; empty if it need not."""
        if self.suffices(self._weighted(GRADED_FEATURES)):
            return ()
        return tuple(EXACT_FEATURES[f] for f in self._weighted(EXACT_FEATURES))
