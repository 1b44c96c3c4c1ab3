"""Pairs of similar texts against all pairs, and how many are looked at."""

import random

import pytest
from pyspark.sql import functions as F

from recordlens.operators import similar, spread
from recordlens.operators.matching import MatchScorer, Way
from recordlens.operators.similar import by_parts, similar_pairs
from tests import brute

SCHEMA = "id long, grp string, txt string, least double"


def likeness(a, b):
    longer = max(len(a), len(b))
    return 1.0 if not longer else 1 - brute.levenshtein(a, b) / longer


def expected(rows):
    return sorted(
        (x[0], y[0])
        for i, x in enumerate(rows)
        for y in rows[i + 1 :]
        if x[1] is not None and x[1] == y[1] and None not in (x[2], y[2]) and likeness(x[2], y[2]) >= x[3]
    )


def found(spark, rows):
    pairs = similar_pairs(spark.createDataFrame(rows, SCHEMA), ["grp"], "id", "txt", "least")
    return sorted((r[0], r[1]) for r in pairs.select("a.id", "b.id").collect())


def words(n, seed, letters="abcd", longest=14):
    rng = random.Random(seed)
    made = ["".join(rng.choice(letters) for _ in range(rng.randrange(1, longest))) for _ in range(n // 2)]
    for _ in range(n - len(made)):
        some = list(rng.choice(made))
        for _ in range(rng.randrange(3)):
            at = rng.randrange(len(some) + 1)
            some[at : at + rng.randrange(2)] = rng.choice(["", "x", "é", "ab"])
        made.append("".join(some))
    return made


@pytest.mark.parametrize("tile", [3, 500])
def test_as_all_pairs(spark, monkeypatch, tile):
    monkeypatch.setattr(spread, "TILE_ROWS", tile)
    monkeypatch.setattr(similar, "LONGEST_BY_PARTS", 10)
    rng = random.Random(1)
    rows = []
    # A group has one least similarity; one and the same text may occur often.
    for least in (0.0, 0.3, 0.5, 0.62, 0.75, 0.8, 0.9, 1.0):
        texts = words(60, seed=int(least * 100)) + ["", "", "same", "same", "same"]
        texts += ["x" * 9, "x" * 10, "x" * 11, "x" * 12, "❤" * 11, None]
        rows += [(f"g{least}", t, least) for t in texts]
    rows += [(None, "abc", 0.5), (None, "abc", 0.5)]
    rng.shuffle(rows)
    rows = [(3 * i, *r) for i, r in enumerate(rows)]
    assert found(spark, rows) == expected(rows)


def test_similar_texts_share_a_part(spark):
    """Short texts of two letters, where parts are found in many places: hundreds of groups."""
    rng, rows = random.Random(11), []
    levels = [0.5, 0.6, 2 / 3, 0.7, 0.75, 0.8, 0.875, 1.0]
    for group in range(400):
        least = rng.choice(levels)
        texts = ["".join(rng.choice("ab") for _ in range(rng.randrange(1, 10))) for _ in range(9)]
        rows += [(len(rows) + i, f"g{group}", t, least) for i, t in enumerate(texts)]
    pairs = by_parts(
        spark.createDataFrame(rows, SCHEMA), ["grp"], "id", "txt", "least", lambda a, b: F.lit(True)
    )
    shared = {(r[0], r[1]) for r in pairs.select("a.id", "b.id").collect()}
    assert shared >= {pair for at in range(0, len(rows), 9) for pair in expected(rows[at : at + 9])}


def test_pairs_looked_at_grow_with_the_matches(spark):
    """Twice the texts, each with one near copy: twice the pairs, where all pairs are four times."""
    seen = []
    for n in (1000, 2000):
        rng = random.Random(n)
        texts = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(14)) for _ in range(n)]
        rows = [(i, "g", t, 0.8) for i, t in enumerate(texts + [t[:5] + "-" + t[6:] for t in texts])]
        pairs = by_parts(
            spark.createDataFrame(rows, SCHEMA), ["grp"], "id", "txt", "least", lambda a, b: F.lit(True)
        )
        seen.append(pairs.count())
    # Random texts share a part of four or five letters now and then.
    assert 1000 <= seen[0] < 4000 and 2000 <= seen[1] < 3 * seen[0]
    assert seen[1] < 4000 * 3999 / 2 / 500


def test_what_a_match_needs():
    default = MatchScorer()
    assert default.least_similarities([]) is None
    assert default.least_similarities(["email_exact"]) == pytest.approx({"name_sim": 0.5, "city_sim": 0.0})
    assert default.least_similarities(["phone_exact"]) == pytest.approx({"name_sim": 0.75, "city_sim": 0.0})
    assert default.ways() == [Way(("email",)), Way(("phone",))]
    # Name and city alone reach one half only where both are equal.
    assert MatchScorer(threshold=0.5).ways() == [Way(("name", "city")), Way(("email",)), Way(("phone",))]
    (similar_names, *joins) = MatchScorer(threshold=0.45).ways()
    assert similar_names.fields == () and joins == [Way(("email",)), Way(("phone",))]
    assert similar_names.least == pytest.approx({"name": 0.875, "city": 0.5})
    assert MatchScorer(threshold=0.0).ways() == [Way()]
    assert MatchScorer(threshold=1.1).ways() == []
    assert MatchScorer({"name_sim": 1.0}, 1.0).ways() == [Way(("name",))]
