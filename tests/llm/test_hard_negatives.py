"""Packed products against Python's integers, and hard negatives against plain search."""

import math
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from recordlens.llm import hard_negatives as module
from recordlens.llm.hard_negatives import HIGHEST, LOWEST, hard_negatives, packed_products


def products(a, b):
    return [[max(LOWEST, min(HIGHEST, sum(x * y for x, y in zip(r, s)))) for s in b] for r in a]


@settings(max_examples=120, deadline=None)
@given(st.data())
def test_packed_products_are_exact(data):
    limit = data.draw(st.sampled_from([0, 1, 3, 256, 2**15, 2**31 - 1, 2**31, 2**40, 2**63 - 1]))
    dims = data.draw(st.integers(1, 7))
    number = st.integers(-limit, limit)
    lines = st.lists(st.lists(number, min_size=dims, max_size=dims), min_size=1, max_size=9)
    a, b = data.draw(lines), data.draw(lines)
    got = packed_products(np.array(a, np.int64), np.array(b, np.int64))
    assert got.tolist() == products(a, b)


def test_all_negative_and_empty():
    a, b = np.full((3, 64), -256), np.full((5, 64), -256)
    assert (packed_products(a, b) == 256 * 256 * 64).all()
    assert packed_products(a[:0], b).shape == (0, 5)
    assert packed_products(a[:, :0], b[:, :0]).tolist() == [[0] * 5] * 3


SCHEMA = "vec_id long, embedding array<float>, label int, id string, vector int, anchor int, best int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, 2, 3) for r in rows], SCHEMA).repartition(3)


def brute(rows, positives=5, negatives=10, low=30, high=90):
    def whole(v):
        return [max(LOWEST, min(HIGHEST, math.floor(256 * x))) for x in v]

    def usable(r):
        return None not in r and all(x is not None and math.isfinite(x) for x in r[1])

    rows = [(i, whole(np.float32(v).astype(float).tolist()), label) for i, v, label in filter(usable, rows)]
    anchors = {}
    for i, v, label in rows:
        if i % 100 == 0 and (i not in anchors or (label, v) < anchors[i]):
            anchors[i] = (label, v)
    out = []

    def top(scored, k):
        best = {}
        for i, s in scored:
            best[i] = max(s, best.get(i, s))
        return sorted(best.items(), key=lambda e: (-e[1], e[0]))[:k]

    for anchor, (label, v) in anchors.items():
        scored = [
            (i, max(LOWEST, min(HIGHEST, sum(x * y for x, y in zip(v, w)))), other == label)
            for i, w, other in rows
            if i != anchor
        ]
        for positive, p in top([(i, s) for i, s, same in scored if same], positives):
            band = [(i, s) for i, s, same in scored if not same and low * p <= 100 * s <= high * p]
            for rank, (i, s) in enumerate(top(band, negatives), 1):
                out.append((anchor, positive, rank, i, p, s))
    return sorted(out)


def rows_of(df):
    names = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    return sorted(tuple(r[n] for n in names) for r in df.collect())


def vectors(n=700, dims=6, seed=2):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 1) for _ in range(dims)] for _ in range(4)]
    rows = []
    for i in range(n):
        centre = rng.choice(centres)
        rows.append((i, [c + rng.gauss(0, 0.7) for c in centre], rng.choice([0, 0, 0, 1, 2])))
    # One vector very often, repeated rows, ids of several rows, and what takes no part.
    rows += [(1000 + i, rows[0][1], rng.randrange(3)) for i in range(60)]
    rows += rows[5:15] + [(20, rows[30][1], 1), (100, rows[31][1], 0), (100, rows[31][1], 2)]
    rows += [(300, None, 1), (2000, [1.0, None], 1), (2001, [math.nan], 0), (2002, [math.inf], 0)]
    rows += [(2003, [1.0] * dims, None), (None, [1.0] * dims, 0), (2004, [], 0), (2100, [], 1)]
    rows += [(2005, [3.0], 2), (2200, [2.0, 1.0], 0), (2006, [1.0] * (dims + 3), 1)]
    return rows


@pytest.mark.parametrize("small", [False, True])
def test_as_plain_search(spark, monkeypatch, small):
    if small:
        monkeypatch.setattr(module, "BLOCK_ANCHORS", 3)
        monkeypatch.setattr(module, "SCORES_AT_ONCE", 20)
    rows = vectors()
    found = hard_negatives(frame(spark, rows), F.col("vec_id") % 100 == 0)
    assert found.schema["rank"].dataType.simpleString() == "int"
    assert rows_of(found) == brute(rows)


def test_huge_components(spark):
    rng = random.Random(4)
    rows = [(i, [rng.choice([-1, 1]) * 10.0 ** rng.randrange(0, 12) for _ in range(4)], i % 2) for i in range(300)]
    rows += [(301, [3e38, -3e38, 1.0, 0.0], 1)]
    found = hard_negatives(frame(spark, rows), F.col("vec_id") % 100 == 0)
    assert rows_of(found) == brute(rows)


def test_other_limits(spark):
    rows = vectors(300)
    found = hard_negatives(
        frame(spark, rows), F.col("vec_id") % 100 == 0, positives=2, negatives=3, low=0, high=100
    )
    assert rows_of(found) == brute(rows, 2, 3, 0, 100)


def test_without_anchors_or_rows(spark):
    df = frame(spark, vectors(50))
    assert rows_of(hard_negatives(df, F.lit(False))) == []
    assert rows_of(hard_negatives(df.limit(0), F.col("vec_id") % 100 == 0)) == []
    assert rows_of(hard_negatives(df, F.lit(None).cast("boolean"))) == []
