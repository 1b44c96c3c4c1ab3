"""Near-duplicate components, against all pairs of full shingle sets."""

import random

import numpy as np
import pytest

from recordlens.llm import near_dedup
from recordlens.llm.near_dedup import near_duplicates
from tests.brute import components
from tests.llm.texts import corpus, frame, lower, prose, words


def shingles(text):
    own = words(lower(text))
    if len(own) < 5:
        return frozenset([tuple(own)] if own else [])
    return frozenset(tuple(own[i : i + 5]) for i in range(len(own) - 4))


def expected(rows, percent=85):
    sets = [(i, shingles(t)) for i, t in rows if i is not None]
    edges = [
        (a, b)
        for n, (a, x) in enumerate(sets)
        for b, y in sets[:n]
        if x and y and 100 * len(x & y) >= percent * len(x | y)
    ]
    root = components([i for i, _ in sets], edges)
    out = [
        (i, len(shingles(t)), None if i is None else root[i], i is None or root[i] == i)
        for i, t in rows
    ]
    return sorted(out, key=repr)


def family(rng, n, length=120, edits=3):
    """A text and variants of it, each with a few words changed."""
    base = prose(rng, length, 5000).split()
    out = []
    for _ in range(n):
        some = list(base)
        for _ in range(rng.randrange(edits + 1)):
            some[rng.randrange(length)] = f"new{rng.randrange(10**6)}"
        out.append(" ".join(some))
    return out


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(9)
    found = corpus(50, seed=5)
    for k, size in enumerate((2, 5, 90)):
        texts = family(rng, size)
        found += [(1000 * (k + 1) + i, t.upper() if i % 3 == 0 else t) for i, t in enumerate(texts)]
    # The longest common part of otherwise different texts.
    shared = prose(rng, 60, 5000)
    found += [(9000 + i, prose(rng, 40, 5000) + " " + shared) for i in range(80)]
    return found


@pytest.mark.parametrize("options", [{}, {"task_docs": 8}, {"percent": 70}])
def test_components(spark, rows, options, monkeypatch):
    if "task_docs" in options:
        monkeypatch.setattr(near_dedup, "LEAF", 6)
        monkeypatch.setattr(near_dedup, "SPREAD_DEPTH", 3)
        monkeypatch.setattr(near_dedup, "BROADCAST_IDS", 0)
    found = near_duplicates(frame(spark, rows), **options).collect()
    assert sorted(map(tuple, found), key=repr) == expected(rows, options.get("percent", 85))


def test_no_documents_and_no_words(spark):
    df = frame(spark, [(1, None), (2, ""), (2, " "), (None, "a b c"), (None, None)])
    assert near_duplicates(df.limit(0)).count() == 0
    found = sorted(map(tuple, near_duplicates(df).collect()), key=repr)
    assert found == expected([(1, None), (2, ""), (2, " "), (None, "a b c"), (None, None)])


def test_thousands_of_copies(spark):
    rows = [(i, "the very same words in each of these texts") for i in range(3000)]
    found = near_duplicates(frame(spark, rows)).agg({"component_id": "max", "n_shingles": "min"}).first()
    assert tuple(found) in {(0, 5), (5, 0)}


def test_min_wise_tokens_estimate_similarity():
    rng = np.random.default_rng(1)
    pool = rng.integers(0, 1 << 62, 1150).astype(np.uint64)
    a, b = near_dedup.minwise([pool[:1000], pool[150:]])
    assert abs((a == b).mean() - 850 / 1150) < 0.15


def test_lower_thresholds_get_more_trees():
    assert [near_dedup.trees_for(p) for p in (85, 80, 70)] == [10, 12, 16]


def test_links_that_do_not_hold_leave_no_pair_out(spark, monkeypatch):
    """Close pairs, each a little too far from the text that all are taken to be close to."""
    rng = random.Random(4)
    monkeypatch.setattr(near_dedup, "LEAF", 6)
    monkeypatch.setattr(near_dedup, "SURE", -4)
    base = prose(rng, 200, 5000).split()
    rows = [(0, " ".join(base))]
    for i in range(1, 31):
        one = list(base)
        for at in (20, 60, 100, 140):
            one[at + rng.randrange(20)] = f"new{rng.randrange(10**6)}"
        rows += [(2 * i, " ".join(one)), (2 * i + 1, " ".join([*one[:-1], "end"]))]
    found = near_duplicates(frame(spark, rows)).collect()
    assert sorted(map(tuple, found), key=repr) == expected(rows)


def test_crowds_that_no_branching_divides_meet_pair_by_pair(spark):
    """Texts with equal tokens, more than a task takes: every two of them share a node."""
    from itertools import combinations

    from recordlens.storage import Workspace

    tokens = np.arange(near_dedup.TOKENS, dtype=np.uint32).tobytes()
    features = spark.createDataFrame([(i, tokens) for i in range(40)], "id long, tokens binary")
    found = near_dedup.nodes_of(features, Workspace(spark, "test"), trees=1, task_docs=8).collect()
    nodes = {}
    for row in found:
        nodes.setdefault(row.node, set()).add(row.id)
    met = {pair for ids in nodes.values() for pair in combinations(sorted(ids), 2)}
    assert met == set(combinations(range(40), 2))
    assert max(map(len, nodes.values())) < 40
