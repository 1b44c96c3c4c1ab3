"""Ranked search against plain scoring of all documents."""

import math
import random
import re

import numpy as np
import pytest

from recordlens.llm import lexical_search
from recordlens.llm.lexical_search import Block, search, terms_of
from tests.llm.texts import corpus, frame, lower

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall(lower(text))


def ranking(docs, items, k=10):
    lists = [(doc_id, terms(text)) for doc_id, text in docs]
    n_docs, n_terms = sum(bool(t) for _, t in lists), sum(len(t) for _, t in lists)
    wanted = {}
    for item, text in items:
        wanted.setdefault(item, set()).update(terms(text))
    out = []
    for item, own in wanted.items():
        found = []
        weight = {}
        for t in own:
            df = sum(t in ts for _, ts in lists)
            weight[t] = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))
        for doc_id, ts in lists:
            m = 10 + 90 * len(ts) * n_docs // n_terms if n_terms else 0
            score = sum(
                weight[t] * (10**9 * ts.count(t) // (1000 * ts.count(t) + 8 * m)) for t in own if t in ts
            )
            if score > 0:
                found.append((-score, doc_id is None, doc_id or 0, doc_id))
        found.sort()
        out += [(item, i + 1, f[3], -f[0]) for i, f in enumerate(found[:k])]
    return sorted(out, key=repr)


def item_frame(spark, rows):
    schema = "item_id long, text string, term string, doc_id string, w int, block int"
    return spark.createDataFrame([(*r, "x", "y", 1, 2) for r in rows], schema)


def items_of(docs, seed=5):
    rng = random.Random(seed)
    items = []
    for i in range(25):
        words = terms(rng.choice(docs)[1])
        start = rng.randrange(len(words)) if words else 0
        items.append((i, " ".join(words[start : start + rng.randrange(1, 40)]).upper()))
    items += [(30, None), (31, ""), (32, "!?"), (None, "w1 w2"), (None, "w3"), (33, "w1 w1 W1 w2")]
    items += [(33, "ünïcödé ÜNÏCÖDÉ ❤"), (34, "nowhere-to be-found-at-all xyzzy")]
    return items


def rows_of(df):
    return sorted((tuple(r) for r in df.select("item_id", "rank", "doc_id", "score").collect()), key=repr)


@pytest.mark.parametrize("small", [False, True])
def test_as_scoring_all_documents(spark, monkeypatch, small):
    if small:
        # Many blocks of documents, of items and of reading, and texts cut into pieces.
        for name, value in {"BLOCK_DOCS": 5, "STRIDE": 1, "BLOCK_TERMS": 60, "PIECE_BYTES": 50}.items():
            monkeypatch.setattr(lexical_search, name, value)
        monkeypatch.setattr(lexical_search, "COUNTED_TERMS", 40)
    docs = corpus(80)
    # Ties across ids, and one row many times over.
    docs += [(1000 + i, "w1 w2 tied") for i in range(30)] + [(5000, "w3 repeated w4")] * 20
    items = items_of(docs)
    assert rows_of(search(frame(spark, docs), item_frame(spark, items))) == ranking(docs, items)
    assert rows_of(search(frame(spark, docs), item_frame(spark, items), k=3)) == ranking(docs, items, 3)


def test_empty_tables(spark):
    docs, items = corpus(10), [(1, "w1 w2")]
    for some_docs, some_items in (([], items), (docs, []), ([], []), ([(1, None), (2, "")], items)):
        d = frame(spark, docs).limit(0) if not some_docs else frame(spark, some_docs)
        i = item_frame(spark, items).limit(0) if not some_items else item_frame(spark, some_items)
        assert rows_of(search(d, i)) == []


def test_terms_of_long_texts():
    rng = random.Random(1)
    text = " ".join(f"Wort{rng.randrange(5000)}é" for _ in range(300_000)) + "x" * 3_000_000
    counts, n = terms_of(text.encode())
    own = terms(text)
    assert n == len(own) and len(counts) == len(set(own)) and counts[own[7].encode()] == own.count(own[7])


def test_reading_stops_at_the_best_positions():
    """The look-ups of one list see the top of the other, so both bounds fall at once."""
    n = 4000
    ids = list(range(n))
    tf = [n - d for d in range(n)]
    postings = ([0] * n + [1] * n, ids * 2, tf * 2)
    block = Block(ids, postings, np.full(n, 10**6), np.array([5, 7]))
    looked_up = []

    class Watched(np.ndarray):
        def __getitem__(self, at):
            if isinstance(at, tuple):
                looked_up.append(np.size(at[1]))
            return super().__getitem__(at)

    block.impact = block.impact.view(Watched)
    best = block.search(np.array([0, 1]), [], 10)
    assert [d for _, _, d in best] == ids[:10]
    assert sum(looked_up) <= 2 * lexical_search.STRIDE
    # A block that cannot reach the k-th score is not read at all.
    looked_up.clear()
    high = [(-(10**12), False, i) for i in range(10)]
    assert block.search(np.array([0, 1]), high, 10) == high and not looked_up


def test_ties_with_the_kth_are_read():
    ids = list(range(100, 0, -1))
    block = Block(ids, ([0] * 100, list(range(100)), [3] * 100), np.full(100, 50), np.array([9]))
    assert [d for _, _, d in block.search(np.array([0]), [], 10)] == list(range(1, 11))
