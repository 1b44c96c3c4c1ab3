"""Shards against bucket by bucket splitting in plain Python."""

import hashlib
from collections import defaultdict

import pytest

from recordlens.llm import sharding
from recordlens.llm.sharding import extendible_shards
from tests.llm.texts import corpus, frame


def split(items, limit, prefix=""):
    """(shard, items) of the hash-prefix tree whose leaves fit the limit."""
    if sum(n for _, n in items) <= limit or len(items) == 1:
        return {prefix: items}
    out = {}
    for bit in "01":
        part = [x for x in items if x[0][len(prefix)] == bit]
        if part:
            out |= split(part, limit, prefix + bit)
    return out


def bits(doc_id):
    digest = hashlib.md5(("" if doc_id is None else str(doc_id)).encode()).hexdigest()
    return f"{int(digest[:15], 16):060b}"


@pytest.mark.parametrize("limit", [10**9, 4000, 300])
@pytest.mark.parametrize("spare", [3, 0])
def test_shards(spark, limit, spare, monkeypatch):
    # Without spare bits the first cells are too coarse and further rounds are needed.
    monkeypatch.setattr(sharding, "SPARE_BITS", spare)
    rows = [(i, t) for i, t in corpus() if i is not None]
    found = extendible_shards(frame(spark, rows), max_bytes=limit).collect()
    expected = {}
    for shard, items in split([(bits(i), len((t or "").encode())) for i, t in rows], limit).items():
        for key, _ in items:
            expected[key] = (shard, len(shard), sum(n for _, n in items), len(items))
    assert len(found) == len(rows)
    for r in found:
        assert (r.shard, r.depth, r.shard_bytes, r.shard_docs) == expected[bits(r.doc_id)]


def test_one_key_with_most_rows(spark):
    """Rows of one key that exceed the limit together are told apart by row."""
    rows = [(5, "x" * 50)] * 200 + [(i, "y" * 20) for i in range(100)] + [(None, "z" * 30)] * 20
    found = extendible_shards(frame(spark, rows), max_bytes=600).collect()
    held = defaultdict(list)
    for r in found:
        held[r.shard].append(r)
    assert len(found) == len(rows)
    for shard in held.values():
        assert sum(r.n_bytes for r in shard) == shard[0].shard_bytes <= 600
        assert len(shard) == shard[0].shard_docs
    shards = sorted(held)
    assert not any(b.startswith(a) for a, b in zip(shards, shards[1:]))


def test_other_keys_long_texts_and_nothing(spark):
    df = frame(spark, [(1, "a" * 1000), (2, "b"), (3, None), (4, "")])
    by_extra = extendible_shards(df, max_bytes=10, key_cols=("body", "id")).collect()
    assert max(r.shard_bytes for r in by_extra if r.n_bytes < 1000) <= 10
    assert [r.shard_docs for r in by_extra if r.n_bytes == 1000] == [1]
    assert extendible_shards(df.limit(0), max_bytes=10).count() == 0
