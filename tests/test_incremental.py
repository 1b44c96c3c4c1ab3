"""Records resolved batch by batch against all at once."""

import random

import pytest
from pyspark.sql import functions as F

from recordlens import EntityStore, MatchScorer, ResolutionPipeline
from recordlens.operators import spread
from recordlens.operators.similar import by_parts
from tests import brute
from tests.test_resolution import frame, people


def entities(df):
    return {r["record_id"]: r["entity_id"] for r in df.collect()}


@pytest.mark.parametrize(
    ("threshold", "blank_emails", "tile"), [(0.6, False, 500), (0.45, True, 3), (0.85, False, 500), (0.6, False, 3)]
)
def test_batches_give_the_entities_of_all(spark, tmp_path, monkeypatch, threshold, blank_emails, tile):
    monkeypatch.setattr(spread, "TILE_ROWS", tile)
    records = people(150, seed=6)
    random.Random(2).shuffle(records)  # later batches hold smaller ids and known profiles
    pipeline = ResolutionPipeline(MatchScorer(threshold=threshold), blank_emails=blank_emails)
    store = EntityStore(spark, str(tmp_path / "store"), pipeline)
    with pytest.raises(ValueError, match="no batch"):
        store.clusters()
    done = []
    for start, end in ((0, 60), (60, 61), (61, 61), (61, 150)):
        store.add(frame(spark, records[start:end]))
        done += records[start:end]
        ids = [r["record_id"] for r in done]
        expected = brute.components(ids, brute.matches(done, pipeline.scorer, blank_emails))
        if end in (61, 150):
            assert entities(store.clusters()) == expected
    # Opened anew it is the same, and goes on from there.
    again = EntityStore(spark, str(tmp_path / "store"), pipeline)
    assert again.n_batches == 4 and entities(again.clusters()) == expected
    assert [p.name for p in (tmp_path / "store").glob("forest-*")] == ["forest-3"]


def test_an_interrupted_batch_is_written_over(spark, tmp_path, monkeypatch):
    records = people(60, seed=8)
    store = EntityStore(spark, str(tmp_path / "store"))
    store.add(frame(spark, records[:30]))
    before = entities(store.clusters())
    with monkeypatch.context() as broken:
        broken.setattr(store.pipeline.__class__, "_close_links", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            store.add(frame(spark, records[30:]))
    again = EntityStore(spark, str(tmp_path / "store"))
    assert again.n_batches == 1 and entities(again.clusters()) == before
    again.add(frame(spark, records[30:]))
    expected = brute.components([r["record_id"] for r in records], brute.matches(records, MatchScorer()))
    assert entities(again.clusters()) == expected


@pytest.mark.parametrize("tile", [10, 500])
def test_stored_rows_do_not_meet_again(spark, monkeypatch, tile):
    monkeypatch.setattr(spread, "TILE_ROWS", tile)
    rows = spark.range(60).selectExpr("id", "'x' AS key", "id % 6 = 0 AS fresh", "concat('abcd', id) AS text", "0.5D AS least")
    joined, a, b = spread.pairs_within(rows, ["key"], "id", lambda a, b: F.lit(True), fresh="fresh")
    found = [(r[0], r[1]) for r in joined.select(a("id"), b("id")).collect()]
    expected = {(i, j) for i in range(60) for j in range(i) if i % 6 == 0 or j % 6 == 0}
    assert len(found) == len(expected) == len({frozenset(p) for p in found})
    assert {(max(p), min(p)) for p in found} == expected
    cut = by_parts(rows, ["key"], "id", "text", "least", lambda a, b: F.lit(True), "fresh")
    pairs = [(r[1], r[0]) for r in cut.select("a.id", "b.id").collect()]
    assert len(pairs) == len(set(pairs)) and set(pairs) == expected
