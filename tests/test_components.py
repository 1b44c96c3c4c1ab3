import random

import pytest
from pyspark.sql import functions as F

from recordlens import connected_components
from recordlens.operators import components
from recordlens.storage import Workspace
from tests.brute import components as expected


def run(spark, nodes, edges, kind="long"):
    records = spark.createDataFrame([(n,) for n in nodes], f"record_id {kind}")
    matches = spark.createDataFrame(edges, f"record_id_a {kind}, record_id_b {kind}")
    return {r[0]: r[1] for r in connected_components(records, matches).collect()}


def test_small_graph(spark):
    found = run(spark, [10, 20, 30, 40, 50, 60], [(60, 40), (40, 20), (30, 50)])
    assert found == {10: 10, 20: 20, 40: 20, 60: 20, 30: 30, 50: 30}


def test_no_edges_loops_and_nulls(spark):
    assert run(spark, [3, 4], [(3, 3), (None, 4), (4, None)]) == {3: 3, 4: 4}


def test_unlisted_ids_bridge(spark):
    assert run(spark, [5, 6, 7], [(5, 1), (1, 6)]) == {5: 1, 6: 1, 7: 7}


def test_text_ids(spark):
    assert run(spark, ["a", "b", "c"], [("c", "b")], "string") == {"a": "a", "b": "b", "c": "b"}


def test_repeated_records_stay(spark):
    records = spark.createDataFrame([(1,), (1,), (2,)], "record_id long")
    matches = spark.createDataFrame([(2, 1)], "record_id_a long, record_id_b long")
    rows = sorted(tuple(r) for r in connected_components(records, matches).collect())
    assert rows == [(1, 1), (1, 1), (2, 1)]


def test_random_graphs_with_hubs_and_paths(spark):
    rng = random.Random(5)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(150)]
    edges += [(1000, 1001 + i) for i in range(80)] + [(2999, 2000 + i) for i in range(80)]
    path = list(range(4000, 4060))
    rng.shuffle(path)
    edges += list(zip(path, path[1:]))
    nodes = [*range(400), *range(1000, 1090), *range(2000, 3000), *range(4000, 4060)]
    assert run(spark, nodes, edges) == expected(nodes, edges)


def test_only_plain_ids(spark):
    records = spark.createDataFrame([([1],)], "record_id array<int>")
    matches = spark.createDataFrame([([1], [2])], "record_id_a array<int>, record_id_b array<int>")
    with pytest.raises(ValueError, match="plain values"):
        connected_components(records, matches)


HUBS = 300_000


def star(spark, centre, n=HUBS):
    return spark.range(1, n + 1).select(F.lit(centre).cast("long").alias("a"), F.col("id").alias("b"))


@pytest.mark.parametrize(("centre", "end"), [(0, "low"), (HUBS + 1, "high")])
def test_no_task_gets_a_whole_hub(spark, centre, end):
    """A hub's edges are dealt to all tasks, also where nothing may be broadcast."""
    settings = {
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    held = {k: spark.conf.get(k) for k in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        a, b = star(spark, centre).columns
        edges = star(spark, centre).select(F.least(a, b).alias("low"), F.greatest(a, b).alias("high"))
        current = components._written(edges, Workspace(spark, "hub"), "edges")
        assert len(current.heavy[end]) == 1 and sum(map(len, current.heavy.values())) == 1
        least = current.edges.groupBy(F.col(end).alias("node")).agg(F.lit(0).alias("root"))
        joined = components.with_least(current.edges, end, least, current.heavy[end])
        per_task = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(per_task) == HUBS and max(per_task) <= HUBS // 4
        records = spark.range(HUBS + 2).withColumnRenamed("id", "record_id")
        links = star(spark, centre).toDF("record_id_a", "record_id_b")
        found = connected_components(records, links).groupBy("entity_id").count().collect()
        assert sorted(tuple(r) for r in found) == ([(0, HUBS + 1), (HUBS + 1, 1)] if centre == 0 else [(0, 1), (1, HUBS + 1)])
    finally:
        for key, value in held.items():
            spark.conf.set(key, value)


def test_every_node_heavy(spark, monkeypatch):
    """Salts change nothing in the outcome, however many nodes have them."""
    monkeypatch.setattr(components, "LEAST_HEAVY", 0)
    monkeypatch.setattr(components, "HEAVY_PARTS", 1000)
    rng = random.Random(9)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(260)]
    edges += [(1000, 1001 + i) for i in range(50)] + [(1001 + i, 2000 + i) for i in range(50)]
    nodes = [*range(300), *range(1000, 1060), *range(2000, 2060)]
    assert run(spark, nodes, edges) == expected(nodes, edges)
    text = [(f"n{a:05}", f"n{b:05}") for a, b in edges]
    names = {n: f"n{n:05}" for n in nodes}
    assert run(spark, list(names.values()), text, "string") == {
        names[a]: names[b] for a, b in expected(nodes, edges).items()
    }
