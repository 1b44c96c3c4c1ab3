import pytest
from pyspark.sql import functions as F

from recordlens.operators import spread

KEYS = [None] * 40 + ["a"] * 30 + [f"k{i}" for i in range(20)]


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame(list(enumerate(KEYS)), "id long, key string")


@pytest.fixture(scope="module")
def table(rows):
    return rows.groupBy(F.col("key").alias("its")).agg(
        F.min("id").alias("first"), F.count("*").alias("n")
    ).filter((F.col("its") != "k3") | F.col("its").isNull())


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize(("broadcast_bytes", "parts"), [(2**23, 10), (0, 1), (0, 10)])
def test_lookup_by_any_route(rows, table, monkeypatch, how, broadcast_bytes, parts):
    # All broadcast, all shuffled, and shuffled with heavy keys dealt to several tasks.
    monkeypatch.setattr(spread, "BROADCAST_BYTES", broadcast_bytes)
    monkeypatch.setattr(spread, "HEAVY_PARTS", parts)
    found = spread.lookup(rows, table, {"key": "its"}, weight="n", how=how)
    assert found.columns == ["id", "key", "first"]
    first = {k: KEYS.index(k) for k in KEYS if k != "k3"}
    expected = [
        (i, k, first.get(k)) for i, k in enumerate(KEYS) if how == "left" or k in first
    ]
    assert sorted(tuple(r) for r in found.collect()) == expected


@pytest.mark.parametrize("tile", [4000, 7])
def test_pairs_by_any_route(rows, monkeypatch, tile):
    monkeypatch.setattr(spread, "TILE_ROWS", tile)
    joined, a, b = spread.pairs_within(rows, ["key"], "id", lambda a, b: (a("id") + b("id")) % 3 == 0)
    found = [tuple(r) for r in joined.select(a("id"), b("id")).collect()]
    expected = [
        (i, j)
        for j, y in enumerate(KEYS)
        for i, x in enumerate(KEYS[:j])
        if x is not None and x == y and (i + j) % 3 == 0
    ]
    assert sorted(found) == sorted(expected)


def test_large_groups_spread_over_tasks(spark, monkeypatch):
    monkeypatch.setattr(spread, "TILE_ROWS", 50)
    same = spark.range(400).withColumn("key", F.lit("x"))
    joined, a, b = spread.pairs_within(same, ["key"], "id", lambda a, b: F.lit(True))
    per_task = joined.groupBy(F.spark_partition_id()).count().collect()
    assert sum(r["count"] for r in per_task) == 400 * 399 // 2
    assert len(per_task) == 4


def test_tiles_hold_each_slice_on_one_side(spark, monkeypatch):
    """Two slices meet as sides, so their rows do not meet those of their own slice there."""
    monkeypatch.setattr(spread, "TILE_ROWS", 50)
    # Twice the same order and none are no pairs, whichever slices they are in.
    orders = [*range(300), *range(20), *[None] * 20]
    rows = spark.createDataFrame([(i, "x") for i in orders], "id long, key string")
    joined, a, b = spread.pairs_within(rows, ["key"], "id", lambda a, b: F.lit(True))
    plan = joined._jdf.queryExecution().analyzed().toString()
    assert "slice#" in plan and all(
        any(f"Filter (slice#" in line and f"= {end}_slice#" in line for line in plan.splitlines())
        for end in ("low", "high")
    )
    found = sorted(tuple(r) for r in joined.select(a("id"), b("id")).collect())
    known = [i for i in orders if i is not None]
    assert found == sorted(
        (min(x, y), max(x, y)) for n, x in enumerate(known) for y in known[:n] if x != y
    )


def test_few_values_of_many_rows_are_measured_once(spark, monkeypatch):
    """Measures of a large group are made of its distinct values, with and without tiles."""
    rows = spark.createDataFrame(
        [(i, "x" if i % 9 else None, None if i % 7 == 0 else "ab" * (i % 4)) for i in [*range(240), 5, 5]],
        "id long, key string, text string",
    )
    length = {"total": lambda a, b: F.coalesce(F.length(a("text")) + F.length(b("text")), F.lit(-1))}

    def found(tile):
        monkeypatch.setattr(spread, "TILE_ROWS", tile)
        joined, a, b = spread.pairs_within(
            rows, ["key"], "id", lambda a, b: (a("id") + b("id")) % 3 == 0, alike=["text"], measures=length
        )
        pairs = joined.select(a("id").alias("i"), b("id").alias("j"), a("text").alias("x"), b("text").alias("y"), "total")
        return pairs, sorted(map(tuple, pairs.collect()), key=repr)

    plain, expected = found(4000)
    tiled, got = found(30)
    assert got == expected and len(got) > 5000
    assert all(t == (-1 if None in (x, y) else len(x + y)) and i < j for i, j, x, y, t in got)
    plans = [p._jdf.queryExecution().optimizedPlan().toString() for p in (plain, tiled)]
    assert ["collect_list" in p for p in plans] == [False, True]


def test_wide_keys_are_not_broadcast_and_hot_ones_are_split(spark):
    """One key of 9 MB neither gets broadcast nor keeps the hot key from being split."""
    rows = spark.range(2000).selectExpr(
        "id", "CASE WHEN id = 7 THEN repeat('w', 9000000) WHEN id % 2 = 0 THEN 'hot' ELSE concat('k', id) END AS key"
    )
    table = spread.Workspace(spark, "wide").keep(
        rows.groupBy(F.col("key").alias("its")).agg(F.min("id").alias("first"), F.count("*").alias("n")), "t"
    )
    joined = spread.lookup(rows, table, {"key": "its"}, weight="n")
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "its#" in plan and "SortMergeJoin" in plan
    broadcasts = [line for line in plan.splitlines() if "BroadcastExchange" in line]
    # What is broadcast are hashes of heavy keys, not keys.
    assert broadcasts and all("input[0, bigint" in line for line in broadcasts)
    assert joined.count() == 2000
    assert joined.filter("key = 'hot' AND first = 0").count() == 1000
