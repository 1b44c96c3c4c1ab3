import pytest

from recordlens import (
    EvaluationMetrics,
    anomaly_metrics,
    flag_measures,
    pair_measures,
    pairwise_resolution_metrics,
)


@pytest.mark.parametrize(
    ("counts", "expected"),
    [
        ((8, 2, 4), (0.8, 8 / 12, 2 * 0.8 * (8 / 12) / (0.8 + 8 / 12), 12)),
        ((5, 0, 0), (1.0, 1.0, 1.0, 5)),
        ((0, 0, 0), (0.0, 0.0, 0.0, 0)),
        ((0, 5, 0), (0.0, 0.0, 0.0, 0)),
        ((0, 0, 5), (0.0, 0.0, 0.0, 5)),
    ],
)
def test_measures_from_counts(counts, expected):
    tp, fp, fn = counts
    m = EvaluationMetrics.from_counts(tp=tp, fp=fp, fn=fn)
    assert (m.precision, m.recall, m.f1, m.support) == pytest.approx(expected)


def test_flags(spark):
    truth = spark.createDataFrame([(1, 1), (2, 0), (3, 1), (4, 0), (5, None), (6, 2)], "txn_id long, is_anomaly long")
    flagged = spark.createDataFrame([(1,), (1,), (2,), (5,), (77,), (None,)], "txn_id long")
    row = flag_measures(truth, flagged).first()
    assert (row["tp"], row["fp"], row["fn"]) == (1, 1, 1)
    assert (row["n_rows"], row["n_flagged"]) == (6, 6)
    assert (row["precision"], row["recall"], row["f1"], row["support"]) == (0.5, 0.5, 0.5, 2)
    assert anomaly_metrics(truth, flagged) == EvaluationMetrics(0.5, 0.5, 0.5, 2)


def test_flags_with_other_labels(spark):
    truth = spark.createDataFrame([(1, True), (2, False)], "a long, b boolean")
    flagged = spark.createDataFrame([(2,)], "a long")
    assert anomaly_metrics(truth, flagged, id_col="a", label_col="b") == EvaluationMetrics(0.0, 0.0, 0.0, 1)


def test_flags_of_nothing(spark):
    none = spark.createDataFrame([], "txn_id long, is_anomaly long")
    assert anomaly_metrics(none, none) == EvaluationMetrics(0.0, 0.0, 0.0, 0)


def metrics(spark, clusters, truth):
    return pairwise_resolution_metrics(
        spark.createDataFrame(clusters, "record_id long, entity_id long"),
        spark.createDataFrame(truth, "record_id long, true_entity_id long"),
    )


def test_pairs(spark):
    assert metrics(spark, [(1, 1), (2, 1), (3, 3)], [(1, 9), (2, 9), (3, 8)]) == EvaluationMetrics(1.0, 1.0, 1.0, 1)
    assert metrics(spark, [(1, 1), (2, 2)], [(1, 9), (2, 9)]) == EvaluationMetrics(0.0, 0.0, 0.0, 1)
    mixed = metrics(spark, [(1, 1), (2, 1), (3, 1), (4, 4)], [(1, 9), (2, 9), (3, 8), (4, 8)])
    assert mixed == EvaluationMetrics(1 / 3, 0.5, pytest.approx(0.4), 2)


def test_pairs_leave_out_unlabelled_records(spark):
    assert metrics(spark, [(1, 1), (2, 1), (3, 1)], [(1, None), (2, None), (4, 1)]) == EvaluationMetrics(0.0, 0.0, 0.0, 0)


def test_pair_counts_beyond_a_long(spark):
    from pyspark.sql import functions as F

    from recordlens.functions.numeric import pair_count

    sizes = [6_000_000_000, 6_000_000_001, 2, 1, 0]
    df = spark.createDataFrame([(n,) for n in sizes], "n long").select("n", pair_count(F.col("n")).alias("p"))
    assert {r["n"]: int(r["p"]) for r in df.collect()} == {n: n * (n - 1) // 2 for n in sizes}


def test_rounded_as_spark_rounds(spark):
    import random

    from pyspark.sql import functions as F

    from recordlens.functions.numeric import rounded

    rng = random.Random(6)
    values = [a / b for b in range(1, 40) for a in range(-b, 2 * b)]
    values += [a / 2**k for k in range(5, 24) for a in (1, 3, 5, -7)] + [a / 1e7 for a in range(-30, 30)]
    values += [rng.uniform(-1, 1) * 10 ** rng.randint(-9, 20) for _ in range(3000)]
    values += [0.0, -0.0, -1e-9, 1e300, -1e300, float("inf"), -float("inf"), float("nan"), None, 2.5e-7, 1.0000005]
    rows = spark.createDataFrame([(v,) for v in values], "x double")
    got = rows.select(rounded(F.col("x"), 6).alias("a"), F.round("x", 6).alias("b")).collect()
    assert [repr(r.a) for r in got] == [repr(r.b) for r in got]
    plan = rows.select(rounded(F.col("x"), 6))._jdf.queryExecution().optimizedPlan().toString()
    assert "rint" in plan.lower()


def test_measured_frames_name_their_columns(spark):
    clusters = spark.createDataFrame([(1, 1)], "record_id long, entity_id long")
    truth = spark.createDataFrame([(1, 1)], "record_id long, true_entity_id long")
    assert pair_measures(clusters, truth).columns == [
        "n_records", "n_entities", "tp", "fp", "fn", "precision", "recall", "f1", "support",
    ]


def test_contingency_adds_up(spark):
    """Measures of a table that was added up from parts are those of the whole."""
    import random
    from collections import Counter

    from recordlens import (
        cluster_measures,
        contingency,
        merge_contingency,
        pair_measures_of,
        partition_measures,
    )

    rng = random.Random(3)
    rows = [(i, f"e{rng.randrange(12)}", rng.choice([None, *range(8)])) for i in range(300)]
    clusters = spark.createDataFrame([r[:2] for r in rows], "record_id long, entity_id string")
    truth = spark.createDataFrame([(r[0], r[2]) for r in rows], "record_id long, true_entity_id long")
    parts = [contingency(clusters.filter(f"record_id % 3 = {i}"), truth) for i in range(3)]
    merged = merge_contingency(merge_contingency(*parts[:2]), parts[2])
    joint = Counter((e, t) for _, e, t in rows if t is not None)
    assert {(r["entity_id"], r["true_id"]): r["n"] for r in merged.collect()} == joint
    assert pair_measures_of(merged).first() == pair_measures(clusters, truth).first()

    sizes, actual = Counter(), Counter()
    for (e, t), n in joint.items():
        sizes[e] += n
        actual[t] += n
    found = {r["entity_id"]: r for r in cluster_measures(merged).collect()}
    assert set(found) == set(sizes)
    for e, row in found.items():
        n, t = min(((-n, t) for (x, t), n in joint.items() if x == e))
        assert (row["n_records"], row["true_id"], row["n_shared"], row["n_actual"]) == (sizes[e], t, -n, actual[t])
        assert row["n_true"] == sum(x == e for x, _ in joint)
        assert (row["purity"], row["completeness"]) == pytest.approx((-n / sizes[e], -n / actual[t]))

    import math

    total = sum(joint.values())
    entropy = lambda c: -sum(n / total * math.log(n / total) for n in c.values())
    hj, he, ht = map(entropy, (joint, sizes, actual))
    row = partition_measures(merged).first()
    assert (row["n_records"], row["n_entities"], row["n_true"]) == (total, len(sizes), len(actual))
    assert row["homogeneity"] == pytest.approx(1 - (hj - he) / ht)
    assert row["completeness"] == pytest.approx(1 - (hj - ht) / he)
    assert row["purity"] == pytest.approx(sum(max(n for (x, _), n in joint.items() if x == e) for e in sizes) / total)


def test_contingency_of_nothing_and_of_perfect_clusters(spark):
    from recordlens import cluster_measures, contingency, partition_measures

    clusters = spark.createDataFrame([(1, 1), (2, 1), (3, 3)], "record_id long, entity_id long")
    truth = spark.createDataFrame([(1, 7), (2, 7), (3, 9)], "record_id long, true_entity_id long")
    row = partition_measures(contingency(clusters, truth)).first()
    assert tuple(row) == (3, 2, 2, 1.0, 1.0, 1.0, 1.0, 1.0)
    nothing = contingency(clusters.limit(0), truth)
    assert cluster_measures(nothing).count() == 0
    assert tuple(partition_measures(nothing).first()) == (0, 0, 0, 0.0, 0.0, 1.0, 1.0, 1.0)
