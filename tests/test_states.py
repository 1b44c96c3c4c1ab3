"""States of parts of the rows, merged, against one pass over all rows."""

import random
import statistics

import pytest
from pyspark.sql import functions as F

from recordlens import (
    DetectionPipeline,
    GaussianDetector,
    IQRDetector,
    ZScoreDetector,
    merge_moments,
    merge_sketches,
    moment_states,
    quantile_sketches,
    rank_error,
)
from recordlens.operators.states import sketch_quantile, spread_of

SCHEMA = "id long, grp string, start string, value double"


def rows_of(seed, n=400, offset=0.0):
    rng = random.Random(seed)
    rows = [(i, rng.choice(["a", "a", "b", None]), "x", offset + rng.gauss(0, 1)) for i in range(n)]
    rows += [(n, "lone", "x", offset), (n + 1, "none", "x", None), (n + 2, "none", "x", float("nan"))]
    return rows + [(n + 3, "a", "x", float("inf"))]


def groups(rows):
    found = {}
    for _, grp, _, value in rows:
        found.setdefault(grp, [])
        if value is not None and abs(value) < float("inf"):
            found[grp].append(value)
    return found


@pytest.mark.parametrize("offset", [0.0, 1e9, -1e12])
def test_merged_moments(spark, offset):
    """Also far off zero, where sums of squares, and even sums, have no digits left."""
    parts = [rows_of(seed, offset=offset) for seed in (1, 2, 3)] + [[(9, "only here", "x", 2.5)]]
    states = [moment_states(spark.createDataFrame(p, SCHEMA), "value", ["grp"]) for p in parts]
    some = merge_moments(states[0].unionByName(states[1]), ["grp"])
    merged = merge_moments(some.unionByName(states[2]).unionByName(states[3]), ["grp"])
    found = {r["grp"]: r for r in merged.withColumn("spread", spread_of()).collect()}
    expected = groups([r for p in parts for r in p])
    assert set(found) == set(expected)
    for grp, values in expected.items():
        row = found[grp]
        assert row["n"] == len(values)
        assert row["mean"] == (pytest.approx(statistics.fmean(values), rel=1e-15, abs=1e-9) if values else None)
        # What an offset leaves of a double's digits in the values themselves.
        exact = statistics.stdev(values) if len(values) > 1 else None
        assert row["spread"] == (None if exact is None else pytest.approx(exact, rel=1e-9))


def test_moments_of_the_whole_column(spark):
    df = spark.createDataFrame(rows_of(4), SCHEMA)
    values = [v for g in groups(rows_of(4)).values() for v in g]
    row = moment_states(df, "value").first()
    assert (row["n"], row["mean"]) == (len(values), pytest.approx(statistics.fmean(values)))
    assert moment_states(df.limit(0), "value").first()["n"] == 0
    assert merge_moments(moment_states(df.limit(0), "value")).first()["n"] == 0
    assert merge_moments(moment_states(df.limit(0), "value", ["grp"]), ["grp"]).count() == 0


def test_names_of_groups(spark):
    df = spark.createDataFrame(rows_of(4), SCHEMA).withColumn("sums", F.lit(1)).withColumn("first", F.lit(2))
    by = ["start", "sums", "first"]
    merged = merge_moments(moment_states(df, "value", by), by)
    assert merged.columns == [*by, "n", "mean", "rest", "m2"] and merged.count() == 1
    with pytest.raises(ValueError, match="rename"):
        moment_states(df.withColumn("n", F.lit(1)), "value", ["n"])


def test_detectors_from_states(spark):
    parts = [rows_of(seed) + [(1000 + seed, "a", "x", 40.0), (2000 + seed, None, "x", -30.0)] for seed in (5, 6)]
    whole = spark.createDataFrame(parts[0] + parts[1], SCHEMA)

    def states(by=()):
        first, second = (moment_states(spark.createDataFrame(p, SCHEMA), "value", by) for p in parts)
        return first.unionByName(second)

    for detector, stored in (
        (ZScoreDetector(), ZScoreDetector(states=states())),
        (GaussianDetector("grp"), GaussianDetector("grp", states=states(["grp"]))),
    ):
        fresh, kept = (
            sorted((r["id"], round(r["anomaly_score"], 9)) for r in d.detect(whole, "value").flagged.collect())
            for d in (detector, stored)
        )
        assert fresh == kept and len(fresh) == 4
    both = DetectionPipeline((ZScoreDetector(states=states()), IQRDetector(exact=True)))
    totals = {r["detector"]: r["n_flagged"] for r in both.totals(whole, "value").collect()}
    assert totals["zscore"] == 4
    # A group that nothing is stored of has nothing to deviate from.
    new = spark.createDataFrame([(1, "new", "x", 1e6), (2, "a", "x", 1e6)], SCHEMA)
    flagged = GaussianDetector("grp", states=states(["grp"])).detect(new, "value").flagged
    assert [r["id"] for r in flagged.collect()] == [2]


def test_merged_sketches_keep_their_rank_error(spark):
    rng = random.Random(7)
    rows = [(i, rng.choice("ab"), str(i % 30), rng.lognormvariate(0, 2)) for i in range(60_000)]
    rows += [(0, "a", "31", None), (0, "a", "31", float("nan")), (0, "empty", "1", None)]
    df = spark.createDataFrame(rows, SCHEMA)
    daily = quantile_sketches(df, "value", ["grp", "start"], k=256)
    merged = merge_sketches(daily, ["grp"], k=256)
    found = {
        r["grp"]: r
        for r in merged.select("grp", "n", *(sketch_quantile(p).alias(f"q{int(100 * p)}") for p in (0.25, 0.75))).collect()
    }
    for grp in "ab":
        values = sorted(r[3] for r in rows if r[1] == grp and r[3] is not None and r[3] == r[3])
        assert found[grp]["n"] == len(values)
        for share in (0.25, 0.75):
            q = found[grp][f"q{int(100 * share)}"]
            rank = sum(v <= q for v in values) / len(values)
            assert abs(rank - share) <= 2 * rank_error(256)
    assert found["empty"]["n"] == 0 and found["empty"]["q25"] is None
    assert rank_error(200) == pytest.approx(0.0133, abs=1e-4)


def test_iqr_from_sketches(spark):
    df = spark.createDataFrame([(i, "g", str(i % 3), float(i % 100)) for i in range(900)] + [(901, "g", "0", 500.0)], SCHEMA)
    sketches = quantile_sketches(df, "value", ["start"])
    report = IQRDetector(sketches=sketches).detect(df, "value")
    assert [r["id"] for r in report.flagged.collect()] == [901]
    totals = DetectionPipeline((IQRDetector(sketches=sketches),)).totals(df, "value").collect()
    assert [tuple(r) for r in totals] == [("iqr", 1)]
    nothing = quantile_sketches(df.limit(0), "value")
    assert IQRDetector(sketches=nothing).detect(df, "value").n_flagged == 0
    with pytest.raises(ValueError, match="not both"):
        IQRDetector(exact=True, sketches=sketches)
