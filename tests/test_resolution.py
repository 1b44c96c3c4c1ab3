import random

import pytest

from recordlens import (
    MatchScorer,
    ResolutionPipeline,
    ResolutionReport,
    block_sizes,
    candidate_pairs,
    compare_pairs,
    connected_components,
    resolve_entities,
)
from recordlens.operators import spread
from recordlens.sources import SyntheticCustomers
from tests import brute

SCHEMA = "record_id long, name string, email string, phone string, city string"
FIELDS = ("record_id", "name", "email", "phone", "city")
WEIGHTS = {
    "default": dict(MatchScorer().weights),
    "two features": {"city_sim": 0.25, "name_sim": 0.75},
    "phone first": {"phone_exact": 0.6, "name_sim": 0.4, "email_exact": 0.0},
    "email alone": {"email_exact": 2.0},
}


def people(n, seed):
    """Few different values, so that copies, blanks, nulls and near misses all meet."""
    rng = random.Random(seed)
    names = ["ann li", "ann lee", "Ann Li ", "anna b", "a", "bob", "bo b", " bob", "", None]
    cities = ["oslo", "oslo ", "osaka", "rome", "", None]
    emails = ["a@x", "A@x ", "b@x", "", " ", None]
    phones = ["1-2", "12", "3 4", "", "-", None]
    pools = (names, emails, phones, cities)
    return [dict(zip(FIELDS, (10 * i, *(rng.choice(p) for p in pools)))) for i in range(n)]


def frame(spark, records):
    return spark.createDataFrame([tuple(r[f] for f in FIELDS) for r in records], SCHEMA)


@pytest.fixture(scope="module")
def records():
    # A third of the rows are copies of one record.
    copies = [{**people(1, 3)[0], "name": "zoe", "city": "rome", "record_id": 1 + 10 * i} for i in range(60)]
    return people(120, seed=1) + copies


@pytest.mark.parametrize(
    ("weights", "threshold"),
    [
        ("default", 0.6),
        ("default", 0.45),
        ("default", 0.85),
        ("two features", 0.7),
        ("phone first", 0.75),
        ("email alone", 1.0),
        ("default", 0.0),
        ("default", 1.1),
    ],
)
def test_entities_are_components_of_all_matching_pairs(spark, records, weights, threshold):
    scorer = MatchScorer(WEIGHTS[weights], threshold)
    report = ResolutionPipeline(scorer).resolve(frame(spark, records))
    ids = [r["record_id"] for r in records]
    expected = brute.components(ids, brute.matches(records, scorer))
    assert {r["record_id"]: r["entity_id"] for r in report.clusters.collect()} == expected
    assert isinstance(report, ResolutionReport)
    assert report.n_records == len(records)
    assert report.n_entities == len(set(expected.values()))


def test_entities_with_every_join_split(spark, records, monkeypatch):
    monkeypatch.setattr(spread, "BROADCAST_BYTES", 800)
    monkeypatch.setattr(spread, "HEAVY_PARTS", 10)
    monkeypatch.setattr(spread, "TILE_ROWS", 3)
    pipeline = ResolutionPipeline(MatchScorer(threshold=0.45), blank_emails=True)
    found = pipeline.resolve(frame(spark, records)).clusters.collect()
    expected = brute.components(
        [r["record_id"] for r in records], brute.matches(records, pipeline.scorer, True)
    )
    assert {r["record_id"]: r["entity_id"] for r in found} == expected


@pytest.mark.parametrize("threshold", [0.6, 0.45])
def test_matching_pairs(spark, threshold):
    records = people(80, seed=2)
    pipeline = ResolutionPipeline(MatchScorer(threshold=threshold))
    df = frame(spark, records)
    found = pipeline.matches(df)
    by_hand = compare_pairs(candidate_pairs(df, evidence=pipeline.scorer))
    assert pipeline.scorer.matches(by_hand).count() == found.count()
    scores = {(r["record_id_a"], r["record_id_b"]): r["match_score"] for r in found.collect()}
    assert scores == brute.matches(records, pipeline.scorer)


def test_candidate_pairs(spark):
    records = people(80, seed=4)
    df = frame(spark, records)
    every = [(x["record_id"], y["record_id"]) for x, y in brute.block_pairs(records)]

    def ids(**options):
        pairs = candidate_pairs(df, fields=("name",), **options)
        assert pairs.columns == ["record_id_a", "record_id_b", "name_a", "name_b"]
        return sorted((r[0], r[1]) for r in pairs.collect())

    def agreeing(*names, blank_emails=False):
        return sorted(
            (x["record_id"], y["record_id"])
            for x, y in brute.block_pairs(records)
            if any(brute.features(x, y, blank_emails)[n] for n in names)
        )

    assert ids(evidence=()) == sorted(every)
    assert ids(evidence=MatchScorer(threshold=0.2)) == sorted(every)
    assert ids(evidence=MatchScorer()) == agreeing("email_exact", "phone_exact")
    both = ("email", "phone")
    assert ids(evidence=both, blank_emails=True) == agreeing(
        "email_exact", "phone_exact", blank_emails=True
    )
    assert ids(evidence=("phone",)) == agreeing("phone_exact")
    with pytest.raises(TypeError):
        candidate_pairs(df)
    sizes = {r["block_key"]: r for r in block_sizes(df).collect()}
    assert sum(r["n_pairs"] for r in sizes.values()) == len(every)


@pytest.mark.parametrize("tile", [4000, 3])
def test_cleaned_once_for_a_record(spark, monkeypatch, tile):
    """Carried values give the same features, and no pair is trimmed or searched for digits."""
    monkeypatch.setattr(spread, "TILE_ROWS", tile)
    df = frame(spark, people(80, seed=5))
    plain, carried = (
        compare_pairs(candidate_pairs(df, evidence=MatchScorer(), cleaned=c)) for c in (False, True)
    )
    assert carried.columns == plain.columns
    assert sorted(carried.collect(), key=repr) == sorted(plain.collect(), key=repr)
    made = ("lower(", "regexp_replace(")
    for pairs in (carried, ResolutionPipeline().matches(df)):
        plan = pairs._jdf.queryExecution().optimizedPlan().toString()
        assert "levenshtein" in plan and not any(m in plan for m in made)


def test_trimmed_block_key(spark):
    df = frame(spark, [dict(zip(FIELDS, (i, n, "a@x", "1", "oslo"))) for i, n in enumerate((" bob", "bob"))])
    assert candidate_pairs(df, evidence=()).count() == 0
    assert candidate_pairs(df, evidence=(), trim_key=True).count() == 1
    assert ResolutionPipeline(trim_key=True).resolve(df).n_entities == 1


def test_repeated_ids_do_not_pair(spark):
    same = [dict(zip(FIELDS, (7, "ann", "a@x", "1", "oslo")))] * 2
    assert candidate_pairs(frame(spark, same), evidence=()).count() == 0
    assert [tuple(r) for r in resolve_entities(frame(spark, same)).clusters.collect()] == [(7, 7)] * 2


def test_comparison_branches(spark):
    # Pairs of (name, email, phone, city) and what name_sim, email_exact, phone_exact and
    # city_sim have to be.
    cases = [
        (("Otto Kern", "Ok@q", "+49 30 7", "Ulm"), ("otto kern ", " oK@Q", "(4930)7", "ulm"), (1, 1, 1, 1)),
        (("", "p@q", "-", "ulm"), (" ", "r@q", "12", "köln"), (1, 0, 0, 1 / 4)),
        (("nora", "  ", "8", "x"), ("cora", "", "9", "x"), (3 / 4, 0, 0, 1)),
        ((None, None, "77", None), ("nora", None, "7 7", None), (0, 0, 1, 0)),
    ]
    rows = [(k, *(v for pair in zip(a, b) for v in pair)) for k, (a, b, _) in enumerate(cases)]
    columns = "k long, " + ", ".join(f"{f}_{s} string" for f in FIELDS[1:] for s in "ab")
    pairs = spark.createDataFrame(rows, columns)
    features = ("name_sim", "email_exact", "phone_exact", "city_sim")
    found = {r["k"]: tuple(r[f] for f in features) for r in compare_pairs(pairs).collect()}
    for k, (_, _, expected) in enumerate(cases):
        assert found[k] == pytest.approx(expected)
    lenient = compare_pairs(pairs, blank_emails=True).filter("k = 2").first()
    assert lenient["email_exact"] == 1.0


def test_scorer(spark):
    # By the default weights 0.4, 0.3, 0.2 and 0.1: exactly 0.6, just below, and 0.5.
    rows = [(11, 12, 0.75, 1.0, 0.0, 0.0), (13, 14, 0.74, 1.0, 0.0, 0.0), (15, 16, 1.0, 0.0, 0.0, 1.0)]
    columns = "record_id_a long, record_id_b long, name_sim double, email_exact double, phone_exact double, city_sim double"
    compared = spark.createDataFrame(rows, columns)
    scored = {r["record_id_a"]: r for r in MatchScorer().score(compared).collect()}
    assert {k: r["is_match"] for k, r in scored.items()} == {11: True, 13: False, 15: False}
    assert scored[15]["match_score"] == pytest.approx(0.5)
    assert {r[0] for r in MatchScorer().matches(compared).collect()} == {11}
    other = MatchScorer({"extra": 3.0, "city_sim": 1.0}, 0.5)
    extra = other.score(compared.selectExpr("*", "0.5D AS extra")).collect()
    assert {r["match_score"] for r in extra} == {0.375, 0.625}


@pytest.mark.parametrize("weights", [{}, {"name_sim": 0.0}, {"name_sim": 1.0, "city_sim": -0.1}, {"name_sim": float("nan")}])
def test_weights_are_checked(weights):
    with pytest.raises(ValueError, match="weights"):
        MatchScorer(weights)


def test_what_default_weights_imply():
    scorer = MatchScorer()
    assert set(map(frozenset, scorer.certain_rules())) == {
        frozenset({"name_sim", "email_exact"}),
        frozenset({"name_sim", "phone_exact"}),
        frozenset({"email_exact", "phone_exact", "city_sim"}),
    }
    assert scorer.open_cases() == [("email_exact",), ("phone_exact",), ("email_exact", "phone_exact")]
    assert scorer.evidence() == ("email", "phone")
    assert MatchScorer(threshold=0.5).evidence() == ()


def test_guards(spark):
    df = frame(spark, people(2, 1))
    with pytest.raises(ValueError, match="missing required"):
        resolve_entities(df.drop("email"))
    with pytest.raises(ValueError, match="missing required"):
        candidate_pairs(df.drop("city"), evidence=())
    with pytest.raises(ValueError, match="no such feature"):
        ResolutionPipeline(MatchScorer({"age": 1.0})).resolve(df)
    with pytest.raises(ValueError, match="missing required"):
        connected_components(df, df)


def test_generated_customers(spark):
    customers = SyntheticCustomers(70, 0.4, seed=8).load(spark).withColumnRenamed("record_id", "key")
    report = resolve_entities(customers, id_col="key")
    assert report.clusters.columns == ["key", "entity_id"]
    assert 70 <= report.n_entities < report.n_records == customers.count()
    assert resolve_entities(customers, id_col="key", threshold=1.0).n_entities > report.n_entities


def test_cost_of_blank_emails_is_linear(spark):
    """Blank emails are no evidence, so no pair of a block meets because of them."""
    rows = spark.range(4000).selectExpr(
        "id AS record_id", "concat('n', id) AS name", "'' AS email", "concat('5', id) AS phone", "'rome' AS city"
    )
    assert candidate_pairs(rows, evidence=MatchScorer()).count() == 0
    assert resolve_entities(rows).n_entities == 4000


def test_closing_a_report_removes_its_tables(spark, records):
    from pathlib import Path

    from recordlens.storage import shared_folder

    folder = Path(shared_folder(spark), "recordlens")
    before = set(folder.rglob("*.parquet"))
    with ResolutionPipeline().resolve(frame(spark, records)) as report:
        assert report.n_records == len(records)
        assert set(folder.rglob("*.parquet")) > before
    assert set(folder.rglob("*.parquet")) == before


@pytest.mark.parametrize(
    ("weights", "threshold"), [("default", 0.6), ("default", 0.45), ("phone first", 0.75)]
)
def test_matches_per_class_connect_the_same(spark, records, weights, threshold):
    pipeline = ResolutionPipeline(MatchScorer(WEIGHTS[weights], threshold))
    df = frame(spark, [*records, {**records[0], "record_id": None}, records[1]])
    found = pipeline.matches(df, per_class=True)
    assert found.columns == ["record_id_a", "record_id_b"]
    every = pipeline.matches(df)
    ids = {tuple(sorted((r.record_id_a, r.record_id_b))) for r in every.collect()}
    assert {tuple(r) for r in found.collect()} <= ids
    expected, got = (
        sorted(map(tuple, connected_components(df, pairs).collect()), key=repr) for pairs in (every, found)
    )
    assert got == expected


def test_a_crowd_with_one_email_costs_a_pair_a_record(spark):
    """Different phones, two spellings of a name: all of them match all others."""
    rows = [(i, ("anna lee", "anna lea")[i % 2], "a@x", str(i), "oslo") for i in range(400)]
    found = ResolutionPipeline().matches(spark.createDataFrame(rows, SCHEMA), per_class=True)
    assert 399 <= found.count() <= 400
