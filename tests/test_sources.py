import pytest
from pyspark.sql import functions as F

from recordlens import Scorecard, run_scorecard
from recordlens.sources import (
    DataSource,
    SyntheticCustomers,
    SyntheticTransactions,
    plant_anomalies,
    plant_duplicates,
)
from recordlens.sources.planted import COPY_SLOTS, changed_name
from recordlens.storage import shared_folder


def test_generated_transactions(spark):
    source = SyntheticTransactions(30, 40, anomaly_rate=0.08, seed=4)
    df = source.load(spark)
    assert isinstance(source, DataSource)
    assert not isinstance(object(), DataSource)
    assert df.dtypes == [("txn_id", "bigint"), ("customer_id", "bigint"), ("amount", "double"), ("is_anomaly", "bigint")]
    n, ids, customers, odd, least = df.agg(
        F.count("*"), F.count_distinct("txn_id"), F.count_distinct("customer_id"),
        F.sum("is_anomaly"), F.min("amount"),
    ).first()
    assert (n, ids, customers) == (1200, 1200, 30)
    assert 60 <= odd <= 140
    assert least > 0


def test_planted_anomalies_do_not_depend_on_partitions(spark):
    rows = spark.range(500).selectExpr("id AS k", "id / 10 AS v", "'x' AS other")
    planted = plant_anomalies(rows, id_col="k", value_col="v", rate=0.1, factor=100.0)
    first = planted.orderBy("k").collect()
    assert plant_anomalies(rows.repartition(7), id_col="k", value_col="v", rate=0.1, factor=100.0).orderBy("k").collect() == first
    assert all(r["v"] == r["k"] / 10 * (100 if r["is_anomaly"] else 1) for r in first)
    assert 25 <= sum(r["is_anomaly"] for r in first) <= 80


def test_planted_duplicates(spark):
    rows = [(i, f"Name {chr(97 + i % 5)}{i}", f"m{i}@x", f"{i:05}", "bonn") for i in range(60)]
    records = spark.createDataFrame(rows, "record_id long, name string, email string, phone string, city string")
    planted = plant_duplicates(records, dup_rate=0.5).collect()
    by_id = {r["record_id"]: r for r in planted}
    assert len(by_id) == len(planted) > 75
    for r in planted:
        original = by_id[r["true_entity_id"] * COPY_SLOTS]
        assert (r["name"][0], r["city"]) == (original["name"][0], original["city"])
        assert (r["email"] or "").strip().lower() in ("", original["email"])
        assert r["phone"].strip("()") in ("", original["phone"])
    assert plant_duplicates(records, dup_rate=0.0).count() == 60


def test_generated_customers(spark):
    source = SyntheticCustomers(n_entities=45, dup_rate=0.7, seed=9)
    df = source.load(spark)
    assert isinstance(source, DataSource)
    assert df.columns == ["record_id", "name", "email", "phone", "city", "true_entity_id"]
    assert df.select("true_entity_id").distinct().count() == 45 < df.count()


@pytest.mark.parametrize(
    ("style", "place", "name", "expected"),
    [
        (0.1, 0.0, "kurt", "kuurt"),
        (0.1, 0.99, "kurt", "kurrt"),
        (0.5, 0.0, "kurt", "krut"),
        (0.5, 0.99, "kurt", "kutr"),
        (0.9, 0.5, "kurt", "KURT"),
        (0.1, 0.5, "ed", "ed"),
    ],
)
def test_changed_name(spark, style, place, name, expected):
    df = spark.createDataFrame([(name, style, place)], "n string, s double, p double")
    assert df.select(changed_name(F.col("n"), F.col("s"), F.col("p"))).first()[0] == expected


def test_scorecard(spark):
    card = run_scorecard(SyntheticTransactions().load(spark), SyntheticCustomers().load(spark))
    assert isinstance(card, Scorecard)
    assert card.n_txns == 9_000
    assert card.n_records > card.n_entities
    assert card.gaussian_metrics.recall >= card.zscore_metrics.recall
    assert min(card.gaussian_metrics.precision, card.zscore_metrics.precision) >= 0.8
    assert card.resolution_metrics.precision >= 0.99
    assert card.resolution_metrics.recall >= 0.5


def test_shared_folder():
    class Conf(dict):
        pass

    class Context:
        def __init__(self, master):
            self.master, self.folder = master, None

        def getCheckpointDir(self):
            return self.folder

        def setCheckpointDir(self, folder):
            self.folder = folder

    class Session:
        def __init__(self, master, **conf):
            self.conf, self.sparkContext = Conf(conf), Context(master)

    named = Session("yarn", **{"spark.checkpoint.dir": "hdfs://shared/"})
    assert shared_folder(named) == "hdfs://shared"
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(Session("spark://host:7077"))
    local = Session("local[2]")
    assert shared_folder(local) == shared_folder(local) == local.sparkContext.folder
