"""Every query with an oracle, against an independent engine on the smallest tables."""

import importlib
from pathlib import Path

import pytest

duckdb = pytest.importorskip("duckdb")
TABLES = Path("/root/testdata/sf0.001")
contract = importlib.import_module("__spark_entry__")
QUERIES = importlib.import_module("recordlens.plans.catalogue").QUERIES
ORACLES = {name: sql for name, sql in contract.oracle_sql().items() if name in QUERIES}

pytestmark = pytest.mark.skipif(not TABLES.is_dir(), reason="needs the driver's tables")


@pytest.fixture(scope="module")
def engine():
    connection = duckdb.connect()
    for table in TABLES.glob("*.parquet"):
        connection.execute(f"CREATE VIEW {table.stem} AS SELECT * FROM '{table}'")
    return connection


def ordered(rows):
    return sorted(rows, key=lambda row: tuple((v is None, v) for v in row))


def test_only_approximate_queries_lack_an_oracle():
    assert set(QUERIES) - set(ORACLES) == {"iqr_events_approximate"}


@pytest.mark.parametrize("name", ORACLES)
def test_same_rows(spark, engine, name):
    df = QUERIES[name](spark, str(TABLES))
    expected = engine.execute(ORACLES[name])
    columns = sorted(c[0] for c in expected.description)
    at = {c[0]: i for i, c in enumerate(expected.description)}
    wanted = [tuple(r[at[c]] for c in columns) for r in expected.fetchall()]
    assert sorted(df.columns) == columns
    assert ordered(tuple(r[c] for c in columns) for r in df.collect()) == ordered(wanted)


def test_entry(spark):
    rows = {r["capability"]: r for r in contract.entry(spark).collect()}
    assert set(rows) == {"zscore", "gaussian", "resolution"}
