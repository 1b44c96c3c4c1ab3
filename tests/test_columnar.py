"""The library's own format against Spark's Parquet reader."""

import datetime
import math

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from recordlens import detect_anomalies
from recordlens.sources import ColumnarTable, DataSource

DAY = datetime.datetime(2024, 1, 1)
ROWS = [
    {
        "id": i,
        "kind": [None, "a", "b", "ab"][i % 4],
        "value": [1.0, None, math.nan, math.inf, float(i)][i % 5],
        "small": i % 100 if i % 7 else None,
        "at": DAY + datetime.timedelta(hours=i),
        "odd.name": i % 3,
        "list": [i],
    }
    for i in range(1000)
]


@pytest.fixture(scope="module")
def table(tmp_path_factory):
    folder = tmp_path_factory.mktemp("table")
    schema = pa.schema(
        [("id", pa.int64()), ("kind", pa.string()), ("value", pa.float64()), ("small", pa.int32())]
        + [("at", pa.timestamp("us", "UTC")), ("odd.name", pa.int16()), ("list", pa.list_(pa.int64()))]
    )
    for part in range(2):
        rows = pa.Table.from_pylist(ROWS[part * 500 : part * 500 + 500], schema)
        pq.write_table(rows, folder / f"part-{part}.parquet", row_group_size=100)
    return str(folder)


CONDITIONS = [
    "true",
    "id >= 250 AND id < 260",
    "id = 7 OR id = 8",
    "id IN (1, 2, 999) AND kind IS NOT NULL",
    "NOT id IN (1, 2)",
    "NOT small IN (1, 2, 3)",
    "NOT kind = 'a'",
    "kind <> 'a' AND kind LIKE '%b'",
    "kind LIKE 'a%'",
    "kind LIKE '%b%'",
    "kind IS NULL",
    "NOT kind IS NULL",
    "kind <=> NULL",
    "small > 90",
    "small = 100000000000",
    "value > 10",
    "value IS NULL",
    "isnan(value)",
    "at >= timestamp'2024-01-20 00:00:00'",
    "`odd.name` = 1",
    "list[0] > 990",
    "id < 0",
]


@pytest.mark.parametrize("condition", CONDITIONS)
def test_filters(spark, table, condition):
    own = ColumnarTable(table).load(spark).filter(condition)
    other = spark.read.parquet(table).filter(condition)
    assert own.schema.simpleString() == other.schema.simpleString()
    found, expected = (
        sorted(df.select("id", "kind", "small", "at").collect(), key=lambda r: r["id"])
        for df in (own, other)
    )
    assert found == expected


def test_filters_reach_the_scan_and_choose_row_groups(spark, table, capsys):
    rows = ColumnarTable(table, ("id", "kind")).load(spark)
    assert rows.columns == ["id", "kind"] and rows.rdd.getNumPartitions() == 10
    some = rows.filter("id >= 250 AND id < 310 AND kind = 'a'")
    some.explain("formatted")
    plan = capsys.readouterr().out
    # What the format takes over does not stand above its scan any more.
    assert "BatchScan recordlens" in plan and "Condition :" not in plan
    assert "GreaterThanOrEqual(id,250), LessThan(id,310), EqualTo(kind,a)" in plan
    assert some.rdd.getNumPartitions() == 2 and some.count() == 15


def test_only_numbers(spark, table):
    rows = ColumnarTable(table, numeric="value").load(spark)
    expected = [r["id"] for r in ROWS if r["value"] is not None and math.isfinite(r["value"])]
    assert sorted(r["id"] for r in rows.select("id").collect()) == expected
    assert ColumnarTable(table, numeric="small").load(spark).count() == sum(r["small"] is not None for r in ROWS)


def test_as_detection_input(spark, table):
    source = ColumnarTable(table, ("id", "value"), "value")
    assert isinstance(source, DataSource)
    flagged, expected = (
        sorted(r["id"] for r in detect_anomalies(df, "value", threshold=1.5).flagged.collect())
        for df in (source.load(spark), spark.read.parquet(table))
    )
    assert flagged == expected and flagged


def test_columns_are_checked(spark, table):
    for source in (ColumnarTable(table, ("id", "nothing")), ColumnarTable(table, numeric="nothing")):
        with pytest.raises(Exception, match="no such columns"):
            source.load(spark).collect()
