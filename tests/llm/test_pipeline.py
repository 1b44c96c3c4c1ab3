"""The registered queries against SQL, and the pipeline against a brute-force version."""

import hashlib
import importlib
from pathlib import Path

import pytest

from recordlens.llm import oracles, queries
from tests.llm.test_near_dedup import expected as near_duplicates
from tests.llm.test_repeats import without_later_windows
from tests.llm.texts import lower, words

duckdb = pytest.importorskip("duckdb")
TABLES = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not TABLES.is_dir(), reason="needs the driver's tables")


@pytest.fixture(scope="module")
def engine():
    connection = duckdb.connect()
    for table in TABLES.glob("*.parquet"):
        connection.execute(f"CREATE VIEW {table.stem} AS SELECT * FROM '{table}'")
    return connection


def ordered(rows):
    return sorted(rows, key=lambda row: tuple((v is None, v) for v in row))


def test_one_query_per_operator():
    contract = importlib.import_module("__spark_entry__")
    names = contract.queries()
    for n in range(1, 11):
        assert sum(name.startswith(f"op{n}_") for name in names) == 1
    assert "pipeline" in names
    assert set(queries.ORACLES) <= set(queries.QUERIES)


@pytest.mark.parametrize("name", queries.ORACLES)
def test_same_rows_as_sql(spark, engine, name):
    found = engine.execute(queries.ORACLES[name])
    columns = [c[0] for c in found.description]
    df = queries.QUERIES[name](spark, str(TABLES))
    assert sorted(df.columns) == sorted(columns)
    assert ordered(tuple(r) for r in df.select(*columns).collect()) == ordered(found.fetchall())


def test_passages_of_the_tables(spark, engine):
    items = engine.execute("SELECT item_id, text FROM benchmark").fetchall()
    docs = engine.execute("SELECT doc_id, text FROM documents").fetchall()
    found = queries.op9_decontamination(spark, str(TABLES)).collect()
    assert {(r.doc_id, r.item_id) for r in found} == leaks(docs, items)


def shingles(text):
    own = words(lower(text))
    return {tuple(own[i : i + 5]) for i in range(max(len(own) - 4, 1))}


def leaks(docs, items):
    """Pairs of documents and items of whose shingles they have at least 4/5."""
    of_items = {i: shingles(t) for i, t in items}
    return {
        (d, i)
        for d, t in docs
        for here in [shingles(t)]
        for i, own in of_items.items()
        if len(own & here) >= 0.8 * len(own)
    }


def test_pipeline(spark, engine):
    tokenizers = pytest.importorskip("tokenizers")
    import corpus_pipeline

    library = tokenizers.Tokenizer.from_file(queries.tokenizer_file("byte_bpe_50k.json"))
    kept = {r[0] for r in engine.execute(f"SELECT doc_id FROM ({oracles.quality_rules()}) WHERE kept").fetchall()}
    docs = [r for r in engine.execute("SELECT doc_id, text FROM documents").fetchall() if r[0] in kept]
    first = {i for i, _, _, stays in near_duplicates(docs) if stays}
    docs = [(i, t) for i, t in docs if i in first]
    docs = [(i, text) for i, _, _, text in without_later_windows(docs, 20)]
    items = engine.execute("SELECT item_id, text FROM benchmark").fetchall()
    gone = {d for d, _ in leaks(docs, items)}
    wanted = []
    for i, text in docs:
        if i not in gone:
            ids = library.encode(text, add_special_tokens=False).ids
            digest = [hashlib.sha256(x.encode()).hexdigest() for x in (",".join(map(str, ids)), text)]
            wanted.append((i, len(ids), *digest, True))
    found = corpus_pipeline.run(spark, str(TABLES)).collect()
    assert sorted(map(tuple, found)) == sorted(wanted)
    assert 0 < len(wanted) < 200


def test_stages_keep_the_columns_of_documents(spark):
    import corpus_pipeline

    docs = queries.documents(spark, str(TABLES))
    odd = docs.limit(3).selectExpr("doc_id + 9000000 AS doc_id", "CAST(NULL AS STRING) AS text", "lang", "source", "n_chars")
    both = docs.limit(20).unionByName(odd)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        for given in (both, both.limit(0)):
            out = stage(spark, given, str(TABLES))
            assert out.dtypes == docs.dtypes, name
            out.count()
    assert corpus_pipeline.STAGES[-1][1](spark, both.limit(0), str(TABLES)).count() == 0


def test_stages_leave_clashing_columns_alone(spark):
    """A column of the documents that is named like one of an operator keeps its values."""
    import corpus_pipeline
    from pyspark.sql import functions as F

    docs = queries.documents(spark, str(TABLES)).limit(60)
    extra = {"n_words": F.lit(-7), "n_removed": F.lit(-8), "id": F.lit("x"), "body": F.lit("y"), "c0": F.lit(1.5)}
    odd = docs.withColumns(extra | {"kept": F.lit(False), "carried_0": F.col("doc_id") + 1})
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, odd, str(TABLES))
        assert out.columns == odd.columns, name
        rows = out.collect()
        assert rows, name
        for r in rows:
            assert (r.n_words, r.n_removed, r.id, r.body, r.c0, r.kept) == (-7, -8, "x", "y", 1.5, False), name
            assert r.carried_0 == r.doc_id + 1, name


def test_null_and_repeated_ids_and_no_benchmark(spark, tmp_path):
    import corpus_pipeline

    docs = queries.documents(spark, str(TABLES))
    nothing = spark.read.parquet(str(TABLES / "benchmark.parquet")).limit(0)
    nothing.write.parquet(str(tmp_path / "benchmark.parquet"))
    odd = docs.limit(40).unionByName(docs.limit(5)).unionByName(docs.limit(5).selectExpr("CAST(NULL AS LONG) AS doc_id", "text", "lang", "source", "n_chars"))
    stages = dict(corpus_pipeline.STAGES)
    kept = stages["decontamination"](spark, odd, str(tmp_path))
    assert sorted(map(repr, kept.collect())) == sorted(map(repr, odd.collect()))
    stay = stages["near dedup"](spark, odd, str(tmp_path))
    assert stay.filter("doc_id IS NULL").count() == 5
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, odd, str(TABLES)).count() >= 0, name
