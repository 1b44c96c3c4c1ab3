"""Documents to training tokens: five stages, each one operator of recordlens.llm.

Every stage is written as Parquet and read again as the documents of the next one, so
a lost executor costs no more than the stage at hand.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordlens.llm.bpe import encode_and_decode
from recordlens.llm.decontamination import without_passages
from recordlens.llm.near_dedup import near_duplicates
from recordlens.llm.quality_rules import kept_documents
from recordlens.llm.queries import documents, tokenizer_file
from recordlens.llm.substring_dedup import remove_repeats
from recordlens.storage import Workspace


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line rules reject go; the others stay as they are."""
    return kept_documents(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the one with the smallest id stays.

    Rows without id stay, and so do all rows that share the id that stays.
    """
    found = near_duplicates(docs)
    # Written, so that Spark knows how few there are before it joins.
    gone = Workspace(spark, "pipeline").keep(found.filter("NOT kept").select("doc_id"), "gone")
    return docs.join(gone.distinct(), "doc_id", "left_anti").select(*docs.columns)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Windows of 20 words that begin earlier too are cut out of the texts."""
    # Under names of their own, since the operator adds columns.
    own = ("doc_id", "text", "n_chars")
    others = {c: f"carried_{i}" for i, c in enumerate(docs.columns) if c not in own}
    cut = remove_repeats(docs.withColumnsRenamed(others), carry=tuple(others.values()))
    cut = cut.withColumn("n_chars", F.length("text").cast("long"))
    return cut.select(*(F.col(f"`{others.get(c, c)}`").alias(c) for c in docs.columns))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark passage go."""
    return without_passages(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Encode what is left, and check that decoding gives it back.

    A little at a time, as the executors hold what the stages before have left behind.
    """
    return encode_and_decode(docs, tokenizer_file("byte_bpe_50k.json"), slice_bytes=1 << 20)


STAGES = [
    ("quality rules", quality_rules),
    ("near dedup", near_dedup),
    ("substring dedup", substring_dedup),
    ("decontamination", decontamination),
    ("tokens", tokens),
]

# Tokens are not SQL's to give; the tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; the last one's rows are returned."""
    work = Workspace(spark, "pipeline")
    docs = documents(spark, sf_dir)
    for number, (_, stage) in enumerate(STAGES):
        docs = work.keep(stage(spark, docs, sf_dir), f"stage-{number}")
    return docs
