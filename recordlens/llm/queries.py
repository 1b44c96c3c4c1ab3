"""The operators as queries over the driver's tables, and SQL for those it can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordlens.llm.oracles import oracles
from recordlens.storage import Workspace


# A shard's limit, small enough that the test tables have many shards.
SHARD_BYTES = 1 << 20


def tokenizer_file(name: str) -> str:
    """Where a public tokenizer's file lies on this machine and on the executors."""
    import public_tokenizers

    return public_tokenizers.path(name)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from recordlens.llm.substring_dedup import remove_repeats

    return remove_repeats(documents(spark, sf_dir)).select(
        "doc_id", "n_words", "n_removed", F.sha2(F.col("text"), 256).alias("kept_sha256")
    )


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    from recordlens.llm.sharding import extendible_shards

    return extendible_shards(documents(spark, sf_dir), max_bytes=SHARD_BYTES)


def op3_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    from recordlens.llm.suffix_array import remove_repeated_bytes

    return remove_repeated_bytes(documents(spark, sf_dir)).select(
        "doc_id",
        "n_bytes",
        "n_removed",
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2(F.col("kept"), 256).alias("kept_sha256"),
    )


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from recordlens.llm.token_counts import token_counts

    return token_counts(documents(spark, sf_dir), tokenizer_file("word_bpe_49k.json"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from recordlens.llm.quality_rules import quality_report

    return quality_report(documents(spark, sf_dir))


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    from recordlens.llm.bpe import encode_and_decode

    return encode_and_decode(documents(spark, sf_dir), tokenizer_file("byte_bpe_50k.json"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from recordlens.llm.decontamination import find_passages

    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return find_passages(documents(spark, sf_dir), items)


def op6_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    from recordlens.llm.lm_scoring import lm_scores

    return lm_scores(documents(spark, sf_dir))


def op5_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from recordlens.llm.near_dedup import near_duplicates

    return near_duplicates(documents(spark, sf_dir))


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from recordlens.llm.licenses import license_scan

    # The documents have no paths: source and language are directories, and so are
    # each thousand ids.
    path = F.concat_ws(
        "/",
        "source",
        "lang",
        F.floor(F.col("doc_id") / 1000).cast("string"),
        F.concat(F.col("doc_id").cast("string"), F.lit(".txt")),
    )
    return license_scan(documents(spark, sf_dir), path)


def op11_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from recordlens.llm.warc import page_number, read_archives, write_archives

    folder = f"{Workspace(spark, 'archives').folder}/warc"
    write_archives(spark.read.parquet(f"{sf_dir}/pages.parquet"), folder)
    return read_archives(spark, folder, with_payload=False).select(
        page_number(F.col("record_id")).alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        page_number(F.col("refers_to")).alias("refers_to"),
        "problem",
    )


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    from recordlens.llm.lexical_search import search

    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return search(documents(spark, sf_dir), items)


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    from recordlens.llm.hard_negatives import hard_negatives

    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    number = F.col("vec_id")
    moved = F.when(number % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(vectors.withColumn("label", moved), number % 100 == 0)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_sharding": op2_sharding,
    "op3_suffix_array": op3_suffix_array,
    "op4_token_counts": op4_token_counts,
    "op5_near_dedup": op5_near_dedup,
    "op6_lm_scores": op6_lm_scores,
    "op7_quality_rules": op7_quality_rules,
    "op8_bpe": op8_bpe,
    "op9_decontamination": op9_decontamination,
    "op10_license_scan": op10_license_scan,
    "op11_warc": op11_warc,
    "op12_lexical_search": op12_lexical_search,
    "op13_hard_negatives": op13_hard_negatives,
}

ORACLES = oracles(SHARD_BYTES)
