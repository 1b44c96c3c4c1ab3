"""Chunks of documents that ask the whole corpus about what they hold.

A chunk is all documents whose ids fall into one class, a few megabytes of text. It
asks with the distinct 64-bit keys that it holds; the keys are dealt by range into
buckets, each bucket sees all chunks' keys in its range, and every chunk gets its
answers back in the order in which it asked. A key costs one entry per chunk however
often it occurs there, so a key that fills a third of the corpus is no larger in its
bucket than any other key that every chunk holds.

The documents are shuffled once by chunk; all steps over the chunks read that shuffle.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordlens.llm.batches import text_bytes

CHUNK_BYTES = 4 << 20
# Beyond so many chunks they grow instead, which bounds what a key costs its bucket.
MOST_CHUNKS = 1 << 20
BUCKET_KEYS = 400_000

ASKED = "chunk long, bucket long, keys binary, counts binary"
ANSWERED = "chunk long, bucket long, answer binary"


@dataclass(frozen=True)
class Corpus:
    """Documents by chunk: columns chunk, id, body and the ones carried along."""

    docs: DataFrame
    n_bytes: int
    n_chunks: int
    carried: tuple[str, ...]

    def buckets(self, bytes_per_key: float) -> int:
        """How many buckets hold the keys, if a chunk has one in so many bytes."""
        return max(1, math.ceil(self.n_bytes / bytes_per_key / BUCKET_KEYS))


def corpus(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    carry: tuple[str, ...] = (),
    chunk_bytes: int = CHUNK_BYTES,
) -> Corpus:
    """The documents dealt into chunks; a null text is empty, a null id an id of its own.

    Rows with the same id share a chunk. Columns in ``carry`` come along as c0, c1, ...
    """
    size = docs.agg(F.sum(F.octet_length(F.col(f"`{text_col}`").cast("string")))).first()[0] or 0
    n_chunks = min(max(1, math.ceil(size / chunk_bytes)), MOST_CHUNKS)
    key = F.col(f"`{id_col}`").cast("long")
    dealt = docs.select(
        F.pmod(F.xxhash64(key), F.lit(n_chunks)).alias("chunk"),
        key.alias("id"),
        text_bytes(text_col).alias("body"),
        *(F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(carry)),
    )
    return Corpus(dealt, size, n_chunks, carry)


def in_order(table: pa.Table) -> pa.Table:
    """A chunk's documents by id, null ids last, and by text; the same in every step."""
    order = pa.compute.sort_indices(
        table.select(["id", "body"]),
        sort_keys=[("id", "ascending"), ("body", "ascending")],
        null_placement="at_end",
    )
    return table.take(order)


def chunk_of(table: pa.Table) -> int:
    return table.column("chunk")[0].as_py()


def bucket_of(keys: np.ndarray, n_buckets: int) -> np.ndarray:
    """The range of 64-bit keys that each key falls into."""
    return ((keys >> np.uint64(32)) * np.uint64(n_buckets) >> np.uint64(32)).astype(np.int64)


def ask(chunk: int, keys: np.ndarray, counts: np.ndarray, n_buckets: int) -> pa.Table:
    """A chunk's distinct sorted keys, with how often it holds each, by bucket."""
    buckets = bucket_of(keys, n_buckets)
    cuts = np.flatnonzero(np.diff(buckets)) + 1
    starts = np.concatenate(([0], cuts)) if len(keys) else np.empty(0, np.int64)
    ends = np.concatenate((cuts, [len(keys)])) if len(keys) else starts
    counts = counts.astype(np.int32)
    return pa.table(
        {
            "chunk": pa.array(np.full(len(starts), chunk, np.int64)),
            "bucket": pa.array(buckets[starts] if len(keys) else starts, pa.int64()),
            "keys": pa.array([keys[a:b].tobytes() for a, b in zip(starts, ends)], pa.binary()),
            "counts": pa.array([counts[a:b].tobytes() for a, b in zip(starts, ends)], pa.binary()),
        }
    )


def answers(
    asked: DataFrame,
    reply: Callable[[np.ndarray, np.ndarray], np.ndarray],
    summary: Callable[[np.ndarray, np.ndarray], bytes] | None = None,
) -> DataFrame:
    """What the whole corpus says to each chunk.

    ``reply`` gets, for every distinct key of a bucket, how often all chunks hold it
    and how many chunks do, and gives an array of answers. Chunks that would get
    nothing but zeros get no row. With ``summary``, what that function makes of a
    bucket's distinct keys and totals is given as the answer to chunk -1.
    """

    def combine(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        keys = [np.frombuffer(k, np.uint64) for k in table.column("keys").to_pylist()]
        counts = np.concatenate(
            [np.frombuffer(c, np.int32) for c in table.column("counts").to_pylist()]
        )
        ends = np.cumsum([len(k) for k in keys])
        all_keys = np.concatenate(keys)
        order = np.argsort(all_keys, kind="stable")
        ordered = all_keys[order]
        first = np.concatenate(([True], ordered[1:] != ordered[:-1]))
        at = np.flatnonzero(first)
        totals = np.add.reduceat(counts[order].astype(np.int64), at)
        chunks = np.diff(np.append(at, len(ordered)))
        given = reply(totals, chunks)
        back = np.empty(len(ordered), given.dtype)
        back[order] = given[np.cumsum(first) - 1]
        parts = np.split(back, ends[:-1])
        some = [i for i, p in enumerate(parts) if p.any()]
        askers, bucket = table.column("chunk").to_numpy()[some], table.column("bucket")[0].as_py()
        given_back = [parts[i].tobytes() for i in some]
        if summary is not None:
            askers = np.append(askers, -1)
            given_back.append(summary(ordered[at], totals))
        return pa.table(
            {
                "chunk": pa.array(askers, pa.int64()),
                "bucket": pa.array(np.full(len(askers), bucket), pa.int64()),
                "answer": pa.array(given_back, pa.binary()),
            }
        )

    return asked.groupBy("bucket").applyInArrow(combine, ANSWERED)


def told(table: pa.Table, keys: np.ndarray, n_buckets: int, dtype: type) -> np.ndarray:
    """The answers to a chunk's distinct sorted keys."""
    found = np.zeros(len(keys), dtype)
    if table.num_rows:
        buckets = bucket_of(keys, n_buckets)
        for bucket, answer in zip(
            table.column("bucket").to_pylist(), table.column("answer").to_pylist()
        ):
            start = np.searchsorted(buckets, bucket)
            values = np.frombuffer(answer, dtype)
            found[start : start + len(values)] = values
    return found
