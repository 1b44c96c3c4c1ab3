"""Arrow batches cut into pieces of bounded size."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def text_bytes(column: str = "text") -> Column:
    """The UTF-8 bytes of a text column; null counts as an empty text."""
    return F.coalesce(F.col(f"`{column}`").cast("string"), F.lit("")).cast("binary")


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Columns id and body alone, whatever else the table has."""
    return docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), text_bytes(text_col).alias("body"))


def slices(
    batches: Iterable[pa.RecordBatch], limit: int, body: str = "body"
) -> Iterator[pa.RecordBatch]:
    """The batches cut so that the bodies of a piece hold ``limit`` bytes or are one body."""
    for batch in batches:
        ends = batch.column(body).cast(pa.large_binary())
        offsets = pa.Array.from_buffers(
            pa.int64(), len(ends) + 1, [None, ends.buffers()[1]], offset=ends.offset
        ).to_numpy()
        start = 0
        while start < batch.num_rows:
            stop = start + 1
            while stop < batch.num_rows and offsets[stop + 1] - offsets[start] <= limit:
                stop += 1
            yield batch.slice(start, stop - start)
            start = stop


@contextmanager
def batches_up_to(spark: SparkSession, limit: int) -> Iterator[None]:
    """Jobs in this block send Python batches of about ``limit`` bytes.

    Spark's own limit lets both sides of a task hold tens of megabytes of wide rows.
    """
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name, None)
    spark.conf.set(name, limit)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)
