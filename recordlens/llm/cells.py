"""A set of query items that meets all rows, in cells.

The items are dealt into blocks of bounded size and the rows into a fixed number of
splits; a cell is one block and one split, and one partition. Each item is copied to the
splits of its block, each row to the blocks. In a cell the items come first, so a task
holds the items of one block and streams the rows past them: its memory does not depend
on how many rows there are. A task reports once per item, so what leaves the cells is
items times splits and does not grow with the rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def in_cells(
    items: DataFrame, rows: DataFrame, *, n_blocks: int, n_splits: int, key: Column
) -> DataFrame:
    """Both tables under one another, dealt into cells, items (``is_row`` false) first.

    Args:
        items: With a column ``block`` from 0 to ``n_blocks`` - 1.
        rows: All rows.
        n_blocks: Number of blocks of items.
        n_splits: Number of splits of the rows.
        key: What deals a row to its split. Rows with equal keys are spread by the
            partition that they come from, so that no key is too frequent.
    """

    def every(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1))) if n > 1 else F.lit(0)

    split = F.pmod(F.xxhash64(key, F.spark_partition_id()), F.lit(n_splits)).cast("int")
    met = items.withColumns({"split": every(n_splits), "is_row": F.lit(False)}).unionByName(
        rows.withColumn("split", split).withColumns(
            {"block": every(n_blocks), "is_row": F.lit(True)}
        ),
        allowMissingColumns=True,
    )
    cell = (F.col("block") * n_splits + F.col("split")).cast("int")
    return (
        met.repartitionById(n_blocks * n_splits, cell)
        .drop("block", "split")
        .sortWithinPartitions("is_row")
    )


def items_then_rows(
    batches: Iterator[pa.RecordBatch],
) -> tuple[pa.Table | None, Iterator[pa.RecordBatch]]:
    """The items of a cell, or None if it has none, and its rows as they come."""
    batches = iter(batches)
    items: list[pa.RecordBatch] = []
    first = None
    for batch in batches:
        n_items = batch.num_rows - batch.column("is_row").true_count
        if n_items:
            items.append(batch.slice(0, n_items))
        if n_items < batch.num_rows:
            first = batch.slice(n_items)
            break

    def rows() -> Iterator[pa.RecordBatch]:
        if first is not None:
            yield first
        yield from batches

    return (pa.Table.from_batches(items) if items else None), rows()
