"""Shards of bounded size by extendible hashing.

The directory is indexed by the leading bits of a row's hash. Bytes are summed once
per cell of so many bits, from the cells up to the root; a node that fits the limit
while its parent does not is a shard, so only oversized buckets split on another bit.
A cell that is still too large goes on with the next bits, alone. Rows of one key
share all bits of the key's hash; if together they exceed the limit, they are split
by bits of a number of their own, so every shard fits unless a single row does not.
"""

from __future__ import annotations

from math import ceil, log2

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordlens.storage import Workspace

# Bits of the key's hash, and then of the row's own number.
HASH_BITS = 60
# A cell holds about 1/8 of a shard at first; later rounds add so many bits.
SPARE_BITS = 3
MORE_BITS = 8


def hash_bits(key: Column) -> Column:
    """The first 60 bits of the MD5 of a key's text, as a number; null is an empty text."""
    text = F.coalesce(key.cast("string"), F.lit(""))
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def _cell(position: int, bits: int) -> Column:
    """Bits ``position`` and following of a row, as a number."""
    column = F.col("key_bits") if position < HASH_BITS else F.col("row_bits")
    shift = HASH_BITS - position % HASH_BITS - bits
    return F.shiftright(column, shift).bitwiseAND(F.lit((1 << bits) - 1))


def _ancestors(cells: DataFrame, bits: int) -> DataFrame:
    """Each cell with the nodes above it: depth and the leading bits so far."""
    return cells.withColumn("depth", F.explode(F.sequence(F.lit(0), F.lit(bits)))).withColumn(
        "node", F.expr(f"shiftright(cell, {bits} - depth)")
    )


def _round(
    rows: DataFrame, work: Workspace, position: int, bits: int, limit: int, name: str
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Directory of the cells that have their shard, cells that have none, and rows by cell."""
    rows = rows.withColumn("cell", _cell(position, bits))
    cells = work.keep(
        rows.groupBy("path", "cell").agg(
            F.sum("n_bytes").alias("bytes"), F.count(F.lit(1)).alias("docs")
        ),
        f"cells-{name}",
    )
    nodes = (
        _ancestors(cells, bits)
        .groupBy("path", "depth", "node")
        .agg(F.sum("bytes").alias("shard_bytes"), F.sum("docs").alias("shard_docs"))
        .withColumn("fits", (F.col("shard_bytes") <= limit) | (F.col("shard_docs") == 1))
    )
    above = nodes.select(
        "path",
        (F.col("depth") + 1).alias("depth"),
        F.col("node").alias("parent"),
        F.col("fits").alias("parent_fits"),
    )
    # A root that has a path is a bucket that did not fit in the round before.
    shards = (
        nodes.filter("fits")
        .withColumn("parent", F.expr("shiftright(node, 1)"))
        .join(above.hint("merge"), ["path", "depth", "parent"], "left")
        .filter(~F.coalesce("parent_fits", F.lit(False)))
        .drop("parent", "parent_fits", "fits")
    )
    directory = work.keep(
        _ancestors(cells.select("path", "cell"), bits).join(
            shards.hint("merge"), ["path", "depth", "node"]
        ),
        f"directory-{name}",
    )
    label = F.lpad(F.bin("cell"), bits, "0")
    fits = (F.col("bytes") <= limit) | (F.col("docs") == 1)
    open_cells = cells.filter(~fits).select("path", "cell", F.concat("path", label).alias("to"))
    return directory, open_cells, rows


def extendible_shards(
    docs: DataFrame,
    *,
    max_bytes: int,
    key_cols: tuple[str, ...] = ("doc_id",),
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """The shard of every row: doc_id, n_bytes, shard, depth, shard_bytes, shard_docs.

    ``shard`` is the prefix of hash bits that the shard's rows share, as a string of 0
    and 1 that is empty while everything fits one shard; ``depth`` is its length. A
    text of more than ``max_bytes`` bytes has a shard to itself. A null text has no
    bytes, null key columns are empty texts, other columns are ignored. Only rows whose
    keys are equal and exceed the limit together are told apart by row.
    """
    work = Workspace(docs.sparkSession, "shards")
    key = F.concat_ws(
        "\x1f", *(F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in key_cols)
    )
    text = F.col(f"`{text_col}`").cast("string")
    # Written once, so that the numbers of the rows stay what they are.
    rows = work.keep(
        docs.select(
            F.col(f"`{id_col}`").cast("long").alias("doc_id"),
            F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("n_bytes"),
            hash_bits(key).alias("key_bits"),
            hash_bits(F.monotonically_increasing_id()).alias("row_bits"),
        ),
        "rows",
    ).withColumn("path", F.lit(""))
    total = rows.agg(F.sum("n_bytes")).first()[0] or 0
    position, bits = 0, min(ceil(log2(max(total / max_bytes, 1))) + SPARE_BITS, HASH_BITS // 2)
    placed, number = None, 0
    while True:
        directory, open_cells, rows = _round(rows, work, position, bits, max_bytes, str(number))
        own = F.substring(F.lpad(F.bin("cell"), bits, "0"), F.lit(1), F.col("depth"))
        # The directory grows with the input and is small when compressed, so Spark would
        # broadcast more than it should: the joins here are merge joins.
        found = rows.join(directory.hint("merge"), ["path", "cell"]).select(
            "doc_id",
            "n_bytes",
            F.concat("path", own).alias("shard"),
            (F.length("path") + F.col("depth")).alias("depth"),
            "shard_bytes",
            "shard_docs",
        )
        placed = found if placed is None else placed.unionByName(found)
        position, number = position + bits, number + 1
        if position >= 2 * HASH_BITS or open_cells.isEmpty():
            return placed
        rows = (
            rows.join(open_cells.hint("merge"), ["path", "cell"])
            .withColumn("path", F.col("to"))
            .drop("cell", "to")
        )
        bits = min(MORE_BITS, HASH_BITS - position % HASH_BITS)
