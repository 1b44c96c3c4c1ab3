"""Hard negatives of anchors by exact integer inner products, Kronecker-packed.

Vectors become whole numbers. Several rows' components, biased so that none is negative,
are laid into separate fields of one 64-bit word; one multiplication per component of the
anchor then serves all of them, and the fields of the sum are the exact inner products.
Fields are as wide as the largest sum needs, so nothing carries over. Numbers that need
more than 64 bits are packed into Python's unbounded integers in the same way.

Two passes over the cells of anchors and rows: the first finds each anchor's positives,
whose scores give the bands in which the second looks for negatives.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recordlens.functions.names import named
from recordlens.llm.cells import in_cells, items_then_rows
from recordlens.storage import Workspace

# Anchors that a task holds, tasks that share the rows of a block, and scores at a time.
BLOCK_ANCHORS = 8192
SPLITS = 32
SCORES_AT_ONCE = 1 << 19
LOWEST, HIGHEST = -(2**63), 2**63 - 1

FOUND = "anchor_id long, nth int, best array<struct<score: long, id: long>>"


def packed_products(anchors: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Inner products of all anchors with all rows, exact; beyond 64 bits the nearest long.

    Args:
        anchors: Whole numbers, one anchor per line.
        rows: Whole numbers, one row per line, as many columns as ``anchors``.
    """
    shape = (len(anchors), len(rows))
    if not all(shape) or not anchors.shape[1]:
        return np.zeros(shape, np.int64)
    largest = max(abs(int(x)) for a in (anchors, rows) for x in (a.min(), a.max()))
    small = largest < 2**31
    a = anchors if small else anchors.astype(object)
    base = int(rows.min())
    most = int(rows.max()) - base
    above = int(np.where(a > 0, a, 0).sum(axis=1).max())
    below = -int(np.where(a < 0, a, 0).sum(axis=1).min())
    # A field holds below * most, which keeps it from being negative, and its sum.
    lift = below * most
    width = max(1, (lift + above * most).bit_length())
    wide = not small or width > 62
    fields = 4 if wide else 64 // width
    kind = object if wide else np.uint64
    biased = (rows.astype(object) - base) if wide else (rows - base).astype(np.uint64)
    n_words = -(-len(rows) // fields)
    padded = np.zeros((n_words * fields, rows.shape[1]), kind)
    padded[: len(rows)] = biased
    word = lambda x: x if wide else np.uint64(x)
    packed = padded[0::fields].copy()
    for j in range(1, fields):
        packed += padded[j::fields] << word(width * j)
    every = sum(lift << (width * j) for j in range(fields))
    # Negative anchors wrap round in 64 bits; the lifted sums do not.
    sums = (a.astype(object) if wide else a.astype(np.uint64)) @ packed.T + word(every)
    mask = word((1 << width) - 1)
    whole = a.sum(axis=1) if small else a.astype(object).sum(axis=1)
    shift = (whole.astype(object) * base - lift) if wide else whole * base - lift
    out = np.empty((len(anchors), n_words * fields), object if wide else np.int64)
    for j in range(fields):
        field = (sums >> word(width * j)) & mask
        out[:, j::fields] = (field if wide else field.astype(np.int64)) + shift[:, None]
    out = out[:, : len(rows)]
    return np.clip(out, LOWEST, HIGHEST).astype(np.int64) if wide else out


class Best:
    """The k best (score, id) of many lists; an id counts once, with its best score."""

    def __init__(self, n_lists: int, k: int) -> None:
        self.k = k
        self.lists, self.scores, self.ids = (np.empty(0, np.int64) for _ in range(3))
        # What a new entry must reach.
        self.floor = np.full(n_lists, LOWEST, np.int64)

    def offer(self, lists: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        if not len(lists):
            return
        lists = np.concatenate([self.lists, lists])
        scores = np.concatenate([self.scores, scores])
        ids = np.concatenate([self.ids, ids])
        # The complement falls as the score rises and, unlike the negative, never overflows.
        order = np.lexsort((~scores, ids, lists))
        lists, scores, ids = lists[order], scores[order], ids[order]
        once = np.append(True, (lists[1:] != lists[:-1]) | (ids[1:] != ids[:-1]))
        lists, scores, ids = lists[once], scores[once], ids[once]
        order = np.lexsort((ids, ~scores, lists))
        lists, scores, ids = lists[order], scores[order], ids[order]
        starts = np.flatnonzero(np.append(True, lists[1:] != lists[:-1]))
        sizes = np.diff(np.append(starts, len(lists)))
        place = np.arange(len(lists)) - np.repeat(starts, sizes)
        kept = place < self.k
        self.lists, self.scores, self.ids = lists[kept], scores[kept], ids[kept]
        last = place == self.k - 1
        self.floor[lists[last]] = scores[last]

    def of_list(self) -> Iterator[tuple[int, list[dict[str, int]]]]:
        """Each list that has entries, best first."""
        if not len(self.lists):
            return
        starts = np.flatnonzero(np.append(True, self.lists[1:] != self.lists[:-1]))
        for start, end in zip(starts, np.append(starts[1:], len(self.lists))):
            pairs = zip(self.scores[start:end].tolist(), self.ids[start:end].tolist())
            yield int(self.lists[start]), [{"score": s, "id": i} for s, i in pairs]


def _matrix(column: pa.Array | pa.ChunkedArray, n_dims: int | None = None) -> np.ndarray:
    """Lists of whole numbers as lines of one length, filled up with zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    sizes = np.asarray(pc.list_value_length(column))
    flat = column.flatten().to_numpy(zero_copy_only=False)
    wide = int(sizes.max(initial=0))
    out = np.zeros((len(sizes), max(wide, n_dims or 0)), np.int64)
    out[np.arange(out.shape[1]) < sizes[:, None]] = flat
    return out


def _search(
    batches: Iterator[pa.RecordBatch],
    k: int,
    admits: Callable[[dict, np.ndarray, np.ndarray, np.ndarray], np.ndarray],
    prepare: Callable[[pa.Table], dict],
) -> Iterator[pa.RecordBatch]:
    """Streams the rows of a cell past its anchors; ``prepare`` says what lists there are."""
    items, rows = items_then_rows(batches)
    if items is None:
        return
    state = prepare(items)
    vectors, best = state["vectors"], Best(len(state["owner"]), k)
    step = max(1, SCORES_AT_ONCE // len(vectors))
    for batch in rows:
        for start in range(0, batch.num_rows, step):
            part = batch.slice(start, step)
            these = _matrix(part.column("vector"), vectors.shape[1])
            ids, labels = (part.column(c).to_numpy() for c in ("id", "label"))
            # An anchor that is shorter than a row has zeros where it ends.
            scores = packed_products(vectors, these[:, : vectors.shape[1]])
            same = state["labels"][:, None] == labels[None, :]
            other = state["ids"][:, None] != ids[None, :]
            for nth in range(state["nths"].max(initial=-1) + 1):
                lists = np.flatnonzero(state["nths"] == nth)
                of = state["owner"][lists]
                fits = admits(state, lists, scores[of], same[of]) & other[of]
                fits &= scores[of] >= best.floor[lists][:, None]
                i, j = np.nonzero(fits)
                best.offer(lists[i], scores[of[i], j], ids[j])
    found = [(int(state["ids"][state["owner"][at]]), int(state["nths"][at]), b) for at, b in best.of_list()]
    if found:
        anchors, nths, lists = zip(*found)
        pairs = pa.list_(pa.struct([("score", pa.int64()), ("id", pa.int64())]))
        yield pa.RecordBatch.from_arrays(
            [pa.array(anchors, pa.int64()), pa.array(nths, pa.int32()), pa.array(lists, pairs)],
            names=["anchor_id", "nth", "best"],
        )


def _anchors(items: pa.Table) -> dict:
    """The anchors of a cell, with one list each."""
    return {
        "vectors": _matrix(items.column("vector")),
        "ids": items.column("id").to_numpy(),
        "labels": items.column("label").to_numpy(),
        "owner": np.arange(items.num_rows),
        "nths": np.zeros(items.num_rows, np.int64),
    }


def _top(found: DataFrame, keys: list[str], k: int) -> DataFrame:
    """The k best over all cells: keys, place, score and id."""
    entries = found.select(*keys, F.explode("best").alias("entry")).select(*keys, "entry.*")
    # An id may have been found in several cells.
    once = entries.groupBy(*keys, "id").agg(F.max("score").alias("score"))
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), "id")
    return once.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= k)


def hard_negatives(
    rows: DataFrame,
    is_anchor: Column,
    *,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    scale: int = 256,
    positives: int = 5,
    negatives: int = 10,
    low: int = 30,
    high: int = 90,
) -> DataFrame:
    """The hardest rows of other labels for each anchor and each of its positives.

    A positive is one of the anchor's ``positives`` best rows of the same label; its
    negatives are the ``negatives`` best rows of other labels whose score is from ``low``
    to ``high`` per cent of the positive's. Better is a higher inner product, then a
    smaller id. No partner is left out: every anchor is scored with every row.

    A null id, label or vector, or a vector with a null, NaN or infinity, takes no part. A
    component is floor(scale * x), at most 64 bits. Vectors of different lengths are filled
    up with zeros, the empty one too. An id that occurs repeatedly counts once, with its
    best score that qualifies, and is no partner of an anchor with the same id; of several
    anchor rows with one id the one with the least (label, vector) counts. An anchor
    without positives, and a positive without negatives, has no rows. Scores past 64 bits
    are the nearest long. Other columns are ignored, whatever their names; an empty table
    gives no rows.

    Args:
        rows: Ids, labels (whole numbers) and vectors.
        is_anchor: Which rows are anchors.
        id_col, vector_col, label_col: Columns of ``rows``.
        scale: Factor before rounding down.
        positives, negatives: How many at most.
        low, high: The band in per cent.

    Returns:
        anchor_id, positive_id, rank (from 1), negative_id, positive_score, negative_score.
    """
    spark = rows.sparkSession
    work = Workspace(spark, "negatives")
    odd = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    vector = F.transform(named(vector_col), lambda x: x.cast("double"))
    clean = rows.select(
        named(id_col).cast("long").alias("id"),
        named(label_col).cast("long").alias("label"),
        vector.alias("vector"),
        F.coalesce(is_anchor, F.lit(False)).alias("anchor"),
    ).filter("id IS NOT NULL AND label IS NOT NULL AND vector IS NOT NULL")
    clean = clean.filter(~F.exists("vector", odd)).withColumn(
        "vector", F.transform("vector", lambda x: F.floor(F.lit(float(scale)) * x))
    )
    table = clean.drop("anchor")
    least = F.min(F.struct("label", "vector"))
    anchors, seen = work.keep_and_observe(
        clean.filter("anchor").groupBy("id").agg(least.alias("own")).select("id", "own.*"),
        "anchors",
        n=F.count(F.lit(1)),
    )
    n_blocks = max(1, -(-seen["n"] // BLOCK_ANCHORS))
    block = F.pmod(F.xxhash64("id"), F.lit(n_blocks)).cast("int").alias("block")

    def cells(items: DataFrame) -> DataFrame:
        return in_cells(items, table, n_blocks=n_blocks, n_splits=SPLITS, key=F.col("id"))

    def same_label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _search(batches, positives, lambda state, lists, scores, same: same, _anchors)

    near = _top(
        cells(anchors.select("*", block)).mapInArrow(same_label, FOUND), ["anchor_id"], positives
    ).select("anchor_id", "place", "score", F.col("id").alias("positive_id"))
    near = work.keep(near, "positives")
    banded = near.groupBy("anchor_id").agg(
        F.sort_array(F.collect_list(F.struct("place", "score"))).alias("bands")
    )
    items = anchors.join(banded, F.col("id") == F.col("anchor_id")).drop("anchor_id")

    def bands(items: pa.Table) -> dict:
        state = _anchors(items)
        of = [[b["score"] for b in bands] for bands in items.column("bands").to_pylist()]
        scores = [s for own in of for s in own]
        state["owner"] = np.repeat(np.arange(len(of)), [len(own) for own in of])
        state["nths"] = np.array([n for own in of for n in range(len(own))], np.int64)
        # Rounded inwards, as Python's unbounded integers.
        state["from"] = np.array([-(-low * s // 100) for s in scores], np.int64)
        state["upto"] = np.array([high * s // 100 for s in scores], np.int64)
        return state

    def in_band(state: dict, lists: np.ndarray, scores: np.ndarray, same: np.ndarray) -> np.ndarray:
        return (
            ~same
            & (scores >= state["from"][lists][:, None])
            & (scores <= state["upto"][lists][:, None])
        )

    def other_labels(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _search(batches, negatives, in_band, bands)

    far = _top(
        cells(items.select("*", block)).mapInArrow(other_labels, FOUND), ["anchor_id", "nth"], negatives
    ).select(
        F.col("anchor_id").alias("its_anchor"),
        (F.col("nth") + 1).alias("its_place"),
        F.col("place").cast("int").alias("rank"),
        F.col("id").alias("negative_id"),
        F.col("score").alias("negative_score"),
    )
    same = (F.col("anchor_id") == F.col("its_anchor")) & (F.col("place") == F.col("its_place"))
    return near.join(far, same).select(
        "anchor_id",
        "positive_id",
        "rank",
        "negative_id",
        F.col("score").alias("positive_score"),
        "negative_score",
    )
