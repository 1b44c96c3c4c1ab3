"""Benchmark passages in documents: SimHash of item-sized windows, then exact shingles.

Every window of a document gets a 64-bit SimHash of its words, for each of a few
window lengths that fit the items. An item is represented by its first, middle and
last window of the length next below 4/5 of its own. A multi-index of the items'
fingerprints holds, for each of four 16-bit blocks, all values within a quarter of
the radius: two fingerprints within the radius agree so far in at least one block,
hence no pair within the radius is missed. Candidates are then verified exactly, by
the weight of the item's 5-word shingles that stand in the item-sized stretch of text, or
as many words before or behind it as the item may have shingles that are missing.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from recordlens.llm.batches import id_and_text, slices, text_bytes
from recordlens.llm.units import grams, mix, whole_windows, words_of

SHINGLE = 5
RADIUS = 7
BLOCKS = 4
BLOCK_BITS = 16
THRESHOLD = 0.8
# Items that one scan of the documents looks for; more items take more scans.
ITEMS_PER_SCAN = 2_000
SLICE_BYTES = 2 << 20
# Starts of an item that are told apart, by its words.
GRID = 64
# Words whose bits are summed together.
WORDS = 1 << 15

FOUND = "doc_id long, item_id long, similarity double, begin long, n_words long, distance int"


def lengths_up_to(longest: int) -> list[int]:
    """Window lengths, each about 1.3 times the one before."""
    found = [1]
    while found[-1] < longest:
        found.append(ceil(found[-1] * 1.3))
    return found


def fingerprints(values: np.ndarray, lengths: list[int]) -> Iterator[tuple[int, int, np.ndarray]]:
    """SimHash of the windows of all lengths: (length, first window, fingerprints)."""
    longest = max(lengths)
    # Sums may wrap around; differences of up to a window's length are right all the same.
    kind = np.uint16 if longest < 1 << 16 else np.uint32
    for base in range(0, len(values), WORDS):
        part = values[base : base + WORDS + longest - 1]
        bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1)
        sums = np.zeros((len(part) + 1, 64), kind)
        np.cumsum(bits, axis=0, dtype=kind, out=sums[1:])
        for length in lengths:
            n = min(len(part) - length + 1, WORDS)
            if n > 0:
                ones = sums[length : length + n] - sums[:n]
                yield length, base, np.packbits(ones > length // 2, axis=1).view(np.uint64)[:, 0]


@dataclass
class Index:
    """The items of one scan.

    Attributes:
        ids, sizes: Id and number of words of each item.
        shingles, weights: Hashes of each item's shingles, and their shares of the item.
        entries: For each length, the fingerprints, their items and their offsets there.
        blocks: For each length and block, begins and members of the lists of entries
            by value.
    """

    ids: list
    sizes: list[int]
    shingles: list[np.ndarray]
    weights: list[np.ndarray]
    entries: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]
    blocks: dict[int, list[tuple[np.ndarray, np.ndarray]]]


def shingles_of(values: np.ndarray) -> np.ndarray:
    """Hashes of a text's shingles; a shorter text is one shingle."""
    return grams(values, min(SHINGLE, len(values)))


def build_index(ids: list, bodies: list[bytes]) -> Index:
    """The index of items; items without words are left out."""
    words = words_of(bodies, lower=True)
    begins = np.concatenate(([0], words.ends[:-1])) if bodies else []
    index = Index([], [], [], [], {}, {})
    values = []
    for item, a, b in zip(ids, begins, words.ends):
        if b > a:
            index.ids.append(item)
            index.sizes.append(int(b - a))
            values.append(words.values[a:b])
            index.shingles.append(np.unique(shingles_of(values[-1])))
    if not index.ids:
        return index
    # A shingle that many items share says less about each of them.
    every, counts = np.unique(np.concatenate(index.shingles), return_counts=True)
    for own in index.shingles:
        weight = 1 / counts[np.searchsorted(every, own)]
        index.weights.append(weight / weight.sum())
    ladder = np.array(lengths_up_to(max(index.sizes)))
    rows: dict[int, list[tuple[int, int, int]]] = {}
    for i, (size, own) in enumerate(zip(index.sizes, values)):
        length = int(ladder[np.searchsorted(ladder, max(size * 4 // 5, 1), "right") - 1])
        for offset in sorted({0, (size - length) // 2, size - length}):
            _, _, prints = next(fingerprints(own[offset : offset + length], [length]))
            rows.setdefault(length, []).append((int(prints[0]), i, offset))
    near = [0]
    for distance in range(1, RADIUS // BLOCKS + 1):
        near += [sum(1 << b for b in c) for c in combinations(range(BLOCK_BITS), distance)]
    masks = np.array(near, np.uint64)
    for length, found in rows.items():
        prints = np.array([f for f, _, _ in found], np.uint64)
        index.entries[length] = (
            prints,
            np.array([i for _, i, _ in found]),
            np.array([o for _, _, o in found]),
        )
        index.blocks[length] = []
        for block in range(BLOCKS):
            own = prints >> np.uint64(BLOCK_BITS * block) & np.uint64((1 << BLOCK_BITS) - 1)
            values_near = (own[:, None] ^ masks[None, :]).astype(np.int64)
            members = np.repeat(np.arange(len(prints)), len(masks))
            order = np.argsort(values_near.ravel(), kind="stable")
            per_value = np.bincount(values_near.ravel(), minlength=1 << BLOCK_BITS)
            starts = np.concatenate(([0], np.cumsum(per_value)))
            index.blocks[length].append((starts, members[order]))
    return index


def candidates(
    index: Index, length: int, prints: np.ndarray, allowed: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All pairs of windows and entries within the radius: window, entry, distance."""
    entries = index.entries[length][0]
    found = []
    for block, (starts, members) in enumerate(index.blocks[length]):
        value = (
            prints >> np.uint64(BLOCK_BITS * block) & np.uint64((1 << BLOCK_BITS) - 1)
        ).astype(np.int64)
        some = np.flatnonzero((np.diff(starts) > 0)[value] & allowed)
        first, last = starts[value[some]], starts[value[some] + 1]
        n = last - first
        window = np.repeat(some, n)
        step = np.arange(len(window)) - np.repeat(np.cumsum(n) - n, n)
        entry = members[np.repeat(first, n) + step]
        distance = np.bitwise_count(prints[window] ^ entries[entry])
        near = distance <= RADIUS
        found.append((window[near], entry[near], distance[near]))
    window, entry, distance = (np.concatenate(c) for c in zip(*found))
    _, one = np.unique(window * len(entries) + entry, return_index=True)
    return window[one], entry[one], distance[one].astype(np.int64)


def matches(index: Index, bodies: list[bytes], threshold: float) -> list[tuple]:
    """(text, item, similarity, first word, words, distance), the best of each pair."""
    words = words_of(bodies, lower=True)
    ends = words.ends
    if not index.ids or not len(words.values):
        return []
    total = len(words.values)
    begins = np.concatenate(([0], ends[:-1]))
    lengths = sorted(index.entries)
    valid = {n: whole_windows(ends, total, n) for n in lengths}
    best: dict[tuple[int, int], tuple] = {}
    checked: set[tuple[int, int]] = set()
    for length, base, prints in fingerprints(words.values, lengths):
        allowed = valid[length][base : base + len(prints)]
        window, entry, distance = candidates(index, length, prints, allowed)
        _, item_of, offset_of = index.entries[length]
        order = np.lexsort((window, distance))
        near = zip((window[order] + base).tolist(), entry[order].tolist(), distance[order].tolist())
        for w, e, d in near:
            item, start = int(item_of[e]), w - int(offset_of[e])
            doc = int(np.searchsorted(ends, w, "right"))
            start = max(start, int(begins[doc]))
            stop = min(start + index.sizes[item], int(ends[doc]))
            # Windows of a long item hardly change from word to word; one start stands for
            # those next to it, and its stretch is wider by as much.
            grid = max(index.sizes[item] // GRID, 1)
            if (item, start // grid) in checked:
                continue
            checked.add((item, start // grid))
            # Words that the document has more push the item's ends out.
            more = ceil(index.sizes[item] * (1 - threshold)) + grid - 1
            wide = max(start - more, int(begins[doc])), min(stop + more, int(ends[doc]))

            def found_in(a: int, b: int, item=item) -> float:
                here = shingles_of(words.values[a:b])
                return float(index.weights[item][np.isin(index.shingles[item], here)].sum())

            similarity = found_in(*wide)
            if similarity < threshold:
                continue
            key = (doc, item)
            # Of stretches that are as similar, the one that needs the least widening.
            row = (similarity, found_in(start, stop), -d, -start, stop - start)
            if key not in best or row > best[key]:
                best[key] = row
    return [
        (doc, item, s, -start - int(begins[doc]), n, -d)
        for (doc, item), (s, _, d, start, n) in sorted(best.items())
    ]


def item_blocks(items: DataFrame, id_col: str, text_col: str) -> list[tuple[list, list[bytes]]]:
    """The items in blocks of at most ITEMS_PER_SCAN; each is small enough for a task.

    This is a stated query set, which is looked for in all documents block by block.
    """
    rows = (
        id_and_text(items, id_col, text_col)
        .groupBy(F.xxhash64("body").alias("same"), "body")
        .agg(F.min("id").alias("id"))
        .orderBy("id", "same")
        .select("id", "body")
        .toLocalIterator()
    )
    blocks: list[tuple[list, list[bytes]]] = []
    for row in rows:
        if not blocks or len(blocks[-1][0]) == ITEMS_PER_SCAN:
            blocks.append(([], []))
        blocks[-1][0].append(row["id"])
        blocks[-1][1].append(bytes(row["body"]))
    return blocks


def find_passages(
    docs: DataFrame,
    items: DataFrame,
    *,
    threshold: float = THRESHOLD,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """Pairs of documents and benchmark items whose passage they hold.

    Columns: doc_id, item_id, similarity (share of the item's shingle weight found in
    a stretch of the item's length, widened at both ends by 1 - ``threshold`` of that), begin
    and n_words of the best stretch without that, and the distance of the fingerprints that
    led there. Items and texts may have any length. Words are compared with A-Z in lower
    case. Texts and items without words match nothing; of items with equal texts the
    smallest id stands for all; rows with equal ids are documents of their own; other
    columns are ignored.
    """
    base = id_and_text(docs, id_col, text_col)
    found = None
    for ids, bodies in item_blocks(items, item_id_col, item_text_col) or [([], [])]:

        def scan(batches: Iterator[pa.RecordBatch], ids=ids, bodies=bodies):
            index = build_index(ids, bodies)
            for part in slices(batches, SLICE_BYTES):
                own = part.column("id").to_pylist()
                rows = matches(index, part.column("body").to_pylist(), threshold)
                columns = list(zip(*rows)) or [()] * 6
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([own[d] for d in columns[0]], pa.int64()),
                        pa.array([index.ids[i] for i in columns[1]], pa.int64()),
                        pa.array(columns[2], pa.float64()),
                        pa.array(columns[3], pa.int64()),
                        pa.array(columns[4], pa.int64()),
                        pa.array(columns[5], pa.int32()),
                    ],
                    names=["doc_id", "item_id", "similarity", "begin", "n_words", "distance"],
                )

        pairs = base.mapInArrow(scan, FOUND)
        found = pairs if found is None else found.unionByName(pairs)
    return found


def without_passages(
    docs: DataFrame,
    items: DataFrame,
    *,
    threshold: float = THRESHOLD,
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """The documents that hold no passage, with all their columns.

    The text goes to Python once, as the column that it is.
    """
    kept = docs
    names = [f"c{i}" for i in range(len(docs.columns))]
    text = names[docs.columns.index(text_col)]
    if not isinstance(docs.schema[text_col].dataType, StringType):
        text = "body"
    for ids, bodies in item_blocks(items, item_id_col, item_text_col):

        def clean(batches: Iterator[pa.RecordBatch], ids=ids, bodies=bodies):
            index = build_index(ids, bodies)
            for part in slices(batches, SLICE_BYTES, text):
                own = part.column(text).cast(pa.binary()).fill_null(b"").to_pylist()
                rows = matches(index, own, threshold)
                keep = np.ones(part.num_rows, bool)
                keep[[row[0] for row in rows]] = False
                yield part.filter(pa.array(keep)).select(names)

        plain = kept.select(
            *(F.col(f"`{c}`").alias(n) for c, n in zip(kept.columns, names)),
            *([text_bytes(text_col).alias(text)] if text == "body" else []),
        )
        schema = ", ".join(
            f"c{i} {f.dataType.simpleString()}" for i, f in enumerate(kept.schema.fields)
        )
        kept = plain.mapInArrow(clean, schema).toDF(*docs.columns)
    return kept
