"""Suffixes that may repeat, dealt into groups by their prefixes.

A window of the wanted width that occurs twice has the same anchor both times (see
``units.anchors``). So each chunk asks which of its anchors occur more than once in
the corpus, and only windows with such an anchor go on: as suffixes of the slice of
text from the first to the last window with that anchor. The anchor is the prefix
that decides the group of a suffix. Where a prefix occurs in very many chunks, or has
very many different slices, it is lengthened to the whole window: chunks ask which of
those windows occur more than once, and only they go on, each to a group of its own. So
a line that many documents share costs no group a slice per document.

Equal slices of a chunk go on as one, with all the places where they begin.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordlens.llm.chunks import (
    ASKED,
    Corpus,
    answers,
    ask,
    bucket_of,
    chunk_of,
    in_order,
    told,
)
from recordlens.llm.units import Anchors, anchors, grams, whole_windows

# A prefix that more chunks hold than this is lengthened to the whole window.
LONG_PREFIX_CHUNKS = 20_000
# So is one with more slices, if those are more than two for each chunk that holds it; a
# whole window still has one slice in each chunk.
LONG_PREFIX_SLICES = 4_000

SLICES = (
    "bucket long, prefix long, chunk long, id long, n int, anchor int, slice binary, starts binary"
)
RUNS = "chunk long, starts binary, lengths binary"


@dataclass(frozen=True)
class Spec:
    """What a window is.

    Attributes:
        width: Units in a window.
        prefix: Units in an anchor.
        units: The 64-bit values and text ends of a list of bodies, and a function
            that gives the bytes from one unit up to another.
        bytes_per_unit: About how long a unit is.
    """

    width: int
    prefix: int
    units: Callable[[list[bytes]], tuple[np.ndarray, np.ndarray, Callable[[int, int], bytes]]]
    bytes_per_unit: float

    def n_buckets(self, corpus: Corpus) -> int:
        anchors_per_unit = 2 / (self.width - self.prefix + 2)
        return corpus.buckets(self.bytes_per_unit / anchors_per_unit)


def _anchors(
    spec: Spec, bodies: list[bytes]
) -> tuple[Anchors, Callable[[int, int], bytes], np.ndarray, np.ndarray]:
    values, ends, text = spec.units(bodies)
    found = anchors(values, whole_windows(ends, len(values), spec.width), spec.width, spec.prefix)
    return found, text, ends, values


def _windows(spec: Spec, found: Anchors, values: np.ndarray, rows: np.ndarray) -> list[np.ndarray]:
    """The keys of the whole windows of some anchors."""
    return [
        grams(values[found.first[i] : found.last[i] + spec.width], spec.width) for i in rows
    ]


def _states(replies: pa.Table, found: Anchors, n_buckets: int) -> np.ndarray:
    """What the corpus says to each anchor: 0 single, 1 repeated, 2 to be lengthened."""
    keys, inverse = np.unique(found.keys, return_inverse=True)
    return told(replies, keys, n_buckets, np.uint8)[inverse]


def candidate_slices(
    corpus: Corpus, spec: Spec, *, long_prefix_chunks: int = LONG_PREFIX_CHUNKS
) -> DataFrame:
    """Slices of text with windows that may occur elsewhere, by group.

    Columns: bucket (the group), prefix (hash of the prefix within it), chunk, id (of
    the first document with the slice; null for documents without one), n (windows in
    the slice), anchor (where in the slice its anchor begins, in units), slice (its
    bytes) and starts (where it begins, in units of the chunk).
    """
    n_buckets, long_prefix_slices = spec.n_buckets(corpus), LONG_PREFIX_SLICES

    def ask_anchors(table: pa.Table) -> pa.Table:
        bodies = in_order(table).column("body").to_pylist()
        found, text, _, _ = _anchors(spec, bodies)
        keys, inverse, counts = np.unique(found.keys, return_inverse=True, return_counts=True)
        # Counted are different slices, and one more if any of them is there again.
        slices = np.minimum(counts, 1)
        several = np.flatnonzero(counts[inverse] > 1)
        different = {
            (int(inverse[i]), text(int(found.first[i]), int(found.last[i]) + spec.width))
            for i in several
        }
        slices[inverse[several]] = 0
        np.add.at(slices, [key for key, _ in different], 1)
        return ask(chunk_of(table), keys, slices + (slices < counts), n_buckets)

    def state(totals: np.ndarray, chunks: np.ndarray) -> np.ndarray:
        many = (totals > long_prefix_slices) & (totals > 2 * chunks)
        lengthen = (totals > 1) & (many | (chunks > long_prefix_chunks))
        return ((totals > 1).astype(np.uint8) + lengthen).astype(np.uint8)

    def ask_windows(docs: pa.Table, replies: pa.Table) -> pa.Table:
        keys, chunk = np.empty(0, np.uint64), 0
        counts = np.empty(0, np.int64)
        if any(b"\x02" in answer for answer in replies.column("answer").to_pylist()):
            chunk = chunk_of(docs)
            found, _, _, values = _anchors(spec, in_order(docs).column("body").to_pylist())
            rows = np.flatnonzero(_states(replies, found, n_buckets) == 2)
            every = np.concatenate(_windows(spec, found, values, rows))
            keys, counts = np.unique(every, return_counts=True)
        return ask(chunk, keys, counts, n_buckets)

    def cut(docs: pa.Table, replies: pa.Table) -> pa.Table:
        seen: dict[tuple[int, bytes], list[int]] = {}
        shape: list[tuple[int, int]] = []
        ids, ends, chunk = [], np.empty(0, np.int64), 0
        if replies.num_rows:
            chunk = chunk_of(docs)
            docs = in_order(docs)
            ids = docs.column("id").to_pylist()
            found, text, ends, values = _anchors(spec, docs.column("body").to_pylist())
            # Answers about whole windows have negative buckets.
            buckets = replies.column("bucket")
            of_windows = pc.less(buckets, 0)
            states = _states(replies.filter(pc.invert(of_windows)), found, n_buckets)
            long = np.flatnonzero(states == 2)
            windows = _windows(spec, found, values, long)
            asked = np.unique(np.concatenate([np.empty(0, np.uint64), *windows]))
            of_windows = replies.set_column(
                replies.column_names.index("bucket"), "bucket", pc.subtract(-1, buckets)
            ).filter(of_windows)
            again = told(of_windows, asked, n_buckets, np.uint8)

            def add(key: int, start: int, n: int, anchor: int) -> None:
                entry = (key, text(start, start + n - 1 + spec.width))
                if entry not in seen:
                    seen[entry] = []
                    shape.append((n, anchor - start))
                seen[entry].append(start)

            for i in np.flatnonzero(states == 1):
                first, last, at = int(found.first[i]), int(found.last[i]), int(found.at[i])
                add(int(found.keys[i]), first, last - first + 1, at)
            for i, own in zip(long, windows):
                for step in np.flatnonzero(again[np.searchsorted(asked, own)]):
                    add(int(own[step]), int(found.first[i] + step), 1, int(found.at[i]))
        prefixes = np.array([key for key, _ in seen], np.uint64)
        owners = np.searchsorted(ends, [s[0] for s in seen.values()], "right")
        return pa.table(
            {
                "bucket": pa.array(bucket_of(prefixes, n_buckets), pa.int64()),
                "prefix": pa.array(prefixes.view(np.int64), pa.int64()),
                "chunk": pa.array([chunk] * len(seen), pa.int64()),
                "id": pa.array([ids[o] for o in owners], pa.int64()),
                "n": pa.array([n for n, _ in shape], pa.int32()),
                "anchor": pa.array([a for _, a in shape], pa.int32()),
                "slice": pa.array([text for _, text in seen], pa.binary()),
                "starts": pa.array(
                    [np.array(s, np.int64).tobytes() for s in seen.values()], pa.binary()
                ),
            }
        )

    by_chunk = corpus.docs.groupBy("chunk")
    replies = answers(by_chunk.applyInArrow(ask_anchors, ASKED), state)
    asked = by_chunk.cogroup(replies.groupBy("chunk")).applyInArrow(ask_windows, ASKED)
    repeated = answers(asked, lambda totals, chunks: (totals > 1).astype(np.uint8))
    replies = replies.union(
        repeated.select("chunk", (F.lit(-1) - F.col("bucket")).alias("bucket"), "answer")
    )
    return by_chunk.cogroup(replies.groupBy("chunk")).applyInArrow(cut, SLICES)


def groups(table: pa.Table, most: int) -> Iterator[pa.Table]:
    """The slices of a bucket in pieces of whole prefixes, about ``most`` slices each."""
    table = table.sort_by("prefix").combine_chunks()
    prefixes = table.column("prefix").to_numpy()
    begins = np.flatnonzero(np.concatenate(([True], prefixes[1:] != prefixes[:-1])))
    start = 0
    while start < len(prefixes):
        later = begins[np.searchsorted(begins, start + most, "left") :]
        stop = int(later[0]) if len(later) else len(prefixes)
        yield table.slice(start, stop - start)
        start = stop


def starts_of(table: pa.Table) -> list[np.ndarray]:
    return [np.frombuffer(s, np.int64) for s in table.column("starts").to_pylist()]


def runs_by_chunk(
    chunks: list[np.ndarray], starts: list[np.ndarray], lengths: list[np.ndarray]
) -> pa.Table:
    """Runs of windows (chunk, first window, how many), one row per chunk."""
    chunk, start, length = (
        np.concatenate(c).astype(np.int64) if c else np.empty(0, np.int64)
        for c in (chunks, starts, lengths)
    )
    order = np.argsort(chunk, kind="stable")
    chunk, start, length = chunk[order], start[order], length[order]
    cuts = np.flatnonzero(np.diff(chunk)) + 1
    begins = np.concatenate(([0], cuts)) if len(chunk) else cuts
    ends = np.append(cuts, len(chunk)) if len(chunk) else cuts
    return pa.table(
        {
            "chunk": pa.array(chunk[begins], pa.int64()),
            "starts": pa.array([start[a:b].tobytes() for a, b in zip(begins, ends)], pa.binary()),
            "lengths": pa.array([length[a:b].tobytes() for a, b in zip(begins, ends)], pa.binary()),
        }
    )


def runs_of(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where runs of true begin and how long they are."""
    edges = np.diff(np.concatenate(([0], flags.astype(np.int8), [0])))
    begins = np.flatnonzero(edges == 1)
    return begins, np.flatnonzero(edges == -1) - begins


def covered(runs: pa.Table, total: int, width: int) -> np.ndarray:
    """Which of a chunk's units lie in a window of the runs."""
    change = np.zeros(total + 1, np.int32)
    for starts, lengths in zip(
        runs.column("starts").to_pylist(), runs.column("lengths").to_pylist()
    ):
        first, n = np.frombuffer(starts, np.int64), np.frombuffer(lengths, np.int64)
        np.add.at(change, first, 1)
        np.add.at(change, first + n - 1 + width, -1)
    return np.cumsum(change[:-1]) > 0
