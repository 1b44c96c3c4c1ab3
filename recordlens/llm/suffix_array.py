"""Repeated byte strings, by suffix arrays built block by block on a difference cover.

The suffixes of a block are those that share a prefix with suffixes elsewhere
(``candidates``); a bucket is one prefix, and buckets are sorted a few at a time, so
memory is bounded whatever the corpus holds. Long ties are not followed byte by byte:
the suffixes at the positions of a difference cover are ranked first, by doubling the
length at each step, and two suffixes that agree up to the next such position are in
the order of the ranks there. Slices are laid out with their anchors on multiples of
the period, so equal strings reach the cover after the same number of bytes.
Neighbours in the array that agree over the wanted length are repeats.
"""

from __future__ import annotations

from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from recordlens.llm.candidates import (
    LONG_PREFIX_CHUNKS,
    RUNS,
    Spec,
    candidate_slices,
    covered,
    groups,
    runs_by_chunk,
    runs_of,
    starts_of,
)
from recordlens.llm.chunks import CHUNK_BYTES, Corpus, corpus, in_order
from recordlens.llm.units import byte_values

BLOCK_SLICES = 4_000
PREFIX_BYTES = 64
PERIOD = 64


def byte_units(bodies: list[bytes]):
    data = b"".join(bodies)
    values = byte_values()[np.frombuffer(data, np.uint8)]
    ends = np.cumsum([len(b) for b in bodies]).astype(np.int64)
    return values, ends, lambda start, stop: data[start:stop]


def difference_cover(period: int) -> np.ndarray:
    """Residues that contain every difference modulo a square number.

    With root s: 0 ... s-1 and the multiples of s; any d is a multiple of s less
    some r below s. Two positions reach the cover together after some bytes, and a
    single one after at most s.
    """
    root = isqrt(period)
    if root * root != period:
        raise ValueError("the period must be a square number")
    return np.union1d(np.arange(root), np.arange(0, period, root))


def big_endian(data: np.ndarray) -> np.ndarray:
    """For each position the eight bytes from there as a number; data ends in padding."""
    n = len(data) - 8
    out = np.zeros(n, np.uint64)
    for i in range(8):
        out |= data[i : i + n].astype(np.uint64) << np.uint64(56 - 8 * i)
    return out


def dense_ranks(keys: list[np.ndarray]) -> np.ndarray:
    """Ranks of rows by several keys, equal rows with equal ranks from 1 on."""
    order = np.lexsort(keys[::-1])
    new = np.zeros(len(order), bool)
    for key in keys:
        ordered = key[order]
        new[1:] |= ordered[1:] != ordered[:-1]
    ranks = np.empty(len(order), np.int64)
    ranks[order] = np.cumsum(new) + 1
    return ranks


def cover_ranks(eight: np.ndarray, depth: int) -> np.ndarray:
    """Ranks, at the cover's positions, of the suffixes there by ``depth`` bytes or more."""
    n = len(eight)
    at = np.flatnonzero(np.isin(np.arange(PERIOD), difference_cover(PERIOD))[np.arange(n) % PERIOD])

    def beyond(values: np.ndarray, step: int) -> np.ndarray:
        """The values ``step`` positions on, 0 past the end."""
        later = at + step
        return np.where(later < n, values[np.minimum(later, n - 1)], 0)

    first = [beyond(eight, step) for step in range(0, PERIOD, 8)]
    ranks, reach = np.zeros(n, np.int64), PERIOD
    ranks[at] = dense_ranks(first)
    while reach < depth:
        ranks[at] = dense_ranks([ranks[at], beyond(ranks, reach)])
        reach *= 2
    return ranks


def repeated_starts(
    data: np.ndarray, starts: np.ndarray, buckets: np.ndarray, width: int
) -> np.ndarray:
    """Which suffixes share their first ``width`` bytes with another one.

    Args:
        data: The bytes, padded by ``width`` + PERIOD zeros.
        starts: Positions; equal strings have equal residues modulo PERIOD.
        buckets: A number per suffix; equal strings have equal ones.
    """
    eight = big_endian(data)
    ranks = cover_ranks(eight, width)
    cover = difference_cover(PERIOD)
    residues = starts % PERIOD
    ahead = np.append(cover, PERIOD)[np.searchsorted(cover, residues)] - residues
    order = np.lexsort((ranks[starts + ahead], eight[starts], residues, buckets))
    at = starts[order]
    same = np.flatnonzero(buckets[order][1:] == buckets[order][:-1])
    for step in [*range(0, width - 7, 8), width - 8]:
        same = same[eight[at[same] + step] == eight[at[same + 1] + step]]
    found = np.zeros(len(starts), bool)
    found[order[same]] = found[order[same + 1]] = True
    return found


def repeated_windows(table: pa.Table, width: int) -> pa.Table:
    """Of a group's windows, those that occur at another place too."""
    chunks, begins, lengths = [], [], []
    for block in groups(table, BLOCK_SLICES):
        prefix = block.column("prefix").to_numpy()
        chunk = block.column("chunk").to_numpy()
        n = block.column("n").to_numpy().astype(np.int64)
        starts = starts_of(block)
        texts = block.column("slice").to_pylist()
        # Equal slices of one prefix are one suffix; all their windows repeat.
        distinct: dict[tuple[int, bytes], list[int]] = {}
        for row, entry in enumerate(zip(prefix.tolist(), texts)):
            distinct.setdefault(entry, []).append(row)
        again = np.zeros(len(prefix), bool)
        for rows in distinct.values():
            again[rows] = len(rows) > 1 or len(starts[rows[0]]) > 1
        copies = np.array([len(s) for s in starts]) * again
        if copies.any():
            chunks.append(np.repeat(chunk, copies))
            begins.append(np.concatenate([s for s, a in zip(starts, again) if a]))
            lengths.append(np.repeat(n, copies))
        # What is left are slices of one place each; they meet the others of their prefix.
        ones = np.array([rows[0] for rows in distinct.values()])
        of = prefix[ones]
        open_ones = ~again[ones]
        _, inverse = np.unique(of, return_inverse=True)
        size, undecided = np.bincount(inverse), np.bincount(inverse, open_ones)
        rows = ones[(size[inverse] > 1) & (undecided[inverse] > 0)]
        if not len(rows):
            continue
        anchor = block.column("anchor").to_numpy()[rows].astype(np.int64)
        data, bases = laid_out([texts[r] for r in rows], anchor, width)
        owner = np.repeat(np.arange(len(rows)), n[rows])
        step = np.arange(len(owner)) - np.repeat(np.cumsum(n[rows]) - n[rows], n[rows])
        found = repeated_starts(data, bases[owner] + step, prefix[rows][owner], width)
        found &= ~again[rows][owner]
        # A gap between slices ends every run of windows with its slice.
        at = np.arange(len(owner)) + owner
        flags = np.zeros(len(owner) + len(rows), bool)
        flags[at] = found
        back = np.zeros(len(flags), np.int64)
        back[at] = np.arange(len(owner))
        run, length = runs_of(flags)
        run = back[run]
        first = np.array([starts[r][0] for r in rows])
        chunks.append(chunk[rows][owner[run]])
        begins.append(first[owner[run]] + step[run])
        lengths.append(length)
    return runs_by_chunk(chunks, begins, lengths)


def laid_out(texts: list[bytes], anchors: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The texts end to end with every anchor on a multiple of PERIOD, and their places."""
    parts, bases, length = [], np.empty(len(texts), np.int64), 0
    for i, (text, anchor) in enumerate(zip(texts, anchors)):
        gap = int(-(length + anchor) % PERIOD)
        bases[i] = length + gap
        parts += [bytes(gap), text]
        length += gap + len(text)
    parts.append(bytes(width + 2 * PERIOD))
    return np.frombuffer(b"".join(parts), np.uint8), bases


def repeat_runs(
    source: Corpus, width: int, long_prefix_chunks: int = LONG_PREFIX_CHUNKS
) -> DataFrame:
    """Runs of byte windows that occur at another place too, by chunk."""
    spec = Spec(width, min(PREFIX_BYTES, width), byte_units, 1.0)

    def resolve(table: pa.Table) -> pa.Table:
        return repeated_windows(table, width)

    slices = candidate_slices(source, spec, long_prefix_chunks=long_prefix_chunks)
    return slices.groupBy("bucket").applyInArrow(resolve, RUNS)


def remove_repeated_bytes(
    docs: DataFrame,
    *,
    width: int = 200,
    id_col: str = "doc_id",
    text_col: str = "text",
    chunk_bytes: int = CHUNK_BYTES,
    long_prefix_chunks: int = LONG_PREFIX_CHUNKS,
) -> DataFrame:
    """Each text without the bytes of ``width``-byte strings that occur anywhere else.

    Strings lie within one text, may overlap and are judged on the texts as given;
    none of their occurrences is spared. A null text is empty, rows with equal ids are
    texts of their own, other columns are ignored. Columns: doc_id, n_bytes,
    n_removed, spans (struct of begin and length in bytes, of the maximal removed
    runs) and kept (the remaining bytes, which need not be whole characters).
    """
    if width < 8:
        raise ValueError("strings must have at least 8 bytes")
    source = corpus(docs, id_col=id_col, text_col=text_col, chunk_bytes=chunk_bytes)

    def apply(table: pa.Table, runs: pa.Table) -> pa.Table:
        table = in_order(table)
        bodies = table.column("body").to_pylist()
        ends = np.cumsum([len(b) for b in bodies])
        gone = covered(runs, int(ends[-1]), width)
        spans, removed, kept, start = [], [], [], 0
        for body, end in zip(bodies, ends):
            own = gone[start:end]
            begins, lengths = runs_of(own)
            spans.append(
                [{"begin": int(a), "length": int(b)} for a, b in zip(begins, lengths)]
            )
            removed.append(int(lengths.sum()))
            kept.append(np.frombuffer(body, np.uint8)[~own].tobytes() if len(begins) else body)
            start = end
        span = pa.struct([("begin", pa.int64()), ("length", pa.int64())])
        return pa.table(
            {
                "doc_id": table.column("id"),
                "n_bytes": pa.array([len(b) for b in bodies], pa.int64()),
                "n_removed": pa.array(removed, pa.int64()),
                "spans": pa.array(spans, pa.list_(span)),
                "kept": pa.array(kept, pa.binary()),
            }
        )

    return (
        source.docs.groupBy("chunk")
        .cogroup(repeat_runs(source, width, long_prefix_chunks).groupBy("chunk"))
        .applyInArrow(
            apply,
            "doc_id long, n_bytes long, n_removed long,"
            " spans array<struct<begin: long, length: long>>, kept binary",
        )
    )
