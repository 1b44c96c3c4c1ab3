"""Repeated word sequences, by suffix trees over groups of suffixes with a common prefix.

A group holds the suffixes whose prefix falls to it (``candidates``); groups are sized
to fit a task, and a prefix with too many suffixes is lengthened. Within a group the
suffix tree is given by its leaves in order and by how long a prefix each leaf shares
with the one before; an internal node is a run of leaves. Nodes at least as deep as
the window are the repeats: all their leaves but the first in the corpus are removed.
"""

from __future__ import annotations

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
from recordlens.llm.units import words_of

GROUP_SLICES = 4_000
PREFIX_WORDS = 8
# Null ids come after all others.
LAST = np.iinfo(np.int64).max


def word_units(bodies: list[bytes]):
    words = words_of(bodies)
    return words.values, words.ends, words.text


def subtree(ids: np.ndarray, starts: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """The suffix tree of some suffixes, down to a depth.

    Args:
        ids: Symbols, numbered in any order.
        starts: Where the suffixes begin; each has at least ``depth`` symbols.

    Returns:
        The suffixes as leaves in order, and for each leaf whether it shares its
        first ``depth`` symbols with the leaf before, that is, a node at least so deep.
    """
    names, reach = ids.astype(np.int64), 1
    while reach * 2 <= depth:
        both = names[:-reach] * (int(names.max()) + 1) + names[reach:]
        names, reach = np.unique(both, return_inverse=True)[1], reach * 2
    keys = names[starts] * (int(names.max()) + 1) + names[starts + depth - reach]
    order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    deep = np.concatenate(([False], ordered[1:] == ordered[:-1]))
    return order, deep


def symbols(slices: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Exact numbers for the words of slices, and where each slice begins."""
    words = words_of(slices)
    letters = words.joined[words.joined != 32]
    offsets = (words.offsets - np.arange(len(words.offsets))).astype(np.int32)
    column = pa.Array.from_buffers(
        pa.binary(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(letters)]
    )
    ids = column.dictionary_encode().indices.to_numpy()
    return ids, np.concatenate(([0], words.ends[:-1])).astype(np.int64)


def later_windows(table: pa.Table, width: int) -> pa.Table:
    """Of a group's windows, those that also begin earlier in the corpus."""
    chunks, begins, lengths = [], [], []
    for group in groups(table, GROUP_SLICES):
        chunk = group.column("chunk").to_numpy()
        n = group.column("n").to_numpy().astype(np.int64)
        starts = starts_of(group)
        # The same slice again in the same chunk: all of its windows are there already.
        copies = np.array([len(s) - 1 for s in starts])
        chunks.append(np.repeat(chunk, copies))
        begins.append(np.concatenate([s[1:] for s in starts]))
        lengths.append(np.repeat(n, copies))
        prefix = group.column("prefix").to_numpy()
        same = prefix[1:] == prefix[:-1]
        shared = np.concatenate(([False], same)) | np.concatenate((same, [False]))
        rows = np.flatnonzero(shared)
        if not len(rows):
            continue
        ids, bases = symbols(group.column("slice").take(pa.array(rows)).to_pylist())
        n, chunk = n[rows], chunk[rows]
        owner = np.repeat(np.arange(len(rows)), n)
        step = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
        order, deep = subtree(ids, bases[owner] + step, width)
        node = np.empty(len(order), np.int64)
        node[order] = np.cumsum(~deep)
        doc = group.column("id").fill_null(LAST).to_numpy()[rows][owner]
        first = np.array([starts[r][0] for r in rows])
        place = first[owner] + step
        by_place = np.lexsort((place, doc, node))
        later = np.zeros(len(order), bool)
        later[by_place[1:]] = node[by_place[1:]] == node[by_place[:-1]]
        # Runs must not go on from one slice into the next: a gap between slices.
        at = np.arange(len(owner)) + owner
        flags = np.zeros(len(owner) + len(rows), bool)
        flags[at] = later
        back = np.zeros(len(flags), np.int64)
        back[at] = np.arange(len(owner))
        run, length = runs_of(flags)
        run = back[run]
        chunks.append(chunk[owner[run]])
        begins.append(place[run])
        lengths.append(length)
    return runs_by_chunk(chunks, begins, lengths)


def repeat_runs(
    source: Corpus, width: int, long_prefix_chunks: int = LONG_PREFIX_CHUNKS
) -> DataFrame:
    """Runs of windows that also begin earlier, by chunk."""
    spec = Spec(width, min(PREFIX_WORDS, width), word_units, 6.0)

    def resolve(table: pa.Table) -> pa.Table:
        return later_windows(table, width)

    slices = candidate_slices(source, spec, long_prefix_chunks=long_prefix_chunks)
    return slices.groupBy("bucket").applyInArrow(resolve, RUNS)


def remove_repeats(
    docs: DataFrame,
    *,
    width: int = 20,
    id_col: str = "doc_id",
    text_col: str = "text",
    carry: tuple[str, ...] = (),
    chunk_bytes: int = CHUNK_BYTES,
    long_prefix_chunks: int = LONG_PREFIX_CHUNKS,
) -> DataFrame:
    """Each text without the words of windows that also begin earlier.

    Earlier means: in a document with a smaller id, or in the same document further
    left. Windows are ``width`` words, judged on the texts as given. Rows with equal
    ids count in the order of their texts, a null id comes last; null and empty
    texts have no words. Columns: doc_id, n_words, n_removed, text (the words that
    are kept, joined by one space) and those in ``carry``; a carried column whose name
    is taken gets ``_in`` behind it. Other columns are ignored.
    """
    source = corpus(
        docs, id_col=id_col, text_col=text_col, carry=carry, chunk_bytes=chunk_bytes
    )
    types = [docs.schema[c].dataType.simpleString() for c in carry]

    def apply(table: pa.Table, runs: pa.Table) -> pa.Table:
        table = in_order(table)
        words = words_of(table.column("body").to_pylist())
        gone = covered(runs, len(words.values), width)
        lengths = np.diff(words.offsets)
        kept = words.joined[np.repeat(~gone, lengths)]
        sizes = np.concatenate(([0], np.cumsum(np.where(gone, 0, lengths))))
        removed = np.concatenate(([0], np.cumsum(gone)))
        ends = words.ends
        begins = np.concatenate(([0], ends[:-1]))
        texts = [
            kept[a : max(b - 1, a)].tobytes() for a, b in zip(sizes[begins], sizes[ends])
        ]
        return pa.table(
            {
                "doc_id": table.column("id"),
                "n_words": pa.array(ends - begins, pa.int64()),
                "n_removed": pa.array(removed[ends] - removed[begins], pa.int64()),
                "text": pa.array(texts, pa.binary()),
                **{f"c{i}": table.column(f"c{i}") for i in range(len(carry))},
            }
        )

    schema = "doc_id long, n_words long, n_removed long, text binary"
    schema += "".join(f", c{i} {kind}" for i, kind in enumerate(types))
    kept = (
        source.docs.groupBy("chunk")
        .cogroup(repeat_runs(source, width, long_prefix_chunks).groupBy("chunk"))
        .applyInArrow(apply, schema)
    )
    own = ["doc_id", "n_words", "n_removed", "text"]
    # As bytes until here, since a text from elsewhere need not be valid UTF-8.
    kept = kept.withColumn("text", kept["text"].cast("string"))
    return kept.toDF(*own, *(f"{c}_in" if c in own else c for c in carry))
