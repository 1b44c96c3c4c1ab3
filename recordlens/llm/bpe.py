"""Byte-level BPE as a streaming transducer, and an incremental decoder.

Encoding. A text is cut by the pre-tokenisation pattern; merges never cross such a
cut. Within one piece, how far to the right a byte can still change a token is
bounded by the merge list itself (``sufficient_lookahead``): a change moves one
token to the left only through a merge of a later rank. A piece is therefore read
through a buffer of constant size, and tokens that end at least that far before the
buffer's end are emitted at once; merging starts afresh behind them, because the
merges on the two sides of a final token boundary do not touch each other.

Decoding. Ids become bytes by a table, and bytes become text by a state machine
that holds back an incomplete character and replaces what cannot be completed.
"""

from __future__ import annotations

import codecs
import gc
import hashlib
import heapq
import json
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from functools import cached_property, lru_cache
from itertools import batched
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from recordlens.llm.batches import id_and_text, slices

SLICE_BYTES = 4 << 20
# Bytes that one generation of remembered units may take, and those of an
# entry besides its contents. What is longer than LONG_UNIT is not remembered.
REMEMBERED_BYTES = 16 << 20
ENTRY_BYTES = 320
LONG_UNIT = 1 << 10
# Units of a text with special strings that are looked at together.
BLOCK_UNITS = 1 << 14
# Characters of a text that are cut into units and hashed together.
BLOCK_CHARS = 128 << 10
# Pieces of fewer bytes are merged at once, without a buffer; those of so few characters
# side by side, so many at a time.
SHORT_PIECE = 256
SIDE_BY_SIDE = 24
ROWS = 8_192

# The characters with the White_Space property.
SPACE = "\u0009\u000a\u000b\u000c\u000d \u0085\u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
# Cuts that the pattern below always makes too: before a lone space and around other space.
UNIT = rf" ?[^{SPACE}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]"
# Fixed value: the public pre-tokenisation pattern of this kind of vocabulary.
PIECE = rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{SPACE}\p{{L}}\p{{N}}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"

SCHEMA = (
    "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, round_trip boolean"
)


def byte_letters() -> dict[int, str]:
    """The printable stand-in of each byte in the files of byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(others)}


class Vocabulary:
    """Token bytes, ids, merges and special strings, read from a vocabulary file.

    Args:
        source: The text of a ``.json`` file with a byte-level BPE model.
    """

    def __init__(self, source: str) -> None:
        spec = json.loads(source)
        letters = {c: b for b, c in byte_letters().items()}
        ids = {
            bytes(letters[c] for c in token): i
            for token, i in spec["model"]["vocab"].items()
            if all(c in letters for c in token)
        }
        pairs = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        self.merges = [tuple(bytes(letters[c] for c in part) for part in pair) for pair in pairs]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.bytes_of = {i: token for token, i in ids.items()}
        self.bytes_of.update((i, text.encode()) for text, i in self.special.items())
        # Ids as they are digested.
        self.numbers = {i: b",%d" % i for i in self.bytes_of}
        self.byte_ids = [ids[bytes([b])] for b in range(256)]
        # Pair of ids, as one number, to the rank of its merge; rank to the merged id.
        self.ranks = {pair_key(ids[u], ids[v]): r for r, (u, v) in enumerate(self.merges)}
        self.made = [ids[u + v] for u, v in self.merges]

    @cached_property
    def sorted_ranks(self) -> tuple[np.ndarray, np.ndarray]:
        """Pairs in order, and their ranks."""
        keys = np.array(list(self.ranks), np.int64)
        order = np.argsort(keys)
        return keys[order], np.array(list(self.ranks.values()), np.int32)[order]

    @cached_property
    def byte_ranks(self) -> np.ndarray:
        """The rank of two bytes' merge, by both bytes; one past the last where there is none."""
        ids, none = self.byte_ids, len(self.made)
        found = [self.ranks.get(pair_key(u, v), none) for u in ids for v in ids]
        return np.array(found, np.int32).reshape(256, 256)


def pair_key(left: int, right: int) -> int:
    """Two ids as one number."""
    return left << 32 | right


def sufficient_lookahead(merges: list[tuple[bytes, bytes]]) -> int:
    """Bytes to the right of a token's end that can still change it.

    Take a merge (u, v) that happens or not, depending on what follows. It concerns
    the tokens that begin where u begins. A merge (x, y) further left is concerned
    only if y is built from u as its first part, and only if it has a later rank.
    The longest chain of such merges, times the longest token, bounds the reach; a
    merge (x, y) with u at the beginning of x carries the chain on without moving.
    """
    made = {u + v: (u, v) for u, v in reversed(merges)}

    def beginnings(token: bytes) -> Iterator[bytes]:
        while True:
            yield token
            if token not in made:
                return
            token = made[token][0]

    longest: dict[bytes, int] = {}
    deepest = 0
    for x, y in merges:
        moved = 1 + max(longest.get(t, 0) for t in beginnings(y))
        reach = max(moved, max(longest.get(t, 0) for t in beginnings(x)))
        longest[x] = max(longest.get(x, 0), reach)
        deepest = max(deepest, reach)
    widest = max((len(u) + len(v) for u, v in merges), default=1)
    return (deepest + 1) * widest


def merge_all(piece: bytes, vocabulary: Vocabulary) -> list[int]:
    """The ids of a piece: always the pair of least rank, of equal ones the leftmost."""
    get, made, none = vocabulary.ranks.get, vocabulary.made, len(vocabulary.made)
    parts = [vocabulary.byte_ids[b] for b in piece]
    order = [get(u << 32 | v, none) for u, v in zip(parts, parts[1:])]
    while order:
        rank = min(order)
        if rank == none:
            break
        at = order.index(rank)
        parts[at : at + 2] = [made[rank]]
        del order[at]
        if at:
            order[at - 1] = get(parts[at - 1] << 32 | parts[at], none)
        if at < len(order):
            order[at] = get(parts[at] << 32 | parts[at + 1], none)
    return parts


def merge_many(pieces: list[bytes], vocabulary: Vocabulary) -> list[list[int]]:
    """The ids of many short pieces, merged side by side: a row each, a merge a round."""
    if not pieces:
        return []
    none = len(vocabulary.made)
    keys, ranks = vocabulary.sorted_ranks
    made = np.array([*vocabulary.made, 0], np.int32)
    out: list[list[int]] = [[]] * len(pieces)
    lengths = np.array([len(p) for p in pieces])
    width = int(lengths.max())

    def rank_of(left: np.ndarray, right: np.ndarray) -> np.ndarray:
        wanted = left.astype(np.int64) << 32 | right
        at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
        return np.where((keys[at] == wanted) & (right >= 0), ranks[at], np.int32(none))

    table = np.array(vocabulary.byte_ids, np.int32)
    parts = np.full((len(pieces), width + 1), -1, np.int32)
    inside = np.arange(width + 1) < lengths[:, None]
    joined = np.frombuffer(b"".join(pieces), np.uint8)
    parts[inside] = table[joined]
    order = np.full((len(pieces), width), none, np.int32)
    # Two bytes that follow each other, but not those of two pieces.
    pair = np.ones(len(joined), bool)
    pair[np.cumsum(lengths) - 1] = False
    at = np.flatnonzero(pair)
    order[parts[:, 1:] >= 0] = vocabulary.byte_ranks[joined[at], joined[at + 1]]
    row_of, column = np.arange(len(pieces)), np.arange(width + 1)
    while len(row_of):
        at = order.argmin(axis=1)
        every = np.arange(len(row_of))
        least = order[every, at]
        done = least == none
        if done.any():
            ended = parts[done]
            left_over = ended >= 0
            ids, stops = ended[left_over].tolist(), np.cumsum(left_over.sum(axis=1)).tolist()
            for i, start, stop in zip(row_of[done].tolist(), [0, *stops], stops):
                out[i] = ids[start:stop]
            going = ~done
            row_of, parts, order = row_of[going], parts[going], order[going]
            at, least = at[going], least[going]
            every = np.arange(len(row_of))
            if not len(row_of):
                break
        # The pair becomes one id, and what follows moves up.
        behind = column > at[:, None]
        moved = np.full_like(parts, -1)
        moved[:, :-1] = parts[:, 1:]
        parts = np.where(behind, moved, parts)
        parts[every, at] = made[least]
        moved = np.full_like(order, none)
        moved[:, :-1] = order[:, 1:]
        order = np.where(behind[:, :-1] | (column[:-1] == at[:, None]), moved, order)
        order[every, at] = rank_of(parts[every, at], parts[every, at + 1])
        has_left = np.flatnonzero(at > 0)
        left = at[has_left] - 1
        order[has_left, left] = rank_of(parts[has_left, left], parts[has_left, at[has_left]])
    return out


def transduce(
    source: Iterable[bytes], vocabulary: Vocabulary, lookahead: int
) -> Iterator[int]:
    """The ids of one piece that arrives in blocks, each emitted once it is stable."""
    held, length = b"", vocabulary.bytes_of
    for block in source:
        held += block
        if len(held) < 2 * lookahead:
            continue
        stable, end = len(held) - lookahead, 0
        for token in merge_long(held, vocabulary):
            if end + len(length[token]) > stable:
                break
            end += len(length[token])
            yield token
        held = held[end:]
    yield from merge_long(held, vocabulary)


def merge_long(piece: bytes, vocabulary: Vocabulary) -> list[int]:
    """As merge_all, with a heap of pairs for pieces of thousands of bytes."""
    ranks, made = vocabulary.ranks, vocabulary.made
    parts: list[int | None] = [vocabulary.byte_ids[b] for b in piece]
    after = [*range(1, len(parts)), -1]
    before = [*range(-1, len(parts) - 1)]
    heap = [
        (rank, i)
        for i, (u, v) in enumerate(zip(parts, parts[1:]))
        if (rank := ranks.get(u << 32 | v)) is not None
    ]
    heapq.heapify(heap)
    while heap:
        rank, i = heapq.heappop(heap)
        j = after[i]
        if parts[i] is None or j < 0 or ranks.get(parts[i] << 32 | parts[j]) != rank:
            continue
        parts[i], parts[j] = made[rank], None
        after[i] = after[j]
        if after[i] >= 0:
            before[after[i]] = i
        for left in (before[i], i):
            right = after[left] if left >= 0 else -1
            if right >= 0:
                found = ranks.get(parts[left] << 32 | parts[right])
                if found is not None:
                    heapq.heappush(heap, (found, left))
    return [p for p in parts if p is not None]


class Recent:
    """What was made of texts of late, in two generations of bounded size.

    When the younger one is full it becomes the older one, which is forgotten; what is
    asked for moves back into the younger one. So frequent texts are never made anew.
    """

    def __init__(self) -> None:
        self.young: dict[str, Any] = {}
        self.old: dict[str, Any] = {}
        self.n_bytes = 0
        self.long: list[str] = []

    def forget(self) -> None:
        """Give back the memory of all entries."""
        self.young, self.old, self.n_bytes = {}, {}, 0
        self.long.clear()

    def missing(self, wanted: set[str]) -> set[str]:
        """Those that are not known; the others are in ``young`` afterwards."""
        for text in self.long:
            self.young.pop(text, None)
        self.long.clear()
        if self.n_bytes > REMEMBERED_BYTES:
            self.old, self.young, self.n_bytes = self.young, {}, 0
        wanted = wanted - self.young.keys()
        again = wanted & self.old.keys()
        self.add_all([(text, self.old.pop(text)) for text in again])
        return wanted - again

    def add(self, text: str, made: Any) -> None:
        """Remember it; a long text until the next question only."""
        self.add_all([(text, made)])

    def add_all(self, found: list[tuple[str, Any]]) -> None:
        """Remember texts with what was made of them."""
        self.young.update(found)
        lengths = [len(text) for text, _ in found]
        if max(lengths, default=0) > LONG_UNIT:
            self.long += [text for text, _ in found if len(text) > LONG_UNIT]
            lengths = [n for n in lengths if n <= LONG_UNIT]
        self.n_bytes += ENTRY_BYTES * len(lengths) + 8 * sum(lengths)


# Ids as text, each behind a comma, how many, and their bytes.
Entry = tuple[bytes, int, bytes]


class Encoder:
    """Ids of units of text without special strings; remembers units it has encoded."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        import regex

        self.vocabulary = vocabulary
        self.pieces = regex.compile(PIECE).findall
        self.known = Recent()

    @cached_property
    def lookahead(self) -> int:
        return sufficient_lookahead(self.vocabulary.merges)

    def entry(self, ids: list[int]) -> Entry:
        numbers, token_bytes = self.vocabulary.numbers, self.vocabulary.bytes_of
        return b"".join([numbers[i] for i in ids]), len(ids), b"".join([token_bytes[i] for i in ids])

    def merged(self, pieces: set[str]) -> dict[str, Entry]:
        """Entries of pieces, of short ones many at a time."""
        out = {p: self.entry(self.piece(p)) for p in pieces if len(p) > SIDE_BY_SIDE}
        # In order of length, so that the rows of a table are about equally long.
        short = sorted(pieces - out.keys() if out else pieces, key=len)
        for start in range(0, len(short), ROWS):
            some = short[start : start + ROWS]
            found = merge_many([p.encode("utf-8", "replace") for p in some], self.vocabulary)
            out.update(zip(some, map(self.entry, found)))
        return out

    def piece(self, piece: str) -> list[int]:
        body = piece.encode("utf-8", "replace")
        if len(body) < SHORT_PIECE:
            return merge_all(body, self.vocabulary)
        step = self.lookahead
        blocks = (body[i : i + step] for i in range(0, len(body), step))
        return list(transduce(blocks, self.vocabulary, step))

    def encode(self, unit: str) -> list[int]:
        return [i for piece in self.pieces(unit) for i in self.piece(piece)]

    def learn(self, units: Iterable[str]) -> None:
        """Encode the units that are new; all are in ``known.young`` afterwards."""
        new = self.known.missing(set(units))
        special = self.vocabulary.special
        found = [(unit, self.entry([special[unit]])) for unit in new & special.keys()]
        new -= special.keys()
        # Letters, also behind a space, are one piece; other units are cut.
        words = {u for u in new if u.isascii() and (u[1:] if u[0] == " " else u).isalpha()}
        others = list(new - words)
        of_unit = list(map(self.pieces, others))
        pieces = set().union(*of_unit)
        # A piece alone is cut as it is within a text, so the entry of an equal unit will do.
        entries = {p: known[p] for known in (self.known.old, self.known.young) for p in pieces & known.keys()}
        entries |= self.merged(words | (pieces - entries.keys()))
        found += [(unit, entries[unit]) for unit in words]
        for unit, own in zip(others, of_unit):
            if len(own) == 1:
                found.append((unit, entries[unit]))
            else:
                numbers, counts, bodies = zip(*[entries[p] for p in own])
                found.append((unit, (b"".join(numbers), sum(counts), b"".join(bodies))))
        self.known.add_all(found)


def units(text: str, special: Iterable[str]) -> Iterator[tuple[str, bool]]:
    """The text cut at special strings and then into units; true marks a special string."""
    import re

    cut = re.compile(UNIT)
    names = [s for s in special if s in text]
    if not names:
        for match in cut.finditer(text):
            yield match.group(), False
        return
    pattern = "(" + "|".join(re.escape(s) for s in sorted(names, key=len, reverse=True)) + ")"
    for i, part in enumerate(re.split(pattern, text)):
        if i % 2:
            yield part, True
        else:
            for match in cut.finditer(part):
                yield match.group(), False


def encode(text: str, vocabulary: Vocabulary) -> list[int]:
    """The ids of one text, as a whole list; for single texts and tests."""
    encoder = Encoder(vocabulary)
    found: list[int] = []
    for unit, special in units(text, vocabulary.special):
        found += [vocabulary.special[unit]] if special else encoder.encode(unit)
    return found


def decode(ids: Iterable[int], vocabulary: Vocabulary) -> str:
    """The text of ids, byte by byte; ids without a token are skipped."""
    machine = codecs.getincrementaldecoder("utf-8")("replace")
    parts = [machine.decode(vocabulary.bytes_of.get(i, b"")) for i in ids]
    return "".join(parts) + machine.decode(b"", True)


@lru_cache(maxsize=1)
def learned_with(vocabulary_file: str) -> tuple[Vocabulary, Encoder]:
    """A vocabulary and its encoder, for all tasks of this process."""
    with open(vocabulary_file, encoding="utf-8") as f:
        vocabulary = Vocabulary(f.read())
    return vocabulary, Encoder(vocabulary)


@contextmanager
def remembering(known: Recent) -> Iterator[None]:
    """Entries are kept to the end of the block, as the process may wait for other work.

    Meanwhile nothing searches them for reference cycles: there are none, and going
    through all entries takes long.
    """
    was_on = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        known.forget()
        if was_on:
            gc.enable()


def encode_and_decode(
    docs: DataFrame,
    vocabulary_file: str,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    slice_bytes: int = SLICE_BYTES,
) -> DataFrame:
    """Encode each whole text, decode the ids again, and digest both.

    ids_sha256 is taken over the decimal ids joined by commas, decoded_sha256 over
    the decoded text; ``round_trip`` says whether that is the text. A null text
    counts as empty and gives no ids, repeated rows are encoded each for itself, and
    columns beyond id and text are ignored. ``vocabulary_file`` has to be readable on
    every executor. Texts of up to ``slice_bytes`` in all are encoded together: fewer take
    less memory and more time.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import re

        vocabulary, encoder = learned_with(vocabulary_file)
        learn = encoder.learn
        cut = re.compile(UNIT).findall
        lone_space = re.compile(rf"[^{SPACE}](?= [^{SPACE}])")

        def blocks(text: str) -> Iterator[list[str]]:
            if any(s in text for s in vocabulary.special):
                found = (u for u, _ in units(text, vocabulary.special))
                yield from map(list, batched(found, BLOCK_UNITS))
                return
            # Long texts are cut before a lone space between two words, where a unit begins.
            start = 0
            while start < len(text):
                stop = len(text)
                if stop - start > BLOCK_CHARS:
                    lone = lone_space.search(text, start + BLOCK_CHARS)
                    stop = lone.start() + 1 if lone else stop
                yield cut(text, start, stop)
                start = stop

        def digest(body: bytes, own: Iterable[list[str]], learned: bool) -> tuple:
            id_hash, text_hash, count, first = hashlib.sha256(), hashlib.sha256(), 0, True
            machine = codecs.getincrementaldecoder("utf-8")("replace")
            for block in own:
                if not learned:
                    learn(block)
                if not block:
                    continue
                young = encoder.known.young
                found = [young[unit] for unit in block]
                ids = b"".join([e[0] for e in found])
                count += sum([e[1] for e in found])
                id_hash.update(ids[1:] if first else ids)
                first = first and not ids
                decoded = machine.decode(b"".join([e[2] for e in found]))
                text_hash.update(decoded.encode())
            text_hash.update(machine.decode(b"", True).encode())
            same = text_hash.digest() == hashlib.sha256(body).digest()
            return count, id_hash.hexdigest(), text_hash.hexdigest(), same

        with remembering(encoder.known):
            for part in slices(batches, slice_bytes):
                bodies = part.column("body").to_pylist()
                texts = (b.decode("utf-8", "replace") for b in bodies)
                # The units of short texts are cut once and learned together, which is faster.
                short = [len(b) < BLOCK_CHARS for b in bodies]
                own = [list(blocks(t)) if s else blocks(t) for t, s in zip(texts, short)]
                learn(set().union(*(block for some, s in zip(own, short) if s for block in some)))
                rows: list = [
                    digest(b, some, True) if s else None for b, some, s in zip(bodies, own, short)
                ]
                for i, (body, some) in enumerate(zip(bodies, own)):
                    if rows[i] is None:
                        rows[i] = digest(body, some, False)
                out = [part.column("id"), *(pa.array(c) for c in zip(*rows))]
                names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "round_trip"]
                yield pa.RecordBatch.from_arrays(out, names=names)

    return id_and_text(docs, id_col, text_col).mapInArrow(run, SCHEMA)
