"""Words and bytes as arrays of 64-bit numbers, and anchors of their windows."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

# Multiplier of the rolling hash, odd and so with an inverse modulo 2**64.
BASE = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
# Units looked at together. Positions within a block take the low bits of a packed hash.
BLOCK = 1 << 19
POSITION = np.uint64((1 << 20) - 1)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(base: np.uint64, n: int) -> np.ndarray:
    """base**0 ... base**(n-1) modulo 2**64."""
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def byte_values() -> np.ndarray:
    """A 64-bit number for each byte."""
    return mix(np.arange(1, 257, dtype=np.uint64) * BASE)


@dataclass
class Words:
    """The words of texts laid end to end.

    Attributes:
        joined: All words, each followed by one space.
        offsets: Where each word begins in ``joined``, and its length at the end.
        values: A 64-bit number for each word.
        ends: For each text, the number of words up to its end.
    """

    joined: np.ndarray
    offsets: np.ndarray
    values: np.ndarray
    ends: np.ndarray

    def text(self, start: int, stop: int) -> bytes:
        """Words ``start`` to ``stop``, joined by one space."""
        return self.joined[self.offsets[start] : max(self.offsets[stop] - 1, 0)].tobytes()


def lower_ascii(data: np.ndarray) -> np.ndarray:
    """The bytes with A-Z in lower case."""
    return np.where((data >= 65) & (data <= 90), data | 32, data).astype(np.uint8)


def words_of(bodies: list[bytes], *, lower: bool = False) -> Words:
    """The words ``[^\\x20\\x09-\\x0D]+`` of UTF-8 texts."""
    data = np.frombuffer(b" ".join([*bodies, b""]), np.uint8)
    text_ends = np.cumsum([len(b) + 1 for b in bodies]) if bodies else np.empty(0, np.int64)
    inside = (data != 32) & ((data < 9) | (data > 13))
    behind = np.zeros_like(inside)
    behind[1:] = inside[:-1] & ~inside[1:]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    joined = np.where(behind, np.uint8(32), data)[inside | behind]
    if lower:
        joined = lower_ascii(joined)
    stops = np.flatnonzero(joined == 32)
    offsets = np.concatenate(([0], stops + 1)).astype(np.int64)
    ends = np.searchsorted(np.flatnonzero(begins), text_ends)
    return Words(joined, offsets, word_values(joined, offsets), ends)


def word_values(joined: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A 64-bit number for each word, from its bytes."""
    table = byte_values()
    values = np.empty(len(offsets) - 1, np.uint64)
    first = 0
    while first < len(values):
        last = int(np.searchsorted(offsets, offsets[first] + BLOCK, "right")) - 1
        last = max(last, first + 1)
        part = joined[offsets[first] : offsets[last]]
        # The space behind a word marks its end, so that words are free of prefixes.
        terms = np.take(table, part)
        terms *= powers(BASE, len(part))
        starts = offsets[first:last] - offsets[first]
        sums = np.add.reduceat(terms, starts)
        values[first:last] = mix(sums * powers(INVERSE, len(part))[starts])
        first = last
    return values


def grams(values: np.ndarray, k: int) -> np.ndarray:
    """A 64-bit number for each run of k values."""
    if len(values) < k:
        return np.empty(0, np.uint64)
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers(BASE, len(values)), out=sums[1:], dtype=np.uint64)
    n = len(values) - k + 1
    return mix((sums[k:] - sums[:n]) * powers(INVERSE, n))


def whole_windows(ends: np.ndarray, total: int, width: int) -> np.ndarray:
    """For each unit, whether a window that begins there ends within its text."""
    valid = np.ones(total, bool)
    start = 0
    for end in ends:
        valid[max(start, end - width + 1) : end] = False
        start = end
    return valid


@dataclass
class Anchors:
    """Runs of windows that share an anchor.

    The anchor of a window is, of its runs of k units, the one with the least hash,
    the leftmost of equals. Equal windows have equal anchors at the same place.
    Windows ``first`` to ``last`` have the anchor that begins at ``at``.
    """

    at: np.ndarray
    first: np.ndarray
    last: np.ndarray
    keys: np.ndarray


def anchors(values: np.ndarray, valid: np.ndarray, width: int, k: int) -> Anchors:
    """The anchors of all windows of ``width`` units that ``valid`` allows."""
    found: list[tuple[np.ndarray, ...]] = []
    span = width - k + 1
    for base in range(0, max(len(values) - width + 1, 0), BLOCK):
        part = values[base : base + BLOCK + width - 1]
        keys = grams(part, k)
        least = (keys & ~POSITION) | np.arange(len(keys), dtype=np.uint64)
        reach = 1
        while reach * 2 <= span:
            least = np.minimum(least[:-reach], least[reach:])
            reach *= 2
        if reach < span:
            least = np.minimum(least[: -(span - reach)], least[span - reach :])
        at = np.flatnonzero(valid[base : base + len(least)])
        if not len(at):
            continue
        where = (least[at] & POSITION).astype(np.int64)
        new = np.ones(len(at), bool)
        new[1:] = (where[1:] != where[:-1]) | (at[1:] != at[:-1] + 1)
        starts = np.flatnonzero(new)
        stops = np.append(starts[1:], len(at)) - 1
        spots = where[starts]
        # Least hashes are small numbers; mixed once more they fill their range evenly.
        found.append((base + spots, base + at[starts], base + at[stops], mix(keys[spots])))
    if not found:
        empty = np.empty(0, np.int64)
        return Anchors(empty, empty, empty, np.empty(0, np.uint64))
    return Anchors(*(np.concatenate(c) for c in zip(*found)))
