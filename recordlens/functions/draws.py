"""Reproducible pseudo-random draws computed from a row's key.

A draw depends on the salt and the key only: not on partitioning, row order or
retries, so a lost executor recomputes exactly the same rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


# A digest gives two words of 15 hex digits, and a word three draws of 20 bits.
WORD_DIGITS = 15
DRAW_BITS = 20


def uniforms(salt: str, *keys: Column, count: int) -> list[Column]:
    """``count`` draws from [0, 1), six from each MD5 of ``salt|number|keys``."""
    draws = []
    for i in range(count):
        digest = F.md5(
            F.concat_ws("|", F.lit(f"{salt}|{i // 6}"), *(k.cast("string") for k in keys))
        )
        start = 1 + WORD_DIGITS * (i // 3 % 2)
        word = F.conv(F.substring(digest, start, WORD_DIGITS), 16, 10).cast("bigint")
        bits = F.shiftright(word, DRAW_BITS * (i % 3)).bitwiseAND(F.lit(2**DRAW_BITS - 1))
        draws.append(bits / F.lit(float(2**DRAW_BITS)))
    return draws


def near_normal(draws: Sequence[Column]) -> Column:
    """Sum of twelve uniforms minus six: mean 0, variance 1, additions only."""
    total = draws[0]
    for draw in draws[1:]:
        total = total + draw
    return total - F.lit(6.0)


def whole(draw: Column, low: int, high: int) -> Column:
    """A whole number from ``low`` to ``high``, both included."""
    return (F.lit(low) + F.floor(draw * F.lit(float(high - low + 1)))).cast("int")


def pick(draw: Column, pool: Sequence[str]) -> Column:
    """One entry of a fixed ``pool``."""
    return F.element_at(F.array(*(F.lit(p) for p in pool)), whole(draw, 1, len(pool)))
