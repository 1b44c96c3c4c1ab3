"""Text expressions for blocking and comparing records."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def normalised(text: Column) -> Column:
    """Lower case without outer spaces (tabs and newlines stay)."""
    return F.lower(F.trim(text))


def digits(text: Column) -> Column:
    """Only the digits of ``text``."""
    return F.regexp_replace(text, r"\D", "")


def block_key(name: Column, city: Column, *, trim: bool = False) -> Column:
    """First letter of the name and first three of the city, e.g. ``s|sea``.

    Nulls are skipped, so a missing name gives ``sea`` and two missing values an
    empty key. Outer spaces count unless ``trim`` is set.
    """
    if trim:
        name, city = F.trim(name), F.trim(city)
    return F.concat_ws(
        "|", F.substring(F.lower(name), 1, 1), F.substring(F.lower(city), 1, 3)
    )


def edit_similarity(a: Column, b: Column) -> Column:
    """``1 - levenshtein / longer length``; 1.0 for two blanks, 0.0 for a null."""
    longer = F.greatest(F.length(a), F.length(b))
    # Equal texts, two blanks among them, need no distance.
    return (
        F.when(a.isNull() | b.isNull(), F.lit(0.0))
        .when(a == b, F.lit(1.0))
        .otherwise(1 - F.levenshtein(a, b) / longer)
    )


def length_similarity(a: Column, b: Column) -> Column:
    """Upper bound of :func:`edit_similarity` that looks at the lengths only."""
    longer = F.greatest(F.length(a), F.length(b))
    return (
        F.when(a.isNull() | b.isNull(), F.lit(0.0))
        .when(longer == 0, F.lit(1.0))
        .otherwise(1 - F.abs(F.length(a) - F.length(b)) / longer)
    )


def same_email(a: Column, b: Column, *, blank_matches: bool = False) -> Column:
    """1.0 where two normalised emails agree, else 0.0; null agrees with nothing."""
    agree = a == b
    if not blank_matches:
        agree = agree & (F.length(a) > 0)
    return F.coalesce(agree.cast("double"), F.lit(0.0))


def same_phone(a: Column, b: Column) -> Column:
    """1.0 where two digit strings agree and are not empty, else 0.0."""
    return F.coalesce(((a == b) & (F.length(a) > 0)).cast("double"), F.lit(0.0))
