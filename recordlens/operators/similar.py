"""Pairs of similar texts, found by the parts that they must have in common.

Two texts that are at most d edits apart: cut the longer one into d + 1 parts, and one of
them occurs unchanged in the other (Li et al., Pass-Join, VLDB 2011). From the left, the
first part that the edits before it have not used up is found at most as many places
aside as there are parts before it; from the right likewise. So a text asks with its
parts and answers with those pieces of itself that can be a part of a text as long as
itself or longer, up to the length at which the similarity can no longer be reached.
The pairs that share such a piece are joined; all others cannot be similar enough.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordlens.functions.names import free_name, named
from recordlens.functions.text import edit_similarity
from recordlens.operators import spread
from recordlens.operators.spread import Side, lookup, pairs_within
from recordlens.storage import Workspace

# Below that similarity parts are single letters, and past that length a text has thousands
# of pieces: there every two texts of a group are compared, in tiles.
LEAST_BY_PARTS = 0.5
LONGEST_BY_PARTS = 48


def edits(length: Column, least: Column) -> Column:
    """The most edits that leave two texts, the longer of this length, similar enough."""
    return F.floor((1 - least) * length + F.lit(1e-9)).cast("int")


def _start(part: Column, length: Column, n_parts: Column) -> Column:
    """Where a part begins, counted from 0; all parts have the same length or one more."""
    return F.floor(part * length / n_parts).cast("int")


def parts(text: Column, least: Column) -> Column:
    """The parts (length, part, piece) of a text as the longer one of a pair."""
    length = F.length(text)
    n_parts = edits(length, least) + 1

    def of(part: Column) -> Column:
        start = _start(part, length, n_parts)
        piece = F.substring(text, start + 1, _start(part + 1, length, n_parts) - start)
        return F.struct(length.alias("length"), part.alias("part"), piece.alias("piece"))

    return F.transform(F.sequence(F.lit(0), n_parts - 1), of)


def pieces(text: Column, least: Column) -> Column:
    """The pieces of a text as the shorter one, or as long, that can be a longer one's part."""
    own = F.length(text)
    # The longest text with which the similarity can be reached.
    longest = F.floor(own / least + F.lit(1e-9)).cast("int")

    def of_length(length: Column) -> Column:
        d = edits(length, least)
        more = length - own

        def of_part(part: Column) -> Column:
            start = _start(part, length, d + 1)
            size = _start(part + 1, length, d + 1) - start
            first = F.greatest(F.lit(0), start - part, start - more - (d - part))
            last = F.least(own - size, start + part, start - more + (d - part))

            def at(place: Column) -> Column:
                return F.struct(
                    length.alias("length"),
                    part.alias("part"),
                    F.substring(text, place + 1, size).alias("piece"),
                )

            some = F.when(first <= last, F.sequence(first, last))
            return F.transform(F.coalesce(some, F.array().cast("array<int>")), at)

        return F.flatten(F.transform(F.sequence(F.lit(0), d), of_part))

    every = F.transform(F.sequence(own, F.greatest(longest, own)), of_length)
    return F.array_distinct(F.flatten(every))


def by_parts(
    rows: DataFrame,
    keys: Sequence[str],
    order: str,
    text: str,
    least: str,
    keep: Callable[[Side, Side], Column],
    fresh: str | None = None,
) -> DataFrame:
    """Pairs (a, b) of rows as structs that share a part and satisfy ``keep``, smaller ``order`` first.

    Complete for all pairs but those of two texts over LONGEST_BY_PARTS.
    """
    part = free_name(rows, "part")
    own, found = ("asks", "answers")
    fields = F.struct(*(named(c) for c in rows.columns))
    on = [named(k).alias(f"key_{i}") for i, k in enumerate(keys)]

    def side(alias: str, generated: Column, among: DataFrame) -> DataFrame:
        return among.select(
            fields.alias("row"), *on, F.explode(generated).alias(part)
        ).alias(alias)

    x, level = named(text), named(least)
    longer = side(own, parts(x, level), rows)
    shorter = side(found, pieces(x, level), rows.filter(F.length(x) <= LONGEST_BY_PARTS))

    def s(column: str) -> Column:
        return F.col(f"{found}.row")[column]

    def t(column: str) -> Column:
        return F.col(f"{own}.row")[column]

    agree = reduce(and_, (F.col(f"{found}.key_{i}") == F.col(f"{own}.key_{i}") for i in range(len(keys))))
    agree = agree & (F.col(f"{found}.{part}") == F.col(f"{own}.{part}"))
    # Texts of one length find each other from both sides; once is enough.
    once = (F.length(s(text)) < F.length(t(text))) | (s(order) < t(order))
    condition = agree & once & (s(order) != t(order)) & keep(s, t)
    ahead = s(order) < t(order)

    def paired(some: DataFrame, others: DataFrame) -> DataFrame:
        return some.join(others, condition).select(
            F.when(ahead, F.col(f"{found}.row")).otherwise(F.col(f"{own}.row")).alias("a"),
            F.when(ahead, F.col(f"{own}.row")).otherwise(F.col(f"{found}.row")).alias("b"),
        )

    if fresh is None:
        pairs = paired(shorter, longer)
    else:
        # Two joins, so that rows which have met before do not meet again.
        pairs = paired(shorter.filter(s(fresh)), longer).unionByName(
            paired(shorter.filter(~s(fresh)), longer.filter(t(fresh)))
        )
    return (
        pairs.withColumns({"a_order": F.col("a")[order], "b_order": F.col("b")[order]})
        .dropDuplicates(["a_order", "b_order"])
        .select("a", "b")
    )


def similar_pairs(
    rows: DataFrame,
    keys: Sequence[str],
    order: str,
    text: str,
    least: str,
    keep: Callable[[Side, Side], Column] | None = None,
    work: Workspace | None = None,
    fresh: str | None = None,
) -> DataFrame:
    """Pairs (a, b) of rows that agree on ``keys`` and whose texts are similar enough.

    All of them and no others: how they are found depends on the size of the group, the
    least similarity and the lengths, what is found does not. Groups too small to be worth
    their parts, similarities below LEAST_BY_PARTS, and texts that are both longer than
    LONGEST_BY_PARTS are compared pair by pair. A null text or key is similar to nothing;
    two blank texts are equal.

    Args:
        rows: The rows to pair.
        keys: Columns on which the two rows of a pair agree.
        order: Unique column that orders the two rows.
        text: The compared column.
        least: Column with the least similarity, from 0 to 1 and the same for all rows
            that agree on ``keys``.
        keep: A further condition on the two sides, the same for both orders.
        work: Where tables are written, for who wants to remove them.
        fresh: Boolean column of the rows that have not been paired before; if given, only
            pairs with such a row are looked for.

    Returns:
        Structs of all columns of ``rows``, smaller ``order`` first unless there is ``fresh``.
    """
    work = work or Workspace(rows.sparkSession, "similar")
    known = reduce(and_, (named(c).isNotNull() for c in (*keys, text)))
    columns = rows.columns

    def alike(a: Side, b: Side) -> Column:
        close = edit_similarity(a(text), b(text)) >= a(least)
        return close if keep is None else close & keep(a, b)

    size, kind = (free_name(rows, c) for c in ("size", "kind"))
    its = {k: free_name(rows, f"its_{i}") for i, k in enumerate(keys)}
    rows = work.keep(rows.filter(known), f"texts-{len(work.names)}")
    sizes = rows.groupBy(*(named(k).alias(i) for k, i in its.items())).agg(
        F.count(F.lit(1)).alias(size), F.lit(True).alias("in_large")
    )
    large = work.keep(sizes.filter(named(size) > spread.TILE_ROWS), f"large-{len(work.names)}")
    length = F.length(named(text))
    marked = lookup(rows, large, its, weight=size, how="left").withColumn(
        kind,
        F.when(F.col("in_large").isNull(), F.lit("small"))
        .when(named(least) < LEAST_BY_PARTS, F.lit("unlike"))
        .when(length == 0, F.lit("blank"))
        .when(length > LONGEST_BY_PARTS, F.lit("long")),
    )
    marked = work.keep(marked.drop("in_large"), f"marked-{len(work.names)}")
    in_parts = marked.filter(named(kind).isNull() | (named(kind) == "long")).drop(kind)
    cut = by_parts(in_parts, keys, order, text, least, alike, fresh)
    joined, a, b = pairs_within(marked, [*keys, kind], order, alike, work, fresh)
    sides = (F.struct(*(s(c).alias(c) for c in columns)) for s in (a, b))
    return cut.unionByName(joined.select(*(s.alias(n) for s, n in zip(sides, "ab"))))
