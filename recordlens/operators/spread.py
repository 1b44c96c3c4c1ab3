"""Joins that stay balanced when one key holds a large part of the rows.

A key is *heavy* if it holds more than 1/HEAVY_PARTS of the rows. By counting, fewer
than HEAVY_PARTS keys can be heavy, whatever the data. All that is broadcast of them is
an eight-byte hash and a number, so how wide keys and entries are makes no difference.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from math import isqrt
from operator import add, and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordlens.functions.names import free_name, named
from recordlens.storage import Workspace

HEAVY_PARTS = 100_000
# A heavy key is dealt to at most so many tasks.
MOST_SALTS = 1_000
BROADCAST_BYTES = 8 * 1024 * 1024
# Allowance per broadcast entry, and per field, for what a hash table adds.
ENTRY_BYTES = 64
FIELD_BYTES = 16
TILE_ROWS = 500

Side = Callable[[str], Column]


def lookup(
    rows: DataFrame,
    table: DataFrame,
    keys: dict[str, str],
    *,
    weight: str,
    how: str = "inner",
) -> DataFrame:
    """Attach to each row the one entry of a written ``table`` with the same keys.

    The table is measured first, keys and payload. Up to BROADCAST_BYTES all of it is
    broadcast and ``rows`` is not shuffled. Beyond that both sides are shuffled, and
    the rows of a heavy key are dealt to several tasks, each of which gets a copy of
    the key's one entry.

    Args:
        rows: The large side; any key may hold any share of it.
        table: One row per key, with how many rows the key has in ``weight``.
        keys: Key column of ``rows`` to key column of ``table``; null equals null.
            The columns of ``table`` have names of their own.
        weight: Column of ``table``, dropped from the result like its keys.
        how: ``inner`` or ``left``.
    """
    widths = (
        F.coalesce(F.octet_length(named(c).cast("string")), F.lit(0)) + FIELD_BYTES
        for c in table.columns
    )
    size = table.agg(
        F.coalesce(F.sum(reduce(add, widths) + ENTRY_BYTES), F.lit(0)).alias("bytes"),
        F.coalesce(F.sum(named(weight)), F.lit(0)).alias("total"),
        F.coalesce(F.max(named(weight)), F.lit(0)).alias("heaviest"),
    ).first()
    on = reduce(and_, (named(r).eqNullSafe(named(t)) for r, t in keys.items()))
    extra = [*keys.values(), weight]
    if size["bytes"] <= BROADCAST_BYTES:
        return rows.join(F.broadcast(table), on, how).drop(*extra)
    share = max(size["total"] // HEAVY_PARTS, 1)
    if size["heaviest"] <= share:
        return rows.join(table.hint("merge"), on, how).drop(*extra)
    print_, salts, salt, its_salt = (
        free_name(rows, c) for c in ("print", "salts", "salt", "its_salt")
    )
    # Rows and entries look a key up by the same hash, so both know it as heavy; a light
    # key with a heavy one's hash is dealt out needlessly, no more.
    heavy = F.broadcast(
        table.filter(named(weight) > share)
        .groupBy(F.xxhash64(*(named(t) for t in keys.values())).alias(print_))
        .agg(
            F.least(F.ceil(F.max(named(weight)) / share), F.lit(MOST_SALTS))
            .cast("int")
            .alias(salts)
        )
    )
    one = F.coalesce(named(salts), F.lit(1))
    dealt = (
        rows.withColumn(print_, F.xxhash64(*(named(r) for r in keys)))
        .join(heavy, print_, "left")
        .withColumn(salt, F.pmod(F.monotonically_increasing_id(), one))
        .drop(print_, salts)
    )
    copies = (
        table.withColumn(print_, F.xxhash64(*(named(t) for t in keys.values())))
        .join(heavy, print_, "left")
        .withColumn(its_salt, F.explode(F.sequence(F.lit(0).cast("bigint"), one - 1)))
        .drop(print_, salts)
    )
    on = on & (named(salt) == named(its_salt))
    return dealt.join(copies.hint("merge"), on, how).drop(*extra, salt, its_salt)


def pairs_within(
    rows: DataFrame,
    keys: Sequence[str],
    order: str,
    keep: Callable[[Side, Side], Column],
    work: Workspace | None = None,
    fresh: str | None = None,
    alike: Sequence[str] = (),
    measures: Mapping[str, Callable[[Side, Side], Column]] | None = None,
) -> tuple[DataFrame, Side, Side]:
    """Pairs of rows that agree on ``keys`` and satisfy ``keep``, smaller ``order`` first.

    With ``fresh`` only pairs with a fresh row, which then is the first side; two rows
    that are not fresh do not meet.

    ``keep`` is part of the join condition, so a pair that fails it never leaves
    the join. The rows are written once; what looks for groups of more than TILE_ROWS
    rows and both sides of the join read what is written. Without such groups it is a
    plain join, for adaptive execution to size. If there are any, they are cut into
    slices and every two slices meet in a task of their own, so that the work of a large
    group spreads over the cluster and each pair is still seen exactly once. A row goes
    to as many tasks as there are slices, at most about thrice the root of their number.
    Without ``fresh`` the rows of one slice are one side there and those of the other the
    other, so that no task looks at two rows twice, or at those of a slice among themselves.

    Args:
        rows: The rows to pair; a null key agrees with nothing.
        keys: Columns on which the two rows of a pair agree.
        order: Column that orders the two rows; equal values do not pair.
        keep: Condition on the two sides, given as column lookups, the same for both orders.
        work: Where the rows are written, for who wants to remove them.
        fresh: Boolean column of the rows that have not been paired before.
        alike: Columns that ``measures`` look at. In tiles the rows of a slice that agree on
            them are one row until they have been measured, so that many rows with few
            values cost few measurements.
        measures: Columns of the joined frame, made of the ``alike`` ones of both sides and
            the same for both orders.

    Returns:
        The joined frame and the column lookups of its two sides.
    """

    def a(column: str) -> Column:
        return F.col(f"a.`{column}`")

    def b(column: str) -> Column:
        return F.col(f"b.`{column}`")

    def agree(on: Sequence[str]) -> Column:
        return reduce(and_, (a(k) == b(k) for k in on))

    def meet(apart: DataFrame, on: Sequence[str], condition: Column) -> DataFrame:
        first = apart if fresh is None else apart.filter(named(fresh))
        return first.alias("a").join(apart.alias("b"), agree(on) & condition)

    spark = rows.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    work = work or Workspace(spark, "pairs")
    number = len(work.names)
    known = reduce(and_, (named(k).isNotNull() for k in keys))
    rows = work.keep(rows.filter(known), f"rows-{number}")
    large = {k: free_name(rows, f"large_{i}") for i, k in enumerate(keys)}
    size, slices, mine, met, low, high = (
        free_name(rows, c) for c in ("size", "slices", "slice", "met", "low_slice", "high_slice")
    )
    in_order = a(order) < b(order)
    if fresh is not None:
        in_order = in_order | (~b(fresh) & (a(order) != b(order)))
    sizes = (
        rows.groupBy(*(named(k).alias(t) for k, t in large.items()))
        .agg(F.count(F.lit(1)).alias(size))
        .filter(named(size) > TILE_ROWS)
    )
    if sizes.isEmpty():
        return _measured(meet(rows, keys, in_order & keep(a, b)), a, b, rows.columns, measures)

    sizes = work.keep(
        sizes.withColumn(
            slices, F.least(F.ceil(named(size) / TILE_ROWS), F.lit(2 * isqrt(2 * tasks) + 2))
        ),
        f"sizes-{number}",
    )
    sliced = (
        lookup(rows, sizes, large, weight=size, how="left")
        .withColumn(slices, F.coalesce(named(slices), F.lit(1).cast("bigint")))
        .withColumn(mine, F.pmod(F.xxhash64(named(order)), named(slices)))
        .withColumn(met, F.explode(F.sequence(F.lit(0).cast("bigint"), named(slices) - 1)))
        .withColumns({low: F.least(mine, met), high: F.greatest(mine, met)})
    )
    on = [*keys, low, high]
    # A fixed number of partitions: the work is in the pairs of a tile, not in the bytes
    # by which Spark would merge small partitions.
    tiles = sliced.repartition(tasks, *(named(k) for k in on))
    if fresh is not None:
        # Two slices also meet themselves in their tile; that belongs to their own tiles.
        # Not written as equalities, which Spark would take as keys of two other shuffles.
        apart = (a(mine) != b(mine)) | (a(low) >= a(high))
        pairs = meet(tiles, on, apart & in_order & keep(a, b))
        return _measured(pairs, a, b, rows.columns, measures)
    first, second = (tiles.filter(named(mine) == named(end)) for end in (low, high))

    def paired(x: Side, y: Side) -> tuple[Column, Side, Side]:
        """Whether two rows of a tile are a pair, and the lookups of its two sides."""
        ahead = x(order) < y(order)
        # Rows of the same order lie in the same slice, so two slices have none in common.
        apart = (x(low) < x(high)) & (x(order) != y(order))

        def smaller(column: str) -> Column:
            return F.when(ahead, x(column)).otherwise(y(column))

        def larger(column: str) -> Column:
            return F.when(ahead, y(column)).otherwise(x(column))

        return (apart | ahead) & keep(x, y), smaller, larger

    if not measures:
        condition, smaller, larger = paired(a, b)
        return first.alias("a").join(second.alias("b"), agree(on) & condition), smaller, larger

    rest = [c for c in rows.columns if c not in (*keys, *alike)]
    members = free_name(rows, "members")

    def gathered(side: DataFrame, alias: str) -> DataFrame:
        held = F.collect_list(F.struct(*map(named, rest))).alias(members)
        return side.groupBy(*map(named, [*on, *alike])).agg(held).alias(alias)

    met, x, y = _measured(
        gathered(first, "a").join(gathered(second, "b"), agree(on)),
        a,
        b,
        [*on, *alike, members],
        measures,
    )
    for side, end in ((x, "a"), (y, "b")):
        met = met.select("*", F.explode(side(members)).alias(f"{end} {members}"))

    def member(side: Side, end: str) -> Side:
        return lambda c: named(f"{end} {members}")[c] if c in rest else side(c)

    condition, smaller, larger = paired(member(x, "a"), member(y, "b"))
    return met.filter(condition), smaller, larger


def _measured(
    pairs: DataFrame,
    a: Side,
    b: Side,
    columns: Sequence[str],
    measures: Mapping[str, Callable[[Side, Side], Column]] | None,
) -> tuple[DataFrame, Side, Side]:
    """Joined rows with their measures, and the lookups of the sides."""
    if not measures:
        return pairs, a, b
    sides = [s(c).alias(f"{end}.{c}") for end, s in (("a", a), ("b", b)) for c in columns]
    # Generated, not projected: no filter on the measures goes below and makes them twice.
    made = F.struct(*(make(a, b).alias(name) for name, make in measures.items()))
    met = pairs.select(*sides, F.inline(F.array(made)))
    return met, lambda c: named(f"a.{c}"), lambda c: named(f"b.{c}")
