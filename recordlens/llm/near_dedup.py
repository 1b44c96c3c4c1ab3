"""Near-duplicate documents by a chosen-path set similarity join.

Every document has min-wise tokens: for each of some hash functions the least value
over its shingles. Independent trees branch the documents by tokens that each node
chooses: documents with equal tokens stay together. Small nodes are compared
exhaustively by their tokens; in large ones everything is also compared with two
pivots, the most central document and any other, and documents that are surely close to
the same pivot need not meet each other again. Where the link to a pivot turns out not to
hold, its nodes are compared again, component against component: the most alike pairs of
two components first, more of them as long as none is confirmed.
Documents with the same shingle set count as one throughout, and every link is
confirmed on the full sets before it joins two components.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import partial
from math import ceil, log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordlens.llm.batches import batches_up_to, id_and_text, slices
from recordlens.llm.units import BASE, grams, mix, words_of
from recordlens.operators.components import star_forest
from recordlens.storage import Workspace

SHINGLE = 5
TOKENS = 96
# Probability to miss a pair at the threshold in the first branching of every tree.
MISSED = 6e-9
# Nodes up to this size are compared exhaustively; larger ones branch.
LEAF = 64
# Documents of one node in one task; larger nodes branch over the cluster first.
TASK_DOCS = 10_000
# Branchings over the cluster, and in all.
SPREAD_DEPTH = 16
DEPTH = 48
# Standard deviations by which an estimate may miss the threshold, and by which it has to
# exceed it for two documents to count as close to the same pivot.
MARGIN = 5
SURE = 1.5
SLICE_BYTES = 2 << 20
# Most alike pairs of two components in a node that a round checks; then all.
ROUNDS = (2, 16, None)
# Ids up to this count are broadcast, eight bytes each.
BROADCAST_IDS = 500_000

FEATURES = "id long, n long, print_a long, print_b long, tokens binary"


def shingle_sets(bodies: list[bytes]) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    words = words_of(bodies, lower=True)
    every = grams(words.values, SHINGLE)
    out, start = [], 0
    for end in words.ends:
        n = end - start
        if n >= SHINGLE:
            out.append(np.unique(every[start : end - SHINGLE + 1]))
        else:
            out.append(grams(words.values[start:end], max(n, 1)))
        start = end
    return out


def minwise(sets: list[np.ndarray]) -> np.ndarray:
    """The min-wise tokens of non-empty sets, one row each."""
    every = np.concatenate(sets)
    starts = np.concatenate(([0], np.cumsum([len(s) for s in sets])[:-1]))
    out = np.empty((len(sets), TOKENS), np.uint32)
    factors = mix(np.arange(1, TOKENS + 1, dtype=np.uint64) * BASE) | np.uint64(1)
    for j in range(TOKENS):
        values = ((every ^ (factors[j] >> np.uint64(7))) * factors[j]) >> np.uint64(32)
        out[:, j] = np.minimum.reduceat(values.astype(np.uint32), starts)
    return out


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in slices(batches, SLICE_BYTES):
        sets = shingle_sets(part.column("body").to_pylist())
        sizes = np.array([len(s) for s in sets], np.int64)
        some = np.flatnonzero(sizes)
        prints = np.zeros((2, len(sets)), np.uint64)
        tokens: list[bytes | None] = [None] * len(sets)
        if len(some):
            full = [sets[i] for i in some]
            starts = np.concatenate(([0], np.cumsum(sizes[some])[:-1]))
            every = np.concatenate(full)
            prints[0, some] = np.add.reduceat(mix(every), starts)
            prints[1, some] = np.bitwise_xor.reduceat(mix(every + BASE), starts)
            for i, row in zip(some, minwise(full)):
                tokens[i] = row.tobytes()
        yield pa.RecordBatch.from_arrays(
            [
                part.column("id"),
                pa.array(sizes),
                pa.array(prints[0].view(np.int64)),
                pa.array(prints[1].view(np.int64)),
                pa.array(tokens, pa.binary()),
            ],
            names=["id", "n", "print_a", "print_b", "tokens"],
        )


def chosen(node: int, depth: int) -> int:
    """The token by which a node branches."""
    return int(mix(np.array([node], np.uint64) + np.uint64(depth))[0] % np.uint64(TOKENS))


def child(nodes: np.ndarray, depth: int, tokens: np.ndarray) -> np.ndarray:
    """The child nodes of documents in ``nodes``, whose tokens are rows."""
    at = (mix(nodes + np.uint64(depth)) % np.uint64(TOKENS)).astype(np.int64)
    value = tokens[np.arange(len(nodes)), at].astype(np.uint64)
    return mix(nodes * BASE + value + np.uint64(1))


def roots(trees: int) -> np.ndarray:
    return mix(np.arange(1, trees + 1, dtype=np.uint64) << np.uint64(20))


def tokens_of(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint32).reshape(-1, TOKENS)


def trees_for(percent: int) -> int:
    """How many trees miss a pair of this similarity with no more than MISSED."""
    return max(1, ceil(log(MISSED) / log(1 - percent / 100))) if percent < 100 else 1


def estimate(similarity: float, deviations: float) -> float:
    """Equal tokens of a pair of this similarity, so many standard deviations off."""
    spread = (similarity * (1 - similarity) * TOKENS) ** 0.5
    return max(similarity * TOKENS + deviations * spread, 1.0)


def central(tokens: np.ndarray) -> int:
    """The row that has the most of the tokens that are most frequent in their column."""
    agreeing = np.zeros(len(tokens), np.int64)
    for column in tokens.T:
        values, counts = np.unique(column, return_counts=True)
        agreeing += column == values[counts.argmax()]
    return int(agreeing.argmax())


def alike(
    sizes: np.ndarray, tokens: np.ndarray, percent: int, a: np.ndarray, b: np.ndarray
) -> np.ndarray:
    """How many tokens rows a and b have in common, 0 where their sizes are too different."""
    low, high = np.minimum(sizes[a], sizes[b]), np.maximum(sizes[a], sizes[b])
    equal = np.zeros(len(a), np.int64)
    possible = np.flatnonzero(low * 100 >= high * percent)
    equal[possible] = (tokens[a[possible]] == tokens[b[possible]]).sum(axis=1)
    return equal


def children_of(
    rows: np.ndarray, tokens: np.ndarray, node: int, depth: int
) -> Iterator[tuple[np.ndarray, int, int]]:
    """The child nodes of a node that hold two rows or more."""
    children = child(np.full(len(rows), node, np.uint64), depth, tokens[rows])
    order = np.argsort(children, kind="stable")
    cuts = np.flatnonzero(np.diff(children[order])) + 1
    for part in np.split(order, cuts):
        if len(part) > 1:
            yield rows[part], int(children[part[0]]), depth + 1


def every_pair(rows: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs of rows, those of a leaf at once and otherwise a leaf against the rest."""
    for start in range(0, len(rows), LEAF):
        own, rest = rows[start : start + LEAF], rows[start + LEAF :]
        i, j = np.triu_indices(len(own), 1)
        yield own[i], own[j]
        for other in range(0, len(rest), LEAF * LEAF):
            some = rest[other : other + LEAF * LEAF]
            yield np.repeat(own, len(some)), np.tile(some, len(own))


def pivots_of(rows: np.ndarray, tokens: np.ndarray, node: int, depth: int) -> tuple[int, int]:
    """The most central row and any other, the same in every search."""
    any_row = np.random.default_rng([node & 0xFFFFFFFF, depth]).choice(rows)
    return rows[central(tokens[rows])], any_row


def lean(
    group: np.ndarray, rows: np.ndarray, pivot: int, equal_to: Callable[..., np.ndarray], sure: float
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows that are not in the pivot's group, their equal tokens, and which lean on it.

    Those that do join the group of the pivot, or one that one of them is in already.
    """
    apart = (group[rows] != group[pivot]) | (group[rows] < 0)
    others = rows[apart & (rows != pivot)]
    equal = equal_to(np.full(len(others), pivot), others)
    leans = equal >= sure
    close = np.append(others[leans], pivot)
    if (group[close] < 0).any():
        taken = group[close].max()
        group[close[group[close] < 0]] = pivot if taken < 0 else taken
    return others, equal, leans


Found = Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]


def node_pairs(
    sizes: np.ndarray, tokens: np.ndarray, of: np.ndarray, node: int, depth: int, percent: int
) -> Found:
    """Candidate pairs of one node: rows a, rows b, whether they span, whether b leans on a.

    Spanning pairs are checked first; others only matter where those did not hold. A row
    leans on a pivot whose group it joins: pairs within the group are left out on the
    strength of that link.
    """
    least, likely, sure = (estimate(percent / 100, m) for m in (-MARGIN, -1, SURE))
    group = np.full(len(sizes), -1)
    stack = [(np.arange(len(sizes)), node, depth)]
    while stack:
        rows, node, depth = stack.pop()
        if len(rows) <= LEAF or depth >= DEPTH:
            for a, b in every_pair(rows):
                apart = (group[a] != group[b]) | (group[a] < 0)
                a, b = a[apart], b[apart]
                equal = alike(sizes, tokens, percent, a, b)
                order = np.argsort(-equal, kind="stable")
                order = order[equal[order] >= least]
                spans = np.zeros(len(order), bool)
                above = {}

                def top(x: int, above=above) -> int:
                    while above.get(x, x) != x:
                        x = above[x]
                    return x

                for k, (x, y) in enumerate(zip(a[order].tolist(), b[order].tolist())):
                    if equal[order[k]] < likely:
                        break
                    x, y = top(x), top(y)
                    if x != y:
                        above[max(x, y)] = min(x, y)
                        spans[k] = True
                yield a[order], b[order], spans, np.zeros(len(order), bool)
            continue
        for pivot in pivots_of(rows, tokens, node, depth):
            others, equal, leans = lean(group, rows, pivot, partial(alike, sizes, tokens, percent), sure)
            near = equal >= least
            yield np.full(near.sum(), pivot), others[near], equal[near] >= likely, leans[near]
        if (group[rows] == group[rows[0]]).all() and group[rows[0]] >= 0:
            continue
        stack.extend(children_of(rows, tokens, node, depth))


def cross_pairs(
    sizes: np.ndarray,
    tokens: np.ndarray,
    of: np.ndarray,
    node: int,
    depth: int,
    percent: int,
    best: int | None,
) -> Found:
    """Pairs that node_pairs leaves out although their components ``of`` differ: rows a, rows
    b, false, and whether more pairs of these components are still left out.

    Of two components that meet in a leaf, or of one that meets a pivot, the ``best`` pairs
    that are most alike.
    """
    least, sure = (estimate(percent / 100, m) for m in (-MARGIN, SURE))
    group = np.full(len(sizes), -1)

    def left_out(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return (group[a] == group[b]) & (group[a] >= 0) & (a != b)

    def chosen_of(a: np.ndarray, b: np.ndarray):
        apart = of[a] != of[b]
        a, b = a[apart], b[apart]
        equal = alike(sizes, tokens, percent, a, b)
        near = equal >= least
        a, b, equal = a[near], b[near], equal[near]
        if best is None or not len(a):
            return a, b, np.zeros(len(a), bool), np.zeros(len(a), bool)
        low, high = np.minimum(of[a], of[b]), np.maximum(of[a], of[b])
        order = np.lexsort((-equal, high, low))
        low, high = low[order], high[order]
        starts = np.flatnonzero(np.append(True, (low[1:] != low[:-1]) | (high[1:] != high[:-1])))
        counts = np.diff(np.append(starts, len(order)))
        kept = np.arange(len(order)) - np.repeat(starts, counts) < best
        more = np.repeat(counts > best, counts)
        return a[order[kept]], b[order[kept]], np.zeros(kept.sum(), bool), more[kept]

    stack = [(np.arange(len(sizes)), node, depth)]
    while stack:
        rows, node, depth = stack.pop()
        if (of[rows] == of[rows[0]]).all():
            continue
        if len(rows) <= LEAF or depth >= DEPTH:
            for a, b in every_pair(rows):
                out = left_out(a, b)
                yield chosen_of(a[out], b[out])
            continue
        for pivot in pivots_of(rows, tokens, node, depth):
            same = rows[left_out(np.full(len(rows), pivot), rows)]
            yield chosen_of(np.full(len(same), pivot), same)
            lean(group, rows, pivot, partial(alike, sizes, tokens, percent), sure)
        stack.extend(children_of(rows, tokens, node, depth))


def candidate_pairs(table: pa.Table, pairs_of: Callable[..., Found]) -> pa.Table:
    """All nodes of a task: columns a, b (smaller id first), first, a_second and b_second.

    ``first`` is the third of what ``pairs_of`` gives; the fourth is ``b_second`` or, where
    the ids are the other way round, ``a_second``.
    """
    table = table.sort_by([("node", "ascending"), ("id", "ascending")]).combine_chunks()
    nodes = table.column("node").to_numpy()
    ids = table.column("id").to_numpy()
    sizes = table.column("n").to_numpy()
    of = table.column("of").to_numpy()
    tokens = tokens_of(table.column("tokens"))
    cuts = np.flatnonzero(np.diff(nodes)) + 1
    none = np.empty(0, bool)
    found = [(np.empty(0, np.int64), np.empty(0, np.int64), none, none)]
    for start, stop in zip(np.append(0, cuts), np.append(cuts, len(nodes))):
        if stop - start > 1:
            own = slice(start, stop)
            depth = int(table.column("depth")[int(start)].as_py())
            node = int(nodes[start].view(np.uint64))
            for a, b, first, second in pairs_of(sizes[own], tokens[own], of[own], node, depth):
                found.append((ids[own][a], ids[own][b], first, second))
    a, b, first, second = (np.concatenate(c) for c in zip(*found))
    apart = a != b
    a, b, first, second = a[apart], b[apart], first[apart], second[apart]
    return pa.table(
        {
            "a": pa.array(np.minimum(a, b), pa.int64()),
            "b": pa.array(np.maximum(a, b), pa.int64()),
            "first": pa.array(first, pa.bool_()),
            "a_second": pa.array(second & (b < a), pa.bool_()),
            "b_second": pa.array(second & (a < b), pa.bool_()),
        }
    )


def _branch(rows: DataFrame, depth: int) -> DataFrame:
    """Rows of node, id, n, tokens at a depth, in their child nodes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                nodes = batch.column("node").to_numpy().view(np.uint64)
                children = child(nodes, depth, tokens_of(batch.column("tokens")))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(children.view(np.int64)),
                        pa.array(np.full(len(nodes), depth + 1), pa.int32()),
                        batch.column("id"),
                    ],
                    names=["node", "depth", "id"],
                )

    return rows.select("node", "id", "tokens").mapInArrow(run, "node long, depth int, id long")


def _members(features: DataFrame, trees: int) -> DataFrame:
    """Each document in its first node of every tree: node, depth, id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                tokens, ids = tokens_of(batch.column("tokens")), batch.column("id")
                for root in roots(trees):
                    nodes = child(np.full(len(ids), root, np.uint64), 0, tokens)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(nodes.view(np.int64)),
                            pa.array(np.ones(len(ids)), pa.int32()),
                            ids,
                        ],
                        names=["node", "depth", "id"],
                    )

    return features.select("id", "tokens").mapInArrow(run, "node long, depth int, id long")


def _sizes(members: DataFrame) -> DataFrame:
    return members.groupBy("node").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")


def nodes_of(features: DataFrame, work: Workspace, *, trees: int, task_docs: int) -> DataFrame:
    """The documents (node, depth, id) of all nodes that a task can hold, written once."""
    members = work.keep(_members(features, trees), "members-1")
    ready, depth = [], 1
    while True:
        sizes = work.keep(_sizes(members), f"sizes-{depth}")
        ready.append(members.join(sizes.filter(F.col("size") <= task_docs), "node").drop("size"))
        large = sizes.filter(F.col("size") > task_docs)
        if large.isEmpty():
            break
        crowd = members.join(large, "node")
        if depth == SPREAD_DEPTH:
            # So many equal tokens mean close texts: they are dealt to parts of half a task,
            # and every two parts meet in a node of their own, so that all pairs do.
            parts = F.ceil(F.col("size") / task_docs) * 2
            own, other = F.least("part", "with"), F.greatest("part", "with")
            dealt = crowd.withColumns(
                {
                    "part": F.pmod(F.xxhash64("id", "node"), parts),
                    "with": F.explode(F.sequence(F.lit(0).cast("long"), parts - 1)),
                }
            )
            ready.append(dealt.select(F.xxhash64("node", own, other).alias("node"), "depth", "id"))
            break
        crowd = crowd.join(features.select("id", "tokens"), "id")
        members = work.keep(_branch(crowd, depth), f"members-{depth + 1}")
        depth += 1
    whole = ready[0]
    for more in ready[1:]:
        whole = whole.unionByName(more)
    whole = work.keep(whole.select("node", "depth", "id"), "nodes")
    for level in range(1, depth + 1):
        work.forget(f"members-{level}", f"sizes-{level}")
    return whole


def compare_nodes(
    nodes: DataFrame, features: DataFrame, pairs_of: Callable[..., Found], buckets: int
) -> DataFrame:
    """Distinct candidate pairs (a, b, first, a_second, b_second) of the documents of nodes.

    ``features`` has id, n, tokens and the component ``of`` each document.
    """
    with_tokens = nodes.join(features.select("id", "n", "tokens", "of"), "id")
    # Whole nodes go to one task; a task takes many nodes at once.
    dealt = with_tokens.withColumn("bucket", F.pmod(F.xxhash64("node"), F.lit(buckets)))

    def compare(table: pa.Table) -> pa.Table:
        return candidate_pairs(table, pairs_of)

    flags = ("first", "a_second", "b_second")
    pairs = dealt.groupBy("bucket").applyInArrow(
        compare, "a long, b long, first boolean, a_second boolean, b_second boolean"
    )
    return pairs.groupBy("a", "b").agg(*(F.max(f).alias(f) for f in flags))


def in_components(pairs: DataFrame, forest: DataFrame) -> DataFrame:
    """Those pairs whose documents are in different components, with these as of_a and of_b."""
    ends = {
        x: forest.select(F.col("high").alias(x), F.col("low").alias(f"of_{x}")) for x in "ab"
    }
    found = pairs.join(ends["a"], "a", "left").join(ends["b"], "b", "left")
    found = found.withColumns({f"of_{x}": F.coalesce(f"of_{x}", x) for x in "ab"})
    return found.filter("of_a <> of_b")


def confirm(
    pairs: DataFrame, docs: DataFrame, percent: int, work: Workspace, name: str
) -> DataFrame:
    """Those pairs (a, b) whose full shingle sets are similar enough, written as ``name``.

    The texts of the documents that occur in pairs are all that is shuffled.
    """
    ids = pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct()
    ids, seen = work.keep_and_observe(ids, f"{name}-ids", n=F.count(F.lit(1)))
    wanted = F.broadcast(ids) if seen["n"] <= BROADCAST_IDS else ids
    texts = docs.join(wanted, "id", "left_semi")
    left = texts.select(F.col("id").alias("a"), F.col("body").alias("body_a"))
    right = texts.select(F.col("id").alias("b"), F.col("body").alias("body_b"))
    both = pairs.select("a", "b").join(left, "a").join(right, "b")

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 128):
                part = batch.slice(start, 128)
                a = shingle_sets(part.column("body_a").to_pylist())
                b = shingle_sets(part.column("body_b").to_pylist())
                keep = []
                for x, y in zip(a, b):
                    common = len(np.intersect1d(x, y, assume_unique=True))
                    keep.append(100 * common >= percent * (len(x) + len(y) - common))
                yield part.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    confirmed = both.select("a", "b", "body_a", "body_b").mapInArrow(check, "a long, b long")
    with batches_up_to(docs.sparkSession, SLICE_BYTES):
        return work.keep(confirmed, name)


def _joined(links: DataFrame, forest: DataFrame) -> DataFrame:
    """The forest of new links and of those that the last one stands for."""
    return star_forest(
        links.unionByName(forest.toDF("a", "b")), Workspace(links.sparkSession, "near")
    )


def near_duplicates(
    docs: DataFrame,
    *,
    percent: int = 85,
    trees: int | None = None,
    task_docs: int = TASK_DOCS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """The component of each document: doc_id, n_shingles, component_id, kept.

    Documents are linked if the distinct 5-word shingles that they share are at least
    ``percent`` of those that either has; a document of fewer words is one shingle.
    component_id is the smallest id that links lead to. A text without words, null or
    empty, has no shingles and no link. Rows with equal ids are one document as far
    as links go; rows without id are their own, with component_id null, and kept.
    Other columns are ignored.
    """
    spark = docs.sparkSession
    work = Workspace(spark, "near")
    trees = trees_for(percent) if trees is None else trees
    base = id_and_text(docs, id_col, text_col)
    with batches_up_to(spark, SLICE_BYTES):
        features = work.keep(base.mapInArrow(_features, FEATURES), "features")
    worded = features.filter("n > 0 AND id IS NOT NULL")
    prints = ["n", "print_a", "print_b"]
    classes = work.keep(worded.groupBy(*prints).agg(F.min("id").alias("class")), "classes")
    first = worded.join(classes, prints).filter("id = class")
    first = work.keep(first.dropDuplicates(["id", *prints]).select("id", "n", "tokens"), "first")
    nodes = nodes_of(first, work, trees=trees, task_docs=task_docs)
    buckets = max(1, first.count() * trees // TASK_DOCS)

    def all_pairs(*node) -> Found:
        return node_pairs(*node, percent)

    lone = first.withColumn("of", F.col("id"))
    pairs = work.keep(compare_nodes(nodes, lone, all_pairs, buckets), "pairs")
    forest = star_forest(confirm(pairs.filter("first"), base, percent, work, "links-0"), work)
    # What spanning pairs have not joined is checked pair by pair.
    rest = in_components(pairs.filter("NOT first"), forest).select("a", "b")
    rest = work.keep(rest, "rest")
    if not rest.isEmpty():
        forest = _joined(confirm(rest, base, percent, work, "links-1"), forest)
    # Pairs were left out on the strength of links to pivots. Where such a link has not
    # held and nothing else joins the two, their nodes are gone through again for those.
    tested = pairs.select("a", "b")
    failed = in_components(pairs.filter("a_second OR b_second"), forest)
    for number, best in enumerate(ROUNDS, 2):
        loose = failed.select(F.explode(F.array("a", "b")).alias("id")).distinct()
        loose = work.keep(loose, f"loose-{number}")
        if loose.isEmpty():
            break
        ends = forest.select(F.col("high").alias("id"), F.col("low").alias("of"))
        known = first.join(ends, "id", "left").withColumn("of", F.coalesce("of", "id"))
        open_nodes = nodes.join(nodes.join(loose, "id").select("node").distinct(), "node")

        def across(*node, best=best) -> Found:
            return cross_pairs(*node, percent, best)

        found = work.keep(
            compare_nodes(open_nodes, known, across, buckets), f"pairs-{number}"
        )
        new = work.keep(
            found.select("a", "b").join(tested, ["a", "b"], "left_anti"), f"new-{number}"
        )
        if not new.isEmpty():
            tested = tested.unionByName(new)
            forest = _joined(confirm(new, base, percent, work, f"links-{number}"), forest)
        failed = in_components(found.filter("a_second OR b_second"), forest)
    own = features.select("id", *prints)
    of_class = classes.join(forest, F.col("class") == F.col("high"), "left").select(
        *prints, F.coalesce("low", "class").alias("component")
    )
    found = own.join(of_class, prints, "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce("component", "id"))
    return found.select(
        F.col("id").alias("doc_id"),
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"),
    )
