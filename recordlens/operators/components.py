"""Connected components of a match graph of any size.

Alternating large-star and small-star steps (Kiveris et al., Connected Components
in MapReduce and Beyond, SoCC 2014) on a table of edges (low, high). Each step is
an aggregation with map-side partial results and a join with its outcome. After
every round the edges are written and the next round starts from the written table,
so the lineage stays one round long. There is one path, whatever the size.

The side with the outcome is dealt by its aggregation, which keeps Spark from splitting
a hub's edges at run time. So the job that writes the edges also sketches which nodes are
heavy: their edges are dealt to salts, in proportion to their number, and the node's
minimum is copied to each salt.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import AtomicType, BooleanType

from recordlens.functions.names import named
from recordlens.operators.guards import require_columns
from recordlens.storage import Workspace

# A node with more than a HEAVY_PARTS-th of all edges at one end is heavy; by counting there
# are fewer than that. The sketch tracks enough of them to miss none. A heavy node's edges
# are cut into pieces of a SALTS-th of all edges.
HEAVY_PARTS = 128
TRACKED = 1024
SALTS = 1024
# Nodes with fewer edges fit any task.
LEAST_HEAVY = 4096

ENDS = ("low", "high")


@dataclass(frozen=True)
class Round:
    """Written edges with what their job saw: a state, the same for the same set of edges,
    and by end the hashes of its heavy nodes with their numbers of salts."""

    edges: DataFrame
    state: tuple[int, int]
    heavy: dict[str, dict[int, int]]


def _ends(edges: DataFrame) -> DataFrame:
    """Each edge seen from both ends: node and other."""
    return edges.selectExpr(
        "inline(array(struct(low AS node, high AS other), struct(high AS node, low AS other)))"
    )


def with_least(
    edges: DataFrame, end: str, least: DataFrame, heavy: dict[int, int]
) -> DataFrame:
    """Each edge with the row of ``least`` (node, ...) for its node at ``end``."""
    if not heavy:
        return edges.join(least, F.col(end) == F.col("node"))
    other = next(e for e in ENDS if e != end)
    number = F.map_from_arrays(
        F.lit(list(heavy)).cast("array<bigint>"), F.lit(list(heavy.values())).cast("array<int>")
    )

    def salts(node: str) -> Column:
        # A light node with a heavy one's hash is dealt out needlessly, no more.
        return F.coalesce(F.try_element_at(number, F.xxhash64(node)), F.lit(1))

    dealt = edges.withColumn("salt", F.pmod(F.xxhash64(other), salts(end)).cast("int"))
    copies = least.withColumn("its_salt", F.explode(F.sequence(F.lit(0), salts("node") - 1)))
    same = (F.col(end) == F.col("node")) & (F.col("salt") == F.col("its_salt"))
    return dealt.join(copies.hint("merge"), same).drop("salt", "its_salt")


def _large_star(edges: DataFrame, heavy: dict[int, int]) -> DataFrame:
    """Link the higher end of each edge to the smallest neighbour of its lower end."""
    nearest = _ends(edges).groupBy("node").agg(F.min("other").alias("nearest"))
    return with_least(edges, "low", nearest, heavy).selectExpr(
        "least(low, nearest) AS low", "high"
    )


def _small_star(edges: DataFrame, heavy: dict[int, int]) -> DataFrame:
    """Link each node and its lower neighbours to the smallest of them."""
    smallest = edges.groupBy(F.col("high").alias("node")).agg(F.min("low").alias("root"))
    return (
        with_least(edges, "high", smallest, heavy)
        .selectExpr(
            "inline(array(struct(root AS low, high AS high), struct(root AS low, low AS high)))"
        )
        .filter("low < high")
        .distinct()
    )


def _written(edges: DataFrame, work: Workspace, name: str) -> Round:
    mixed = F.sum(F.xxhash64(*ENDS).cast("decimal(38,0)"))
    frequent = {
        end: F.expr(f"approx_top_k(xxhash64({end}), {HEAVY_PARTS}, {TRACKED})") for end in ENDS
    }
    kept, seen = work.keep_and_observe(
        edges,
        name,
        n=F.count(F.lit(1)),
        mixed=F.coalesce(mixed, F.lit(0).cast("decimal(38,0)")),
        **frequent,
    )
    n = seen["n"]
    limit = max(n // HEAVY_PARTS, LEAST_HEAVY)
    heavy = {
        end: {
            row["item"]: -(-row["count"] * SALTS // n)
            for row in seen[end] or []
            if row["count"] > limit
        }
        for end in ENDS
    }
    return Round(kept, (n, int(seen["mixed"])), heavy)


def star_forest(edges: DataFrame, work: Workspace) -> DataFrame:
    """Edges (low, high) that join every node to the smallest node of its component.

    One job a round: the count, the hash and the heavy nodes of a round's edges come from
    the job that writes them.

    Args:
        edges: Two columns of ids, one undirected edge per row; nulls, loops and
            repetitions do no harm.
        work: Where the rounds are written.
    """
    first, second = (named(c) for c in edges.columns)
    ordered = edges.filter(first != second).select(
        F.least(first, second).alias("low"), F.greatest(first, second).alias("high")
    )
    current = _written(ordered.distinct(), work, "edges-0")
    done = 0
    while current.state[0]:
        # The large star leaves the higher ends as they are, and so how often each occurs.
        large = _large_star(current.edges, current.heavy["low"])
        following = _written(
            _small_star(large, current.heavy["high"]), work, f"edges-{done + 1}"
        )
        work.forget(f"edges-{done}")
        done += 1
        # A round that changes nothing has only stars around smallest nodes left.
        settled = following.state == current.state
        current = following
        if settled:
            break
    return current.edges


def connected_components(
    records: DataFrame, matches: DataFrame, *, id_col: str = "record_id"
) -> DataFrame:
    """One row per record with its ``entity_id``, the smallest id of its component.

    Args:
        records: All records; those without a match are entities of their own.
        matches: Matched pairs ``<id_col>_a``, ``<id_col>_b``. Ids that are not among
            the records still connect what they touch.
        id_col: Unique record id: a number, text, date, time or binary value.
    """
    require_columns(records, [id_col])
    require_columns(matches, [f"{id_col}_a", f"{id_col}_b"])
    kind = records.schema[id_col].dataType
    if not isinstance(kind, AtomicType) or isinstance(kind, BooleanType):
        raise ValueError(f"ids must be plain values, not {kind.simpleString()}")
    work = Workspace(records.sparkSession, "components")
    forest = star_forest(matches.select(named(f"{id_col}_a"), named(f"{id_col}_b")), work)
    own = records.select(named(id_col).alias("id"))
    return own.join(forest, F.col("id") == F.col("high"), "left").select(
        F.col("id").alias(id_col), F.coalesce("low", "id").alias("entity_id")
    )
