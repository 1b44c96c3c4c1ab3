"""Ranked lexical search by the Best Position Algorithm (Akbarinia et al., VLDB 2007).

Documents are dealt into splits, and a split is read in blocks of documents. In a block
each term of the items has an impact list: its documents by falling contribution. An item
reads its lists from the top, side by side. Of a document that it meets it looks up the
contribution and the position in all its lists, and marks those positions as seen. A list's
best position is the last one up to which all have been seen, by reading or by look-up; it
lies as deep as the last-read position or deeper, so the sum of the contributions there is
the tighter bound on what unseen documents can reach. Reading ends once the bound is strictly
below the k-th score, which the blocks of a split hand on to one another.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from recordlens.functions.names import named
from recordlens.llm.batches import text_bytes
from recordlens.llm.cells import in_cells, items_then_rows
from recordlens.storage import Workspace

# Contributions that a block of documents may have, documents in it, and how far an item
# reads its lists before it looks at the bound again.
BLOCK_ENTRIES = 1 << 22
BLOCK_DOCS = 8192
STRIDE = 32
# Terms of the items of one block of items, and text that one split is meant to hold.
BLOCK_TERMS = 1 << 14
SPLIT_BYTES = 128 << 20
# Bytes of a text that are cut into terms at a time, and terms that a task counts before it
# hands over what it has.
PIECE_BYTES = 1 << 20
COUNTED_TERMS = 1 << 18

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Bytes of no term become spaces: ASCII but for letters and digits.
TO_TERMS = bytes(
    b if b >= 0x80 or chr(b) in "0123456789" + LOWER else b + 32 if chr(b) in UPPER else 32
    for b in range(256)
)
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def terms_of(body: bytes) -> tuple[Counter, int]:
    """How often each term occurs in a text, and how many terms it has."""
    body = body.translate(TO_TERMS)
    if len(body) <= PIECE_BYTES:
        found = body.split()
        return Counter(found), len(found)
    counts, n, start = Counter(), 0, 0
    while start < len(body):
        end = body.find(b" ", start + PIECE_BYTES)
        found = body[start : end if end >= 0 else len(body)].split()
        counts.update(found)
        n += len(found)
        start = end if end >= 0 else len(body)
    return counts, n


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents per term; under the empty term those with any, and all their terms."""

    def made(df: Counter, n_terms: int) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [
                pa.array(list(df), pa.binary()),
                pa.array(list(df.values()), pa.int64()),
                pa.array([0 if t else n_terms for t in df], pa.int64()),
            ],
            names=["term", "df", "n_terms"],
        )

    df, n_terms = Counter(), 0
    for batch in batches:
        for body in batch.column("body"):
            counts, n = terms_of(body.as_py())
            if n:
                df.update(counts.keys())
                df[b""] += 1
                n_terms += n
            if len(df) > COUNTED_TERMS:
                yield made(df, n_terms)
                df, n_terms = Counter(), 0
    yield made(df, n_terms)


class Block:
    """The impact lists of a block of documents."""

    def __init__(
        self, ids: list, postings: tuple[list, list, list], lengths: np.ndarray, weights: np.ndarray
    ) -> None:
        terms, docs, tf = (np.array(p, np.int64) for p in postings)
        self.ids = ids
        impact = weights[terms] * (1_000_000_000 * tf // (1_000 * tf + 8 * lengths[docs]))
        order = np.lexsort((docs, -impact, terms))
        terms, docs, impact = terms[order], docs[order], impact[order]
        present, starts, sizes = np.unique(terms, return_index=True, return_counts=True)
        self.row_of = {int(t): i for i, t in enumerate(present)}
        self.lists = [(docs[s : s + n], impact[s : s + n]) for s, n in zip(starts, sizes)]
        # For direct access: contribution and position by term and document.
        place = np.arange(len(terms)) - np.repeat(starts, sizes)
        row = np.repeat(np.arange(len(present)), sizes)
        self.impact = np.zeros((len(present), len(ids)), np.int64)
        self.place = np.full((len(present), len(ids)), -1, np.int32)
        self.impact[row, docs] = impact
        self.place[row, docs] = place

    def search(self, terms: np.ndarray, best: list[tuple], k: int) -> list[tuple]:
        """``best``, (-score, id is null, id), with the documents of this block that belong there."""
        rows = np.array([self.row_of[t] for t in terms.tolist() if t in self.row_of], np.int64)
        lists = [self.lists[r] for r in rows]
        positions = [np.zeros(len(docs) + 1, bool) for docs, _ in lists]
        best_position = [0] * len(lists)
        bound = sum(int(impacts[0]) for _, impacts in lists)
        met = np.zeros(len(self.ids), bool)
        depth, longest = 0, max((len(docs) for docs, _ in lists), default=0)
        # Strictly: an unseen document that may tie with the k-th may have the smaller id.
        while depth < longest and bound > 0 and not (len(best) == k and bound < -best[-1][0]):
            read = np.concatenate([docs[depth : depth + STRIDE] for docs, _ in lists])
            depth += STRIDE
            new = np.unique(read[~met[read]])
            met[new] = True
            at = np.ix_(rows, new)
            scores = self.impact[at].sum(axis=0)
            least = -best[-1][0] if len(best) == k else 1
            good = np.flatnonzero(scores >= max(least, 1))
            if len(good) > k:
                # Only ties with the k-th of them can matter besides the better ones.
                good = good[scores[good] >= np.partition(scores[good], -k)[-k]]
            entries = [
                (-s, self.ids[d] is None, self.ids[d] or 0)
                for s, d in zip(scores[good].tolist(), new[good].tolist())
            ]
            best = sorted(best + entries)[:k]
            bound = 0
            for i, (seen, place) in enumerate(zip(positions, self.place[at])):
                seen[place[place >= 0]] = True
                # The last entry is never seen and stops the search for a gap.
                p = best_position[i] = best_position[i] + int(np.argmin(seen[best_position[i] :]))
                impacts = lists[i][1]
                if p < len(impacts):
                    bound += int(impacts[p - 1])
        return best


def _ranked(
    batches: Iterator[pa.RecordBatch], k: int, n_docs: int, n_terms: int
) -> Iterator[pa.RecordBatch]:
    """The k best documents of a cell's rows for each of its items."""
    items, rows = items_then_rows(batches)
    if items is None:
        return
    number: dict[bytes, int] = {}
    weights: list[int] = []
    wanted = []
    for entries in items.column("terms").to_pylist():
        own = []
        for entry in entries:
            at = number.setdefault(entry["term"], len(number))
            if at == len(weights):
                weights.append(entry["w"])
            own.append(at)
        wanted.append(np.array(own, np.int64))
    weigh = np.array(weights, np.int64)
    best: list[list[tuple]] = [[] for _ in wanted]
    most = min(BLOCK_DOCS, max(1, BLOCK_ENTRIES // len(number)))
    ids: list = []
    lengths: list[int] = []
    postings: tuple[list, list, list] = ([], [], [])

    def finish() -> None:
        if postings[0]:
            block = Block(ids, postings, np.array(lengths, np.int64), weigh)
            for i, terms in enumerate(wanted):
                best[i] = block.search(terms, best[i], k)

    for batch in rows:
        for doc_id, body in zip(batch.column("id").to_pylist(), batch.column("body")):
            counts, n = terms_of(body.as_py())
            held = counts.keys() & number.keys()
            if not held:
                continue
            for term in held:
                postings[0].append(number[term])
                postings[1].append(len(ids))
                postings[2].append(counts[term])
            ids.append(doc_id)
            lengths.append(10 + 90 * n * n_docs // n_terms)
            if len(ids) == most:
                finish()
                ids, lengths, postings = [], [], ([], [], [])
    finish()
    keys = items.column("item_id").to_pylist()
    found = [(key, -s, None if null else d) for key, own in zip(keys, best) for s, null, d in own]
    if found:
        columns = [pa.array(c, pa.int64()) for c in zip(*found)]
        yield pa.RecordBatch.from_arrays(columns, names=["item_id", "score", "doc_id"])


def search(
    docs: DataFrame,
    items: DataFrame,
    *,
    k: int = 10,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """The ``k`` best documents for each item, over all documents and their whole texts.

    Terms are runs of letters, digits and characters beyond ASCII, only A-Z lower-cased. A
    term weighs floor(1000 ln((2 N + 2) / (2 df + 1))), N the documents with a term, df those
    with this one. With tf its occurrences, n the document's terms, L all terms and
    m = 10 + 90 n N div L, it adds weight * (10^9 tf div (1000 tf + 8 m)) to the score.

    Equal scores are in the order of the ids, null last. A null or empty text has no terms,
    and what has none is in no ranking. Rows of documents rank separately, those with the
    same id too; rows of items with the same id are one item, with the terms of all, and so
    are those without id. Only scores above 0 are ranked, so an item has no rows if no
    document has a term of it that weighs anything. Other columns are ignored, whatever their
    names; empty tables give no rows.

    Returns:
        item_id, rank (from 1), doc_id, score.
    """
    spark = docs.sparkSession
    work = Workspace(spark, "search")
    texts = docs.select(named(id_col).cast("long").alias("id"), text_bytes(text_col).alias("body"))
    lowered = F.translate(F.coalesce(named(item_text_col).cast("string"), F.lit("")), UPPER, LOWER)
    wanted = work.keep(
        items.select(
            named(item_col).cast("long").alias("item_id"),
            F.explode(F.regexp_extract_all(lowered, F.lit(TERM), F.lit(0))).alias("term"),
        )
        .select("item_id", F.col("term").cast("binary").alias("term"))
        .distinct(),
        "wanted",
    )
    # One pass over the texts: the wanted terms' documents, and the totals by the empty term.
    asked = wanted.select("term").union(wanted.select(F.lit(b"").alias("term")).limit(1)).distinct()
    counted = work.keep(
        texts.select("body")
        .mapInArrow(_counted, "term binary, df long, n_terms long")
        .join(asked, "term", "left_semi")
        .groupBy("term")
        .agg(F.sum("df").alias("df"), F.sum("n_terms").alias("n_terms")),
        "counted",
    )
    totals = counted.filter(F.octet_length("term") == 0).first()
    n_docs, n_terms = (totals["df"], totals["n_terms"]) if totals else (0, 0)
    weight = F.floor(
        1000 * F.log(F.lit(2.0 * n_docs + 2) / (2 * F.col("df") + 1).cast("double"))
    )
    weighed = (
        wanted.join(counted, "term")
        .withColumn("w", weight)
        .filter("w > 0")
        .groupBy("item_id")
        .agg(F.sort_array(F.collect_list(F.struct("term", "w"))).alias("terms"))
    )
    weighed, seen = work.keep_and_observe(
        weighed, "items", n=F.coalesce(F.sum(F.size("terms")), F.lit(0))
    )
    n_blocks = max(1, -(-seen["n"] // BLOCK_TERMS))
    n_bytes = texts.agg(F.coalesce(F.sum(F.octet_length("body")), F.lit(0))).first()[0]
    n_splits = max(
        int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n_bytes // SPLIT_BYTES)
    )
    block = F.pmod(F.xxhash64("item_id"), F.lit(n_blocks)).cast("int").alias("block")
    cells = in_cells(
        weighed.select("*", block),
        texts,
        n_blocks=n_blocks,
        n_splits=n_splits,
        key=F.coalesce(F.col("id"), F.xxhash64("body")),
    )

    def ranked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _ranked(batches, k, n_docs, n_terms)

    found = cells.mapInArrow(ranked, "item_id long, score long, doc_id long")
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return (
        found.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= k)
        .select("item_id", "rank", "doc_id", "score")
    )
