"""Repeated word windows and byte strings, against plain definitions."""

import hashlib
from collections import Counter

import numpy as np
import pytest

from recordlens.llm import candidates, substring_dedup, suffix_array
from recordlens.llm.substring_dedup import remove_repeats
from recordlens.llm.suffix_array import difference_cover, remove_repeated_bytes
from tests.llm.texts import corpus, frame, words

LAST = 1 << 62


def order(row):
    return (LAST if row[0] is None else row[0], (row[1] or "").encode())


def without_later_windows(rows, width):
    seen, out = set(), []
    for doc_id, text in sorted(rows, key=order):
        own = words(text)
        gone = [False] * len(own)
        for i in range(len(own) - width + 1):
            window = tuple(own[i : i + width])
            if window in seen:
                gone[i : i + width] = [True] * width
            seen.add(window)
        kept = " ".join(w for w, g in zip(own, gone) if not g)
        out.append((doc_id, len(own), sum(gone), kept))
    return out


def without_repeated_bytes(rows, width):
    bodies = [(i, (t or "").encode()) for i, t in rows]
    found = Counter(b[i : i + width] for _, b in bodies for i in range(len(b) - width + 1))
    out = []
    for doc_id, body in bodies:
        gone = bytearray(len(body))
        for i in range(len(body) - width + 1):
            if found[body[i : i + width]] > 1:
                gone[i : i + width] = b"\1" * width
        spans, at = [], 0
        for part in bytes(gone).split(b"\0"):
            if part:
                spans.append((at, len(part)))
            at += len(part) + 1
        kept = bytes(b for b, g in zip(body, gone) if not g)
        out.append((doc_id, len(body), sum(gone), spans, kept))
    return out


def sortable(rows):
    return sorted(rows, key=repr)


@pytest.mark.parametrize("options", [{}, {"chunk_bytes": 900}, {"chunk_bytes": 900, "long_prefix_chunks": 1}])
@pytest.mark.parametrize("width", [20, 5])
def test_words(spark, options, width):
    rows = corpus()
    found = remove_repeats(frame(spark, rows), width=width, **options).collect()
    got = [(r.doc_id, r.n_words, r.n_removed, r.text) for r in found]
    assert sortable(got) == sortable(without_later_windows(rows, width))


@pytest.mark.parametrize("options", [{}, {"chunk_bytes": 900}, {"chunk_bytes": 900, "long_prefix_chunks": 1}])
@pytest.mark.parametrize("width", [200, 30])
def test_bytes(spark, options, width):
    rows = corpus()
    found = remove_repeated_bytes(frame(spark, rows), width=width, **options).collect()
    got = [(r.doc_id, r.n_bytes, r.n_removed, [tuple(s) for s in r.spans], bytes(r.kept)) for r in found]
    assert sortable(got) == sortable(without_repeated_bytes(rows, width))


def test_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(substring_dedup, "GROUP_SLICES", 2)
    monkeypatch.setattr(suffix_array, "BLOCK_SLICES", 2)
    rows = corpus(40, seed=3)
    found = remove_repeats(frame(spark, rows), chunk_bytes=2000).collect()
    assert sortable((r.doc_id, r.n_words, r.n_removed, r.text) for r in found) == sortable(without_later_windows(rows, 20))
    found = remove_repeated_bytes(frame(spark, rows), width=60, chunk_bytes=2000).collect()
    got = [(r.doc_id, r.n_bytes, r.n_removed, [tuple(s) for s in r.spans], bytes(r.kept)) for r in found]
    assert sortable(got) == sortable(without_repeated_bytes(rows, 60))


def test_empty_tables_and_carried_columns(spark):
    none = frame(spark, corpus(9)).limit(0)
    assert remove_repeats(none).count() == 0
    assert remove_repeated_bytes(none).count() == 0
    carried = remove_repeats(frame(spark, corpus(9)), carry=("id", "text", "chunk"))
    assert carried.columns == ["doc_id", "n_words", "n_removed", "text", "id", "text_in", "chunk"]
    assert {(r.id, r.chunk) for r in carried.collect()} == {(7, 1.5)}


def test_nothing_but_blanks(spark):
    rows = [(1, None), (2, ""), (2, ""), (None, " ")]
    assert {(r.n_words, r.n_removed, r.text) for r in remove_repeats(frame(spark, rows)).collect()} == {(0, 0, "")}
    assert {r.n_removed for r in remove_repeated_bytes(frame(spark, rows)).collect()} == {0}


def test_one_text_over_and_over(spark):
    """A text that repeats within itself, and thousands of copies of one text."""
    rows = [(1, "la " * 500)] + [(10 + i, "a b c d e f g h i j k l m n o p q r s t u v") for i in range(2000)]
    found = {r.doc_id: r for r in remove_repeats(frame(spark, rows), chunk_bytes=5000).collect()}
    assert (found[1].n_words, found[1].n_removed) == (500, 499)
    assert found[10].n_removed == 0
    assert {found[10 + i].n_removed for i in range(1, 2000)} == {22}


def test_cover_has_every_difference():
    cover = set(difference_cover(64).tolist())
    assert {(a - b) % 64 for a in cover for b in cover} == set(range(64))
    with pytest.raises(ValueError, match="square"):
        difference_cover(60)


def test_suffix_order_and_neighbours():
    rng = np.random.default_rng(2)
    text = bytes(rng.choice([97, 98], 3000).astype(np.uint8))
    data = np.frombuffer(text + bytes(200 + 128), np.uint8)
    starts = np.arange(0, 2900, 64)
    found = suffix_array.repeated_starts(data, starts, np.zeros(len(starts), np.int64), 8)
    counts = Counter(text[s : s + 8] for s in starts)
    assert found.tolist() == [counts[text[s : s + 8]] > 1 for s in starts]


def test_subtree():
    ids = np.array([1, 2, 1, 2, 1, 3, 1, 2, 1, 3])
    order_, deep = substring_dedup.subtree(ids, np.arange(7), 3)
    suffixes = [tuple(ids[s : s + 3]) for s in order_]
    assert suffixes == sorted(suffixes)
    assert deep.tolist() == [False] + [a == b for a, b in zip(suffixes, suffixes[1:])]


def test_digests(spark):
    from recordlens.llm import queries

    row = queries.op1_substring_dedup(spark, "/root/testdata/sf0.001").filter("n_removed = 0").first()
    text = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").filter(f"doc_id = {row.doc_id}").first().text
    assert row.kept_sha256 == hashlib.sha256(" ".join(words(text)).encode()).hexdigest()
    assert candidates.LONG_PREFIX_CHUNKS > 1


def shared_line(n):
    """Documents with one line in common and other words around it, and two copies."""
    line = "all rights to this page are kept by its first owner and"
    rows = [(i, " ".join([f"a{i}b{j}" for j in range(15)] + [line] + [f"c{i}d{j}" for j in range(15)])) for i in range(n)]
    return rows + [(n, rows[3][1])]


def test_a_shared_line_makes_no_large_group(spark, monkeypatch):
    monkeypatch.setattr(candidates, "LONG_PREFIX_SLICES", 20)
    rows = shared_line(200)
    source = substring_dedup.corpus(frame(spark, rows), chunk_bytes=4000)
    spec = candidates.Spec(20, 8, substring_dedup.word_units, 6.0)
    slices = candidates.candidate_slices(source, spec).groupBy("prefix").count().collect()
    assert max(r["count"] for r in slices) <= 20


def test_many_slices_of_a_prefix(spark, monkeypatch):
    monkeypatch.setattr(candidates, "LONG_PREFIX_SLICES", 3)
    rows = shared_line(60) + [(1000 + i, t) for i, t in corpus() if i is not None]
    found = remove_repeats(frame(spark, rows), chunk_bytes=9000).collect()
    got = [(r.doc_id, r.n_words, r.n_removed, r.text) for r in found]
    assert sortable(got) == sortable(without_later_windows(rows, 20))
    found = remove_repeated_bytes(frame(spark, rows), width=60, chunk_bytes=9000).collect()
    got = [(r.doc_id, r.n_bytes, r.n_removed, [tuple(s) for s in r.spans], bytes(r.kept)) for r in found]
    assert sortable(got) == sortable(without_repeated_bytes(rows, 60))
