"""Quality rules, benchmark passages and licences, against plain definitions."""

import math
import random
import re
from collections import Counter

import pytest

from recordlens.llm import decontamination, quality_rules
from recordlens.llm.decontamination import find_passages, without_passages
from recordlens.llm import licenses
from recordlens.llm.licenses import TEMPLATES, license_scan
from recordlens.llm.quality_rules import cleaned_documents, kept_documents, quality_report
from tests.llm.texts import corpus, frame, lower, prose, words

CLEAN = "\n".join(prose(random.Random(i), 8, 10**6) + "." for i in range(12))
NAVIGATION = "Home | Products | About us | Help | Contact\n" * 6


def measured(text):
    text = text or ""
    own = words(text)
    triples = Counter(zip(own, own[1:], own[2:]))
    covered = {j for i in range(len(own) - 2) if triples[tuple(own[i : i + 3])] > 1 for j in range(i, i + 3)}
    lines = [line for line in text.split("\n") if words(line)]
    n = len(own)
    return (
        n,
        sum(map(len, own)),
        len(re.findall(r"[#*$%&|<>]", text)),
        len(lines) - len(set(lines)),
        len(covered),
        n < 50 or 100 * len(covered) > 50 * n,
    )


@pytest.mark.parametrize("bits", [quality_rules.POSITION_BITS, 2, 61])
def test_measures(spark, bits, monkeypatch):
    # With 2 bits every text takes the path for long ones; with 61 the hash bits that
    # are left collide all the time.
    monkeypatch.setattr(quality_rules, "POSITION_BITS", bits)
    rows = corpus() + [(500, NAVIGATION), (501, "a b c a b c d"), (502, "x " * 300), (503, "é| <ß> \x0b#\n#\n#")]
    found = quality_report(frame(spark, rows)).collect()
    got = [(r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in found]
    assert sorted(got, key=repr) == sorted(((i, *measured(t)) for i, t in rows), key=repr)
    assert quality_report(frame(spark, rows).limit(0)).count() == 0


def test_verdicts_and_cleaning(spark):
    shout = " ".join(f"BUY{i}!! NOW!!" for i in range(40))
    rows = [
        (1, CLEAN),
        (2, CLEAN + "\nAll rights reserved."),
        (3, CLEAN + "\n" + NAVIGATION * 3),
        (4, shout),
        (5, "too short"),
        (6, None),
        (1, CLEAN),
    ]
    df = frame(spark, rows)
    kept = {(r.doc_id, r.kept) for r in quality_report(df).collect()}
    assert kept == {(1, True), (2, True), (3, False), (4, False), (5, False), (6, False)}
    assert sorted(r.doc_id for r in kept_documents(df).collect()) == [1, 1, 2]
    assert kept_documents(df).columns == df.columns
    assert {r.doc_id: r.text for r in cleaned_documents(df).collect()} == {1: CLEAN, 2: CLEAN}


def items(rng):
    return [(i, prose(rng, rng.randrange(15, 60), 50_000)) for i in range(25)] + [(90, None), (91, "")]


@pytest.fixture(scope="module")
def leaks(spark):
    rng = random.Random(8)
    benchmark = items(rng)
    rows, truth = [], set()
    for d in range(120):
        text = prose(rng, rng.randrange(120), 50_000)
        if d % 4 == 0:
            item, passage = benchmark[d % 25]
            some = passage.split()
            if d % 8 == 0 and len(some) >= 30:
                some[len(some) // 2] = "changed"
            text = f"{text} {' '.join(some).upper()}\n{prose(rng, 9, 50_000)}"
            truth.add((d, item))
        rows.append((d, text))
    rows += [(500, None), (501, ""), (None, benchmark[3][1])]
    truth.add((None, 3))
    # Half a passage is no leak.
    rows.append((502, " ".join(benchmark[0][1].split()[:9])))
    wide = spark.createDataFrame([(*b, 1, "x") for b in benchmark], "item_id long, text string, id long, body string")
    return frame(spark, rows), wide, rows, truth


@pytest.mark.parametrize("per_scan", [2000, 7])
def test_passages(leaks, per_scan, monkeypatch):
    docs, benchmark, rows, truth = leaks
    monkeypatch.setattr(decontamination, "ITEMS_PER_SCAN", per_scan)
    found = find_passages(docs, benchmark).collect()
    assert {(r.doc_id, r.item_id) for r in found} == truth
    assert len(found) == len(truth)
    texts = dict(rows)
    passages = {r.item_id: r.text for r in benchmark.collect()}
    for r in found:
        if r.similarity == 1.0 and r.doc_id is not None:
            here = words(lower(texts[r.doc_id]))[r.begin : r.begin + r.n_words]
            assert here == words(lower(passages[r.item_id]))


def test_clean_documents_stay(leaks):
    docs, benchmark, rows, truth = leaks
    kept = without_passages(docs, benchmark)
    assert kept.columns == docs.columns
    gone = {d for d, _ in truth}
    assert sorted((r.doc_id, r.text) for r in kept.collect()) == sorted(
        [(d, t) for d, t in rows if d not in gone], key=lambda x: x[0]
    )
    assert without_passages(docs, benchmark.limit(0)).count() == len(rows)
    assert find_passages(docs.limit(0), benchmark).count() == 0
    assert find_passages(docs, benchmark.limit(0)).count() == 0


def test_very_long_items(spark):
    """Items of more words than are fingerprinted at a time, also past 16-bit counts."""
    rng = random.Random(12)
    long = [(1, prose(rng, 45_000, 10**6)), (2, prose(rng, 90_000, 10**6))]
    docs = [(10, prose(rng, 50, 10**6)), (11, "before " + long[0][1] + " behind"), (12, long[1][1])]
    cut = long[1][1].split()
    docs += [(13, " ".join(cut[: len(cut) // 2])), (14, long[0][1].replace(" ", " \n", 3))]
    found = find_passages(frame(spark, docs), spark.createDataFrame(long, "item_id long, text string"))
    assert {(r.doc_id, r.item_id) for r in found.collect()} == {(11, 1), (12, 2), (14, 1)}


def test_inserted_words_lose_no_passage(spark):
    """Wherever words are put in, what brute force finds in the whole text is found."""
    rng = random.Random(13)
    some = [(i, prose(rng, rng.randrange(30, 60), 50_000)) for i in range(20)]
    rows = []
    for d in range(200):
        passage = rng.choice(some)[1].split()
        passage.insert(rng.randrange(1, len(passage)), "inserted")
        if d % 3 == 0:
            del passage[rng.randrange(len(passage))]
        rows.append((d, f"{prose(rng, 20, 50_000)} {' '.join(passage)} {prose(rng, 20, 50_000)}"))

    def shingles(text):
        own = words(lower(text))
        return {tuple(own[i : i + 5]) for i in range(len(own) - 4)}

    whole = {(d, i) for d, t in rows for i, p in some if len(shingles(p) & shingles(t)) >= 0.8 * len(shingles(p))}
    found = find_passages(frame(spark, rows), spark.createDataFrame(some, "item_id long, text string"))
    got = {(r.doc_id, r.item_id) for r in found.collect()}
    assert got <= whole and len(got) >= 0.97 * len(whole) and len(whole) > 150


def test_no_fingerprint_within_the_radius_is_missed():
    """The multi-index against all distances."""
    import numpy as np

    rng = random.Random(2)
    index = decontamination.build_index(*zip(*[(i, t.encode()) for i, t in items(rng)[:25]]))
    generator = np.random.default_rng(1)
    for length, (prints, _, _) in index.entries.items():
        flips = generator.integers(0, 9, 400)
        some = generator.choice(prints, 400)
        for _ in range(8):
            some ^= np.where(flips > 0, np.uint64(1) << generator.integers(0, 64, 400).astype(np.uint64), np.uint64(0))
            flips -= 1
        window, entry, _ = decontamination.candidates(index, length, some, np.ones(400, bool))
        every = np.bitwise_count(some[:, None] ^ prints[None, :]) <= decontamination.RADIUS
        assert set(zip(window.tolist(), entry.tolist())) == set(zip(*(x.tolist() for x in np.nonzero(every))))


def test_licenses(spark):
    from pyspark.sql import functions as F

    notice = dict(TEMPLATES)
    body = prose(random.Random(1), 200)
    files = [
        ("a/LICENSE", notice["Apache-2.0"]),
        ("a/b/code", body),
        ("a/b/own", body + "\n# " + notice["GPL-3.0"] + "\n" + body),
        ("a/b/c/LICENSE", "LICENSED under the MIT license"),
        ("a/b/c/d/code", "licensed photographers agree on much"),
        ("e/code", body),
        ("e/long", (body + "\n") * 3 + notice["MIT"]),
        ("top", None),
        ("a/LICENSE", notice["Apache-2.0"]),
        (None, ""),
    ]
    rows = [(i, t, p, 1) for i, (p, t) in enumerate(files)]
    df = spark.createDataFrame(rows, "doc_id long, text string, place string, license int")
    found = {r.doc_id: r for r in license_scan(df, F.col("place")).collect()}
    got = {files[i][0]: (r.license, r.origin, r.directory) for i, r in found.items()}
    assert len(found) == len(files)
    assert got["a/LICENSE"] == ("Apache-2.0", "own", None)
    assert got["a/b/code"] == ("Apache-2.0", "inherited", "a")
    assert got["a/b/own"] == ("GPL-3.0", "own", None)
    assert got["a/b/c/LICENSE"] == ("MIT", "own", None)
    assert got["a/b/c/d/code"] == ("MIT", "inherited", "a/b/c")
    # A notice in a long file says nothing about its neighbours.
    assert got["e/code"] == got["top"] == got[None] == (None, "none", None)
    assert got["e/long"] == ("MIT", "own", None)
    assert license_scan(df.limit(0), F.col("place")).count() == 0


@pytest.mark.parametrize("name", sorted({n for n, _ in TEMPLATES}))
def test_every_notice_is_told_from_the_others(spark, name):
    from pyspark.sql import functions as F

    texts = [t for n, t in TEMPLATES if n == name]
    rows = [(i, t) for i, t in enumerate(texts)] + [(100 + i, t) for i, (_, t) in enumerate(TEMPLATES)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = license_scan(df.filter("doc_id < 100"), F.lit("x/y")).collect()
    assert {r.license for r in found} == {name}


def cosines(texts, passage):
    """The cosine of a passage with every template, by the plain definition."""
    files = [set(licenses.python_terms(t)) for t in texts]
    vocabulary = {t for _, notice in TEMPLATES for t in licenses.python_terms(notice)}

    def weight(term):
        n = sum(term in f for f in files) if term in vocabulary else 1
        return math.log((1 + len(files)) / (1 + n)) + 1

    def square(some):
        return sum(weight(t) ** 2 for t in some)

    own = set(licenses.python_terms(passage))
    for name, notice in TEMPLATES:
        its = set(licenses.python_terms(notice))
        yield round(square(own & its) / math.sqrt((square(own) or 1) * square(its)), 6), name


def test_notices_without_the_usual_words(spark):
    """Whatever words it has, a line or file that is close enough to a template is found."""
    from pyspark.sql import functions as F

    rng = random.Random(3)
    texts = [f"{prose(rng, 30)}\nlicensed or released under the {prose(rng, 5)}" for _ in range(60)]
    texts += [
        prose(rng, 100) + "\nCC BY 4.0\n" + prose(rng, 100),
        "CC\nBY-SA\n4.0",
        "CC0 1.0",
        prose(rng, 20) + "\nGNU Lesser General Public, version 3",
        "Mozilla Public 2.0",
        "mit",
        "by",
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    expected = []
    for i, text in enumerate(texts):
        score, name = max(
            (c for p in [*text.split("\n"), text] for c in cosines(texts, p)), key=lambda c: c[0]
        )
        expected.append((i, name, score) if score >= licenses.THRESHOLD else (i, None, None))
    found = license_scan(df, F.concat("doc_id", F.lit("/x"))).select("doc_id", "license", "score")
    assert sorted(map(tuple, found.collect())) == expected
    assert sum(name is not None for _, name, _ in expected) >= 3
