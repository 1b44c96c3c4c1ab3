"""Small corpora with copies, shared passages, blanks and oddities, and plain definitions."""

from __future__ import annotations

import random
import re

SCHEMA = "doc_id long, text string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def lower(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


def prose(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def corpus(n=60, seed=1):
    """Documents of a few to some hundred words; copies, near copies and shared passages."""
    rng = random.Random(seed)
    passages = [prose(rng, 45, 10_000) for _ in range(4)]
    rows = []
    for i in range(n):
        kind = i % 8
        if kind == 0 and i:
            text = rows[rng.randrange(i)][1]
        elif kind == 1:
            text = "\n".join([prose(rng, 30), rng.choice(passages), prose(rng, 25)])
        elif kind == 2 and i > 8:
            some = words(rows[rng.randrange(i)][1]) or ["alone"]
            some[rng.randrange(len(some))] = "changed"
            text = " ".join(some)
        elif kind == 3:
            text = "again and " * rng.randrange(1, 60)
        elif kind == 4:
            text = "Ünïcödé ❤ " + prose(rng, rng.randrange(40)) + " \t\x0b end"
        else:
            text = prose(rng, rng.randrange(1, 160))
        rows.append((3 * i, text))
    rows += [(1, None), (4, ""), (7, " \n\t "), (10, rows[5][1]), (None, rows[5][1]), (None, "lost words")]
    # One text that is much longer than a chunk of the tests.
    rows.append((13, prose(rng, 4000, 50_000) + " " + passages[0]))
    return rows


def frame(spark, rows):
    """The rows with extra columns whose names the operators use inside."""
    df = spark.createDataFrame([(*r, 7, "x", 1.5) for r in rows], SCHEMA + ", id long, body string, chunk double")
    return df.repartition(3)
