"""Licence scans: sparse TF-IDF cosine to templates, then inheritance along paths.

Every line, and every file as a whole, is compared with notice templates; left out are
only those that by the weights of their terms cannot come to the threshold. Weights come
from document counts over all files. Files without a
notice of their own take the licence of the licence file in the nearest directory
above them; that is found once per directory, by joins on path prefixes.
"""

from __future__ import annotations

import re
from math import log, sqrt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordlens.storage import Workspace

# Notices as projects state them.
TEMPLATES = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("ISC", "Released under the ISC License."),
    ("MPL-2.0", "Licensed under the Mozilla Public License, version 2.0."),
    ("EPL-2.0", "Licensed under the Eclipse Public License, version 2.0."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("LGPL-3.0", "Licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "Licensed under the GNU Affero General Public License, version 3."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC0-1.0", "Dedicated to the public domain under CC0 1.0."),
    ("Unlicense", "Released into the public domain under the Unlicense."),
)
# Every template names one of these. The scan does not ask for them, the SQL does.
TRIGGERS = ("licen", "public domain")
TERM = r"[^a-z0-9.\-]+"
THRESHOLD = 0.8
# A file of at most so many terms that has a notice is a licence file.
LICENSE_FILE_TERMS = 60
# By how much a score may fall short of the threshold and still be rounded up to it.
ROUNDING = 1e-6


def terms(text: Column) -> Column:
    """The distinct terms of a text: lower-case ASCII, digits, inner dots and dashes."""
    cut = F.transform(F.split(F.lower(text), TERM), lambda t: F.regexp_replace(t, r"^[.\-]+|[.\-]+$", ""))
    return F.array_distinct(F.filter(cut, lambda t: t != ""))


def python_terms(text: str) -> list[str]:
    """As ``terms``, for the templates."""
    cut = (t.strip(".-") for t in re.split(TERM, text.lower()))
    return sorted({t for t in cut if t})


def weights(files: DataFrame) -> tuple[dict[str, float], float]:
    """The weight of each template term, and that of any other term.

    The weight is ln((1 + N) / (1 + n)) + 1 for a term of n of the N files; a term of
    no template counts as one that no other file has. What comes to the driver is one
    number per template term, however large the corpus is.
    """
    vocabulary = sorted({t for _, notice in TEMPLATES for t in python_terms(notice)})
    present = F.array_intersect(terms(F.col("text")), F.array(*map(F.lit, vocabulary)))
    # The empty term stands for the file itself.
    counted = (
        files.select(F.explode(F.array_append(present, F.lit(""))).alias("term"))
        .groupBy("term")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    n = {row["term"]: row["n"] for row in counted.collect()}
    total = n.get("", 0)
    weight = {t: log((1 + total) / (1 + n.get(t, 0))) + 1 for t in vocabulary}
    return weight, log((1 + total) / 2) + 1


def needed_terms(weight: dict[str, float], threshold: float) -> list[str]:
    """Template terms of which every passage that comes to the threshold has one or more.

    A cosine is at most the root of the share that the common terms have in the squared
    weights of the template. So of each template these are its heaviest terms, as many as
    it takes for the others to have too small a share.
    """
    least = max(threshold - ROUNDING, 0.0) ** 2
    needed: set[str] = set()
    for _, notice in TEMPLATES:
        own = sorted(python_terms(notice), key=lambda t: (-weight[t], t))
        squares = [weight[t] ** 2 for t in own]
        for i, term in enumerate(own):
            if sum(squares[i:]) < least * sum(squares):
                break
            needed.add(term)
    return sorted(needed)


def most_terms(weight: dict[str, float], other: float, threshold: float) -> int:
    """How many terms a passage that comes to the threshold has at most.

    A cosine is at most the length of the template by that of the passage, in which all
    but the template terms weigh ``other``.
    """
    longest = max(sum(weight[t] ** 2 for t in python_terms(notice)) for _, notice in TEMPLATES)
    least = max(threshold - ROUNDING, ROUNDING) * other
    return len(weight) + int(longest / least**2) + 1


def best_template(passages: Column, weight: dict[str, float], other: float) -> Column:
    """The best (score, -template) of an array of passages, each an array of terms.

    The score is the cosine of the weights of the distinct terms, rounded to six digits.
    """
    table = F.create_map(*(F.lit(x) for pair in weight.items() for x in pair))

    def squares(found: Column, rest: Column) -> Column:
        return F.aggregate(
            found,
            F.lit(0.0),
            lambda total, t: total + F.coalesce(F.try_element_at(table, t), rest) ** 2,
        )

    def scores(passage: Column) -> Column:
        length = F.sqrt(squares(passage, F.lit(other)))
        return F.array(
            *(
                F.struct(
                    F.round(
                        squares(
                            F.array_intersect(passage, F.array(*map(F.lit, python_terms(notice)))),
                            F.lit(0.0),
                        )
                        / (length * F.lit(sqrt(sum(weight[t] ** 2 for t in python_terms(notice))))),
                        6,
                    ).alias("score"),
                    F.lit(-i).alias("template"),
                )
                for i, (_, notice) in enumerate(TEMPLATES)
            )
        )

    worded = F.filter(passages, lambda p: F.size(p) > 0)
    return F.array_max(F.flatten(F.transform(worded, scores)))


def scan_notices(files: DataFrame, *, threshold: float = THRESHOLD) -> DataFrame:
    """The files with license, score and whether each is short; null without a notice."""
    weight, other = weights(files)
    names = F.array(*(F.lit(name) for name, _ in TEMPLATES))

    # A look at the letters first; what it lets pass is compared by its terms.
    some = "|".join(map(re.escape, needed_terms(weight, threshold)))
    most = most_terms(weight, other, threshold)

    def could(text: Column) -> Column:
        return F.lower(text).rlike(f"(?<![a-z0-9])(?:{some})(?![a-z0-9])")

    whole = terms(F.col("text"))
    lines = F.transform(F.filter(F.split("text", "\n"), could), terms)
    passages = F.filter(F.array_append(lines, whole), lambda p: F.size(p) <= most)
    return (
        files.withColumn(
            "found",
            F.when(
                could(F.col("text")),
                F.struct(
                    best_template(passages, weight, other).alias("best"),
                    (F.size(whole) <= LICENSE_FILE_TERMS).alias("short"),
                ),
            ),
        )
        .withColumn("hit", F.col("found.best.score") >= threshold)
        .withColumn("score", F.when(F.col("hit"), F.col("found.best.score")))
        .withColumn("license", F.when(F.col("hit"), F.get(names, -F.col("found.best.template"))))
        .withColumn("short", F.col("hit") & F.col("found.short"))
        .drop("found", "hit", "text")
    )


def directory(path: Column) -> Column:
    """What stands before the last slash; empty for a file at the top."""
    return F.regexp_replace(path, r"/?[^/]*$", "")


def license_scan(
    files: DataFrame,
    path: Column,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    threshold: float = THRESHOLD,
) -> DataFrame:
    """The licence of every file: doc_id, path, license, score, origin, directory.

    origin is ``own`` for a file with a notice, ``inherited`` for one below a directory
    with a licence file (a short file with a notice), and ``none``; directory is where
    an inherited licence comes from. Of several licence files in a directory the one
    with the best score counts, then the licence first by name. Null and empty texts
    have no notice, a null path lies in the top directory; repeated rows are files of
    their own, and other columns are ignored.
    """
    own = files.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"),
        F.coalesce(path, F.lit("")).alias("path"),
        F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"),
    )
    work = Workspace(files.sparkSession, "licenses")
    listed = work.keep(
        scan_notices(own, threshold=threshold).withColumn("directory", directory(F.col("path"))),
        "files",
    )
    stated = (
        listed.filter("short")
        .groupBy(F.col("directory").alias("above"))
        .agg(
            F.min_by("license", F.struct(-F.col("score"), F.col("license"))).alias("from_license"),
            F.max("score").alias("from_score"),
        )
    )
    parts = F.split("directory", "/")
    above = F.transform(
        F.sequence(F.lit(0), F.size(parts)), lambda i: F.array_join(F.slice(parts, 1, i), "/")
    )
    inherited = (
        listed.select("directory")
        .distinct()
        .withColumn("above", F.explode(F.array_distinct(above)))
        .join(stated, "above")
        .groupBy("directory")
        .agg(
            F.max_by(
                F.struct("above", "from_license", "from_score"), F.length("above")
            ).alias("from")
        )
        .select("directory", "from.*")
    )
    has_own = F.col("license").isNotNull()
    taken = F.col("from_license").isNotNull()
    return listed.join(inherited, "directory", "left").select(
        "doc_id",
        "path",
        F.coalesce("license", "from_license").alias("license"),
        F.coalesce("score", "from_score").alias("score"),
        F.when(has_own, "own").when(taken, "inherited").otherwise("none").alias("origin"),
        F.when(~has_own & taken, F.col("above")).alias("directory"),
    )
