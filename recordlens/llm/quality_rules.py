"""Line-first cleaning: rules judge each line, and a text that loses too much is rejected.

Everything is a column expression over one row, so nothing is shuffled and no text
is looked at by more than one task.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# ASCII white space between words, and the symbols that the measures count.
GAP = r"[\x20\x09-\x0D]+"
VISIBLE = r"[^\x20\x09-\x0D]"
NO_SYMBOLS = r"[!=~^_]+"
# Marks that prose uses seldom; many of them in a line are decoration or shouting.
MARKS = r"[#*$%&<>!=~^_]+"
NO_MARKS = r"[^#*$%&|<>!=~^_]+"
# Phrases of page furniture, in lower case.
BOILERPLATE = (
    "all rights reserved",
    "cookie",
    "privacy policy",
    "terms of use",
    "terms of service",
    "subscribe",
    "sign up",
    "log in",
    "login",
    "click here",
    "read more",
    "enable javascript",
    "powered by",
)
# Bits of a window's hash that make room for its position in the text.
POSITION_BITS = 20

MEASURES = (
    "n_words",
    "word_chars",
    "n_symbols",
    "n_dup_lines",
    "n_repeat_words",
    "lost_chars",
    "base_failed",
    "kept",
)


@dataclass(frozen=True)
class LineRules:
    """When a line, and then a text, is rejected; shares are in percent.

    Attributes:
        marks: Punctuation: a line of which MARKS are at least this share goes ...
        least_marks: ... if it has at least so many.
        bars: Navigation: a line of which ``|`` is at least this share goes ...
        least_bars: ... if it has at least so many.
        boilerplate_chars: A line of at most so many characters with a BOILERPLATE
            phrase goes.
        lost: A text is rejected if more of its word characters than this are removed.
        least_words: A text with fewer words is rejected.
        repeated: A text is rejected if more of its words stand in repeated 3-word windows.
    """

    marks: int = 10
    least_marks: int = 3
    bars: int = 5
    least_bars: int = 2
    boilerplate_chars: int = 80
    lost: int = 30
    least_words: int = 50
    repeated: int = 50


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once for each row."""
    return F.element_at(F.transform(F.array(value), body), 1)


def found(text: Column, pattern: str) -> Column:
    """How many characters of a text match a class of characters."""
    return F.length(text) - F.length(F.regexp_replace(text, pattern, ""))


def words_of(text: Column) -> Column:
    """The words of a text as an array."""
    return F.filter(F.split(text, GAP), lambda w: w != "")


def _covered(positions: Column) -> Column:
    """Words in the 3-word windows that begin at sorted positions."""
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(-3).cast("long").alias("last"))
    return F.aggregate(
        positions,
        start,
        lambda acc, at: F.struct(
            (acc["n"] + F.least(F.lit(3).cast("long"), at - acc["last"])).alias("n"),
            at.alias("last"),
        ),
        lambda acc: acc["n"],
    )


def _equal_neighbour(items: Column, same: Callable[[Column, Column], Column]) -> Column:
    """The items of a sorted array that are the same as the one before or behind."""
    return F.filter(
        items,
        lambda x, k: F.coalesce(same(F.get(items, k + 1), x), F.lit(False))
        | F.coalesce(same(F.get(items, k - 1), x), F.lit(False)),
    )


def _repeats(hashes: Column) -> Column:
    """Covered words, from (hash, position) pairs in order."""
    pairs = F.transform(
        hashes, lambda h, i: F.struct(h.alias("h"), i.cast("long").alias("i"))
    )
    return let(
        F.sort_array(pairs),
        lambda s: _covered(
            F.sort_array(
                F.transform(
                    _equal_neighbour(s, lambda x, y: x["h"] == y["h"]), lambda x: x["i"]
                )
            )
        ),
    )


def _packed_repeats(hashes: Column) -> Column:
    """As ``_repeats``, sorting one long per window: upper hash bits and position.

    If two windows agree in the upper bits alone, the pairs are sorted after all.
    """
    mask = (1 << POSITION_BITS) - 1

    def position(x: Column) -> Column:
        return x.bitwiseAND(F.lit(mask))

    def close(x: Column, y: Column) -> Column:
        return F.shiftrightunsigned(x.bitwiseXOR(y), POSITION_BITS) == 0

    def whole(x: Column) -> Column:
        return F.get(hashes, position(x).cast("int"))

    packed = F.transform(
        hashes, lambda h, i: h.bitwiseAND(F.lit(~mask)).bitwiseOR(i.cast("long"))
    )

    def result(candidates: Column) -> Column:
        doubtful = F.exists(
            F.transform(
                candidates,
                lambda x, k: F.coalesce(
                    close(F.get(candidates, k + 1), x)
                    & (whole(F.get(candidates, k + 1)) != whole(x)),
                    F.lit(False),
                ),
            ),
            lambda x: x,
        )
        at = F.sort_array(F.transform(candidates, position))
        return F.when(doubtful, _repeats(hashes)).otherwise(_covered(at))

    return let(F.sort_array(packed), lambda s: let(_equal_neighbour(s, close), result))


def repeated_words(words: Column) -> Column:
    """How many words stand in a window of three words that is found twice or more.

    Windows are compared by a 64-bit hash within one text. Sorted, equal ones are
    neighbours; the positions found so are joined into covered words.
    """

    def counted(hashes: Column) -> Column:
        return (
            F.when(
                F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0).cast("long")
            )
            .when(F.size(hashes) < (1 << POSITION_BITS), _packed_repeats(hashes))
            .otherwise(_repeats(hashes))
        )

    def windows(ws: Column) -> Column:
        every = F.transform(ws, lambda w, i: F.xxhash64(w, F.get(ws, i + 1), F.get(ws, i + 2)))
        return F.slice(every, 1, F.greatest(F.size(ws) - 2, F.lit(0)))

    return let(words, lambda ws: let(windows(ws), counted))


def furniture(low: Column) -> Column:
    """Whether a text in lower case has a BOILERPLATE phrase."""
    return reduce(or_, (F.contains(low, F.lit(phrase)) for phrase in BOILERPLATE))


def line_fails(line: Column, rules: LineRules) -> Column:
    """Whether a line breaks the punctuation, navigation or boilerplate rule."""
    size = F.length(line)
    marks, bars = found(line, MARKS), found(line, r"\|+")
    return (
        ((size <= rules.boilerplate_chars) & let(F.lower(line), furniture))
        | let(marks, lambda n: (n >= rules.least_marks) & (n * 100 >= size * rules.marks))
        | let(bars, lambda n: (n >= rules.least_bars) & (n * 100 >= size * rules.bars))
    )


def clean_text(text: Column, rules: LineRules) -> Column:
    """The lines of a text that pass the rules."""
    return F.array_join(
        F.filter(F.split(text, "\n"), lambda line: ~line_fails(line, rules)), "\n"
    )


def measures(text: Column, rules: LineRules) -> Column:
    """A struct with the fields MEASURES of one text."""

    def of_words(ws: Column) -> Column:
        return F.struct(
            F.size(ws).cast("long").alias("n_words"),
            F.length(F.array_join(ws, "")).cast("long").alias("word_chars"),
            repeated_words(ws).alias("n_repeat_words"),
        )

    def of_lines(lines: Column) -> Column:
        worded = F.filter(lines, lambda line: F.rlike(line, F.lit(VISIBLE)))
        return let(worded, lambda w: F.size(w) - F.size(F.array_distinct(w))).cast("long")

    def lost(t: Column, marks: Column) -> Column:
        gone = F.array_join(
            F.filter(F.split(t, "\n"), lambda line: line_fails(line, rules)), ""
        )
        # Without a mark or a phrase anywhere, no line can fail.
        possible = (F.length(marks) > 0) | let(F.lower(t), furniture)
        return F.when(possible, F.length(F.regexp_replace(gone, GAP, ""))).otherwise(0).cast("long")

    def verdict(m: Column) -> Column:
        w = m["words"]
        base_failed = (w["n_words"] < rules.least_words) | (
            w["n_repeat_words"] * 100 > w["n_words"] * rules.repeated
        )
        return F.struct(
            w["n_words"].alias("n_words"),
            w["word_chars"].alias("word_chars"),
            m["n_symbols"].alias("n_symbols"),
            m["n_dup_lines"].alias("n_dup_lines"),
            w["n_repeat_words"].alias("n_repeat_words"),
            m["lost_chars"].alias("lost_chars"),
            base_failed.alias("base_failed"),
            (~base_failed & (m["lost_chars"] * 100 <= w["word_chars"] * rules.lost)).alias(
                "kept"
            ),
        )

    def measured(t: Column, marks: Column) -> Column:
        return let(
            F.struct(
                let(words_of(t), of_words).alias("words"),
                let(F.split(t, "\n"), of_lines).alias("n_dup_lines"),
                F.length(F.regexp_replace(marks, NO_SYMBOLS, ""))
                .cast("long")
                .alias("n_symbols"),
                lost(t, marks).alias("lost_chars"),
            ),
            verdict,
        )

    return let(
        text, lambda t: let(F.regexp_replace(t, NO_MARKS, ""), lambda marks: measured(t, marks))
    )


def _whole(text_col: str) -> Column:
    return F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))


def kept_documents(
    docs: DataFrame, rules: LineRules = LineRules(), *, text_col: str = "text"
) -> DataFrame:
    """The rows whose text is kept, unchanged.

    A null or empty text has no words and is not kept; repeated rows get the same
    verdict, each for itself.
    """
    return docs.filter(measures(_whole(text_col), rules)["kept"])


def cleaned_documents(
    docs: DataFrame, rules: LineRules = LineRules(), *, text_col: str = "text"
) -> DataFrame:
    """The rows whose text is kept, each text without its failing lines."""
    kept = kept_documents(docs, rules, text_col=text_col)
    return kept.withColumn(text_col, clean_text(_whole(text_col), rules))


def quality_report(
    docs: DataFrame,
    rules: LineRules = LineRules(),
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per row of ``docs``: its id as doc_id, and MEASURES.

    lost_chars are the word characters of failing lines. Null and empty texts have
    no words; a null id stays null; columns beyond id and text are ignored.
    """
    return docs.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"),
        measures(_whole(text_col), rules).alias("found"),
    ).select("doc_id", *(f"found.{f}" for f in MEASURES))
