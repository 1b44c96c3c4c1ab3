"""Candidate pairs of records and the features that compare them."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordlens.functions.names import free_name, named
from recordlens.functions.numeric import pair_count
from recordlens.functions.text import (
    block_key,
    digits,
    edit_similarity,
    normalised,
    same_email,
    same_phone,
)
from recordlens.operators.guards import require_columns
from recordlens.operators.matching import EXACT_FEATURES, GRADED_FEATURES, MatchScorer, Way
from recordlens.operators.similar import LEAST_BY_PARTS, similar_pairs
from recordlens.operators.spread import Side, pairs_within

FIELDS = ("name", "email", "phone", "city")
EVIDENCE = ("email", "phone")
# How two values are compared; what of a record does not change is best made once for it.
CLEANED = {"name": normalised, "city": normalised, "email": normalised, "phone": digits}
CLEAN = "cleaned "


def evidence_key(field: str, *, blank_emails: bool = False) -> Column:
    """The value on which two records must agree for an exact feature; null if none can."""
    if field == "email":
        email = normalised(named("email"))
        return email if blank_emails else F.nullif(email, F.lit(""))
    if field == "phone":
        return F.nullif(digits(named("phone")), F.lit(""))
    raise ValueError(f"no exact feature for {field!r}; choose from {EVIDENCE}")


def block_sizes(records: DataFrame, *, trim_key: bool = False) -> DataFrame:
    """Records and record pairs per block: (block_key, n_records, n_pairs).

    The pairs are counted, not listed, so a block may hold any share of the rows.
    """
    require_columns(records, ["name", "city"])
    key = block_key(named("name"), named("city"), trim=trim_key)
    sizes = records.groupBy(key.alias("block_key")).agg(F.count(F.lit(1)).alias("n_records"))
    return sizes.withColumn("n_pairs", pair_count(F.col("n_records")))


def _agreement(fields: Sequence[str], blank_emails: bool) -> Column:
    """The values on which two records must agree, as one text; null if one is missing."""
    values = []
    for f in fields:
        value = evidence_key(f, blank_emails=blank_emails) if f in EVIDENCE else normalised(named(f))
        # With its length ahead, so that no two lists of values run into the same text.
        values.append(F.concat(F.length(value).cast("string"), F.lit(":"), value))
    return F.concat(F.lit("+".join(fields) + "|"), *values)


def candidate_pairs(
    records: DataFrame,
    *,
    id_col: str = "record_id",
    fields: Sequence[str] = FIELDS,
    evidence: Sequence[str] | MatchScorer,
    blank_emails: bool = False,
    trim_key: bool = False,
    cleaned: bool = False,
) -> DataFrame:
    """Pairs of records in one block, smaller id first, as ``<field>_a`` / ``<field>_b``.

    What may be left out depends on who scores the pairs, so ``evidence`` has no
    default. Given a scorer, all pairs that can match by its weights and threshold are
    produced. From these follows on which fields a match has to agree in full: a shared
    email or phone, or a name and city whose least similarity is 1.0. Each such way is an
    equi-join on (block, values), whose output grows with the duplicates in the data. A
    name or city that has to be similar only, but at least by half, is looked for by
    :func:`similar_pairs`. Otherwise, and with ``evidence=()``, it is every pair of a block;
    look at :func:`block_sizes` first. Records without name and city share the empty block.

    Args:
        records: Records with ``id_col``, ``name``, ``city``, the ``fields`` and the
            ``evidence`` fields.
        id_col: Unique record id.
        fields: Columns carried onto both sides.
        evidence: The scorer of the pairs, or the fields of which at least one must
            agree, out of email and phone.
        blank_emails: Whether two blank emails agree.
        trim_key: Whether outer spaces are left out of the block key.
        cleaned: Whether the pairs also carry what :func:`compare_pairs` looks at, made once
            for a record instead of once for each of its pairs, and how similar names and
            cities are, found once for two values that many records of a large group have.
    """
    if isinstance(evidence, MatchScorer):
        ways = evidence.ways()
        impossible = not ways
        if any(not w.fields and max(w.least.values(), default=0) < LEAST_BY_PARTS for w in ways):
            ways = []
    else:
        for f in evidence:
            evidence_key(f)
        ways, impossible = [Way((f,)) for f in evidence], False
    needed = [f for w in ways for f in (*w.fields, *w.least)]
    require_columns(records, [id_col, "name", "city", *fields, *needed])
    block, shared, kind, text, least = (
        free_name(records, c) for c in ("block", "shared", "kind", "text", "least")
    )
    clean = {f"{CLEAN}{f}": make(named(f)) for f, make in CLEANED.items() if cleaned}
    graded = {f"{CLEAN}{x}": f"{CLEAN}{f}" for x, f in GRADED_FEATURES.items() if cleaned}
    require_columns(records, [f for f in CLEANED if cleaned])
    # What is compared in full is carried; of the others only how similar they are.
    carried = [*fields, *(c for c in clean if c not in graded.values())]

    def similarity(field: str) -> Callable[[Side, Side], Column]:
        return lambda a, b: edit_similarity(a(field), b(field))

    measures = {x: similarity(f) for x, f in graded.items()}
    joins = [w.fields for w in ways if w.fields]
    values = [free_name(records, f"earlier_{i}") for i in range(len(joins))]
    keyed = records.select(
        *(named(c) for c in dict.fromkeys((id_col, *fields))),
        *(made.alias(c) for c, made in clean.items()),
        block_key(named("name"), named("city"), trim=trim_key).alias(block),
        *(_agreement(j, blank_emails).alias(v) for j, v in zip(joins, values)),
        *(normalised(named(f)).alias(f"{text}_{f}") for f in ("name", "city")),
    )
    if impossible:
        keyed = keyed.filter(F.lit(False))

    def unseen(a, b) -> Column:
        agree = (F.coalesce(a(v) == b(v), F.lit(False)) for v in values)
        return ~reduce(or_, agree, F.lit(False))

    def sides(frame: DataFrame, a, b) -> DataFrame:
        return frame.select(
            a(id_col).alias(f"{id_col}_a"),
            b(id_col).alias(f"{id_col}_b"),
            *(s(f).alias(f"{f}_{end}") for f in carried for end, s in (("a", a), ("b", b))),
            *map(named, measures),
        )

    found = None
    if joins or not ways:
        # One row per way to agree; `values` keep those of the ways before it.
        agreed = F.array(*map(named, values)) if ways else F.array(F.lit(""))
        agreeing = keyed.select(
            "*", F.posexplode(agreed.cast("array<string>")).alias(kind, shared)
        ).withColumns({v: F.when(named(kind) > i, named(v)) for i, v in enumerate(values)})
        found = sides(
            *pairs_within(
                agreeing,
                [block, kind, shared],
                id_col,
                unseen,
                alike=[*graded.values()],
                measures=measures,
            )
        )
    for way in ways:
        if way.fields:
            continue
        field, level = max(way.least.items(), key=lambda entry: entry[1])
        texts = keyed.withColumns({text: named(f"{text}_{field}"), least: F.lit(level)})
        pairs = similar_pairs(texts, [block], id_col, text, least, unseen)
        a, b = (lambda c: F.col("a")[c]), (lambda c: F.col("b")[c])
        if measures:
            made = (make(a, b).alias(x) for x, make in measures.items())
            pairs = pairs.select("a", "b", F.inline(F.array(F.struct(*made))))
        more = sides(pairs, a, b)
        found = more if found is None else found.unionByName(more)
    return found


def compare_pairs(pairs: DataFrame, *, blank_emails: bool = False) -> DataFrame:
    """``pairs`` with ``name_sim``, ``city_sim``, ``email_exact`` and ``phone_exact``.

    All four are doubles from 0 to 1 and never null: a missing value on either
    side gives 0.0, because absence is no evidence. So does a blank phone, and a blank
    email unless ``blank_emails`` is set. What pairs carry ``cleaned`` is used and left out.
    """
    require_columns(pairs, [f"{f}_{end}" for f in FIELDS for end in "ab"])
    exact = {f"{CLEAN}{f}_{end}" for f in EXACT_FEATURES.values() for end in "ab"}
    graded = {f"{CLEAN}{x}" for x in GRADED_FEATURES}
    given = exact | graded <= set(pairs.columns)

    def both(field: str) -> list[Column]:
        if given:
            return [named(f"{CLEAN}{field}_{end}") for end in "ab"]
        return [CLEANED[field](named(f"{field}_{end}")) for end in "ab"]

    def similarity(feature: str) -> Column:
        if given:
            return named(f"{CLEAN}{feature}")
        return edit_similarity(*both(GRADED_FEATURES[feature]))

    features = [
        similarity("name_sim").alias("name_sim"),
        similarity("city_sim").alias("city_sim"),
        same_email(*both("email"), blank_matches=blank_emails).alias("email_exact"),
        same_phone(*both("phone")).alias("phone_exact"),
    ]
    names = ("name_sim", "city_sim", "email_exact", "phone_exact")
    left_out = {*names, *exact, *graded} if given else names
    others = [named(c) for c in pairs.columns if c not in left_out]
    if given:
        return pairs.select(*others, *features)
    # Generated, not projected: a filter on the features then stays above the join that made
    # the pairs, and no similarity is computed for what is no pair, or twice.
    return pairs.select(*others, F.inline(F.array(F.struct(*features))))
