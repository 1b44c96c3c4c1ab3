"""Precision, recall and F1 of flags and of clusters against known truth."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordlens.functions.names import named
from recordlens.functions.numeric import harmonic_mean, pair_count, ratio
from recordlens.operators.guards import require_columns
from recordlens.reports import EvaluationMetrics

CONTINGENCY = ("entity_id", "true_id", "n")


def measures(tp: Column, fp: Column, fn: Column) -> list[Column]:
    """Columns precision, recall, f1 and support from three counts."""
    precision, recall = ratio(tp, tp + fp), ratio(tp, tp + fn)
    return [
        precision.alias("precision"),
        recall.alias("recall"),
        harmonic_mean(precision, recall).alias("f1"),
        (tp + fn).alias("support"),
    ]


def flag_measures(
    truth: DataFrame,
    flagged: DataFrame,
    *,
    id_col: str = "txn_id",
    label_col: str = "is_anomaly",
) -> DataFrame:
    """One row (n_rows, n_flagged, tp, fp, fn, precision, recall, f1, support).

    Both frames go into one aggregation per id, with partial results before its
    only shuffle, instead of a join. Flagged ids that are not in ``truth`` count
    nowhere, and neither do labels other than 0 and 1.

    Args:
        truth: All rows with a label: 1 or true for an anomaly, 0 or false for none.
        flagged: The flagged rows; an id may occur more than once.
        id_col: Row id in both frames.
        label_col: The label in ``truth``.
    """
    require_columns(truth, [id_col, label_col])
    require_columns(flagged, [id_col])
    label = named(label_col).cast("double")
    labelled = truth.select(
        named(id_col).alias("id"),
        (label == 1).cast("bigint").alias("positive"),
        (label == 0).cast("bigint").alias("negative"),
        F.lit(1).cast("bigint").alias("row"),
        F.lit(0).cast("bigint").alias("hit"),
    )
    found = flagged.select(
        named(id_col).alias("id"),
        F.lit(0).cast("bigint").alias("positive"),
        F.lit(0).cast("bigint").alias("negative"),
        F.lit(0).cast("bigint").alias("row"),
        F.lit(1).cast("bigint").alias("hit"),
    )
    sums = {c: F.sum(c).alias(c) for c in ("positive", "negative", "row", "hit")}
    per_id = labelled.unionByName(found).groupBy("id").agg(*sums.values())
    # A null id is no id: such a row cannot be flagged.
    is_hit = (F.col("hit") > 0) & F.col("id").isNotNull()

    def total(count: str, among: Column) -> Column:
        return F.coalesce(F.sum(F.when(among, F.col(count))), F.lit(0))

    counts = per_id.agg(
        total("row", F.lit(True)).alias("n_rows"),
        total("hit", F.lit(True)).alias("n_flagged"),
        total("positive", is_hit).alias("tp"),
        total("negative", is_hit).alias("fp"),
        total("positive", ~is_hit).alias("fn"),
    )
    return counts.select("*", *measures(F.col("tp"), F.col("fp"), F.col("fn")))


def contingency(
    clusters: DataFrame,
    truth: DataFrame,
    *,
    id_col: str = "record_id",
    truth_col: str = "true_entity_id",
) -> DataFrame:
    """How many records each entity shares with each true entity: (entity_id, true_id, n).

    Records without a truth value are left out. Tables of different records add up, see
    :func:`merge_contingency`; all measures of clusters follow from one.
    """
    require_columns(clusters, [id_col, "entity_id"])
    require_columns(truth, [id_col, truth_col])
    known = truth.select(named(id_col).alias("known_id"), named(truth_col).alias("true_id"))
    return (
        clusters.select(named(id_col).alias("id"), "entity_id")
        .join(known.filter(F.col("true_id").isNotNull()), F.col("id") == F.col("known_id"))
        .groupBy("entity_id", "true_id")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def merge_contingency(*tables: DataFrame) -> DataFrame:
    """The table of the records of all tables, which have no record in common."""
    every = reduce(DataFrame.unionByName, (t.select(*CONTINGENCY) for t in tables))
    return every.groupBy("entity_id", "true_id").agg(F.sum("n").alias("n"))


def pair_measures(
    clusters: DataFrame,
    truth: DataFrame,
    *,
    id_col: str = "record_id",
    truth_col: str = "true_entity_id",
) -> DataFrame:
    """One row (n_records, n_entities, tp, fp, fn, precision, recall, f1, support).

    A pair of records is predicted if both records share an ``entity_id`` and true if they
    share ``truth_col``. Pairs are counted in closed form from the group sizes, in
    one job: sizes per (entity, truth) first, the coarser sizes from those. The
    counts are ``decimal(38,0)``. Records without a truth value are left out.
    """
    return pair_measures_of(contingency(clusters, truth, id_col=id_col, truth_col=truth_col))


def pair_measures_of(table: DataFrame) -> DataFrame:
    """:func:`pair_measures` of a table of :func:`contingency`."""
    require_columns(table, CONTINGENCY)
    by_entity, by_truth = F.col("entity_id"), F.col("true_id")
    groups = table.groupingSets(
        [[by_entity, by_truth], [by_entity], [by_truth]], by_entity, by_truth
    ).agg(F.sum("n").alias("n"), F.grouping_id().alias("level"))

    def pairs(level: int) -> Column:
        counted = F.sum(F.when(F.col("level") == level, pair_count(F.col("n"))))
        return F.coalesce(counted, F.lit(0)).cast("decimal(38,0)")

    of_entity = F.when(F.col("level") == 1, F.col("n"))
    counts = groups.agg(
        F.coalesce(F.sum(of_entity), F.lit(0)).alias("n_records"),
        F.count(of_entity).alias("n_entities"),
        pairs(0).alias("both"),
        pairs(1).alias("predicted"),
        pairs(2).alias("actual"),
    ).select(
        "n_records",
        "n_entities",
        F.col("both").alias("tp"),
        (F.col("predicted") - F.col("both")).cast("decimal(38,0)").alias("fp"),
        (F.col("actual") - F.col("both")).cast("decimal(38,0)").alias("fn"),
    )
    return counts.select(
        "*", *measures(F.col("tp"), F.col("fp"), F.col("fn"))
    ).withColumn("support", F.col("support").cast("decimal(38,0)"))


def cluster_measures(table: DataFrame) -> DataFrame:
    """One row per entity of a :func:`contingency`, about it and the truth it mostly holds.

    Columns: entity_id, n_records, n_true (true entities it mixes), true_id (the one with
    most of its records, the smallest of several), n_shared (records of that one in the
    entity), n_actual (all records of that one), purity (n_shared / n_records) and
    completeness (n_shared / n_actual). A large entity or true entity is one row per pair
    of the two, so no task gets its records.
    """
    require_columns(table, CONTINGENCY)
    actual = table.groupBy(F.col("true_id").alias("its_true_id")).agg(F.sum("n").alias("n_actual"))
    sizes = table.groupBy("entity_id").agg(
        F.sum("n").alias("n_records"),
        F.count(F.lit(1)).alias("n_true"),
        F.max("n").alias("n_shared"),
    )
    leading = (
        table.select(F.col("entity_id").alias("its_entity"), "true_id", F.col("n").alias("its_n"))
        .join(sizes, (F.col("its_entity") == F.col("entity_id")) & (F.col("its_n") == F.col("n_shared")))
        .groupBy("entity_id", "n_records", "n_true", "n_shared")
        .agg(F.min("true_id").alias("true_id"))
    )
    return leading.join(actual, F.col("true_id") == F.col("its_true_id")).select(
        "entity_id",
        "n_records",
        "n_true",
        "true_id",
        "n_shared",
        "n_actual",
        ratio(F.col("n_shared"), F.col("n_records")).alias("purity"),
        ratio(F.col("n_shared"), F.col("n_actual")).alias("completeness"),
    )


def partition_measures(table: DataFrame) -> DataFrame:
    """One row (n_records, n_entities, n_true, purity, inverse_purity, homogeneity,
    completeness, v_measure) about a whole :func:`contingency`.

    Purity is the share of records that belong to their entity's most frequent truth, the
    inverse the same with the sides exchanged; homogeneity and completeness are 1 minus the
    conditional entropy's share of the entropy, 1 where there is none, and the v-measure is
    their harmonic mean. Without records all are 0 and the entropies' measures 1.
    """
    require_columns(table, CONTINGENCY)

    def side(key: str) -> DataFrame:
        n = F.col("n_of").cast("double")
        return (
            table.groupBy(key)
            .agg(F.sum("n").alias("n_of"), F.max("n").alias("most"))
            .agg(
                F.count(F.lit(1)).alias("groups"),
                F.coalesce(F.sum("most"), F.lit(0)).alias("most"),
                F.coalesce(F.sum("n_of"), F.lit(0)).alias("n"),
                F.coalesce(F.sum(n * F.log(n)), F.lit(0.0)).alias("nlogn"),
            )
        )

    n = F.col("n").cast("double")
    joint = table.agg(F.coalesce(F.sum(n * F.log(n)), F.lit(0.0)).alias("joint"))
    entities, truths = (
        side(key).select(F.struct("*").alias(name))
        for key, name in (("entity_id", "e"), ("true_id", "t"))
    )
    total = F.col("e.n").cast("double")
    own = total * F.log(F.nullif(total, F.lit(0.0)))

    def explained(given: str, of: str) -> Column:
        """1 - H(of | given) / H(of), from sums of n log n."""
        left, whole = F.col(f"{given}.nlogn") - F.col("joint"), own - F.col(f"{of}.nlogn")
        return F.when(whole > 1e-9 * total, F.least(F.lit(1.0), 1 - left / whole)).otherwise(F.lit(1.0))

    # Three tables of one row each.
    one = entities.join(truths).join(joint)
    homogeneity, completeness = explained("e", "t"), explained("t", "e")
    return one.select(
        F.col("e.n").alias("n_records"),
        F.col("e.groups").alias("n_entities"),
        F.col("t.groups").alias("n_true"),
        ratio(F.col("e.most"), F.col("e.n")).alias("purity"),
        ratio(F.col("t.most"), F.col("e.n")).alias("inverse_purity"),
        homogeneity.alias("homogeneity"),
        completeness.alias("completeness"),
        harmonic_mean(homogeneity, completeness).alias("v_measure"),
    )


def _metrics(one_row: DataFrame) -> EvaluationMetrics:
    counts = one_row.select("tp", "fp", "fn").first()
    return EvaluationMetrics.from_counts(**{k: int(v) for k, v in counts.asDict().items()})


def anomaly_metrics(
    truth: DataFrame,
    flagged: DataFrame,
    *,
    id_col: str = "txn_id",
    label_col: str = "is_anomaly",
) -> EvaluationMetrics:
    """:func:`flag_measures` as a plain object."""
    return _metrics(flag_measures(truth, flagged, id_col=id_col, label_col=label_col))


def pairwise_resolution_metrics(
    clusters: DataFrame,
    truth: DataFrame,
    *,
    id_col: str = "record_id",
    truth_col: str = "true_entity_id",
) -> EvaluationMetrics:
    """:func:`pair_measures` as a plain object."""
    return _metrics(pair_measures(clusters, truth, id_col=id_col, truth_col=truth_col))
