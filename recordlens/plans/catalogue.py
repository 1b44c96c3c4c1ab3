"""Named queries over the driver's tables; each reads whole tables of one directory."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordlens.functions.names import named
from recordlens.functions.numeric import rounded
from recordlens.operators.anomaly import SCORE, GaussianDetector, IQRDetector, ZScoreDetector
from recordlens.operators.components import connected_components
from recordlens.operators.matching import MatchScorer
from recordlens.operators.pairs import block_sizes, candidate_pairs, compare_pairs
from recordlens.operators.quality import (
    cluster_measures,
    contingency,
    flag_measures,
    merge_contingency,
    pair_measures,
    pair_measures_of,
    partition_measures,
)
from recordlens.operators.states import (
    merge_moments,
    merge_sketches,
    moment_states,
    quantile_sketches,
    rank_error,
    sketch_quantile,
    spread_of,
)
from recordlens.plans.detection import DetectionPipeline, detect_anomalies, flag_totals
from recordlens.plans.incremental import EntityStore
from recordlens.plans.resolution import ResolutionPipeline, resolve_entities
from recordlens.plans.scorecard import scorecard
from recordlens.sources import ColumnarTable, plant_anomalies, plant_duplicates
from recordlens.storage import Workspace

Query = Callable[[SparkSession, str], DataFrame]

CUSTOM_WEIGHTS = {"name_sim": 0.5, "email_exact": 0.25, "city_sim": 0.25}
CUSTOM_THRESHOLD = 0.8
LOW_THRESHOLD = 0.5
# So low that a similar name and city alone can match.
NAMES_THRESHOLD = 0.45
# Rank errors of a sketch that one quantile in 10,000 may exceed.
SLACK = 2
CHAIN = 50
# Without a common divisor with CHAIN: steps of this length visit every key of a chain.
STRIDE = 17
ACCURACY = 10_000


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _table(spark, sf_dir, "events").select(
        F.col("event_id").alias("txn_id"),
        F.col("user_id").alias("customer_id"),
        F.col("value").alias("amount"),
    )
    return plant_anomalies(events)


def _customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records read off the documents, which hold copies, short texts and shared values."""
    documents = _table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("record_id"),
        # Plain letters, because engines disagree on the edit distance of others.
        F.regexp_replace(F.substring("text", 1, 14), "[^A-Za-z ]", "").alias("name"),
        F.concat(F.substring("text", 20, 8), F.lit("@"), "lang").alias("email"),
        F.col("n_chars").cast("string").alias("phone"),
        F.concat("lang", F.lit("-"), "source").alias("city"),
    )
    return plant_duplicates(documents)


def _written(df: DataFrame, name: str) -> DataFrame:
    """Planted rows that several passes read, made once."""
    return Workspace(df.sparkSession, "planted").keep(df, name)


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    """Doubles to six digits, past which engines may add up differently."""
    return df.withColumns({c: rounded(named(c), 6) for c in columns})


def _flagged(flagged: DataFrame, *columns: str) -> DataFrame:
    return _rounded(flagged.select(*columns, SCORE), SCORE)


def zscore_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = detect_anomalies(_table(spark, sf_dir, "events"), "value")
    return _flagged(report.flagged, "event_id", "value")


def zscore_documents_t2(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents")
    report = detect_anomalies(documents, "n_chars", method="zscore", threshold=2.0)
    return _flagged(report.flagged, "doc_id", "n_chars")


def iqr_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = detect_anomalies(_table(spark, sf_dir, "events"), "value", method="iqr", exact=True)
    return _flagged(report.flagged, "event_id", "value")


def iqr_documents_k3(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents")
    report = IQRDetector(3.0, exact=True).detect(documents, "n_chars")
    return _flagged(report.flagged, "doc_id", "n_chars")


def iqr_events_approximate(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = detect_anomalies(_table(spark, sf_dir, "events"), "value", method="iqr")
    return _flagged(report.flagged, "event_id", "value")


def gauss_events_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _table(spark, sf_dir, "events")
    report = detect_anomalies(events, "value", method="gaussian", group_col="user_id")
    return _flagged(report.flagged, "event_id", "user_id", "value")


def gauss_events_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = GaussianDetector("event_type").detect(_table(spark, sf_dir, "events"), "value")
    return _flagged(report.flagged, "event_id", "event_type", "value")


def gauss_lineitem_supp_t15(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem = _table(spark, sf_dir, "lineitem")
    report = GaussianDetector("l_suppkey", threshold=1.5).detect(lineitem, "l_extendedprice")
    return _flagged(
        report.flagged, "l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice"
    )


def multi_detect_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    detectors = (ZScoreDetector(), IQRDetector(exact=True), GaussianDetector("user_id"))
    return DetectionPipeline(detectors).totals(_table(spark, sf_dir, "events"), "value")


def flag_totals_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    detectors = (ZScoreDetector(2.0), IQRDetector(exact=True))
    return flag_totals(DetectionPipeline(detectors).run(_table(spark, sf_dir, "events"), "value"))


def iqr_approximate_ranks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether the quartiles of the one-pass detector are as near in rank as it promises."""
    events = _table(spark, sf_dir, "events")
    x = F.col("value")
    summary = IQRDetector(accuracy=ACCURACY).summarise(events, x)
    counted = events.filter(x.isNotNull()).agg(
        F.count(x).alias("n_values"),
        *(
            agg.alias(f"{q}_{name}")
            for q in ("q1", "q3")
            for name, agg in (
                ("below", F.count_if(x < summary[q])),
                ("upto", F.count_if(x <= summary[q])),
            )
        ),
    )
    slack = F.col("n_values") / ACCURACY + 1
    return counted.select(
        "n_values",
        *(
            (
                (F.col(f"{q}_below") <= F.col("n_values") * share + slack)
                & (F.col(f"{q}_upto") >= F.col("n_values") * share - slack)
            ).alias(f"{q}_within")
            for q, share in (("q1", 0.25), ("q3", 0.75))
        ),
    )


def zscore_constant(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem = _table(spark, sf_dir, "lineitem").withColumn("constant", F.col("l_tax") * 0 + 5)
    scored = ZScoreDetector(2.0).score(lineitem, "constant")
    return scored.agg(
        F.count(F.lit(1)).alias("n_scored"),
        F.count_if(F.col(SCORE) > 2.0).alias("n_flagged"),
        F.max(SCORE).alias("top_score"),
    )


def gauss_singletons(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = GaussianDetector("o_orderkey").score(_table(spark, sf_dir, "orders"), "o_totalprice")
    return scored.agg(
        F.count(F.lit(1)).alias("n_scored"),
        F.count_if(F.col(SCORE) > 3.0).alias("n_flagged"),
        F.max(SCORE).alias("top_score"),
    )


def labelled_transactions_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(_transactions(spark, sf_dir), "amount")


def _flag_quality(spark: SparkSession, sf_dir: str, method: str, **options) -> DataFrame:
    transactions = _written(_transactions(spark, sf_dir), "transactions")
    report = detect_anomalies(transactions, "amount", method=method, **options)
    return _rounded(flag_measures(transactions, report.flagged), "precision", "recall", "f1")


def flag_metrics_zscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flag_quality(spark, sf_dir, "zscore")


def flag_metrics_gaussian(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flag_quality(spark, sf_dir, "gaussian", group_col="customer_id")


def flag_metrics_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = ZScoreDetector(2.0).detect(_table(spark, sf_dir, "documents"), "n_chars")
    truth = _table(spark, sf_dir, "labels").withColumn("low_quality", F.col("quality") == 0)
    quality = flag_measures(truth, report.flagged, id_col="doc_id", label_col="low_quality")
    return _rounded(quality, "precision", "recall", "f1")


def plant_duplicates_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _customers(spark, sf_dir)


def block_sizes_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return block_sizes(_customers(spark, sf_dir))


def candidate_pairs_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return candidate_pairs(_customers(spark, sf_dir), evidence=MatchScorer())


def _compared(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = candidate_pairs(_customers(spark, sf_dir), evidence=MatchScorer(), cleaned=True)
    return compare_pairs(pairs)


def pair_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    features = ("name_sim", "city_sim", "email_exact", "phone_exact")
    compared = _compared(spark, sf_dir).select("record_id_a", "record_id_b", *features)
    return _rounded(compared, *features)


def _scores(scored: DataFrame) -> DataFrame:
    return _rounded(
        scored.select("record_id_a", "record_id_b", "match_score", "is_match"), "match_score"
    )


def match_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scores(MatchScorer().score(_compared(spark, sf_dir)))


def matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scores(ResolutionPipeline().matches(_customers(spark, sf_dir)))


def matches_custom_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    scorer = MatchScorer(CUSTOM_WEIGHTS, CUSTOM_THRESHOLD)
    return _scores(ResolutionPipeline(scorer).matches(_customers(spark, sf_dir)))


def matches_low_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    scorer = MatchScorer(threshold=LOW_THRESHOLD)
    pairs = candidate_pairs(_customers(spark, sf_dir), evidence=scorer, cleaned=True)
    return _scores(scorer.matches(compare_pairs(pairs)))


def entity_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resolve_entities(_customers(spark, sf_dir)).clusters


def entity_clusters_custom_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    scorer = MatchScorer(CUSTOM_WEIGHTS, CUSTOM_THRESHOLD)
    return ResolutionPipeline(scorer).resolve(_customers(spark, sf_dir)).clusters


def entity_clusters_blank_emails(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ResolutionPipeline(blank_emails=True).resolve(_customers(spark, sf_dir)).clusters


def components_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = _customers(spark, sf_dir)
    return connected_components(customers, ResolutionPipeline().matches(customers, per_class=True))


def components_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    orders = _table(spark, sf_dir, "orders").select(key)
    steps = orders.filter(key % CHAIN != CHAIN - 1).select(
        key.alias("o_orderkey_a"), (key + 1).alias("o_orderkey_b")
    )
    return connected_components(orders, steps, id_col="o_orderkey")


def components_shuffled_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each chain of orders linked in an order that jumps to and fro."""
    key = F.col("o_orderkey")
    orders = _table(spark, sf_dir, "orders").select(key)
    base, step = key - key % CHAIN, key % CHAIN
    jumps = orders.filter(step != CHAIN - 1).select(
        (base + step * STRIDE % CHAIN).alias("o_orderkey_a"),
        (base + (step + 1) * STRIDE % CHAIN).alias("o_orderkey_b"),
    )
    return connected_components(orders, jumps, id_col="o_orderkey")


def components_hub(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All orders of a priority linked to the dearest one."""
    orders = _table(spark, sf_dir, "orders")
    hubs = orders.groupBy("o_orderpriority").agg(
        F.max_by("o_orderkey", F.struct("o_totalprice", "o_orderkey")).alias("o_orderkey_b")
    )
    links = orders.join(hubs, "o_orderpriority").select(
        F.col("o_orderkey").alias("o_orderkey_a"), "o_orderkey_b"
    )
    return connected_components(orders.select("o_orderkey"), links, id_col="o_orderkey")


def pairwise_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = _written(_customers(spark, sf_dir), "customers")
    quality = pair_measures(resolve_entities(customers).clusters, customers)
    return _rounded(quality, "precision", "recall", "f1")


def scorecard_planted(spark: SparkSession, sf_dir: str) -> DataFrame:
    card = scorecard(
        _written(_transactions(spark, sf_dir), "transactions"),
        _written(_customers(spark, sf_dir), "customers"),
    )
    return _rounded(card, "precision", "recall", "f1")


def _halves(spark: SparkSession, df: DataFrame, key: str, state, name: str) -> DataFrame:
    """States of the rows with even keys and of the others, each written, under one another."""
    work = Workspace(spark, name)
    odd = F.pmod(F.col(key), F.lit(2)) == 1
    first, second = (
        work.keep(state(df.filter(half)), side) for half, side in ((~odd, "even"), (odd, "odd"))
    )
    return first.unionByName(second)


def moments_events_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each type's moments, half of the events merged into the state of the other half."""
    events = _table(spark, sf_dir, "events")
    states = _halves(
        spark, events, "event_id", lambda df: moment_states(df, "value", ["event_type"]), "moments"
    )
    merged = merge_moments(states, ["event_type"]).withColumn("spread", spread_of())
    return _rounded(merged, "mean", "spread").select("event_type", "n", "mean", "spread")


def zscore_events_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _table(spark, sf_dir, "events")
    states = _halves(spark, events, "event_id", lambda df: moment_states(df, "value"), "moments")
    report = ZScoreDetector(states=states).detect(events, "value")
    return _flagged(report.flagged, "event_id", "value")


def gauss_events_user_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _table(spark, sf_dir, "events")
    states = _halves(
        spark, events, "event_id", lambda df: moment_states(df, "value", ["user_id"]), "moments"
    )
    report = GaussianDetector("user_id", states=states).detect(events, "value")
    return _flagged(report.flagged, "event_id", "user_id", "value")


def quartiles_merged_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether quartiles out of merged daily sketches are as near in rank as is stated."""
    events = _table(spark, sf_dir, "events").withColumn("day", F.to_date("ts"))
    daily = Workspace(spark, "sketches").keep(
        quantile_sketches(events, "value", ["event_type", "day"]), "daily"
    )
    quartiles = merge_sketches(daily.drop("day"), ["event_type"]).select(
        F.col("event_type").alias("its_type"),
        sketch_quantile(0.25).alias("q1"),
        sketch_quantile(0.75).alias("q3"),
    )
    x, n = F.col("value"), F.col("n_values")
    counted = (
        events.join(quartiles, F.col("event_type").eqNullSafe(F.col("its_type")))
        .groupBy("event_type")
        .agg(
            F.count(x).alias("n_values"),
            *(
                agg.alias(f"{q}_{name}")
                for q in ("q1", "q3")
                for name, agg in (
                    ("below", F.count_if(x < F.col(q))),
                    ("upto", F.count_if(x <= F.col(q))),
                )
            ),
        )
    )
    slack = n * (SLACK * rank_error()) + 1
    return counted.select(
        "event_type",
        "n_values",
        *(
            (
                (F.col(f"{q}_below") <= n * share + slack) & (F.col(f"{q}_upto") >= n * share - slack)
            ).alias(f"{q}_within")
            for q, share in (("q1", 0.25), ("q3", 0.75))
        ),
    )


def zscore_clicks_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unusual clicks, read through the library's own format, which takes over the filter."""
    source = ColumnarTable(f"{sf_dir}/events.parquet", ("event_id", "event_type", "value"), "value")
    clicks = source.load(spark).filter(F.col("event_type") == "click")
    return _flagged(detect_anomalies(clicks, "value", threshold=2.0).flagged, "event_id", "value")


def entity_clusters_similar_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    scorer = MatchScorer(threshold=NAMES_THRESHOLD)
    return ResolutionPipeline(scorer).resolve(_customers(spark, sf_dir)).clusters


def entity_clusters_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The entities of records that arrive in two batches, the larger ids first."""
    customers = _written(_customers(spark, sf_dir), "customers")
    late = F.pmod(F.xxhash64("true_entity_id"), F.lit(3)) == 0
    store = EntityStore(spark, f"{Workspace(spark, 'batches').folder}/store")
    store.add(customers.filter(~late))
    store.add(customers.filter(late))
    return store.clusters()


def _contingency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entities against the truth, added up from the stored tables of two halves."""
    customers = _written(_customers(spark, sf_dir), "customers")
    clusters = _written(resolve_entities(customers).clusters, "clusters")
    return merge_contingency(
        _halves(spark, clusters, "record_id", lambda df: contingency(df, customers), "contingency")
    )


def pairwise_metrics_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(pair_measures_of(_contingency(spark, sf_dir)), "precision", "recall", "f1")


def cluster_measures_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(cluster_measures(_contingency(spark, sf_dir)), "purity", "completeness")


def partition_measures_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    measured = partition_measures(_written(_contingency(spark, sf_dir), "table"))
    return _rounded(
        measured, "purity", "inverse_purity", "homogeneity", "completeness", "v_measure"
    )


QUERIES: dict[str, Query] = {
    "zscore_events": zscore_events,
    "zscore_documents_t2": zscore_documents_t2,
    "iqr_events": iqr_events,
    "iqr_documents_k3": iqr_documents_k3,
    "iqr_events_approximate": iqr_events_approximate,
    "gauss_events_user": gauss_events_user,
    "gauss_events_type": gauss_events_type,
    "gauss_lineitem_supp_t15": gauss_lineitem_supp_t15,
    "iqr_approximate_ranks": iqr_approximate_ranks,
    "multi_detect_events": multi_detect_events,
    "flag_totals_events": flag_totals_events,
    "zscore_constant": zscore_constant,
    "gauss_singletons": gauss_singletons,
    "labelled_transactions": labelled_transactions_events,
    "flag_metrics_zscore": flag_metrics_zscore,
    "flag_metrics_gaussian": flag_metrics_gaussian,
    "flag_metrics_labels": flag_metrics_labels,
    "plant_duplicates": plant_duplicates_customer,
    "block_sizes": block_sizes_customers,
    "candidate_pairs": candidate_pairs_customers,
    "pair_features": pair_features,
    "match_scores": match_scores,
    "matches": matches,
    "matches_custom_weights": matches_custom_weights,
    "matches_low_threshold": matches_low_threshold,
    "entity_clusters": entity_clusters,
    "entity_clusters_blank_emails": entity_clusters_blank_emails,
    "entity_clusters_custom_weights": entity_clusters_custom_weights,
    "components_matches": components_matches,
    "components_chain": components_chain,
    "components_shuffled_path": components_shuffled_path,
    "components_hub": components_hub,
    "pairwise_metrics": pairwise_metrics,
    "scorecard": scorecard_planted,
    "moments_events_merged": moments_events_merged,
    "zscore_events_merged": zscore_events_merged,
    "gauss_events_user_merged": gauss_events_user_merged,
    "quartiles_merged_sketches": quartiles_merged_sketches,
    "zscore_clicks_source": zscore_clicks_source,
    "entity_clusters_similar_names": entity_clusters_similar_names,
    "entity_clusters_batches": entity_clusters_batches,
    "pairwise_metrics_merged": pairwise_metrics_merged,
    "cluster_measures_merged": cluster_measures_merged,
    "partition_measures_merged": partition_measures_merged,
}
