"""The catalogue's queries once more, as plain SQL for an independent engine.

Written from the definitions, not from the Spark plans: records are matched by a
self-join of each block, without regard to what a match needs, and components are
closed by a recursive query.
"""

from __future__ import annotations

from recordlens.functions.draws import DRAW_BITS, WORD_DIGITS
from recordlens.operators.matching import DEFAULT_WEIGHTS
from recordlens.plans.catalogue import (
    CHAIN,
    CUSTOM_THRESHOLD,
    CUSTOM_WEIGHTS,
    LOW_THRESHOLD,
    NAMES_THRESHOLD,
)
from recordlens.sources.planted import COPY_SLOTS


def _num(x: float) -> str:
    return f"{float(x)!r}::DOUBLE"


def _draw(salt: str, i: int, *keys: str) -> str:
    text = " || '|' || ".join([f"'{salt}|{i // 6}'", *(f"({k})::VARCHAR" for k in keys)])
    word = f"('0x' || substr(md5({text}), {1 + WORD_DIGITS * (i // 3 % 2)}, {WORD_DIGITS}))::BIGINT"
    bits = f"(({word} >> {DRAW_BITS * (i % 3)}) & {2**DRAW_BITS - 1})"
    return f"({bits}::DOUBLE / {_num(2**DRAW_BITS)})"


def _whole(draw: str, low: int, high: int) -> str:
    return f"({low} + floor({draw} * {_num(high - low + 1)}))::INTEGER"


def _transactions() -> str:
    odd = f"{_draw('5|odd', 0, 'event_id')} < {_num(0.01)}"
    return f"""
    txns AS (
      SELECT event_id AS txn_id, user_id AS customer_id,
             CASE WHEN {odd} THEN value * {_num(12)} ELSE value END AS amount,
             ({odd})::BIGINT AS is_anomaly
      FROM events)"""


def _customers() -> str:
    def copied(i: int) -> str:
        return _draw("17|copy", i, "e", "copy")

    many = _draw("17|copies", 1, "doc_id")
    return f"""
    entities AS (
      SELECT doc_id AS e, regexp_replace(substr(text, 1, 14), '[^A-Za-z ]', '', 'g') AS name,
             substr(text, 20, 8) || '@' || lang AS email,
             n_chars::VARCHAR AS phone, lang || '-' || source AS city,
             CASE WHEN {_draw("17|copies", 0, "doc_id")} < {_num(0.25)}
                  THEN {_whole(many, 1, COPY_SLOTS - 1)} ELSE 0 END AS copies
      FROM documents),
    copies AS (
      SELECT *, unnest(range(copies + 1)) AS copy FROM entities),
    drawn AS (
      SELECT *, {copied(0)} AS style, {copied(2)} AS mail, {copied(3)} AS tel,
             (2 + floor({copied(1)} * (length(name) - 2)))::INTEGER AS p
      FROM copies),
    customers AS (
      SELECT (e * {COPY_SLOTS} + copy)::BIGINT AS record_id,
             CASE WHEN copy = 0 OR length(name) < 3 THEN name
                  WHEN style < {_num(0.4)} THEN substr(name, 1, p) || substr(name, p)
                  WHEN style < {_num(0.7)}
                    THEN substr(name, 1, p - 1) || substr(name, p + 1, 1) || substr(name, p, 1)
                         || substr(name, p + 2)
                  ELSE upper(name) END AS name,
             CASE WHEN copy = 0 THEN email WHEN mail < {_num(0.1)} THEN NULL
                  WHEN mail < {_num(0.3)} THEN ''
                  WHEN mail < {_num(0.6)} THEN ' ' || upper(email) || ' '
                  ELSE email END AS email,
             CASE WHEN copy = 0 THEN phone WHEN tel < {_num(0.1)} THEN ''
                  WHEN tel < {_num(0.35)} THEN '(' || phone || ')'
                  ELSE phone END AS phone,
             city, e::BIGINT AS true_entity_id
      FROM drawn)"""


_FIELDS = ("name", "email", "phone", "city")


def _digits(side: str) -> str:
    return f"regexp_replace({side}, '\\D', '', 'g')"


def _same(email: tuple[str, str], phone: tuple[str, str], blank_emails: bool) -> dict[str, str]:
    a, b = (f"lower(trim({e}))" for e in email)
    p, q = (_digits(x) for x in phone)
    blank = "" if blank_emails else f" AND {a} <> ''"
    return {"email": f"({a} = {b}{blank})", "phone": f"({p} = {q} AND {p} <> '')"}


def _pairs(evidence: tuple[str, ...] = ()) -> str:
    """Pairs of a block, or those of them that agree on some evidence."""
    same = _same(("a.email", "b.email"), ("a.phone", "b.phone"), False)
    condition = " OR ".join(same[f] for f in evidence) or "true"
    carried = ", ".join(f"a.{f} AS {f}_a, b.{f} AS {f}_b" for f in _FIELDS)
    return f"""
    keyed AS (
      SELECT *, concat_ws('|', substr(lower(name), 1, 1), substr(lower(city), 1, 3)) AS block
      FROM customers),
    pairs AS (
      SELECT a.record_id AS record_id_a, b.record_id AS record_id_b, {carried}
      FROM keyed a JOIN keyed b ON a.block = b.block AND a.record_id < b.record_id
      WHERE {condition})"""


def _features(blank_emails: bool = False) -> str:
    def similarity(f: str) -> str:
        a, b = f"lower(trim({f}_a))", f"lower(trim({f}_b))"
        longer = f"greatest(length({a}), length({b}))"
        return (
            f"CASE WHEN {a} IS NULL OR {b} IS NULL THEN {_num(0)} WHEN {longer} = 0 THEN {_num(1)} "
            f"ELSE {_num(1)} - levenshtein({a}, {b})::DOUBLE / {longer}::DOUBLE END"
        )

    same = _same(("email_a", "email_b"), ("phone_a", "phone_b"), blank_emails)
    return f"""
    features AS (
      SELECT record_id_a, record_id_b,
             {similarity("name")} AS name_sim, {similarity("city")} AS city_sim,
             coalesce({same["email"]}, false)::INTEGER::DOUBLE AS email_exact,
             coalesce({same["phone"]}, false)::INTEGER::DOUBLE AS phone_exact
      FROM pairs)"""


def _scored(weights: dict[str, float], threshold: float, total: float) -> str:
    blend = _num(0)
    for feature, weight in weights.items():
        blend = f"({blend} + {_num(weight)} * {feature})"
    return f"""
    scored AS (
      SELECT record_id_a, record_id_b, {blend} / {_num(total)} AS match_score,
             {blend} / {_num(total)} >= {_num(threshold)} AS is_match
      FROM features)"""


def _closure() -> str:
    return """
    edges AS (
      SELECT record_id_a AS x, record_id_b AS y FROM scored WHERE is_match
      UNION ALL SELECT record_id_b, record_id_a FROM scored WHERE is_match),
    reach AS (
      SELECT record_id AS x, record_id AS y FROM customers
      UNION SELECT reach.x, edges.y FROM reach JOIN edges ON reach.y = edges.x),
    clusters AS (SELECT x AS record_id, min(y) AS entity_id FROM reach GROUP BY x)"""


def _z(x: str, mean: str, spread: str) -> str:
    return (
        f"CASE WHEN {spread} IS NULL OR {spread} = 0 THEN {_num(0)} "
        f"ELSE abs(({x} - {mean}) / {spread}) END"
    )


def _zscore(table: str, x: str, columns: str, threshold: float) -> str:
    return f"""
    WITH s AS (SELECT avg({x}) AS mu, stddev_samp({x}) AS sd FROM {table}),
    z AS (SELECT {columns}, {_z(x, "mu", "sd")} AS score FROM {table}, s)
    SELECT {columns}, round(score, 6) AS anomaly_score FROM z WHERE score > {_num(threshold)}"""


def _gauss(table: str, x: str, group: str, columns: str, threshold: float) -> str:
    return f"""
    WITH s AS (
      SELECT {columns}, avg({x}) OVER (PARTITION BY {group}) AS mu,
             stddev_samp({x}) OVER (PARTITION BY {group}) AS sd
      FROM {table}),
    z AS (SELECT {columns}, {_z(x, "mu", "sd")} AS score FROM s)
    SELECT {columns}, round(score, 6) AS anomaly_score FROM z WHERE score > {_num(threshold)}"""


def _iqr(table: str, x: str, columns: str, k: float) -> str:
    return f"""
    WITH s AS (
      SELECT quantile_disc({x}, 0.25)::DOUBLE AS q1, quantile_disc({x}, 0.75)::DOUBLE AS q3
      FROM {table}),
    z AS (
      SELECT {columns}, CASE WHEN q3 - q1 <= 0 THEN {_num(0)} ELSE greatest({_num(0)},
               ((q1 - {_num(k)} * (q3 - q1)) - {x}::DOUBLE) / (q3 - q1),
               ({x}::DOUBLE - (q3 + {_num(k)} * (q3 - q1))) / (q3 - q1)) END AS score
      FROM {table}, s)
    SELECT {columns}, round(score, 6) AS anomaly_score FROM z WHERE score > 0"""


def _measures(tp: str, fp: str, fn: str, kind: str, source: str, sizes: str) -> str:
    return f"""
    counts AS (SELECT {tp} AS tp, {fp} AS fp, {fn} AS fn FROM {source}),
    ratios AS (
      SELECT tp, fp, fn,
             CASE WHEN tp + fp = 0 THEN {_num(0)} ELSE tp::DOUBLE / (tp + fp)::DOUBLE END AS p,
             CASE WHEN tp + fn = 0 THEN {_num(0)} ELSE tp::DOUBLE / (tp + fn)::DOUBLE END AS r
      FROM counts),
    quality AS (
      SELECT {sizes}, tp::{kind} AS tp, fp::{kind} AS fp, fn::{kind} AS fn,
             round(p, 6) AS precision, round(r, 6) AS recall,
             round(CASE WHEN p + r = 0 THEN {_num(0)} ELSE 2 * p * r / (p + r) END, 6) AS f1,
             (tp + fn)::{kind} AS support
      FROM ratios)"""


def _flag_quality(truth: str, label: str, key: str, flagged: str) -> str:
    counted = f"""
    judged AS (
      SELECT t.{label} AS label, f.{key} IS NOT NULL AS hit
      FROM {truth} t LEFT JOIN (SELECT DISTINCT {key} FROM ({flagged})) f USING ({key}))"""
    return counted + "," + _measures(
        "count(*) FILTER (hit AND label = 1)",
        "count(*) FILTER (hit AND label = 0)",
        "count(*) FILTER (NOT hit AND label = 1)",
        "BIGINT",
        "judged",
        f"(SELECT count(*) FROM {truth}) AS n_rows, (SELECT count(*) FROM ({flagged})) AS n_flagged",
    )


_GLOBAL_FLAGS = f"""
    SELECT txn_id FROM txns, (SELECT avg(amount) AS mu, stddev_samp(amount) AS sd FROM txns)
    WHERE {_z("amount", "mu", "sd")} > 3"""
_GROUP_FLAGS = f"""
    SELECT txn_id FROM (
      SELECT *, avg(amount) OVER (PARTITION BY customer_id) AS mu,
             stddev_samp(amount) OVER (PARTITION BY customer_id) AS sd FROM txns)
    WHERE {_z("amount", "mu", "sd")} > 3"""


def _default_scores(threshold: float = 0.6, blank_emails: bool = False) -> str:
    return ",".join(
        [
            _customers(),
            _pairs(),
            _features(blank_emails),
            _scored(DEFAULT_WEIGHTS, threshold, 1.0),
        ]
    )


def _custom_scores() -> str:
    return ",".join(
        [
            _customers(),
            _pairs(),
            _features(),
            _scored(CUSTOM_WEIGHTS, CUSTOM_THRESHOLD, sum(CUSTOM_WEIGHTS.values())),
        ]
    )


def _pair_quality() -> str:
    def total(keys: str) -> str:
        return (
            f"(SELECT coalesce(sum(n * (n - 1) // 2), 0) FROM "
            f"(SELECT count(*)::HUGEINT AS n FROM labelled GROUP BY {keys}))"
        )

    both, predicted, actual = (
        total(k) for k in ("entity_id, true_entity_id", "entity_id", "true_entity_id")
    )
    return """
    labelled AS (SELECT * FROM clusters JOIN customers USING (record_id)),""" + _measures(
        both,
        f"{predicted} - {both}",
        f"{actual} - {both}",
        "DECIMAL(38,0)",
        "(SELECT 1)",
        "(SELECT count(*) FROM labelled) AS n_records,"
        " (SELECT count(DISTINCT entity_id) FROM labelled) AS n_entities",
    )


_CONTINGENCY = """
    joint AS (
      SELECT entity_id, true_entity_id AS true_id, count(*) AS n
      FROM clusters JOIN customers USING (record_id) GROUP BY ALL)"""


def _cluster_quality() -> str:
    return f"""{_CONTINGENCY}
    SELECT entity_id, sum(n) OVER e::BIGINT AS n_records, count(*) OVER e AS n_true, true_id, n AS n_shared,
           (SELECT sum(n) FROM joint o WHERE o.true_id = j.true_id)::BIGINT AS n_actual,
           round(n::DOUBLE / sum(n) OVER e, 6) AS purity,
           round(n::DOUBLE / (SELECT sum(n) FROM joint o WHERE o.true_id = j.true_id), 6) AS completeness
    FROM joint j
    WINDOW e AS (PARTITION BY entity_id)
    QUALIFY row_number() OVER (PARTITION BY entity_id ORDER BY n DESC, true_id) = 1"""


def _partition_quality() -> str:
    return f"""{_CONTINGENCY},
    e AS (SELECT sum(n) AS n, max(n) AS most FROM joint GROUP BY entity_id),
    t AS (SELECT sum(n) AS n, max(n) AS most FROM joint GROUP BY true_id),
    total AS (SELECT sum(n)::DOUBLE AS n FROM joint),
    h AS (
      SELECT (SELECT -sum(e.n / total.n * ln(e.n / total.n)) FROM e, total) AS he,
             (SELECT -sum(t.n / total.n * ln(t.n / total.n)) FROM t, total) AS ht,
             (SELECT -sum(j.n / total.n * ln(j.n / total.n)) FROM joint j, total) AS hj),
    v AS (SELECT 1 - (hj - he) / ht AS homogeneity, 1 - (hj - ht) / he AS completeness FROM h)
    SELECT total.n::BIGINT AS n_records, (SELECT count(*) FROM e) AS n_entities,
           (SELECT count(*) FROM t) AS n_true,
           round((SELECT sum(most) FROM e) / total.n, 6) AS purity,
           round((SELECT sum(most) FROM t) / total.n, 6) AS inverse_purity,
           round(homogeneity, 6) AS homogeneity, round(completeness, 6) AS completeness,
           round(2 * homogeneity * completeness / (homogeneity + completeness), 6) AS v_measure
    FROM total, v"""


_SCORE_COLUMNS = "record_id_a, record_id_b, round(match_score, 6) AS match_score, is_match"


def _card(name: str, n_in: str, n_out: str, quality: str) -> str:
    return f"""
    SELECT '{name}' AS capability, ({n_in}) AS n_in, ({n_out}) AS n_out,
           precision, recall, f1, support::DECIMAL(38,0) AS support FROM ({quality})"""


def _scorecard() -> str:
    def flags(name: str, flagged: str) -> str:
        quality = f"WITH {_flag_quality('txns', 'is_anomaly', 'txn_id', flagged)} SELECT * FROM quality"
        return _card(
            name, "SELECT count(*) FROM txns", f"SELECT count(*) FROM ({flagged})", quality
        )

    pairs = f"WITH {_pair_quality()} SELECT * FROM quality"
    return (
        f"WITH RECURSIVE {_transactions()}, {_default_scores()}, {_closure()}"
        + flags("zscore", _GLOBAL_FLAGS)
        + " UNION ALL "
        + flags("gaussian", _GROUP_FLAGS)
        + " UNION ALL "
        + _card(
            "resolution",
            "SELECT count(*) FROM customers",
            "SELECT count(DISTINCT entity_id) FROM clusters",
            pairs,
        )
    )


def oracles() -> dict[str, str]:
    """Query name to SQL; approximate queries have none."""
    zscore = _zscore("events", "value", "event_id, value", 3)
    iqr = _iqr("events", "value", "event_id, value", 1.5)
    gauss = _gauss("events", "value", "user_id", "event_id, user_id, value", 3)
    labels = _flag_quality(
        "(SELECT doc_id, (quality = 0)::INTEGER AS low_quality FROM labels)",
        "low_quality",
        "doc_id",
        _zscore("documents", "n_chars", "doc_id, n_chars", 2),
    )
    evidence = ("email", "phone")
    clusters = f"{_closure()} SELECT record_id, entity_id FROM clusters"
    return {
        "zscore_events": zscore,
        "zscore_documents_t2": _zscore("documents", "n_chars", "doc_id, n_chars", 2),
        "iqr_events": iqr,
        "iqr_documents_k3": _iqr("documents", "n_chars", "doc_id, n_chars", 3),
        "gauss_events_user": gauss,
        "gauss_events_type": _gauss(
            "events", "value", "event_type", "event_id, event_type, value", 3
        ),
        "gauss_lineitem_supp_t15": _gauss(
            "lineitem",
            "l_extendedprice",
            "l_suppkey",
            "l_orderkey, l_linenumber, l_suppkey, l_extendedprice",
            1.5,
        ),
        "multi_detect_events": " UNION ALL ".join(
            f"SELECT '{name}' AS detector, count(*) AS n_flagged FROM ({sql})"
            for name, sql in (("zscore", zscore), ("iqr", iqr), ("gaussian", gauss))
        ),
        "flag_totals_events": " UNION ALL ".join(
            f"SELECT '{name}' AS detector, count(*) AS n_flagged FROM ({sql})"
            for name, sql in (
                ("zscore", _zscore("events", "value", "event_id, value", 2)),
                ("iqr", iqr),
            )
        ),
        "iqr_approximate_ranks": """
            SELECT count(value) AS n_values, true AS q1_within, true AS q3_within FROM events""",
        "zscore_constant": f"""
            WITH s AS (SELECT avg(l_tax * 0 + 5) AS mu, stddev_samp(l_tax * 0 + 5) AS sd
                       FROM lineitem),
            z AS (SELECT {_z("(l_tax * 0 + 5)", "mu", "sd")} AS score FROM lineitem, s)
            SELECT count(*) AS n_scored, count(*) FILTER (score > 2) AS n_flagged,
                   max(score) AS top_score FROM z""",
        "gauss_singletons": f"""
            WITH s AS (
              SELECT o_totalprice, avg(o_totalprice) OVER (PARTITION BY o_orderkey) AS mu,
                     stddev_samp(o_totalprice) OVER (PARTITION BY o_orderkey) AS sd
              FROM orders),
            z AS (SELECT {_z("o_totalprice", "mu", "sd")} AS score FROM s)
            SELECT count(*) AS n_scored, count(*) FILTER (score > 3) AS n_flagged,
                   max(score) AS top_score FROM z""",
        "labelled_transactions": f"""
            WITH {_transactions()}
            SELECT txn_id, customer_id, round(amount, 6) AS amount, is_anomaly FROM txns""",
        "flag_metrics_zscore": f"""
            WITH {_transactions()}, {_flag_quality("txns", "is_anomaly", "txn_id", _GLOBAL_FLAGS)}
            SELECT * FROM quality""",
        "flag_metrics_gaussian": f"""
            WITH {_transactions()}, {_flag_quality("txns", "is_anomaly", "txn_id", _GROUP_FLAGS)}
            SELECT * FROM quality""",
        "flag_metrics_labels": f"WITH {labels} SELECT * FROM quality",
        "plant_duplicates": f"WITH {_customers()} SELECT * FROM customers",
        "block_sizes": f"""
            WITH {_customers()}, sizes AS (
              SELECT concat_ws('|', substr(lower(name), 1, 1), substr(lower(city), 1, 3)) AS block_key,
                     count(*) AS n FROM customers GROUP BY 1)
            SELECT block_key, n AS n_records, (n * (n - 1) // 2)::DECIMAL(38,0) AS n_pairs
            FROM sizes""",
        "candidate_pairs": f"WITH {_customers()}, {_pairs(evidence)} SELECT * FROM pairs",
        "pair_features": f"""
            WITH {_customers()}, {_pairs(evidence)}, {_features()}
            SELECT record_id_a, record_id_b, round(name_sim, 6) AS name_sim,
                   round(city_sim, 6) AS city_sim, email_exact, phone_exact FROM features""",
        "match_scores": f"""
            WITH {_customers()}, {_pairs(evidence)}, {_features()},
            {_scored(DEFAULT_WEIGHTS, 0.6, 1.0)} SELECT {_SCORE_COLUMNS} FROM scored""",
        "matches": f"WITH {_default_scores()} SELECT {_SCORE_COLUMNS} FROM scored WHERE is_match",
        "matches_low_threshold": f"""
            WITH {_default_scores(LOW_THRESHOLD)} SELECT {_SCORE_COLUMNS} FROM scored
            WHERE is_match""",
        "matches_custom_weights": f"""
            WITH {_custom_scores()} SELECT {_SCORE_COLUMNS} FROM scored WHERE is_match""",
        "entity_clusters": f"WITH RECURSIVE {_default_scores()}, {clusters}",
        "entity_clusters_blank_emails": f"""
            WITH RECURSIVE {_default_scores(blank_emails=True)}, {clusters}""",
        "entity_clusters_custom_weights": f"WITH RECURSIVE {_custom_scores()}, {clusters}",
        "components_matches": f"WITH RECURSIVE {_default_scores()}, {clusters}",
        "components_chain": f"""
            SELECT o_orderkey, o_orderkey - o_orderkey % {CHAIN} AS entity_id FROM orders""",
        "components_shuffled_path": f"""
            SELECT o_orderkey, o_orderkey - o_orderkey % {CHAIN} AS entity_id FROM orders""",
        "components_hub": """
            SELECT o_orderkey, min(o_orderkey) OVER (PARTITION BY o_orderpriority) AS entity_id
            FROM orders""",
        "pairwise_metrics": f"""
            WITH RECURSIVE {_default_scores()}, {_closure()}, {_pair_quality()}
            SELECT * FROM quality""",
        "scorecard": _scorecard(),
        "moments_events_merged": """
            SELECT event_type, count(value) AS n, round(avg(value), 6) AS mean,
                   round(stddev_samp(value), 6) AS spread FROM events GROUP BY event_type""",
        "zscore_events_merged": zscore,
        "gauss_events_user_merged": gauss,
        "quartiles_merged_sketches": """
            SELECT event_type, count(value) AS n_values, true AS q1_within, true AS q3_within
            FROM events GROUP BY event_type""",
        "zscore_clicks_source": _zscore(
            "(SELECT * FROM events WHERE event_type = 'click')", "value", "event_id, value", 2
        ),
        "entity_clusters_similar_names": f"""
            WITH RECURSIVE {_default_scores(NAMES_THRESHOLD)}, {clusters}""",
        "entity_clusters_batches": f"WITH RECURSIVE {_default_scores()}, {clusters}",
        "pairwise_metrics_merged": f"""
            WITH RECURSIVE {_default_scores()}, {_closure()}, {_pair_quality()}
            SELECT * FROM quality""",
        "cluster_measures_merged": f"""
            WITH RECURSIVE {_default_scores()}, {_closure()}, {_cluster_quality()}""",
        "partition_measures_merged": f"""
            WITH RECURSIVE {_default_scores()}, {_closure()}, {_partition_quality()}""",
    }
