"""SQL for the operators that it can express, in the dialect of DuckDB."""

from __future__ import annotations

from recordlens.llm.licenses import LICENSE_FILE_TERMS, TEMPLATES, THRESHOLD, TRIGGERS, python_terms
from recordlens.llm.quality_rules import BOILERPLATE, LineRules

GAP = r"[\x20\x09-\x0D]+"
WORDS = f"""
    SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '{GAP}'), lambda w: w <> '') AS ws
    FROM documents
"""


def substring_dedup(width: int = 20) -> str:
    return f"""
WITH d AS ({WORDS}),
word AS (
    SELECT doc_id, unnest(ws) AS w, unnest(range(len(ws))) AS i FROM d
),
win AS (
    SELECT doc_id, i, array_to_string(ws[i + 1:i + {width}], ' ') AS s
    FROM (SELECT doc_id, ws, unnest(range(len(ws) - {width - 1})) AS i FROM d WHERE len(ws) >= {width})
),
later AS (
    SELECT doc_id, i
    FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY s ORDER BY doc_id, i) AS k FROM win)
    WHERE k > 1
),
gone AS (
    SELECT DISTINCT doc_id, i + j AS i FROM later, range({width}) AS r(j)
),
kept AS (
    SELECT doc_id, string_agg(w, ' ' ORDER BY i) AS text, count(*) AS n
    FROM word ANTI JOIN gone USING (doc_id, i)
    GROUP BY doc_id
)
SELECT d.doc_id, len(ws)::BIGINT AS n_words, (len(ws) - coalesce(kept.n, 0))::BIGINT AS n_removed,
    sha256(coalesce(kept.text, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""


def sharding(max_bytes: int) -> str:
    return f"""
WITH d AS (
    SELECT doc_id, strlen(coalesce(text, ''))::BIGINT AS n_bytes,
        ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS bits
    FROM documents
),
node AS (
    SELECT depth, bits >> (60 - depth) AS node, sum(n_bytes)::BIGINT AS shard_bytes,
        count(*) AS shard_docs
    FROM d, range(0, 60) AS r(depth)
    GROUP BY ALL
),
fit AS (
    SELECT * FROM node WHERE shard_bytes <= {max_bytes} OR shard_docs = 1
),
placed AS (
    SELECT doc_id, n_bytes, bits, min(depth) AS depth
    FROM d JOIN fit ON d.bits >> (60 - fit.depth) = fit.node
    GROUP BY ALL
)
SELECT doc_id, n_bytes, substr(lpad(bin(bits), 60, '0'), 1, depth::INT) AS shard,
    depth::INT AS depth, shard_bytes, shard_docs
FROM placed JOIN fit USING (depth) WHERE placed.bits >> (60 - depth) = fit.node
"""


def near_dedup(percent: int = 85) -> str:
    lower = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"""
WITH RECURSIVE d AS (
    SELECT doc_id, list_filter(regexp_split_to_array({lower}, '{GAP}'), lambda w: w <> '') AS ws
    FROM documents
),
shingle AS (
    SELECT DISTINCT doc_id, array_to_string(ws[i + 1:i + 5], ' ') AS s
    FROM (
        SELECT doc_id, ws, unnest(range(greatest(len(ws) - 4, 1))) AS i FROM d WHERE len(ws) > 0
    )
),
size AS (SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id),
shared AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n
    FROM shingle a JOIN shingle b ON a.s = b.s AND a.doc_id < b.doc_id
    GROUP BY ALL
),
link AS (
    SELECT a, b FROM shared JOIN size x ON x.doc_id = a JOIN size y ON y.doc_id = b
    WHERE 100 * shared.n >= {percent} * (x.n + y.n - shared.n)
),
edge AS (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
reach AS (
    SELECT doc_id AS a, doc_id AS b FROM documents
    UNION
    SELECT reach.a, edge.b FROM reach JOIN edge ON reach.b = edge.a
),
component AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept
FROM component LEFT JOIN size USING (doc_id)
"""


def quality_rules(rules: LineRules = LineRules()) -> str:
    phrases = " OR ".join(f"contains(lower(line), '{p}')" for p in BOILERPLATE)

    def found(text: str, pattern: str) -> str:
        return f"(length({text}) - length(regexp_replace({text}, '{pattern}', '', 'g')))"

    marks, bars = found("line", "[#*$%&<>!=~^_]+"), found("line", "[|]+")
    return f"""
WITH d AS ({WORDS}),
win AS (
    SELECT doc_id, i, ws[i + 1] || ' ' || ws[i + 2] || ' ' || ws[i + 3] AS s
    FROM (SELECT doc_id, ws, unnest(range(len(ws) - 2)) AS i FROM d WHERE len(ws) >= 3)
),
again AS (
    SELECT doc_id, count(DISTINCT i + j) AS n
    FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, s) AS k FROM win), range(3) AS r(j)
    WHERE k > 1
    GROUP BY doc_id
),
line AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line FROM documents),
lines AS (
    SELECT doc_id,
        count(*) FILTER (worded) - count(DISTINCT line) FILTER (worded) AS n_dup,
        coalesce(sum(length(regexp_replace(line, '{GAP}', '', 'g'))) FILTER (fails), 0) AS lost
    FROM (
        SELECT doc_id, line, regexp_matches(line, '[^\\x20\\x09-\\x0D]') AS worded,
            (length(line) <= {rules.boilerplate_chars} AND ({phrases}))
            OR ({marks} >= {rules.least_marks} AND {marks} * 100 >= length(line) * {rules.marks})
            OR ({bars} >= {rules.least_bars} AND {bars} * 100 >= length(line) * {rules.bars}) AS fails
        FROM line
    )
    GROUP BY doc_id
),
measured AS (
    SELECT d.doc_id, len(ws)::BIGINT AS n_words,
        length(array_to_string(ws, ''))::BIGINT AS word_chars,
        {found("coalesce(text, '')", "[#*$%&|<>]+")}::BIGINT AS n_symbols,
        n_dup::BIGINT AS n_dup_lines, coalesce(again.n, 0)::BIGINT AS n_repeat_words,
        lost::BIGINT AS lost_chars
    FROM d JOIN documents USING (doc_id) JOIN lines USING (doc_id) LEFT JOIN again USING (doc_id)
)
SELECT *, n_words < {rules.least_words} OR 100 * n_repeat_words > {rules.repeated} * n_words AS base_failed,
    NOT (n_words < {rules.least_words} OR 100 * n_repeat_words > {rules.repeated} * n_words)
    AND 100 * lost_chars <= {rules.lost} * word_chars AS kept
FROM measured
"""


def license_scan() -> str:
    templates = ", ".join(
        f"({i}, '{name}', {[*python_terms(notice)]})" for i, (name, notice) in enumerate(TEMPLATES)
    )
    trigger = " OR ".join(f"contains(lower({{0}}), '{t}')" for t in TRIGGERS)

    def terms(text: str) -> str:
        cut = f"regexp_split_to_array(lower({text}), '[^a-z0-9.\\-]+')"
        return (
            f"list_distinct(list_filter(list_transform({cut},"
            " lambda t: regexp_replace(t, '^[.\\-]+|[.\\-]+$', '', 'g')), lambda t: t <> ''))"
        )

    return f"""
WITH file AS (
    SELECT doc_id, coalesce(text, '') AS text,
        source || '/' || lang || '/' || (doc_id // 1000) AS dir,
        {terms("coalesce(text, '')")} AS terms
    FROM documents
),
template(template, license, terms) AS (VALUES {templates}),
vocabulary AS (SELECT DISTINCT unnest(terms) AS term FROM template),
counted AS (
    SELECT term, count(*) AS n FROM (SELECT unnest(terms) AS term FROM file)
    WHERE term IN (SELECT term FROM vocabulary) GROUP BY term
),
weight AS (
    SELECT term, ln((1 + (SELECT count(*) FROM file)) / (1 + coalesce(n, 0))) + 1 AS weight
    FROM vocabulary LEFT JOIN counted USING (term)
),
other AS (SELECT ln((1 + (SELECT count(*) FROM file)) / 2) + 1 AS other),
passage AS (
    SELECT doc_id, terms, row_number() OVER () AS passage FROM (
        SELECT doc_id, {terms("line")} AS terms
        FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM file)
        WHERE {trigger.format("line")}
        UNION ALL
        SELECT doc_id, terms FROM file
        WHERE len(terms) <= {LICENSE_FILE_TERMS} AND ({trigger.format("text")})
    )
),
term AS (
    SELECT passage, term, coalesce(weight, other) AS weight
    FROM (SELECT passage, unnest(terms) AS term FROM passage) LEFT JOIN weight USING (term), other
),
length AS (SELECT passage, sqrt(sum(weight ** 2)) AS length FROM term GROUP BY passage),
tt AS (SELECT template, license, unnest(terms) AS term FROM template),
norm AS (
    SELECT template, sqrt(sum(weight ** 2)) AS norm FROM tt JOIN weight USING (term) GROUP BY template
),
scored AS (
    SELECT passage, template, license, round(sum(weight ** 2) / any_value(norm) / any_value(length), 6) AS score
    FROM term JOIN tt USING (term) JOIN norm USING (template) JOIN length USING (passage)
    GROUP BY passage, template, license
),
best AS (
    SELECT doc_id, license, score FROM (
        SELECT doc_id, license, score,
            row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, template) AS k
        FROM scored JOIN passage USING (passage)
    ) WHERE k = 1 AND score >= {THRESHOLD}
),
stated AS (
    SELECT dir, min(license) AS license, max(score) AS score FROM (
        SELECT dir, license, score, max(score) OVER (PARTITION BY dir) AS top
        FROM best JOIN file USING (doc_id) WHERE len(terms) <= {LICENSE_FILE_TERMS}
    ) WHERE score = top GROUP BY dir
)
SELECT doc_id, dir || '/' || doc_id || '.txt' AS path, coalesce(best.license, stated.license) AS license,
    coalesce(best.score, stated.score) AS score,
    CASE WHEN best.license IS NOT NULL THEN 'own' WHEN stated.license IS NOT NULL THEN 'inherited'
        ELSE 'none' END AS origin,
    CASE WHEN best.license IS NULL AND stated.license IS NOT NULL THEN dir END AS directory
FROM file LEFT JOIN best USING (doc_id) LEFT JOIN stated USING (dir)
"""


def warc(min_bytes: int = 0) -> str:
    # Base32 writes five hexadecimal digits as four characters of five bits.
    base32 = " || ".join(
        f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((('0x' || substr(hex, {1 + 5 * group}, 5))::BIGINT"
        f" >> {15 - 5 * place}) & 31)::BIGINT, 1)"
        for group in range(8)
        for place in range(4)
    )
    return f"""
WITH page AS (
    SELECT page_id, octet_length(encode(coalesce(html, '')))::BIGINT AS n, sha1(coalesce(html, '')) AS hex
    FROM pages
),
ranked AS (SELECT *, max(page_id) OVER (PARTITION BY hex, n) AS first_id FROM page)
SELECT page_id, n AS payload_bytes, {base32} AS payload_digest,
    CASE WHEN n >= {min_bytes} AND page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN n >= {min_bytes} AND page_id <> first_id THEN first_id END AS refers_to,
    NULL::VARCHAR AS problem
FROM ranked
"""


def lexical_search(k: int = 10) -> str:
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

    def terms(text: str) -> str:
        pattern = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
        return f"regexp_extract_all(translate({text}, '{upper}', '{lower}'), '{pattern}')"

    return f"""
WITH doc AS (
    SELECT row_number() OVER () AS d, doc_id, ts, len(ts)::BIGINT AS n
    FROM (SELECT doc_id, coalesce({terms("text")}, []) AS ts FROM documents)
),
total AS (SELECT (count(*) FILTER (n > 0))::BIGINT AS nn, sum(n)::BIGINT AS l FROM doc),
wanted AS (SELECT DISTINCT item_id, t FROM (SELECT item_id, unnest({terms("text")}) AS t FROM benchmark)),
posting AS (
    SELECT d, t, count(*)::BIGINT AS tf FROM (SELECT d, unnest(ts) AS t FROM doc)
    WHERE t IN (SELECT t FROM wanted) GROUP BY d, t
),
weight AS (
    SELECT t, floor(1000 * ln((2 * nn + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w
    FROM (SELECT t, count(*) AS df FROM posting GROUP BY t), total
),
scored AS (
    SELECT item_id, d, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * nn) // l))))::BIGINT AS score
    FROM wanted JOIN weight USING (t) JOIN posting USING (t) JOIN doc USING (d), total GROUP BY item_id, d
),
ranked AS (
    SELECT item_id, doc_id, score,
        row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank
    FROM scored JOIN doc USING (d) WHERE score > 0
)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM ranked WHERE rank <= {k}
"""


def hard_negatives() -> str:
    return """
WITH vec AS (
    SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
pair AS (
    SELECT a.id AS anchor_id, b.id, a.label = b.label AS same, list_dot_product(a.v, b.v)::BIGINT AS score
    FROM vec a JOIN vec b ON a.id % 100 = 0 AND a.id <> b.id
),
near AS (
    SELECT anchor_id, id AS positive_id, score AS positive_score
    FROM (SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) AS k FROM pair WHERE same)
    WHERE k <= 5
),
far AS (
    SELECT anchor_id, positive_id, id AS negative_id, positive_score, score AS negative_score,
        row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id) AS rank
    FROM near JOIN (SELECT * FROM pair WHERE NOT same) USING (anchor_id)
    WHERE 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score
FROM far WHERE rank <= 10
"""


def oracles(shard_bytes: int) -> dict[str, str]:
    """Query name to SQL on the same tables."""
    return {
        "op1_substring_dedup": substring_dedup(),
        "op2_sharding": sharding(shard_bytes),
        "op5_near_dedup": near_dedup(),
        "op7_quality_rules": quality_rules(),
        "op10_license_scan": license_scan(),
        "op11_warc": warc(),
        "op12_lexical_search": lexical_search(),
        "op13_hard_negatives": hard_negatives(),
    }
