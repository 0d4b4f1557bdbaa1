"""The registered queries of this package and the SQL they must equal.

Each query runs its operator with production parameters over the whole table.
Where DuckDB cannot express an operator, `SQL` has no entry and the tests
compare the query with a brute-force version.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from snapkeep.llm import (
    centroids, conversations, decontam, genetic_packing, jaccard, language, packing, quality, repeats, secret_scan, shards, toxicity, url_lists,
)
from snapkeep.llm.frames import read_table, ship_package


def q_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_toxicity(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def q_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan_secrets(read_table(spark, sf_dir, "documents"))


def q_url_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages")
    return url_lists.judge_captures(url_lists.derived_captures(pages), url_lists.derived_entries(pages))


def q_repeat_removal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.repeats_query(read_table(spark, sf_dir, "documents"))


def q_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards.curve_shards(read_table(spark, sf_dir, "documents"))


def q_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(read_table(spark, sf_dir, "documents"))


def q_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify_languages(read_table(spark, sf_dir, "documents"))


def q_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(read_table(spark, sf_dir, "documents"))


def q_benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.leaks(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def q_quality_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_query(read_table(spark, sf_dir, "documents"))


def q_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster_vectors(read_table(spark, sf_dir, "embeddings"))


def q_genetic_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return genetic_packing.pack_documents(read_table(spark, sf_dir, "documents"))


def q_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.repair_conversations(read_table(spark, sf_dir, "conversations"))


def _shipped(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return fn(spark, sf_dir)

    return query


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    name: _shipped(fn)
    for name, fn in {
        "op1_toxicity_fm": q_toxicity,
        "op2_secret_scan": q_secret_scan,
        "op3_url_lists": q_url_lists,
        "op4_repeat_removal": q_repeat_removal,
        "op5_hilbert_shards": q_hilbert_shards,
        "op6_jaccard_join": q_jaccard_join,
        "op7_language_cnn": q_language,
        "op8_packing": q_packing,
        "op9_benchmark_leaks": q_benchmark_leaks,
        "op10_quality_lines": q_quality_lines,
        "op11_centroid_clusters": q_centroid_clusters,
        "op12_genetic_packing": q_genetic_packing,
        "op13_conversation_repair": q_conversation_repair,
    }.items()
}

_WORD = r"[^\x20\x09-\x0D]+"
_LINE_END = r"""[.!?:;,"'')\]}][\x20\x09-\x0D]*$"""

SQL: dict[str, str] = {
    "op3_url_lists": r"""
WITH p AS (
  SELECT page_id, url, DATE '2024-01-01' + CAST((page_id * 7919) % 365 AS INTEGER) AS fetch_day,
         nullif(rtrim(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]+)', 1)), '.'), '') AS host
  FROM pages
),
d AS (
  SELECT regexp_extract(host, '([^.]+\.[^.]+\.[^.]+)$', 1) AS domain, min(page_id) AS k, count(*) AS n
  FROM p GROUP BY 1 HAVING domain LIKE '%-%.%'
),
o AS (SELECT domain, (k * 13) % 120 AS first, 40 + n % 50 AS stay FROM d),
e AS (
  SELECT domain, 'add' AS action, first AS off FROM o
  UNION ALL SELECT domain, 'remove', first + stay FROM o
  UNION ALL SELECT domain, 'add', first + 2 * stay FROM o
),
spans AS (
  SELECT * FROM (
    SELECT 'list-' || substr(domain, 1, 1) AS list, domain, action, DATE '2024-01-01' + CAST(off AS INTEGER) AS valid_from,
           coalesce(lead(DATE '2024-01-01' + CAST(off AS INTEGER)) OVER (PARTITION BY domain ORDER BY off), DATE '9999-12-31') AS valid_to
    FROM e)
  WHERE action = 'add'
),
hits AS (
  SELECT host, fetch_day, string_agg(DISTINCT list, ',' ORDER BY list) AS lists, count(DISTINCT list) AS n
  FROM (SELECT DISTINCT host, fetch_day FROM p) a
  JOIN spans s ON (a.host = s.domain OR ends_with(a.host, '.' || s.domain)) AND fetch_day >= valid_from AND fetch_day < valid_to
  GROUP BY host, fetch_day
)
SELECT page_id, url, fetch_day, host, CAST(coalesce(n, 0) AS INTEGER) AS n_lists, coalesce(lists, '') AS lists,
       lists IS NOT NULL AS blocked
FROM p LEFT JOIN hits USING (host, fetch_day)
""",
    "op10_quality_lines": rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS (
  SELECT doc_id, t, regexp_extract_all(t, '{_WORD}') AS ws, string_split(t, chr(10)) AS ls FROM d
),
tri AS (
  SELECT doc_id, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS g
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM w WHERE len(ws) >= 3)
),
twice AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM tri) WHERE c >= 2),
covered AS (
  SELECT doc_id, count(DISTINCT p) AS n
  FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM twice) GROUP BY doc_id
),
l AS (
  SELECT doc_id, k, ls[k] AS line, len(regexp_extract_all(ls[k], '{_WORD}')) AS n,
         strlen(regexp_replace(ls[k], '[\x20\x09-\x0D]+', '', 'g')) AS size
  FROM (SELECT doc_id, ls, unnest(range(1, len(ls) + 1)) AS k FROM w)
),
judged AS (
  SELECT doc_id, k, line, n, size,
         n > 0 AND (
           NOT regexp_matches(line, '{_LINE_END}')
           OR (length(line) - length(replace(line, '|', '')) >= 3
               AND 4 * (length(line) - length(replace(line, '|', ''))) >= n)
           OR 10 * (length(line) - length(regexp_replace(line, '[#*$%&|<>]', '', 'g'))
                    + (length(line) - length(replace(line, '!!', ''))) // 2) > 3 * n
           OR (n <= {quality.BOILERPLATE_WORDS} AND regexp_matches(line, '{quality.BOILERPLATE}'))
         ) AS failed
  FROM l
),
per AS (
  SELECT doc_id, count(*) FILTER (n > 0) AS n_lines, count(*) FILTER (failed) AS n_failed_lines,
         count(*) FILTER (n > 0) - count(DISTINCT line) FILTER (n > 0) AS n_dup_lines,
         coalesce(sum(size) FILTER (failed), 0) AS lost, sum(size) AS total,
         coalesce(string_agg(line, chr(10) ORDER BY k) FILTER (NOT failed), '') AS clean
  FROM judged GROUP BY doc_id
),
f AS (
  SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words,
         CAST(length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
         CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         coalesce(covered.n, 0) AS n_repeat_words
  FROM w LEFT JOIN covered USING (doc_id)
)
SELECT f.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < {quality.MIN_WORDS} OR 100 * n_repeat_words > {quality.MAX_REPEAT_PERCENT} * n_words AS base_failed,
       NOT (n_words < {quality.MIN_WORDS} OR 100 * n_repeat_words > {quality.MAX_REPEAT_PERCENT} * n_words)
         AND 100 * lost <= {quality.MAX_LOSS_PERCENT} * total AS kept,
       n_lines, n_failed_lines, md5(clean) AS clean_md5
FROM f JOIN per USING (doc_id)
""",
    "op11_centroid_clusters": centroids.clusters_sql(),
    # every 50-byte string with the least document it starts in; runs of strings
    # that start in a later one are the removed spans
    "op4_repeat_removal": r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
-- stretches of 400 strings: taking one string from a long text costs its length
c AS (
  SELECT r, doc_id, base, substr(h, 2 * base + 1, 898) AS h
  FROM (SELECT r, doc_id, h, unnest(range(0, length(h) // 2 - 49, 400)) AS base FROM d WHERE length(h) >= 100)
),
w AS (
  SELECT r, doc_id, base + k AS p, substr(h, 2 * k - 1, 100) AS g
  FROM (SELECT r, doc_id, base, h, unnest(range(1, length(h) // 2 - 48)) AS k FROM c)
),
f AS (SELECT g, min(doc_id) AS m FROM w GROUP BY g),
hit AS (SELECT r, p, lag(p) OVER (PARTITION BY r ORDER BY p) AS b FROM w JOIN f USING (g) WHERE doc_id > m),
run AS (
  SELECT r, min(p) AS a, max(p) + 50 AS z
  FROM (SELECT r, p, sum(CASE WHEN b IS NULL OR p > b + 50 THEN 1 ELSE 0 END) OVER (PARTITION BY r ORDER BY p) AS k FROM hit)
  GROUP BY r, k
),
piece AS (
  SELECT d.r, a, z, substr(h, 2 * before - 1, 2 * (a - before)) AS kept
  FROM (SELECT r, a, z, lag(z, 1, 1) OVER (PARTITION BY r ORDER BY a) AS before FROM run) AS s JOIN d ON d.r = s.r
),
doc AS (
  SELECT r, sum(z - a) AS n_removed, count(*) AS n_spans, max(z) AS tail, string_agg(kept, '' ORDER BY a) AS front FROM piece GROUP BY r
)
SELECT doc_id, CAST(length(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
       sha256(unhex(coalesce(front, '') || substr(h, 2 * coalesce(tail, 1) - 1))) AS kept_sha256
FROM d LEFT JOIN doc ON d.r = doc.r
""",
    # pairs through shared shingles, then everything reachable by links
    "op6_jaccard_join": rf"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_WORD}') AS w
  FROM documents
),
s AS MATERIALIZED (
  SELECT r, doc_id, CASE
    WHEN len(w) = 0 THEN []
    WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS g
  FROM d
),
x AS MATERIALIZED (SELECT r, unnest(g) AS t FROM s),
c AS (SELECT a.r AS a, b.r AS b, count(*) AS n FROM x AS a JOIN x AS b ON a.t = b.t AND a.r < b.r GROUP BY 1, 2),
l AS MATERIALIZED (
  SELECT a, b FROM c JOIN s AS p ON p.r = a JOIN s AS q ON q.r = b WHERE 100 * n >= 80 * (len(p.g) + len(q.g) - n)
),
e AS MATERIALIZED (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
reach AS (SELECT r, r AS z FROM s UNION SELECT reach.r, e.b FROM reach JOIN e ON reach.z = e.a)
SELECT s.doc_id, CAST(len(s.g) AS BIGINT) AS n_shingles, o.component_id
FROM s JOIN (SELECT reach.r, min(doc_id) AS component_id FROM reach JOIN s AS t ON t.r = reach.z GROUP BY reach.r) AS o ON o.r = s.r
""",
}
