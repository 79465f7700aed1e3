"""The registered queries of this folder and the SQL that some of them can be held against."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quillstone.llm import ann, bpe, curve, fingerprint, interactions, langid, linededup, packing, periodic, pii, secrets, simhash, warc
from quillstone.llm.shared import table


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op2_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"))


def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.edit_report(table(spark, sf_dir, "documents"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify_documents(table(spark, sf_dir, "documents"), carry=["doc_id"])


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linededup.digest(table(spark, sf_dir, "documents"))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.groups(table(spark, sf_dir, "documents"))


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.scan(table(spark, sf_dir, "documents"))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"))


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(table(spark, sf_dir, "documents"))


def op11_curve_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curve.pack_along_curve(table(spark, sf_dir, "documents"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.digest(table(spark, sf_dir, "documents"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return interactions.filter_audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def pages_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify_pages(table(spark, sf_dir, "pages"), table(spark, sf_dir, "documents"), carry=["page_id"])


QUERIES = {f.__name__: f for f in (op1_packing, op2_nearest, op3_fingerprints, op4_language_id, op5_line_dedup, op6_simhash, op7_pii, op8_warc, op9_bpe, op10_secrets, op11_curve_packing, op12_periodic_runs, op13_filter_audit, pages_language_id)}

_OP5 = r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents
), keyed AS (
  SELECT doc_id, line, pos,
         translate(regexp_replace(regexp_replace(line, '^[\x20\x09-\x0D]+', ''), '[\x20\x09-\x0D]+$', ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines
), frequent AS (
  SELECT key, max(doc_id) AS last FROM keyed WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5
)
SELECT k.doc_id, count(*) AS n_lines, count(*) FILTER (WHERE f.last <> k.doc_id) AS n_dropped,
       sha256(coalesce(string_agg(k.line, chr(10) ORDER BY k.pos) FILTER (WHERE f.last IS NULL OR f.last = k.doc_id), '')) AS kept_sha256
FROM keyed k LEFT JOIN frequent f ON k.key = f.key GROUP BY k.doc_id
"""

_OP8 = """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, unhex(sha1(coalesce(html, ''))) AS d, max(page_id) OVER (PARTITION BY coalesce(html, '')) AS winner
  FROM pages
), groups AS (
  SELECT *, range(0, 32) AS places FROM p
)
SELECT page_id, payload_bytes,
       list_aggregate(list_transform(places, lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST(('0b' || substr(CAST(CAST(d AS BIT) AS VARCHAR), 1 + 5 * i, 5))::INT AS INT), 1)), 'string_agg', '') AS payload_digest,
       CASE WHEN page_id = winner THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = winner THEN NULL ELSE winner END AS refers_to
FROM groups
"""

_OP13 = r"""
WITH texts AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text FROM documents
), words AS (
  SELECT *, list_filter(string_split_regex(text, '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w, min(doc_id) OVER (PARTITION BY text) AS first FROM texts
), fails AS (
  SELECT part, doc_id,
         CASE WHEN len(w) < 100 THEN 1 ELSE 0 END + CASE WHEN 100 * len(list_distinct(w)) < 80 * len(w) THEN 2 ELSE 0 END
         + CASE WHEN 100 * (length(text) - length(regexp_replace(text, '[A-Z]', '', 'g'))) > 10 * length(text) THEN 4 ELSE 0 END
         + CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 8 ELSE 0 END + CASE WHEN doc_id > first THEN 16 ELSE 0 END AS mask
  FROM words
), marks AS (
  SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY doc_id
), patterns AS (
  SELECT part, mask, count(*) AS n, sum(coalesce(good, 0)) AS good, sum(coalesce(toxic, 0)) AS toxic FROM fails LEFT JOIN marks USING (doc_id) GROUP BY part, mask
), letters AS (
  SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x, unnest([1, 2, 4, 8, 16]) AS bit
), orders AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
  FROM letters a JOIN letters b ON b.x <> a.x JOIN letters c ON c.x NOT IN (a.x, b.x) JOIN letters d ON d.x NOT IN (a.x, b.x, c.x) JOIN letters e ON e.x NOT IN (a.x, b.x, c.x, d.x)
), steps AS (
  SELECT filter_order, k AS step, bits[k] AS bit, CAST(coalesce(list_sum(bits[1:k - 1]), 0) AS INT) AS before FROM orders, (SELECT unnest(range(1, 6)) AS k)
), counted AS (
  SELECT part, filter_order, step, bit,
         coalesce(sum(n) FILTER (WHERE mask & (before | bit) = 0), 0) AS kept, coalesce(sum(n) FILTER (WHERE mask & before = 0 AND mask & bit <> 0), 0) AS removed,
         coalesce(sum(n) FILTER (WHERE mask & before <> 0 AND mask & bit <> 0), 0) AS redundant, coalesce(sum(n) FILTER (WHERE mask = bit), 0) AS unique_fails,
         coalesce(sum(good) FILTER (WHERE mask & before = 0 AND mask & bit <> 0), 0) AS good_lost, coalesce(sum(toxic) FILTER (WHERE mask & before = 0 AND mask & bit <> 0), 0) AS toxic_lost
  FROM patterns, steps GROUP BY part, filter_order, step, bit
)
SELECT part, filter_order, CAST(step AS INT) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
       CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley
FROM counted
"""

ORACLE_SQL = {"op5_line_dedup": _OP5, "op8_warc": _OP8, "op13_filter_audit": _OP13}
