"""The queries op1 to op10 over whole tables, and the SQL that DuckDB can run for them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, fingerprints, langid, mixing, ngram_join, packing, quality, secret_scan, token_counts, url_filter
from .common import table


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op2_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.groups(table(spark, sf_dir, "documents"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = langid.train(docs.filter(~langid.held_out()))
    return langid.predict(docs, model).withColumn("held_out", F.coalesce(langid.held_out(), F.lit(False))).select("doc_id", "held_out", "lang_pred", "score")


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda x: x["kind_order"] < len(secret_scan.BASE))

    def text(spans):
        return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")

    def number(kind):
        return F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *(number(kind) for kind, *_ in secret_scan.BASE),
        F.sha2(text(base), 256).alias("base_sha256"),
        text(F.col("spans")).alias("spans"),
    )


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.train(docs, table(spark, sf_dir, "labels").filter(~quality.held_out()))
    scored = quality.score(docs, model).withColumn("held_out", F.coalesce(quality.held_out(), F.lit(False)))
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"), url_filter.rule_table(spark, url_filter.RULES))


def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.compare_edits(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "fingerprint", "edited_fingerprint", "near_edited", "near_next"
    )


def op10_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"), lambda i: i % 20 == 0)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_mixing": op1_mixing,
    "op2_ngram_join": op2_ngram_join,
    "op3_language_id": op3_language_id,
    "op4_packing": op4_packing,
    "op5_secret_scan": op5_secret_scan,
    "op6_quality": op6_quality,
    "op7_token_counts": op7_token_counts,
    "op8_url_filter": op8_url_filter,
    "op9_fingerprints": op9_fingerprints,
    "op10_nearest": op10_nearest,
}

SQL: dict[str, str] = {}

SQL["op8_url_filter"] = """
WITH cut AS (
  SELECT page_id,
         translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages)
), rules(v, h, p) AS (
  VALUES ('block', 'com', '/en/'), ('allow', 'example.com', '/en/7'), ('allow', 'net', '/de/'), ('block', 'example.net', '/de/8'), ('block', 'org', '/es/')
), fits AS (
  SELECT c.host, c.path, max_by(h || p, length(h || p)) AS rule, max_by(v, length(h || p)) AS v
  FROM (SELECT DISTINCT host, path FROM cut) c JOIN rules ON (c.host = h OR ends_with(c.host, '.' || h)) AND starts_with(c.path, p)
  GROUP BY c.host, c.path
)
SELECT c.page_id, c.host, c.path, f.rule AS rule, coalesce(f.v, 'allow') AS verdict
FROM cut c LEFT JOIN fits f ON c.host = f.host AND c.path = f.path
"""

SQL["op1_mixing"] = """
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size,
         CAST('0x' || substr(sha256('17:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || md5(coalesce(text, ''))), 1, 15) AS BIGINT) AS tie
  FROM documents
), s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS n, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 1 WHEN 1 THEN 2 ELSE 3 END AS w FROM d GROUP BY source
), o AS ( -- in order of the words a weight may take, the sources before are full
  SELECT *, sum(n) OVER () - coalesce(sum(3 * n) OVER z, 0) AS rest, sum(w) OVER () - coalesce(sum(w) OVER z, 0) AS whole
  FROM s WINDOW z AS (ORDER BY 3.0 * n / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), c AS (
  SELECT *, CAST(rest AS DOUBLE) * w / whole > 3 * n AS is_full FROM o
), t AS (
  SELECT source, n, CAST(CASE WHEN is_full THEN 3 * n ELSE CAST((SELECT sum(n) - sum(CASE WHEN is_full THEN 3 * n ELSE 0 END) FROM c) AS DOUBLE) * w / (SELECT sum(w) FROM c WHERE NOT is_full) END AS DOUBLE) AS target FROM c
), p AS (
  SELECT d.doc_id, d.source, d.size, d.tie, t.n, t.target, sum(d.size) OVER (PARTITION BY d.source ORDER BY d.tie, d.doc_id ROWS UNBOUNDED PRECEDING) AS cum
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
), k AS (
  SELECT *, sum(size) OVER (ORDER BY (e * n + cum) / target, tie, CAST(doc_id AS VARCHAR), e ROWS UNBOUNDED PRECEDING) AS spent
  FROM p, (VALUES (0), (1), (2)) AS epochs(e) WHERE size > 0 AND target > 0
), taken AS (
  SELECT doc_id, CAST(sum(size) AS BIGINT) AS taken FROM k WHERE spent <= (SELECT sum(size) FROM d) GROUP BY doc_id
)
SELECT p.doc_id, p.size, p.n AS source_size, p.target, coalesce(taken.taken, 0) AS taken FROM p LEFT JOIN taken ON p.doc_id = taken.doc_id
"""

SQL["op2_ngram_join"] = """
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS l FROM documents
), sh AS (
  SELECT DISTINCT doc_id, s FROM (
    SELECT doc_id, unnest(CASE WHEN len(l) = 0 THEN [] WHEN len(l) < 5 THEN [array_to_string(l, ' ')] ELSE list_transform(range(1, len(l) - 3), lambda i: array_to_string(l[i:i + 4], ' ')) END) AS s FROM w)
), n AS (
  SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id
), shared AS (
  SELECT doc_id, s FROM sh WHERE s IN (SELECT s FROM sh GROUP BY s HAVING count(*) > 1)
), both_ AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS i FROM shared a JOIN shared b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2
), link AS (
  SELECT x, y FROM both_ JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y WHERE 100 * i >= 80 * (p.n + q.n - i)
), edge AS (
  SELECT x, y FROM link UNION ALL SELECT y, x FROM link
), reach(x, y) AS (
  SELECT x, y FROM edge UNION SELECT r.x, e.y FROM reach r JOIN edge e ON r.y = e.x
), least_ AS (
  SELECT x, min(y) AS m FROM reach GROUP BY x
)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(least(w.doc_id, m), w.doc_id) AS component_id
FROM w LEFT JOIN n ON n.doc_id = w.doc_id LEFT JOIN least_ ON x = w.doc_id
"""


def _kind_sql(order: int, kind: str, pattern: str, group: int, least: int) -> str:
    p = pattern.replace("'", "''")
    return f"""SELECT doc_id, owner, copy, {order} AS o, '{kind}' AS kind, i, gap, m, v, {least} AS least_ FROM (SELECT doc_id, copy, source AS owner, unnest(string_split_regex(t, '{p}')) AS gap,
    unnest(range(len(string_split_regex(t, '{p}')))) AS i, unnest(regexp_extract_all(t, '{p}', 0)) AS m, unnest(regexp_extract_all(t, '{p}', {group})) AS v FROM d WHERE regexp_matches(t, '{p}'))"""


SQL["op5_secret_scan"] = f"""
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS t, md5(coalesce(text, '')) AS copy FROM documents),
found AS ({" UNION ALL ".join(_kind_sql(i, *k) for i, k in enumerate([*secret_scan.BASE, *secret_scan.ADDED]))}),
placed AS (
  SELECT *, CAST(sum(length(gap)) OVER z + coalesce(sum(length(m)) OVER z, 0) - coalesce(length(m), 0) AS BIGINT) AS s, length(m) AS size
  FROM found WINDOW z AS (PARTITION BY doc_id, o ORDER BY i)
), good AS (SELECT * FROM placed WHERE m IS NOT NULL AND length(v) >= least_),
owners AS (SELECT sha256(v) AS h, count(DISTINCT owner) AS n, least(count(DISTINCT doc_id), count(DISTINCT copy)) AS r FROM good GROUP BY 1),
kept AS (SELECT good.*, kind || ':' || CAST(s AS VARCHAR) || ':' || CAST(s + size AS VARCHAR) AS said FROM good JOIN owners ON h = sha256(v) WHERE o < {len(secret_scan.BASE)} OR n <= {secret_scan.MAX_OWNERS} OR r <= {secret_scan.MAX_REPOS}),
told AS (
  SELECT doc_id, count(*) FILTER (kind = 'assign') AS a, count(*) FILTER (kind = 'access') AS b, count(*) FILTER (kind = 'hex') AS c,
         string_agg(said, ',' ORDER BY s, o) FILTER (o < {len(secret_scan.BASE)}) AS base, string_agg(said, ',' ORDER BY s, o) AS spans
  FROM kept GROUP BY doc_id
)
SELECT d.doc_id, coalesce(a, 0) AS n_assign, coalesce(b, 0) AS n_access, coalesce(c, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN told ON told.doc_id = d.doc_id
"""
