"""A query for each operator over the test tables, and the same in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import codec, completions, positions, prompts, signals, text
from ..functions.identity import identity, signature
from ..functions.lineage import shared_dir
from ..operators import chunking, corpus, metrics, records, sampling, splits
from ..sources import readers
from . import stages, teachers

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(f: Query) -> Query:
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f

    return add


def docs(spark: SparkSession, sf: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/documents.parquet").withColumn("doc_id", F.col("doc_id").cast("string"))


def r6(c) -> Column:
    return F.round(c, 6)


def listed(c: Column) -> Column:
    return F.array_join(F.transform(c, lambda x: x.cast("string")), ",")


# Ingest, chunks, windows


def chunk_sql(size: int, overlap: int, name: str = "c", where: str = "documents") -> str:
    """A CTE of chunks: doc_id, k, s, e, n (bytes of the document), total, x (hex of the document)."""
    step = size - overlap
    return f"""d_{name} AS (SELECT CAST(doc_id AS VARCHAR) AS doc_id, hex(encode(text)) AS x, octet_length(encode(text)) AS n FROM {where}),
{name} AS (SELECT doc_id, k, k * {step} AS s, least(k * {step} + {size}, n) AS e, n, total, x
  FROM (SELECT *, unnest(range(total)) AS k FROM (SELECT *, CAST(ceil(n / {step}.0) AS BIGINT) AS total FROM d_{name} WHERE n > 0)))"""


BYTES = "unhex(substr(x, 2 * s + 1, 2 * (e - s)))"


def whole_sql(h: str, mark: str) -> str:
    """Of hex digits cut out of UTF-8 text: characters cut at either end become mark (in hex), once for each stray byte or stump."""
    head, tail = f"regexp_extract({h}, '^((?:[89AB].)*)', 1)", f"regexp_extract({h}, '^(?:..)*?((?:[CD].|E.(?:[89AB].)?|F.(?:[89AB].){{0,2}})?)$', 1)"
    return f"unhex(repeat('{mark}', length({head}) // 2) || substr({h}, length({head}) + 1, length({h}) - length({head}) - length({tail})) || CASE WHEN {tail} <> '' THEN '{mark}' ELSE '' END)"


REPLACED = "EFBFBD"  # U+FFFD in UTF-8


@query("doc_ingest", """
SELECT sha256(source || '/' || CAST(doc_id AS VARCHAR) || '.txt') AS doc_id, source || '/' || CAST(doc_id AS VARCHAR) || '.txt' AS source_path,
  CAST(octet_length(encode(replace(replace(text, chr(13) || chr(10), chr(10)), chr(13), chr(10)))) AS BIGINT) AS n_bytes,
  md5(replace(replace(text, chr(13) || chr(10), chr(10)), chr(13), chr(10))) AS text_md5 FROM documents""")
def doc_ingest(spark, sf):
    d = readers.documents(docs(spark, sf), path_cols=("source", "doc_id"))
    return d.select("doc_id", "source_path", F.octet_length("text").cast("long").alias("n_bytes"), F.md5("text").alias("text_md5"))


@query("chunk_bytes", f"WITH {chunk_sql(4096, 256)} SELECT doc_id, k AS chunk_index, s AS byte_start, e AS byte_end, md5({BYTES}) AS bytes_md5 FROM c")
def chunk_bytes(spark, sf):
    return chunking.chunk(docs(spark, sf)).select("doc_id", F.col("chunk_index").cast("long").alias("chunk_index"), "byte_start", "byte_end", F.md5("raw_bytes").alias("bytes_md5"))


@query("chunk_neighbors", f"""WITH {chunk_sql(512, 0)} SELECT doc_id, k AS chunk_index, lag(k) OVER w AS prev_chunk_index, lead(k) OVER w AS next_chunk_index FROM c WINDOW w AS (PARTITION BY doc_id ORDER BY k)""")
def chunk_neighbors(spark, sf):
    return chunking.chunk(docs(spark, sf), 512, 0).select("doc_id", *(F.col(c).cast("long").alias(c) for c in ("chunk_index", "prev_chunk_index", "next_chunk_index")))


@query("chunk_reassemble", "SELECT CAST(doc_id AS VARCHAR) AS doc_id, md5(text) AS data_md5, CAST(octet_length(encode(text)) AS BIGINT) AS n_bytes FROM documents WHERE text <> ''")
def chunk_reassemble(spark, sf):
    whole = chunking.reassemble(chunking.chunk(docs(spark, sf), 512, 128))
    return whole.select("doc_id", F.md5("data").alias("data_md5"), F.octet_length("data").cast("long").alias("n_bytes"))


def window_sql(size: int, context: int, stride: int) -> str:
    """CTEs of windows over chunks without overlap: chunk columns and a, b (the window's bounds), by looking at neighbours."""
    return f"""{chunk_sql(size, 0)},
w AS (SELECT *, min(s) OVER z AS lo, max(e) OVER z AS hi FROM c WINDOW z AS (PARTITION BY doc_id ORDER BY k ROWS BETWEEN {stride} PRECEDING AND {stride} FOLLOWING)),
v AS (SELECT *, CASE WHEN hi - lo <= {context} THEN lo ELSE least(greatest(s - (greatest({context}, e - s) - (e - s)) // 2, lo), hi - greatest({context}, e - s)) END AS a,
  CASE WHEN hi - lo <= {context} THEN hi ELSE least(greatest(s - (greatest({context}, e - s) - (e - s)) // 2, lo), hi - greatest({context}, e - s)) + greatest({context}, e - s) END AS b FROM w)"""


@query("long_context_windows", f"""WITH {window_sql(512, 1024, 2)} SELECT doc_id, k AS chunk_index, a AS window_start, b AS window_end, s - a AS target_start, e - a AS target_end,
  md5(unhex(substr(x, 2 * a + 1, 2 * (b - a)))) AS window_md5 FROM v""")
def long_context_windows(spark, sf):
    w = chunking.chunk(docs(spark, sf), 512, 0, context=1024, stride=2)
    return w.select("doc_id", F.col("chunk_index").cast("long").alias("chunk_index"), F.col("window_byte_start").alias("window_start"), F.col("window_byte_end").alias("window_end"), F.col("target_start_in_window").alias("target_start"), F.col("target_end_in_window").alias("target_end"), F.md5("window_raw_bytes").alias("window_md5"))


def cut_sql(most: int, where: str) -> str:
    """CTEs of cut windows; where: the start of the cut window, from ts, te (target in the window) and m (its bytes)."""
    return f"""{window_sql(512, 2048, 4)}, t AS (SELECT doc_id, k, x, a, b, s, e, s - a AS ts, e - a AS te, b - a AS m FROM v),
u AS (SELECT *, CASE WHEN m <= {most} THEN 0 ELSE {where} END AS p FROM t), q AS (SELECT *, CASE WHEN m <= {most} THEN m ELSE p + {most} END AS r FROM u)"""


CENTRED = "least(greatest(ts + (te - ts) // 2 - 500, 0), m - 1000)"  # of 1000 bytes
CUT_HEX = "substr(x, 2 * (a + p) + 1, 2 * (r - p))"


def truncate_sql(most: int, where: str) -> str:
    return f"""WITH {cut_sql(most, where)} SELECT doc_id, k AS chunk_index, r - p AS final_bytes, ts - p AS target_start, te - p AS target_end, m > {most} AS truncated, md5(unhex(substr(x, 2 * (a + p) + 1, 2 * (r - p)))) AS input_md5 FROM q"""


def truncated(spark, sf, most: int, policy: str, target: str = "preserve_full") -> DataFrame:
    t = chunking.truncate(chunking.chunk(docs(spark, sf), 512, 0, context=2048, stride=4), most, policy, target)
    return t.select("doc_id", F.col("chunk_index").cast("long").alias("chunk_index"), F.col("context_truncation.final_bytes").alias("final_bytes"), "target_start", "target_end", F.col("context_truncation.truncated").alias("truncated"), F.md5("teacher_input_bytes").alias("input_md5"))


PLACES = {
    "left": ("left_biased", "least(greatest(te - 1024, 0), m - 1024)"),
    "right": ("right_biased", "least(greatest(ts, 0), m - 1024)"),
    "center": ("center_target", "least(greatest(ts + (te - ts) // 2 - 512, 0), m - 1024)"),
}
for _short, (_policy, _where) in PLACES.items():
    query(f"context_truncate_{_short}", truncate_sql(1024, _where))(lambda spark, sf, p=_policy: truncated(spark, sf, 1024, p))


@query("context_preserve_vs_truncate", f"""WITH {window_sql(512, 2048, 4)}, t AS (SELECT doc_id, k, s - a AS ts, e - a AS te, b - a AS m FROM v)
SELECT doc_id, k AS chunk_index, CASE WHEN m <= 200 THEN m WHEN te - ts > 200 THEN te - ts ELSE 200 END AS preserved_bytes, least(m, 200) AS truncated_bytes FROM t""")
def context_preserve_vs_truncate(spark, sf):
    w = chunking.chunk(docs(spark, sf), 512, 0, context=2048, stride=4)
    n = F.octet_length("window_raw_bytes").cast("long")
    size = lambda p: (c := chunking.truncation(n, F.col("target_start_in_window"), F.col("target_end_in_window"), 200, "left_biased", p))["end"] - c["start"]
    return w.select("doc_id", F.col("chunk_index").cast("long").alias("chunk_index"), size("preserve_full").alias("preserved_bytes"), size("truncate_if_needed").alias("truncated_bytes"))


@query("chunk_split_summary", f"""WITH {chunk_sql(4096, 256)} SELECT CASE WHEN CAST('0x' || substr(sha256(doc_id), 1, 8) AS BIGINT) % 10000 < 1000 THEN 'eval' ELSE 'train' END AS split,
  count(*) AS chunks, CAST(sum(e - s) AS BIGINT) AS n_bytes, round(avg(e - s), 6) AS avg_chunk_length FROM c GROUP BY 1""")
def chunk_split_summary(spark, sf):
    c = splits.by_hash(chunking.chunk(docs(spark, sf)), 0.1)
    n = F.col("byte_end") - F.col("byte_start")
    return c.groupBy("split").agg(F.count(F.lit(1)).alias("chunks"), F.sum(n).alias("n_bytes"), r6(F.avg(n)).alias("avg_chunk_length"))


# Splits and samples


@query("split_hash", "SELECT CAST(doc_id AS VARCHAR) AS doc_id, CASE WHEN CAST('0x' || substr(sha256(CAST(doc_id AS VARCHAR)), 1, 8) AS BIGINT) % 10000 < 1000 THEN 'eval' ELSE 'train' END AS split FROM documents")
def split_hash(spark, sf):
    return splits.by_hash(docs(spark, sf), 0.1).select("doc_id", "split")


RANKED = """r AS (SELECT doc_id, octet_length(encode(text)) AS n, row_number() OVER (ORDER BY sha256('42:' || doc_id), doc_id) AS rn, count(*) OVER () AS total
  FROM (SELECT CAST(doc_id AS VARCHAR) AS doc_id, text FROM documents))"""


@query("split_ranked", f"WITH {RANKED} SELECT doc_id, CASE WHEN rn <= round_even(total * 0.1, 0) THEN 'eval' ELSE 'train' END AS split FROM r")
def split_ranked(spark, sf):
    return splits.by_rank(docs(spark, sf), 0.1, 42).select("doc_id", "split")


@query("split_longdoc", f"""WITH {RANKED}, e AS (SELECT *, rn <= round_even(total * 0.1, 0) AS is_eval FROM r),
q AS (SELECT *, row_number() OVER (PARTITION BY NOT is_eval AND n >= 4096 ORDER BY n DESC, doc_id DESC) AS lr FROM e)
SELECT doc_id, CASE WHEN is_eval THEN 'eval' WHEN n >= 4096 AND lr <= round_even(total * 0.05, 0) THEN 'eval_longdoc' ELSE 'train' END AS split FROM q""")
def split_longdoc(spark, sf):
    rows = docs(spark, sf).withColumn("byte_end", F.octet_length("text").cast("long"))
    return splits.with_long_documents(rows, 0.1, 42, 4096, 0.05).select("doc_id", "split")


@query("split_random_longdoc", f"""WITH {RANKED}, e AS (SELECT *, rn <= round_even(total * 0.1, 0) AS is_eval FROM r),
q AS (SELECT *, row_number() OVER (PARTITION BY NOT is_eval AND n >= 4096 ORDER BY sha256('951:' || doc_id), doc_id) AS lr FROM e)
SELECT doc_id, CASE WHEN is_eval THEN 'eval' WHEN n >= 4096 AND lr <= round_even(total * 0.05, 0) THEN 'eval_longdoc' ELSE 'train' END AS split FROM q""")
def split_random_longdoc(spark, sf):
    rows = docs(spark, sf).withColumn("byte_end", F.octet_length("text").cast("long"))
    return splits.with_long_documents(rows, 0.1, 42, 4096, 0.05, "random_docs").select("doc_id", "split")


HASHED = "sha256(concat_ws(':', '{seed}', doc_id, CAST(k AS VARCHAR), CAST(s AS VARCHAR)))"


def chunks(spark, sf) -> DataFrame:
    return chunking.chunk(docs(spark, sf))


def key(c: DataFrame) -> DataFrame:
    return c.select("doc_id", F.col("chunk_index").cast("long").alias("chunk_index"))


@query("subsample_k", f"WITH {chunk_sql(4096, 256)} SELECT doc_id, k AS chunk_index FROM c ORDER BY {HASHED.format(seed=42)}, doc_id, k, s LIMIT 100")
def subsample_k(spark, sf):
    return key(sampling.subsample(chunks(spark, sf), 100, 42))


@query("subsample_large", f"WITH {chunk_sql(64, 0)} SELECT doc_id, k AS chunk_index FROM c ORDER BY {HASHED.format(seed=5)}, doc_id, k, s LIMIT 12000")
def subsample_large(spark, sf):
    return key(sampling.subsample(chunking.chunk(docs(spark, sf), 64, 0), 12_000, 5))


@query("sample_first_n", f"WITH {chunk_sql(4096, 256)} SELECT doc_id, k AS chunk_index FROM c ORDER BY doc_id, k, s, e LIMIT 50")
def sample_first_n(spark, sf):
    return key(sampling.first_rows(chunks(spark, sf), 50))


@query("ratio_merge", f"""WITH {chunk_sql(4096, 256, 'p', "(FROM documents WHERE lang = 'en')")}, {chunk_sql(4096, 256, 'q', "(FROM documents WHERE lang IS DISTINCT FROM 'en')")},
n AS (SELECT (SELECT count(*) FROM p) AS np, (SELECT count(*) FROM q) AS nq), f AS (SELECT *, (np + nq) * 1 / 4.0 AS tp, (np + nq) * 3 / 4.0 AS tq FROM n),
a AS (SELECT *, floor(tp) + CASE WHEN floor(tp) + floor(tq) < np + nq AND tp - floor(tp) > tq - floor(tq) THEN 1 ELSE 0 END AS ap FROM f), b AS (SELECT *, np + nq - ap AS aq FROM a),
pr AS (SELECT doc_id, k, row_number() OVER (ORDER BY {HASHED.format(seed=8)}, doc_id, k, s) AS rn FROM p), qr AS (SELECT doc_id, k, row_number() OVER (ORDER BY {HASHED.format(seed=9)}, doc_id, k, s) AS rn FROM q)
SELECT doc_id, k AS chunk_index FROM pr, b WHERE rn <= ap UNION ALL SELECT doc_id, k FROM qr, b WHERE rn <= aq""")
def ratio_merge(spark, sf):
    d = docs(spark, sf)
    return key(sampling.merge_by_ratio([(chunking.chunk(d.filter("lang = 'en'")), 1.0), (chunking.chunk(d.filter("not lang <=> 'en'")), 3.0)], 7))


def dummies(spark, sf, name: str, k: int) -> DataFrame:
    c = chunks(spark, sf)
    return stages.stage_a(c, teachers.create(name), k)


@query("teacher_mixture", f"""WITH {chunk_sql(4096, 256)}, n AS (SELECT count(*) AS t FROM c), f AS (SELECT t, t * 3 / 4.0 AS ta, t / 4.0 AS tb FROM n),
a AS (SELECT t, floor(ta) + CASE WHEN floor(ta) + floor(tb) < t AND ta - floor(ta) > tb - floor(tb) THEN 1 ELSE 0 END AS sa FROM f)
SELECT 'dummy' AS teacher_name, doc_id, k AS chunk_index FROM (SELECT *, row_number() OVER (ORDER BY {HASHED.format(seed=102)}, doc_id, k, s) AS rn FROM c), a WHERE rn <= sa
UNION ALL SELECT 'dry_run', doc_id, k FROM (SELECT *, row_number() OVER (ORDER BY {HASHED.format(seed=103)}, doc_id, k, s) AS rn FROM c), a WHERE rn <= t - sa""")
def teacher_mixture(spark, sf):
    c = chunks(spark, sf)
    out = sampling.teacher_mixture([(dummies(spark, sf, "dummy", 4), 3.0), (dummies(spark, sf, "dry_run", 4), 1.0)], c.count(), 101)
    return out.select("teacher_name", "doc_id", F.col("chunk_index").cast("long").alias("chunk_index"))


@query("curriculum_mix", f"""WITH {chunk_sql(4096, 256)}, n AS (SELECT count(*) AS t FROM c),
r AS (SELECT doc_id, k, row_number() OVER (ORDER BY {HASHED.format(seed=59)}, doc_id, k, s) AS r1, row_number() OVER (ORDER BY {HASHED.format(seed=76)}, doc_id, k, s) AS r2, row_number() OVER (ORDER BY {HASHED.format(seed=93)}, doc_id, k, s) AS r3 FROM c)
SELECT 'stage_a' AS stage_name, doc_id, k AS chunk_index FROM r, n WHERE r1 <= t // 3 UNION ALL SELECT 'stage_b', doc_id, k FROM r, n WHERE r2 <= t // 3 + CASE WHEN t % 3 = 2 THEN 1 ELSE 0 END
UNION ALL SELECT 'stage_c', doc_id, k FROM r, n WHERE r3 <= t // 3 + CASE WHEN t % 3 >= 1 THEN 1 ELSE 0 END""")
def curriculum_mix(spark, sf):
    c = chunks(spark, sf)
    history = [(c.withColumn("stage_name", F.lit(s)), 1.0) for s in ("stage_a", "stage_b", "stage_c")]
    return sampling.curriculum(history[-1][0], history, 42).select("stage_name", "doc_id", F.col("chunk_index").cast("long").alias("chunk_index"))


# Corpora


def strip_sql(value: str) -> str:
    return f"regexp_replace({value}, '^{text.SPACES}+|{text.SPACES}+$', '', 'g')"


def group_sql(cap: str) -> str:
    joined = strip_sql("string_agg(text, chr(10) || chr(10) ORDER BY doc_id)")
    return f"""WITH a AS (SELECT source, doc_id, text, row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS rn FROM documents WHERE octet_length(encode(text)) BETWEEN 200 AND 20000)
SELECT source, 'doc_' || lpad(CAST(rn // 4 + 1 AS VARCHAR), 8, '0') AS doc_id, md5({joined} || chr(10)) AS text_md5, min(rn) AS first_row, max(rn) AS last_row FROM a {cap} GROUP BY source, rn // 4 HAVING count(*) = 4"""


def grouped(spark, sf, cap: int | None) -> DataFrame:
    d = spark.read.parquet(f"{sf}/documents.parquet")
    g = corpus.group_rows(d, ["source"], ["doc_id"], "text", 4, 200, 20_000, cap)
    return g.select("source", "doc_id", F.md5("text").alias("text_md5"), F.col("first_row").cast("long").alias("first_row"), F.col("last_row").cast("long").alias("last_row"))


query("extract_groups", group_sql(""))(lambda spark, sf: grouped(spark, sf, None))
query("extract_capped", group_sql("WHERE rn // 4 < 3"))(lambda spark, sf: grouped(spark, sf, 3))


@query("extract_counters", """SELECT source, count(*) AS rows_seen, count(*) FILTER (n < 200) AS rows_below_min_bytes, count(*) FILTER (n > 20000) AS rows_above_max_bytes,
  count(*) FILTER (n BETWEEN 200 AND 20000) AS rows_accepted, count(*) FILTER (n BETWEEN 200 AND 20000) // 4 AS documents FROM (SELECT source, octet_length(encode(text)) AS n FROM documents) GROUP BY source""")
def extract_counters(spark, sf):
    return corpus.count_rows(docs(spark, sf), ["source"], "text", 4, 200, 20_000)


@query("source_cache", f"""WITH a AS (SELECT coalesce(text, '') AS text, doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS rn FROM documents)
SELECT split, 'doc_' || lpad(CAST(rn // 3 + 1 AS VARCHAR), 8, '0') AS doc_id, md5({strip_sql("string_agg(text, chr(10) || chr(10) ORDER BY rn)")} || chr(10)) AS text_md5 FROM a, (VALUES ('train'), ('eval')) AS s(split) GROUP BY split, rn // 3 HAVING count(*) = 3""")
def source_cache(spark, sf):
    """A source's cache, filled once and then found ready, as it is read back."""
    import uuid

    from . import build, config

    root = f"{shared_dir(spark)}/cache-{uuid.uuid4().hex}"
    source = config.source({"source_name": "all", "location": f"{sf}/documents.parquet", "text_field": "text", "order_field": "doc_id", "group_size": 3, "split_mapping": {"train": "", "eval": ""}})
    build.extract(spark, root, source)
    if build.extract(spark, root, source) != {"source_name": "all", "state": "ready", "reused_upstream_splits": {"": ["eval", "train"]}}:
        raise AssertionError("a cache that was just filled is not ready")
    return readers.cache(spark, root, "all").select("split", "doc_id", F.md5("text").alias("text_md5"))


GROUPS = (corpus.Group("code", 50, ("src0", "src1", "src2")), corpus.Group("general", 30, ("src2", "src3", "src4", "src5", "src6", "src7", "src8")), corpus.Group("narrative", 20, ("src9", "src10", "src11")))
POOL_SQL = """pool AS (SELECT CASE WHEN h < 3000 THEN 'eval' WHEN h < 5000 THEN 'validation' ELSE 'train' END AS split, source AS source_name, doc_id, text
  FROM (SELECT source, text, CAST(doc_id AS VARCHAR) AS doc_id, CAST('0x' || substr(sha256(CAST(doc_id AS VARCHAR)), 1, 8) AS BIGINT) % 10000 AS h FROM documents))"""


def pool(spark, sf) -> DataFrame:
    h = text.hash_bucket(F.col("doc_id"))
    return docs(spark, sf).select(F.when(h < 3000, "eval").when(h < 5000, "validation").otherwise("train").alias("split"), F.col("source").alias("source_name"), "doc_id", "text")


def mix_sql(target: int, more: bool, final: str) -> str:
    asked = sampling.allocate_groups(target, {g.name: g.percentage for g in GROUPS})
    of = ", ".join(f"('{s}', '{g.name}', {asked[g.name]})" for g in GROUPS for s in g.sources)
    seed = "CAST(42 + CASE split WHEN 'train' THEN 0 WHEN 'eval' THEN 1 ELSE 2 END AS VARCHAR)"
    keep = "rn <= asked" + (" OR xr <= short" if more else "")
    return f"""WITH {POOL_SQL}, g(source_name, group_name, asked) AS (VALUES {of}),
m AS (SELECT split, p.source_name, doc_id, text, group_name, asked, row_number() OVER (PARTITION BY split, group_name ORDER BY sha256(concat_ws(':', {seed}, group_name, p.source_name, doc_id)), p.source_name, doc_id) AS rn
  FROM pool p JOIN g ON p.source_name = g.source_name WHERE octet_length(encode(text)) BETWEEN 100 AND 30000),
l AS (SELECT *, {target} - sum(CASE WHEN rn <= asked THEN 1 ELSE 0 END) OVER (PARTITION BY split) AS short, CASE WHEN rn > asked THEN row_number() OVER (PARTITION BY split, rn > asked ORDER BY rn - asked, sha256({seed} || ':' || CAST(rn - asked AS VARCHAR) || ':' || group_name), group_name) END AS xr FROM m),
o AS (SELECT *, row_number() OVER (PARTITION BY split ORDER BY sha256(concat_ws(':', 'final', {seed}, group_name, source_name, doc_id))) AS ordinal FROM l WHERE {keep})
{final}"""


MIXED = "SELECT split, group_name, source_name, doc_id, ordinal AS output_ordinal, 'doc_' || lpad(CAST(ordinal AS VARCHAR), 8, '0') AS output_doc_id, md5(text) AS text_md5 FROM o"


def mixed(spark, sf, target: int, policy: str) -> DataFrame:
    m = corpus.mix(pool(spark, sf), GROUPS, target, 42, policy, 100, 30_000)
    return m.select("split", "group_name", "source_name", "doc_id", "output_ordinal", "output_doc_id", F.md5("text").alias("text_md5"))


query("mix_rebalance", mix_sql(90, True, MIXED))(lambda spark, sf: mixed(spark, sf, 90, "rebalance"))
query("mix_strict", mix_sql(10, False, MIXED))(lambda spark, sf: mixed(spark, sf, 10, "strict"))
query("mix_record_only", mix_sql(90, False, MIXED))(lambda spark, sf: mixed(spark, sf, 90, "record_only"))
_asked = sampling.allocate_groups(90, {g.name: g.percentage for g in GROUPS})


@query("mix_composition", mix_sql(90, True, f"""SELECT CASE grouping(group_name, source_name) WHEN 3 THEN 'split' WHEN 1 THEN 'group' ELSE 'source' END AS level, split, group_name, source_name, count(*) AS documents,
  CAST(CASE grouping(group_name, source_name) WHEN 3 THEN 90 WHEN 1 THEN CASE group_name {' '.join(f"WHEN '{g}' THEN {n}" for g, n in _asked.items())} END END AS BIGINT) AS requested,
  count(*) <> CASE grouping(group_name, source_name) WHEN 3 THEN 90 WHEN 1 THEN CASE group_name {' '.join(f"WHEN '{g}' THEN {n}" for g, n in _asked.items())} END END AS deviates
FROM o GROUP BY GROUPING SETS ((split), (split, group_name), (split, group_name, source_name))"""))
def mix_composition(spark, sf):
    return corpus.composition(corpus.mix(pool(spark, sf), GROUPS, 90, 42, "rebalance", 100, 30_000), 90, GROUPS)


@query("corpus_counts", """SELECT 'source_name' AS dimension, source AS value, count(*) AS documents FROM documents WHERE source IS NOT NULL GROUP BY source
UNION ALL SELECT 'split', CASE WHEN h < 3000 THEN 'eval' WHEN h < 5000 THEN 'validation' ELSE 'train' END, count(*) FROM (SELECT CAST('0x' || substr(sha256(CAST(doc_id AS VARCHAR)), 1, 8) AS BIGINT) % 10000 AS h FROM documents) GROUP BY 2""")
def corpus_counts(spark, sf):
    return corpus.inspect(pool(spark, sf))


# Teachers and signals

BIGRAM_SQL = """bytes AS (SELECT regexp_extract_all(hex(encode(text)), '..') AS l FROM documents),
pairs AS (SELECT CAST('0x' || unnest(l[1:len(l) - 1]) AS INTEGER) AS cur, CAST('0x' || unnest(l[2:len(l)]) AS INTEGER) AS nxt FROM bytes WHERE len(l) > 1),
counts AS (SELECT cur, nxt, count(*) AS n FROM pairs GROUP BY cur, nxt),
probs AS (SELECT *, n / sum(n) OVER (PARTITION BY cur) AS p, row_number() OVER (PARTITION BY cur ORDER BY n DESC, nxt) AS rk FROM counts),
model AS (SELECT cur, -sum(p * ln(p)) AS h, coalesce(max(CASE WHEN rk = 1 THEN ln(p) END) - max(CASE WHEN rk = 2 THEN ln(p) END), 0.0) AS gap FROM probs GROUP BY cur)"""


@query("teacher_bigram_topk", f"WITH {BIGRAM_SQL} SELECT CAST(cur AS BIGINT) AS byte, string_agg(CAST(nxt AS VARCHAR), ',' ORDER BY rk) AS ids, round(sum(ln(p)), 6) AS logprob_sum FROM probs WHERE rk <= 8 GROUP BY cur")
def teacher_bigram_topk(spark, sf):
    counts = teachers.bigram_counts(docs(spark, sf))
    tops = counts.groupBy("before").agg(F.sum("n").alias("total"), F.slice(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("down"), F.col("next").alias("id")))), 1, 8).alias("t"))
    logs = F.aggregate(F.transform("t", lambda x: F.log(-x["down"] / F.col("total"))), F.lit(0.0), lambda s, x: s + x)
    return tops.select(F.col("before").alias("byte"), listed(F.transform("t", lambda x: x["id"])).alias("ids"), r6(logs).alias("logprob_sum"))


def signalled(spark, sf, *fields: str) -> DataFrame:
    """Chunks with the byte teacher's signals; fields: the lists that are used, all if none is named."""
    d = docs(spark, sf)
    return stages.stage_a(chunking.chunk(d), teachers.train_bigram(d), 4, fields=fields or None).filter("error is null")


ENTROPY, GAP = "per_token_entropy", "per_token_top1_gap"


#: Positions of every chunk with their signals: doc_id, k, i (from 0), h, gap, m (positions).
POSITION_SQL = f"""{BIGRAM_SQL}, {chunk_sql(4096, 256)}, cl AS (SELECT doc_id, k, regexp_extract_all(substr(x, 2 * s + 1, 2 * (e - s)), '..') AS l, e - s AS size FROM c),
raw AS (SELECT doc_id, k, size - 1 AS m, unnest(l[1:len(l) - 1]) AS b, unnest(range(len(l) - 1)) AS i FROM cl WHERE len(l) > 1),
pos AS (SELECT doc_id, k, m, i, coalesce(h, 0.0) AS h, coalesce(gap, 0.0) AS gap FROM raw LEFT JOIN model ON model.cur = CAST('0x' || b AS INTEGER)),
keys AS (SELECT doc_id, k, size FROM cl)"""


@query("teacher_bigram_signals", f"""WITH {POSITION_SQL} SELECT keys.doc_id, keys.k AS chunk_index, CAST(keys.size AS BIGINT) AS tokens, CAST(count(i) AS BIGINT) AS n_rows, round(coalesce(avg(h), 0.0), 6) AS entropy, round(coalesce(sum(gap), 0.0), 4) AS gap_sum
FROM keys LEFT JOIN pos ON keys.doc_id = pos.doc_id AND keys.k = pos.k GROUP BY 1, 2, 3""")
def teacher_bigram_signals(spark, sf):
    s = signalled(spark, sf, "top_k_ids", GAP)
    gaps = F.aggregate("per_token_top1_gap", F.lit(0.0), lambda a, x: a + x)
    return s.select("doc_id", F.col("chunk_index").cast("long").alias("chunk_index"), F.col("teacher_input_token_length").alias("tokens"), F.size("top_k_ids").cast("long").alias("n_rows"), r6("entropy").alias("entropy"), F.round(gaps, 4).alias("gap_sum"))


def outputs_sql(name: str, ids: str, lps: str, entropy: float) -> str:
    return f"WITH {chunk_sql(4096, 256)} SELECT doc_id, k AS chunk_index, '{name}' AS teacher_name, '{ids}' AS ids, {lps} AS logprob_sum, {entropy} AS entropy FROM c"


def outputs(spark, sf, name: str, k: int) -> DataFrame:
    row = F.get("top_k_ids", F.lit(0))
    total = F.aggregate(F.get("top_k_logprobs", F.lit(0)), F.lit(0.0), lambda a, x: a + x)
    return dummies(spark, sf, name, k).select("doc_id", F.col("chunk_index").cast("long").alias("chunk_index"), "teacher_name", listed(row).alias("ids"), r6(total).alias("logprob_sum"), r6("entropy").alias("entropy"))


query("teacher_dummy", outputs_sql("dummy", "0,1,2,3", "CAST(-1.0 AS DOUBLE)", "CAST(0.4 AS DOUBLE)"))(lambda spark, sf: outputs(spark, sf, "dummy", 4))
query("teacher_dry_run", outputs_sql("dry_run", "0,1,2,3,4", "CAST(0.0 AS DOUBLE)", "CAST(0.0 AS DOUBLE)"))(lambda spark, sf: outputs(spark, sf, "dry_run", 5))

# Position policies

H, G = 2.5, 0.25


def mask_sql(on: str) -> str:
    return f"""WITH {POSITION_SQL}, sel AS (SELECT * FROM pos WHERE {on})
SELECT keys.doc_id, keys.k AS chunk_index, CAST(count(i) AS BIGINT) AS selected, CAST(coalesce(sum(i), 0) AS BIGINT) AS position_sum FROM keys LEFT JOIN sel ON keys.doc_id = sel.doc_id AND keys.k = sel.k GROUP BY 1, 2"""


def masked(spark, sf, entropy, gap, combine="union", minimum=None) -> DataFrame:
    s = signalled(spark, sf, ENTROPY, GAP).withColumn("_m", positions.select(F.col("per_token_entropy"), F.col("per_token_top1_gap"), entropy, gap, combine, minimum)).withColumn("_on", positions.selected(F.col("_m")))
    total = F.aggregate("_on", F.lit(0).cast("long"), lambda a, x: a + x)
    return s.select("doc_id", F.col("chunk_index").cast("long").alias("chunk_index"), F.size("_on").cast("long").alias("selected"), total.alias("position_sum"))


query("select_entropy", mask_sql(f"h >= {H}"))(lambda spark, sf: masked(spark, sf, H, None))
query("select_gap", mask_sql(f"gap <= {G}"))(lambda spark, sf: masked(spark, sf, None, G))
query("select_union", mask_sql(f"h >= {H} OR gap <= {G}"))(lambda spark, sf: masked(spark, sf, H, G))
query("select_intersection", mask_sql(f"h >= {H} AND gap <= {G}"))(lambda spark, sf: masked(spark, sf, H, G, "intersection"))


@query("select_minimum", f"""WITH {POSITION_SQL}, f AS (SELECT *, h >= 3.2 AS o, row_number() OVER (PARTITION BY doc_id, k, h >= 3.2 ORDER BY i) AS fr, sum(CASE WHEN h >= 3.2 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id, k) AS have FROM pos),
sel AS (SELECT * FROM f WHERE o OR fr <= 300 - have) SELECT keys.doc_id, keys.k AS chunk_index, CAST(count(i) AS BIGINT) AS selected, CAST(coalesce(sum(i), 0) AS BIGINT) AS position_sum FROM keys LEFT JOIN sel ON keys.doc_id = sel.doc_id AND keys.k = sel.k GROUP BY 1, 2""")
def select_minimum(spark, sf):
    return masked(spark, sf, 3.2, None, minimum=300)


WINDOW_SQL = f"""{POSITION_SQL}, sel AS (SELECT * FROM pos WHERE gap <= 0.05),
b AS (SELECT doc_id, k, greatest(i - 2, 0) AS ws, least(i + 2, m - 1) AS we, CASE WHEN greatest(i - 2, 0) <= lag(least(i + 2, m - 1)) OVER (PARTITION BY doc_id, k ORDER BY i) THEN 0 ELSE 1 END AS fresh, i FROM sel),
isl AS (SELECT *, sum(fresh) OVER (PARTITION BY doc_id, k ORDER BY i) AS w FROM b), win AS (SELECT doc_id, k, w, min(ws) AS ws, max(we) AS we, count(*) AS inside FROM isl GROUP BY 1, 2, 3)"""


@query("select_windows", f"""WITH {WINDOW_SQL} SELECT keys.doc_id, keys.k AS chunk_index, CAST(count(ws) AS BIGINT) AS windows, CAST(coalesce(sum(we - ws + 1), 0) AS BIGINT) AS covered, CAST(coalesce(sum(ws), 0) AS BIGINT) AS start_sum
FROM keys LEFT JOIN win ON keys.doc_id = win.doc_id AND keys.k = win.k GROUP BY 1, 2""")
def select_windows(spark, sf):
    s = signalled(spark, sf, GAP).withColumn("_w", positions.windows(positions.at_most(F.col("per_token_top1_gap"), 0.05), 2))
    add = lambda f: F.aggregate("_w", F.lit(0).cast("long"), lambda a, w: a + f(w))
    return s.select("doc_id", F.col("chunk_index").cast("long").alias("chunk_index"), F.size("_w").cast("long").alias("windows"), add(lambda w: w["end"] - w["start"] + 1).alias("covered"), add(lambda w: w["start"]).alias("start_sum"))


@query("export_selected_windows", f"WITH {WINDOW_SQL} SELECT doc_id, k AS chunk_index, CAST(ws AS BIGINT) AS window_start, CAST(we AS BIGINT) AS window_end, CAST(inside AS BIGINT) AS selected, CAST(we - ws + 1 AS BIGINT) AS n_rows FROM win")
def export_selected_windows(spark, sf):
    out = records.apply_policy(signalled(spark, sf, "top_k_ids", GAP), "selected_windows", gap=0.05, radius=2)
    return out.select("doc_id", *(F.col(a).cast("long").alias(b) for a, b in (("chunk_index", "chunk_index"), ("selected_window_start", "window_start"), ("selected_window_end", "window_end"), ("selected_position_count", "selected"))), F.size("top_k_ids").cast("long").alias("n_rows"))


@query("export_position_mask", mask_sql(f"h >= {H} OR gap <= {G}"))
def export_position_mask(spark, sf):
    out = records.apply_policy(signalled(spark, sf, ENTROPY, GAP), "position_mask", H, G)
    total = F.aggregate("selected_positions", F.lit(0).cast("long"), lambda a, x: a + x)
    return out.select("doc_id", F.col("chunk_index").cast("long").alias("chunk_index"), F.col("selected_position_count").cast("long").alias("selected"), total.alias("position_sum"))


@query("policy_preview", f"""WITH {WINDOW_SQL}, per AS (SELECT keys.doc_id, keys.k, keys.size - 1 AS m, count(ws) AS nw, coalesce(sum(we - ws + 1), 0) AS covered, coalesce(sum(inside), 0) AS ns FROM keys LEFT JOIN win ON keys.doc_id = win.doc_id AND keys.k = win.k GROUP BY 1, 2, 3)
SELECT count(*) AS records, CAST(sum(ns) AS BIGINT) AS selected_positions, CAST(sum(nw) AS BIGINT) AS windows, round(avg(CASE WHEN m > 0 THEN covered / m ELSE 0.0 END), 6) AS mean_compression FROM per""")
def policy_preview(spark, sf):
    s = signalled(spark, sf, GAP).withColumn("mask", positions.at_most(F.col("per_token_top1_gap"), 0.05)).withColumn("windows", positions.windows(F.col("mask"), 2))
    return metrics.policy_preview(s).withColumn("mean_compression", r6("mean_compression"))


# Prompts: whole documents as one chunk, so that no character is cut

for _name in prompts.names():
    _value = {"summarize_chunk": 80, "answer_question_from_chunk": prompts.template(_name).default, "continue_document": 128, "extract_key_points": 5}[_name]
    _filled = prompts.WORDING[_name].replace("{0}", str(_value)).replace("'", "''")
    _sql = "'" + _filled.replace("{doc}", "' || CAST(doc_id AS VARCHAR) || '").replace("{chunk}", "' || '0' || '").replace("{text}", "' || text || '") + "'"

    def _prompted(spark, sf, name=_name, value=_value):
        c = chunking.chunk(docs(spark, sf), 1 << 30, 0)
        p = prompts.prompt(name, {prompts.template(name).parameter: value})
        return c.select("doc_id", F.md5(p).alias("prompt_md5"), F.octet_length(p).cast("long").alias("n_bytes"))

    query(f"prompt_{_name}", f"SELECT CAST(doc_id AS VARCHAR) AS doc_id, md5(p) AS prompt_md5, CAST(octet_length(encode(p)) AS BIGINT) AS n_bytes FROM (SELECT doc_id, {_sql} AS p FROM documents WHERE text <> '')")(_prompted)


@query("stage_b_records", f"""WITH {cut_sql(1000, CENTRED)} SELECT doc_id, k AS chunk_index, s AS target_byte_start, e AS target_byte_end, a AS window_start, b AS window_end, ts - p AS target_start, te - p AS target_end,
  r - p AS n_bytes, CAST(1 AS BIGINT) AS tokens, '0,1,2' AS ids, 0.3 AS entropy, md5({whole_sql(CUT_HEX, REPLACED)}) AS text_md5, 'stage_b|dummy|long_context' AS made_by FROM q""")
def stage_b_records(spark, sf):
    out = stages.stage_b(chunking.chunk(docs(spark, sf), 512, 0, context=2048, stride=4), teachers.Dummy(), 1000, 3).filter("error is null")
    offset = lambda c: F.col(f"{c}_offset_within_window").alias(c)
    return out.select(
        "doc_id", F.col("target_chunk_index").cast("long").alias("chunk_index"), "target_byte_start", "target_byte_end", F.col("teacher_window_byte_start").alias("window_start"), F.col("teacher_window_byte_end").alias("window_end"),
        offset("target_start"), offset("target_end"), F.col("teacher_input_byte_length").alias("n_bytes"), F.col("teacher_input_token_length").alias("tokens"), listed(F.col("top_k_ids")[0]).alias("ids"),
        r6("entropy").alias("entropy"), F.md5("long_context_text").alias("text_md5"), F.concat_ws("|", "stage_name", "teacher_name", "mode").alias("made_by"),
    )


_asked = "'" + prompts.WORDING["summarize_chunk"].replace("{0}", "40").replace("'", "''").replace("{doc}", "' || doc_id || '").replace("{chunk}", "' || CAST(k AS VARCHAR) || '").replace("{text}", f"' || decode({whole_sql('h', REPLACED)}) || '") + "'"


@query("stage_c_records", f"""WITH {chunk_sql(4096, 256)}, h AS (SELECT *, substr(x, 2 * s + 1, 2 * (e - s)) AS h FROM c)
SELECT doc_id, k AS chunk_index, 'summarize_chunk' AS task_type, md5({_asked}) AS prompt_md5, 'dummy_completion_0' AS completion_text, 'deterministic=true,max_words=40,template_name=summarize_chunk' AS metadata, true AS whole FROM h""")
def stage_c_records(spark, sf):
    out = stages.stage_c(chunks(spark, sf), teachers.Dummy(), "summarize_chunk", {"max_words": 40}).filter("error is null")
    o = F.col("structured_output")
    metadata = F.array_join(F.array_sort(F.transform(F.map_entries(o["teacher_metadata"]), lambda e: F.concat_ws("=", e["key"], e["value"]))), ",")
    return out.select("doc_id", F.col("chunk_index").cast("long").alias("chunk_index"), o["task_type"].alias("task_type"), F.md5(o["prompt_text"]).alias("prompt_md5"), o["completion_text"].alias("completion_text"), metadata.alias("metadata"), stages.is_whole(out).alias("whole"))


# Records: chunks with made-up but reproducible stages, teachers and values

RECORD_SQL = f"""{chunk_sql(4096, 256)}, rec AS (SELECT doc_id, k, s, e, b, CASE b % 3 WHEN 0 THEN 'stage_a' WHEN 1 THEN 'stage_b' ELSE 'stage_c' END AS stage_name, CASE WHEN b % 11 = 0 THEN NULL WHEN b % 2 = 0 THEN 'dummy' ELSE 'byte_bigram' END AS teacher_name,
  'topk_logits' AS mode, CASE WHEN b % 7 = 0 THEN NULL ELSE b / 2000.0 END AS entropy, CASE WHEN b % 5 = 0 THEN NULL ELSE 1 + b % 4 END AS width
  FROM (SELECT *, CAST('0x' || substr(sha256(doc_id || ':' || CAST(k AS VARCHAR)), 1, 8) AS BIGINT) % 10000 AS b FROM c))"""


def recorded(spark, sf) -> DataFrame:
    c = chunks(spark, sf).withColumn("b", text.hash_bucket(F.concat_ws(":", "doc_id", F.col("chunk_index").cast("string"))))
    b = F.col("b")
    width = (1 + b % 4).cast("int")
    rows = lambda x: F.when(b % 5 != 0, F.array_repeat(x, 3))
    return c.withColumns({
        "stage_name": F.when(b % 3 == 0, "stage_a").when(b % 3 == 1, "stage_b").otherwise("stage_c"),
        "teacher_name": F.when(b % 11 == 0, F.lit(None)).when(b % 2 == 0, "dummy").otherwise("byte_bigram"),
        "mode": F.lit("topk_logits"), "schema_version": F.lit("1.0"),
        "entropy": F.when(b % 7 != 0, b / 2000.0),
        "top_k_ids": rows(F.transform(F.sequence(F.lit(1), width), lambda i: i.cast("long"))),
        "top_k_logprobs": rows(F.transform(F.sequence(F.lit(1), width), lambda i: -i.cast("double"))),
        "teacher_input_byte_length": F.lit(None).cast("long"), "teacher_input_token_length": F.lit(None).cast("long"),
        "selected_window_start": F.when(b % 3 == 0, (b % 50).cast("int")), "selected_window_end": F.when(b % 3 == 0, (b % 50 + b % 9).cast("int")),
        "selected_position_count": F.when(b % 2 == 0, (b % 20).cast("int")), "selected_position_mask": F.when(b % 4 == 0, F.array(F.lit(True))),
        "selected_positions": F.lit(None).cast("array<int>"), "selection_policy": F.lit(None).cast("string"),
    })


IDENTITY_SQL = "concat_ws('|', doc_id, 'chunk:' || CAST(k AS VARCHAR), stage_name, coalesce(teacher_name, ''), mode)"


@query("record_signature", f"WITH {RECORD_SQL} SELECT {IDENTITY_SQL} AS identity, sha256({IDENTITY_SQL}) AS signature FROM rec")
def record_signature(spark, sf):
    return recorded(spark, sf).select(identity().alias("identity"), signature().alias("signature"))


@query("dedup_first_seen", f"WITH {RECORD_SQL} SELECT {IDENTITY_SQL} AS identity, CAST(min(copy) AS BIGINT) AS copy FROM (SELECT *, 1 AS copy FROM rec WHERE b % 2 = 0 UNION ALL SELECT *, 2 FROM rec UNION ALL SELECT *, 3 FROM rec WHERE b % 3 = 0) GROUP BY 1")
def dedup_first_seen(spark, sf):
    r = recorded(spark, sf)
    copies = sampling.concat([r.filter("b % 2 = 0").withColumn("copy", F.lit(1)), r.withColumn("copy", F.lit(2)), r.filter("b % 3 = 0").withColumn("copy", F.lit(3))])
    return records.first_seen(copies, ("copy",)).select(identity().alias("identity"), F.col("copy").cast("long").alias("copy"))


@query("append_antijoin", f"WITH {RECORD_SQL} SELECT {IDENTITY_SQL} AS identity FROM rec WHERE b % 4 <> 0")
def append_antijoin(spark, sf):
    r = recorded(spark, sf)
    return records.new_only(r, r.filter("b % 4 = 0")).select(identity().alias("identity"))


def shard_sql(filled: int) -> str:
    return f"WITH {chunk_sql(4096, 256)} SELECT doc_id, k AS chunk_index, CAST((row_number() OVER (ORDER BY doc_id, k) - 1 + {filled}) // 100 AS BIGINT) AS shard_id FROM c"


def shards(spark, sf, filled: int) -> DataFrame:
    s = records.sharded(chunks(spark, sf), 100, ("doc_id", "chunk_index"), filled)
    return s.select("doc_id", F.col("chunk_index").cast("long").alias("chunk_index"), F.col("shard_id").cast("long").alias("shard_id"))


query("shard_assign", shard_sql(0))(lambda spark, sf: shards(spark, sf, 0))
query("shard_append", shard_sql(237))(lambda spark, sf: shards(spark, sf, 237))


# Metrics


@query("stage_sanity", f"""WITH {RECORD_SQL} SELECT stage_name, count(*) AS record_count, round(avg(entropy), 6) AS avg_entropy, min(entropy) AS min_entropy, max(entropy) AS max_entropy, round(avg(e - s), 6) AS avg_chunk_length, round(avg(width), 6) AS avg_topk_width,
  round(avg(e - s), 6) AS avg_teacher_input_bytes, avg(CASE WHEN width IS NOT NULL THEN 3 END) AS avg_teacher_input_tokens, CAST(min(CASE WHEN width IS NOT NULL THEN 3 END) AS BIGINT) AS min_teacher_input_tokens, CAST(max(CASE WHEN width IS NOT NULL THEN 3 END) AS BIGINT) AS max_teacher_input_tokens, round(avg(e - s) / 3, 6) AS avg_bytes_per_token
FROM rec GROUP BY stage_name""")
def stage_sanity(spark, sf):
    s = metrics.stage_sanity(recorded(spark, sf))
    return s.withColumns({c: r6(c) for c in ("avg_entropy", "avg_chunk_length", "avg_topk_width", "avg_teacher_input_bytes", "avg_bytes_per_token")} | {c: F.col(c).cast("long") for c in ("min_teacher_input_tokens", "max_teacher_input_tokens")})


for _key in ("stage_name", "teacher_name"):
    query(f"quality_by_{_key.partition('_')[0]}", f"WITH {RECORD_SQL} SELECT coalesce({_key}, 'missing') AS {_key}, count(*) AS records, round(avg(entropy), 6) AS avg_entropy FROM rec GROUP BY 1")(lambda spark, sf, k=_key: metrics.by_key(recorded(spark, sf), k).withColumn("avg_entropy", r6("avg_entropy")))


@query("entropy_histogram", f"""WITH {RECORD_SQL}, z AS (SELECT min(entropy) AS lo, max(entropy) AS hi, (max(entropy) - min(entropy)) / 10 AS w FROM rec), q AS (SELECT least(CAST(floor((entropy - lo) / w) AS BIGINT), 9) AS bin, count(*) AS n FROM rec, z WHERE entropy IS NOT NULL GROUP BY 1)
SELECT CAST(i AS BIGINT) AS bin, round(lo + i * w, 6) AS bin_start, round(CASE WHEN i = 9 THEN hi ELSE lo + (i + 1) * w END, 6) AS bin_end, coalesce(n, 0) AS count FROM (SELECT unnest(range(10)) AS i) LEFT JOIN q ON q.bin = i, z""")
def entropy_histogram(spark, sf):
    h = metrics.histogram(recorded(spark, sf), "entropy", 10)
    return h.select(F.col("bin").cast("long").alias("bin"), r6("bin_start").alias("bin_start"), r6("bin_end").alias("bin_end"), "count")


@query("selection_summary", f"""WITH {RECORD_SQL} SELECT count(*) FILTER (b % 3 = 0) AS selected_window_record_count, round(avg(CASE WHEN b % 3 = 0 THEN b % 9 + 1 END), 6) AS average_selected_window_length, round(avg(CASE WHEN b % 2 = 0 THEN b % 20 END), 6) AS average_selected_position_count,
  bool_or(b % 4 = 0) AS position_masks_present, round(avg(CASE WHEN b % 3 = 0 OR b % 4 = 0 THEN 1.0 ELSE 0.0 END), 6) AS selection_filtered_record_proportion FROM rec""")
def selection_summary(spark, sf):
    s = metrics.selection_summary(recorded(spark, sf))
    return s.withColumns({c: r6(c) for c in ("average_selected_window_length", "average_selected_position_count", "selection_filtered_record_proportion")})


@query("record_summary", f"""WITH {RECORD_SQL} SELECT count(*) AS record_count, (SELECT string_agg(v, ',' ORDER BY v) FROM (SELECT DISTINCT stage_name AS v FROM rec)) AS stages, (SELECT string_agg(v, ',' ORDER BY v) FROM (SELECT DISTINCT teacher_name AS v FROM rec WHERE teacher_name IS NOT NULL)) AS teachers,
  round(avg(e - s), 6) AS avg_chunk_length, round(avg(entropy), 6) AS avg_entropy, '1.0' AS versions FROM rec""")
def record_summary(spark, sf):
    s = metrics.record_summary(recorded(spark, sf))
    return s.select("record_count", *(F.array_join(c, ",").alias(c) for c in ("stages", "teachers")), r6("avg_chunk_length").alias("avg_chunk_length"), r6("avg_entropy").alias("avg_entropy"), F.array_join("versions", ",").alias("versions"))


def _facts_sql(where: str) -> str:
    return f"""SELECT 'records' AS fact, CAST(count(*) AS DOUBLE) AS v FROM rec WHERE {where} UNION ALL SELECT 'avg_chunk_length', avg(e - s) FROM rec WHERE {where} UNION ALL SELECT 'avg_entropy', avg(entropy) FROM rec WHERE {where}
UNION ALL SELECT 'stage_name:' || stage_name, count(*) FROM rec WHERE {where} GROUP BY stage_name UNION ALL SELECT 'teacher_name:' || coalesce(teacher_name, 'missing'), count(*) FROM rec WHERE {where} GROUP BY coalesce(teacher_name, 'missing')"""


@query("record_compare", f"""WITH {RECORD_SQL}, l AS ({_facts_sql('true')}), r AS ({_facts_sql("stage_name <> 'stage_c'")})
SELECT coalesce(l.fact, r.fact) AS fact, round(l.v, 6) AS left_value, round(r.v, 6) AS right_value, CASE WHEN l.v IS NULL OR r.v IS NULL THEN l.v IS DISTINCT FROM r.v ELSE abs(l.v - r.v) > 1e-9 END AS differs FROM l FULL JOIN r ON l.fact = r.fact""")
def record_compare(spark, sf):
    r = recorded(spark, sf)
    return metrics.compare(r, r.filter("stage_name <> 'stage_c'")).withColumns({"left_value": r6("left_value"), "right_value": r6("right_value")})


@query("token_cost", f"""WITH {chunk_sql(4096, 256)}, t AS (SELECT e - s AS n_bytes, 1 + len(list_filter(regexp_extract_all(substr(x, 2 * s + 1, 2 * (e - s)), '..'), lambda y: y = '20')) AS n_tokens FROM c)
SELECT count(*) AS inputs, round(avg(n_bytes), 6) AS avg_bytes, round(avg(n_tokens), 6) AS avg_tokens, CAST(min(n_tokens) AS BIGINT) AS min_tokens, CAST(max(n_tokens) AS BIGINT) AS max_tokens, round(avg(n_bytes) / avg(n_tokens), 6) AS bytes_per_token, round(avg(CASE WHEN n_tokens >= 460 THEN 1.0 ELSE 0.0 END), 6) AS near_limit_share FROM t""")
def token_cost(spark, sf):
    # what lies between spaces as tokens, counted in Latin-1 so that every byte is a character
    latin = F.decode("raw_bytes", "ISO-8859-1")
    words = F.length(latin) - F.length(F.replace(latin, F.lit(" "), F.lit(""))) + 1
    counts = chunks(spark, sf).select((F.col("byte_end") - F.col("byte_start")).alias("n_bytes"), words.cast("long").alias("n_tokens"))
    t = metrics.token_cost(counts, 512)
    return t.withColumns({c: r6(c) for c in ("avg_bytes", "avg_tokens", "bytes_per_token", "near_limit_share")})


PARITY_LEFT = "SELECT *, width IS NOT NULL AS topk, CASE WHEN b % 3 <> 0 THEN b % 100 END AS tl, CASE WHEN b % 6 <> 0 THEN CASE WHEN b % 13 = 0 THEN 2 ELSE 3 END END AS ne, CASE WHEN b % 4 <> 0 THEN 3 END AS ng, b % 1000 >= 900 AS low FROM rec"


def _parity_sql(records: str) -> str:
    plausible = lambda n: f"count(*) FILTER ({n} IS NOT NULL AND (NOT topk OR {n} = 3))"
    facts = {
        "records": "count(*)", "with_topk": "count(*) FILTER (topk)", "token_length_count": "count(tl)", "token_length_min": "min(tl)", "token_length_max": "max(tl)", "token_length_avg": "avg(tl)",
        "entropy_count": "count(entropy)", "entropy_min": "min(entropy)", "entropy_max": "max(entropy)", "entropy_avg": "avg(entropy)", "width_avg": "avg(width)",
        "per_token_entropy_present": "count(ne)", "per_token_entropy_plausible": plausible("ne"), "per_token_top1_gap_present": "count(ng)", "per_token_top1_gap_plausible": plausible("ng"),
        "invalid": "count(*) FILTER (entropy IS NULL)", "selectable": "count(*) FILTER (ne IS NOT NULL AND NOT low)",
    }
    return "SELECT unnest([" + ", ".join(f"{{'check': '{f}', 'v': CAST({c} AS DOUBLE)}}" for f, c in facts.items()) + f"], recursive := true) FROM ({records})"


@query("token_lengths", f"WITH {chunk_sql(512, 64)}, t AS (SELECT doc_id, k, CAST(octet_length({whole_sql('substr(x, 2 * s + 1, 2 * (e - s))', REPLACED)}) AS BIGINT) AS n FROM c) SELECT doc_id, k AS chunk_index, n AS n_bytes, n AS n_tokens FROM t")
def token_lengths(spark, sf):
    """By the byte teacher, whose tokens are the bytes of what it reads."""
    t = stages.token_lengths(chunking.chunk(docs(spark, sf), 512, 64), teachers.ByteBigram(), "raw_bytes")
    return t.select("doc_id", F.col("chunk_index").cast("long").alias("chunk_index"), F.col("teacher_input_byte_length").alias("n_bytes"), F.col("teacher_input_token_length").alias("n_tokens"))


@query("parity_summary", f"""WITH {RECORD_SQL}, x AS ({_parity_sql(PARITY_LEFT)}), y AS ({_parity_sql(f"SELECT * REPLACE (entropy * 2 AS entropy, CASE WHEN b % 12 <> 0 THEN ne END AS ne, CASE WHEN tl < 50 THEN tl END AS tl) FROM ({PARITY_LEFT})")}),
z AS (SELECT x."check", x.v AS a, y.v AS b, (SELECT v FROM x WHERE "check" = 'per_token_entropy_present') AS pe, (SELECT v FROM y WHERE "check" = 'per_token_entropy_present') AS qe, (SELECT v FROM x WHERE "check" = 'per_token_top1_gap_present') AS pg,
  (SELECT v FROM x WHERE "check" = 'records') AS n FROM x JOIN y ON x."check" = y."check")
SELECT "check", round(a, 6) AS left_value, round(b, 6) AS right_value, CASE WHEN "check" LIKE 'token_length%' OR "check" LIKE 'entropy%' OR "check" = 'width_avg' THEN 'INFO' WHEN "check" = 'records' THEN 'PASS' WHEN "check" = 'with_topk' THEN CASE WHEN a = n AND b = n THEN 'PASS' ELSE 'WARN' END
  WHEN "check" = 'invalid' THEN CASE WHEN a + b = 0 THEN 'PASS' ELSE 'FAIL' END WHEN "check" = 'selectable' THEN CASE WHEN a > 0 AND b > 0 THEN 'PASS' ELSE 'WARN' END WHEN "check" = 'per_token_entropy_plausible' THEN CASE WHEN a = pe AND b = qe THEN 'PASS' ELSE 'FAIL' END
  WHEN "check" = 'per_token_top1_gap_plausible' THEN CASE WHEN a = pg AND b = pg THEN 'PASS' ELSE 'FAIL' END ELSE CASE WHEN a = b THEN 'PASS' ELSE 'WARN' END END AS verdict FROM z""")
def parity_summary(spark, sf):
    b = F.col("b")
    level = F.when(b % 1000 >= 900, 0.1).otherwise(0.5)
    left = recorded(spark, sf).withColumns({
        "teacher_input_token_length": F.when(b % 3 != 0, b % 100), "per_token_entropy": F.when(b % 6 != 0, F.array_repeat(level, F.when(b % 13 == 0, 2).otherwise(3))),
        "per_token_top1_gap": F.when(b % 4 != 0, F.array_repeat(level, 3)),
    })
    right = left.withColumns({"entropy": F.col("entropy") * 2, "per_token_entropy": F.when(b % 12 != 0, F.col("per_token_entropy")), "teacher_input_token_length": F.when(F.col("teacher_input_token_length") < 50, F.col("teacher_input_token_length"))})
    return metrics.parity(left, right, "selected_windows", entropy=0.4).withColumns({"left_value": r6("left_value"), "right_value": r6("right_value")})


# Vectors


def _embedded(spark, sf) -> DataFrame:
    return spark.read.parquet(f"{sf}/embeddings.parquet")


HALF_SQL = "CASE WHEN abs(x) >= pow(2.0, -14) THEN round_even(x / pow(2.0, floor(log2(abs(x))) - 10), 0) * pow(2.0, floor(log2(abs(x))) - 10) ELSE round_even(x / pow(2.0, -24), 0) * pow(2.0, -24) END"
VALUES_SQL = "v AS (SELECT vec_id, CAST(unnest(embedding) AS DOUBLE) AS x, unnest(range(len(embedding))) AS i FROM embeddings)"


@query("pack_ids", """WITH v AS (SELECT vec_id, list_transform(embedding, lambda y: CAST(floor(abs(y) * 100000) AS BIGINT)) AS ids FROM embeddings), w AS (SELECT *, CASE WHEN list_max(ids) <= 255 THEN 1 WHEN list_max(ids) <= 65535 THEN 2 ELSE 4 END AS size FROM v)
SELECT vec_id, CASE size WHEN 1 THEN 'uint8' WHEN 2 THEN 'uint16' ELSE 'uint32' END AS dtype, '1,' || CAST(len(ids) AS VARCHAR) AS shape, to_base64(unhex(array_to_string(list_transform(ids, lambda y: CASE size WHEN 1 THEN printf('%02X', y) WHEN 2 THEN printf('%02X%02X', y & 255, y >> 8) ELSE printf('%02X%02X%02X%02X', y & 255, (y >> 8) & 255, (y >> 16) & 255, y >> 24) END), ''))) AS data_b64 FROM w""")
def pack_ids(spark, sf):
    ids = F.array(F.transform("embedding", lambda x: F.floor(F.abs(x.cast("double").cast("float")) * F.lit(100000).cast("float")).cast("long")))
    p = _embedded(spark, sf).select("vec_id", codec.pack_ids(ids).alias("p"))
    return p.select("vec_id", F.col("p.dtype").alias("dtype"), listed(F.col("p.shape")).alias("shape"), F.col("p.data_b64").alias("data_b64"))


@query("pack_float16", f"WITH {VALUES_SQL}, h AS (SELECT vec_id, {HALF_SQL} AS y FROM v) SELECT vec_id, round(sum(y), 9) AS total, round(min(y), 9) AS low, round(max(y), 9) AS high FROM h GROUP BY vec_id")
def pack_float16(spark, sf):
    h = _embedded(spark, sf).select("vec_id", F.transform(F.col("embedding").cast("array<double>"), codec.half).alias("h"))
    return h.select("vec_id", F.round(F.aggregate("h", F.lit(0.0), lambda a, x: a + x), 9).alias("total"), F.round(F.array_min("h"), 9).alias("low"), F.round(F.array_max("h"), 9).alias("high"))


@query("codec_roundtrip", f"WITH {VALUES_SQL}, h AS (SELECT vec_id, {HALF_SQL} AS y FROM v) SELECT vec_id, count(*) AS n, round(sum(y * y), 9) AS squares FROM h GROUP BY vec_id")
def codec_roundtrip(spark, sf):
    p = _embedded(spark, sf).select("vec_id", codec.pack_half(F.col("embedding").cast("array<double>")).alias("p"))
    u = p.select("vec_id", codec.unpack(F.col("p.dtype"), F.col("p.data_b64")).alias("u"))
    return u.select("vec_id", F.size("u").cast("long").alias("n"), F.round(F.aggregate("u", F.lit(0.0), lambda a, x: a + x * x), 9).alias("squares"))


# Storage, previews, checks


@query("jsonl_roundtrip", f"""WITH {RECORD_SQL}, y AS (SELECT * REPLACE (coalesce(teacher_name, 'none') AS teacher_name), entropy AS x FROM rec) SELECT {IDENTITY_SQL} AS identity, e - s AS n_bytes, CAST(width * 3 AS BIGINT) AS n_ids, CASE WHEN x IS NULL THEN NULL WHEN x = 0 THEN 0.0 ELSE round({HALF_SQL}, 9) END AS entropy FROM y""")
def jsonl_roundtrip(spark, sf):
    import uuid

    from ..sources import sinks

    folder = f"{shared_dir(spark)}/jsonl-{uuid.uuid4().hex}"
    rows = recorded(spark, sf).withColumns({"split": F.lit("train"), "teacher_name": F.coalesce("teacher_name", F.lit("none"))})  # a line must name its teacher
    sinks.write_records(rows, folder, "train", size=500)
    back = readers.records(spark, folder)
    return back.select(identity().alias("identity"), F.octet_length("raw_bytes").cast("long").alias("n_bytes"), F.size(F.flatten("top_k_ids")).cast("long").alias("n_ids"), F.round("entropy", 9).alias("entropy")).withColumn("n_ids", F.when(F.col("n_ids") >= 0, F.col("n_ids")))


@query("merge_shards", f"""WITH {RECORD_SQL}, n AS (SELECT 2 * count(*) AS n FROM rec) SELECT 'part-' || lpad(CAST(i AS VARCHAR), 5, '0') || '.jsonl' AS shard, least(500, n - 500 * i) AS records FROM (SELECT n, unnest(range((n + 499) // 500)) AS i FROM n)""")
def merge_shards(spark, sf):
    """Shards of two folders, one of 300 and one of 700 lines each, as shards of 500."""
    import uuid

    from ..sources import sinks

    folder = f"{shared_dir(spark)}/merge-{uuid.uuid4().hex}"
    keys = chunks(spark, sf).select("doc_id", "chunk_index", F.to_json(F.struct("doc_id", "chunk_index", "byte_end")).alias("value"))
    for size in (300, 700):
        sinks.write_lines(keys, f"{folder}/{size}", size, "part", ("doc_id", "chunk_index"))
    sinks.merge_shards(spark, [f"{folder}/300", f"{folder}/700"], f"{folder}/all", 500)
    return readers.shard_counts(spark, f"{folder}/all")


@query("build_and_resume", f"""WITH {RANKED}, {chunk_sql(4096, 256)}
SELECT c.doc_id, k AS chunk_index, e - s AS n_bytes, stage_name, CASE WHEN rn <= round_even(total_docs * 0.1, 0) THEN 'eval' ELSE 'train' END AS split
FROM c, (VALUES ('stage_a')) AS stages(stage_name), (SELECT doc_id AS id, rn, count(*) OVER () AS total_docs FROM r WHERE n > 0) WHERE c.doc_id = id""")
def build_and_resume(spark, sf):
    """A build of stage A, and the same again, resumed: every record is written once."""
    import uuid

    from . import build, config

    folder = f"{shared_dir(spark)}/build-{uuid.uuid4().hex}"

    def run():
        teacher = {"teacher_name": "dummy", "top_k": 2}
        sections = {"data": {"input_path": sf, "eval_fraction": 0.1, "seed": 42}, "input": {}, "output": {"output_dir": folder, "resume": True, "max_records_per_shard": 500, "stop_after_stage": "stage_a"}}
        return build.run(spark, config.pipeline(sections | {"stage_a": teacher, "stage_b": teacher, "stage_c": teacher}), docs(spark, sf))

    run()
    if run()["output_records"]:
        raise AssertionError("a resumed run wrote records again")
    back = readers.records(spark, folder)
    return back.select("doc_id", F.col("chunk_index").cast("long").alias("chunk_index"), F.octet_length("raw_bytes").cast("long").alias("n_bytes"), "stage_name", "split")


@query("text_preview", """SELECT doc_id, CASE WHEN length(p) > 80 THEN left(p, 80) || '...' ELSE p END AS preview FROM (SELECT CAST(doc_id AS VARCHAR) AS doc_id, replace(text, chr(10), '\\n') AS p FROM documents)""")
def text_preview(spark, sf):
    return docs(spark, sf).select("doc_id", text.preview(F.col("text"), 80).alias("preview"))


@query("field_presence", f"WITH {RECORD_SQL} SELECT bool_or(entropy IS NOT NULL) AS entropy, bool_or(width IS NOT NULL) AS top_k_ids, bool_or(b % 4 = 0) AS selected_position_mask, false AS selection_policy FROM rec")
def field_presence(spark, sf):
    return metrics.presence(recorded(spark, sf), ("entropy", "top_k_ids", "selected_position_mask", "selection_policy"))


@query("output_checks", f"""WITH {RECORD_SQL} SELECT doc_id, k AS chunk_index, CASE WHEN entropy IS NULL THEN 'entropy is not a finite number of 0 or more'
  WHEN width = 4 THEN 'an id is outside the vocabulary' END AS problem FROM rec""")
def output_checks(spark, sf):
    r = recorded(spark, sf)
    found = signals.problem(F.col("top_k_ids"), F.col("top_k_logprobs"), F.col("entropy"), None, 4)
    return r.select("doc_id", F.col("chunk_index").cast("long").alias("chunk_index"), found.alias("problem"))


@query("chunk_text_legacy", f"""WITH {chunk_sql(512, 64)}, h AS (SELECT *, substr(x, 2 * s + 1, 2 * (e - s)) AS h FROM c) SELECT doc_id, k AS chunk_index, md5({whole_sql('h', '')}) AS text_md5 FROM h""")
def chunk_text_legacy(spark, sf):
    return chunking.text_chunks(docs(spark, sf), 512, 64).select("doc_id", F.col("chunk_index").cast("long").alias("chunk_index"), F.md5("text").alias("text_md5"))


@query("context_text", f"WITH {cut_sql(1000, CENTRED)} SELECT doc_id, k AS chunk_index, md5({whole_sql(CUT_HEX, REPLACED)}) AS text_md5 FROM q")
def context_text(spark, sf):
    t = chunking.truncate(chunking.chunk(docs(spark, sf), 512, 0, context=2048, stride=4), 1000)
    return t.select("doc_id", F.col("chunk_index").cast("long").alias("chunk_index"), F.md5(text.lossy(F.col("teacher_input_bytes"))).alias("text_md5"))


# Responses, failures, streams

# A response for each vector, in four shapes by vec_id: two positions after a null and a number of tokens; a position without
# numeric keys and a list of tokens; the list alone; one position and a count. Numbers come from the vector's components.

COMPLETION_SQL = """WITH v AS (SELECT vec_id, vec_id % 4 AS kind, list_transform(embedding, lambda y: CAST(floor(abs(CAST(y AS DOUBLE)) * 1000) AS BIGINT)) AS m FROM embeddings),
r AS (SELECT *, list_sort(list_transform(range(1, 9), lambda i: {'down': m[i], 'id': i})) AS one, list_sort(list_transform(range(9, 17), lambda i: {'down': m[i], 'id': i})) AS two FROM v)
SELECT vec_id, CASE kind WHEN 0 THEN m[1] WHEN 3 THEN m[2] ELSE vec_id % 5 + 1 END AS tokens, CAST(CASE kind WHEN 0 THEN 2 WHEN 3 THEN 1 END AS BIGINT) AS n_rows,
  CASE WHEN kind IN (0, 3) THEN one[1].id || ':' || -one[1].down || ',' || one[2].id || ':' || -one[2].down END || CASE WHEN kind = 0 THEN ';' || two[1].id || ':' || -two[1].down || ',' || two[2].id || ':' || -two[2].down ELSE '' END AS ids FROM r"""


@query("completion_parse", COMPLETION_SQL)
def completion_parse(spark, sf):
    m = F.transform("embedding", lambda y: F.floor(F.abs(y.cast("double")) * 1000).cast("long"))
    v = _embedded(spark, sf).select("vec_id", (F.col("vec_id") % 4).alias("kind"), m.alias("m"))
    position = lambda low: F.concat(F.lit("{"), F.array_join(F.transform(F.sequence(F.lit(low), F.lit(low + 7)), lambda i: F.concat(F.lit('"'), i, F.lit('":-'), F.col("m")[i - 1])), ","), F.lit("}"))
    told = lambda tops, rest: F.concat(F.lit('{"choices":[{"logprobs":{"top_logprobs":['), tops, F.lit("]}}],"), rest, F.lit("}"))
    tokens = F.concat(F.lit("["), F.array_join(F.sequence(F.lit(0).cast("long"), F.col("vec_id") % 5), ","), F.lit("]"))
    body = (
        F.when(F.col("kind") == 0, told(F.concat(F.lit("null,"), position(1), F.lit(","), position(9)), F.concat(F.lit('"n_tokens":'), F.col("m")[0])))
        .when(F.col("kind") == 1, told(F.concat(position(1), F.lit(',{"the":-0.1}')), F.concat(F.lit('"tokens":'), tokens)))
        .when(F.col("kind") == 2, tokens)
        .otherwise(told(position(1), F.concat(F.lit('"count":'), F.col("m")[1])))
    )
    b = v.select("vec_id", body.alias("body")).withColumn("r", completions.top_rows(F.col("body"), 2))
    ids = F.array_join(F.transform("r", lambda row: F.array_join(F.transform(row, lambda p: F.concat_ws(":", p["id"].cast("string"), p["logprob"].cast("long").cast("string"))), ",")), ";")
    return b.select("vec_id", completions.token_count(F.col("body")).cast("long").alias("tokens"), F.when(F.col("r").isNotNull(), F.size("r")).cast("long").alias("n_rows"), ids.alias("ids"))


@query("candidate_signals", """WITH v AS (SELECT vec_id, list_transform(list_sort(list_transform(embedding, lambda y: -abs(CAST(y AS DOUBLE))), 'DESC')[1:8], lambda y: y) AS l FROM embeddings),
w AS (SELECT vec_id, l, list_sum(list_transform(l, lambda y: exp(y - l[1]))) AS z FROM v) SELECT vec_id, round(list_sum(list_transform(l, lambda y: -exp(y - l[1]) / z * ln(exp(y - l[1]) / z))), 6) AS entropy, round(l[1] - l[2], 6) AS gap FROM w""")
def candidate_signals(spark, sf):
    lp = F.slice(F.sort_array(F.transform("embedding", lambda x: -F.abs(x.cast("double"))), asc=False), 1, 8)
    rows = _embedded(spark, sf).select("vec_id", F.array(lp).alias("rows"))
    return rows.select("vec_id", r6(signals.mean_entropy(F.col("rows"))).alias("entropy"), r6(F.get(signals.top_gaps(F.col("rows")), F.lit(0))).alias("gap"))


class Fragile(teachers.Dummy):
    """Fails on inputs whose first byte is a capital T."""

    def topk(self, data, k=4):
        if any(d[:1] == b"T" for d in data):
            raise ValueError("an input begins with T")
        return super().topk(data, k)


@query("failure_deadletter", f"""WITH {chunk_sql(4096, 256)} SELECT doc_id, k AS chunk_index, CASE WHEN substr(x, 2 * s + 1, 2) = '54' THEN 'ValueError: an input begins with T' END AS error FROM c""")
def failure_deadletter(spark, sf):
    return stages.infer(chunks(spark, sf), Fragile(), "raw_bytes", 4).select("doc_id", F.col("chunk_index").cast("long").alias("chunk_index"), "error")


@query("stream_append", "SELECT event_id, event_type, round(value, 6) AS value FROM events")
def stream_append(spark, sf):
    import uuid

    from ..streaming.append import stream_events

    folder = f"{shared_dir(spark)}/stream-{uuid.uuid4().hex}"
    schema = spark.read.parquet(f"{sf}/events.parquet").schema.simpleString()[7:-1].replace(":", " ")
    for _ in range(2):  # the second run, from a new checkpoint, sends every row again
        stream_events(spark, f"{sf}/events.parque[t]", schema, f"{folder}/table", f"{folder}/checkpoint-{uuid.uuid4().hex}").awaitTermination()
    return spark.read.parquet(f"{folder}/table").select("event_id", "event_type", r6("value").alias("value"))
