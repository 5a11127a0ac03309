"""Sources: text folders, upstream tables, JSON lines, caches."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import codec, text
from ..functions.schema import schema
from . import files

SCHEMA_VERSION = "1.0"
PACKED = T.StructType([T.StructField("encoding", T.StringType()), T.StructField("dtype", T.StringType()), T.StructField("shape", T.ArrayType(T.IntegerType())), T.StructField("data_b64", T.StringType())])
#: The fields of a teacher record on the wire, with their types, in order.
WIRE = schema(
    "schema_version string, doc_id string, chunk_index int, byte_start long, byte_end long, raw_bytes_b64 string, split string, teacher_name string, stage_name string, mode string, "
    "target_doc_id string, target_chunk_index int, target_byte_start long, target_byte_end long, teacher_window_byte_start long, teacher_window_byte_end long, "
    "target_start_offset_within_window long, target_end_offset_within_window long, top_k_ids string, top_k_logprobs string, entropy double, per_token_entropy string, "
    "per_token_top1_gap string, per_token_token_ids string, per_token_valid_mask string, hidden_summary string, structured_output string, extra_metadata string"
)
REQUIRED = WIRE.fieldNames()[:10]


def text_folder(spark: SparkSession, path: str, glob: str = "*.txt", encoding: str = "utf-8", unix_newlines: bool = True) -> DataFrame:
    """doc_id (of the path below the folder), text, source_path; in no order, one row a file."""
    raw = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true").load(path)
    root = files._path(spark, path)[1].makeQualified(files._path(spark, path)[0]).toUri().getPath().rstrip("/") + "/"
    full = F.regexp_replace(F.col("path"), r"^[A-Za-z0-9+.-]+:(//[^/]*)?", "")
    relative = F.when(F.startswith(full, F.lit(root)), F.substring(full, F.lit(len(root) + 1), F.length(full))).otherwise(F.element_at(F.split(full, "/"), -1))
    body = F.decode("content", encoding)
    rows = raw.select(relative.alias("source_path"), (text.unix_newlines(body) if unix_newlines else body).alias("text"))
    return rows.select(text.path_id(F.col("source_path")).alias("doc_id"), "text", "source_path")


def text_file(spark: SparkSession, path: str) -> str:
    return spark.read.text(path, wholetext=True).first()[0]


def documents(table: DataFrame, id_col: str = "doc_id", text_col: str = "text", path_cols: tuple[str, ...] = ()) -> DataFrame:
    """A table as documents; path_cols: a path like a/b.txt is made of them and its hash is the id."""
    if path_cols:
        path = F.concat(F.concat_ws("/", *(F.col(c).cast("string") for c in path_cols)), F.lit(".txt"))
        return table.select(text.path_id(path).alias("doc_id"), text.unix_newlines(text.safe_text(F.col(text_col))).alias("text"), path.alias("source_path"))
    return table.select(F.col(id_col).cast("string").alias("doc_id"), text.unix_newlines(text.safe_text(F.col(text_col))).alias("text"))


def upstream(spark: SparkSession, path: str, kind: str = "parquet", ddl: str | None = None, config: str | None = None, split: str | None = None) -> DataFrame:
    """Rows of an upstream table: of the folder split below path, or of path itself.

    kind huggingface: of a downloaded snapshot in the usual layout, Parquet files <config or data>/<split>-*.parquet.
    """
    reader = spark.read.schema(ddl) if ddl else spark.read
    if kind == "huggingface":
        return reader.parquet(f"{path}/{config or 'data'}/{split or '*'}-*.parquet")
    path = f"{path}/{split}" if split else path
    return reader.format(kind).load(path)


def shard_paths(spark: SparkSession, path: str) -> list[str]:
    """A folder's *.jsonl in order; a file; or, where there is no such file, <stem>-*.jsonl beside it."""
    if files.is_dir(spark, path):
        return [f"{path.rstrip('/')}/{n}" for n in files.names(spark, path) if n.endswith(".jsonl")]
    if files.exists(spark, path):
        return [path]
    folder, _, name = path.rpartition("/")
    stem = name.removesuffix(".jsonl")
    found = [f"{folder}/{n}" for n in files.names(spark, folder or ".") if re.fullmatch(re.escape(stem) + r"-.*\.jsonl", n)]
    if not found:
        raise FileNotFoundError(path)
    return found


def lines(spark: SparkSession, path: str) -> DataFrame:
    """The lines that are not blank: value, file."""
    return spark.read.text(shard_paths(spark, path)).select("value", F.col("_metadata.file_path").alias("file")).filter(F.trim("value") != "")


def shard_counts(spark: SparkSession, path: str) -> DataFrame:
    return lines(spark, path).groupBy(F.element_at(F.split("file", "/"), -1).alias("shard")).agg(F.count(F.lit(1)).alias("records"))


def wire_records(spark: SparkSession, path: str) -> DataFrame:
    """JSON lines as wire records; a line without a required field, or of another version, fails the query."""
    parsed = lines(spark, path).select("value", F.from_json("value", WIRE, {"mode": "PERMISSIVE"}).alias("r"))
    missing = F.array_compact(F.array(*(F.when(F.get_json_object("value", f"$.{c}").isNull(), F.lit(c)) for c in REQUIRED if c != "chunk_index")))
    known = F.when(F.size(missing) > 0, F.raise_error(F.concat(F.lit("missing fields: "), F.array_join(missing, ", ")))).when(
        F.col("r.schema_version") != SCHEMA_VERSION, F.raise_error(F.concat(F.lit("unknown schema_version "), F.col("r.schema_version")))
    )
    return parsed.withColumn("_ok", known.cast("string")).filter("_ok is null").select("r.*")


def records(spark: SparkSession, path: str) -> DataFrame:
    """Wire records with raw bytes and numbers decoded."""
    kinds = {"top_k_ids": "array<array<long>>", "top_k_logprobs": "array<array<double>>", "per_token_entropy": "array<double>", "per_token_top1_gap": "array<double>", "per_token_token_ids": "array<long>", "per_token_valid_mask": "array<long>", "hidden_summary": "array<double>"}
    wire = wire_records(spark, path)
    return wire.withColumns({c: codec.unpacked_lines(F.col(c), k) for c, k in kinds.items()}).withColumn("raw_bytes", F.unbase64("raw_bytes_b64")).drop("raw_bytes_b64")


def cache(spark: SparkSession, root: str, source: str | None = None, split: str | None = None) -> DataFrame:
    """Cached documents; source and split prune partitions. An empty selection is an error."""
    df = spark.read.parquet(f"{root}/documents")
    if source is not None:
        df = df.filter(F.col("source_name") == source)
    if split is not None:
        df = df.filter(F.col("split") == split)
    if df.isEmpty():
        raise FileNotFoundError(f"no cached documents of {source or 'any source'}, {split or 'any split'}, in {root}")
    return df


def cache_refs(spark: SparkSession, root: str, sources: list[str]) -> dict[str, dict]:
    """For each source whether its manifest is there, and its fingerprint and time."""
    out = {}
    for s in sources:
        path = f"{root}/manifests/{s}.json"
        found = files.read_json(spark, path)
        there = files.exists(spark, path)
        out[s] = {"exists": there, "config_fingerprint": (found or {}).get("config_fingerprint"), "created_at": (found or {}).get("created_at"), "error": "unreadable" if there and found is None else None}
    return out
