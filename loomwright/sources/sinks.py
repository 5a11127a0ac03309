"""Sinks: JSON lines in exact shards, Parquet, caches, manifests, failures."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import codec, text
from ..operators import records as R
from . import files
from .readers import SCHEMA_VERSION, WIRE, lines, shard_paths, wire_records

MANIFEST = "manifest.json"
FAILURES = "failures"


def now() -> str:
    return datetime.now(UTC).isoformat()


def to_wire(records: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """The columns of keep, and value: the JSON of each record; vectors packed, bytes in base64, fields that a record lacks null."""
    have = set(records.columns)
    whole, halves = ("top_k_ids", "per_token_token_ids", "per_token_valid_mask"), ("top_k_logprobs", "per_token_entropy", "per_token_top1_gap", "hidden_summary")
    nested = [*whole, *halves, "structured_output", "extra_metadata"]
    cols = []
    for f in WIRE.fields:
        c = f.name
        if c == "schema_version":
            v = F.lit(SCHEMA_VERSION)
        elif c == "raw_bytes_b64":
            v = text.base64_line(F.col("raw_bytes")) if "raw_bytes" in have else F.lit("")
        elif c not in have:
            v = F.lit(None).cast(f.dataType)
        elif c in whole or c in halves:
            v = codec.packed_lines(F.col(c), c in halves)
        elif c == "entropy":
            v = codec.half(F.col(c))
        elif c in nested and dict(records.dtypes)[c] != "string":
            v = F.to_json(c)
        else:
            v = F.col(c).cast(f.dataType)
        cols.append(v.alias(c))
    if "structured_output" not in have and "extra_metadata" in have and dict(records.dtypes)["extra_metadata"] == "string":
        cols[WIRE.fieldNames().index("structured_output")] = F.get_json_object("extra_metadata", "$.structured_output").alias("structured_output")
    fields = [f.name for f in WIRE.fields]
    row = records.select(*keep, *cols)
    # nested fields are JSON already, so the line is put together from its parts
    parts = [F.concat(F.lit(f'"{c}":'), F.coalesce(F.col(c) if c in nested else F.regexp_extract(F.to_json(F.struct(F.col(c).alias("v"))), r"(?s)^\{\"v\":(.*)\}$", 1), F.lit("null"))) for c in fields]
    parts = [F.when(F.col(c).isNull(), F.lit(f'"{c}":null')).otherwise(p) for c, p in zip(fields, parts, strict=True)]
    return row.select(*keep, F.concat(F.lit("{"), F.concat_ws(",", *parts), F.lit("}")).alias("value"))


def write_lines(rows: DataFrame, folder: str, size: int, prefix: str, order: tuple[str, ...], append: bool = False, value: str = "value", made: Callable[[DataFrame], DataFrame] | None = None) -> list[str]:
    """Lines of rows[value] in order into <prefix>-00000.jsonl and so on, size lines each, or one <prefix>.jsonl if size is 0.

    append: fills the last shard, then goes on numbering; else shards of that prefix are replaced. Every shard is written by one
    task and renamed into place. made: gives value, shard_id and the columns of order, of rows that were moved to their shards, as
    lines are wider than what they are made of.
    """
    spark = rows.sparkSession
    own = [n for n in files.names(spark, folder) if n.endswith(".jsonl") and (n == f"{prefix}.jsonl" or n.startswith(f"{prefix}-"))]
    held = spark.read.text([f"{folder}/{n}" for n in own[-1:]]) if append and own else None
    filled = 0
    if append and own and size:
        last = int(own[-1].removesuffix(".jsonl").rpartition("-")[2])
        filled = last * size + held.count()
    if size:
        placed = R.sharded(rows, size, order, filled)
    else:
        placed = rows.withColumn("shard_id", F.lit(0))
    part = f"{folder}/_part-{uuid.uuid4().hex}"
    dealt = placed.repartition("shard_id")
    (made(dealt) if made else dealt).sortWithinPartitions("shard_id", *order).select("shard_id", F.col(value).alias("value")).write.partitionBy("shard_id").text(part)
    if not append:
        for n in own:
            files.delete(spark, f"{folder}/{n}")
    out = []
    for shard in sorted((int(n.partition("=")[2]) for n in files.names(spark, part) if n.startswith("shard_id="))):
        made = next(n for n in files.names(spark, f"{part}/shard_id={shard}") if n.startswith("part-"))
        name = f"{folder}/{prefix}-{shard:05d}.jsonl" if size else f"{folder}/{prefix}.jsonl"
        fresh = f"{part}/shard_id={shard}/{made}"
        if append and files.exists(spark, name):
            # the last shard: at most size lines, old ones first
            old, new = files.read_text(spark, name), files.read_text(spark, fresh)
            files.write_text(spark, name, (old or "") + (new or ""))
        else:
            files.rename(spark, fresh, name)
        out.append(name)
    files.delete(spark, part)
    return out


def write_records(records: DataFrame, folder: str, split: str, order: tuple[str, ...] = ("doc_id", "chunk_index", "byte_start", "stage_name", "teacher_name"), size: int = 0, prefix: str | None = None, append: bool = False, deduplicate: bool = True, kind: str = "jsonl", compression: str | None = None) -> dict:
    """Writes one split: first of each identity, only new ones if append; then the manifest. Gives the counts."""
    spark = records.sparkSession
    name = prefix or split
    kept = R.first_seen(records, order) if deduplicate and R.repeated(records) else records
    if append and kind == "jsonl" and any(n.endswith(".jsonl") and n.startswith(name) for n in files.names(spark, folder)):
        kept = R.new_only(kept, wire_records(spark, f"{folder}/{name}.jsonl"))
    kept = kept.persist()
    try:
        total, written = records.count(), kept.count()
        if kind == "parquet":
            # partitioned by shard-free split; a rerun replaces the split only
            kept.write.mode("append" if append else "overwrite").option("compression", compression or "snappy").parquet(f"{folder}/{name}.parquet")
        elif written:
            # only what lines are made of, ordered by what lines will show
            have, used = set(kept.columns), {*WIRE.fieldNames(), "raw_bytes"}
            key = lambda c: (F.col(c) if c in have else F.lit(None)).cast("long" if c in ("chunk_index", "byte_start") else "string")
            keyed = kept.select(*(c for c in kept.columns if c in used), *(key(c).alias(f"_o{i}") for i, c in enumerate(order)))
            own = tuple(f"_o{i}" for i in range(len(order)))
            write_lines(keyed, folder, size, name, own, append, made=lambda rows: to_wire(rows, ("shard_id", *own)))
        stages = [tuple(r) for r in kept.select("stage_name", "teacher_name").distinct().collect()]
    finally:
        kept.unpersist()
    upsert_manifest(spark, folder, stages, total - written)
    return {"split": split, "records": written, "skipped": total - written}


def upsert_manifest(spark: SparkSession, folder: str, stages: list[tuple[str, str]], skipped: int, extra: dict | None = None) -> dict:
    """Adds a write to the folder's manifest: files with their counts, stages and teachers so far, rows skipped so far."""
    path = f"{folder}/{MANIFEST}"
    old = files.read_json(spark, path) or {}
    shards = [n for n in files.names(spark, folder) if n.endswith(".jsonl")]
    counts = {r["shard"]: r["records"] for r in lines(spark, folder).groupBy(F.element_at(F.split("file", "/"), -1).alias("shard")).agg(F.count(F.lit(1)).alias("records")).collect()} if shards else {}
    new = {
        "schema_version": SCHEMA_VERSION, "created_at": old.get("created_at", now()), "updated_at": now(), "output_files": {n: counts.get(n, 0) for n in shards}, "record_count": sum(counts.values()),
        "stages": sorted({*old.get("stages", []), *(s for s, _ in stages if s)}), "teachers": sorted({*old.get("teachers", []), *(t for _, t in stages if t)}), "skipped_records": old.get("skipped_records", 0) + skipped,
    } | (extra or {})
    files.write_json(spark, path, new)
    return new


def write_cache(docs: DataFrame, root: str, source: str, manifest: dict) -> None:
    """Cached documents of a source, replaced whole: root/documents/source_name=/split=, and its manifest."""
    spark = docs.sparkSession
    out = docs.withColumn("source_name", F.lit(source))
    out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("source_name", "split").parquet(f"{root}/documents")
    files.write_json(spark, f"{root}/manifests/{source}.json", manifest | {"created_at": now()})


def write_failures(failed: DataFrame, root: str) -> None:
    """Failed records to a folder of their own: timestamp, stage_name, teacher_name, doc_id, chunk_index, error_message."""
    failed.select(F.current_timestamp().alias("timestamp"), "stage_name", "teacher_name", "doc_id", "chunk_index", F.col("error").alias("error_message")).write.mode("append").json(f"{root}/{FAILURES}")


def merge_shards(spark: SparkSession, inputs: list[str], folder: str, size: int = 0) -> dict[str, list[str]]:
    """Shards <prefix>-ddddd.jsonl of several folders into one, lines as they are, one group for each prefix."""
    files.delete(spark, folder)
    found = [lines(spark, p).withColumn("_input", F.lit(i)) for i, p in enumerate(inputs)]
    rows = found[0]
    for f in found[1:]:
        rows = rows.unionByName(f)
    name = F.element_at(F.split("file", "/"), -1)
    rows = rows.withColumn("_prefix", F.coalesce(F.nullif(F.regexp_extract(name, r"^(.*)-\d{5}\.jsonl$", 1), F.lit("")), F.regexp_replace(name, r"\.jsonl$", ""))).withColumn("_name", name)
    rows = rows.withColumn("_line", F.monotonically_increasing_id()).persist()  # the order of lines within a file
    out = {}
    try:
        for p in sorted(r[0] for r in rows.select("_prefix").distinct().collect()):
            own = rows.filter(F.col("_prefix") == p)
            out[p] = write_lines(own, folder, size or max(1, own.count()), p, ("_input", "_name", "_line"))
    finally:
        rows.unpersist()
    counts = {r["shard"]: r["records"] for r in lines(spark, folder).groupBy(F.element_at(F.split("file", "/"), -1).alias("shard")).agg(F.count(F.lit(1)).alias("records")).collect()}
    source = files.read_json(spark, f"{inputs[0].rstrip('/')}/{MANIFEST}") or {}
    files.write_json(spark, f"{folder}/{MANIFEST}", source | {"merged_from": inputs, "output_files": counts, "record_count": sum(counts.values()), "updated_at": now()})
    return out


def shards_of(spark: SparkSession, path: str) -> list[str]:
    return shard_paths(spark, path)
