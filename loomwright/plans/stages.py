"""The three teacher stages over chunks, each a lazy DataFrame; failed records are kept apart in the column error."""

from __future__ import annotations

import json
from collections.abc import Collection, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import prompts, text
from ..functions.schema import schema
from ..operators import chunking
from ..operators.records import apply_policy, check_policy
from .teachers import Output, Teacher, require

OUTPUTS = schema(
    "top_k_ids array<array<long>>, top_k_logprobs array<array<double>>, entropy double, per_token_entropy array<double>, per_token_top1_gap array<double>, "
    "per_token_token_ids array<long>, per_token_valid_mask array<boolean>, hidden_summary array<double>, teacher_input_byte_length long, teacher_input_token_length long, error string"
)
BATCH = 16


def infer(rows: DataFrame, teacher: Teacher, data: str, k: int, fields: Collection[str] | None = None) -> DataFrame:
    """Adds the teacher's outputs of rows[data]. A record whose batch fails is tried alone; if that fails, its error is kept.

    fields: the lists that are used, as Spark cannot tell; other lists stay null and are not moved out of Python. All if None.
    """
    kept = [c for c in rows.columns if c not in OUTPUTS.fieldNames()]
    rows = rows.select(*kept)
    made = T.StructType([*(rows.schema[c] for c in kept), *OUTPUTS.fields])
    types = [pa.list_(pa.list_(pa.int64())), pa.list_(pa.list_(pa.float64())), pa.float64(), pa.list_(pa.float64()), pa.list_(pa.float64()), pa.list_(pa.int64()), pa.list_(pa.bool_()), pa.list_(pa.float64()), pa.int64(), pa.int64(), pa.string()]

    def used(n: int, cols: list[pa.Array]) -> list[pa.Array]:
        unused = [fields is not None and pa.types.is_list(t) and f not in fields for f, t in zip(OUTPUTS.fieldNames(), types, strict=True)]
        return [pa.nulls(n, t) if no else c for no, c, t in zip(unused, cols, types, strict=True)]

    def tried(inputs: list[bytes]) -> list[tuple[Output | None, str | None]]:
        try:
            out = teacher.topk(inputs, k)
            if len(out) != len(inputs):
                raise ValueError("the teacher gave another number of outputs")
            return [(o, None) for o in out]
        except Exception as e:
            if len(inputs) == 1:
                return [(None, f"{type(e).__name__}: {e}")]
            return [x for i in inputs for x in tried([i])]

    def whole_batch(inputs: list[bytes]) -> list[pa.Array] | None:
        try:
            return teacher.arrays(inputs, k) if fields is None else teacher.arrays(inputs, k, fields)
        except Exception:  # which record it is comes out one by one
            return None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        teacher.open()
        try:
            for whole in batches:
                for at in range(0, whole.num_rows, BATCH):
                    b = whole.slice(at, BATCH)
                    inputs = [x or b"" for x in b.column(kept.index(data)).to_pylist()]
                    if (made_arrays := whole_batch(inputs)) is not None:
                        sizes = pa.array([len(d) for d in inputs], pa.int64())
                        cols = [*made_arrays[:8], sizes, made_arrays[8], pa.nulls(len(inputs), pa.string())]
                        yield pa.RecordBatch.from_arrays([*b.columns, *(c.cast(t) for c, t in zip(used(len(inputs), cols), types, strict=True))], made.fieldNames())
                        continue
                    cells = []
                    for (o, error), d in zip(tried(inputs), inputs, strict=True):
                        if o is None:
                            cells.append((None,) * 8 + (len(d), None, error))
                        else:
                            cells.append((o.ids, o.logprobs, o.entropy, o.per_token_entropy, o.per_token_top1_gap, o.per_token_token_ids, o.per_token_valid_mask, o.hidden_summary, len(d), o.tokens, None))
                    cols = [pa.array(c, t) for c, t in zip(zip(*cells, strict=True), types, strict=True)]
                    yield pa.RecordBatch.from_arrays([*b.columns, *used(len(inputs), cols)], made.fieldNames())
        finally:
            teacher.close()

    return rows.mapInArrow(run, made)


def token_lengths(rows: DataFrame, teacher: Teacher, data: str) -> DataFrame:
    """Adds teacher_input_byte_length and teacher_input_token_length of rows[data] as the teacher would read it, without inference."""
    kept = [c for c in rows.columns if c not in ("teacher_input_byte_length", "teacher_input_token_length")]
    rows = rows.select(*kept)
    made = T.StructType([*(rows.schema[c] for c in kept)]).add("teacher_input_byte_length", "long").add("teacher_input_token_length", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        teacher.open()
        try:
            for whole in batches:
                for at in range(0, whole.num_rows, BATCH):
                    b = whole.slice(at, BATCH)
                    texts = [(x or b"").decode("utf-8", "replace") for x in b.column(kept.index(data)).to_pylist()]
                    counts = [[len(t.encode()) for t in texts], teacher.token_lengths(texts)]
                    yield pa.RecordBatch.from_arrays([*b.columns, *(pa.array(c, pa.int64()) for c in counts)], made.fieldNames())
        finally:
            teacher.close()

    return rows.mapInArrow(run, made)


def complete(rows: DataFrame, teacher: Teacher, prompt: str, options: dict[str, Any]) -> DataFrame:
    """Adds completion_text and error for rows[prompt]."""
    kept = [c for c in rows.columns if c not in ("completion_text", "error")]
    rows = rows.select(*kept)
    made = T.StructType([*(rows.schema[c] for c in kept)]).add("completion_text", "string").add("error", "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        teacher.open()
        try:
            for whole in batches:
                for at in range(0, whole.num_rows, BATCH):
                    b = whole.slice(at, BATCH)
                    texts, errors = [], []
                    for p in b.column(kept.index(prompt)).to_pylist():
                        try:
                            texts.append(teacher.structured([p], [options])[0])
                            errors.append(None)
                        except Exception as e:
                            texts.append(None)
                            errors.append(f"{type(e).__name__}: {e}")
                    yield pa.RecordBatch.from_arrays([*b.columns, pa.array(texts, pa.string()), pa.array(errors, pa.string())], made.fieldNames())
        finally:
            teacher.close()

    return rows.mapInArrow(run, made)


def _named(rows: DataFrame, stage: str, teacher: Teacher, mode: str) -> DataFrame:
    return rows.withColumns({"stage_name": F.lit(stage), "teacher_name": F.lit(teacher.name), "mode": F.lit(mode)})


def stage_a(chunks: DataFrame, teacher: Teacher, k: int = 32, mode: str = "topk_logits", filtering: bool = False, selection: str = "none", entropy: float | None = None, gap: float | None = None, radius: int = 0, combine: str = "union", minimum: int | None = None, fields: Collection[str] | None = None) -> DataFrame:
    """Candidates and signals of every chunk, then the position policy. The signals that thresholds need must be supported.
    fields: as in infer."""
    if filtering:
        check_policy(selection, entropy, gap, radius, minimum)
    signals = (("per_token_entropy",) if filtering and entropy is not None else ()) + (("per_token_top1_gap",) if filtering and gap is not None else ())
    require(teacher.name, mode, signals)
    out = _named(infer(chunks, teacher, "raw_bytes", k, fields), "stage_a", teacher, mode)
    if not filtering or selection == "none":
        return out
    good = apply_policy(out.filter("error is null"), selection, entropy, gap, radius, combine, minimum)
    return good.unionByName(out.filter("error is not null"), allowMissingColumns=True)


def stage_b(windows: DataFrame, teacher: Teacher, most: int, k: int = 32, mode: str = "long_context", window_policy: str = "center_target", target_policy: str = "preserve_full", selection: str = "none") -> DataFrame:
    """Candidates of every chunk's long context, cut to most bytes. windows: of chunk(context=...).

    teacher_window_byte_* is the neighbourhood's window in the document; the target's offsets are in the cut window.
    """
    if selection != "none":
        raise NotImplementedError("position filtering is for stage A")
    require(teacher.name, mode)
    cut = chunking.truncate(windows, most, window_policy, target_policy)
    rows = cut.withColumns({
        "target_doc_id": F.col("doc_id"), "target_chunk_index": F.col("chunk_index"), "target_byte_start": F.col("byte_start"), "target_byte_end": F.col("byte_end"),
        "teacher_window_byte_start": F.col("window_byte_start"), "teacher_window_byte_end": F.col("window_byte_end"),
        "target_start_offset_within_window": F.col("target_start"), "target_end_offset_within_window": F.col("target_end"),
        "long_context_text": text.lossy(F.col("teacher_input_bytes")),
    }).drop("window_raw_bytes", "window_byte_start", "window_byte_end", "target_start_in_window", "target_end_in_window", "target_start", "target_end")
    return _named(infer(rows, teacher, "teacher_input_bytes", k), "stage_b", teacher, mode)


def stage_c(chunks: DataFrame, teacher: Teacher, template: str = "summarize_chunk", options: dict[str, Any] | None = None, mode: str = "structured_outputs", deterministic: bool = True, k: int = 16) -> DataFrame:
    """Completions of prompts over chunks, or candidates of the chunks. Position fields of earlier stages are cleared."""
    require(teacher.name, mode)
    fresh = chunks.drop(*OUTPUTS.fieldNames())
    if mode == "topk_logits":
        return _named(infer(fresh, teacher, "raw_bytes", k), "stage_c", teacher, mode).withColumn("structured_output", F.lit(None).cast(structured_type()))
    record = prompts.prompt_record(template, options, deterministic)
    rows = complete(fresh.withColumn("_prompt", record).withColumn("_text", F.col("_prompt.prompt_text")), teacher, "_text", dict(options or {}))
    made = F.struct(
        F.col("_prompt.task_type").alias("task_type"), F.col("_prompt.prompt_text").alias("prompt_text"), F.col("completion_text"),
        F.map_concat(F.col("_prompt.template_metadata"), F.create_map(F.lit("template_name"), F.lit(template), F.lit("deterministic"), F.lit(json.dumps(deterministic)))).alias("teacher_metadata"),
    )
    out = rows.withColumn("structured_output", F.when(F.col("error").isNull(), made)).drop("_prompt", "_text", "completion_text")
    blank = {f.name: F.lit(None).cast(f.dataType) for f in OUTPUTS.fields if f.name != "error"}
    return _named(out.withColumns(blank), "stage_c", teacher, mode)


def structured_type() -> str:
    return "struct<task_type:string,prompt_text:string,completion_text:string,teacher_metadata:map<string,string>>"


def parted(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Records without and with an error."""
    return rows.filter("error is null").drop("error"), rows.filter("error is not null")


def is_whole(rows: DataFrame) -> Column:
    """Whether a structured output has what it must have."""
    return F.col("structured_output.task_type").isNotNull() & (F.col("structured_output.prompt_text") != "") & F.col("structured_output.completion_text").isNotNull()
