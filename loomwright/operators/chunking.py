"""Byte chunks of documents and the long-context windows around them.

Everything is narrow: chunks and windows are computed inside the row of their document, so there is no join of chunks with
their neighbours and no shuffle, whatever the stride.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import utf8


def check_chunking(size: int, overlap: int) -> None:
    if size <= 0:
        raise ValueError("chunk_bytes must be > 0")
    if not 0 <= overlap < size:
        raise ValueError("overlap_bytes must be in [0, chunk_bytes)")


def window_bounds(target_start: Column, target_end: Column, low: Column, high: Column, context: int) -> tuple[Column, Column]:
    """The neighbourhood [low, high) if it fits into context, else a window of context bytes (or the target, if longer) with the
    target in its middle, moved to stay inside."""
    length = F.greatest(F.lit(context), target_end - target_start)
    centred = target_start - F.floor((length - (target_end - target_start)) / 2)
    start = F.least(F.greatest(centred, low), high - length)
    fits = high - low <= context
    return F.when(fits, low).otherwise(start).cast("long"), F.when(fits, high).otherwise(start + length).cast("long")


def chunk(docs: DataFrame, size: int = 4096, overlap: int = 256, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = (), context: int | None = None, stride: int = 1) -> DataFrame:
    """doc_id, chunk_index, prev and next index, byte_start, byte_end, raw_bytes; one row for each chunk, none for an empty text.

    The last chunk may lie inside the one before. context: also window_byte_start, window_byte_end, window_raw_bytes and the
    target's offsets in that window, out of stride chunks to either side.
    """
    check_chunking(size, overlap)
    if context is not None and (context <= 0 or stride < 0):
        raise ValueError("context_window must be > 0 and stride >= 0")
    step = size - overlap
    rows = docs.select(F.col(id_col).alias("doc_id"), *keep, utf8(F.coalesce(F.col(text_col).cast("string"), F.lit(""))).alias("_data")).withColumn("_n", F.octet_length("_data").cast("long"))
    count = F.ceil(F.col("_n") / step).cast("int")

    def one(k: Column) -> Column:
        start = k.cast("long") * step
        end = F.least(start + size, F.col("_n"))
        cells = [
            k.cast("int").alias("chunk_index"), F.when(k > 0, k - 1).cast("int").alias("prev_chunk_index"), F.when(k < count - 1, k + 1).cast("int").alias("next_chunk_index"),
            start.alias("byte_start"), end.alias("byte_end"), F.substring(F.col("_data"), (start + 1).cast("int"), (end - start).cast("int")).alias("raw_bytes"),
        ]
        if context is not None:
            low = F.greatest(k - stride, F.lit(0)).cast("long") * step
            high = F.least(F.least(k.cast("long") + stride, count - 1) * step + size, F.col("_n"))
            a, b = window_bounds(start, end, low, high, context)
            cells += [
                a.alias("window_byte_start"), b.alias("window_byte_end"), F.substring(F.col("_data"), (a + 1).cast("int"), (b - a).cast("int")).alias("window_raw_bytes"),
                (start - a).alias("target_start_in_window"), (end - a).alias("target_end_in_window"),
            ]
        return F.struct(*cells)

    return rows.filter("_n > 0").select("doc_id", *keep, F.inline(F.transform(F.sequence(F.lit(0), count - 1), one)))


def reassemble(chunks: DataFrame) -> DataFrame:
    """The bytes of each document from its overlapping chunks: doc_id, data. Bytes that no chunk has are zero."""
    parts = F.array_sort(F.collect_list(F.struct("byte_start", "byte_end", "raw_bytes")))
    start = F.struct(F.lit(0).cast("long").alias("at"), F.unhex(F.lit("")).alias("data"))

    def step(acc: Column, p: Column) -> Column:
        gap = F.greatest(p["byte_start"] - acc["at"], F.lit(0))
        seen = F.greatest(acc["at"] - p["byte_start"], F.lit(0))
        fresh = F.substring(p["raw_bytes"], (seen + 1).cast("int"), F.greatest(p["byte_end"] - p["byte_start"] - seen, F.lit(0)).cast("int"))
        zeros = F.unhex(F.repeat(F.lit("00"), gap.cast("int")))
        return F.struct(F.greatest(acc["at"], p["byte_end"]).alias("at"), F.concat(acc["data"], zeros, fresh).alias("data"))

    return chunks.groupBy("doc_id").agg(parts.alias("_p")).select("doc_id", F.aggregate("_p", start, step, lambda a: a["data"]).alias("data"))


def text_chunks(docs: DataFrame, size: int, overlap: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The older form: chunks as text, the bytes of cut characters left out."""
    raw = F.col("raw_bytes")
    # a cut character leaves up to three of its bytes at either end
    before = F.length(F.regexp_extract(F.hex(F.substring(raw, 1, 3)), "^((?:[89AB].)*)", 1)) / 2
    after = F.length(F.regexp_extract(F.hex(F.substring(raw, -3, 3)), "^(?:..)*?([CD].|E.(?:[89AB].)?|F.(?:[89AB].){0,2})$", 1)) / 2
    whole = F.substring(raw, (before + 1).cast("int"), (F.octet_length(raw) - before - after).cast("int"))
    return chunk(docs, size, overlap, id_col, text_col).select("doc_id", "chunk_index", whole.cast("string").alias("text"))


WINDOW_POLICIES = ("left_biased", "right_biased", "center_target")
TARGET_POLICIES = ("preserve_full", "truncate_if_needed")


def truncation(n: Column, start: Column, end: Column, most: int, window_policy: str = "center_target", target_policy: str = "preserve_full") -> Column:
    """How a window of n bytes with the target [start, end) is cut to most bytes: a struct of start and end in the window, the
    target's offsets in the cut window, and whether it was cut. Unknown policies are center_target and preserve_full."""
    window_policy = window_policy if window_policy in WINDOW_POLICIES else "center_target"
    target_policy = target_policy if target_policy in TARGET_POLICIES else "preserve_full"
    size = end - start
    clamp = lambda x: F.least(F.greatest(x, F.lit(0).cast("long")), n - most)
    middle = {"left_biased": clamp(end - most), "right_biased": clamp(start), "center_target": clamp(start + F.floor(size / 2) - most // 2)}[window_policy]
    if target_policy == "preserve_full":
        long_start, long_end = start, end
    else:
        inside = {"left_biased": end - most, "right_biased": start, "center_target": start + F.floor((size - most) / 2)}[window_policy]
        long_start, long_end = inside, inside + most
    whole, long = n <= most, size > most
    a = F.when(whole, F.lit(0)).when(long, long_start).otherwise(middle).cast("long")
    b = F.when(whole, n).when(long, long_end).otherwise(middle + most).cast("long")
    return F.struct(a.alias("start"), b.alias("end"), (F.greatest(start, a) - a).alias("target_start"), (F.least(end, b) - a).alias("target_end"), (~whole).alias("truncated"))


def truncate(windows: DataFrame, most: int, window_policy: str = "center_target", target_policy: str = "preserve_full") -> DataFrame:
    """Adds teacher_input_bytes, target_start and target_end in it, and context_truncation to windows of chunk(context=...)."""
    if most <= 0:
        raise ValueError("max_teacher_context must be > 0")
    n = F.octet_length("window_raw_bytes").cast("long")
    cut = windows.withColumn("_t", truncation(n, F.col("target_start_in_window"), F.col("target_end_in_window"), most, window_policy, target_policy))
    told = F.struct(
        F.col("_t.truncated").alias("truncated"), F.lit(window_policy).alias("window_policy"), F.lit(target_policy).alias("target_region_policy"), n.alias("original_bytes"),
        (F.col("_t.end") - F.col("_t.start")).alias("final_bytes"), F.col("target_start_in_window").alias("original_target_start"), F.col("target_end_in_window").alias("original_target_end"),
        F.when(F.col("_t.truncated"), F.col("_t.start")).alias("window_start"), F.when(F.col("_t.truncated"), F.col("_t.end")).alias("window_end"),
    )
    return cut.withColumns({
        "teacher_input_bytes": F.expr("substring(window_raw_bytes, int(_t.start) + 1, int(_t.end - _t.start))"),
        "target_start": F.col("_t.target_start"), "target_end": F.col("_t.target_end"), "context_truncation": told,
    }).drop("_t")
