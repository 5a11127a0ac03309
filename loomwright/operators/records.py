"""Teacher records: first-seen dedup, new rows only, shard numbers, policies of selected positions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import positions
from ..functions.identity import signature
from ..functions.lineage import saved

POSITION_FIELDS = ("top_k_ids", "top_k_logprobs", "per_token_entropy", "per_token_top1_gap", "per_token_token_ids", "per_token_valid_mask")


def first_seen(records: DataFrame, order: Sequence[str], windows: bool = False) -> DataFrame:
    """One row for each identity, the first in order."""
    w = Window.partitionBy("_signature").orderBy(*order)
    return records.withColumn("_signature", signature(windows)).withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n", "_signature")


def repeated(records: DataFrame, windows: bool = False) -> bool:
    """Whether any identity has more than one row. Only the identity's columns are read and only signatures are moved."""
    return not records.select(signature(windows).alias("_signature")).groupBy("_signature").count().filter("count > 1").isEmpty()


def new_only(records: DataFrame, existing: DataFrame, windows: bool = False) -> DataFrame:
    """Rows whose identity existing does not have; existing needs only the identity's columns.

    Signatures alone tell how many rows are new. If none or all are, no row is moved.
    """
    seen = existing.select(signature(windows).alias("_signature")).distinct()
    own = records.select(signature(windows).alias("_signature"))
    told = own.join(seen.withColumn("_seen", F.lit(True)), "_signature", "left").agg(F.count(F.lit(1)).alias("all"), F.count("_seen").alias("seen")).first()
    if told["seen"] == told["all"]:
        return records.limit(0)
    if not told["seen"]:
        return records
    return records.withColumn("_signature", signature(windows)).join(seen, "_signature", "left_anti").drop("_signature")


def numbered(records: DataFrame, order: Sequence[str], name: str = "ordinal") -> DataFrame:
    """Ordinals from 0 in a total order. Rows are sorted within ranges and written with their place in the range, so the numbers
    stay when an executor is lost; a range's first number is the sum of the sizes of those before."""
    spread = records.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_place", F.monotonically_increasing_id())
    placed = saved(spread, "numbered", "zstd").withColumn("_part", F.shiftright("_place", 33)).withColumn("_rank", F.col("_place").bitwiseAND((1 << 33) - 1))
    # a row for each range
    sizes = placed.groupBy("_part").count()
    before = sizes.select("_part", (F.sum("count").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, 0)) - F.col("count")).alias("_before"))
    return placed.join(F.broadcast(before), "_part").withColumn(name, F.col("_before") + F.col("_rank")).drop("_part", "_place", "_rank", "_before")


def sharded(records: DataFrame, size: int, order: Sequence[str], filled: int = 0) -> DataFrame:
    """Adds shard_id: exactly size rows a shard, in order. filled: rows that earlier shards hold, the last of which is filled first."""
    if size <= 0:
        raise ValueError("max_records_per_shard must be > 0")
    return numbered(records, order, "_at").withColumn("shard_id", F.floor((F.col("_at") + filled) / size).cast("int")).drop("_at")


def dense_windows(mask: Column) -> Column:
    return F.when(F.size(mask) > 0, F.array(F.struct(F.lit(0).alias("start"), (F.size(mask) - 1).alias("end"))))


def check_policy(mode: str, entropy: float | None, gap: float | None, radius: int = 0, minimum: int | None = None) -> None:
    if mode not in ("none", "position_mask", "selected_windows"):
        return
    if mode != "none" and entropy is None and gap is None:
        raise ValueError("position filtering needs entropy_threshold or top1_gap_threshold")
    if radius < 0 or (minimum is not None and minimum < 0):
        raise ValueError("radius and minimum must be >= 0")


def apply_policy(records: DataFrame, mode: str, entropy: float | None = None, gap: float | None = None, radius: int = 0, combine: str = "union", minimum: int | None = None) -> DataFrame:
    """Position filtering of a teacher's records.

    none, or an unknown mode: unchanged. position_mask: the record with its mask, positions and their number. selected_windows:
    one record for each merged window, its position fields cut to the window; a record without windows goes.
    """
    check_policy(mode, entropy, gap, radius, minimum)
    if mode not in ("position_mask", "selected_windows"):
        return records
    mask = positions.select(F.col("per_token_entropy"), F.col("per_token_top1_gap"), entropy, gap, combine, minimum)
    rows = records.withColumn("_mask", mask).withColumn("_on", positions.selected(F.col("_mask")))
    opt = lambda v, kind: F.lit(v).cast(kind)
    policy = F.struct(
        F.lit(mode).alias("selection_mode"), F.lit(combine).alias("combine_mode"), opt(entropy, "double").alias("entropy_threshold"), opt(gap, "double").alias("top1_gap_threshold"),
        F.lit(radius).alias("selection_window_radius"), opt(minimum, "int").alias("minimum_selected_positions"), F.size("_on").alias("selected_position_count_total"),
    )
    rows = rows.withColumn("selection_policy", policy)
    if mode == "position_mask":
        return rows.withColumns({"selected_position_mask": F.col("_mask"), "selected_positions": F.col("_on"), "selected_position_count": F.size("_on")}).drop("_mask", "_on")
    fields = [c for c in POSITION_FIELDS if c in records.columns]

    def cut(w: Column) -> Column:
        start, end = w["start"], w["end"]
        return F.struct(start.alias("selected_window_start"), end.alias("selected_window_end"), w["count"].alias("selected_position_count"), *(positions.sliced(F.col(c), start, end).alias(c) for c in fields))

    # the fields are cut before the rows multiply, so no row carries more than its window
    kept = [c for c in rows.columns if c not in (*fields, "_mask", "_on")]
    return rows.select(*kept, F.inline(F.transform(positions.windows(F.col("_mask"), radius), cut)))
