"""Quality metrics, summaries and comparisons of teacher records: one scan and one aggregation each."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import positions, signals

TOLERANCE = 1e-9


def _width() -> Column:
    return F.when(F.col("top_k_ids").isNotNull(), signals.width(F.col("top_k_ids")))


def _tokens() -> Column:
    explicit = F.col("teacher_input_token_length")
    return F.coalesce(explicit, F.when(F.col("top_k_ids").isNotNull(), F.size("top_k_ids")))


def stage_sanity(records: DataFrame) -> DataFrame:
    """For each stage: records, entropies, chunk length, candidates, bytes and tokens of the teacher's input."""
    chunk = F.col("byte_end") - F.col("byte_start")
    size = F.coalesce(F.col("teacher_input_byte_length"), F.octet_length("raw_bytes").cast("long"))
    out = records.groupBy("stage_name").agg(
        F.count(F.lit(1)).alias("record_count"), F.avg("entropy").alias("avg_entropy"), F.min("entropy").alias("min_entropy"), F.max("entropy").alias("max_entropy"),
        F.coalesce(F.avg(chunk), F.lit(0.0)).alias("avg_chunk_length"), F.coalesce(F.avg(_width()), F.lit(0.0)).alias("avg_topk_width"), F.avg(size).alias("avg_teacher_input_bytes"),
        F.avg(_tokens()).alias("avg_teacher_input_tokens"), F.min(_tokens()).alias("min_teacher_input_tokens"), F.max(_tokens()).alias("max_teacher_input_tokens"),
    )
    return out.withColumn("avg_bytes_per_token", F.when(F.col("avg_teacher_input_tokens") > 0, F.col("avg_teacher_input_bytes") / F.col("avg_teacher_input_tokens")))


def by_key(records: DataFrame, key: str) -> DataFrame:
    """Records and mean entropy of each stage or teacher; a missing key is "missing", a key without entropies has none."""
    return records.groupBy(F.coalesce(F.col(key), F.lit("missing")).alias(key)).agg(F.count(F.lit(1)).alias("records"), F.avg("entropy").alias("avg_entropy"))


def histogram(values: DataFrame, column: str, bins: int = 10) -> DataFrame:
    """Equal-width bins: bin, bin_start, bin_end, count. One bin if all values are equal; none without values. The largest
    value falls into the last bin, whose end it is; empty bins have count 0."""
    spark = values.sparkSession
    bins = max(1, int(bins))
    v = values.select(F.col(column).cast("double").alias("v")).filter("v is not null")
    low, high = v.agg(F.min("v"), F.max("v")).collect()[0]
    if low is None:
        return spark.createDataFrame([], "bin int, bin_start double, bin_end double, count long")
    if low == high:
        return v.agg(F.count(F.lit(1)).alias("count")).select(F.lit(0).alias("bin"), F.lit(low).alias("bin_start"), F.lit(high).alias("bin_end"), "count")
    width = (high - low) / bins
    counted = v.groupBy(F.least(((F.col("v") - low) / width).cast("int"), F.lit(bins - 1)).alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    edges = spark.createDataFrame([(i, low + i * width, high if i == bins - 1 else low + (i + 1) * width) for i in range(bins)], "bin int, bin_start double, bin_end double")
    return edges.join(F.broadcast(counted), "bin", "left").select("bin", "bin_start", "bin_end", F.coalesce("n", F.lit(0)).alias("count"))


def selection_summary(records: DataFrame) -> DataFrame:
    """One row about position filtering; a null metadata field counts as absent."""
    window = F.col("selected_window_start").isNotNull() & F.col("selected_window_end").isNotNull()
    marked = F.col("selected_window_start").isNotNull() | F.col("selected_position_mask").isNotNull() | F.col("selection_policy").isNotNull() | F.col("selected_positions").isNotNull()
    length = F.when(window, F.greatest(F.lit(0), F.col("selected_window_end") - F.col("selected_window_start") + 1))
    return records.agg(
        F.count_if(window).alias("selected_window_record_count"), F.avg(length).alias("average_selected_window_length"), F.avg("selected_position_count").alias("average_selected_position_count"),
        F.coalesce(F.bool_or(F.col("selected_position_mask").isNotNull()), F.lit(False)).alias("position_masks_present"),
        F.coalesce(F.avg(marked.cast("double")), F.lit(0.0)).alias("selection_filtered_record_proportion"),
    )


def record_summary(records: DataFrame) -> DataFrame:
    """One row: records, by stage and by teacher, mean chunk length and entropy, versions."""
    pairs = records.groupBy("stage_name", "teacher_name", "schema_version").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("byte_end") - F.col("byte_start")).alias("bytes"), F.sum("entropy").alias("e"), F.count("entropy").alias("en"))
    # a few rows, one for each stage, teacher and version
    listed = lambda key: F.array_sort(F.collect_set(F.col(key)))
    return pairs.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("record_count"), listed("stage_name").alias("stages"), listed("teacher_name").alias("teachers"),
        (F.sum("bytes") / F.sum("n")).alias("avg_chunk_length"), (F.sum("e") / F.sum("en")).alias("avg_entropy"), listed("schema_version").alias("versions"),
    )


def summary_facts(records: DataFrame) -> DataFrame:
    """The summary as rows (fact, value), to compare two tables."""
    total = records.agg(F.count(F.lit(1)).cast("double").alias("records"), F.avg(F.col("byte_end") - F.col("byte_start")).alias("avg_chunk_length"), F.avg("entropy").alias("avg_entropy"))
    facts = [total.select(F.explode(F.array(*(F.struct(F.lit(c).alias("fact"), F.col(c).alias("value")) for c in total.columns))).alias("f")).select("f.*")]
    for key in ("stage_name", "teacher_name"):
        facts.append(by_key(records, key).select(F.concat(F.lit(f"{key}:"), F.col(key)).alias("fact"), F.col("records").cast("double").alias("value")))
    return reduce(DataFrame.unionByName, facts)


def compare(left: DataFrame, right: DataFrame, tolerance: float = TOLERANCE) -> DataFrame:
    """fact, left_value, right_value, differs; means may differ by tolerance."""
    a, b = summary_facts(left).withColumnRenamed("value", "left_value"), summary_facts(right).withColumnRenamed("value", "right_value")
    near = F.coalesce(F.abs(F.col("left_value") - F.col("right_value")) <= tolerance, F.col("left_value").eqNullSafe(F.col("right_value")))
    return a.join(b, "fact", "full_outer").withColumn("differs", ~near)


def token_cost(counts: DataFrame, max_context: int, share: float = 0.9) -> DataFrame:
    """Of n_bytes and n_tokens: means, extremes, bytes per token, and the share of inputs near the limit."""
    near = max(1, int(max_context * share))
    return counts.agg(
        F.count(F.lit(1)).alias("inputs"), F.avg("n_bytes").alias("avg_bytes"), F.avg("n_tokens").alias("avg_tokens"), F.min("n_tokens").alias("min_tokens"), F.max("n_tokens").alias("max_tokens"),
        (F.avg("n_bytes") / F.avg("n_tokens")).alias("bytes_per_token"), F.avg((F.col("n_tokens") >= near).cast("double")).alias("near_limit_share"),
    )


def policy_preview(masks: DataFrame, windows: str = "windows", mask: str = "mask") -> DataFrame:
    """What a policy would keep: positions, windows, and the mean share of positions that lie in windows."""
    inside = F.aggregate(windows, F.lit(0), lambda s, w: s + w["end"] - w["start"] + 1)
    on = F.size(mask) - F.size(F.array_remove(mask, True))  # counted without a lambda for each position
    return masks.agg(
        F.count(F.lit(1)).alias("records"), F.sum(on).alias("selected_positions"), F.sum(F.size(windows)).alias("windows"),
        F.avg(F.when(F.size(mask) > 0, inside / F.size(mask)).otherwise(F.lit(0.0))).alias("mean_compression"),
    )


#: Facts that only inform: models may differ in them.
INFORMATIVE = ("token_length_count", "token_length_min", "token_length_max", "token_length_avg", "entropy_count", "entropy_min", "entropy_max", "entropy_avg", "width_avg")


def parity_facts(records: DataFrame, selection: str = "none", entropy: float | None = None, gap: float | None = None, combine: str = "union", minimum: int | None = None) -> DataFrame:
    """One row about the shape of a teacher's records, all doubles. Per-token fields that are plausible have an entry for each
    row of candidates, where there are any. selectable: records for which the policy yields a mask or a window."""
    lacking = {"teacher_input_token_length": "long", "per_token_entropy": "array<double>", "per_token_top1_gap": "array<double>"}
    records = records.withColumns({c: F.lit(None).cast(kind) for c, kind in lacking.items() if c not in records.columns})
    rows = F.when(F.col("top_k_ids").isNotNull(), F.size("top_k_ids")).otherwise(0)
    tokens, e = F.col("teacher_input_token_length"), F.col("entropy")
    facts = {"records": F.count(F.lit(1)), "with_topk": F.count_if(F.col("top_k_ids").isNotNull() & F.col("top_k_logprobs").isNotNull())}
    for name, c in (("token_length", tokens), ("entropy", e)):
        facts |= {f"{name}_count": F.count(c), f"{name}_min": F.min(c), f"{name}_max": F.max(c), f"{name}_avg": F.avg(c)}
    facts["width_avg"] = F.avg(_width())
    for name in ("per_token_entropy", "per_token_top1_gap"):
        there = F.col(name).isNotNull()
        facts |= {f"{name}_present": F.count_if(there), f"{name}_plausible": F.count_if(there & ((rows == 0) | (F.size(name) == rows)))}
    facts["invalid"] = F.count_if(signals.problem(F.col("top_k_ids"), F.col("top_k_logprobs"), e).isNotNull())
    if selection != "none":
        needed = [F.col(c) for c, threshold in (("per_token_entropy", entropy), ("per_token_top1_gap", gap)) if threshold is not None]
        there = reduce(lambda x, y: x & y, (c.isNotNull() for c in needed), F.lit(True))
        mask = F.when(there, positions.select(F.col("per_token_entropy"), F.col("per_token_top1_gap"), entropy, gap, combine, minimum))
        facts["selectable"] = F.count_if(mask.isNotNull() if selection == "position_mask" else F.exists(mask, lambda on: on))
    return records.agg(*(c.cast("double").alias(name) for name, c in facts.items()))


def parity(left: DataFrame, right: DataFrame, selection: str = "none", **policy) -> DataFrame:
    """Whether two teachers' records have one shape: a row for each check with both sides and PASS, WARN, FAIL or INFO.

    FAIL: numbers of records differ, a per-token field is not plausible, an output is not valid. WARN: candidates are missing on
    either side, a per-token field is present in unequal numbers, a policy selects nothing on either side.
    """

    def side(records: DataFrame, name: str) -> DataFrame:
        facts = parity_facts(records, selection, **policy)
        own = {f: F.col(f.replace("_plausible", "_present")) if f.endswith("_plausible") else F.col("records") for f in facts.columns}
        return facts.select(F.inline(F.array(*(F.struct(F.lit(f).alias("check"), F.col(f).alias(f"{name}_value"), own[f].alias(f"_{name}_of")) for f in facts.columns))))

    both = side(left, "left").join(F.broadcast(side(right, "right")), "check")  # a row for each fact
    check, a, b = F.col("check"), F.col("left_value"), F.col("right_value")
    whole = (a == F.col("_left_of")) & (b == F.col("_right_of"))
    verdict = (
        F.when(check.isin(*INFORMATIVE), "INFO")
        .when(check == "records", F.when(a == b, "PASS").otherwise("FAIL"))
        .when(check == "with_topk", F.when(whole, "PASS").otherwise("WARN"))
        .when(check == "invalid", F.when((a == 0) & (b == 0), "PASS").otherwise("FAIL"))
        .when(check == "selectable", F.when((a > 0) & (b > 0), "PASS").otherwise("WARN"))
        .when(F.endswith(check, F.lit("_plausible")), F.when(whole, "PASS").otherwise("FAIL"))
        .otherwise(F.when(a == b, "PASS").otherwise("WARN"))
    )
    return both.select("check", "left_value", "right_value", verdict.alias("verdict"))


def presence(records: DataFrame, fields: tuple[str, ...]) -> DataFrame:
    """One row: for each field whether any record has it."""
    return records.agg(*(F.coalesce(F.bool_or(F.col(c).isNotNull()), F.lit(False)).alias(c) for c in fields))
