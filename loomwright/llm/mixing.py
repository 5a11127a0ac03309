"""Mixing sources to target weights by weighted fair queueing.

Every source shuffles its documents by a seeded hash and serves them in up to MAX_EPOCHS passes. A copy's virtual finish
time is the number of its source's words up to its end, divided by the source's target. The copies of all sources are taken
in order of finish time until the total budget is spent.

Prefix sums are made in buckets of about BUCKET_ROWS rows whose number follows the row count, so neither a hot source nor
the global order ever meets in one task; only totals per bucket are summed in sequence. The place where the budget ends is found
by histograms of CELLS cells, each of which refines the cell before in which the budget ends, until so few copies are left that
they can be put in order.

Cases: a null or empty text has size 0 and is taken 0 words; a null source is a source of its own, ordered last; null and
repeated ids are shuffled by their texts; repeated rows are rows of their own, and among equal ones it does not matter which is
taken; a very long text counts whole; an empty table gives an empty mix; other columns, whatever their names, do not matter.
"""

from __future__ import annotations

import math
from typing import NamedTuple

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import offsets, saved, word_count

WEIGHTS = (1, 2, 3)
MAX_EPOCHS = 3
BUCKET_ROWS = 2_000
CELLS = 4_096
#: The plan holds one entry for each source on the driver; more sources than this are refused.
MAX_SOURCES = 100_000


class Share(NamedTuple):
    source: str | None
    size: int
    rows: int
    target: float


def shares(totals: list[tuple[str | None, int, int]], weights=WEIGHTS, max_epochs: int = MAX_EPOCHS) -> list[Share]:
    """Targets of (source, size, rows): all sizes dealt out by weight; what is above max_epochs sizes is dealt out anew."""
    # Python compares strings by code point; None comes last
    totals = sorted(totals, key=lambda x: (x[0] is None, x[0] or ""))
    weight = [float(weights[i % len(weights)]) for i in range(len(totals))]
    caps = [max_epochs * x[1] for x in totals]
    target: list[float] = [0.0] * len(totals)
    open_ = set(range(len(totals)))
    left = sum(x[1] for x in totals)
    while open_:
        whole = sum(weight[i] for i in open_)
        for i in open_:
            target[i] = left * weight[i] / whole
        above = {i for i in open_ if target[i] > caps[i]}
        if not above:
            break
        for i in above:
            target[i] = float(caps[i])
            left -= caps[i]
        open_ -= above
    return [Share(s, n, rows, t) for (s, n, rows), t in zip(totals, target, strict=True)]


def _finish(df: DataFrame, plan: DataFrame, before: DataFrame) -> DataFrame:
    """Adds _cum, the words of the source up to the end of the row in its shuffled order, and the source's plan."""
    in_bucket = Window.partitionBy("_source", "_bucket").orderBy("_tie", "_id", "_text_hash", "_size").rowsBetween(Window.unboundedPreceding, 0)
    return (
        _bucketed(df, plan)
        .withColumn("_in", F.sum("_size").over(in_bucket))
        .join(before, ["_source", "_bucket"])
        .withColumn("_cum", F.col("_in") + F.col("_before"))
        .drop("_before", "_in")
    )


def _bucketed(df: DataFrame, plan: DataFrame) -> DataFrame:
    return df.join(F.broadcast(plan), "_source").withColumn("_bucket", F.shiftright(F.shiftright("_tie", 30) * F.col("_buckets"), 30)).drop("_buckets")


def _finish_time(epoch) -> F.Column:
    return F.when(F.col("_target") > 0, (F.lit(epoch) * F.col("_source_size") + F.col("_cum")) / F.col("_target"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: int = 17, weights=WEIGHTS, max_epochs: int = MAX_EPOCHS, carry: bool = False) -> DataFrame:
    """One row for each document: id, size, source_size, target, copies (how often the mix takes it), taken (copies * size).

    carry: the row itself, as the struct _row, comes along. A source is taken up to its target but for less than a document
    or two; no document is taken more than max_epochs times.
    """
    spark = docs.sparkSession
    keyed = docs.select(
        F.col(id_col).alias("_id"),
        F.coalesce(F.concat(F.lit("="), F.col(source_col).cast("string")), F.lit("")).alias("_source"),
        word_count(F.col(text_col)).alias("_size"),
        # 60 bits of a hash that other engines have too
        F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.lit(":"), F.md5(F.coalesce(F.col(text_col), F.lit("")))), 256), 1, 15), 16, 10).cast("long").alias("_tie"),
        F.xxhash64(F.col(text_col)).alias("_text_hash"),
        *([F.struct(*(docs[c] for c in docs.columns)).alias("_row")] if carry else []),
    )
    slim = saved(keyed.drop("_row"), "mix-sizes")
    totals = slim.groupBy("_source").agg(F.sum("_size").alias("n"), F.count(F.lit(1)).alias("rows")).limit(MAX_SOURCES + 1).collect()
    if len(totals) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    # the key of a source is "" for null, else "=" and its name
    found = shares([(r[0][1:] if r[0] else None, r[1], r[2]) for r in totals], weights, max_epochs)
    plan = spark.createDataFrame(
        [("" if x.source is None else f"={x.source}", x.size, x.target, max(1, math.ceil(x.rows / BUCKET_ROWS))) for x in found],
        "_source string, _source_size long, _target double, _buckets long",
    )
    sums = _bucketed(slim, plan).groupBy("_source", "_bucket").agg(F.sum("_size").alias("_n"))
    rows = sum(x.rows for x in found)
    before = saved(offsets(sums, "_source", "_bucket", "_n", "_before"), "mix-offsets", rows // BUCKET_ROWS + len(found))
    last = _cutoff(_finish(slim, plan, before), rows, sum(x.size for x in found), max_epochs)
    placed = _finish(keyed if carry else slim, plan, before)
    copies = sum((F.coalesce(_key(e) <= _literal(last), F.lit(False)).cast("long") for e in range(max_epochs)), F.lit(0).cast("long")) if last else F.lit(0).cast("long")
    return placed.select(
        F.col("_id").alias(id_col),
        F.col("_size").alias("size"),
        F.col("_source_size").alias("source_size"),
        F.col("_target").alias("target"),
        F.when(F.col("_size") > 0, copies).otherwise(F.lit(0).cast("long")).alias("copies"),
        *(["_row"] if carry else []),
    ).withColumn("taken", F.col("copies") * F.col("size"))


def _key(epoch) -> F.Column:
    """Place of a copy in the mix: by finish time, ties by hash, id and pass."""
    return F.struct(_finish_time(epoch).alias("f"), F.col("_tie").alias("t"), F.col("_id").cast("string").alias("i"), F.col("_text_hash").alias("h"), F.lit(epoch).cast("int").alias("e"))


def _literal(last) -> F.Column:
    return F.struct(F.lit(last["f"]).cast("double").alias("f"), F.lit(last["t"]).cast("long").alias("t"), F.lit(last["i"]).cast("string").alias("i"), F.lit(last["h"]).cast("long").alias("h"), F.lit(last["e"]).cast("int").alias("e"))


def _cutoff(placed: DataFrame, rows: int, budget: int, max_epochs: int):
    """The key of the last copy that still fits the budget."""
    passes = saved(placed.filter("_size > 0").select("_size", F.explode(F.array(*(_key(e) for e in range(max_epochs)))).alias("k")).filter("k.f is not null"), "mix-copies", max_epochs * rows)
    left, spent = passes, 0
    for part in ("k.f", "k.t"):  # copies of one finish time are told apart by their hashes
        while True:
            n, low, high = left.agg(F.count(F.lit(1)), F.min(part), F.max(part)).collect()[0]
            if n <= BUCKET_ROWS or low == high:
                break
            cell = F.least(F.floor((F.col(part) - low) / (high - low) * CELLS), F.lit(CELLS - 1))
            cells = left.groupBy(cell.alias("c")).agg(F.sum("_size").alias("n"), F.min(part).alias("low"), F.max(part).alias("high")).orderBy("c").collect()
            for c in cells:
                if spent + c["n"] > budget:
                    break
                spent += c["n"]
            else:  # all fit
                return passes.agg(F.max("k").alias("k")).collect()[0]["k"]
            left = left.filter(F.col(part).between(c["low"], c["high"]))
    order = Window.orderBy("k").rowsBetween(Window.unboundedPreceding, 0)  # few copies, or repeated rows
    reached = left.withColumn("_spent", F.sum("_size").over(order) + spent).agg(F.max(F.when(F.col("_spent") <= budget, F.col("k"))).alias("fits"), F.min("k").alias("first")).collect()[0]
    if reached["fits"] is not None or reached["first"] is None:
        return reached["fits"]
    return passes.filter(F.col("k") < _literal(reached["first"])).agg(F.max("k").alias("k")).collect()[0]["k"]
