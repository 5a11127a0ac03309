"""Sampling, allocation and ratio mixes. Shuffles order rows by a seeded hash, so a draw is the same on any cluster.

A small draw is a top-k by hash (TakeOrdered). A large one, and every draw within groups, counts rows by the first digits of
the hash, finds on the driver (in a table of a fixed size for each group) where the quota ends, goes on with the next digits of
the rows that share those, and ranks only the last SMALL; so no group is ever sorted in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import draw_order

RECORD_KEY = ("doc_id", "chunk_index", "byte_start")
SMALL = 10_000
DIGITS, MOST_DIGITS = 3, 12


def allocate(total: int, ratios: Sequence[float]) -> list[int]:
    """Largest remainders; of equal remainders the last one first."""
    whole = sum(ratios)
    if total <= 0 or whole <= 0:
        return [0] * len(ratios)
    exact = [total * r / whole for r in ratios]
    out = [int(x) for x in exact]
    for i in sorted(range(len(out)), key=lambda i: (exact[i] - out[i], i), reverse=True)[: total - sum(out)]:
        out[i] += 1
    return out


def allocate_groups(total: int, percentages: dict[str, float]) -> dict[str, int]:
    """Largest remainders of percentages; of equal remainders the greatest name first."""
    exact = {g: total * p / 100.0 for g, p in percentages.items()}
    out = {g: int(x) for g, x in exact.items()}
    for g in sorted(out, key=lambda g: (exact[g] - out[g], g), reverse=True)[: total - sum(out.values())]:
        out[g] += 1
    return out


def lowest_within(df: DataFrame, group: Sequence[str], quotas: dict[tuple, int], order: Column, key: Sequence[str | Column]) -> DataFrame:
    """Of each group the first rows in order (a hex string), ties by key; quotas: how many, for groups not named none."""
    spark = df.sparkSession
    keyed = df.withColumn("_order", order)
    kinds = dict(keyed.dtypes)
    schema = ", ".join(f"`{c}` {kinds[c]}" for c in group) + ", _end string, _left int"
    same = [F.col(c).eqNullSafe(F.col(f"_g{i}")) for i, c in enumerate(group)]

    def ended(ends: dict[tuple, tuple[str, int]]) -> DataFrame:
        """Rows with _end, the first digits of the rows among which the group's quota ends, and _left, how many of those are taken."""
        table = spark.createDataFrame([(*g, *e) for g, e in ends.items()], schema).toDF(*(f"_g{i}" for i in range(len(group))), "_end", "_left")
        return keyed.join(F.broadcast(table), same)  # a row for each group that has a quota

    ends = {g: ("", n) for g, n in quotas.items() if n > 0}
    if not ends:
        return df.limit(0)
    for at in range(0, MOST_DIGITS, DIGITS):
        near = ended(ends).filter(F.col("_order").startswith(F.col("_end"))).withColumn("_digits", F.substring("_order", 1, at + DIGITS))
        counted: dict[tuple, list[tuple[str, int]]] = {}
        for r in near.groupBy(*group, "_digits").count().collect():
            counted.setdefault(tuple(r[c] for c in group), []).append((r["_digits"], r["count"]))
        most = 0
        for g, counts in counted.items():
            left = ends[g][1]
            for digits, n in sorted(counts):
                if n > left:
                    ends[g], most = (digits, left), max(most, n)
                    break
                left -= n
            else:
                ends[g] = ("~", 0)
        if most <= SMALL:
            break
    placed = ended(ends).withColumn("_digits", F.when(F.col("_end") == "~", "").otherwise(F.expr("substring(_order, 1, length(_end))")))
    rank = F.row_number().over(Window.partitionBy(*group).orderBy("_order", *key))
    edge = placed.filter("_digits = _end and _left > 0").withColumn("_rank", rank).filter("_rank <= _left").drop("_rank")
    return placed.filter("_digits < _end").unionByName(edge).select(*df.columns)


def subsample(df: DataFrame, k: int, seed: int, key: Sequence[str] = RECORD_KEY) -> DataFrame:
    """k rows at random; all of them if there are no more than k."""
    if k <= 0:
        return df.limit(0)
    order = draw_order(seed, *(F.col(c) for c in key))
    if k <= SMALL:
        return df.orderBy(order, *key).limit(k)
    return lowest_within(df.withColumn("_all", F.lit(0)), ["_all"], {(0,): k}, order, key).drop("_all")


def subsample_within(df: DataFrame, group: Sequence[str], quotas: dict[tuple, int], seed: int, key: Sequence[str] = RECORD_KEY) -> DataFrame:
    """As subsample within each group."""
    return lowest_within(df, group, quotas, draw_order(seed, *(F.col(c) for c in key)), key)


def first_rows(df: DataFrame, n: int, stage: str | None = None, teacher: str | None = None, key: Sequence[str] = ("doc_id", "chunk_index", "byte_start", "byte_end")) -> DataFrame:
    """The first n rows in key order, of one stage and teacher if named."""
    if stage is not None:
        df = df.filter(F.col("stage_name") == stage)
    if teacher is not None:
        df = df.filter(F.col("teacher_name") == teacher)
    return df.orderBy(*key).limit(max(0, n))


def concat(parts: Sequence[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def merge_by_ratio(parts: Sequence[tuple[DataFrame, float]], seed: int, key: Sequence[str] = RECORD_KEY) -> DataFrame:
    """The total of all inputs, dealt out by ratio; an input that is too small is taken whole."""
    if any(r < 0 for _, r in parts) or not sum(r for _, r in parts) > 0:
        raise ValueError("ratios must be >= 0 and not all 0")
    sizes = [p.count() for p, _ in parts]
    targets = allocate(sum(sizes), [r for _, r in parts])
    return concat([p if t >= n else subsample(p, t, seed + i + 1, key) for i, ((p, _), t, n) in enumerate(zip(parts, targets, sizes, strict=True))])


def teacher_mixture(outputs: Sequence[tuple[DataFrame, float]], total: int, seed: int, key: Sequence[str] = RECORD_KEY) -> DataFrame:
    """Each teacher's output cut to its share of total, one after the other."""
    shares = allocate(total, [r for _, r in outputs])
    return concat([subsample(o, n, seed + i + 1, key) for i, ((o, _), n) in enumerate(zip(outputs, shares, strict=True))])


def curriculum(final: DataFrame, history: Sequence[tuple[DataFrame, float]], seed: int, key: Sequence[str] = RECORD_KEY) -> DataFrame:
    """As many rows as the final stage has, drawn from the stages of history by fraction; history holds the final stage too."""
    if len(history) <= 1 or not any(f > 0 for _, f in history):
        return final
    shares = allocate(final.count(), [max(0.0, f) for _, f in history])
    return concat([subsample(h, n, seed + (i + 1) * 17, key) for i, ((h, _), n) in enumerate(zip(history, shares, strict=True))])
