"""Corpus building: grouping upstream rows into documents, and mixing cached documents by percentage."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import draw_order, safe_text, stripped
from .records import numbered
from .sampling import allocate_groups, lowest_within

MOST_SOURCES = 100_000
SPLITS = ("train", "eval", "validation")
POLICIES = ("strict", "rebalance", "record_only")


def fits(size: Column, min_bytes: int | None, max_bytes: int | None) -> Column:
    ok = F.lit(True)
    if min_bytes is not None:
        ok = ok & (size >= min_bytes)
    if max_bytes is not None:
        ok = ok & (size <= max_bytes)
    return ok


def group_rows(rows: DataFrame, source: Sequence[str], order: Sequence[str], text_col: str, group_size: int, min_bytes: int | None = None, max_bytes: int | None = None, max_docs: int | None = None) -> DataFrame:
    """Every group_size rows of a source that fit the byte bounds, in order, are one document: their texts joined by a blank
    line, stripped, and a line feed. An incomplete last group is dropped.

    Gives the source columns, doc_id (doc_ and eight digits, from 1), text, first_row, last_row, row_count. The position of
    a row in its source is its position among all rows less that of the source's first, so a large source is not
    ranked in one task. The first positions are broadcast up to MOST_SOURCES sources, so a large source is not joined in one
    task either.
    """
    if group_size <= 0:
        raise ValueError("group_size must be > 0")
    text = safe_text(F.col(text_col))
    good = rows.filter(fits(F.octet_length(text), min_bytes, max_bytes)).select(*source, *(c for c in order if c not in source), text.alias("_text"))
    placed = numbered(good, [*source, *order], "_at")
    first = placed.groupBy(*source).agg(F.min("_at").alias("_first")).toDF(*(f"_s{i}" for i in range(len(source))), "_first")
    if first.count() <= MOST_SOURCES:
        first = F.broadcast(first)
    same = [F.col(c).eqNullSafe(F.col(f"_s{i}")) for i, c in enumerate(source)]
    ranked = placed.join(first, same).withColumn("_at", F.col("_at") - F.col("_first")).withColumn("_group", F.floor(F.col("_at") / group_size))
    if max_docs is not None:
        ranked = ranked.filter(F.col("_group") < max_docs)
    parts = F.array_sort(F.collect_list(F.struct("_at", "_text")))
    grouped = ranked.groupBy(*source, "_group").agg(parts.alias("_parts")).filter(F.size("_parts") == group_size)
    joined = stripped(F.array_join(F.transform("_parts", lambda p: p["_text"]), "\n\n"))
    return grouped.select(
        *source,
        F.concat(F.lit("doc_"), F.lpad((F.col("_group") + 1).cast("string"), 8, "0")).alias("doc_id"),
        F.concat(joined, F.lit("\n")).alias("text"),
        (F.col("_group") * group_size).alias("first_row"),
        ((F.col("_group") + 1) * group_size - 1).alias("last_row"),
        F.lit(group_size).alias("row_count"),
    )


def count_rows(rows: DataFrame, source: Sequence[str], text_col: str, group_size: int, min_bytes: int | None = None, max_bytes: int | None = None, max_docs: int | None = None) -> DataFrame:
    """What group_rows does, in numbers, for each source: rows seen, below and above the bounds, accepted, documents.

    All rows are counted, also those after max_docs documents are full.
    """
    size = F.octet_length(safe_text(F.col(text_col)))
    below = size < (min_bytes if min_bytes is not None else 0)
    above = (size > max_bytes) & ~below if max_bytes is not None else F.lit(False)
    docs = F.floor(F.count_if(~below & ~above) / group_size)
    return rows.groupBy(*source).agg(
        F.count(F.lit(1)).alias("rows_seen"), F.count_if(below).alias("rows_below_min_bytes"), F.count_if(above).alias("rows_above_max_bytes"), F.count_if(~below & ~above).alias("rows_accepted"),
        (F.least(docs, F.lit(max_docs)) if max_docs is not None else docs).cast("long").alias("documents"),
    )


class Group(NamedTuple):
    name: str
    percentage: float
    sources: tuple[str, ...]


class Shortfall(ValueError):
    """A strict mixture asks for more documents than there are."""


def check_groups(groups: Sequence[Group], sources: Sequence[str] | None = None) -> None:
    if not groups or any(g.percentage <= 0 or not g.name or not g.sources for g in groups):
        raise ValueError("every group needs a name, sources and a percentage > 0")
    if abs(sum(g.percentage for g in groups) - 100) > 1e-9:
        raise ValueError("percentages must add up to 100")
    if sources is not None and (unknown := {s for g in groups for s in g.sources} - set(sources)):
        raise ValueError(f"unknown sources: {', '.join(sorted(unknown))}")


def rounds(left: dict[str, int], short: int, order) -> dict[str, int]:
    """short documents dealt out one by one: in each round every group that has one left gives one, in the order of
    order(round, group)."""
    short = min(short, sum(left.values()))
    low, high = 0, max(left.values(), default=0)
    while low < high:  # the most full rounds
        mid = (low + high + 1) // 2
        low, high = (mid, high) if sum(min(n, mid) for n in left.values()) <= short else (low, mid - 1)
    out = {g: min(n, low) for g, n in left.items()}
    rest = short - sum(out.values())
    for g in sorted((g for g, n in left.items() if n > low), key=lambda g: order(low + 1, g))[:rest]:
        out[g] += 1
    return out


def _round_order(seed: int):
    import hashlib

    return lambda r, g: (hashlib.sha256(f"{seed}:{r}:{g}".encode()).hexdigest(), g)


def mix(pool: DataFrame, groups: Sequence[Group], target: int, seed: int, policy: str = "rebalance", min_bytes: int | None = None, max_bytes: int | None = None) -> DataFrame:
    """Documents of pool (split, source_name, doc_id, text) by percentage: target documents for each split that pool has.

    Adds group_name, output_ordinal (from 1 within the split, shuffled) and output_doc_id. A source of two groups is in both.
    strict fails if a group is short, record_only leaves it short, rebalance fills up from what the other groups have left.
    """
    if policy not in POLICIES:
        raise ValueError(f"depletion_policy must be one of {', '.join(POLICIES)}")
    if target <= 0:
        raise ValueError("target_documents must be > 0")
    check_groups(groups)
    spark = pool.sparkSession
    of = spark.createDataFrame([(s, g.name) for g in groups for s in g.sources], "source_name string, group_name string")
    able = pool.filter(fits(F.octet_length("text"), min_bytes, max_bytes)).join(F.broadcast(of), "source_name")
    there: dict[str, dict[str, int]] = {}
    for r in able.groupBy("split", "group_name").count().collect():
        there.setdefault(r["split"], {})[r["group_name"]] = r["count"]
    asked = allocate_groups(target, {g.name: g.percentage for g in groups})
    quotas: dict[tuple, int] = {}
    for split, have in there.items():
        own_seed = seed + (SPLITS.index(split) if split in SPLITS else len(SPLITS))
        if policy == "strict" and (short := {g: n - have.get(g, 0) for g, n in asked.items() if n > have.get(g, 0)}):
            raise Shortfall(f"{split}: {', '.join(f'{g} lacks {n}' for g, n in sorted(short.items()))}")
        taken = {g: min(n, have.get(g, 0)) for g, n in asked.items()}
        if policy == "rebalance":
            more = rounds({g: have.get(g, 0) - n for g, n in taken.items()}, target - sum(taken.values()), _round_order(own_seed))
            taken = {g: n + more.get(g, 0) for g, n in taken.items()}
        quotas |= {(split, g): n for g, n in taken.items()}
    seeds = F.coalesce(*(F.when(F.col("split") == s, F.lit(str(seed + i))) for i, s in enumerate(SPLITS)), F.lit(str(seed + len(SPLITS))))
    order = F.sha2(F.concat_ws(":", seeds, "group_name", "source_name", "doc_id"), 256)
    chosen = lowest_within(able, ["split", "group_name"], quotas, order, ["source_name", "doc_id"])
    final = F.sha2(F.concat_ws(":", F.lit("final"), seeds, "group_name", "source_name", "doc_id"), 256)
    placed = numbered(chosen.withColumn("_final", final), ["split", "_final"], "_at")
    first = placed.groupBy("split").agg(F.min("_at").alias("_first"))
    out = placed.join(F.broadcast(first), "split").withColumn("output_ordinal", F.col("_at") - F.col("_first") + 1)
    return out.withColumn("output_doc_id", F.concat(F.lit("doc_"), F.lpad(F.col("output_ordinal").cast("string"), 8, "0"))).drop("_at", "_first", "_final")


def composition(mixed: DataFrame, target: int, groups: Sequence[Group]) -> DataFrame:
    """Realised documents by split, by split and group, by split, group and source; what was asked for; whether they differ."""
    asked = allocate_groups(target, {g.name: g.percentage for g in groups})
    table = mixed.sparkSession.createDataFrame(list(asked.items()), "group_name string, _asked int")
    counted = mixed.groupingSets([["split"], ["split", "group_name"], ["split", "group_name", "source_name"]], "split", "group_name", "source_name").agg(F.grouping_id().alias("_level"), F.count(F.lit(1)).alias("documents"))
    out = counted.join(F.broadcast(table), "group_name", "left")
    requested = F.when(F.col("_level") == 3, F.lit(target)).when(F.col("_level") == 1, F.col("_asked"))
    level = F.when(F.col("_level") == 3, "split").when(F.col("_level") == 1, "group").otherwise("source")
    return out.select(level.alias("level"), "split", "group_name", "source_name", "documents", requested.cast("long").alias("requested"), (F.col("documents") != requested).alias("deviates"))


def inspect(corpus: DataFrame, width: int = 200) -> DataFrame:
    """Documents by split, source and group (nulls left out): dimension, value, documents."""
    dims = [c for c in ("split", "source_name", "group_name") if c in corpus.columns]
    pairs = corpus.select(F.explode(F.array(*(F.struct(F.lit(d).alias("dimension"), F.col(d).cast("string").alias("value")) for d in dims))).alias("p"))
    return pairs.filter("p.value is not null").groupBy(F.col("p.dimension").alias("dimension"), F.col("p.value").alias("value")).agg(F.count(F.lit(1)).alias("documents"))
