"""Splits by document: every row of a document falls on the same side."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import draw_order, hash_bucket
from .sampling import lowest_within, subsample

BUCKETS = 10_000


def _check(eval_fraction: float) -> None:
    if not 0 < eval_fraction < 1:
        raise ValueError("eval_fraction must be between 0 and 1")


def by_hash(rows: DataFrame, eval_fraction: float, id_col: str = "doc_id") -> DataFrame:
    """Adds split: eval where the id's bucket is below the fraction, else train. No shuffle."""
    _check(eval_fraction)
    return rows.withColumn("split", F.when(hash_bucket(F.col(id_col).cast("string"), BUCKETS) < int(eval_fraction * BUCKETS), "eval").otherwise("train"))


def _labelled(rows: DataFrame, chosen: DataFrame, label: str, id_col: str) -> DataFrame:
    marked = rows.join(chosen.select(F.col(id_col).alias("_c"), F.lit(label).alias("_label")), F.col(id_col) == F.col("_c"), "left")
    return marked.withColumn("split", F.coalesce("_label", "split")).drop("_c", "_label")


def by_rank(rows: DataFrame, eval_fraction: float, seed: int, id_col: str = "doc_id") -> DataFrame:
    """Adds split: exactly round(documents * fraction) documents, the first in a seeded shuffle, are eval.

    The last document drawn tells the others, so rows are labelled where they are, without a join.
    """
    _check(eval_fraction)
    ids = rows.select(id_col).distinct()
    k = round(ids.count() * eval_fraction)  # Python rounds halves to even
    order = draw_order(seed, F.col(id_col))
    last = subsample(ids, k, seed, (id_col,)).agg(F.max(F.struct(order.alias("o"), F.col(id_col).alias("id"))).alias("last")).first()["last"]
    if last is None:
        return rows.withColumn("split", F.lit("train"))
    drawn = (order < last["o"]) | ((order == last["o"]) & (F.col(id_col) <= F.lit(last["id"]).cast(ids.schema[id_col].dataType)))
    return rows.withColumn("split", F.when(F.col(id_col).isNotNull() & drawn, "eval").otherwise("train"))


def with_long_documents(rows: DataFrame, eval_fraction: float, seed: int, min_bytes: int, fraction: float, strategy: str = "prefer_long_docs", id_col: str = "doc_id") -> DataFrame:
    """by_rank, and of the train documents round(documents * fraction) of at least min_bytes become eval_longdoc.

    prefer_long_docs takes the longest (of equal ones the greatest id); random_docs a seeded draw.
    """
    if not 0 <= fraction < 1:
        raise ValueError("eval_longdoc_fraction must be in [0, 1)")
    if strategy not in ("prefer_long_docs", "random_docs"):
        raise ValueError(f"unknown strategy {strategy}")
    split = by_rank(rows, eval_fraction, seed, id_col)
    lengths = split.groupBy(id_col, "split").agg(F.max("byte_end").alias("n"))
    target = round(lengths.count() * fraction)
    if not target:
        return split
    able = lengths.filter((F.col("split") == "train") & (F.col("n") >= min_bytes))
    if strategy == "prefer_long_docs":
        longest = F.lpad(F.hex(F.lit((1 << 47) - 1) - F.col("n")), 12, "0")
        chosen = lowest_within(able.withColumn("_all", F.lit(0)), ["_all"], {(0,): target}, longest, [F.desc(id_col)])
    else:
        chosen = subsample(able, target, seed + 909, (id_col,))
    return _labelled(split, chosen, "eval_longdoc", id_col)


def train_and_validation(rows: DataFrame, train_ratio: float, seed: int, id_col: str = "doc_id") -> tuple[DataFrame, DataFrame]:
    """The older form: two tables."""
    split = by_rank(rows, 1 - train_ratio, seed, id_col)
    return split.filter("split = 'train'").drop("split"), split.filter("split = 'eval'").drop("split")
