"""Signals of a teacher's candidates: entropies, gaps, top k, padding and checks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def row_entropy(logprobs: Column) -> Column:
    """Entropy of one row of log-probabilities, made to sum to one; an empty row has 0."""
    top = F.array_max(logprobs)
    weights = F.transform(logprobs, lambda x: F.exp(x - top))
    whole = F.aggregate(weights, F.lit(0.0), lambda s, w: s + w)
    parts = F.transform(weights, lambda w: -(w / whole) * F.log(F.greatest(w / whole, F.lit(1e-12))))
    return F.when(F.size(logprobs) > 0, F.aggregate(parts, F.lit(0.0), lambda s, p: s + p)).otherwise(F.lit(0.0))


def mean_entropy(rows: Column) -> Column:
    """The mean over rows that have candidates; without any 0."""
    full = F.filter(rows, lambda r: F.size(r) > 0)
    total = F.aggregate(F.transform(full, row_entropy), F.lit(0.0), lambda s, e: s + e)
    return F.when(F.size(full) > 0, total / F.size(full)).otherwise(F.lit(0.0))


def top_gaps(rows: Column) -> Column:
    """First minus second log-probability of each row; 0 where there is no second."""
    return F.transform(rows, lambda r: F.when(F.size(r) > 1, F.get(r, F.lit(0)) - F.get(r, F.lit(1))).otherwise(F.lit(0.0)))


def top_k(scores: Column, k: int) -> Column:
    """From a map of id to log-probability, the k best as (id, logprob); ties go to the smaller id."""
    ordered = F.array_sort(F.transform(F.map_entries(scores), lambda e: F.struct((-e["value"]).alias("down"), e["key"].alias("id"))))
    return F.transform(F.slice(ordered, 1, k), lambda e: F.struct(e["id"].alias("id"), (-e["down"]).alias("logprob")))


def padded(values: Column, k: int, fill: Column) -> Column:
    """Cut or filled to k entries."""
    cut = F.slice(values, 1, k)
    return F.concat(cut, F.array_repeat(fill, F.lit(k) - F.size(cut)))


def padded_logprobs(values: Column, k: int) -> Column:
    """Filled with the last log-probability, or 0."""
    return padded(values, k, F.coalesce(F.try_element_at(values, F.lit(-1)), F.lit(0.0)))


def width(rows: Column) -> Column:
    """Mean number of candidates of a row; 0 without rows."""
    total = F.aggregate(rows, F.lit(0).cast("long"), lambda s, r: s + F.size(r))
    return F.when(F.size(rows) > 0, total / F.size(rows)).otherwise(F.lit(0.0))


def problem(ids: Column, logprobs: Column, entropy: Column, tokens: Column | None = None, vocabulary: int | None = None) -> Column:
    """What is wrong with a row's output, null if nothing: shapes, order, finite values, ids in the vocabulary, entropy."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    checks = [
        (F.size(ids) != F.size(logprobs), "ids and log-probabilities differ in rows"),
        (F.exists(F.zip_with(ids, logprobs, lambda a, b: F.size(a) != F.size(b)), lambda x: x), "a row's ids and log-probabilities differ in number"),
        (F.exists(logprobs, lambda r: F.exists(r, lambda x: ~finite(x))), "a log-probability is not finite"),
        (F.exists(logprobs, lambda r: F.exists(F.zip_with(F.slice(r, 1, F.size(r) - 1), F.slice(r, 2, F.size(r)), lambda a, b: b > a), lambda up: up)), "log-probabilities are not in descending order"),
        (~finite(entropy) | (entropy < 0), "entropy is not a finite number of 0 or more"),
    ]
    if tokens is not None:
        checks.append((F.size(ids) != F.greatest(tokens - 1, F.lit(0)), "there are not as many rows as tokens less one"))
    if vocabulary is not None:
        checks.append((F.exists(ids, lambda r: F.exists(r, lambda x: (x < 0) | (x >= vocabulary))), "an id is outside the vocabulary"))
    return F.coalesce(*(F.when(bad, F.lit(said)) for bad, said in checks))
