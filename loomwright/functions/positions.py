"""Selection of positions: masks, the least number selected, windows. All are array expressions, with no Python on executors."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value), with value computed once however often body uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def at_least(values: Column, threshold: float) -> Column:
    return F.transform(values, lambda v: v >= F.lit(float(threshold)))


def at_most(values: Column, threshold: float) -> Column:
    return F.transform(values, lambda v: v <= F.lit(float(threshold)))


def combined(a: Column, b: Column, mode: str = "union", on_a: Callable[[Column], Column] = lambda x: x, on_b: Callable[[Column], Column] = lambda x: x) -> Column:
    """Masks of one length, or values with what makes masks of them in the same pass; other lengths fail the query."""
    if mode not in ("union", "intersection"):
        raise ValueError("mode must be 'union' or 'intersection'")
    both = F.zip_with(a, b, lambda x, y: (on_a(x) | on_b(y)) if mode == "union" else (on_a(x) & on_b(y)))
    return F.when(F.size(a) == F.size(b), both).otherwise(F.raise_error(F.lit("position masks differ in length")).cast("array<boolean>"))


def with_minimum(mask: Column, minimum: int | None) -> Column:
    """Turns on positions from the left until minimum are on."""
    if minimum is None or minimum <= 0:
        return mask

    def filled(m: Column) -> Column:
        need = F.lit(int(minimum)) - F.size(F.filter(m, lambda x: x))
        # the place of the last of the first positions that are off, as many as are needed
        off = F.slice(F.filter(F.sequence(F.lit(0), F.size(m) - 1), lambda i: ~F.get(m, i)), F.lit(1), F.greatest(need, F.lit(0)))
        grown = bound(F.coalesce(F.try_element_at(off, F.lit(-1)), F.lit(-1)), lambda last: F.transform(m, lambda x, i: x | (i <= last)))
        return F.when((F.size(m) == 0) | (need <= 0), m).otherwise(grown)

    return bound(mask, filled)


def selected(mask: Column) -> Column:
    """Indexes of the positions that are on."""
    # one pass of the mask; the off ones go without another
    on = F.array_remove(F.transform(mask, lambda x, i: F.when(x, i).otherwise(F.lit(-1))), F.lit(-1))
    return F.coalesce(on, F.array().cast("array<int>"))


def merged(windows: Column) -> Column:
    """Windows (start, end inclusive) in order; those that share a position become one, neighbours stay apart."""
    empty = F.array().cast("array<struct<start:int,end:int>>")

    def step(done: Column, w: Column) -> Column:
        last = F.element_at(done, -1)
        rest = F.slice(done, F.lit(1), F.size(done) - 1)
        grown = F.struct(last["start"].alias("start"), F.greatest(last["end"], w["end"]).alias("end"))
        joined = F.concat(rest, F.array(grown))
        return F.when((F.size(done) > 0) & (w["start"] <= last["end"]), joined).otherwise(F.concat(done, F.array(w)))

    ordered = F.array_sort(F.transform(windows, lambda w: F.struct(w["start"].cast("int").alias("start"), w["end"].cast("int").alias("end"))))
    return F.aggregate(ordered, empty, step)


def windows(mask: Column, radius: int) -> Column:
    """Merged windows of radius around the positions that are on: start, end and how many of them are in it.

    A position begins a window if none before it is near enough to share one, and the window ends with the position before the
    next beginning: no fold over the positions is needed.
    """
    if radius < 0:
        raise ValueError("radius must be >= 0")

    def joined(x: Column) -> Column:
        on, n = x["on"], x["n"]
        fresh = lambda at, i: (i == 0) | (at - F.get(on, i - 1) > 2 * radius)  # noqa: E731  shares no position with the window before
        begins = F.array_remove(F.transform(on, lambda at, i: F.when(fresh(at, i), i).otherwise(F.lit(-1))), F.lit(-1))

        def all_of(begins: Column) -> Column:
            def window(b: Column, k: Column) -> Column:
                e = F.coalesce(F.get(begins, k + 1), F.size(on)) - 1
                return F.struct(F.greatest(F.get(on, b) - radius, F.lit(0)).alias("start"), F.least(F.get(on, e) + radius, n - 1).alias("end"), (e - b + 1).alias("count"))

            return F.transform(begins, window)

        return bound(begins, all_of)

    return bound(bound(mask, lambda m: F.struct(selected(m).alias("on"), F.size(m).alias("n"))), joined)


def select(entropy: Column | None, gap: Column | None, entropy_threshold: float | None, gap_threshold: float | None, combine: str = "union", minimum: int | None = None) -> Column:
    """The mask of a policy. A threshold without its signal fails the query; without thresholds nothing is on but the minimum."""

    def needed(values: Column | None, name: str) -> Column:
        if values is None:
            raise ValueError(f"{name} is required by its threshold")
        return F.when(values.isNotNull(), values).otherwise(F.raise_error(F.lit(f"{name} is required by its threshold")).cast("array<double>"))

    high = needed(entropy, "per_token_entropy") if entropy_threshold is not None else None
    near = needed(gap, "per_token_top1_gap") if gap_threshold is not None else None
    if high is not None and near is not None:
        mask = combined(high, near, combine, lambda e: e >= F.lit(float(entropy_threshold)), lambda g: g <= F.lit(float(gap_threshold)))
    elif high is not None or near is not None:
        mask = at_least(high, entropy_threshold) if high is not None else at_most(near, gap_threshold)
    else:
        known = [c for c in (entropy, gap) if c is not None]
        mask = F.transform(F.coalesce(*known, F.array().cast("array<double>")), lambda _: F.lit(False))
    return with_minimum(mask, minimum)


def sliced(values: Column, start: Column, end: Column) -> Column:
    """The part of an array that belongs to a window (end inclusive); null stays null."""
    return F.slice(values, start + 1, end - start + 1)
