"""Connected components by least labels and pointer jumping: few edges in one task, more in rounds with a written table each."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import saved

#: At most so many edges are joined in one task, in some 50 MB.
ONE_TASK = 1 << 19


def roots(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nodes of the edges, sorted, and the least node that each reaches."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[: len(a)], at[len(a) :]
    root = np.arange(len(nodes))
    while len(x):
        low, high = np.minimum(root[x], root[y]), np.maximum(root[x], root[y])
        np.minimum.at(root, high, low)
        while ((up := root[root]) != root).any():
            root = up
        apart = root[x] != root[y]
        x, y = x[apart], y[apart]
    return nodes, nodes[root]


def _whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    found = list(batches)
    if found:
        node, root = roots(*(np.concatenate([b.column(i).to_numpy() for b in found]) for i in (0, 1)))
        yield pa.RecordBatch.from_arrays([pa.array(node, pa.int64()), pa.array(root, pa.int64())], ["node", "root"])


def components(edges: DataFrame) -> DataFrame:
    """node, root for every node of edges (a, b: longs; a written table); root is the least node reachable.

    Up to ONE_TASK edges are joined in one task. Of more, a round takes each node's least label among its neighbours' and its
    own, then follows the label's own label, so paths shrink by more than half; rounds end when no label changes.
    """
    rows = 2 * edges.count()
    if rows <= 2 * ONE_TASK:
        return saved(edges.select("a", "b").coalesce(1).mapInArrow(_whole, "node long, root long"), "cc-labels")
    both = saved(edges.select(F.col("a").alias("x"), F.col("b").alias("y")).unionByName(edges.select(F.col("b").alias("x"), F.col("a").alias("y"))).distinct(), "cc-edges", rows)
    labels = saved(both.groupBy(F.col("x").alias("node")).agg(F.least(F.first("x"), F.min("y")).alias("root")), "cc-labels", rows)
    while True:
        of = labels.select(F.col("node").alias("y"), F.col("root").alias("r"))
        near = both.join(of, "y").groupBy(F.col("x").alias("node")).agg(F.min("r").alias("m"))
        jump = labels.select(F.col("node").alias("root"), F.col("root").alias("j"))
        new = saved(
            labels.join(jump, "root").join(near, "node").select("node", F.least("root", "j", "m").alias("root"), (F.least("root", "j", "m") < F.col("root")).alias("moved")),
            "cc-labels",
            rows,
        )
        labels = new.select("node", "root")
        if not new.filter("moved").limit(1).count():
            return labels
