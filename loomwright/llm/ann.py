"""Approximate nearest neighbours by a hash-prefix forest.

Vectors are hashed to long bit strings by the signs of random projections, one string for each tree; a tree is the array of
its strings in order. A query descends every tree to its longest prefix match and then ascends all trees together: one bit
at a time, and within a bit tree by tree, until the ranges hold the budget of candidates (repeats over trees count), which is
a share of the vectors and a few for each neighbour asked for. Those candidates are scored exactly, in double precision, on the
original vectors. Should fewer than k different ones be found, the budget is doubled.

The index is cut into shards of SHARD_CELLS components and the queries into blocks of about BLOCK_QUERIES; each task holds
the forest of one shard and answers one block, and the best of all shards are merged. Every query meets every shard, so the
work grows with queries times vectors. Every vector is indexed; nothing is fitted. Equal vectors are one entry that carries its
k + 1 smallest ids, which are all that can be among the k nearest, so a vector that a third of all rows have does not fill a
shard; as a query it is asked once, and its rows are dealt to several tasks when they get the answer.

Cases: a vector that is null, zero, or has a null or non-finite component takes no part; vectors of different lengths are never
neighbours, each length is searched by itself; repeated rows count once; a row is never its own neighbour; ties go to the
smaller id; an empty table gives an empty result; other columns do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import salted_join, saved, small

TREES, BITS = 192, 24
#: The budget of candidates in a shard: EFFORT for each of its vectors, REACH for each neighbour asked for, and one for each tree.
EFFORT, REACH = 0.6, 12
SHARD_CELLS = 1 << 20
BLOCK_QUERIES = 4_096
SEED = 20240229


class Forest:
    """Sorted arrays of hash strings, one for each tree."""

    def __init__(self, vectors: np.ndarray, trees: int = TREES, bits: int = BITS, seed: int = SEED):
        self.trees, self.bits = trees, bits
        self.planes = np.random.default_rng(seed).standard_normal((vectors.shape[1], trees * bits))
        strings = self.strings(vectors)
        self.order = np.ascontiguousarray(np.argsort(strings, axis=0, kind="stable").T.astype(np.int32))
        self.sorted = np.ascontiguousarray(np.take_along_axis(strings.T, self.order, 1))

    def strings(self, vectors: np.ndarray) -> np.ndarray:
        out = np.zeros((len(vectors), self.trees), np.int64)
        weight = 1 << np.arange(self.bits - 1, -1, -1, dtype=np.int64)
        for at in range(0, len(vectors), 256):
            signs = vectors[at : at + 256] @ self.planes > 0
            out[at : at + 256] = signs.reshape(-1, self.trees, self.bits) @ weight
        return out

    def candidates(self, queries: np.ndarray, budget: float, least: int = 0) -> Iterator[np.ndarray]:
        """For each query the vectors that the budget reaches, at least so many different ones if there are."""
        for at in range(0, len(queries), 256):
            asked = self.strings(queries[at : at + 256])
            low, high = np.zeros((2, self.bits + 1, *asked.shape), np.int32)
            for depth in range(self.bits + 1):  # the longest match is the deepest range that is not empty
                rest = (1 << (self.bits - depth)) - 1
                for t in range(self.trees):
                    low[depth, :, t] = np.searchsorted(self.sorted[t], asked[:, t] & ~rest, "left")
                    high[depth, :, t] = np.searchsorted(self.sorted[t], asked[:, t] | rest, "right")
            size = high - low
            total = size.sum(2, dtype=np.int64)
            for q in range(len(asked)):
                now = budget
                while True:
                    found = self._ascended(low[:, q], high[:, q], size[:, q], total[:, q], now)
                    if len(found) >= min(least, self.order.shape[1]):
                        break
                    now *= 2
                yield found

    def _ascended(self, low: np.ndarray, high: np.ndarray, size: np.ndarray, total: np.ndarray, budget: float) -> np.ndarray:
        enough = np.flatnonzero(total >= budget)
        depth = int(enough[-1]) if len(enough) else 0
        # trees go up to this depth one after the other, the rest stay a bit deeper
        below = min(depth + 1, self.bits)
        held = total[below] + np.cumsum(size[depth] - size[below])
        up = int(np.searchsorted(held, budget)) + 1 if depth < self.bits else 0
        found = np.zeros(self.order.shape[1], bool)
        for t in range(self.trees):
            d = depth if t < up else below
            found[self.order[t, low[d, t] : high[d, t]]] = True
        return np.flatnonzero(found)


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def _search(k: int, effort: float):
    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        asks = pc.is_null(table["_ids"])
        points, queries = table.filter(pc.invert(asks)), table.filter(asks)
        out: list[tuple] = []
        if points.num_rows and queries.num_rows:
            x, q = _matrix(points["_vector"].combine_chunks()), _matrix(queries["_vector"].combine_chunks())
            for i, near in enumerate(Forest(x).candidates(q, TREES + REACH * k + effort * len(x), k)):
                rough = x[near] @ q[i]
                if len(near) > 2 * k:
                    edge = np.partition(rough, len(near) - k)[len(near) - k]
                    near = near[rough >= edge - 1e-9 * max(1.0, abs(edge))]
                score = (x[near] * q[i]).sum(1)  # the same sum for equal vectors, wherever they lie
                out += [(i, p, s) for p, s in zip(near.tolist(), score.tolist(), strict=True)]
        i, p, s = zip(*out, strict=True) if out else ((), (), ())
        return pa.table({"_query": queries["_key"].take(pa.array(i, pa.int64())), "_ids": points["_ids"].take(pa.array(p, pa.int64())), "score": pa.array(s, pa.float64())})

    return run


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """_id, _vector, _dim (its length) and _key, a key of equal vectors."""
    v = F.col(vector_col).cast("array<double>")
    good = F.col(vector_col).isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    rows = vectors.select(F.col(id_col).cast("long").alias("_id"), F.when(good, F.transform(v, lambda x: x + 0.0)).alias("_vector")).filter("_vector is not null")
    key = F.concat_ws(" ", F.size("_vector").cast("string"), F.xxhash64("_vector").cast("string"), F.xxhash64(F.lit(1), "_vector").cast("string"))
    return rows.withColumn("_dim", F.size("_vector")).withColumn("_key", key)


def nearest(vectors: DataFrame, is_query, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 20, effort: float = EFFORT) -> DataFrame:
    """For each row for which is_query holds, its k nearest by inner product: query_id, rank, vec_id, score.

    is_query: from the id column to a condition. Any other row is a candidate.
    """
    rows = usable(vectors, id_col, vector_col)
    least = Window.partitionBy("_key").orderBy("_id")  # each task passes on k + 1 rows of a key at most
    entries = (
        rows.select("_key", "_id").distinct().withColumn("_n", F.row_number().over(least)).filter(F.col("_n") <= k + 1)
        .groupBy("_key").agg(F.sort_array(F.collect_list("_id")).alias("_ids"))
        .join(rows.groupBy("_key").agg(F.first("_vector").alias("_vector"), F.first("_dim").alias("_dim")), "_key")
    )
    queries = rows.filter(is_query(F.col("_id"))).select(F.col("_key").alias("_query"), F.col("_id").alias("query_id")).distinct()
    asked = rows.filter(is_query(F.col("_id"))).groupBy("_key").agg(F.first("_vector").alias("_vector"), F.first("_dim").alias("_dim"))
    # a row for each length of vectors
    parts = entries.groupBy("_dim").agg(F.greatest(F.lit(1), F.ceil(F.count(F.lit(1)) * F.col("_dim") / SHARD_CELLS)).cast("int").alias("_shards"))
    turns = asked.groupBy("_dim").agg(F.ceil(F.count(F.lit(1)) / BLOCK_QUERIES).cast("int").alias("_blocks"))
    shape = small(saved(parts.join(turns, "_dim"), "nearest-shape"))
    every = lambda m: F.explode(F.sequence(F.lit(0), F.col(m) - 1))
    place = lambda seed, m: F.pmod(F.xxhash64(F.lit(seed), "_key"), F.col(m)).cast("int")
    tasks = entries.join(shape, "_dim").select("_dim", "_key", "_ids", "_vector", place(2, "_shards").alias("_shard"), every("_blocks").alias("_block")).unionByName(
        asked.join(shape, "_dim").select("_dim", "_key", F.lit(None).cast("array<long>").alias("_ids"), "_vector", every("_shards").alias("_shard"), place(3, "_blocks").alias("_block"))
    )
    near = tasks.groupBy("_dim", "_shard", "_block").applyInArrow(_search(k + 1, effort), "_query string, _ids array<long>, score double")
    best = Window.partitionBy("_query").orderBy(F.desc("score"), "vec_id")
    ids = near.select("_query", "score", F.explode("_ids").alias("vec_id")).withColumn("_r", F.row_number().over(best)).filter(F.col("_r") <= k + 1)
    listed = ids.groupBy("_query").agg(F.array_sort(F.collect_list(F.struct("_r", "vec_id", "score"))).alias("_near"))
    own = F.slice(F.filter("_near", lambda x: x["vec_id"] != F.col("query_id")), 1, k)
    found = salted_join(queries, listed, ["_query"], F.col("query_id")).select("query_id", F.posexplode(own).alias("_p", "_x"))
    return found.select("query_id", (F.col("_p") + 1).alias("rank"), F.col("_x.vec_id").alias("vec_id"), F.col("_x.score").alias("score"))
