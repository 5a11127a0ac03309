"""Best-fit packing planned over the histogram of lengths.

Documents are encoded once, in Arrow batches; only (id, piece, start, length, crc) are kept, in a written table. The plan is made
over counts: best fit in order of decreasing length places whole runs of equal pieces, so its cost depends on the capacity and
not on the number of documents. A piece then takes the planned slot of its rank within its length.

Ranks are made in buckets of about BUCKET_ROWS rows (their number follows the histogram), so a length that a third of all
pieces have is ranked by many tasks. The plan has at most a few runs for each pair of lengths, whatever the input, and is broadcast.

Cases: a null text is empty, a piece of one token (the end id); repeated rows each get slots of their own; very long texts are
encoded whole and cut by tokens; an empty table gives an empty result; other columns do not matter.
"""

from __future__ import annotations

import os
import zlib
from bisect import bisect_left, insort
from collections import deque
from collections.abc import Iterator
from functools import cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import offsets, saved

CAPACITY = 1024
END_ID = 2
BUCKET_ROWS = 2_000
CALL_BYTES = 1 << 20


class Run(NamedTuple):
    """Pieces of a length with ranks from first on, count of them, each many to a sequence from sequence on, from offset on."""

    length: int
    first: int
    count: int
    each: int
    sequence: int
    offset: int


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[Run]:
    """Best fit, longest first, over counts. Sequences are numbered from 0; within each, offsets have no gap."""
    runs: list[Run] = []
    free: list[int] = []  # room left, sorted, of sequences that have any
    held: dict[int, deque[tuple[int, int]]] = {}  # room left: runs of sequences as (first, number)
    made = 0

    def put(room: int, first: int, number: int) -> None:
        if number and room:
            if room not in held:
                held[room] = deque()
                insort(free, room)
            held[room].append((first, number))

    for length in sorted(histogram, reverse=True):
        rank, left = 0, histogram[length]
        while left:
            if (i := bisect_left(free, length)) < len(free):
                room = free[i]
                first, number = held[room].popleft()
                if not held[room]:
                    del held[room]
                    free.pop(i)
            else:
                room, first, number = capacity, made, -(-left // (capacity // length))
                made += number
            each = room // length
            full = min(number, left // each)
            if full:
                runs.append(Run(length, rank, full * each, each, first, capacity - room))
                put(room - each * length, first, full)
                rank, left = rank + full * each, left - full * each
            if full < number and left:  # fewer are left than fill one more sequence
                runs.append(Run(length, rank, left, each, first + full, capacity - room))
                put(room - left * length, first + full, 1)
                full, left = full + 1, 0
            put(room, first + full, number - full)
    return runs


@cache
def _encoder(path: str):
    """Texts to arrays of ids, those of tokenizers. Texts of plain characters go to a faster encoder of the same vocabulary, whose
    ids are the same (README has the figures, a test compares random texts); where its file is missing, none do."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(path)
    tok.no_truncation()
    tok.no_padding()
    ranks_path = path.removesuffix(".json") + ".tiktoken"
    fast = None
    if os.path.exists(ranks_path):
        import base64

        import public_tokenizers
        import tiktoken

        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        fast = tiktoken.Encoding(os.path.basename(ranks_path), pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    special = [t.content for t in tok.get_added_tokens_decoder().values()]
    import re

    # classes of letters, digits and white space that every Unicode version and regex library has alike
    plain = re.compile(r"[\t\n\r\x20-\x7eÀ-ÖØ-öø-ſ€‘’“”–—…¿¡«»]*")

    def encode(texts: list[str]) -> list[np.ndarray]:
        out: list[np.ndarray | None] = [None] * len(texts)
        rest = []
        for i, t in enumerate(texts):
            if fast is not None and plain.fullmatch(t) and not any(s in t for s in special):
                out[i] = fast.encode_to_numpy(t, disallowed_special=())
            else:
                rest.append(i)
        at = 0
        while at < len(rest):
            to, size = at, 0
            while to < len(rest) and (to == at or size + len(texts[rest[to]]) <= CALL_BYTES):
                size += len(texts[rest[to]])
                to += 1
            for i, e in zip(rest[at:to], tok.encode_batch_fast([texts[i] for i in rest[at:to]], add_special_tokens=False), strict=True):
                out[i] = np.array(e.ids, np.uint32)
            at = to
        return out  # type: ignore[return-value]

    return encode


def cuts(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n tokens: only what is longer than capacity is cut, and the first piece may be shorter."""
    if n <= capacity:
        return [(0, n)]
    head = n % capacity or capacity
    return [(0, head), *((s, capacity) for s in range(head, n, capacity))]


def pieces(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """The pieces of all documents: id, piece, start, length, ids_crc32."""
    rows = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("_text"))
    end = np.array([end_id], "<u4")
    names = ["_id", "piece", "start", "length", "ids_crc32"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoder(tokenizer)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                own, rest = [], []
                for i, ids in enumerate(encode(part.column(1).to_pylist())):
                    ids = np.concatenate([ids, end]).astype("<u4", copy=False)
                    for k, (start, length) in enumerate(cuts(len(ids), capacity)):
                        own.append(i)
                        rest.append((k, start, length, zlib.crc32(ids[start : start + length].tobytes())))
                cols = list(zip(*rest, strict=True))
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(own, pa.int64())), pa.array(cols[0], pa.int32()), *(pa.array(c, pa.int64()) for c in cols[1:])], names)

    return rows.mapInArrow(run, f"_id {dict(rows.dtypes)['_id']}, piece int, start long, length long, ids_crc32 long")


def pack(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """One row for each piece: id, piece, start, length, ids_crc32, sequence_id, offset."""
    spark = docs.sparkSession
    # a number of its own for each piece, so that neither repeated nor null ids share a bucket
    cut = saved(pieces(docs, tokenizer, id_col, text_col, capacity, end_id).withColumn("_row", F.monotonically_increasing_id()), "pack-pieces")
    histogram = {r["length"]: r["count"] for r in cut.groupBy("length").count().collect()}  # at most capacity rows
    runs = spark.createDataFrame([(*x,) for x in plan(histogram, capacity)], "length long, _first long, _count long, _each long, _sequence long, _offset long")
    buckets = spark.createDataFrame([(n, -(-c // BUCKET_ROWS)) for n, c in histogram.items()], "length long, _buckets long")
    spread = cut.join(F.broadcast(buckets), "length").withColumn("_bucket", F.pmod(F.xxhash64("_row"), F.col("_buckets")))
    before = offsets(spread.groupBy("length", "_bucket").agg(F.count(F.lit(1)).alias("_n")), "length", "_bucket", "_n", "_before")
    ranked = (
        spread.withColumn("_in", F.row_number().over(Window.partitionBy("length", "_bucket").orderBy("_row")))
        .join(before, ["length", "_bucket"])
        .withColumn("_rank", F.col("_before") + F.col("_in") - 1)
    )
    slot = ranked.join(F.broadcast(runs), "length").filter((F.col("_rank") >= F.col("_first")) & (F.col("_rank") < F.col("_first") + F.col("_count")))
    place = F.col("_rank") - F.col("_first")
    return slot.select(
        F.col("_id").alias(id_col), "piece", "start", "length", "ids_crc32",
        (F.col("_sequence") + F.expr("(_rank - _first) div _each")).alias("sequence_id"),
        (F.col("_offset") + F.pmod(place, F.col("_each")) * F.col("length")).alias("offset"),
    )
