"""Quality classifier: a byte-level convolutional network in numpy.

A text's UTF-8 bytes are cut into chunks of CHUNK bytes, each OVERLAP bytes into the one before, so that every byte
lies in some window of every filter; windows begin only at even places of the document (STRIDE). Bytes are embedded, learned filters of WIDTH bytes slide over a chunk by STRIDE, and each
filter's largest response is kept. Over a document's chunks these are pooled by maximum, mean and minimum, and one logistic
unit combines them into the probability of label 1.

Fitting takes at most TRAIN_ROWS labelled rows, chosen by hash, of texts up to TRAIN_BYTES bytes, in one task of that bounded
size; only the network comes back. Scoring covers all documents whole: only texts go through Python, in Arrow batches that
are cut by bytes, and a very long text is chunked and scored by itself.

Cases: a null text is empty; an empty text has the score of an all-padding chunk; labels that are null, or whose document is
missing, teach nothing, and a document with several labels counts once for each; with labels of one kind only, or none,
the score is the smoothed share of label 1; equal texts, and so repeated rows, have equal scores; where two filters or
places respond alike, either gives the same score; an empty table gives an empty result; other columns, whatever their
names, do not matter.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CHUNK, OVERLAP = 512, 32
EMBED, WIDTH, STRIDE, FILTERS = 6, 8, 2, 24
TRAIN_ROWS, TRAIN_BYTES = 6_000, 1 << 17
#: At least so many passes and so many steps, so that a few hundred labels are learned as well.
EPOCHS, STEPS, BATCH_CHUNKS, RATE = 10, 900, 256, 0.01
THRESHOLD = 0.7
CALL_BYTES = 1 << 20
PAD = 256


def chunked(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Chunks of all texts as rows of byte values, padded with PAD, and where each text's chunks begin."""
    hop = CHUNK - OVERLAP
    n = np.array([1 + max(0, -(-(len(t) - CHUNK) // hop)) for t in texts], np.int64)
    starts = np.cumsum(np.append(0, n))
    out = np.full((starts[-1], CHUNK), PAD, np.int16)
    for t, at, k in zip(texts, starts[:-1].tolist(), n.tolist(), strict=True):
        data = np.frombuffer(t, np.uint8)
        for i in range(k):
            part = data[i * hop : i * hop + CHUNK]
            out[at + i, : len(part)] = part
    return out, starts


class Network:
    def __init__(self, seed: int = 11):
        r = np.random.default_rng(seed)
        self.embed = r.normal(0, 0.5, (PAD + 1, EMBED)).astype(np.float32)
        self.embed[PAD] = 0
        self.filters = r.normal(0, 1 / math.sqrt(EMBED * WIDTH), (EMBED * WIDTH, FILTERS)).astype(np.float32)
        self.bias = np.zeros(FILTERS, np.float32)
        self.out = np.zeros(3 * FILTERS, np.float32)
        self.out_bias = np.zeros(1, np.float32)

    def windows(self, chunks: np.ndarray) -> np.ndarray:
        e = self.embed[chunks].reshape(len(chunks), CHUNK * EMBED)
        places = (CHUNK - WIDTH) // STRIDE + 1
        a, b = e.strides
        return np.lib.stride_tricks.as_strided(e, (len(chunks), places, WIDTH * EMBED), (a, b * EMBED * STRIDE, b))

    def responses(self, chunks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Largest response of each filter in each chunk, and its place."""
        top = np.empty((len(chunks), FILTERS), np.float32)
        place = np.empty((len(chunks), FILTERS), np.int32)
        for at in range(0, len(chunks), 64):
            w = self.windows(chunks[at : at + 64])
            r = (w.reshape(-1, WIDTH * EMBED) @ self.filters).reshape(len(w), -1, FILTERS)
            p = r.argmax(1)
            place[at : at + 64] = p
            top[at : at + 64] = np.take_along_axis(r, p[:, None], 1)[:, 0]
        return np.tanh(top + self.bias), place

    def pooled(self, top: np.ndarray, starts: np.ndarray) -> np.ndarray:
        n = np.diff(starts)[:, None]
        at = starts[:-1]
        return np.concatenate([np.maximum.reduceat(top, at), np.add.reduceat(top, at) / n, np.minimum.reduceat(top, at)], 1)

    def score(self, texts: list[bytes]) -> np.ndarray:
        if not texts:
            return np.zeros(0)
        chunks, starts = chunked(texts)
        z = self.pooled(self.responses(chunks)[0], starts).astype(np.float64) @ self.out + self.out_bias[0]
        return 1 / (1 + np.exp(-np.clip(z, -500, 500)))

    def fit(self, texts: list[bytes], labels: np.ndarray, seed: int = 3) -> Network:
        """Adam on the log loss, over batches of about BATCH_CHUNKS chunks."""
        r = np.random.default_rng(seed)
        weights = ["embed", "filters", "bias", "out", "out_bias"]
        m = {k: np.zeros_like(getattr(self, k)) for k in weights}
        v = {k: np.zeros_like(getattr(self, k)) for k in weights}
        step = 0
        share = np.clip(labels.mean(), 0.01, 0.99)
        self.out_bias[:] = math.log(share / (1 - share))
        sizes = np.array([1 + len(t) // CHUNK for t in texts])
        epochs = max(EPOCHS, -(-STEPS * BATCH_CHUNKS // int(sizes.sum())))
        for epoch in range(epochs):
            order = r.permutation(len(texts))
            groups = np.cumsum(sizes[order]) // BATCH_CHUNKS
            rate = RATE * (1 - epoch / epochs)
            for own in np.split(order, np.flatnonzero(np.diff(groups)) + 1):
                step += 1
                for k, g in self._gradient([texts[i] for i in own], labels[own]).items():
                    m[k] = 0.9 * m[k] + 0.1 * g
                    v[k] = 0.999 * v[k] + 0.001 * g * g
                    getattr(self, k)[...] -= rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
                self.embed[PAD] = 0
        return self

    def _gradient(self, texts: list[bytes], labels: np.ndarray) -> dict[str, np.ndarray]:
        chunks, starts = chunked(texts)
        top, place = self.responses(chunks)
        features = self.pooled(top, starts)
        z = features @ self.out + self.out_bias[0]
        d = ((1 / (1 + np.exp(-z)) - labels) / len(labels)).astype(np.float32)
        g = {"out": features.T @ d + 1e-4 * self.out, "out_bias": d.sum(keepdims=True)}
        df = d[:, None] * self.out
        n = np.diff(starts)
        doc = np.repeat(np.arange(len(texts)), n)
        high, mean, low = df[:, :FILTERS], df[:, FILTERS : 2 * FILTERS], df[:, 2 * FILTERS :]
        share = lambda hit: hit / np.add.reduceat(hit.astype(np.float32), starts[:-1])[doc]
        dt = high[doc] * share(top == features[doc, :FILTERS]) + mean[doc] / n[doc][:, None] + low[doc] * share(top == features[doc, 2 * FILTERS :])
        dt = (dt * (1 - top * top)).astype(np.float32)
        g["bias"] = dt.sum(0)
        g["filters"], g["embed"] = np.zeros_like(self.filters), np.zeros_like(self.embed)
        rows = np.arange(len(chunks))
        for f in range(FILTERS):  # only the places of the largest responses have a gradient
            at = place[:, f, None] * STRIDE + np.arange(WIDTH)
            seen = chunks[rows[:, None], at]
            g["filters"][:, f] = dt[:, f] @ self.embed[seen].reshape(len(chunks), -1)
            np.add.at(g["embed"], seen, dt[:, f, None, None] * self.filters[:, f].reshape(WIDTH, EMBED))
        return g


class Share:
    """The score where nothing can be learned."""

    def __init__(self, labels: np.ndarray):
        self.share = (labels.sum() + 1) / (len(labels) + 2)

    def score(self, texts: list[bytes]) -> np.ndarray:
        return np.full(len(texts), self.share)


def held_out(id_col: str = "doc_id") -> Column:
    return F.pmod(F.crc32(F.col(id_col).cast("string")), F.lit(4)) == 2


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", seed: int = 7) -> Network | Share:
    """Fit on TRAIN_ROWS of labels at most; labels: the rows that may be learned from."""
    known = labels.filter(F.col(label_col).isin(0, 1)).select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("_label")).distinct()
    n = known.count()
    draw = F.pmod(F.xxhash64(F.lit(seed), F.col("_id").cast("string")), F.lit(1 << 30)) / float(1 << 30)
    chosen = known.filter(draw < min(1.0, TRAIN_ROWS / max(n, 1)))
    texts = docs.select(F.col(id_col).alias("_id"), F.encode(F.coalesce(F.col(text_col).cast("string"), F.lit("")), "UTF-8").alias("_text")).filter(F.octet_length("_text") <= TRAIN_BYTES)
    # about TRAIN_ROWS ids, whatever the size of labels; an id that many rows have is cut by the order
    sample = texts.join(F.broadcast(chosen), "_id").orderBy(F.xxhash64(F.lit(seed), "_id", "_text", "_label"), "_id", "_label").limit(TRAIN_ROWS).select("_id", "_label", "_text")

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = sorted((x["_id"], x["_label"], x["_text"]) for b in batches for x in b.to_pylist())
        y = np.array([x[1] for x in rows], np.float32)
        made = Network().fit([x[2] for x in rows], y) if len(set(y.tolist())) > 1 else Share(y)
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(made)], pa.binary())], ["model"])

    made = sample.coalesce(1).mapInArrow(fit, "model binary").collect()
    return pickle.loads(bytes(made[0]["model"])) if made else Share(np.zeros(0))


def score_column(text: Column, model: Network | Share) -> Column:
    """The score of a text. Only texts go through Python, in Arrow batches that are cut by bytes."""

    @F.arrow_udf("double")
    def run(texts: pa.Array) -> pa.Array:
        sizes = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
        out, at = [], 0
        while at < len(texts):
            done = sizes[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(sizes, done + CALL_BYTES, "right")))
            out.append(model.score(texts.slice(at, to - at).to_pylist()))
            at = to
        return pa.array(np.concatenate(out) if out else np.zeros(0), pa.float64())

    return run(F.encode(F.coalesce(text.cast("string"), F.lit("")), "UTF-8"))


def score(docs: DataFrame, model: Network | Share, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each document: id, score."""
    return docs.select(F.col(id_col), score_column(F.col(text_col), model).alias("score"))
