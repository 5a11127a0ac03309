"""Language ID by prediction by partial matching.

Each language has a context tree of byte counts, up to ORDER bytes deep. A byte's probability in a context is its count over
the context's total plus its number of distinct bytes; a byte that the context never had pays an escape (the distinct bytes
over the same sum) and is coded one byte shallower, at last evenly among 256. A context that a language's tree lacks is
passed over to the next shorter one at no cost. The statistics are frozen after training, so a text's code length is the
exact sum of its bytes' costs; the language with the shortest code wins, and the score is its share of the probability.

Fitting takes about TRAIN_ROWS distinct labelled texts of each language, chosen by hash, of up to TRAIN_BYTES bytes; every context
of that sample is kept, whatever the bytes and languages are. All else covers every text whole.

Costs are held for LANES languages at a time: a row for each gram (a context and its next byte) that one of them has, and a row of
escapes for each context. A gram that none has costs the escapes of its context and what the shorter gram costs. Rows are
found in a hash table, one look for most bytes. A text is read as if ORDER line feeds came before it.

Cases: a text that is null or has no letter is und with score 0; ties go to the first language in order; without any
labelled text every text is und; equal texts, and so repeated rows, get one result; a very long text is scored whole, in
windows; an empty table gives an empty result; other columns do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ORDER = 3
TRAIN_ROWS, TRAIN_BYTES = 2_000, 1 << 17
LANES = 16
SLICE, WINDOW = 256, 1 << 18
UNKNOWN = "und"


def _joined(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts, ORDER line feeds before each, and where each begins (one more at the end)."""
    parts = texts.cast(pa.binary()).to_pylist()
    pad = b"\n" * ORDER
    starts = np.cumsum([0, *(len(p) + ORDER for p in parts)])
    return np.frombuffer(b"".join(x for p in parts for x in (pad, p)), np.uint8), starts


def _pads(n: int, starts: np.ndarray) -> np.ndarray:
    out = np.zeros(n, bool)
    for k in range(ORDER):
        out[starts[:-1] + k] = True
    return out


def _grams(data: np.ndarray) -> np.ndarray:
    """For each place from ORDER on, the ORDER bytes before it and its own, packed."""
    g = np.zeros(max(0, len(data) - ORDER), np.int64)
    for k in range(ORDER + 1):
        g = (g << 8) | data[k : len(data) - ORDER + k]
    return g


class Rows:
    """From distinct keys to their places, by open addressing."""

    def __init__(self, keys: np.ndarray):
        bits = max(4, (4 * len(keys)).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys, self.place = np.full(1 << bits, -1, np.int64), np.full(1 << bits, -1, np.int32)
        left, at = np.arange(len(keys)), self._slot(keys)
        while len(left):
            free = self.keys[at] == -1
            self.keys[at[free]] = keys[left[free]]
            won = self.keys[at] == keys[left]
            self.place[at[won]] = left[won]
            left, at = left[~won], (at[~won] + 1) & self.mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The place of each key, -1 for those that there are not."""
        at = self._slot(keys)
        out = self.place[at]
        left = np.flatnonzero(self.keys[at] != keys)
        at = at[left]
        while len(left):
            there = self.keys[at]
            out[left] = np.where(there == keys[left], self.place[at], -1)
            on = (there != keys[left]) & (there != -1)
            left, at = left[on], (at[on] + 1) & self.mask
        return out


class Costs:
    """Costs in bits of the grams of a few languages; language, gram, count: their statistics, languages from 0 to n - 1."""

    def __init__(self, language: np.ndarray, gram: np.ndarray, count: np.ndarray, n: int):
        lower = None
        grams, contexts, costs, escapes = [], [], [], []
        for order in range(ORDER + 1):
            own = gram & ((1 << 8 * (order + 1)) - 1)
            names, at = (np.arange(256), own) if order == 0 else np.unique(own, return_inverse=True)
            heads, head = np.unique(names >> 8, return_inverse=True)
            c = np.zeros((len(names), n))
            np.add.at(c, (at, language), count)
            total, distinct = np.zeros((len(heads), n)), np.zeros((len(heads), n))
            np.add.at(total, head, c)
            np.add.at(distinct, head, c > 0)
            with np.errstate(divide="ignore", invalid="ignore"):
                escape = np.where(total > 0, np.log2((total + distinct) / distinct), 0.0)
                seen = np.log2((total + distinct)[head] / c)
            below = 8.0 if lower is None else lower[np.searchsorted(known, names & ((1 << 8 * order) - 1))]
            lower, known = np.where(c > 0, seen, escape[head] + below), names
            if order == 0:
                self.plain = lower.astype(np.float32)
            else:
                grams.append(names | order << 32)
                contexts.append(heads | order << 32)
                costs.append(lower.astype(np.float32))
                escapes.append(escape.astype(np.float32))
        self.grams, self.contexts = Rows(np.concatenate(grams)), Rows(np.concatenate(contexts))
        self.costs, self.escapes = np.concatenate(costs), np.concatenate(escapes)

    def bits(self, gram: np.ndarray) -> np.ndarray:
        """The cost of each gram's last byte in each language."""
        out = np.zeros((len(gram), self.plain.shape[1]), np.float32)
        left = np.arange(len(gram))
        for order in range(ORDER, 0, -1):
            g = gram[left] & ((1 << 8 * (order + 1)) - 1)
            row = self.grams.find(g | order << 32)
            hit = row >= 0
            out[left[hit]] += self.costs[row[hit]]
            left, g = left[~hit], g[~hit]
            row = self.contexts.find(g >> 8 | order << 32)
            out[left[row >= 0]] += self.escapes[row[row >= 0]]
        out[left] += self.plain[gram[left] & 255]
        return out


class Model:
    """Frozen statistics: languages, and counts of (language, packed ORDER bytes and the next)."""

    def __init__(self, languages: list[str], language: np.ndarray, gram: np.ndarray, count: np.ndarray):
        self.languages, self.language, self.gram, self.count = languages, language, gram, count
        self._costs: list[Costs] | None = None

    @staticmethod
    def fit(lang: Sequence[str], before: np.ndarray, byte: np.ndarray, count: np.ndarray) -> Model:
        """Columns: language, the ORDER bytes before packed by 8 bits, byte, count."""
        languages = sorted(set(lang))
        index = {x: i for i, x in enumerate(languages)}
        return Model(languages, np.array([index[x] for x in lang], np.int64), np.asarray(before, np.int64) << 8 | np.asarray(byte, np.int64), np.asarray(count, np.int64))

    def costs(self) -> list[Costs]:
        if self._costs is None:
            own = [(self.language // LANES == i) for i in range(-(-len(self.languages) // LANES))]
            self._costs = [Costs(self.language[x] % LANES, self.gram[x], self.count[x], min(LANES, len(self.languages) - i * LANES)) for i, x in enumerate(own)]
        return self._costs

    def bits(self, texts: pa.Array) -> np.ndarray:
        """The code length of each text in each language."""
        data, starts = _joined(texts)
        total = np.zeros((len(texts), len(self.languages)))
        pads = _pads(len(data) + 1, starts)
        for at in range(ORDER, len(data), WINDOW):
            to = min(len(data), at + WINDOW)
            gram = _grams(data[at - ORDER : to])
            first = np.searchsorted(starts, at, "right") - 1
            last = np.searchsorted(starts, to, "left")
            cuts = np.maximum(starts[first:last], at) - at
            for i, costs in enumerate(self.costs()):
                each = costs.bits(gram)
                each[pads[at:to]] = 0
                total[first : first + len(cuts), i * LANES : (i + 1) * LANES] += np.add.reduceat(each, cuts, axis=0, dtype=np.float64)
        return total


_last: dict[int, Model] = {}


def held_out(id_col: str = "doc_id") -> Column:
    return F.pmod(F.crc32(F.col(id_col).cast("string")), F.lit(3)) == 1


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", seed: int = 5) -> Model | None:
    """Fit on about TRAIN_ROWS texts of each language; docs: the rows that may be learned from."""
    spark = docs.sparkSession
    rows = docs.filter(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"), F.col(lang_col).cast("string").alias("_lang"))
    rows = rows.filter(F.octet_length("_text") <= TRAIN_BYTES)
    sizes = [(r["_lang"], min(1.0, TRAIN_ROWS / r["count"])) for r in rows.groupBy("_lang").count().collect()]
    if not sizes:
        return None
    draw = F.pmod(F.xxhash64(F.lit(seed), F.col("_id").cast("string"), "_text"), F.lit(1 << 30)) / float(1 << 30)
    shares = F.broadcast(spark.createDataFrame(sizes, "_lang string, _share double"))  # a row for each language
    sample = rows.join(shares, "_lang").filter(draw < F.col("_share")).select("_lang", "_text").dropDuplicates()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lang in b.column(0).unique().to_pylist():
                data, starts = _joined(b.column(1).filter(pc.equal(b.column(0), lang)))
                gram, n = np.unique(_grams(data)[~_pads(len(data), starts)[ORDER:]], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(gram), pa.string()), pa.array(gram >> 8), pa.array(gram & 255), pa.array(n.astype(np.int64))], ["lang", "before", "byte", "n"])

    counted = sample.mapInArrow(count, "lang string, before long, byte long, n long").groupBy("lang", "before", "byte").agg(F.sum("n").alias("n"))
    found = counted.toArrow()  # bounded by the bytes of the sample
    return Model.fit(found["lang"].to_pylist(), *(found[c].to_numpy() for c in ("before", "byte", "n"))) if found.num_rows else None


def predict(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each document: id, lang_pred, score."""
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text"))
    if model is None:
        return rows.select(F.col("_id").alias(id_col), F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    state = (model.languages, model.language, model.gram, model.count)
    key = hash((tuple(model.languages), model.gram.tobytes(), model.count.tobytes()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if key not in _last:  # a worker keeps the tables of one model for its next task
            _last.clear()
            _last[key] = Model(*state)
        m = _last[key]
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                b = batch.slice(at, SLICE)
                texts = b.column(1).fill_null("")
                bits = m.bits(texts)
                best = bits.argmin(1)
                score = 1 / np.exp2(np.maximum(bits.min(1, keepdims=True) - bits, -1000)).sum(1)
                letters = pc.match_substring_regex(texts, r"\pL").to_numpy(zero_copy_only=False)
                names = [m.languages[i] if ok else UNKNOWN for i, ok in zip(best, letters, strict=True)]
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(names, pa.string()), pa.array(np.where(letters, score, 0.0))], ["_id", "lang_pred", "score"])

    out = rows.mapInArrow(run, f"_id {dict(rows.dtypes)['_id']}, lang_pred string, score double")
    return out.withColumnRenamed("_id", id_col)
