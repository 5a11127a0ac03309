"""Token counts: batches encoded in Arrow functions that return lengths only.

The rows of an Arrow batch are cut into pieces and dealt into encoder calls of about CALL_BYTES bytes of UTF-8 each, so one very
long text neither waits for nor swells a batch. Texts over SPLIT_BYTES are cut at safe boundaries, where no token can span: for
tokenizers that drop white space, before a space. A tokenizer without such boundaries gets whole texts.

Where boundaries are safe, every space is one, so a call's pieces are cut to words and only the distinct words that the worker
has not counted before are encoded, in batches of about CALL_BYTES bytes. A worker remembers up to WORDS words of up to
LONG_WORD characters; over that it forgets all and goes on, so memory is bounded and counts are the same.

Cases: a null text counts as empty: 0 tokens; repeated rows each get their count; an empty table gives an empty result; other
columns do not matter.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CALL_BYTES = 1 << 20
SPLIT_BYTES = 1 << 16
WORDS = 1 << 20
LONG_WORD = 64
OVER = 2048


@cache
def load(path: str):
    """A function from texts to token counts, and the characters at which texts may be cut: none, space, or space and line feed."""
    if path.endswith(".model"):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        return (lambda texts: [len(x) for x in model.encode(texts, num_threads=1)]), ""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    import json

    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(path)
    tok.no_truncation()
    tok.no_padding()
    with open(path, encoding="utf-8") as f:
        made = json.load(f)
    kept = [p for p in (made.get("pre_tokenizer") or {}).get("pretokenizers", []) if "Removed" in str(p.get("behavior")) and p.get("invert")]
    patterns = [str(p["pattern"].get("Regex", " ")) for p in kept]
    # no alternative of the pattern can hold white space: no literal one, no dot, no class that takes it in
    lines_dropped = any(all(r"\s" in c for c in re.findall(r"\[\^[^\]]*\]", p)) and not re.search(r"[\s.]|\\[SWDnrt]", re.sub(r"\[\^[^\]]*\]", "", p).replace(r"\s", " ")) for p in patterns)
    inside = any(" " in t["content"] or t.get("lstrip") or t.get("rstrip") for t in made.get("added_tokens", []))
    cuts = "" if not kept or inside else " \n" if lines_dropped and not any("\n" in t["content"] for t in made.get("added_tokens", [])) else " "
    return (lambda texts: [len(x) for x in tok.encode_batch_fast(texts, add_special_tokens=False)]), cuts


@cache
def remembered(path: str) -> dict[str, int]:
    """The words that this worker has counted."""
    return {}


def by_words(pieces: list[str], path: str) -> list[int]:
    """Token counts of pieces by those of their words."""
    encode, cuts = load(path)
    known = remembered(path)
    words = [(p.replace("\n", " ") if "\n" in cuts else p).split(" ") for p in pieces]
    fresh = list(set().union(*words) - known.keys())
    for at, to in calls([len(w.encode()) for w in fresh]):
        known.update(zip(fresh[at:to], encode(fresh[at:to]), strict=True))
    out = [sum(map(known.__getitem__, w)) for w in words]
    for w in fresh:
        if len(w) > LONG_WORD:
            del known[w]
    if len(known) > WORDS:
        known.clear()
    return out


def cut(text: str, size: int = SPLIT_BYTES) -> list[str]:
    """Pieces of about size bytes, each but the first beginning with a space; a run without spaces stays whole."""
    data = text.encode()
    if len(data) <= size:
        return [text]
    out, at = [], 0
    while len(data) - at > size and (to := data.find(b" ", at + size)) >= 0:
        out.append(data[at:to].decode())
        at = to
    return [*out, data[at:].decode()]


def calls(sizes: list[int], most: int = CALL_BYTES) -> list[tuple[int, int]]:
    """Runs of pieces, from and to, of at most so many bytes; a piece over that is a run of its own."""
    out, at = [], 0
    while at < len(sizes):
        to, held = at, 0
        while to < len(sizes) and (to == at or held + sizes[to] <= most):
            held += sizes[to]
            to += 1
        out.append((at, to))
        at = to
    return out


def counts(texts: list[str], path: str) -> np.ndarray:
    encode, cuts = load(path)
    rows, pieces = [], []
    for i, t in enumerate(texts):
        own = cut(t) if cuts else [t]
        pieces += own
        rows += [i] * len(own)
    total = np.zeros(len(texts), np.int64)
    for at, to in calls([len(p.encode()) for p in pieces]):
        np.add.at(total, rows[at:to], by_words(pieces[at:to], path) if cuts else encode(pieces[at:to]))
    return total


def count_tokens(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", limit: int = OVER) -> DataFrame:
    """One row for each document: id, n_bytes, n_tokens, over_limit. tokenizer: a file that every executor can open."""
    rows = docs.select(F.col(id_col).alias(id_col), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(1)
            n = counts(texts.to_pylist(), tokenizer)
            size = pa.compute.binary_length(texts).cast(pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0), size, pa.array(n), pa.array(n > limit)], ["id", "n_bytes", "n_tokens", "over_limit"])

    import pyarrow.compute  # noqa: F401

    kind = dict(rows.dtypes)[id_col]
    out = rows.mapInArrow(run, f"id {kind}, n_bytes long, n_tokens long, over_limit boolean")
    return out.withColumnRenamed("id", id_col)
