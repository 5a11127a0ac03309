"""Word shingles of Arrow text batches as 64-bit hashes, by numpy over the bytes of the batch.

A-Z are lower-cased; words are runs of anything but the six ASCII white-space characters. A text's set is its distinct shingles
of WIDTH words; with fewer words, the whole sequence as one; without words, empty.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash

WIDTH = 5
#: Words up to this many bytes are hashed side by side, longer ones one by one.
SHORT_WORD = 48

_space = np.zeros(256, bool)
_space[[0x20, *range(0x09, 0x0E)]] = True
_lower = np.arange(256, dtype=np.uint8)
_lower[65:91] += 32
_odd = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (the finaliser of splitmix64)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, in order, and for each text where its words begin (one more entry at the end)."""
    offsets, data = _bytes(texts)
    data = _lower[data]
    inside = ~_space[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    offsets = offsets - offsets[0]
    edge = offsets[:-1][offsets[:-1] < len(data)]
    begins[edge] = inside[edge]
    start = np.flatnonzero(begins)
    ends = ~inside
    ends[edge] = True
    # a word ends at the next white space or the next text
    stop_at = np.flatnonzero(ends | begins)
    stop = np.append(stop_at, len(data))[np.searchsorted(stop_at, start, "right")]
    length = stop - start
    h = np.full(len(start), 0x1F0D3804, np.uint64) + length.astype(np.uint64)
    order = np.argsort(-np.minimum(length, SHORT_WORD + 1), kind="stable")
    sorted_length = length[order]
    long_words = int(np.searchsorted(-sorted_length, -SHORT_WORD, "left"))
    for i in order[:long_words]:
        h[i] = xxhash.xxh3_64_intdigest(data[start[i] : stop[i]].tobytes())
    order, sorted_length = order[long_words:], sorted_length[long_words:]
    s, acc = start[order], h[order]
    for k in range(int(sorted_length[0]) if len(order) else 0):
        n = int(np.searchsorted(-sorted_length, -k, "left"))  # words longer than k
        acc[:n] = acc[:n] * np.uint64(0x100000001B3) + data[s[:n] + k]
    h[order] = acc
    return mixed(h), np.searchsorted(start, offsets)


def _bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and bytes of a string array without nulls."""
    large = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    _, offsets, data = texts.buffers()
    if len(texts) == 0 or offsets is None:
        return np.zeros(1, np.int64), np.zeros(0, np.uint8)
    o = np.frombuffer(offsets, np.int64 if large else np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    d = np.frombuffer(data, np.uint8)[o[0] : o[-1]] if data is not None else np.zeros(0, np.uint8)
    return o, d


def shingle_sets(texts: pa.Array) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    w, at = words(texts)
    n = len(w)
    full = np.zeros(max(0, n - WIDTH + 1), np.uint64)
    for k in range(WIDTH):
        full += w[k : k + len(full)] * _odd[k]
    full = mixed(full)
    out = []
    for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
        if b - a >= WIDTH:
            out.append(np.unique(full[a : b - WIDTH + 1]))
        elif b > a:
            out.append(mixed((w[a:b] * _odd[: b - a]).sum(keepdims=True) + np.uint64(b - a)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out
