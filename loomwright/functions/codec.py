"""Compact vectors for JSON lines: {"encoding": "ndarray_b64", dtype, shape, data_b64}, little-endian.

Ids take the smallest unsigned type that holds them; floats are halved to 16 bits. Ragged rows stay plain lists.
"""

from __future__ import annotations

import base64
import json
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

ENCODING = "ndarray_b64"
DTYPES = {"uint8": 1, "uint16": 2, "uint32": 4, "float16": 2, "float32": 4}
PACKED = "struct<encoding:string,dtype:string,shape:array<int>,data_b64:string>"


def ids_dtype(rows: Column) -> Column:
    most = F.coalesce(F.array_max(F.flatten(rows)), F.lit(0))
    return F.when(most <= 255, "uint8").when(most <= 65_535, "uint16").otherwise("uint32")


def rectangular(rows: Column) -> Column:
    return F.size(F.array_distinct(F.transform(rows, F.size))) <= 1


def _little_endian(x: Column, size: int) -> Column:
    hexed = F.lpad(F.hex(x.cast("long")), 2 * size, "0")
    return F.concat(*(F.substring(hexed, 2 * (size - 1 - i) + 1, 2) for i in range(size)))


def pack_ids(rows: Column) -> Column:
    """array<array<long>> to the packed struct, null if ragged; numbers below 0 or above 32 bits fail the query."""
    flat = F.flatten(rows)
    dtype = ids_dtype(rows)
    whole = F.array_join(F.when(dtype == "uint8", F.transform(flat, lambda x: _little_endian(x, 1))).when(dtype == "uint16", F.transform(flat, lambda x: _little_endian(x, 2))).otherwise(F.transform(flat, lambda x: _little_endian(x, 4))), "")
    bad = F.exists(flat, lambda x: x.isNull() | (x < 0) | (x > 4_294_967_295))
    shape = F.when(F.size(rows) == 0, F.array(F.lit(0))).otherwise(F.array(F.size(rows), F.size(F.get(rows, F.lit(0)))))
    packed = F.struct(F.lit(ENCODING).alias("encoding"), dtype.alias("dtype"), shape.alias("shape"), F.translate(F.base64(F.unhex(whole)), "\r\n", "").alias("data_b64"))
    return F.when(bad, F.raise_error(F.lit("an id does not fit 32 bits")).cast(packed_type())).when(rectangular(rows), packed)


def packed_type():
    from pyspark.sql.types import _parse_datatype_string

    return _parse_datatype_string(PACKED)


def half(x: Column) -> Column:
    """A double rounded to the nearest 16-bit float (ties to even), without Python; beyond the range it fails the query."""
    size = F.abs(x)
    exponent = F.greatest(F.floor(F.log2(F.greatest(size, F.lit(2.0**-40)))), F.lit(-14))
    # the logarithm may round up to the next power
    exponent = F.when(F.pow(F.lit(2.0), exponent) > size, F.greatest(exponent - 1, F.lit(-14))).otherwise(exponent)
    unit = F.pow(F.lit(2.0), exponent - 10)
    return F.when(size >= 65_520, F.raise_error(F.lit("a value does not fit 16 bits")).cast("double")).otherwise(F.rint(x / unit) * unit)


def half_b64(values: Column) -> Column:
    """array<double> to base64 of its 16-bit floats."""

    @F.arrow_udf("string")
    def run(batch: pa.Array) -> pa.Array:
        flat, ends = batch.values.to_numpy(zero_copy_only=False).astype("<f2"), batch.offsets.to_numpy()
        there = batch.is_valid().to_numpy(zero_copy_only=False)
        return pa.array([base64.b64encode(flat[s:e]).decode() if ok else None for s, e, ok in zip(ends[:-1], ends[1:], there, strict=True)], pa.string())

    return run(values)


def pack_half(values: Column) -> Column:
    return F.struct(F.lit(ENCODING).alias("encoding"), F.lit("float16").alias("dtype"), F.array(F.size(values)).alias("shape"), half_b64(values).alias("data_b64"))


def unpack(dtype: Column, data: Column) -> Column:
    """The numbers of packed vectors, flat."""

    @F.arrow_udf("array<double>")
    def run(kinds: pa.Array, batch: pa.Array) -> pa.Array:
        parts = [None if d is None else np.frombuffer(base64.b64decode(d), np.dtype(t).newbyteorder("<")) for t, d in zip(kinds.to_pylist(), batch.to_pylist(), strict=True)]
        return _lists([None if p is None else len(p) for p in parts], _joined([p for p in parts if p is not None], np.float64))

    return run(dtype, data)


def _joined(parts: list[np.ndarray], kind: type) -> pa.Array:
    return pa.array(np.concatenate([np.zeros(0, kind), *parts]).astype(kind))


def _lists(sizes: list[int | None], values: pa.Array) -> pa.ListArray:
    """Lists of these sizes, one after the other, null where the size is None."""
    ends = np.append(0, np.cumsum([n or 0 for n in sizes])).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends, mask=np.array([n is None for n in sizes] + [False], bool)), values)


def pack_flat(flat: np.ndarray, shape: list[int], floats: bool) -> dict[str, Any]:
    """Numbers of that shape as a packed vector or matrix."""
    if floats:
        if (np.abs(flat) >= 65_520).any():
            raise OverflowError("a value does not fit 16 bits")
        dtype = "float16"
    else:
        least, most = (int(flat.min()), int(flat.max())) if flat.size else (0, 0)
        if least < 0 or most > 0xFFFFFFFF:
            raise OverflowError("an id does not fit 32 bits")
        dtype = "uint8" if most <= 0xFF else "uint16" if most <= 0xFFFF else "uint32"
    return {"encoding": ENCODING, "dtype": dtype, "shape": shape, "data_b64": base64.b64encode(flat.astype(np.dtype(dtype).newbyteorder("<")).tobytes()).decode()}


def pack(values: list, floats: bool = False) -> Any:
    """One vector or matrix for a JSON line; ragged ones are returned as they are."""
    nested = bool(values) and isinstance(values[0], (list, tuple))
    if nested and len({len(r) for r in values}) > 1:
        return values
    flat = np.array([x for r in values for x in r] if nested else list(values), np.float64 if floats else np.int64)
    return pack_flat(flat, [len(values), len(values[0])] if nested else [len(values)], floats)


def packed_lines(values: Column, floats: bool = False) -> Column:
    """Vectors or matrices as JSON of what pack makes. A row is a slice of the batch's numbers, never a list of objects."""

    @F.arrow_udf("string")
    def run(batch: pa.Array) -> pa.Array:
        ends, inner = batch.offsets.to_numpy(), batch.values
        nested = pa.types.is_list(inner.type)
        rows = inner.offsets.to_numpy() if nested else None
        numbers = (inner.values if nested else inner).cast(pa.float64() if floats else pa.int64()).to_numpy(zero_copy_only=False)
        out: list[str | None] = []
        for i, ok in enumerate(batch.is_valid().to_numpy(zero_copy_only=False)):
            s, e = int(ends[i]), int(ends[i + 1])
            if not ok:
                out.append(None)
            elif not nested or s == e:
                out.append(json.dumps(pack_flat(numbers[s:e], [e - s], floats)))
            elif np.ptp(sizes := np.diff(rows[s : e + 1])):
                out.append(json.dumps(batch[i].as_py()))
            else:
                out.append(json.dumps(pack_flat(numbers[rows[s] : rows[e]], [e - s, int(sizes[0])], floats)))
        return pa.array(out, pa.string())

    return run(values)


def unpacked_lines(values: Column, kind: str) -> Column:
    """JSON of packed_lines, or of plain lists, as arrays of kind: array of long or double, or array of those arrays. A vector
    read as a matrix is its only row."""
    nested, number = kind.startswith("array<array"), np.float64 if "double" in kind else np.int64

    def plain(text: str) -> tuple[list[int], np.ndarray]:
        v = json.loads(text)
        if isinstance(v, dict):
            if v.get("encoding") != ENCODING or v["dtype"] not in DTYPES:
                raise ValueError(f"unknown encoding {v.get('encoding')} or dtype {v.get('dtype')}")
            flat = np.frombuffer(base64.b64decode(v["data_b64"]), np.dtype(v["dtype"]).newbyteorder("<"))
            rows, width = (v["shape"][0], v["shape"][1]) if len(v["shape"]) == 2 else (int(len(flat) > 0), len(flat))
            return [width] * rows, flat
        v = v if not v or isinstance(v[0], list) else [v]
        return [len(r) for r in v], np.array([x for r in v for x in r], number)

    @F.arrow_udf(kind)
    def run(batch: pa.Array) -> pa.Array:
        parts = [None if t is None else plain(t) for t in batch.to_pylist()]
        numbers = _joined([p[1] for p in parts if p is not None], number)
        if not nested:
            return _lists([None if p is None else len(p[1]) for p in parts], numbers)
        return _lists([None if p is None else len(p[0]) for p in parts], _lists([n for p in parts if p is not None for n in p[0]], numbers))

    return run(values)


def decode(value: Any) -> Any:
    """What pack made, as lists again; anything else is returned as it is."""
    if not isinstance(value, dict) or value.get("encoding") != ENCODING:
        return value
    if value["dtype"] not in DTYPES:
        raise ValueError(f"unknown dtype {value['dtype']}")
    return np.frombuffer(base64.b64decode(value["data_b64"]), np.dtype(value["dtype"]).newbyteorder("<")).reshape(value["shape"]).tolist()


def canonical_json(value: Any, ascii_only: bool = True) -> str:
    return json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=ascii_only)
