"""Schemas from text, without a session."""

from __future__ import annotations

import re

from pyspark.sql import types as T

SIMPLE = {"string": T.StringType, "int": T.IntegerType, "long": T.LongType, "double": T.DoubleType, "boolean": T.BooleanType, "binary": T.BinaryType}


def kind(name: str) -> T.DataType:
    inner = re.fullmatch(r"array<(.*)>", name)
    return T.ArrayType(kind(inner[1])) if inner else SIMPLE[name]()


def schema(text: str) -> T.StructType:
    """Of "name type, name type"; types are simple ones and arrays of them."""
    return T.StructType([T.StructField(n, kind(k)) for n, k in (part.split() for part in text.split(","))])
