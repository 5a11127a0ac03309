"""Small files (manifests, listings, renames) through Hadoop's file system, so any store that Spark reads will do."""

from __future__ import annotations

import json
from typing import Any

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    p, fs = _path(spark, path)
    return fs.exists(p)


def is_dir(spark: SparkSession, path: str) -> bool:
    p, fs = _path(spark, path)
    return fs.exists(p) and fs.getFileStatus(p).isDirectory()


def names(spark: SparkSession, path: str) -> list[str]:
    p, fs = _path(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def delete(spark: SparkSession, path: str) -> None:
    p, fs = _path(spark, path)
    fs.delete(p, True)


def rename(spark: SparkSession, old: str, new: str) -> None:
    p, fs = _path(spark, old)
    q, _ = _path(spark, new)
    fs.mkdirs(q.getParent())
    if not fs.rename(p, q):
        raise OSError(f"cannot rename {old} to {new}")


def read_text(spark: SparkSession, path: str) -> str | None:
    """The text of a file, None if there is none."""
    p, fs = _path(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode("utf-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Writes beside the file and renames, so a reader sees the old text or the new."""
    p, fs = _path(spark, path)
    part, _ = _path(spark, path + ".part")
    fs.mkdirs(p.getParent())
    stream = fs.create(part, True)
    try:
        stream.write(bytearray(text.encode("utf-8")))
    finally:
        stream.close()
    fs.delete(p, False)
    if not fs.rename(part, p):
        raise OSError(f"cannot write {path}")


def read_json(spark: SparkSession, path: str) -> Any:
    """A JSON document; None if the file is missing or broken."""
    try:
        text = read_text(spark, path)
        return None if text is None else json.loads(text)
    except ValueError:
        return None


def write_json(spark: SparkSession, path: str, value: Any) -> None:
    write_text(spark, path, json.dumps(value, indent=2, sort_keys=True, ensure_ascii=False) + "\n")
