"""Column builders for documents as text and bytes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def safe_text(x: Column) -> Column:
    """Null is empty; anything else is its string."""
    return F.coalesce(x.cast("string"), F.lit(""))


def unix_newlines(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\r\n"), F.lit("\n")), F.lit("\r"), F.lit("\n"))


def path_id(path: Column) -> Column:
    """A stable document id of a relative path with forward slashes."""
    return F.sha2(path, 256)


def utf8(text: Column) -> Column:
    return F.encode(text, "UTF-8")


def lossy(data: Column) -> Column:
    """Bytes as text, each malformed part replaced by U+FFFD."""
    return F.make_valid_utf8(data.cast("string"))


def base64_line(data: Column) -> Column:
    """Base64 without the line breaks that Spark puts in."""
    return F.translate(F.base64(data), "\r\n", "")


def preview(text: Column, width: int) -> Column:
    """Line feeds shown as \\n; what is longer than width ends in three dots."""
    one_line = F.replace(text, F.lit("\n"), F.lit("\\n"))
    return F.when(F.length(one_line) > width, F.concat(F.substring(one_line, 1, width), F.lit("..."))).otherwise(one_line)


def shard_id(stem: Column) -> Column:
    """What follows the last dash."""
    return F.element_at(F.split(stem, "-"), -1)


def hash_bucket(key: Column, buckets: int = 10_000) -> Column:
    """The first eight hex digits of the key's SHA-256, modulo buckets."""
    return F.pmod(F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("long"), F.lit(buckets))


def draw_order(seed: int, *key: Column) -> Column:
    """A key to shuffle rows by: the same for the same seed and row, whatever the partitions."""
    return F.sha2(F.concat_ws(":", F.lit(str(seed)), *(k.cast("string") for k in key)), 256)


#: The characters that Unicode counts as white space, as a class for Java's and RE2's regular expressions.
SPACES = r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def stripped(text: Column) -> Column:
    """Without white space at either end."""
    return F.regexp_replace(text, f"^{SPACES}+|{SPACES}+$", "")
