"""URL filters: host-suffix and path-prefix expressions looked up by short hash prefixes.

A URL is expanded into its host suffixes, cut at dots, times its path prefixes of the lengths that rules have. An expression
is looked up by the first SHORT hex digits of its SHA-256; the full digest then confirms the hit, and the longest rule wins
(between rules of one length the greater string, and for one string block before allow).

Distinct (host, path) pairs are judged, so a page copied a million times is expanded once; its rows are dealt to several tasks
when they get the verdict. The rules are broadcast only
while they number at most BROADCAST_RULES; beyond that the join shuffles both sides.

Cases: a null URL, or one without ://, has an empty host and path and no rule; repeated rows each get the verdict; an empty
table gives an empty result; other columns, whatever their names, do not matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import salted_join

SHORT = 8
BROADCAST_RULES = 50_000
#: The rules of the query, as (verdict, host and path).
RULES = [("block", "com/en/"), ("allow", "example.com/en/7"), ("allow", "net/de/"), ("block", "example.net/de/8"), ("block", "org/es/")]
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_path(url: Column) -> tuple[Column, Column]:
    """Host, with A-Z lower-cased, and path of a URL; both empty without ://."""
    after = F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1)
    host = F.translate(F.regexp_extract(after, r"^[^/?#]*", 0), UPPER, LOWER)
    path = F.regexp_extract(after, r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def rule_table(spark, rules: list[tuple[str, str]]) -> DataFrame:
    """(verdict, "host/path") as a table verdict, rule, labels (of the host), length (of the path)."""
    rows = [(v, h.translate(str.maketrans(UPPER, LOWER)) + slash + p) for v, r in rules for h, slash, p in [r.partition("/")]]
    return spark.createDataFrame(rows, "verdict string, rule string").select(
        "verdict",
        "rule",
        F.size(F.split(F.substring_index("rule", "/", 1), "[.]")).alias("labels"),
        F.expr("length(rule) - length(substring_index(rule, '/', 1))").alias("length"),
    )


def judge(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url", default: str = "allow") -> DataFrame:
    """One row for each page: id, host, path, rule (the one that decided, else null), verdict (its own, else default)."""
    shape = rules.agg(F.count(F.lit(1)), F.max("labels"), F.collect_set("length")).collect()[0]
    n_rules, labels, lengths = shape[0], shape[1] or 0, sorted(shape[2])
    host, path = host_path(F.col(url_col).cast("string"))
    split = pages.select(F.col(id_col).alias("_id"), host.alias("_host"), path.alias("_path"))
    # a rule with k labels can only fit the last k labels, so longer suffixes need not be made
    parts = F.split("_host", "[.]")
    suffixes = F.transform(F.sequence(F.lit(1), F.least(F.size(parts), F.lit(labels))), lambda k: F.array_join(F.slice(parts, F.size(parts) - k + 1, k), "."))
    prefixes = F.array_compact(F.array(*(F.when(F.length("_path") >= n, F.substring("_path", 1, n)) for n in lengths)))
    asked = (
        split.filter("_host <> ''").select("_host", "_path").distinct()
        .select("_host", "_path", F.explode(suffixes).alias("_suffix"))
        .select("_host", "_path", "_suffix", F.explode(prefixes).alias("_prefix"))
        .withColumn("_expression", F.concat("_suffix", "_prefix"))
        .withColumn("_digest", F.sha2("_expression", 256))
        .select("_host", "_path", "_digest", F.substring("_digest", 1, SHORT).alias("_short"))
    )
    known = rules.select("rule", "verdict", F.sha2("rule", 256).alias("_full")).withColumn("_short", F.substring("_full", 1, SHORT))
    hit = asked.join(F.broadcast(known) if n_rules <= BROADCAST_RULES else known, "_short").filter(F.col("_digest") == F.col("_full"))
    best = hit.groupBy("_host", "_path").agg(F.max(F.struct(F.length("rule").alias("n"), "rule", F.col("verdict").alias("v"))).alias("_best"))
    return salted_join(split, best, ["_host", "_path"], F.struct("_id")).select(
        F.col("_id").alias(id_col), F.col("_host").alias("host"), F.col("_path").alias("path"),
        F.col("_best.rule").alias("rule"), F.coalesce(F.col("_best.v"), F.lit(default)).alias("verdict"),
    )
