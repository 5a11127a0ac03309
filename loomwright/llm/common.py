"""Helpers shared by the operators: table access, the shared folder, text columns."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: A word is a run of anything but the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir; a new local one only where that is unset and Spark runs in
    one process."""
    sc = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not folder:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="loomwright-")
        sc.setCheckpointDir(folder)
    return f"{folder}/{sc.applicationId}"


#: Rows of a written file, where a bound on the rows is known.
FILE_ROWS = 100_000


def saved(df: DataFrame, name: str, rows: int | None = None) -> DataFrame:
    """Cut the lineage: write df as Parquet into the shared folder and read it back.

    The table outlives a lost executor, and every later read sees the same rows. rows: a bound on its slim rows, if one is known;
    the table then has a file for each FILE_ROWS of them, not one for each partition of the last shuffle.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    (df if rows is None else df.coalesce(max(1, -(-rows // FILE_ROWS)))).write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def word_count(text: Column) -> Column:
    return F.coalesce(F.size(F.regexp_extract_all(text, F.lit(WORD), F.lit(0))), F.lit(0)).cast("long")


def no_text(text: str) -> Column:
    return F.coalesce(F.col(text), F.lit(""))


def fresh(df: DataFrame, name: str) -> str:
    """A column name that df does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


#: A key of more rows than HOT_ROWS is split in salted_join; tables of more rows than BROADCAST_ROWS are not broadcast.
HOT_ROWS, BROADCAST_ROWS = 100_000, 50_000


def small(df: DataFrame) -> DataFrame:
    """df, a written or tiny table, marked for broadcast if its rows number at most BROADCAST_ROWS."""
    return F.broadcast(df) if df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else df


def salted_join(rows: DataFrame, facts: DataFrame, keys: list[str], spread: Column) -> DataFrame:
    """rows left join facts on keys, of which facts has each once. The rows of a key that more than HOT_ROWS have are dealt by
    spread to several tasks, and the key's fact is copied to each."""
    salt, salts = fresh(rows, "_salt"), fresh(rows, "_salts")
    counted = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias(salts)).filter(F.col(salts) > HOT_ROWS)
    hot = saved(counted.withColumn(salts, F.ceil(F.col(salts) / HOT_ROWS)), "hot-keys")
    if hot.limit(1).count() == 0:
        return rows.join(facts, keys, "left")
    number = F.coalesce(salts, F.lit(1).cast("long"))
    left = rows.join(small(hot), keys, "left").withColumn(salt, F.pmod(F.xxhash64(spread), number)).drop(salts)
    right = facts.join(small(hot), keys, "left").withColumn(salt, F.explode(F.sequence(F.lit(0).cast("long"), number - 1))).drop(salts)
    return left.join(right, [*keys, salt], "left").drop(salt)


def offsets(counts: DataFrame, key: str, bucket: str, value: str, name: str) -> DataFrame:
    """key, bucket and name, the sum of value over the key's buckets before. counts has a row for each key and bucket (from 0).

    Sums are made within spans of 1,024 buckets and over the spans, so no task orders all buckets of a key.
    """
    spanned = counts.withColumn("_span", F.shiftright(bucket, 10))
    inside = Window.partitionBy(key, "_span").orderBy(bucket).rowsBetween(Window.unboundedPreceding, 0)
    spans = spanned.groupBy(key, "_span").agg(F.sum(value).alias("_all"))
    over = Window.partitionBy(key).orderBy("_span").rowsBetween(Window.unboundedPreceding, 0)
    first = spans.select(key, "_span", (F.sum("_all").over(over) - F.col("_all")).alias("_first"))
    within = spanned.withColumn("_in", F.sum(value).over(inside) - F.col(value))
    return within.join(first, [key, "_span"]).select(key, bucket, (F.col("_first") + F.col("_in")).alias(name))
