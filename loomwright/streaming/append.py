"""A file stream of documents into a table: each record once, whatever is sent again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.identity import signature
from ..operators.chunking import chunk


def append_new(batch: DataFrame, target: str) -> None:
    """Appends the rows of a batch that target does not have yet, one of each identity. A batch that is run again adds nothing."""
    spark = batch.sparkSession
    fresh = batch.withColumn("_signature", signature()).dropDuplicates(["_signature"])
    jvm = spark._jvm.org.apache.hadoop.fs.Path(target)
    if jvm.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jvm):
        seen = spark.read.parquet(target).select(signature().alias("_signature"))
        fresh = fresh.join(seen, "_signature", "left_anti")
    fresh.drop("_signature").write.mode("append").parquet(target)


def stream_chunks(spark: SparkSession, source: str, schema: str, target: str, checkpoint: str, size: int = 4096, overlap: int = 256):
    """Starts a query that chunks the Parquet documents that arrive in source and appends new chunks to target; it stops when
    all files that are there have been read."""
    docs = spark.readStream.schema(schema).parquet(source)
    rows = chunk(docs, size, overlap).withColumns({"stage_name": F.lit("source"), "teacher_name": F.lit("none"), "mode": F.lit("chunks")})
    return rows.writeStream.foreachBatch(lambda df, _: append_new(df, target)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def stream_events(spark: SparkSession, source: str, schema: str, target: str, checkpoint: str):
    """The same for keyed event rows: an event_id is kept once."""

    def append(df: DataFrame, _: int) -> None:
        rows = df.withColumns({"doc_id": F.col("event_id").cast("string"), "chunk_index": F.lit(0), "byte_start": F.lit(0), "byte_end": F.lit(0), "stage_name": F.lit("event"), "teacher_name": F.lit("none"), "mode": F.lit("event")})
        append_new(rows, target)

    return spark.readStream.schema(schema).parquet(source).writeStream.foreachBatch(append).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
