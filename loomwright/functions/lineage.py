"""Written tables that cut lineage, in the folder that the cluster shares."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """This application's part of spark.checkpoint.dir; a new local folder only where that is unset and Spark runs in one process."""
    sc = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not folder:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="loomwright-")
        sc.setCheckpointDir(folder)
    return f"{folder}/{sc.applicationId}"


def saved(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """df written as Parquet and read back: every later read sees the same rows, also after an executor is lost."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", compression).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
