"""The corpus pipeline: from documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir), works on all rows that its predecessor kept, and returns a DataFrame that is written as
Parquet and read again as the next one's docs; all but the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from loomwright.llm import mixing, ngram_join, packing, quality, secret_scan
from loomwright.llm.common import saved, table
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the classifier scores below its threshold. It learns from the labels that are not held out.

    A null text is scored as an empty one; rows with null in other columns, and repeated rows, are judged by their texts alone;
    without labels the smoothed share of good ones, 0.5, is below the threshold; an empty table gives an empty result.
    """
    model = quality.train(docs, table(spark, sf_dir, "labels").filter(~quality.held_out()))
    return docs.filter(quality.score_column(F.col("text"), model) >= quality.THRESHOLD)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps, of each group of linked documents, the one with the smallest doc_id, null last; documents without words all stay.

    Of rows that share an id and a text one stays, also where the id is null; rows that share an id but are not linked are told
    apart by their texts. An empty table gives an empty result.
    """
    return ngram_join.representatives(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces every secret by a mark; n_chars follows the text. A null text stays null, and an empty table empty."""
    masked = secret_scan.mask(docs)
    return masked.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes each document as often as the mix does; one that it does not take goes. Documents without words stay, once: they use
    none of the budget. Null ids and sources take part; an empty table gives an empty mix."""
    mixed = mixing.mix(docs, carry=True).withColumn("_times", F.when(F.col("size") == 0, 1).otherwise(F.col("copies")).cast("int"))
    copies = mixed.filter("_times > 0").select("_row", F.explode(F.sequence(F.lit(1), F.col("_times"))))
    return copies.select(*(F.col(f"_row.{c}").alias(c) for c in docs.columns))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in sequences of at most 1024 tokens. A null text is empty: one end token."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality classifier", quality_filter),
    ("n-gram Jaccard join", near_duplicates),
    ("secret scans", secrets),
    ("mixing sources to target weights", mix),
    ("best-fit packing", pack),
]

#: SQL cannot express the classifier; tests hold every stage against a brute-force version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over the whole of documents."""
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = saved(docs, f"pipeline-{i}")
    return docs
