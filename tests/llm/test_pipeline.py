import re
from collections import Counter

import corpus_pipeline as P
import public_tokenizers
from loomwright.llm import mixing, quality
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from . import brute


def test_stages_are_named_in_order():
    assert [f.__name__ for _, f in P.STAGES] == ["quality_filter", "near_duplicates", "secrets", "mix", "pack"]


def test_quality_keeps_what_the_classifier_accepts(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet").withColumn("_score", F.lit("mine"))
    got = P.quality_filter(spark, docs, sf)
    assert got.columns == docs.columns
    kept = {r["doc_id"] for r in got.collect()}
    model = quality.train(docs, spark.read.parquet(f"{sf}/labels.parquet").filter(~quality.held_out()))
    scores = dict(zip((rows := docs.orderBy("doc_id").collect()) and [r["doc_id"] for r in rows], model.score([r["text"].encode() for r in rows]), strict=True))
    # batches may differ in the last bits
    assert {i for i, s in scores.items() if s >= 0.7 + 1e-4} <= kept <= {i for i, s in scores.items() if s >= 0.7 - 1e-4}
    labels = spark.read.parquet(f"{sf}/labels.parquet").filter("quality = 1").collect()
    assert sum(r["doc_id"] in kept for r in labels) > 0.97 * len(labels)


def test_one_document_of_each_group_stays(spark):
    docs = brute.frame(spark)
    got = P.near_duplicates(spark, docs, "")
    assert got.columns == docs.columns
    rows = got.collect()
    assert Counter(r["doc_id"] for r in rows) == Counter([1, 2, 3, 4, 5, None, 9, 10, 11, 12, 14, 15])
    assert all(r["_n"] == 8 and r["n"] == 7 for r in rows)
    whole = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    least = {g for _, _, g in brute.groups([(r["doc_id"], r["text"]) for r in whole.collect()])}
    assert {r["doc_id"] for r in P.near_duplicates(spark, whole, "").collect()} == least


def test_rows_with_one_id_or_none_are_told_apart_by_text(spark):
    long = " ".join(f"w{i}" for i in range(60))
    rows = [(3, long), (7, f"{long} more"), (7, "quite another text of six words"), (None, "copy without an id at all"), (None, "copy without an id at all"), (None, None), (None, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = Counter((r["doc_id"], r["text"]) for r in P.near_duplicates(spark, docs, "").collect())
    assert got == Counter([rows[0], rows[2], rows[3], rows[5], rows[6]])


def test_secrets_are_masked_and_lengths_follow(spark):
    docs = brute.frame(spark)
    got = P.secrets(spark, docs, "")
    assert got.columns == docs.columns and dict(got.dtypes) == dict(docs.dtypes)
    for r in got.collect():
        assert r["n_chars"] == (None if r["text"] is None else len(r["text"]))
        assert not re.search(r"[0-9a-f]{24}|AKIA[A-Z0-9]{16}", r["text"] or "") and r["_text"] == "clash"
    whole = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    before = {r["doc_id"]: r["text"] for r in whole.collect()}
    changed = 0
    for r in P.secrets(spark, whole, "").collect():
        secret = re.search(r"token = \"[0-9a-f]{40}|[0-9a-f]{24}", before[r["doc_id"]])
        assert (r["text"] != before[r["doc_id"]]) == bool(secret)
        changed += bool(secret)
    assert changed


def test_copies_are_those_of_the_mix(spark):
    docs = brute.frame(spark)
    got = P.mix(spark, docs, "")
    assert got.columns == docs.columns
    want = Counter()
    for r in mixing.mix(docs).collect():
        want[r["doc_id"]] += r["copies"] if r["size"] else 1
    assert Counter(r["doc_id"] for r in got.collect()) == +want


def test_every_token_is_packed(spark):
    docs = brute.frame(spark)
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    got = P.pack(spark, docs, "").agg(F.sum("length")).first()[0]
    assert got == sum(len(tok.encode(t or "", add_special_tokens=False).ids) + 1 for _, t, *_ in brute.AWKWARD)


def test_the_whole_pipeline(spark, sf):
    rows = P.run(spark, sf).collect()
    assert rows
    by = {}
    for r in rows:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for own in by.values():
        at = 0
        for offset, n in sorted(own):
            assert offset == at
            at += n
        assert at <= 1024


def test_stages_of_an_empty_table(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(0)
    for _, stage in P.STAGES:
        assert stage(spark, docs, sf).count() == 0
