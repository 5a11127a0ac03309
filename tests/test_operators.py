import pytest
from loomwright.functions import completions, lineage
from loomwright.operators import chunking, corpus, metrics, records, sampling, splits
from pyspark.sql import functions as F


def docs(spark, *texts):
    return spark.createDataFrame([(f"d{i}", t) for i, t in enumerate(texts)], "doc_id string, text string")


# chunks


def test_chunks_of_a_text(spark):
    got = chunking.chunk(docs(spark, "abcdefghij", "", None), 4, 1).orderBy("chunk_index").collect()
    assert [bytes(r["raw_bytes"]).decode() for r in got] == ["abcd", "defg", "ghij", "j"]
    assert [(r["byte_start"], r["byte_end"]) for r in got] == [(0, 4), (3, 7), (6, 10), (9, 10)]
    assert [r["prev_chunk_index"] for r in got] == [None, 0, 1, 2] and [r["next_chunk_index"] for r in got] == [1, 2, 3, None]
    for size, overlap in ((0, 0), (4, 4), (4, -1)):
        with pytest.raises(ValueError):
            chunking.chunk(docs(spark, "a"), size, overlap)


def test_chunks_cut_bytes_and_reassemble(spark):
    texts = ["é" * 7, "x" * 50, "日本語" * 9]
    c = chunking.chunk(docs(spark, *texts), 5, 2)
    whole = {r["doc_id"]: bytes(r["data"]).decode() for r in chunking.reassemble(c).collect()}
    assert whole == {f"d{i}": t for i, t in enumerate(texts)}
    gaps = c.filter("doc_id = 'd1' and chunk_index not in (2, 3, 4)")
    data = bytes(chunking.reassemble(gaps).first()["data"])
    assert len(data) == 50 and data.count(0) == sum(not any(s <= i < s + 5 for s in range(0, 50, 3) if s // 3 not in (2, 3, 4)) for i in range(50))
    assert [r["text"] for r in chunking.text_chunks(docs(spark, "éa"), 1).orderBy("chunk_index").collect()] == ["", "", "a"]


def test_windows_by_looking_at_neighbours(spark):
    got = chunking.chunk(docs(spark, "abcdefghijklmnop"), 4, 0, context=8, stride=1).filter("chunk_index = 1").first()
    assert bytes(got["window_raw_bytes"]) == b"cdefghij" and (got["target_start_in_window"], got["target_end_in_window"]) == (2, 6)
    for size, overlap, context, stride in ((4, 1, 9, 2), (5, 0, 3, 1), (3, 2, 100, 4), (4, 0, 8, 0)):
        text = "abcdefghijklmnopqrstuvwxyz"
        c = chunking.chunk(docs(spark, text), size, overlap, context=context, stride=stride).orderBy("chunk_index").collect()
        for r in c:
            k = r["chunk_index"]
            near = [x for x in c if abs(x["chunk_index"] - k) <= stride]
            low, high = near[0]["byte_start"], max(x["byte_end"] for x in near)
            a, b = r["window_byte_start"], r["window_byte_end"]
            assert low <= a <= r["byte_start"] and r["byte_end"] <= b <= high
            assert (a, b) == (low, high) if high - low <= context else b - a == max(context, r["byte_end"] - r["byte_start"])
            assert bytes(r["window_raw_bytes"]).decode() == text[a:b]


@pytest.mark.parametrize(("policy", "want"), [("left_biased", (2, 6)), ("right_biased", (0, 4)), ("center_target", (1, 5)), ("other", (1, 5))])
def test_truncation_policies(spark, policy, want):
    w = chunking.chunk(docs(spark, "abcdefghijklmnopqrst"), 4, 0, context=20, stride=2).filter("chunk_index = 2")
    got = chunking.truncate(w, 6, policy).first()
    assert (got["target_start"], got["target_end"]) == want and len(got["teacher_input_bytes"]) == 6
    assert bytes(got["teacher_input_bytes"])[want[0] : want[1]] == b"ijkl"


def test_truncation_of_long_targets(spark):
    w = chunking.chunk(docs(spark, "abcdefghij"), 10, 0, context=10, stride=0)
    for policy, n in (("preserve_full", 10), ("truncate_if_needed", 6)):
        got = chunking.truncate(w, 6, "right_biased", policy).first()
        assert (got["target_start"], got["target_end"], got["context_truncation"]["final_bytes"]) == (0, n, n)
    whole = chunking.truncate(w, 100).first()
    assert not whole["context_truncation"]["truncated"] and whole["context_truncation"]["window_start"] is None


# splits, samples


def test_splits_keep_documents_whole(spark):
    rows = chunking.chunk(docs(spark, *("x" * (20 + 7 * i) for i in range(40))), 8, 0)
    for made in (splits.by_hash(rows, 0.3), splits.by_rank(rows, 0.25, 1), splits.with_long_documents(rows, 0.25, 1, 100, 0.2), splits.with_long_documents(rows, 0.25, 1, 100, 0.2, "random_docs")):
        assert made.count() == rows.count()
        assert made.groupBy("doc_id").agg(F.countDistinct("split").alias("n")).filter("n > 1").count() == 0
    ranked = splits.by_rank(rows, 0.25, 1)
    assert ranked.filter("split = 'eval'").select("doc_id").distinct().count() == 10
    long = splits.with_long_documents(rows, 0.25, 1, 100, 0.2)
    picked = long.filter("split = 'eval_longdoc'").groupBy("doc_id").agg(F.max("byte_end").alias("n")).collect()
    rest = long.filter("split = 'train'").groupBy("doc_id").agg(F.max("byte_end").alias("n")).collect()
    assert len(picked) == 8 and min(r["n"] for r in picked) >= max(100, *(r["n"] for r in rest))
    a, b = splits.train_and_validation(rows, 0.75, 1)
    assert a.count() + b.count() == rows.count()
    for bad in (0, 1, -1):
        with pytest.raises(ValueError):
            splits.by_hash(rows, bad)
    with pytest.raises(ValueError):
        splits.with_long_documents(rows, 0.1, 1, 1, 0.1, "none")


def test_large_draws_are_those_of_a_sort(spark, monkeypatch):
    df = spark.range(3000).select(F.col("id").cast("string").alias("doc_id"), F.lit(0).alias("chunk_index"), F.lit(0).alias("byte_start"))
    small = {r["doc_id"] for r in sampling.subsample(df, 700, 9).collect()}
    monkeypatch.setattr(sampling, "SMALL", 10)
    assert {r["doc_id"] for r in sampling.subsample(df, 700, 9).collect()} == small and len(small) == 700
    assert sampling.subsample(df, 5000, 9).count() == 3000 and sampling.subsample(df, 0, 9).count() == 0
    got = sampling.subsample_within(df.withColumn("g", F.col("doc_id").cast("int") % 3), ["g"], {(0,): 5, (1,): 1000, (2,): 0}, 1).groupBy("g").count().collect()
    assert dict(map(tuple, got)) == {0: 5, 1: 1000}


def test_ratio_merge_takes_small_inputs_whole(spark):
    make = lambda n, x: spark.range(n).select(F.concat(F.lit(x), "id").alias("doc_id"), F.lit(0).alias("chunk_index"), F.lit(0).alias("byte_start"))
    got = sampling.merge_by_ratio([(make(30, "a"), 1.0), (make(5, "b"), 1.0)], 1)
    assert dict(map(tuple, got.groupBy(F.substring("doc_id", 1, 1)).count().collect())) == {"a": 17, "b": 5}
    with pytest.raises(ValueError):
        sampling.merge_by_ratio([(make(1, "a"), 0.0)], 1)


# corpora


def test_groups_of_rows(spark):
    rows = spark.createDataFrame([("s", i, t) for i, t in enumerate(["a", "bb", "ccc", "dddd", "ee", "fff", None, "gg"])], "source string, i int, t string")
    got = corpus.group_rows(rows, ["source"], ["i"], "t", 2, 2, 3).orderBy("doc_id").collect()
    assert [(r["doc_id"], r["text"], r["first_row"], r["last_row"]) for r in got] == [("doc_00000001", "bb\n\nccc\n", 0, 1), ("doc_00000002", "ee\n\nfff\n", 2, 3)]
    assert corpus.group_rows(rows, ["source"], ["i"], "t", 2, 2, 3, 1).count() == 1
    counts = corpus.count_rows(rows, ["source"], "t", 2, 2, 3).first()
    assert (counts["rows_seen"], counts["rows_below_min_bytes"], counts["rows_above_max_bytes"], counts["documents"]) == (8, 2, 1, 2)
    assert corpus.group_rows(rows.limit(0), ["source"], ["i"], "t", 2).count() == 0


def pool(spark, **sizes):
    return spark.createDataFrame([(s, k, f"doc_{i:08d}", f"{k} {i}") for k, n in sizes.items() for s in corpus.SPLITS for i in range(n)], "split string, source_name string, doc_id string, text string")


def test_mixture_policies(spark):
    groups = [corpus.Group("code", 50, ("c",)), corpus.Group("general", 50, ("g",))]
    count = lambda m: dict(map(tuple, m.groupBy("group_name").count().collect()))
    assert count(corpus.mix(pool(spark, c=9, g=9), groups, 6, 123)) == {"code": 9, "general": 9}
    assert count(corpus.mix(pool(spark, c=2, g=10), groups, 6, 123, "rebalance")) == {"code": 6, "general": 12}
    assert corpus.mix(pool(spark, c=2, g=2), groups, 6, 123, "rebalance").count() == 12
    assert count(corpus.mix(pool(spark, c=2, g=10), groups, 6, 123, "record_only")) == {"code": 6, "general": 9}
    with pytest.raises(corpus.Shortfall):
        corpus.mix(pool(spark, c=2, g=10), groups, 6, 123, "strict")
    once = [tuple(r) for r in corpus.mix(pool(spark, c=9, g=9), groups, 6, 1).orderBy("split", "output_ordinal").select("split", "source_name", "doc_id").collect()]
    assert once == [tuple(r) for r in corpus.mix(pool(spark, c=9, g=9).repartition(5), groups, 6, 1).orderBy("split", "output_ordinal").select("split", "source_name", "doc_id").collect()]


# records


def record(spark, rows):
    return spark.createDataFrame(rows, "doc_id string, chunk_index int, byte_start long, byte_end long, stage_name string, teacher_name string, mode string, n int")


def test_first_of_each_identity_stays(spark):
    rows = [("a", 0, 0, 4, "s", "t", "m", 2), ("a", 0, 0, 4, "s", "t", "m", 1), ("a", None, 0, 4, "s", "t", "m", 3), ("a", None, 0, 5, "s", "t", "m", 4), ("a", 0, 0, 4, "s", None, "m", 5)]
    got = records.first_seen(record(spark, rows), ("n",))
    assert sorted(r["n"] for r in got.collect()) == [1, 3, 4, 5]
    assert records.new_only(record(spark, rows), record(spark, rows[:1])).count() == 3


def test_shards_are_exact(spark):
    rows = record(spark, [(f"d{i:03d}", 0, 0, 1, "s", "t", "m", i) for i in range(25)]).repartition(7)
    got = records.sharded(rows, 10, ("n",)).groupBy("shard_id").agg(F.count("*"), F.min("n"), F.max("n")).orderBy("shard_id").collect()
    assert [tuple(r) for r in got] == [(0, 10, 0, 9), (1, 10, 10, 19), (2, 5, 20, 24)]
    assert records.sharded(rows, 10, ("n",), 7).filter("shard_id = 0").count() == 3


def test_selected_windows_and_masks(spark):
    row = [([[i * 2 + 1, i * 2 + 2] for i in range(5)], [0.1, 0.9, 0.2, 0.8, 0.1], [0.5] * 5)]
    df = spark.createDataFrame(row, "top_k_ids array<array<int>>, per_token_entropy array<double>, per_token_top1_gap array<double>")
    got = records.apply_policy(df, "selected_windows", 0.75).orderBy("selected_window_start").collect()
    assert [r["top_k_ids"] for r in got] == [[[3, 4]], [[7, 8]]] and [r["selected_window_start"] for r in got] == [1, 3]
    masked = records.apply_policy(df, "position_mask", 0.75).first()
    assert masked["selected_positions"] == [1, 3] and masked["top_k_ids"] == row[0][0]
    assert records.apply_policy(df, "selected_windows", 5.0).count() == 0
    assert records.apply_policy(df, "none").columns == df.columns == records.apply_policy(df, "unknown").columns
    with pytest.raises(ValueError):
        records.apply_policy(df, "position_mask")


# metrics


def test_histogram_edges(spark):
    make = lambda vs: spark.createDataFrame([(v,) for v in vs], "v double")
    got = metrics.histogram(make([0.0, 1.0, 2.0, 4.0, None]), "v", 4).orderBy("bin").collect()
    assert [(r["bin_start"], r["bin_end"], r["count"]) for r in got] == [(0, 1, 1), (1, 2, 1), (2, 3, 1), (3, 4, 1)]
    assert [tuple(r) for r in metrics.histogram(make([2.0, 2.0]), "v", 4).collect()] == [(0, 2.0, 2.0, 2)]
    assert metrics.histogram(make([None]), "v").count() == 0


def test_comparison_of_datasets(spark):
    r = record(spark, [("a", 0, 0, 4, "s", "t", "m", 1), ("b", 0, 0, 6, "s2", None, "m", 1)]).withColumn("entropy", F.lit(0.5))
    assert metrics.compare(r, r).filter("differs").count() == 0
    facts = {x["fact"] for x in metrics.compare(r, r.limit(1)).filter("differs").collect()}
    assert {"records", "avg_chunk_length", "stage_name:s2", "teacher_name:missing"} <= facts


def test_ordinals_are_written_and_stay(spark):
    rows = spark.range(5_000).select(F.md5(F.col("id").cast("string")).alias("k"), "id")
    got = records.numbered(rows, ["k", "id"])
    want = sorted((r["k"], r["id"]) for r in rows.collect())
    for df in (got, got.repartition(7), got.filter("ordinal >= 0")):  # each reads the written places again
        assert [(r["k"], r["id"]) for r in df.orderBy("ordinal").collect()] == want
    assert [r["ordinal"] for r in got.orderBy("ordinal").collect()] == list(range(5_000))
    assert records.numbered(rows.limit(0), ["k"]).count() == 0


def test_draws_go_on_to_the_digits_that_matter(spark, monkeypatch):
    monkeypatch.setattr(sampling, "SMALL", 2)
    monkeypatch.setattr(sampling, "DIGITS", 1)
    rows = spark.range(3_000).select("id", (F.col("id") % 3).alias("g"), F.sha2(F.col("id").cast("string"), 256).alias("h"))
    got = sampling.lowest_within(rows, ["g"], {(0,): 10, (1,): 999, (2,): 5_000}, F.col("h"), ["id"])
    all_ = [(r["g"], r["h"], r["id"]) for r in rows.collect()]
    want = [x for g, n in ((0, 10), (1, 999), (2, 5_000)) for x in sorted(a for a in all_ if a[0] == g)[:n]]
    assert sorted((r["g"], r["h"], r["id"]) for r in got.collect()) == sorted(want)
    assert sampling.lowest_within(rows, ["g"], {}, F.col("h"), ["id"]).count() == 0


def test_shared_folder_is_never_a_local_one_on_a_cluster(spark):
    from types import SimpleNamespace

    far = SimpleNamespace(sparkContext=SimpleNamespace(master="spark://x", getCheckpointDir=lambda: None, applicationId="a"), conf=SimpleNamespace(get=lambda *_: None))
    with pytest.raises(RuntimeError):
        lineage.shared_dir(far)


def test_text_chunks_leave_out_cut_characters(spark):
    texts = ["", "a", "é", "€€€", "a😀b€cé" * 7, "� x �", "日本語テキスト"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    for size, overlap in ((1, 0), (2, 1), (3, 0), (5, 2), (64, 8)):
        got = {(r[0], r[1]): r[2] for r in chunking.text_chunks(docs, size, overlap).collect()}
        for i, t in enumerate(texts):
            data = t.encode()
            starts = range(0, len(data), size - overlap)
            assert [got[i, k] for k in range(len(starts))] == [data[s : s + size].decode("utf-8", "ignore") for s in starts]


def test_completion_bodies(spark):
    bodies = [
        (1, '{"choices":[{"logprobs":{"prompt_token_ids":[11,22,33],"top_logprobs":[null,{"22":-0.2,"7":-0.5},{"33":-0.3,"9":-0.6}]}}],"n_tokens":3}'),
        (2, '{"choices":[{"logprobs":{"top_logprobs":[{"the":-0.1}]}}],"tokens":[1,2]}'),
        (3, "[5,6,7,8]"),
        (4, '{"choices":[{"logprobs":{"top_logprobs":[{"1":-2.0,"2":-1.0,"3":-3.0}]}}],"count":9}'),
    ]
    body = F.col("body")
    rows = spark.createDataFrame(bodies, "id int, body string").select("id", completions.token_count(body), completions.prompt_tokens(body), completions.top_rows(body, 2)).orderBy("id").collect()
    assert [(r[1], r[2]) for r in rows] == [(3, [11, 22, 33]), (2, None), (4, None), (9, None)]
    assert [r[3] and [[p["id"] for p in row] for row in r[3]] for r in rows] == [[[22, 7], [33, 9]], None, None, [[2, 1]]]


def test_a_source_is_not_joined_in_one_task(spark):
    rows = spark.range(40).select(F.lit("only").alias("source"), "id", F.col("id").cast("string").alias("text"))
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = corpus.group_rows(rows, ["source"], ["id"], "text", 4)
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
        assert sorted((r["doc_id"], r["text"]) for r in got.collect())[1] == ("doc_00000002", "4\n\n5\n\n6\n\n7\n") and got.count() == 10
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_a_draw_of_documents_moves_no_rows(spark):
    rows = spark.range(200).select((F.col("id") % 50).cast("string").alias("doc_id"), F.lit("x").alias("raw")).unionByName(spark.sql("select cast(null as string) doc_id, 'x' raw"))
    for fraction, seed in ((0.3, 1), (0.02, 5), (0.001, 2), (0.999, 3)):
        got = splits.by_rank(rows, fraction, seed)
        assert "Join" not in got._jdf.queryExecution().optimizedPlan().toString()
        ids = rows.select("doc_id").distinct()
        want = {r["doc_id"] for r in sampling.subsample(ids, round(51 * fraction), seed, ("doc_id",)).collect()} - {None}
        assert {r["doc_id"] for r in got.filter("split = 'eval'").collect()} == want and got.count() == 201


def test_signatures_tell_what_is_new_without_moving_records(spark):
    r = record(spark, [(d, k, 0, 4, "s", "t", "m", 1) for d in "ab" for k in range(3)])
    assert records.repeated(r.unionByName(r.limit(1))) and not records.repeated(r)
    for existing, n in ((r, 0), (r.filter("doc_id = 'z'"), 6)):
        got = records.new_only(r, existing)
        assert got.count() == n and "Join" not in got._jdf.queryExecution().optimizedPlan().toString()
    assert {x["doc_id"] for x in records.new_only(r, r.filter("doc_id = 'a'")).collect()} == {"b"}
