import json
import os

import __spark_entry__ as entry
import pytest
from loomwright.operators import chunking
from loomwright.plans import build, cli, config, stages, teachers
from loomwright.sources import files, readers, sinks
from pyspark.sql import functions as F

TEXTS = {"a.txt": "The first document.\r\nIt has two lines. " * 20, "sub/b.txt": "Second é document. " * 30, "c.txt": "Third one, short.", "d.txt": "Fourth. " * 60}


@pytest.fixture
def folder(tmp_path):
    for name, text in TEXTS.items():
        (tmp_path / "raw" / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / "raw" / name).write_bytes(text.encode())
    (tmp_path / "raw" / "x.md").write_text("not read")
    return tmp_path


def made(folder, **sections):
    base = {
        "data": {"input_path": str(folder / "raw"), "chunk_bytes": 64, "overlap_bytes": 8, "eval_fraction": 0.3},
        "input": {}, "output": {"output_dir": str(folder / "out")},
        "stage_a": {"teacher_name": "byte_bigram", "top_k": 3}, "stage_b": {"teacher_name": "byte_bigram", "context_window": 128, "stride": 2, "max_teacher_context": 96, "top_k": 3},
        "stage_c": {"teacher_name": "byte_bigram", "template_name": "extract_key_points"},
    }
    return {k: base[k] | sections.get(k, {}) for k in base}


def test_text_folders(spark, folder):
    got = {r["source_path"]: r["text"] for r in readers.text_folder(spark, str(folder / "raw")).collect()}
    assert got == {k: v.replace("\r\n", "\n") for k, v in TEXTS.items()}


def test_configuration_is_checked(folder):
    config.pipeline(made(folder))
    bad = [
        ("data", {"chunk_bytes": 0}), ("data", {"overlap_bytes": 64}), ("data", {"eval_fraction": 1}), ("data", {"eval_split_strategy": "x"}), ("data", {"replay_stage_a_fraction": -1}),
        ("output", {"format": "csv"}), ("output", {"resume_policy": "x"}), ("output", {"dry_run_max_records": 0}), ("output", {"stop_after_stage": "x"}), ("output", {"output_dir": ""}),
        ("stage_a", {"teacher_name": "x"}), ("stage_a", {"mode": "x"}), ("stage_a", {"enable_position_filtering": True}), ("stage_a", {"enable_position_filtering": True, "selection_mode": "position_mask"}),
        ("stage_a", {"entropy_threshold": float("nan")}), ("stage_a", {"teacher_mixture": [{"teacher_name": "dummy", "ratio": 0}]}), ("stage_a", {"backend_type": "vllm"}),
        ("stage_b", {"window_policy": "x"}), ("stage_b", {"target_region_policy": "x"}), ("stage_c", {"template_name": "x"}),
    ]
    for section, values in bad:
        with pytest.raises(config.ConfigError):
            config.pipeline(made(folder, **{section: values}))
    with pytest.raises(config.ConfigError):
        config.pipeline({"data": {}})
    a, b = config.pipeline(made(folder)), config.pipeline(made(folder, output={"max_records_per_shard": 5}))
    assert config.fingerprints(a)["critical"] == config.fingerprints(b)["critical"] and config.fingerprints(a)["full"] != config.fingerprints(b)["full"]


def test_build_write_read_resume(spark, folder):
    c = config.pipeline(made(folder, output={"max_records_per_shard": 7, "resume": True}))
    first = build.run(spark, c)
    out = c.output.output_dir
    shards = readers.shard_counts(spark, out).collect()
    assert first["output_records"] == sum(r["records"] for r in shards) > 10 and max(r["records"] for r in shards) == 7
    got = readers.records(spark, out)
    assert {r[0] for r in got.select("stage_name").distinct().collect()} == {"stage_a", "stage_b", "stage_c"}
    row = got.filter("stage_name = 'stage_a' and size(top_k_ids) > 0").first()
    assert len(row["top_k_ids"]) == len(row["raw_bytes"]) - 1 and len(row["top_k_ids"][0]) <= 3
    assert json.loads(got.filter("stage_name = 'stage_c'").first()["structured_output"])["task_type"] == "extract_key_points"
    again = build.run(spark, c)
    assert again["output_records"] == 0
    assert sum(r["records"] for r in readers.shard_counts(spark, out).collect()) == first["output_records"]
    manifest = files.read_json(spark, f"{out}/manifest.json")
    assert manifest["record_count"] == first["output_records"] and manifest["stages"] == ["stage_a", "stage_b", "stage_c"]
    report = build.quality_report(spark, got, out)
    assert report["record_count"] == first["output_records"] and files.read_json(spark, f"{out}/{build.METRICS}")["record_count"] == report["record_count"]
    with pytest.raises(ValueError):
        build.run(spark, config.pipeline(made(folder, data={"chunk_bytes": 50}, output={"max_records_per_shard": 7, "resume": True, "resume_policy": "best_effort"})))
    merged = sinks.merge_shards(spark, [out, out], str(folder / "merged"), 10)
    assert sum(r["records"] for r in readers.shard_counts(spark, str(folder / "merged")).collect()) == 2 * first["output_records"] and merged


def test_dry_runs_and_stops(spark, folder):
    c = config.pipeline(made(folder, output={"output_dir": str(folder / "dry"), "dry_run": True, "dry_run_max_records": 4, "stop_after_stage": "stage_a", "format": "parquet"}))
    out = build.run(spark, c)
    assert out["stages"] == ["stage_a"] and out["output_records"] <= 8
    assert spark.read.parquet(f"{folder}/dry/train.parquet").count() <= 4


def test_lines_are_appended_to_the_last_shard(spark, tmp_path):
    rows = lambda a, b: spark.range(a, b).select(F.col("id").alias("k"), F.col("id").cast("string").alias("value"))
    sinks.write_lines(rows(0, 5), str(tmp_path), 3, "x", ("k",))
    sinks.write_lines(rows(5, 9), str(tmp_path), 3, "x", ("k",), append=True)
    got = {n: (tmp_path / n).read_text().split() for n in sorted(os.listdir(tmp_path)) if n.endswith(".jsonl")}
    assert got == {"x-00000.jsonl": ["0", "1", "2"], "x-00001.jsonl": ["3", "4", "5"], "x-00002.jsonl": ["6", "7", "8"]}
    sinks.write_lines(rows(0, 2), str(tmp_path), 3, "x", ("k",))
    assert [n for n in os.listdir(tmp_path) if n.endswith(".jsonl")] == ["x-00000.jsonl"]


def test_broken_records_fail(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"schema_version": "1.0", "doc_id": "d"}\n')
    with pytest.raises(Exception, match="missing fields"):
        readers.wire_records(spark, str(tmp_path)).collect()
    with pytest.raises(FileNotFoundError):
        readers.shard_paths(spark, str(tmp_path / "none.jsonl"))
    assert files.read_json(spark, str(tmp_path / "a.jsonl")) is not None and files.read_json(spark, str(tmp_path / "none")) is None


class Broken(teachers.Dummy):
    def topk(self, data, k=4):
        if any(b"Third" in d for d in data):
            raise ValueError("no")
        return super().topk(data, k)


def test_failures_are_kept_apart(spark, folder):
    docs = readers.text_folder(spark, str(folder / "raw"))
    good, bad = stages.parted(stages.infer(chunking.chunk(docs, 4096, 0), Broken(), "raw_bytes", 4))
    assert good.count() == 3 and bad.first()["error"] == "ValueError: no"
    sinks.write_failures(bad.withColumns({"stage_name": F.lit("stage_a"), "teacher_name": F.lit("dummy")}), str(folder / "f"))
    assert spark.read.json(f"{folder}/f/failures").count() == 1


def test_capabilities_are_required():
    teachers.require("byte_bigram", "long_context", ("per_token_entropy",))
    for name, mode, signals in (("dummy", "topk_logits", ("per_token_entropy",)), ("none", "topk_logits", ()), ("dummy", "x", ())):
        with pytest.raises(ValueError):
            teachers.require(name, mode, signals)
    assert teachers.backend("hf_causal_lm") == "hf" and teachers.create("vllm_causal_lm").check() == "not installed: vllm"
    assert teachers._rows_of([None, {"22": -0.2, "7": -0.5, "x": 1}], 2) == ([[22, 7]], [[-0.2, -0.5]])
    with pytest.raises(ValueError):
        teachers._rows_of([{"the": -0.1}], 2)


def test_caches_and_mixtures(spark, tmp_path):
    for name in ("one", "two"):
        spark.range(40).select("id", F.concat(F.lit(name), "id").alias("text")).write.parquet(f"{tmp_path}/{name}/train")
    source = lambda name, **more: {"source_name": name, "location": f"{tmp_path}/{name}", "text_field": "text", "order_field": "id", "train_split": "train", "eval_split": "train", "group_size": 4} | more
    values = {
        "source_extraction": {"cache_dir": f"{tmp_path}/cache", "datasets": [source("one"), source("two")]},
        "mixture_build": {"target_documents": 6, "depletion_policy": "rebalance", "groups": [{"group_name": "a", "percentage": 50, "dataset_names": ["one"]}, {"group_name": "b", "percentage": 50, "dataset_names": ["two"]}]},
    }
    c = config.corpus(values)
    for s in c.sources:
        assert build.extract(spark, c.cache_dir, s, dry_run=True)["state"] == "missing"
        told = build.extract(spark, c.cache_dir, s)
        assert told["splits"]["train"]["documents"] == 10 and told["reused_upstream_splits"] == {"train": ["eval", "train"]}
        assert build.extract(spark, c.cache_dir, s)["state"] == "ready"
    changed = config.source(source("one", group_size=5))
    with pytest.raises(ValueError):
        build.extract(spark, c.cache_dir, changed)
    assert build.cache_state(spark, c.cache_dir, changed) == "mismatch"
    manifest = build.build_mixture(spark, c, f"{tmp_path}/mix")
    assert {(r["split"], r["documents"]) for r in manifest["composition"] if r["level"] == "split"} == {("train", 6), ("eval", 6)}
    assert readers.cache(spark, c.cache_dir, "two", "train").count() == 10
    with pytest.raises(FileExistsError):
        build.build_mixture(spark, c, f"{tmp_path}/mix")
    with pytest.raises(FileNotFoundError):
        readers.cache(spark, c.cache_dir, "none")
    for bad in ({"group_size": 0}, {"text_field": ""}, {"min_bytes": 5, "max_bytes": 1}, {"train_split": None, "eval_split": None}):
        with pytest.raises(config.ConfigError):
            config.source(source("x", **bad))


def test_command_line(spark, folder, capsys):
    cli.main(["preview-prompt", "summarize_chunk", "hello", "--options", '{"max_words": 3}'])
    assert "at most 3 words" in capsys.readouterr().out
    path = folder / "c.toml"
    path.write_text(config.DEFAULT)
    cli.main(["build", "--config", str(path), "--preflight"])
    assert "fingerprints" in capsys.readouterr().out


@pytest.mark.parametrize("name", sorted(entry.engine.QUERIES))
def test_every_query_runs(spark, sf, name):
    df = entry.engine.QUERIES[name](spark, sf)
    assert df.count() >= 0 and len(set(df.columns)) == len(df.columns)


def test_entry(spark):
    rows = entry.entry(spark).collect()
    assert sum(r["chunks"] for r in rows) == 254


def test_arrays_of_the_byte_teacher_are_its_outputs():
    import numpy as np

    rng = np.random.default_rng(2)
    teacher = teachers.ByteBigram(np.where(rng.random((256, 256)) < 0.03, rng.integers(1, 50, (256, 256)), 0).astype(np.int64).tobytes())
    teacher.open()
    data = [b"", b"a", b"some text", bytes(range(256)), rng.integers(0, 256, 500, dtype=np.uint8).tobytes()]
    for k in (1, 4, 32):
        got = [c.to_pylist() for c in teacher.arrays(data, k)]
        for i, o in enumerate(teacher.topk(data, k)):
            want = [o.ids, o.logprobs, o.entropy, o.per_token_entropy, o.per_token_top1_gap, o.per_token_token_ids, o.per_token_valid_mask, None, o.tokens]
            assert [c[i] for c in got] == want
    assert [len(c) for c in teacher.arrays([], 3)] == [0] * 9


def test_records_are_moved_before_they_are_lines(spark, tmp_path, monkeypatch):
    moved = []
    real = sinks.R.numbered
    monkeypatch.setattr(sinks.R, "numbered", lambda rows, *a: (moved.append(rows.columns), real(rows, *a))[1])
    rows = spark.range(25).select(F.concat(F.lit("d"), F.col("id") % 3).alias("doc_id"), F.col("id").cast("int").alias("chunk_index"), F.lit(0).cast("long").alias("byte_start"), F.lit(4).cast("long").alias("byte_end"),
        F.encode(F.col("id").cast("string"), "UTF-8").alias("raw_bytes"), F.lit("train").alias("split"), F.lit("s").alias("stage_name"), F.lit("t").alias("teacher_name"), F.lit("m").alias("mode"), F.array(F.lit(0.5)).alias("per_token_entropy"))
    told = sinks.write_records(rows.unionByName(rows.limit(2)), str(tmp_path), "train", size=10)
    assert told == {"split": "train", "records": 25, "skipped": 2} and moved and all("value" not in c and "raw_bytes" in c for c in moved)
    got = [json.loads(x) for n in sorted(os.listdir(tmp_path)) if n.endswith(".jsonl") for x in (tmp_path / n).read_text().splitlines()]
    assert [(r["doc_id"], r["chunk_index"]) for r in got] == sorted((f"d{i % 3}", i) for i in range(25)) and got[0]["per_token_entropy"]
    assert sinks.write_records(rows, str(tmp_path), "train", size=10, append=True)["records"] == 0


def test_only_the_lists_that_are_used_leave_python(spark):
    docs = spark.createDataFrame([("a", "the first text, twice the same " * 9), ("b", ""), ("c", "x"), ("d", "é and the rest"), ("e", None)], "doc_id string, text string")
    teacher, rows = teachers.train_bigram(docs), chunking.chunk(docs, 64, 8)
    whole = {(r["doc_id"], r["chunk_index"]): r for r in stages.infer(rows, teacher, "raw_bytes", 4).collect()}
    part = stages.infer(rows, teacher, "raw_bytes", 4, ("per_token_top1_gap", "top_k_ids")).collect()
    assert len(part) == len(whole) > 3
    for r in part:
        w = whole[(r["doc_id"], r["chunk_index"])]
        assert all(r[c] == w[c] for c in ("per_token_top1_gap", "top_k_ids", "entropy", "teacher_input_token_length", "error"))
        assert all(r[c] is None for c in ("top_k_logprobs", "per_token_entropy", "per_token_token_ids", "per_token_valid_mask"))
    # a teacher without arrays, too
    d = stages.infer(rows, teachers.create("dummy"), "raw_bytes", 4, ("top_k_ids",)).first()
    assert d["top_k_ids"] == [[0, 1, 2, 3]] and d["top_k_logprobs"] is None and d["entropy"] is not None


def test_bigrams_are_counted_within_each_text(spark):
    texts = ["", "ab", "a", "", "abcab", "bc" * 40, ""]
    want = {}
    for t in texts:
        for p in zip(t.encode(), t.encode()[1:], strict=False):
            want[p] = want.get(p, 0) + 1
    docs = spark.createDataFrame([(t,) for t in texts], "text string").coalesce(1)
    assert {(r["before"], r["next"]): r["n"] for r in teachers.bigram_counts(docs).collect()} == want
