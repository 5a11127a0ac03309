import json
import os

import pytest
from loomwright.operators import metrics
from loomwright.plans import build, cli, config, teachers
from loomwright.sources import files, readers
from pyspark.sql import functions as F
from tests.test_build import folder, made  # noqa: F401

BPE = "/opt/tokenizers/byte_bpe_50k.json"


class Unwell(teachers.Dummy):
    def check(self):
        return "out of order"


class Summaries(teachers.Dummy):
    def topk(self, data, k=4):
        return [teachers.Output(o.ids, o.logprobs, o.entropy, hidden_summary=[0.5, 1.0]) for o in super().topk(data, k)]


teachers.register("unwell", teachers.Capabilities(), "none")(Unwell)
teachers.register("summaries", teachers.Capabilities(hidden_summary=True), "none")(Summaries)


def test_summary_of_a_run(spark, folder):  # noqa: F811
    c = config.pipeline(made(folder, stage_b={"enabled": False}, stage_c={"enabled": False}, data={"replay_stage_a_fraction": 1.0}))
    out = build.run(spark, c)
    assert out["doc_count"] == 4 and out["chunk_count"] > 10 and out["train_count"] + out["eval_count"] == out["output_records"] > 0
    assert out["stage_a_teachers"] == ["byte_bigram"] and out["stage_b_teachers"] == [] and out["train_stage_fractions"]["stage_a"] == 1.0
    t = out["timing"]
    assert t["teacher_inference_seconds"] == t["stage_a_seconds"] > 0 and t["stage_b_seconds"] == 0.0
    assert t["total_runtime_seconds"] == pytest.approx(sum(t[f"{p}_seconds"] for p in ("ingestion", "chunking", "splitting", "stage_a", "writing")))
    assert out["teacher_startup_checks"] == [{"stage_name": "stage_a", "teacher_name": "byte_bigram", "mode": "topk_logits", "top_k": 3, "result": {"backend": "builtin", "ok": True}}]
    assert out["stage_metrics"][0]["failures"] == out["skipped_records"] == 0 and build.stage_lines(out["stage_metrics"])[0].startswith("stage_a: ")
    report = files.read_json(spark, f"{c.output.output_dir}/{build.METRICS}")
    assert report["record_count"] == out["output_records"] and {r["stage_name"] for r in report["per_stage"]} == {"stage_a"}


def test_every_member_of_a_mixture_is_checked(spark, folder):  # noqa: F811
    mixture = [{"teacher_name": "dummy", "ratio": 3}, {"teacher_name": "unwell", "ratio": 1}]
    with pytest.raises(RuntimeError, match="stage_a: unwell .*out of order"):
        build.run(spark, config.pipeline(made(folder, stage_a={"teacher_mixture": mixture})))
    assert not os.path.exists(f"{folder}/out/stages")
    build.run(spark, config.pipeline(made(folder, output={"dry_run": True}, stage_a={"teacher_mixture": mixture})))


def test_settings_are_used_or_refused(spark, folder):  # noqa: F811
    for section, values in (("stage_a", {"extract_hidden_summary": True}), ("input", {"preserve_document_boundaries": False}), ("output", {"compression": "x"})):
        with pytest.raises(config.ConfigError):
            config.pipeline(made(folder, **{section: values}))
    off = {"stage_b": {"enabled": False}, "stage_c": {"enabled": False}}
    for asked in (False, True):
        out = {"output_dir": f"{folder}/h{asked}", "format": "parquet", "compression": "zstd"}
        build.run(spark, config.pipeline(made(folder, output=out, stage_a={"teacher_name": "summaries", "extract_hidden_summary": asked}, **off)))
        got = spark.read.parquet(f"{folder}/h{asked}/train.parquet").select("hidden_summary").distinct().collect()
        assert [r[0] for r in got] == [[0.5, 1.0] if asked else None]
    assert any(".zstd." in n for n in os.listdir(f"{folder}/hTrue/train.parquet"))
    c = config.pipeline(made(folder, stage_a={"teacher_name": "llamacpp_server", "temperature": 0.3, "teacher_settings": {"max_tokens": 4}}))
    assert build.members(c.stage_a) == [("llamacpp_server", {"temperature": 0.3, "max_tokens": 4})]


def test_snapshots_are_read(spark, tmp_path):
    rows = spark.range(12).select("id", F.concat(F.lit("text "), "id").alias("text"))
    for name, part in (("en/train-00000-of-00002", "id < 5"), ("en/train-00001-of-00002", "id >= 5"), ("en/test-00000-of-00001", "id = 0"), ("data/train-00000-of-00001", "id < 2")):
        rows.filter(part).toPandas().to_parquet((tmp_path / name).parent.mkdir(exist_ok=True) or tmp_path / f"{name}.parquet")
    read = lambda **k: readers.upstream(spark, str(tmp_path), "huggingface", **k).count()
    assert (read(config="en", split="train"), read(config="en", split="test"), read(split="train"), read(config="en")) == (12, 1, 2, 13)
    values = {"source_name": "s", "source_type": "huggingface", "hf_dataset": str(tmp_path), "hf_config": "en", "text_field": "text", "order_field": "id", "train_split": "train"}
    assert build.extract(spark, f"{tmp_path}/cache", config.source(values))["splits"]["train"]["documents"] == 12
    with pytest.raises(RuntimeError, match="source s, split none"):
        build.extract(spark, f"{tmp_path}/cache2", config.source(values | {"train_split": "none"}))


def test_parity_of_records(spark):
    kinds = "doc_id string, top_k_ids array<array<long>>, top_k_logprobs array<array<double>>, entropy double, per_token_entropy array<double>, per_token_top1_gap array<double>, teacher_input_token_length long"
    good = ("a", [[1, 2], [3, 4]], [[-0.1, -0.2], [-0.1, -0.3]], 0.5, [0.5, 0.9], [0.1, 0.2], 3)
    table = lambda *rows: spark.createDataFrame(list(rows), kinds)
    told = lambda a, b, *p, **k: {r["check"]: r["verdict"] for r in metrics.parity(a, b, *p, **k).collect()}
    same = told(table(good, good), table(good, good), "position_mask", entropy=0.6)
    assert set(same.values()) == {"PASS", "INFO"} and len(same) == 17
    short = good[:4] + ([0.5], None, None)
    got = told(table(good, good), table(good, short), "selected_windows", entropy=5.0)
    assert {k: v for k, v in got.items() if v not in ("PASS", "INFO")} == {"per_token_entropy_plausible": "FAIL", "per_token_top1_gap_present": "WARN", "selectable": "WARN"}
    assert told(table(good), table(good, good))["records"] == "FAIL" and told(table(good), table(("a", None, None, 0.1, None, None, None)))["with_topk"] == "WARN"
    empty = told(table(), table())
    assert set(empty.values()) == {"PASS", "INFO"}


def test_commands_over_records(spark, folder, capsys):  # noqa: F811
    c = made(folder, stage_a={"enable_position_filtering": True, "selection_mode": "position_mask", "entropy_threshold": 0.5})
    lines = []
    for name, values in c.items():
        lines += [f"[{name}]", *(f"{k} = {json.dumps(v)}" for k, v in values.items())]
    path = folder / "c.toml"
    path.write_text("\n".join(lines))
    cli.main(["try-stage-a", "--config", str(path), "--chunks", "5"])
    told = json.loads(capsys.readouterr().out)
    assert told["teacher"] == "byte_bigram" and told["records"] == 5 and told["failed"] == 0 and told["selection"]["selected_positions"] > 0
    cli.main(["build", "--config", str(path)])
    assert "stage_b: " in capsys.readouterr().out
    out = str(folder / "out")
    cli.main(["inspect", out, "--samples", "2", "--sample-out", str(folder / "s.txt")])
    told = json.loads(capsys.readouterr().out)
    assert "entropy" in told["observed_fields"] and "hidden_summary" not in told["observed_fields"]
    assert (folder / "s.txt").read_text().count("doc_id: ") == 2
    cli.main(["parity", out, out])
    assert capsys.readouterr().out.strip().endswith(("PASS", "WARN", "FAIL"))
    cli.main(["build", "--merge-inputs", out, out, "--merge-output", str(folder / "m"), "--max-records-per-shard", "9"])
    capsys.readouterr()
    assert max(r["records"] for r in readers.shard_counts(spark, str(folder / "m")).collect()) == 9
    docs = str(folder / "docs")
    readers.text_folder(spark, str(folder / "raw")).write.parquet(docs)
    for more in ([], ["--tokenizer", BPE]) if os.path.exists(BPE) else ([],):
        cli.main(["token-cost", docs, *more])
        told = json.loads(capsys.readouterr().out)
        assert told["inputs"] == 4 and (told["bytes_per_token"] > 1.5 if more else told["bytes_per_token"] == 1)
