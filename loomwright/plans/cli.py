"""Command line: python -m loomwright.plans.cli COMMAND ..."""

from __future__ import annotations

import argparse
import json
import sys
import time

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from ..functions import positions, prompts
from ..functions.lineage import saved
from ..functions.text import preview
from ..operators import chunking, corpus, metrics, records, sampling
from ..sources import files, readers, sinks
from . import build, config, stages, teachers


def session() -> SparkSession:
    return SparkSession.builder.appName("loomwright").config("spark.sql.session.timeZone", "UTC").getOrCreate()


def show(value) -> None:
    print(json.dumps(value, indent=2, sort_keys=True, default=str, ensure_ascii=False))


def rows(df, limit: int = 1000) -> list[dict]:
    return [r.asDict(recursive=True) for r in df.limit(limit).collect()]


def cmd_build(a) -> None:
    """Build teacher records, or merge tables of them by ratio."""
    spark = session()
    if a.merge_inputs:
        parts = [readers.wire_records(spark, p) for p in a.merge_inputs]
        ratios = a.merge_ratios or [1.0] * len(parts)
        if len(ratios) != len(parts):
            raise SystemExit("--merge-ratios needs as many numbers as there are inputs")
        merged = sampling.merge_by_ratio(list(zip(parts, ratios, strict=True)), a.seed) if a.merge_ratios else sampling.concat(parts)
        # wire records go back as they are
        lines = merged.select(F.to_json(F.struct("*")).alias("value"), "doc_id", "chunk_index", "byte_start")
        show({"files": sinks.write_lines(lines, a.merge_output, a.max_records_per_shard, "merged", ("doc_id", "chunk_index", "byte_start"))})
        return
    c = config.load_pipeline(a.config)
    if a.preflight:
        show({"config": a.config, "fingerprints": config.fingerprints(c), "stages": [s for s in ("stage_a", "stage_b", "stage_c") if getattr(c, s).enabled]})
        return
    out = build.run(spark, c)
    print("\n".join([*build.timing_lines(out["seconds"]), *build.stage_lines(out["stage_metrics"])]))
    show(out)


def cmd_extract(a) -> None:
    """Fill the cache of one source."""
    c = config.load_corpus(a.config)
    source = next((s for s in c.sources if s.source_name == a.source), None)
    if source is None:
        raise SystemExit(f"no source {a.source}; there are {', '.join(s.source_name for s in c.sources)}")
    show(build.extract(session(), c.cache_dir, source, a.refresh, a.dry_run))


def cmd_mix(a) -> None:
    """Mix cached sources into a corpus."""
    c = config.load_corpus(a.config)
    if a.dry_run:
        show({"asked": sampling.allocate_groups(c.mixture.target_documents, {g.name: g.percentage for g in c.groups}), "policy": c.mixture.depletion_policy})
        return
    show(build.build_mixture(session(), c, a.output))


def cmd_inspect_corpus(a) -> None:
    """Counts and a preview of a corpus."""
    spark = session()
    df = spark.read.parquet(f"{a.path}/documents")
    show({"counts": rows(corpus.inspect(df).orderBy("dimension", "value")), "sample": rows(df.orderBy(F.sha2("text", 256)).limit(a.samples).select("split", preview(F.col("text"), a.preview_chars).alias("text")))})


def cmd_inspect(a) -> None:
    """Summary, quality and a sample of a table of records."""
    spark = session()
    df = readers.records(spark, a.path)
    if a.stage:
        df = df.filter(F.col("stage_name") == a.stage)
    observed = rows(metrics.presence(df, tuple(df.columns)))[0]
    out = {
        "observed_fields": sorted(c for c, there in observed.items() if there),
        "shards": rows(readers.shard_counts(spark, a.path)), "summary": rows(metrics.record_summary(df))[0], "quality": build.quality_report(spark, df, a.path if a.export else None),
        "fields": rows(metrics.presence(df, ("top_k_ids", "per_token_entropy", "per_token_top1_gap", "per_token_valid_mask", "structured_output")))[0], "manifest": files.read_json(spark, f"{a.path}/{sinks.MANIFEST}"),
    }
    if a.samples:
        sample = sampling.first_rows(df, a.samples).select("doc_id", "chunk_index", "stage_name", "teacher_name", "entropy", preview(F.decode("raw_bytes", "ISO-8859-1"), 160).alias("text"))
        out["sample"] = rows(sample)
    if a.sample_out and a.sample_out.endswith(".txt"):
        told = ["\n".join(f"{k}: {v}" for k, v in r.items()) for r in out.get("sample", [])]
        files.write_text(spark, a.sample_out, "\n\n".join(told) + "\n")
    elif a.sample_out:
        files.write_json(spark, a.sample_out, out.get("sample", []))
    show(out)


def cmd_compare(a) -> None:
    """Compare two tables of records."""
    spark = session()
    found = rows(metrics.compare(readers.records(spark, a.left), readers.records(spark, a.right)).orderBy("fact"))
    show(found)
    print("DIFFERENT" if any(r["differs"] for r in found) else "MATCH")


def cmd_merge(a) -> None:
    """Merge shards of several folders."""
    show(sinks.merge_shards(session(), a.inputs, a.output, a.max_records_per_shard))


def cmd_prompt(a) -> None:
    """Render one prompt."""
    spark = session()
    df = spark.createDataFrame([(a.doc_id, a.chunk_index, bytearray(a.text.encode()))], "doc_id string, chunk_index int, raw_bytes binary")
    print(df.select(prompts.prompt(a.template, json.loads(a.options))).first()[0])


def cmd_policy(a) -> None:
    """What a position policy would keep."""
    spark = session()
    docs = spark.read.parquet(a.documents).withColumn("doc_id", F.col("doc_id").cast("string"))
    records.check_policy("selected_windows", a.entropy, a.gap, a.radius, a.minimum)
    out = stages.stage_a(chunking.chunk(docs, a.chunk_bytes, a.overlap_bytes), teachers.train_bigram(docs), 4).filter("error is null")
    mask = positions.select(F.col("per_token_entropy"), F.col("per_token_top1_gap"), a.entropy, a.gap, a.combine, a.minimum)
    show(rows(metrics.policy_preview(out.withColumn("mask", mask).withColumn("windows", positions.windows(F.col("mask"), a.radius))))[0])


def cmd_tokens(a) -> None:
    """Token cost of chunks by a teacher's tokenizer, without inference."""
    spark = session()
    docs = spark.read.parquet(a.documents)
    settings = json.loads(a.settings) | ({"path": a.tokenizer} if a.tokenizer else {})
    teacher = teachers.create("tokenizer_file" if a.tokenizer else a.teacher, **settings)
    out = stages.token_lengths(chunking.chunk(docs, a.chunk_bytes, a.overlap_bytes), teacher, "raw_bytes")
    show(rows(metrics.token_cost(out.select(F.col("teacher_input_byte_length").alias("n_bytes"), F.col("teacher_input_token_length").alias("n_tokens")), a.max_context))[0])


def cmd_parity(a) -> None:
    """Whether two tables of records have one shape."""
    spark = session()
    found = rows(metrics.parity(readers.records(spark, a.left), readers.records(spark, a.right), a.selection, entropy=a.entropy, gap=a.gap).orderBy("check"))
    show(found)
    print(max((r["verdict"] for r in found), key=["INFO", "PASS", "WARN", "FAIL"].index, default="PASS"))


def cmd_try_stage_a(a) -> None:
    """Run stage A of a configuration over a few chunks, and tell what comes out and what its position policy would keep."""
    spark = session()
    c = config.load_pipeline(a.config)
    s = c.stage_a
    docs = readers.text_folder(spark, c.data.input_path, c.data.file_glob, c.data.encoding, c.input.normalize_newlines)
    chunks = sampling.first_rows(chunking.chunk(docs, c.data.chunk_bytes, c.data.overlap_bytes), a.chunks)
    (name, settings), fell_back = build.members(s)[0], None
    try:
        teacher = build.make_teacher(name, settings, docs)
        if fell_back := teacher.check():
            teacher = teachers.Dummy()
    except (TypeError, OSError, ImportError) as e:
        teacher, fell_back = teachers.Dummy(), str(e)
    out = saved(stages.stage_a(chunks, teacher, s.top_k, s.mode), "try-stage-a")
    good, bad = stages.parted(out)
    told = {"teacher": teacher.name, "fell_back": fell_back, "records": good.count(), "failed": bad.count(), "sanity": rows(metrics.stage_sanity(good)), "facts": rows(metrics.parity_facts(good))[0]}
    if s.enable_position_filtering:
        needed = [x for x, threshold in (("per_token_entropy", s.entropy_threshold), ("per_token_top1_gap", s.top1_gap_threshold)) if threshold is not None]
        if all(getattr(teachers.capabilities(teacher.name), x) for x in needed):
            mask = positions.select(F.col("per_token_entropy"), F.col("per_token_top1_gap"), s.entropy_threshold, s.top1_gap_threshold, s.selection_combine_mode, s.minimum_selected_positions_per_record)
            masked = good.withColumn("mask", mask)
            told["selection"] = rows(metrics.policy_preview(masked.withColumn("windows", positions.windows(F.col("mask"), s.selection_window_radius))))[0]
        else:
            told["selection"] = f"teacher {teacher.name} does not give {', '.join(needed)}"
    show(told)


def cmd_bench(a) -> None:
    """Records a second of a build."""
    c = config.load_pipeline(a.config)
    began = time.perf_counter()
    out = build.run(session(), c)
    took = time.perf_counter() - began
    show({"records": out["output_records"], "seconds": took, "records_per_second": out["output_records"] / took, "phases": out["seconds"]})


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="loomwright", description=__doc__)
    sub = p.add_subparsers(required=True)

    def add(name, run, *args):
        s = sub.add_parser(name, help=run.__doc__)
        for flags, options in args:
            s.add_argument(*flags.split("|"), **options)
        s.set_defaults(run=run)

    yes = {"action": "store_true"}
    number = lambda kind, default=None: {"type": kind, "default": default}
    add("build", cmd_build, ("--config", {}), ("--preflight", yes), ("--merge-inputs", {"nargs": "*"}), ("--merge-ratios", {"nargs": "*", "type": float}), ("--merge-output", {}), ("--max-records-per-shard", number(int, 0)), ("--seed", number(int, 42)))
    add("extract", cmd_extract, ("--config", {"required": True}), ("--source", {"required": True}), ("--refresh", yes), ("--dry-run", yes))
    add("mix", cmd_mix, ("--config", {"required": True}), ("--output", {}), ("--dry-run", yes))
    add("inspect-corpus", cmd_inspect_corpus, ("path", {}), ("--samples", number(int, 3)), ("--preview-chars", number(int, 200)))
    add("inspect", cmd_inspect, ("path", {}), ("--stage", {}), ("--samples", number(int, 0)), ("--sample-out", {}), ("--export", yes))
    add("compare", cmd_compare, ("left", {}), ("right", {}))
    add("merge", cmd_merge, ("inputs", {"nargs": "+"}), ("--output", {"required": True}), ("--max-records-per-shard", number(int, 0)))
    add("preview-prompt", cmd_prompt, ("template", {"choices": prompts.names()}), ("text", {}), ("--doc-id", {"default": "doc"}), ("--chunk-index", number(int, 0)), ("--options", {"default": "{}"}))
    add("preview-policy", cmd_policy, ("documents", {}), ("--entropy", number(float)), ("--gap", number(float)), ("--radius", number(int, 0)), ("--minimum", number(int)), ("--combine", {"default": "union", "choices": ["union", "intersection"]}), ("--chunk-bytes", number(int, 4096)), ("--overlap-bytes", number(int, 256)))
    add("token-cost", cmd_tokens, ("documents", {}), ("--teacher", {"default": "byte_bigram", "choices": teachers.names()}), ("--settings", {"default": "{}"}), ("--tokenizer", {}), ("--max-context", number(int, 2048)), ("--chunk-bytes", number(int, 4096)), ("--overlap-bytes", number(int, 256)))
    add("parity", cmd_parity, ("left", {}), ("right", {}), ("--selection", {"default": "none", "choices": ["none", "position_mask", "selected_windows"]}), ("--entropy", number(float)), ("--gap", number(float)))
    add("try-stage-a", cmd_try_stage_a, ("--config", {"required": True}), ("--chunks", number(int, 8)))
    add("bench", cmd_bench, ("--config", {"required": True}))
    return p


def main(argv: list[str] | None = None) -> None:
    a = parser().parse_args(argv)
    a.run(a)


if __name__ == "__main__":
    main(sys.argv[1:])
