"""Builds: source caches, mixtures and teacher records, with manifests and resume."""

from __future__ import annotations

import time
from dataclasses import asdict
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.lineage import saved
from ..operators import chunking, corpus, metrics, sampling, splits
from ..sources import files, readers, sinks
from . import stages, teachers
from .config import Corpus, Pipeline, Source, fingerprints

RESUME = "resume_state.json"
METRICS = "teacher_quality_metrics.json"


# Source caches and mixtures


def cache_state(spark: SparkSession, root: str, source: Source) -> str:
    """missing, present_without_manifest, ready or mismatch."""
    there = files.exists(spark, f"{root}/documents/source_name={source.source_name}")
    manifest = files.read_json(spark, f"{root}/manifests/{source.source_name}.json")
    if manifest is None:
        return "present_without_manifest" if there else "missing"
    return "ready" if manifest.get("config_fingerprint") == source.fingerprint() else "mismatch"


def extract(spark: SparkSession, root: str, source: Source, refresh: bool = False, dry_run: bool = False, read=None) -> dict[str, Any]:
    """Fills the cache of one source. A ready cache is left alone; one of another configuration is an error without refresh."""
    state = cache_state(spark, root, source)
    told = {"source_name": source.source_name, "state": state, "reused_upstream_splits": source.reused_splits()}
    if dry_run or (state == "ready" and not refresh):
        return told
    if state in ("mismatch", "present_without_manifest") and not refresh:
        raise ValueError(f"the cache of {source.source_name} is {state}; refresh it to replace it")
    parts, counts = [], {}
    for ours, theirs in sorted(source.split_mapping.items()):
        try:
            rows = read(source, theirs) if read else readers.upstream(spark, source.location, source.source_type, config=source.config_name, split=theirs)
        except Exception as e:
            raise RuntimeError(f"source {source.source_name}, split {theirs}: {e}") from e
        order = [source.order_field] if source.order_field else [c for c, k in rows.dtypes if not k.startswith(("array", "map", "struct"))]
        rows = rows.withColumn("split", F.lit(ours))
        parts.append(corpus.group_rows(rows, ["split"], order, source.text_field, source.group_size, source.min_bytes, source.max_bytes, source.max_docs_per_split))
        counted = corpus.count_rows(rows, ["split"], source.text_field, source.group_size, source.min_bytes, source.max_bytes, source.max_docs_per_split).collect()
        counts[ours] = counted[0].asDict() if counted else {"rows_seen": 0, "documents": 0}
    sinks.write_cache(sampling.concat(parts), root, source.source_name, {"source_config": asdict(source), "config_fingerprint": source.fingerprint(), "splits": counts})
    return told | {"state": "ready", "splits": counts}


def build_mixture(spark: SparkSession, config: Corpus, out: str) -> dict[str, Any]:
    """Mixes the cached sources into out/<split> and writes a manifest. Everything is checked before the first write."""
    if files.exists(spark, out):
        raise FileExistsError(out)
    pool = readers.cache(spark, config.cache_dir)
    m = config.mixture
    mixed = corpus.mix(pool, config.groups, m.target_documents, m.random_seed, m.depletion_policy, m.min_bytes, m.max_bytes)
    mixed.select("split", "output_doc_id", "output_ordinal", "group_name", "source_name", "doc_id", "text").write.partitionBy("split").parquet(f"{out}/documents")
    written = spark.read.parquet(f"{out}/documents")
    levels = [r.asDict() for r in corpus.composition(written, m.target_documents, config.groups).collect()]  # a few rows for each group and source
    manifest = {
        "created_at": sinks.now(), "target_documents_per_split": m.target_documents, "random_seed": m.random_seed, "depletion_policy": m.depletion_policy, "groups": [g._asdict() for g in config.groups],
        "composition": levels, "warnings": [f"{r['split']}/{r['group_name']}: {r['documents']} of {r['requested']}" for r in levels if r["deviates"]],
        "sources": readers.cache_refs(spark, config.cache_dir, [s.source_name for s in config.sources]),
    }
    files.write_json(spark, f"{out}/manifest.json", manifest)
    return manifest


# Teacher records


def initial_resume(config: Pipeline) -> dict[str, Any]:
    f = fingerprints(config)
    return {"schema_version": "1", "config_fingerprint": f["full"], "critical_config_fingerprint": f["critical"], "completed_stages": [], "split_progress": {}, "last_update_timestamp": sinks.now()}


def may_resume(state: dict[str, Any], config: Pipeline, policy: str) -> tuple[bool, str | None]:
    """strict wants the whole configuration to be the same; best_effort what changes records, and warns of the rest."""
    f = fingerprints(config)
    if state.get("config_fingerprint") == f["full"]:
        return True, None
    if policy == "strict":
        return False, "the configuration differs from the run that is resumed"
    if state.get("critical_config_fingerprint") != f["critical"]:
        return False, "settings that change the records differ from the run that is resumed"
    return True, "settings that do not change the records differ from the run that is resumed"


def members(c: Any) -> list[tuple[str, dict[str, Any]]]:
    """The teachers of a stage and their settings; a stage's own settings reach the teachers that have them."""
    used = [(m["teacher_name"], m.get("settings", {})) for m in c.teacher_mixture or ()] or [(c.teacher_name, c.teacher_settings)]
    shared = {"temperature": c.temperature, "hidden": c.extract_hidden_summary}
    return [(name, {k: v for k, v in shared.items() if teachers.accepts(name, k)} | settings) for name, settings in used]


def make_teacher(name: str, settings: dict[str, Any], docs: DataFrame) -> teachers.Teacher:
    return teachers.train_bigram(docs) if name == "byte_bigram" and not settings else teachers.create(name, **settings)


def startup_checks(config: Pipeline, enabled: list[str]) -> list[dict[str, Any]]:
    """Asks every teacher that will run, once for each stage, whether it can; the first that cannot stops the build."""
    told = []
    for kind in enabled:
        c = getattr(config, kind)
        for name, settings in members(c):
            teacher = teachers.create(name, **settings)
            if name != "byte_bigram" and (bad := teacher.check()):
                raise RuntimeError(f"{kind}: {name} (mode {c.mode}, top_k {c.top_k}): {bad}")
            told.append({"stage_name": kind, "teacher_name": name, "mode": c.mode, "top_k": c.top_k, "result": teacher.about() | {"ok": True}})
    return told


def _stage(kind: str, config: Pipeline, teacher: teachers.Teacher, rows: DataFrame) -> DataFrame:
    made = _records(kind, config, teacher, rows)
    if getattr(config, kind).extract_hidden_summary:
        return made
    return made.withColumn("hidden_summary", F.lit(None).cast(made.schema["hidden_summary"].dataType))


def _records(kind: str, config: Pipeline, teacher: teachers.Teacher, rows: DataFrame) -> DataFrame:
    c = getattr(config, kind)
    if kind == "stage_a":
        return stages.stage_a(rows, teacher, c.top_k, c.mode, c.enable_position_filtering, c.selection_mode, c.entropy_threshold, c.top1_gap_threshold, c.selection_window_radius, c.selection_combine_mode, c.minimum_selected_positions_per_record)
    if kind == "stage_b":
        return stages.stage_b(rows, teacher, c.max_teacher_context or c.context_window, c.top_k, c.mode, c.window_policy, c.target_region_policy, c.selection_mode if c.enable_position_filtering else "none")
    return stages.stage_c(rows, teacher, c.template_name, c.template_kwargs, c.mode, c.deterministic, c.top_k)


WINDOW_COLUMNS = ("window_raw_bytes", "window_byte_start", "window_byte_end", "target_start_in_window", "target_end_in_window")


def run(spark: SparkSession, config: Pipeline, docs: DataFrame | None = None) -> dict[str, Any]:
    """Ingest, chunk, split, stages, curriculum, dedup, write, quality report. Gives the run's summary: counts, seconds by phase,
    records and failures by stage, shares of the stages, what was asked, and what the teachers' checks told.

    Each stage's output is written once as a table in the output folder, so no teacher runs twice for a record, and a resumed
    run reads the stages that were finished.
    """
    seconds: dict[str, float] = {}
    clock = time.perf_counter

    def timed(phase: str, since: float) -> None:
        seconds[phase] = seconds.get(phase, 0.0) + clock() - since

    out = config.output.output_dir
    state = files.read_json(spark, f"{out}/{RESUME}") if config.output.resume else None
    warning = None
    if state is not None:
        ok, warning = may_resume(state, config, config.output.resume_policy)
        if not ok:
            raise ValueError(warning)
    state = state or initial_resume(config)
    t = clock()
    if docs is None:
        docs = readers.text_folder(spark, config.data.input_path, config.data.file_glob, config.data.encoding, config.input.normalize_newlines)
    docs = docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text")
    timed("ingestion", t)
    enabled = [s for s in ("stage_a", "stage_b", "stage_c") if getattr(config, s).enabled]
    if config.output.stop_after_stage:
        enabled = enabled[: enabled.index(config.output.stop_after_stage) + 1] if config.output.stop_after_stage in enabled else enabled
    checks = [] if config.output.dry_run else startup_checks(config, enabled)
    t = clock()
    b = config.stage_b
    chunks = chunking.chunk(docs, config.data.chunk_bytes, config.data.overlap_bytes, context=b.context_window, stride=b.stride)
    timed("chunking", t)
    t = clock()
    d = config.data
    if d.eval_longdoc_fraction > 0:
        labelled = splits.with_long_documents(chunks, d.eval_fraction, d.seed, d.eval_longdoc_min_bytes, d.eval_longdoc_fraction, d.eval_split_strategy)
    else:
        labelled = splits.by_rank(chunks, d.eval_fraction, d.seed)
    if config.output.dry_run:
        n = config.output.dry_run_max_records
        labelled = sampling.concat([sampling.subsample(labelled.filter(F.col("split") == s), n, d.seed + i + 1) for i, s in enumerate(("train", "eval", "eval_longdoc"))])
    timed("splitting", t)
    history: list[tuple[str, DataFrame]] = []
    by_stage: list[dict[str, Any]] = []
    for i, kind in enumerate(enabled):
        t = clock()
        path = f"{out}/stages/{kind}"
        if kind not in state["completed_stages"] or not files.exists(spark, path):
            c = getattr(config, kind)
            rows = labelled if kind == "stage_b" else labelled.drop(*WINDOW_COLUMNS)
            if config.output.dry_run:
                made = _stage(kind, config, teachers.create("dry_run"), rows) if kind != "stage_a" else stages.stage_a(rows, teachers.create("dry_run"), c.top_k)
            elif c.teacher_mixture:
                total = rows.count()
                # written first, so each teacher sees each record once, however often the draw reads its output
                outputs = [(saved(_stage(kind, config, make_teacher(*member, docs), rows), f"teacher-{j}"), m["ratio"]) for j, (member, m) in enumerate(zip(members(c), c.teacher_mixture, strict=True))]
                made = sampling.teacher_mixture(outputs, total, d.seed + 101 * (i + 1))
            else:
                made = _stage(kind, config, make_teacher(*members(c)[0], docs), rows)
            made.drop(*WINDOW_COLUMNS).write.mode("overwrite").option("compression", "zstd").parquet(path)
            state["completed_stages"] = sorted({*state["completed_stages"], kind})
            files.write_json(spark, f"{out}/{RESUME}", state | {"last_update_timestamp": sinks.now()})
        good, bad = stages.parted(spark.read.parquet(path))
        n_bad = bad.count()
        if n_bad:
            sinks.write_failures(bad, out)
            if good.isEmpty():
                raise RuntimeError(f"{kind}: every record failed")
        history.append((kind, good))
        timed(kind, t)
        by_stage.append({"stage_name": kind, "records": good.count(), "failures": n_bad, "seconds": seconds[kind]})
    if not history:
        raise ValueError("no stage is enabled")
    t = clock()
    order = ("doc_id", "chunk_index", "byte_start", "stage_name", "teacher_name")
    written = []
    for split in ("train", "eval", "eval_longdoc"):
        of = lambda df: df.filter(F.col("split") == split)  # noqa: B023, E731
        side = "train" if split == "train" else "eval"
        final = sampling.curriculum(of(history[-1][1]), [(of(h), d.replay(side, k)) for k, h in history], d.seed)
        if final.isEmpty():
            continue
        prefix = f"{config.output.shard_prefix}{split}"
        written.append(sinks.write_records(final, out, split, order, config.output.max_records_per_shard, prefix, append=config.output.resume, kind=config.output.format, compression=config.output.compression))
        state["split_progress"][split] = {"record_count": written[-1]["records"]}
    files.write_json(spark, f"{out}/{RESUME}", state | {"last_update_timestamp": sinks.now()})
    timed("writing", t)
    t = clock()
    found = output_records(spark, config)
    if found is not None:
        quality_report(spark, found, out)
    timed("metrics", t)
    n_docs, n_chunks = docs.count(), chunks.count()  # ids and sizes only
    of = {w["split"]: w for w in written}
    number = lambda split, what: of.get(split, {}).get(what, 0)
    used = {s: [n for n, _ in members(getattr(config, s))] for s in enabled}
    phases = ("ingestion", "chunking", "splitting", *enabled, "writing")
    timing = {f"{p}_seconds": seconds.get(p, 0.0) for p in ("ingestion", "chunking", "splitting", "stage_a", "stage_b", "stage_c", "writing")}
    timing |= {"teacher_inference_seconds": sum(seconds[s] for s in enabled), "total_runtime_seconds": sum(seconds.get(p, 0.0) for p in phases)}
    return {
        "output_dir": out, "stages": enabled, "splits": written, "output_records": sum(w["records"] for w in written), "warning": warning, "seconds": seconds, "total_runtime_seconds": sum(seconds.values()),
        "train_path": f"{out}/{config.output.shard_prefix}train", "eval_path": f"{out}/{config.output.shard_prefix}eval", "train_count": number("train", "records"),
        "eval_count": number("eval", "records"), "eval_longdoc_count": number("eval_longdoc", "records"), "train_duplicates_skipped": number("train", "skipped"),
        "eval_duplicates_skipped": number("eval", "skipped"), "doc_count": n_docs, "chunk_count": n_chunks, **{f"{s}_teachers": used.get(s, []) for s in ("stage_a", "stage_b", "stage_c")},
        "timing": timing, "stage_metrics": by_stage, **{f"{side}_stage_fractions": {s: config.data.replay(side, s) for s in ("stage_a", "stage_b", "stage_c")} for side in ("train", "eval")},
        "resume_enabled": config.output.resume, "resume_policy": config.output.resume_policy, "resume_warning": warning, "dry_run": config.output.dry_run,
        "dry_run_max_records": config.output.dry_run_max_records, "skipped_records": sum(r["failures"] for r in by_stage), "stop_after_stage": config.output.stop_after_stage,
        "teacher_startup_checks": checks,
    }


def output_records(spark: SparkSession, config: Pipeline) -> DataFrame | None:
    """All records in a build's folder, those of earlier runs included; None where there are none."""
    o = config.output
    if o.format == "jsonl":
        return readers.records(spark, o.output_dir) if any(n.endswith(".jsonl") for n in files.names(spark, o.output_dir)) else None
    paths = [p for split in ("train", "eval", "eval_longdoc") if files.exists(spark, p := f"{o.output_dir}/{o.shard_prefix}{split}.parquet")]
    return sampling.concat([spark.read.parquet(p) for p in paths]) if paths else None


def quality_report(spark: SparkSession, records: DataFrame, folder: str | None = None, bins: int = 10) -> dict[str, Any]:
    """Histogram, counts and entropies by stage and teacher, and position filtering; written to folder if named."""
    # the few columns that are used, written once, as every figure reads them again
    needed = ("entropy", "stage_name", "teacher_name", "selected_window_start", "selected_window_end", "selected_position_count", "selected_position_mask", "selected_positions", "selection_policy")
    records = saved(records.select(*(c for c in needed if c in records.columns)), "quality")
    have = set(records.columns)
    for c, kind in (("selected_window_start", "int"), ("selected_window_end", "int"), ("selected_position_count", "int"), ("selected_position_mask", "array<boolean>"), ("selected_positions", "array<int>"), ("selection_policy", "string")):
        if c not in have:
            records = records.withColumn(c, F.lit(None).cast(kind))
    rows = lambda df: [r.asDict() for r in df.collect()]  # noqa: E731  a few rows each
    report = {
        "schema_version": "1.0", "created_at": sinks.now(), "record_count": records.count(),
        "entropy_histogram": {"binning": "deterministic_equal_width", "bin_count": max(1, bins), "bins": rows(metrics.histogram(records, "entropy", bins).orderBy("bin"))},
        "per_stage": rows(metrics.by_key(records, "stage_name")), "per_teacher": rows(metrics.by_key(records, "teacher_name")), "selection_summary": rows(metrics.selection_summary(records))[0],
    }
    if folder:
        files.write_json(spark, f"{folder}/{METRICS}", report)
    return report


def timing_lines(seconds: dict[str, float]) -> list[str]:
    return [f"{k}: {v:.3f} s" for k, v in seconds.items()] + [f"total: {sum(seconds.values()):.3f} s"]


def stage_lines(by_stage: list[dict[str, Any]]) -> list[str]:
    return [f"{r['stage_name']}: {r['records']} records, {r['failures']} failed, {r['records'] / max(r['seconds'], 1e-9):.1f} records a second" for r in by_stage]
