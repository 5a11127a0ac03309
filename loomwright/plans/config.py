"""Configuration of a pipeline and of a corpus mixture, read from TOML and checked before anything runs.

A section is a frozen dataclass; what a field may hold stands beside its default, as a rule in its metadata. Settings are values
that travel in closures; nothing is put into the environment.
"""

from __future__ import annotations

import hashlib
import math
import tomllib
from collections.abc import Callable
from dataclasses import asdict, dataclass, field, fields
from typing import Any

from ..functions import prompts
from ..functions.codec import canonical_json
from ..operators.corpus import POLICIES, Group, check_groups
from . import teachers


class ConfigError(ValueError):
    pass


Rule = tuple[Callable[[Any], bool], str]


def one_of(*allowed: Any) -> Rule:
    return (lambda v: v in allowed), f"must be one of {', '.join(map(str, allowed))}"


def at_least(low: float, strict: bool = False) -> Rule:
    return (lambda v: v is None or (isinstance(v, (int, float)) and not math.isnan(v) and (v > low if strict else v >= low))), f"must be {'>' if strict else '>='} {low}"


def between(low: float, high: float, closed: bool = False) -> Rule:
    return (lambda v: (low <= v < high) if closed else (low < v < high)), f"must be between {low} and {high}"


def setting(default: Any = None, *rules: Rule, required: bool = False) -> Any:
    make = {"default_factory": (lambda: default.copy())} if isinstance(default, (dict, list)) else {"default": default}
    return field(**make, metadata={"rules": rules, "required": required})


@dataclass(frozen=True)
class Data:
    input_path: str = setting("", required=True)
    file_glob: str = setting("*.txt")
    encoding: str = setting("utf-8")
    chunk_bytes: int = setting(4096, at_least(0, strict=True))
    overlap_bytes: int = setting(256, at_least(0))
    eval_fraction: float = setting(0.1, between(0, 1))
    eval_longdoc_min_bytes: int = setting(0, at_least(0))
    eval_longdoc_fraction: float = setting(0.0, between(0, 1, closed=True))
    eval_split_strategy: str = setting("prefer_long_docs", one_of("prefer_long_docs", "random_docs"))
    replay_stage_a_fraction: float = setting(1.0, at_least(0))
    replay_stage_b_fraction: float = setting(1.0, at_least(0))
    replay_stage_c_fraction: float = setting(1.0, at_least(0))
    train_replay_stage_a_fraction: float | None = setting(None, at_least(0))
    train_replay_stage_b_fraction: float | None = setting(None, at_least(0))
    train_replay_stage_c_fraction: float | None = setting(None, at_least(0))
    eval_replay_stage_a_fraction: float | None = setting(None, at_least(0))
    eval_replay_stage_b_fraction: float | None = setting(None, at_least(0))
    eval_replay_stage_c_fraction: float | None = setting(None, at_least(0))
    seed: int = setting(42)

    def replay(self, split: str, stage: str) -> float:
        """The share of a stage in a split's mix: the split's own, else the shared one."""
        own = getattr(self, f"{split}_replay_{stage}_fraction", None)
        return getattr(self, f"replay_{stage}_fraction") if own is None else own


@dataclass(frozen=True)
class Input:
    preserve_document_boundaries: bool = setting(True, one_of(True))  # chunks never join documents
    normalize_newlines: bool = setting(True)


@dataclass(frozen=True)
class Output:
    output_dir: str = setting("", required=True)
    format: str = setting("jsonl", one_of("jsonl", "parquet"))
    compression: str | None = setting(None, one_of(None, "none", "snappy", "gzip", "zstd", "lz4"))  # of Parquet; lines are written plain
    max_records_per_shard: int = setting(0, at_least(0))
    shard_prefix: str = setting("")
    resume: bool = setting(False)
    resume_policy: str = setting("strict", one_of("strict", "best_effort"))
    dry_run: bool = setting(False)
    dry_run_max_records: int = setting(16, at_least(0, strict=True))
    stop_after_stage: str | None = setting(None, one_of(None, "stage_a", "stage_b", "stage_c"))


@dataclass(frozen=True)
class _Stage:
    enabled: bool = setting(True)
    teacher_name: str = setting("byte_bigram", required=True)
    backend_type: str | None = setting(None, one_of(None, "builtin", "hf", "vllm", "llamacpp_server"))
    mode: str = setting("topk_logits", one_of("topk_logits", "long_context", "structured_outputs"))
    top_k: int = setting(32, at_least(0, strict=True))
    temperature: float = setting(1.0, at_least(0))  # for teachers that have the setting
    extract_hidden_summary: bool = setting(False)
    teacher_settings: dict = setting({})
    teacher_mixture: list = setting([])

    def extra_checks(self, name: str) -> None:
        try:
            for m in [self.teacher_name, *(x["teacher_name"] for x in self.teacher_mixture)]:
                teachers.capabilities(m)
        except KeyError:
            raise ConfigError(f"{name}.teacher_mixture needs teacher_name and ratio") from None
        except ValueError as e:
            raise ConfigError(f"{name}: {e}") from None
        if any(not isinstance(x.get("ratio"), (int, float)) or x["ratio"] <= 0 for x in self.teacher_mixture):
            raise ConfigError(f"{name}.teacher_mixture ratios must be > 0")
        used = [x["teacher_name"] for x in self.teacher_mixture] or [self.teacher_name]
        if self.enabled and self.extract_hidden_summary and (lacking := [m for m in used if not teachers.capabilities(m).hidden_summary]):
            raise ConfigError(f"{name}.extract_hidden_summary is not supported by {', '.join(lacking)}")
        if self.backend_type is not None and self.backend_type != teachers.backend(self.teacher_name):
            raise ConfigError(f"{name}.backend_type {self.backend_type} is not that of {self.teacher_name}")


@dataclass(frozen=True)
class StageA(_Stage):
    enable_position_filtering: bool = setting(False)
    entropy_threshold: float | None = setting(None, at_least(0))
    top1_gap_threshold: float | None = setting(None, at_least(0))
    selection_window_radius: int = setting(0, at_least(0))
    selection_mode: str = setting("none", one_of("none", "position_mask", "selected_windows"))
    selection_combine_mode: str = setting("union", one_of("union", "intersection"))
    minimum_selected_positions_per_record: int | None = setting(None, at_least(0))

    def extra_checks(self, name: str) -> None:
        super().extra_checks(name)
        if self.enable_position_filtering and self.selection_mode == "none":
            raise ConfigError(f"{name}.enable_position_filtering needs a selection_mode")
        if self.enable_position_filtering and self.entropy_threshold is None and self.top1_gap_threshold is None:
            raise ConfigError(f"{name}.enable_position_filtering needs entropy_threshold or top1_gap_threshold")


@dataclass(frozen=True)
class StageB(StageA):
    mode: str = setting("long_context", one_of("topk_logits", "long_context"))
    context_window: int = setting(8192, at_least(0, strict=True))
    stride: int = setting(2048, at_least(0))
    window_policy: str = setting("center_target", one_of("left_biased", "right_biased", "center_target"))
    max_teacher_context: int | None = setting(None, at_least(0, strict=True))
    target_region_policy: str = setting("preserve_full", one_of("preserve_full", "truncate_if_needed"))


@dataclass(frozen=True)
class StageC(_Stage):
    mode: str = setting("structured_outputs", one_of("structured_outputs", "topk_logits"))
    top_k: int = setting(16, at_least(0, strict=True))
    template_name: str = setting("summarize_chunk", one_of(*prompts.names()))
    template_kwargs: dict = setting({})
    deterministic: bool = setting(True)


@dataclass(frozen=True)
class Pipeline:
    data: Data
    input: Input
    output: Output
    stage_a: StageA
    stage_b: StageB
    stage_c: StageC


def section(kind: type, name: str, values: Any) -> Any:
    """A checked section. Unknown keys are ignored, as settings of other versions may be there."""
    if not isinstance(values, dict):
        raise ConfigError(f"section [{name}] is missing or not a table")
    known = {f.name: f for f in fields(kind)}
    for key, f in known.items():
        if f.metadata["required"] and values.get(key) in (None, ""):
            raise ConfigError(f"{name}.{key} is required")
    made = kind(**{k: v for k, v in values.items() if k in known})
    for key, f in known.items():
        for ok, said in f.metadata["rules"]:
            try:
                good = ok(getattr(made, key))
            except TypeError:
                good = False
            if not good:
                raise ConfigError(f"{name}.{key} {said}")
    if hasattr(made, "extra_checks"):
        made.extra_checks(name)
    return made


SECTIONS = {"data": Data, "input": Input, "output": Output, "stage_a": StageA, "stage_b": StageB, "stage_c": StageC}


def pipeline(values: dict[str, Any]) -> Pipeline:
    made = Pipeline(**{n: section(k, n, values.get(n)) for n, k in SECTIONS.items()})
    if made.data.overlap_bytes >= made.data.chunk_bytes:
        raise ConfigError("data.overlap_bytes must be < data.chunk_bytes")
    return made


def load_pipeline(path: str) -> Pipeline:
    with open(path, "rb") as f:
        return pipeline(tomllib.load(f))


def fingerprints(config: Pipeline) -> dict[str, str]:
    """SHA-256 of the whole configuration, and of what changes the records."""
    whole = asdict(config)
    critical = {k: v for k, v in whole.items() if k != "output"} | {"output_format": config.output.format}
    digest = lambda x: hashlib.sha256(canonical_json(x, ascii_only=False).encode()).hexdigest()
    return {"critical": digest(critical), "full": digest(whole)}


# Corpora


@dataclass(frozen=True)
class Source:
    source_name: str = setting("", required=True)
    source_type: str = setting("parquet", one_of("parquet", "json", "csv", "orc", "huggingface"))
    location: str = setting("", required=True)
    config_name: str | None = setting(None)
    text_field: str = setting("text", required=True)
    order_field: str | None = setting(None)
    split_mapping: dict = setting({})
    group_size: int = setting(1, at_least(0, strict=True))
    max_docs_per_split: int | None = setting(None, at_least(0, strict=True))
    min_bytes: int | None = setting(None, at_least(0))
    max_bytes: int | None = setting(None, at_least(0))

    def extra_checks(self, name: str) -> None:
        if not self.split_mapping or not set(self.split_mapping) <= {"train", "eval", "validation"}:
            raise ConfigError(f"{name} needs split_mapping, or train_split, eval_split or validation_split")
        if self.min_bytes is not None and self.max_bytes is not None and self.min_bytes > self.max_bytes:
            raise ConfigError(f"{name}.min_bytes must be <= max_bytes")

    def fingerprint(self) -> str:
        return hashlib.sha256(canonical_json(asdict(self)).encode()).hexdigest()

    def reused_splits(self) -> dict[str, list[str]]:
        """Upstream splits that more than one split of ours reads."""
        by: dict[str, list[str]] = {}
        for ours, theirs in self.split_mapping.items():
            by.setdefault(theirs, []).append(ours)
        return {k: sorted(v) for k, v in by.items() if len(v) > 1}


@dataclass(frozen=True)
class Mixture:
    target_documents: int = setting(0, at_least(0, strict=True))
    random_seed: int = setting(42)
    min_bytes: int | None = setting(None, at_least(0))
    max_bytes: int | None = setting(None, at_least(0))
    depletion_policy: str = setting("strict", one_of(*POLICIES))


@dataclass(frozen=True)
class Corpus:
    cache_dir: str
    sources: tuple[Source, ...]
    mixture: Mixture
    groups: tuple[Group, ...]


def source(values: dict[str, Any]) -> Source:
    """A source; hf_dataset, hf_config and the three split keys are read as well."""
    v = dict(values)
    v.setdefault("location", v.pop("hf_dataset", ""))
    v.setdefault("config_name", v.pop("hf_config", None))
    splits = dict(v.get("split_mapping") or {})
    for ours in ("train", "eval", "validation"):
        if v.get(f"{ours}_split"):
            splits[ours] = v[f"{ours}_split"]
    return section(Source, f"source {v.get('source_name')}", v | {"split_mapping": splits})


def corpus(values: dict[str, Any]) -> Corpus:
    extraction, mixture = values.get("source_extraction"), values.get("mixture_build")
    if not isinstance(extraction, dict) or not isinstance(mixture, dict):
        raise ConfigError("sections [source_extraction] and [mixture_build] are required")
    sources = tuple(source(s) for s in extraction.get("datasets", []))
    groups = tuple(
        Group(g.get("group_name", ""), float(g.get("percentage", 0)), tuple(g.get("dataset_names") or [d["source_name"] for d in g.get("datasets", [])])) for g in mixture.get("groups", [])
    )
    try:
        check_groups(groups, [s.source_name for s in sources])
    except ValueError as e:
        raise ConfigError(f"mixture_build.groups: {e}") from None
    return Corpus(extraction.get("cache_dir", "source_cache"), sources, section(Mixture, "mixture_build", mixture), groups)


def load_corpus(path: str) -> Corpus:
    with open(path, "rb") as f:
        return corpus(tomllib.load(f))


DEFAULT = """\
[data]
input_path = "./data/raw"
chunk_bytes = 4096
overlap_bytes = 256
eval_fraction = 0.1
seed = 42

[input]
normalize_newlines = true

[output]
output_dir = "./data/processed"
format = "jsonl"

[stage_a]
teacher_name = "byte_bigram"
top_k = 32

[stage_b]
teacher_name = "byte_bigram"
context_window = 8192
stride = 2048
max_teacher_context = 4096

[stage_c]
teacher_name = "byte_bigram"
template_name = "summarize_chunk"
"""
