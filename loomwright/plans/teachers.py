"""Teachers: what turns bytes into candidates and signals. They run on executors in Arrow batches; see stages.py.

A teacher is opened once for each task and closed at its end. Settings travel with it, never through the environment.
"""

from __future__ import annotations

import json
import math
import time
import urllib.error
import urllib.request
from collections.abc import Callable, Collection, Iterator
from dataclasses import dataclass, field
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.completions import COUNTS, LISTS


@dataclass(frozen=True)
class Capabilities:
    topk: bool = True
    structured: bool = False
    long_context: bool = False
    hidden_summary: bool = False
    per_token_entropy: bool = False
    per_token_top1_gap: bool = False
    tokenizer: bool = False


@dataclass
class Output:
    """Of one input: rows of candidate ids and log-probabilities, and signals; None where a teacher has none."""

    ids: list[list[int]]
    logprobs: list[list[float]]
    entropy: float
    per_token_entropy: list[float] | None = None
    per_token_top1_gap: list[float] | None = None
    per_token_token_ids: list[int] | None = None
    per_token_valid_mask: list[bool] | None = None
    hidden_summary: list[float] | None = None
    tokens: int | None = None


class Teacher:
    """Base of all teachers. Subclasses say what they can do and implement topk, and structured if they can."""

    name = "teacher"
    backend = "builtin"
    capabilities = Capabilities()

    def open(self) -> None:
        """Called once in each task before the first batch."""

    def close(self) -> None:
        """Called once in each task after the last batch, also after an error."""

    def topk(self, data: list[bytes], k: int) -> list[Output]:
        raise NotImplementedError

    def arrays(self, data: list[bytes], k: int, fields: Collection[str] | None = None) -> list[pa.Array] | None:
        """The fields of Output as Arrow arrays, for teachers that can make them without a Python object for each number.

        fields: names of stages.OUTPUTS that are asked for; other lists may be null.
        """
        return None

    def structured(self, prompts: list[str], options: list[dict[str, Any]]) -> list[str]:
        raise NotImplementedError

    def token_lengths(self, texts: list[str]) -> list[int]:
        """Tokens of each text, as the teacher would read it; no inference."""
        raise NotImplementedError(f"teacher {self.name} has no tokenizer")

    def check(self) -> str | None:
        """What stands against starting, None if nothing."""
        return None

    def about(self) -> dict[str, Any]:
        """What is known of the backend before a run, for the run's summary."""
        return {"backend": self.backend}


_registry: dict[str, tuple[Callable[..., Teacher], Capabilities, str]] = {}


def register(name: str, capabilities: Capabilities, backend: str = "builtin"):
    def add(factory):
        _registry[name] = (factory, capabilities, backend)
        return factory

    return add


def names() -> list[str]:
    return sorted(_registry)


def create(name: str, **settings: Any) -> Teacher:
    if name not in _registry:
        raise ValueError(f"unknown teacher {name}; there are {', '.join(names())}")
    return _registry[name][0](**settings)


def capabilities(name: str) -> Capabilities:
    if name not in _registry:
        raise ValueError(f"unknown teacher {name}; there are {', '.join(names())}")
    return _registry[name][1]


def backend(name: str) -> str:
    capabilities(name)
    return _registry[name][2]


def accepts(name: str, setting: str) -> bool:
    """Whether a teacher has a setting of that name."""
    capabilities(name)
    return setting in getattr(_registry[name][0], "__dataclass_fields__", {})


class Runtime:
    """What serves a model, apart from records: subclasses implement what their capabilities say."""

    backend = "runtime"
    capabilities = Capabilities()

    def open(self) -> None:
        pass

    def close(self) -> None:
        pass

    def topk(self, data: list[bytes], k: int) -> list[Output]:
        raise NotImplementedError

    def structured(self, prompts: list[str], options: list[dict[str, Any]]) -> list[str]:
        raise NotImplementedError

    def token_lengths(self, texts: list[str]) -> list[int]:
        raise NotImplementedError


class Adapted(Teacher):
    """A runtime as a teacher. What the runtime cannot do is refused before it is asked."""

    def __init__(self, name: str, runtime: Runtime):
        self.name, self.runtime, self.backend, self.capabilities = name, runtime, runtime.backend, runtime.capabilities

    def _able(self, what: str) -> Runtime:
        if not getattr(self.capabilities, what):
            raise NotImplementedError(f"runtime {self.backend} does not support {what}")
        return self.runtime

    def open(self):
        self.runtime.open()

    def close(self):
        self.runtime.close()

    def topk(self, data, k):
        return self._able("topk").topk(data, k)

    def structured(self, prompts, options):
        return self._able("structured").structured(prompts, options)

    def token_lengths(self, texts):
        return self._able("tokenizer").token_lengths(texts)


def adapt(name: str, make: Callable[..., Runtime], can: Capabilities, backend: str = "runtime") -> None:
    """Registers a runtime as a teacher."""
    register(name, can, backend)(lambda **settings: Adapted(name, make(**settings)))


def require(name: str, mode: str, signals: tuple[str, ...] = ()) -> None:
    """Fails before planning if a teacher cannot do what a stage asks."""
    can = capabilities(name)
    needed = {"topk_logits": ("topk",), "long_context": ("topk", "long_context"), "structured_outputs": ("structured",)}.get(mode)
    if needed is None:
        raise ValueError(f"unknown mode {mode}")
    for c in (*needed, *signals):
        if not getattr(can, c):
            raise ValueError(f"teacher {name} does not support {c}, which mode {mode} needs")


# Built-in teachers


@register("dummy", Capabilities(structured=True, long_context=True))
class Dummy(Teacher):
    """Ids 0, 1, ..., log-probabilities -0.1, -0.2, ..., entropy a tenth of their number."""

    name = "dummy"

    def topk(self, data, k=4):
        ids, lps = list(range(k)), [-(i + 1) * 0.1 for i in range(k)]
        return [Output([ids], [lps], 0.1 * k, tokens=1) for _ in data]

    def structured(self, prompts, options):
        return [f"dummy_completion_{i}" for i in range(len(prompts))]


@register("dry_run", Capabilities(structured=True, long_context=True))
class DryRun(Teacher):
    """Placeholders of the asked width, entropy 0, empty completions."""

    name = "dry_run"

    def topk(self, data, k=5):
        return [Output([list(range(k))], [[0.0] * k], 0.0, tokens=1) for _ in data]

    def structured(self, prompts, options):
        return ["" for _ in prompts]


@register("byte_bigram", Capabilities(structured=True, long_context=True, per_token_entropy=True, per_token_top1_gap=True, tokenizer=True))
class ByteBigram(Teacher):
    """Predicts the next byte from the byte before, by counts over a corpus. table: counts[256][256], fixed in size.

    A text of n bytes has n - 1 rows; a byte that the corpus never continued has no candidates, entropy 0 and is not valid.
    """

    name = "byte_bigram"

    def __init__(self, table: bytes = b""):
        self.table = table

    def open(self):
        c = np.frombuffer(self.table, np.int64).reshape(256, 256) if self.table else np.zeros((256, 256), np.int64)
        n = c.sum(1, keepdims=True)
        with np.errstate(divide="ignore", invalid="ignore"):
            p = np.where(n > 0, c / n, 0.0)
            logp = np.where(c > 0, np.log(np.where(c > 0, p, 1.0)), 0.0)
        self.entropy = -(p * logp).sum(1)
        self.order = np.lexsort((np.broadcast_to(np.arange(256), c.shape), -c), axis=1)
        self.found = (c > 0).sum(1)
        self.logp = logp
        best = np.take_along_axis(logp, self.order[:, :2], 1)
        self.gap = np.where(self.found > 1, best[:, 0] - best[:, 1], 0.0)

    def topk(self, data, k=32):
        rows = [self.order[b, : min(k, self.found[b])].tolist() for b in range(256)]
        lps = [self.logp[b, r].tolist() for b, r in enumerate(rows)]
        out = []
        for d in data:
            x = np.frombuffer(d, np.uint8)[:-1]
            e = self.entropy[x]
            own = x.tolist()
            out.append(Output([rows[b] for b in own], [lps[b] for b in own], float(e.mean()) if len(x) else 0.0, e.tolist(), self.gap[x].tolist(), own, (self.found[x] > 0).tolist(), tokens=len(d)))
        return out

    def arrays(self, data, k=32, fields=None):
        parts = [np.frombuffer(d, np.uint8)[:-1] for d in data]
        x = np.concatenate(parts) if parts else np.zeros(0, np.uint8)
        ends = np.cumsum([0, *map(len, parts)])
        whole = pa.array(ends, pa.int32())
        listed = lambda values: pa.ListArray.from_arrays(whole, pa.array(values))
        asked = lambda name, make: make() if fields is None or name in fields else pa.nulls(len(data))

        def nested(table: np.ndarray) -> pa.Array:
            width = np.minimum(self.found, k)[x]
            rows = pa.array(np.append(0, np.cumsum(width)), pa.int32())
            return pa.ListArray.from_arrays(whole, pa.ListArray.from_arrays(rows, pa.array(table[x][np.arange(k) < width[:, None]])))

        order = self.order[:, :k]
        e = self.entropy[x]
        means = [float(e[a:b].mean()) if b > a else 0.0 for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
        return [
            asked("top_k_ids", lambda: nested(order)), asked("top_k_logprobs", lambda: nested(np.take_along_axis(self.logp, order, 1))), pa.array(means, pa.float64()),
            asked("per_token_entropy", lambda: listed(e)), asked("per_token_top1_gap", lambda: listed(self.gap[x])), asked("per_token_token_ids", lambda: listed(x.astype(np.int64))),
            asked("per_token_valid_mask", lambda: listed(self.found[x] > 0)), pa.nulls(len(data), pa.list_(pa.float64())), pa.array([len(d) for d in data], pa.int64()),
        ]

    def token_lengths(self, texts):
        return [len(t.encode("utf-8", "replace")) for t in texts]

    def structured(self, prompts, options):
        out = []
        for p, o in zip(prompts, options, strict=True):
            b, made = (p.encode() or b"\n")[-1], bytearray()
            for _ in range(int(o.get("max_bytes", 32))):
                if not self.found[b]:
                    break
                b = int(self.order[b, 0])
                made.append(b)
            out.append(made.decode("utf-8", "replace"))
        return out


PAIRS = 1 << 20  # counted at once


def bigram_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """before, next, n: how often a byte follows another, over the whole of every text. At most 65,536 rows a task."""
    rows = docs.select(F.encode(F.coalesce(F.col(text_col).cast("string"), F.lit("")), "UTF-8").alias("data"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(65_536, np.int64)
        for b in batches:
            c = b.column(0).cast(pa.large_binary())
            at = np.frombuffer(c.buffers()[1], np.int64)[c.offset : c.offset + len(c) + 1] if len(c) else np.zeros(1, np.int64)
            x = np.frombuffer(c.buffers()[2] or b"", np.uint8)[at[0] : at[-1]] if len(c) else np.zeros(0, np.uint8)
            # pairs within a text: not those of its last byte
            within = np.ones(len(x), bool)
            within[at[1:][np.diff(at) > 0] - at[0] - 1] = False
            for at in range(0, len(x), PAIRS):
                before, after = x[at : at + PAIRS], x[at + 1 : at + PAIRS + 1]
                pairs = before[: len(after)].astype(np.int64) * 256 + after
                total += np.bincount(pairs[within[at : at + len(after)]], minlength=65_536)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen // 256), pa.array(seen % 256), pa.array(total[seen])], ["before", "next", "n"])

    return rows.mapInArrow(run, "before long, next long, n long").groupBy("before", "next").agg(F.sum("n").alias("n"))


def train_bigram(docs: DataFrame, text_col: str = "text") -> ByteBigram:
    table = np.zeros((256, 256), np.int64)
    for r in bigram_counts(docs, text_col).collect():  # at most 65,536 rows
        table[r["before"], r["next"]] = r["n"]
    return ByteBigram(table.tobytes())


# Teachers outside


def _rows_of(tops: list, k: int) -> tuple[list[list[int]], list[list[float]]]:
    """Candidate rows of a completion's top_logprobs: maps from id to log-probability; entries that are not numbers go."""
    ids, lps = [], []
    for entry in tops:
        if entry is None:
            continue
        good = []
        for key, value in entry.items():
            try:
                pair = (-float(value), int(key))
            except (TypeError, ValueError):
                continue
            if math.isfinite(pair[0]):
                good.append(pair)
        if not good:
            raise ValueError("a position has no numeric candidates")
        good.sort()
        ids.append([i for _, i in good[:k]])
        lps.append([-s for s, _ in good[:k]])
    return ids, lps


def entropy_of(logprobs: list[float]) -> float:
    """Of one row, made to sum to one."""
    if not logprobs:
        return 0.0
    x = np.exp(np.array(logprobs) - max(logprobs))
    p = x / x.sum()
    return float(-(p * np.log(np.maximum(p, 1e-12))).sum())


def output_of(ids: list[list[int]], logprobs: list[list[float]], tokens: int | None = None) -> Output:
    each = [entropy_of(r) for r in logprobs]
    full = [e for e, r in zip(each, logprobs, strict=True) if r]
    return Output(ids, logprobs, sum(full) / len(full) if full else 0.0, each, [r[0] - r[1] if len(r) > 1 else 0.0 for r in logprobs], tokens=tokens, per_token_valid_mask=[bool(r) for r in logprobs])


@register("tokenizer_file", Capabilities(topk=False, tokenizer=True))
@dataclass
class TokenizerFile(Teacher):
    """Only a tokenizer: a vocabulary file that executors can read, for token costs without a model. Needs tokenizers there."""

    path: str = ""
    max_context: int | None = None
    name = "tokenizer_file"

    def open(self):
        import tokenizers

        self.tokenizer = tokenizers.Tokenizer.from_file(self.path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()

    def token_lengths(self, texts):
        counts = [len(e.ids) for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]
        return counts if self.max_context is None else [min(n, self.max_context) for n in counts]


#: Fixed values of completion servers: paths that tell about the server; paths and body keys that count tokens, in the order they
#: are tried; and the names under which servers give a prompt's token ids and candidates, and facts about themselves.
PROBES = ("/health", "/v1/models", "/props")
TOKENIZE = ("/tokenize", "/v1/tokenize")
TOKENIZE_KEYS = ("content", "text", "prompt")
ID_FIELDS = ("prompt_token_ids", "token_ids", "tokens_ids")
TOP_FIELDS = ("prompt_top_logprobs", "top_logprobs")
ABOUT = {"version": ("version", "server_version", "llama_cpp_version"), "build": ("build", "build_info", "build_commit"), "context": ("n_ctx", "context_length", "max_context_length")}


def _first(body: Any, names: tuple[str, ...]) -> Any:
    return next((body[n] for n in names if body.get(n) is not None), None) if isinstance(body, dict) else None


def count_of(body: Any) -> int | None:
    """The number of tokens that an answer tells, see functions.completions."""
    for n in COUNTS:
        try:
            return int(_first(body, (n,)))
        except (TypeError, ValueError):
            continue
    found = body if isinstance(body, list) else next((body[n] for n in LISTS if isinstance(body, dict) and isinstance(body.get(n), list)), None)
    return None if found is None else len(found)


@register("llamacpp_server", Capabilities(structured=True, long_context=True, per_token_entropy=True, per_token_top1_gap=True, tokenizer=True), "llamacpp_server")
@dataclass
class CompletionServer(Teacher):
    """A completion server reached by HTTP from every executor. An answer of 5xx, or none, is asked for again, retries times."""

    base_url: str = "http://127.0.0.1:8080"
    timeout: float = 60.0
    max_tokens: int = 32
    max_context: int = 2048
    model: str | None = None
    temperature: float = 0.0
    retries: int = 2
    pause: float = 0.5
    headers: dict[str, str] = field(default_factory=lambda: {"Content-Type": "application/json"})
    name = "llamacpp_server"
    backend = "llamacpp_server"

    def ask(self, path: str, body: dict[str, Any] | None = None) -> Any:
        """The answer's JSON, or its text where it is none; without a body by GET."""
        request = urllib.request.Request(self.base_url.rstrip("/") + path, None if body is None else json.dumps(body).encode(), self.headers)
        for left in range(self.retries, -1, -1):
            try:
                with urllib.request.urlopen(request, timeout=self.timeout) as answer:
                    raw = answer.read()
                break
            except urllib.error.HTTPError as e:
                if e.code < 500 or not left:
                    raise
            except OSError:
                if not left:
                    raise
            time.sleep(self.pause * 2 ** (self.retries - left))
        try:
            return json.loads(raw)
        except ValueError:
            return raw.decode("utf-8", "replace")

    def probes(self) -> tuple[dict[str, Any], dict[str, str]]:
        """Of each probed path its answer, or why there is none."""
        answers, failed = {}, {}
        for path in PROBES:
            try:
                answers[path] = self.ask(path)
            except (OSError, ValueError) as e:
                failed[path] = str(e)
        return answers, failed

    def about(self):
        answers, failed = self.probes()
        told: dict[str, Any] = {"backend": self.backend, "base_url": self.base_url, "endpoints": list(answers), "unreachable": failed}
        for fact, fields in ABOUT.items():
            told[fact] = next((v for a in answers.values() if (v := _first(a, fields)) is not None), None)
        models = answers.get("/v1/models")
        told["model"] = (models.get("data", models) if isinstance(models, dict) else None) or answers.get("/props")
        try:
            self.token_lengths(["a"])
            told["tokenizer"] = True
        except NotImplementedError:
            told["tokenizer"] = False
        return told

    def check(self):
        if self.timeout <= 0 or self.max_context < 1 or not self.base_url:
            return "base_url, timeout > 0 and max_context > 0 are needed"
        answers, failed = self.probes()
        return None if answers else f"{self.base_url} does not answer: {'; '.join(f'{p}: {e}' for p, e in failed.items())}"

    def token_lengths(self, texts):
        return [self._tokens(t) for t in texts]

    def _tokens(self, text: str) -> int:
        failed = []
        for path in TOKENIZE:
            for k in TOKENIZE_KEYS:
                try:
                    n = count_of(self.ask(path, {k: text}))
                except (OSError, ValueError) as e:
                    failed.append(f"{path}: {e}")
                    continue
                if n is not None:
                    return max(0, min(n, self.max_context))
                failed.append(f"{path}: no number of tokens in the answer to {k}")
        raise NotImplementedError(f"{self.base_url} counts no tokens ({'; '.join(failed)})")

    def _body(self, prompt: str, **more: Any) -> dict[str, Any]:
        return {"prompt": prompt, "temperature": self.temperature} | ({"model": self.model} if self.model else {}) | more

    def topk(self, data, k=32):
        out = []
        for d in data:
            answer = self.ask("/v1/completions", self._body(d.decode("utf-8", "replace"), max_tokens=0, echo=True, logprobs=k))
            choices = _first(answer, ("choices",))
            told = _first(choices[0], ("logprobs",)) if isinstance(choices, list) and choices else None
            tokens, tops = _first(told, ID_FIELDS), _first(told, TOP_FIELDS)
            if not isinstance(tokens, list) or not tokens or not isinstance(tops, list):
                raise ValueError("the answer has no token ids or no candidates of the prompt")
            ids, lps = _rows_of(tops, k)
            if len(ids) >= len(tokens):
                raise ValueError(f"the answer has candidates for {len(ids)} positions of {len(tokens)} tokens")
            out.append(output_of(ids, lps, len(tokens)))
        return out

    def structured(self, prompts, options):
        answers = [self.ask("/v1/completions", self._body(p, max_tokens=int(o.get("max_tokens", self.max_tokens)))) for p, o in zip(prompts, options, strict=True)]
        return [a.get("content") or a["choices"][0]["text"] for a in answers]


_loaded: dict[tuple, tuple[Any, Any]] = {}


@register("hf_causal_lm", Capabilities(structured=True, long_context=True, hidden_summary=True, per_token_entropy=True, per_token_top1_gap=True, tokenizer=True), "hf")
@dataclass
class LocalModel(Teacher):
    """A causal language model on the executor; needs torch and transformers there. batch texts go through the model at once,
    padded on the right with id 0 and masked; a worker loads a model once, whatever the number of its tasks."""

    model: str = "distilgpt2"
    max_context: int = 2048
    batch: int = 1
    dtype: str = "float16"
    device: str = "auto"
    hidden: bool = False
    pad_token_id: int | None = None
    name = "hf_causal_lm"
    backend = "hf"

    def check(self):
        import importlib.util

        if not self.model.strip() or self.max_context < 1 or self.batch < 1:
            return "model, max_context > 0 and batch > 0 are needed"
        missing = [m for m in ("torch", "transformers") if importlib.util.find_spec(m) is None]
        return f"not installed: {', '.join(missing)}" if missing else None

    def _tokenizer(self):
        import transformers

        key = (self.model, "tokenizer", self.pad_token_id)
        if key not in _loaded:
            made = transformers.AutoTokenizer.from_pretrained(self.model, padding_side="right")
            if self.pad_token_id is not None:
                made.pad_token_id = self.pad_token_id
            elif made.pad_token_id is None:
                made.pad_token_id = made.eos_token_id
            _loaded[key] = (made, None)
        return _loaded[key][0]

    def open(self):
        import torch
        import transformers

        key = (self.model, self.dtype, self.device)
        if key not in _loaded:
            net = transformers.AutoModelForCausalLM.from_pretrained(self.model, torch_dtype=getattr(torch, self.dtype), device_map=self.device).eval()
            _loaded[key] = (net, torch.inference_mode)
        self.net, self.quiet = _loaded[key]
        self.tokenizer = self._tokenizer()

    def token_lengths(self, texts):
        tokenizer = getattr(self, "tokenizer", None) or self._tokenizer()
        return [len(tokenizer.encode(t, truncation=True, max_length=self.max_context)) for t in texts]

    def topk(self, data, k=32):
        return [o for at in range(0, len(data), self.batch) for o in self._together([d.decode("utf-8", "replace") for d in data[at : at + self.batch]], k)]

    def _together(self, texts: list[str], k: int) -> list[Output]:
        asked = self.tokenizer(texts, return_tensors="pt", padding=True, truncation=True, max_length=self.max_context)
        mask = asked["attention_mask"].to(self.net.device)
        with self.quiet():
            answer = self.net(input_ids=asked["input_ids"].to(self.net.device) * mask, attention_mask=mask, output_hidden_states=self.hidden)
        out = []
        for i in range(len(texts)):
            n = int(mask[i].sum())
            rows = max(n - 1, 0)
            logp = answer.logits[i, :rows].float().log_softmax(-1)
            best = logp.topk(min(k, logp.shape[-1]), -1)
            lps = best.values.tolist()
            each = (-(logp.exp() * logp).sum(-1)).tolist()
            gaps = [r[0] - r[1] if len(r) > 1 else 0.0 for r in lps]
            own = asked["input_ids"][i, :rows].tolist()
            summary = answer.hidden_states[-1][i, :n].float().mean(0).tolist() if self.hidden and n else None
            out.append(Output(best.indices.tolist(), lps, sum(each) / rows if rows else 0.0, each, gaps, own, [True] * rows, summary, n))
        return out

    def structured(self, prompts, options):
        out = []
        for p, o in zip(prompts, options, strict=True):
            asked = self.tokenizer([p], return_tensors="pt", truncation=True, max_length=self.max_context)
            ids = asked["input_ids"].to(self.net.device)
            with self.quiet():
                made = self.net.generate(ids, max_new_tokens=int(o.get("max_tokens", 32)), do_sample=False)
            out.append(self.tokenizer.decode(made[0, ids.shape[1] :], skip_special_tokens=True))
        return out


@register("vllm_causal_lm", Capabilities(structured=True, long_context=True, per_token_entropy=True, per_token_top1_gap=True, tokenizer=True), "vllm")
@dataclass
class EngineModel(Teacher):
    """A model behind a batching engine on the executor; needs vllm there. Positions without candidates are marked not valid."""

    model: str = "distilgpt2"
    max_context: int = 2048
    parallel: int = 1
    dtype: str = "auto"
    memory: float = 0.9
    name = "vllm_causal_lm"
    backend = "vllm"

    def check(self):
        import importlib.util

        return None if importlib.util.find_spec("vllm") else "not installed: vllm"

    def open(self):
        import vllm

        self.vllm = vllm
        self.engine = vllm.LLM(self.model, tensor_parallel_size=self.parallel, dtype=self.dtype, gpu_memory_utilization=self.memory, max_model_len=self.max_context)

    def _ids(self, texts: list[str]) -> list[list[int]]:
        # the engine refuses prompts that leave no room for the one token it must make
        tokenizer = self.engine.get_tokenizer()
        return [tokenizer.encode(t)[: self.max_context - 1] for t in texts]

    def token_lengths(self, texts):
        return [len(ids) for ids in self._ids(texts)]

    def topk(self, data, k=32):
        ask = self.vllm.SamplingParams(max_tokens=1, prompt_logprobs=k, temperature=0)
        out = []
        prompts = self._ids([d.decode("utf-8", "replace") for d in data])
        for answer in self.engine.generate([{"prompt_token_ids": ids} for ids in prompts], ask):
            tops = [{str(i): x.logprob for i, x in (row or {}).items()} for row in answer.prompt_logprobs[1:]]
            pairs = [_rows_of([t], k) if t else ([[]], [[]]) for t in tops]
            out.append(output_of([p[0][0] for p in pairs], [p[1][0] for p in pairs], len(answer.prompt_token_ids)))
        return out

    def structured(self, prompts, options):
        asks = [self.vllm.SamplingParams(max_tokens=int(o.get("max_tokens", 32)), temperature=0) for o in options]
        return [a.outputs[0].text for a in self.engine.generate(prompts, asks)]
