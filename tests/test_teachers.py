import json
import math
import os
import threading
from contextlib import nullcontext
from http.server import BaseHTTPRequestHandler, HTTPServer
from types import SimpleNamespace

import numpy as np
import pytest
from loomwright.operators import chunking
from loomwright.plans import stages, teachers

BPE = "/opt/tokenizers/byte_bpe_50k.json"


@pytest.fixture
def server():
    """A server with canned answers; it fails every first request to a path with 503."""
    asked = []

    class Handler(BaseHTTPRequestHandler):
        def say(self, code, body):
            raw = json.dumps(body).encode()
            self.send_response(code)
            self.end_headers()
            self.wfile.write(raw)

        def do(self, body):
            first = all(p != self.path for p, _ in asked)
            asked.append((self.path, body))
            answers = {"/v1/models": {"data": [{"id": "m"}]}, "/props": {"n_ctx": 512, "build": "b7"}, "/v1/tokenize": {"tokens": [1, 2, 3]} if body and "text" in body else {}}
            if self.path == "/v1/completions":
                words = body["prompt"].split()
                tops = [None] + [{str(i): -0.5 - i, "7": -0.1, "x": 0} for i in range(1, len(words))]
                said = {"choices": [{"text": "made", "logprobs": {"token_ids": list(range(len(words) - (body["prompt"] == "short one"))), "top_logprobs": tops}}]}
                return self.say(503, {}) if first else self.say(200, said)
            if self.path in answers:
                return self.say(503, {}) if first else self.say(200, answers[self.path])
            return self.say(404, {})

        def do_GET(self):  # noqa: N802
            self.do(None)

        def do_POST(self):  # noqa: N802
            self.do(json.loads(self.rfile.read(int(self.headers["Content-Length"]))))

        def log_message(self, *_):
            pass

    http = HTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=http.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{http.server_port}", asked
    http.shutdown()


def test_completion_server(server):
    url, asked = server
    t = teachers.create("llamacpp_server", base_url=url, pause=0.01, model="m", temperature=0.7, max_context=2)
    assert t.check() is None
    about = t.about()
    assert about["endpoints"] == ["/v1/models", "/props"] and list(about["unreachable"]) == ["/health"]
    assert (about["context"], about["build"], about["version"], about["model"], about["tokenizer"]) == (512, "b7", None, [{"id": "m"}], True)
    assert t.token_lengths(["a b c"]) == [2]  # three, cut to the context
    got = t.topk([b"one two three"], 2)[0]
    assert got.ids == [[7, 1], [7, 2]] and got.logprobs == [[-0.1, -1.5], [-0.1, -2.5]] and got.tokens == 3
    assert math.isclose(got.per_token_top1_gap[1], 2.4)
    body = next(b for p, b in asked if p == "/v1/completions")
    assert body == {"prompt": "one two three", "temperature": 0.7, "model": "m", "max_tokens": 0, "echo": True, "logprobs": 2}
    assert t.structured(["p"], [{"max_tokens": 3}]) == ["made"]
    with pytest.raises(ValueError, match="1 positions of 1 tokens"):
        t.topk([b"short one"], 2)
    assert "does not answer" in teachers.create("llamacpp_server", base_url="http://127.0.0.1:9", retries=0).check()
    assert teachers.create("llamacpp_server", timeout=0).check().startswith("base_url")


def test_counts_of_answers():
    bodies = [({"count": 3}, 3), ({"n_tokens": "4"}, 4), ({"count": "x", "tokens": [1]}, 1), ({"token_ids": [1, 2]}, 2), ([5, 6, 7], 3), ({}, None), ("text", None), ({"tokens": 5}, None)]
    assert [teachers.count_of(b) for b, _ in bodies] == [n for _, n in bodies]


class Tensor(np.ndarray):
    """As much of a tensor as the model teacher uses."""

    device = "cpu"

    def to(self, _):
        return self

    def float(self):
        return self

    def log_softmax(self, axis):
        return self - np.log(np.exp(self).sum(axis, keepdims=True))

    def exp(self):
        return np.exp(self)

    def topk(self, k, axis):
        order = np.argsort(-self, axis, kind="stable")[..., :k]
        return SimpleNamespace(values=np.take_along_axis(self, order, axis), indices=order)


def tensor(x):
    return np.asarray(x).view(Tensor)


class Words:
    """Tokens are words; their ids their lengths."""

    def encode(self, text, truncation=True, max_length=None):
        return [len(w) for w in text.split()][:max_length]

    def __call__(self, texts, max_length, padding=False, **_):
        rows = [self.encode(t, max_length=max_length) for t in texts]
        width = max(map(len, rows))
        return {"input_ids": tensor([r + [99] * (width - len(r)) for r in rows]), "attention_mask": tensor([[1] * len(r) + [0] * (width - len(r)) for r in rows])}


def test_local_model_in_batches():
    calls = []

    def net(input_ids, attention_mask, output_hidden_states):
        calls.append(input_ids.shape)
        assert (input_ids[attention_mask == 0] == 0).all()
        logits = np.cos(input_ids[..., None] * 0.7 + np.arange(20) * 1.3)
        return SimpleNamespace(logits=tensor(logits), hidden_states=[tensor(logits[..., :3])] if output_hidden_states else None)

    net.device = "cpu"
    texts = [b"a bb ccc", b"dddd", b"ee f ggg hhhh iiiii", b"jj k"]

    def outputs(batch, hidden=False):
        t = teachers.create("hf_causal_lm", batch=batch, max_context=4, hidden=hidden)
        t.net, t.quiet, t.tokenizer = net, nullcontext, Words()
        return t.topk(texts, 3)

    alone, together = outputs(1), outputs(3)
    assert calls[4:] == [(3, 4), (1, 2)] and [o.tokens for o in together] == [3, 1, 4, 2]
    for a, b in zip(alone, together, strict=True):
        assert a.ids == b.ids and np.allclose(a.entropy, b.entropy) and a.per_token_token_ids == b.per_token_token_ids
        assert len(b.ids) == max(b.tokens - 1, 0) and all(r == sorted(r, reverse=True) for r in b.logprobs)
    assert alone[0].hidden_summary is None and np.allclose(outputs(4, True)[3].hidden_summary, np.cos(np.array([[2.0], [1.0]]) * 0.7 + np.arange(3) * 1.3).mean(0))
    assert teachers.create("hf_causal_lm", batch=0).check() and teachers.create("hf_causal_lm", model=" ").check()


def test_engine_model_cuts_prompts():
    asked = []

    class Engine:
        def get_tokenizer(self):
            return Words()

        def generate(self, prompts, ask):
            asked.extend(prompts)
            for p in prompts:
                ids = p["prompt_token_ids"]
                yield SimpleNamespace(prompt_token_ids=ids, prompt_logprobs=[None, {1: SimpleNamespace(logprob=-0.2), 5: SimpleNamespace(logprob=-0.1)}, None][: len(ids)])

    t = teachers.create("vllm_causal_lm", max_context=4)
    t.engine, t.vllm = Engine(), SimpleNamespace(SamplingParams=lambda **k: k)
    got = t.topk([b"a bb ccc dddd eeeee", b"a"], 2)
    assert [p["prompt_token_ids"] for p in asked] == [[1, 2, 3], [1]] and t.token_lengths(["a b c d e"]) == [3]
    assert got[0].ids == [[5, 1], []] and got[0].per_token_valid_mask == [True, False] and got[0].tokens == 3 and got[1].ids == []


def test_runtimes_are_adapted(spark):
    class Fixed(teachers.Runtime):
        capabilities = teachers.Capabilities(tokenizer=True)

        def __init__(self, n=1):
            self.n = n

        def topk(self, data, k):
            return [teachers.Output([[self.n]], [[0.0]], 0.0) for _ in data]

        def token_lengths(self, texts):
            return [len(t.split()) for t in texts]

    teachers.adapt("fixed", Fixed, Fixed.capabilities)
    t = teachers.create("fixed", n=4)
    assert t.topk([b"x"], 1)[0].ids == [[4]] and t.token_lengths(["a b"]) == [2] and teachers.backend("fixed") == "runtime"
    with pytest.raises(NotImplementedError):
        t.structured(["p"], [{}])
    with pytest.raises(ValueError):
        teachers.require("fixed", "structured_outputs")
    with pytest.raises(NotImplementedError):
        teachers.Dummy().token_lengths(["a"])


@pytest.mark.skipif(not os.path.exists(BPE), reason="no vocabulary file")
def test_token_lengths_by_a_vocabulary_file(spark):
    tokenizers = pytest.importorskip("tokenizers")
    texts = ["", "some words, and some more", "é" * 9, "日本語 x"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    got = stages.token_lengths(chunking.chunk(docs, 100, 0), teachers.create("tokenizer_file", path=BPE), "raw_bytes").collect()
    own = tokenizers.Tokenizer.from_file(BPE)
    assert {(r["doc_id"], r["teacher_input_byte_length"], r["teacher_input_token_length"]) for r in got} == {(i, len(t.encode()), len(own.encode(t, add_special_tokens=False).ids)) for i, t in enumerate(texts) if t}
