"""Prompt templates as column expressions."""

from __future__ import annotations

from collections.abc import Callable
from typing import Any, NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import lossy

#: The wording of each template. {0} is its parameter, {doc}, {chunk} and {text} come from the row.
WORDING = {
    "summarize_chunk": "Summarize the following chunk in at most {0} words.\nDocument: {doc}\nChunk: {chunk}\n\nChunk text:\n{text}\n",
    "answer_question_from_chunk": "Answer the question using only the provided chunk.\nQuestion: {0}\nDocument: {doc}\nChunk: {chunk}\n\nChunk text:\n{text}\n",
    "continue_document": "Continue the document naturally for about {0} tokens.\nDocument: {doc}\nChunk: {chunk}\n\nCurrent excerpt:\n{text}\n",
    "extract_key_points": "Extract up to {0} key points from the chunk as concise bullet points.\nDocument: {doc}\nChunk: {chunk}\n\nChunk text:\n{text}\n",
}
#: Each template's parameter and its default.
PARAMETERS: dict[str, tuple[str, Any]] = {
    "summarize_chunk": ("max_words", 120),
    "answer_question_from_chunk": ("question", "What is the most important information in this chunk?"),
    "continue_document": ("continuation_tokens", 128),
    "extract_key_points": ("max_points", 5),
}


class Template(NamedTuple):
    name: str
    parameter: str
    default: Any


Builder = Callable[[Template, dict[str, Any]], Column]


def names() -> list[str]:
    return sorted(WORDING)


def template(name: str) -> Template:
    if name not in WORDING:
        raise ValueError(f"unknown template {name}; there are {', '.join(names())}")
    return Template(name, *PARAMETERS[name])


def prompt(name: str, options: dict[str, Any] | None = None, doc: str = "doc_id", chunk: str = "chunk_index", raw: str = "raw_bytes") -> Column:
    """The prompt text of a row."""
    t = template(name)
    value = (options or {}).get(t.parameter, t.default)
    value = type(t.default)(value)
    holes = {"doc": F.coalesce(F.col(doc).cast("string"), F.lit("None")), "chunk": F.coalesce(F.col(chunk).cast("string"), F.lit("None")), "text": lossy(F.col(raw))}
    parts: list[Column] = []
    rest = WORDING[name].replace("{0}", str(value).replace("{", "\0"))
    for piece in rest.split("{"):
        hole, closed, tail = piece.partition("}")
        if closed and hole in holes:
            parts += [holes[hole], F.lit(tail.replace("\0", "{"))]
        else:
            parts.append(F.lit(piece.replace("\0", "{")))
    return F.concat(*parts)


def prompt_record(name: str, options: dict[str, Any] | None = None, deterministic: bool = True) -> Column:
    """task_type, prompt_text, template_name, template_options, deterministic as one struct."""
    t = template(name)
    used = {t.parameter: (options or {}).get(t.parameter, t.default)}
    return F.struct(
        F.lit(name).alias("task_type"),
        prompt(name, options).alias("prompt_text"),
        F.lit(name).alias("template_name"),
        F.create_map(*(F.lit(str(x)) for kv in used.items() for x in kv)).alias("template_metadata"),
        F.lit(bool(deterministic)).alias("deterministic"),
    )
