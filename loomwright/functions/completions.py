"""Reading completion responses (JSON) into rows of candidates and a token count."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

CANDIDATES = "array<map<string,double>>"
#: Where a response may hold its token ids or their number, in the order they are tried.
COUNTS = ("count", "n_tokens", "token_count")
LISTS = ("tokens", "token_ids")


def top_rows(body: Column, k: int) -> Column:
    """Of choices[0].logprobs.top_logprobs, for each entry that is not null its k best (id, logprob).

    Keys that are not numbers and values that are not finite are passed over; an entry with nothing left makes the result null.
    """
    entries = F.filter(F.from_json(F.get_json_object(body, "$.choices[0].logprobs.top_logprobs"), CANDIDATES), lambda m: m.isNotNull())

    def best(m: Column) -> Column:
        pairs = F.transform(F.map_entries(m), lambda e: F.struct((-e["value"]).alias("down"), e["key"].try_cast("long").alias("id")))
        good = F.filter(pairs, lambda p: p["id"].isNotNull() & p["down"].isNotNull() & ~F.isnan(p["down"]) & (F.abs(p["down"]) < float("inf")))
        return F.transform(F.slice(F.array_sort(good), 1, k), lambda p: F.struct(p["id"].alias("id"), (-p["down"]).alias("logprob")))

    rows = F.transform(entries, best)
    return F.when(~F.exists(rows, lambda r: F.size(r) == 0), rows)


def token_count(body: Column) -> Column:
    """The number of tokens: a count field, else the length of a list field, else of the response if it is a list itself."""
    counts = [F.get_json_object(body, f"$.{f}").try_cast("int") for f in COUNTS]
    lists = [F.json_array_length(F.get_json_object(body, f"$.{f}")) for f in LISTS]
    return F.coalesce(*counts, *lists, F.json_array_length(body))


def prompt_tokens(body: Column) -> Column:
    """choices[0].logprobs.prompt_token_ids."""
    return F.from_json(F.get_json_object(body, "$.choices[0].logprobs.prompt_token_ids"), "array<long>")


def completion_text(body: Column) -> Column:
    return F.coalesce(*(F.get_json_object(body, p) for p in ("$.content", "$.completion", "$.choices[0].text", "$.choices[0].message.content")))
