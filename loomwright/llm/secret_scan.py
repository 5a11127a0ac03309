"""Secret scans with corpus-wide ownership frequency, in DataFrame functions only.

A text is cut at the matches of a kind's pattern; the lengths of the gaps and matches give the places in code points. Kinds in
BASE are always reported. Kinds in ADDED are looser, so their candidates are judged by ownership: each value's hash is counted
over the distinct owners and repositories of the whole corpus. A value that more than MAX_OWNERS owners and more than
MAX_REPOS repositories have is taken for a widely copied example; all others look live and are reported. Copies of one text
count as one repository, so a leaked credential stays live however often its text was copied. The counts of base spans are told too.

The counts are made in two steps (distinct pairs, then counts), so a value that a third of all rows hold is summed by many
tasks. Verdicts are looked up by the set of values of a text, each distinct set once; the rows of a set that very many texts
have are dealt to several tasks, and whole rows are only ever shuffled by a key of their own.

Cases: a null text is empty and has no spans; a null owner or repository counts for nothing, and a value with no known owner
is taken for live; repeated rows each get their spans; a very long text is searched whole, in its row; of spans that begin at
one place the kind listed first comes first; an empty table gives an empty result; other columns do not matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import no_text, salted_join, saved

#: Kind, pattern, group of the value, least length of that group.
BASE = [
    ("assign", r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    ("access", r"AKIA[A-Z0-9]+", 0, 20),
    ("hex", r"[0-9a-f]+", 0, 24),
]
ADDED = [
    ("bearer", r"[Bb]earer\x20+([A-Za-z0-9._~+/-]+=*)", 1, 20),
    ("hosted", r"gh[pousr]_[A-Za-z0-9]+", 0, 24),
    ("jwt", r"eyJ[A-Za-z0-9_-]+[.]eyJ[A-Za-z0-9_-]+[.][A-Za-z0-9_-]+", 0, 40),
    ("live", r"[sr]k_live_[A-Za-z0-9]+", 0, 20),
    ("chat", r"xox[abprs]-[A-Za-z0-9-]+", 0, 20),
    ("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----[^-]+-----END [A-Z ]*PRIVATE KEY-----", 0, 60),
]
#: A cheap test of a pattern; where it fails there is no span. Runs are asked for at once at their least length.
QUICK = {"hex": r"[0-9a-f]{24}", "access": r"AKIA[A-Z0-9]{16}", "assign": r"(?i)(?:word|passwd|secret|token|key)[\"']?\x20*[:=]"}
MAX_OWNERS, MAX_REPOS = 2, 8


def _spans(text: Column, order: int, kind: str, pattern: str, group: int, least: int) -> Column:
    """Spans of one kind: leftmost matches that do not overlap; those whose group is too short are dropped after matching."""
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else whole
    cut = F.arrays_zip(F.split(text, pattern, -1).alias("gap"), whole.alias("m"), value.alias("v"))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,kind_order:int,end:int,kind:string,value:string>>").alias("found"))

    def step(acc: Column, x: Column) -> Column:
        begin = acc["at"] + F.length(x["gap"])
        end = begin + F.length(x["m"])
        span = F.struct(begin.alias("start"), F.lit(order).alias("kind_order"), end.alias("end"), F.lit(kind).alias("kind"), x["v"].alias("value"))
        return F.struct(F.coalesce(end, begin).alias("at"), F.when(F.length(x["v"]) >= least, F.concat(acc["found"], F.array(span))).otherwise(acc["found"]).alias("found"))

    folded = F.aggregate(cut, start, step, lambda acc: acc["found"])
    return F.when(text.rlike(QUICK.get(kind, pattern)), folded).otherwise(F.array().cast("array<struct<start:int,kind_order:int,end:int,kind:string,value:string>>"))


def find(text: Column) -> Column:
    """All candidates of a text, base kinds and added ones, by start and then kind."""
    kinds = [*BASE, *ADDED]
    return F.array_sort(F.concat(*(_spans(text, i, *k) for i, k in enumerate(kinds))))


def any_candidate(text: Column) -> Column:
    return F.coalesce(text.rlike("|".join(f"(?:{QUICK.get(k, p)})" for k, p, *_ in [*BASE, *ADDED])), F.lit(False))


def _hashes(found: Column | str) -> Column:
    return F.transform(found, lambda x: F.sha2(x["value"], 256))


def ownership(found: DataFrame) -> DataFrame:
    """Of a table _found, _owner, _repo, _copy (a hash of the text): for each value's hash the number of owners, and of
    repositories, copies of one text counted once, that have it."""
    values = found.filter(F.size("_found") > 0).select("_owner", "_repo", "_copy", F.explode(F.array_distinct(_hashes("_found"))).alias("_value"))

    def number(column: str, name: str) -> DataFrame:
        return values.select("_value", column).distinct().groupBy("_value").agg(F.count(column).alias(name))

    counted = number("_owner", "owners").join(number("_repo", "repos"), "_value").join(number("_copy", "copies"), "_value")
    return counted.select("_value", "owners", F.least("repos", "copies").alias("repos"))


def _verdicts(found: DataFrame) -> DataFrame:
    """For each distinct set of values, _set: a map from a value's hash to its owners and repositories."""
    sets = found.filter(F.size("_found") > 0).select("_set", _hashes("_found").alias("_values")).dropDuplicates(["_set"])
    each = sets.select("_set", F.explode(F.array_distinct("_values")).alias("_value"))
    return each.join(ownership(found), "_value").groupBy("_set").agg(F.map_from_entries(F.collect_list(F.struct("_value", F.struct("owners", "repos").alias("known")))).alias("_counts"))


def _candidates(docs: DataFrame, id_col: str, text_col: str, owner_col: str, repo_col: str, *more: Column) -> DataFrame:
    """Candidates of every text, with _key, a number of the row, and _set, a hash of the text's values."""
    text = no_text(text_col)
    rows = docs.select(F.col(id_col).alias("_id"), F.col(owner_col).alias("_owner"), F.col(repo_col).alias("_repo"), F.xxhash64(text).alias("_copy"), find(text).alias("_found"), *more)
    return rows.withColumn("_key", F.monotonically_increasing_id()).withColumn("_set", F.sha2(F.array_join(_hashes("_found"), ","), 256))


def _judged(found: DataFrame) -> DataFrame:
    """_key and spans, the candidates with owners, repos and example, of the rows that have any; found: a written table."""
    have = found.filter(F.size("_found") > 0)
    known = salted_join(have.select("_key", "_set", "_found"), _verdicts(found), ["_set"], F.col("_key"))

    def told(x: Column) -> Column:
        def judged(k: Column) -> Column:
            owners, repos = F.coalesce(k["owners"], F.lit(0)), F.coalesce(k["repos"], F.lit(0))
            example = (owners > MAX_OWNERS) & (repos > MAX_REPOS)
            return F.struct(*(x[c].alias(c) for c in ("start", "kind_order", "end", "kind")), owners.alias("owners"), repos.alias("repos"), example.alias("example"))

        return F.element_at(F.transform(F.array(F.try_element_at("_counts", F.sha2(x["value"], 256))), judged), 1)

    return known.select("_key", F.transform("_found", told).alias("spans"))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source", repo_col: str = "doc_id") -> DataFrame:
    """One row for each document: id and spans, an array of start, kind_order, end, kind, owners, repos, example, by start and then
    kind; of the added kinds only what looks live."""
    found = saved(_candidates(docs, id_col, text_col, owner_col, repo_col), "secret-candidates")
    judged = _judged(found)
    reported = F.filter("spans", lambda x: (x["kind_order"] < len(BASE)) | ~x["example"])
    none = F.array().cast(judged.schema["spans"].dataType)
    return found.select("_key", "_id").join(judged, "_key", "left").select(F.col("_id").alias(id_col), F.coalesce(reported, none).alias("spans"))


def mask(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source", repo_col: str = "doc_id") -> DataFrame:
    """The documents with every candidate replaced: by <secret> if it looks live, by <example> if it is widely copied.

    Only documents that have a candidate are shuffled, each by its own number; the others stay where they are. Spans that
    overlap become one.
    """
    has = any_candidate(F.col(text_col))
    hot = saved(_candidates(docs.filter(has), id_col, text_col, owner_col, repo_col, F.struct(*(docs[c] for c in docs.columns)).alias("_row")), "secret-rows")
    done = hot.select("_key", "_row", no_text(f"_row.{text_col}").alias("_text")).join(_judged(hot), "_key", "left")
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(acc: Column, x: Column) -> Column:
        gap = F.substring(F.col("_text"), acc["at"] + 1, x["start"] - acc["at"])
        mark = F.when(x["example"], F.lit("<example>")).otherwise(F.lit("<secret>"))
        return F.struct(F.greatest(acc["at"], x["end"]).alias("at"), F.when(x["start"] >= acc["at"], F.concat(acc["out"], gap, mark)).otherwise(acc["out"]).alias("out"))

    rest = F.expr("substring(_text, _folded.at + 1)")
    done = done.withColumn("_folded", F.aggregate("spans", start, step)).withColumn("_masked", F.when(F.size("spans") > 0, F.concat("_folded.out", rest)).otherwise(F.col(f"_row.{text_col}")))
    masked = done.select(*((F.col("_masked") if c == text_col else F.col(f"_row.{c}")).alias(c) for c in docs.columns))
    return docs.filter(~has).unionByName(masked)
