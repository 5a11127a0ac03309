"""Document fingerprints by I-Match, in DataFrame functions only.

Terms are lower-cased runs of letters and digits, kept as 64-bit hashes. Document frequencies are counted over all documents
for each term, however many the corpus has. The lexicon holds the terms whose inverse document frequency, as a share of
log(number of documents), lies in a band. While they number at most LEXICON_TERMS they are sent to all tasks, in buckets of
about BUCKET; beyond that the distinct terms of the distinct texts are joined with them. A text's distinct terms of the lexicon,
sorted, are hashed whole and within randomised subsets of the lexicon: twice
GROUPS independent families of nested subsets, each half of the one before, drawn by the bits of the term's hash and of a
second hash. Small subsets survive edits, large ones tell apart texts that share much.

A fingerprint is the hashes in order, apart by spaces: WHOLE hex digits of the whole, DIGITS of each subset, - for one that has
none of the text's terms. The likeness of two fingerprints is the share of equal hashes among the subsets that have terms of either. Ids must be numbers.

Cases: a null text is empty; a text without terms in the lexicon has one hash, SHA-256 of the text itself, so only equal texts
are alike; repeated rows each get the same fingerprint, and rows that share an id, or have none, have one next document; a very
long text is hashed whole; an empty table gives an empty result; other columns, whatever their names, do not matter.
"""

from __future__ import annotations

import math
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import no_text, salted_join, saved

#: Terms of the lexicon in a bucket, on average, and rows that the buckets are gathered into.
BUCKET, PARTS = 4, 4_096
#: At most so many terms, of about 14 bytes each, go to every task.
LEXICON_TERMS = 4_000_000
BAND = (0.2, 0.8)
GROUPS, LEVELS = 5, 12
DIGITS, WHOLE = 8, 16
EMPTY = "-" * DIGITS
RANGES, RANGE_ROWS = 65_536, 2_000


def terms(text: Column) -> Column:
    """Distinct 64-bit hashes of the terms."""
    words = F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")
    return F.array_distinct(F.transform(words, lambda w: F.xxhash64(w)))


class Lexicon(NamedTuple):
    """The terms in the band: as a table of one column, term, and, unless they are too many, as one row with _lexicon, an array of
    buckets, a power of two; a term is in the bucket of its lower bits."""

    terms: DataFrame
    row: DataFrame | None


def lexicon(docs: DataFrame, text_col: str = "text", band: tuple[float, float] = BAND) -> Lexicon:
    spark = docs.sparkSession
    n = docs.count()
    df = docs.select(F.explode(terms(no_text(text_col))).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    log_n = math.log(max(n, 2))
    idf = (F.lit(log_n) - F.log("df")) / log_n
    words = saved(df.filter(idf.between(*band)).select("term"), "imatch-terms")
    if (size := words.count()) > LEXICON_TERMS:
        return Lexicon(words, None)
    buckets = 1 << max(0, math.ceil(math.log2(max(size, 1) / BUCKET)))
    each = words.groupBy(F.col("term").bitwiseAND(buckets - 1).alias("i")).agg(F.sort_array(F.collect_list("term")).alias("terms"))
    whole = spark.range(buckets).select(F.col("id").alias("i")).join(each, "i", "left").select("i", F.coalesce("terms", F.array().cast("array<bigint>")).alias("terms"))

    def gathered(i: Column, x: str) -> Column:
        return F.transform(F.array_sort(F.collect_list(F.struct(i.alias("i"), F.col(x).alias("x")))), lambda r: r["x"])

    parts = whole.groupBy(F.floor(F.col("i") / max(1, buckets // PARTS)).alias("part")).agg(gathered(F.col("i"), "terms").alias("listed"))
    return Lexicon(words, saved(parts.agg(F.flatten(gathered(F.col("part"), "listed")).alias("_lexicon")), "imatch-lexicon"))


def bound(value: Column, body) -> Column:
    """body(value), with value computed once however often body uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _hash(ts: Column) -> Column:
    digits = F.hex(F.xxhash64(ts).bitwiseAND((1 << 4 * DIGITS) - 1).bitwiseOR(1 << 4 * DIGITS))
    return F.when(F.size(ts) > 0, F.substring(digits, 2, DIGITS)).otherwise(F.lit(EMPTY))


def _families() -> Column:
    """For each family the bits of its levels, as literals: nothing but a term's own bit is left to do for each term."""
    return F.array(*(F.array(*(F.lit(1 << g * LEVELS + level).cast("long") for level in range(LEVELS))) for g in range(GROUPS)))


def _subsets(terms_: Column, bits: Column) -> Column:
    """The hashes of LEVELS nested subsets of sorted terms, each after a space: each keeps the terms of the one before whose next bit
    is 0. They are gathered as a string, since to append to an array costs more than all filters."""

    def step(acc: Column, bit: Column) -> Column:
        kept = F.filter(acc["t"], lambda t: t.bitwiseAND(bit) == F.lit(0).cast("long"))
        return bound(kept, lambda k: F.struct(k.alias("t"), F.concat(acc["h"], F.lit(" "), _hash(k)).alias("h")))

    start = F.struct(terms_.alias("t"), F.lit("").alias("h"))
    return F.aggregate(bits, start, step, lambda acc: acc["h"])


def _print(text: Column, known: Column) -> Column:
    """The fingerprint of a text that has these terms of the lexicon."""

    def parts(x: Column) -> Column:
        whole = F.when(F.size(x["a"]) > 0, F.lpad(F.hex(F.xxhash64(x["a"])), WHOLE, "0")).otherwise(F.upper(F.sha2(text, 256)))
        families = F.flatten(F.transform(F.array(x["a"], x["b"]), lambda own: F.transform(_families(), lambda bits: _subsets(own, bits))))
        return F.concat(whole, F.array_join(families, ""))

    return bound(F.sort_array(known), lambda s: bound(F.struct(s.alias("a"), F.sort_array(F.transform(s, lambda t: F.xxhash64(t))).alias("b")), parts))


def with_print(df: DataFrame, text: str, name: str, words: Lexicon) -> DataFrame:
    """df with the fingerprint of column text; df has no column _lexicon or _known."""
    if words.row is not None:

        def known(w: Column) -> Column:
            # exists, as array_contains leaves its loop by an exception for each term found
            return bound((F.size(w) - 1).cast("long"), lambda last: F.filter(terms(F.col(text)), lambda t: F.exists(F.get(w, t.bitwiseAND(last).cast("int")), lambda x: x == t)))

        # named once, or each row would carry a copy of the lexicon
        return df.withColumn("_lexicon", words.row.scalar()).withColumn(name, _print(F.col(text), bound(F.col("_lexicon"), known))).drop("_lexicon")
    key = [F.xxhash64(F.lit(i), F.col(text)).alias(f"_t{i}") for i in (1, 2)]
    texts = df.select(*key, terms(F.col(text)).alias("_terms")).dropDuplicates(["_t1", "_t2"])
    known = texts.select("_t1", "_t2", F.explode("_terms").alias("term")).join(words.terms, "term").groupBy("_t1", "_t2").agg(F.collect_list("term").alias("_known"))
    keyed = df.withColumns({f"_t{i}": k for i, k in zip((1, 2), key, strict=True)})
    found = salted_join(keyed, known, ["_t1", "_t2"], F.monotonically_increasing_id())
    return found.withColumn(name, _print(F.col(text), F.coalesce("_known", F.array().cast("array<bigint>")))).drop("_known", "_t1", "_t2")


def likeness(a: Column, b: Column) -> Column:
    """Share of equal hashes among those that either fingerprint has."""

    def cut(x: Column) -> Column:
        return F.split(x, " ")

    def share(pairs: Column) -> Column:
        return F.size(F.filter(pairs, lambda p: p["a"] == p["b"])) / F.size(pairs)

    def compared(x: Column) -> Column:
        return bound(F.filter(F.arrays_zip(cut(x["a"]).alias("a"), cut(x["b"]).alias("b")), lambda p: (p["a"] != EMPTY) | (p["b"] != EMPTY)), share)

    return bound(F.struct(a.alias("a"), b.alias("b")), compared)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", band: tuple[float, float] = BAND) -> DataFrame:
    """One row for each document: id, fingerprint."""
    rows = docs.select(F.col(id_col).alias("_id"), no_text(text_col).alias("_text"))
    return with_print(rows, "_text", "fingerprint", lexicon(docs, text_col, band)).select(F.col("_id").alias(id_col), "fingerprint")


def _cuts(ids: DataFrame) -> DataFrame | None:
    """One row with _cuts, at most RANGES - 1 sorted ids that cut the table into ranges of about RANGE_ROWS rows or more."""
    ranges = min(RANGES, -(-ids.count() // RANGE_ROWS))
    if ranges < 2:
        return None
    shares = F.split(F.lit(",".join(repr(i / ranges) for i in range(1, ranges))), ",").cast("array<double>")
    at = F.percentile_approx("_id", shares, 10 * ranges)
    return saved(ids.agg(F.array_distinct(F.coalesce(at, F.array().cast(f"array<{dict(ids.dtypes)['_id']}>"))).alias("_cuts")), "imatch-cuts")


def _range(i: Column, cuts: Column) -> Column:
    """The number of cuts that are not above i, by a search in two steps; null is below all."""
    step = F.greatest(F.lit(1), F.ceil(F.sqrt(F.size(cuts))).cast("int"))

    def searched(x: Column) -> Column:
        firsts = F.transform(F.sequence(F.lit(0), F.size(x["c"]) - 1, x["s"]), lambda k: F.element_at(x["c"], k + 1))
        block = F.greatest(F.size(F.filter(firsts, lambda c: c <= i)) - 1, F.lit(0)) * x["s"]
        return bound(block, lambda b: b + F.size(F.filter(F.slice(x["c"], b + 1, x["s"]), lambda c: c <= i)))

    return F.when(i.isNull() | (F.size(cuts) == 0), 0).otherwise(bound(F.struct(cuts.alias("c"), step.alias("s")), searched))


def _followed(chain: DataFrame, words: Lexicon) -> DataFrame:
    """chain (_id, each once, _text and others) with _print and _next, the text and fingerprint of the next smaller id, after the last of
    the greatest. Texts are shuffled once, to ranges of ids whose cuts are computed beforehand; what a range needs from the one
    before is at most RANGES documents, looked up apart."""
    spark = chain.sparkSession
    cuts = _cuts(chain.select("_id"))
    if cuts is None:
        rows = chain.withColumn("_range", F.lit(0))
    else:
        rows = chain.withColumn("_cuts", cuts.scalar()).withColumn("_range", _range(F.col("_id"), F.col("_cuts"))).drop("_cuts")
    last = sorted((r["_range"], r["top"]) for r in rows.groupBy("_range").agg(F.max("_id").alias("top")).collect())
    before = spark.createDataFrame([(part, last[i - 1][1]) for i, (part, _) in enumerate(last)], f"_range int, _before {dict(rows.dtypes)['_id']}")
    heads = rows.select("_id", "_text").join(F.broadcast(before), F.col("_id").eqNullSafe(F.col("_before"))).select("_range", "_text")
    heads = saved(with_print(heads, "_text", "_print", words).select("_range", F.struct("_text", "_print").alias("_head")), "imatch-heads", len(last))
    order = Window.partitionBy("_range").orderBy(F.col("_id").asc_nulls_first())
    stepped = with_print(rows, "_text", "_print", words).withColumn("_near", F.lag(F.struct("_text", "_print")).over(order))
    return stepped.join(F.broadcast(heads) if len(last) <= RANGE_ROWS else heads, "_range", "left").withColumn("_next", F.coalesce("_near", "_head")).drop("_near", "_head", "_range")


def compare_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", band: tuple[float, float] = BAND) -> DataFrame:
    """One row for each document: id, n_chars, edited text, its fingerprint, that of the edited text, near_edited, near_next.

    The edited text ends in the beginning of the next document, in descending id (after the last: the first): the last n_chars // 2
    code points give way to as many of it, or all. Where rows share an id, the next document is the one of the next smaller
    id whose text has the least hash; null is the smallest id. Of an id that several rows have, one text takes its place in the
    order; all its rows get the next document by a join that splits hot ids.
    """
    words = lexicon(docs, text_col, band)
    key = F.coalesce(F.concat(F.lit("="), F.col(id_col).cast("string")), F.lit("")).alias("_key")
    rows = docs.select(F.col(id_col).alias("_id"), no_text(text_col).alias("_text"), key).withColumn("_tie", F.xxhash64("_text"))
    repeated = saved(rows.groupBy("_key").agg(F.min("_tie").alias("_least"), F.count(F.lit(1)).alias("_n")).filter("_n > 1").select("_key", "_least"), "imatch-repeated")
    if repeated.limit(1).count() == 0:
        done = _followed(rows.select("_id", "_text"), words)
    else:
        known = salted_join(rows, repeated, ["_key"], F.col("_tie"))
        many = known.filter("_least is not null").select("_id", "_text", "_key", "_tie", "_least")
        heads = many.filter("_tie = _least").groupBy("_key").agg(F.first("_id").alias("_id"), F.first("_text").alias("_text"))
        chain = known.filter("_least is null").select("_id", "_text", "_key", F.lit(True).alias("_only")).unionByName(heads.withColumn("_only", F.lit(False)))
        placed = saved(_followed(chain, words), "imatch-chain")
        theirs = salted_join(many.select("_id", "_text", "_key", "_tie"), placed.filter("not _only").select("_key", "_print", "_next"), ["_key"], F.col("_tie")).drop("_print")
        done = placed.filter("_only").select("_id", "_text", "_print", "_next").unionByName(with_print(theirs, "_text", "_print", words).select("_id", "_text", "_print", "_next"))
    half = F.expr("int(length(_text) div 2)")
    kept = F.expr("substring(_text, 1, length(_text) - int(length(_text) div 2))")
    edited = done.withColumn("_edited", F.concat(kept, F.substring(F.col("_next._text"), F.lit(1), half)))
    told = with_print(edited, "_edited", "_eprint", words)
    return told.select(
        F.col("_id").alias(id_col), F.length("_text").cast("long").alias("n_chars"), F.col("_edited").alias("edited"), F.col("_print").alias("fingerprint"),
        F.col("_eprint").alias("edited_fingerprint"), likeness(F.col("_print"), F.col("_eprint")).alias("near_edited"), likeness(F.col("_print"), F.col("_next._print")).alias("near_next"),
    )
