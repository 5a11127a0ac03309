"""N-gram Jaccard join: which documents share 80 of 100 word shingles, and the groups that such links form.

The answer is exact, but for the chance that two shingles, or two sets, have one 64-bit hash. A document's set is its distinct shingles (see shingles.py) in the order of their hashes, and documents
with equal sets are one class. Any partner of a class of n shingles shares at least ceil(0.8 n) of them, so:

1. Of a class's first n - ceil(0.8 n) + 1 + SLACK n shingles in hash order, every partner has at least 1 + SLACK n. The shingles
   are dealt out by key to see which ones another class has too, and classes with fewer drop out: most documents.
2. Among the rest the frequency of every shingle is counted, and classes of which fewer than ceil(0.8 n) shingles are shared
   drop out. With the rarest shingles first, partners share one of the first n - ceil(0.8 n) + 1.
3. The classes of such a rare shingle are compared in tiles: first with one of them (a hub), which joins groups of copies of
   any size in a number of comparisons in proportion to it; then, where classes of different groups still meet, group
   against group, in blocks by size that hold a bounded number of shingles.
4. In a tile, classes are banded by size; each has a bitmap of hashed shingles as wide as its band. The bits that only one
   of two bitmaps has bound their overlap from above; what passes is settled by intersecting the sorted arrays.

A link within a group that is already joined is not looked for again, so links() returns enough links to join every group, not
all pairs; link_counts() looks at all pairs of classes within a group, which is quadratic in the group's classes. Shuffled rows are single shingles or one array for each tile; frequent shingles are sent twice by each task at
most, and no list of a shingle is ever gathered whole unless it has few groups.

Cases: texts that are null, empty or blank have an empty set and link with nothing; repeated rows are in one class; null ids
take part and a group's id is its smallest that is not null; an empty table gives an empty result; other columns do not matter.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import fresh, saved, small
from .components import components
from .shingles import shingle_sets

SLACK = 0.1
#: Shingles in a block of a tile's left and right side; a class counts for LIGHT at least, so a block has few classes too.
BLOCK, PARTNERS, LIGHT = 1 << 17, 1 << 19, 256
#: A shingle that this many groups still share is a tile of its own instead of pairs of groups.
MANY_GROUPS = 64
#: A filter of this many bits, whatever the input, tells which documents are read again; others may pass, none is missed.
FILTER_BITS = 1 << 24
#: Shingle keys that a task holds before it sends them: some 60 MB with their sort.
FLUSH = 1 << 20
#: Sizes of one band differ by less than this factor.
SIZE_BAND = 1.25
KEY_SHIFT = np.uint64(20)


def least_common(n):
    """The fewest shingles that a partner shares with a class of n."""
    return (80 * n + 99) // 100


def first_shingles(n: int, slack: float) -> int:
    return min(n, n - least_common(n) + 1 + int(slack * n))


def _class(s: np.ndarray) -> int:
    return int(np.uint64(xxhash.xxh3_64_intdigest(s.tobytes())).astype(np.int64))


def row_key(id_col: str, text_col: str) -> list[Column]:
    """_k1, _k2: 128 bits that rows with one id and one text share."""
    own = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (id_col, text_col)]
    return [F.xxhash64(F.lit(i), F.col(id_col).isNull(), *own).alias(f"_k{i}") for i in (1, 2)]


def _rows(docs: DataFrame, id_col: str, text_col: str, *more: Column) -> DataFrame:
    return docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("_text"), *more)


def _parts(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)


def sets(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """_id, n (size of the set), cls (hash of the set), _k1 and _k2 (row_key) of every document."""
    rows = _rows(docs, id_col, text_col, *row_key(id_col, text_col))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _parts(batches):
            found = shingle_sets(b.column(1))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([len(s) for s in found], pa.int64()), pa.array([_class(s) for s in found], pa.int64()), b.column(2), b.column(3)], ["_id", "n", "cls", "_k1", "_k2"]
            )

    return rows.mapInArrow(run, f"_id {dict(rows.dtypes)['_id']}, n long, cls long, _k1 long, _k2 long")


def _first_postings(docs: DataFrame, id_col: str, text_col: str, slack: float) -> DataFrame:
    """key, cls, known: the first shingles of each class. A task sends a key for two classes at most; of the others, which
    certainly share it, it sends how many such keys they have (known, under a key of their own)."""

    def flush(keys: list[np.ndarray], owners: list[int]) -> pa.RecordBatch:
        key = np.concatenate(keys)
        owner = np.repeat(np.array(owners, np.int64), [len(k) for k in keys])
        order = np.argsort(key, kind="stable")
        k = key[order]
        new = np.append(True, k[1:] != k[:-1])
        place = np.arange(len(k)) - np.maximum.accumulate(np.where(new, np.arange(len(k)), 0))
        sent = np.zeros(len(k), bool)
        sent[order] = place < 2
        more, count = np.unique(owner[~sent], return_counts=True)
        own_key = -1 - (more.view(np.uint64) >> KEY_SHIFT).astype(np.int64)
        return pa.RecordBatch.from_arrays(
            [pa.array(np.append(key[sent].astype(np.int64), own_key)), pa.array(np.append(owner[sent], more)), pa.array(np.append(np.zeros(int(sent.sum()), np.int32), count.astype(np.int32)))],
            ["key", "cls", "known"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        keys, owners, held = [], [], 0
        for b in _parts(batches):
            for s in shingle_sets(b.column(1)):
                if not len(s) or (c := _class(s)) in seen:
                    continue
                seen.add(c)
                keys.append(s[: first_shingles(len(s), slack)] >> KEY_SHIFT)
                owners.append(c)
                held += len(keys[-1])
            if held > FLUSH:
                yield flush(keys, owners)
                keys, owners, held = [], [], 0
        if keys:
            yield flush(keys, owners)

    return _rows(docs, id_col, text_col).mapInArrow(run, "key long, cls long, known int")


def _slot(c: Column) -> Column:
    return F.pmod(F.xxhash64(c), F.lit(FILTER_BITS))


def _signatures(docs: DataFrame, id_col: str, text_col: str, chosen: DataFrame) -> DataFrame:
    """cls, n, keys (all shingles, sorted) of the classes whose first document is in chosen (_id), and of a few others."""
    words = chosen.select(_slot(F.col("_id")).alias("s")).groupBy(F.shiftright("s", 5).alias("i")).agg(F.bit_or(F.expr("shiftleft(1L, int(s & 31))")).alias("w")).toArrow()
    bits = np.zeros(FILTER_BITS >> 5, np.uint32)  # of a fixed size
    bits[words["i"].to_numpy()] = words["w"].to_numpy().astype(np.uint32)
    rows = _rows(docs, id_col, text_col).select(_slot(F.col("_id")).alias("_slot"), "_text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for b in _parts(batches, 1024):
            s = b.column(0).to_numpy()
            b = b.filter(pa.array((bits[s >> 5] >> (s & 31).astype(np.uint32)) & 1 == 1))
            for part in _parts([b]):
                own, arrays = [], []
                for x in shingle_sets(part.column(1)):
                    if len(x) and (c := _class(x)) not in seen:
                        seen.add(c)
                        own.append(c)
                        arrays.append(x.view(np.int64))
                if own:
                    at = np.cumsum([0, *map(len, arrays)])
                    yield pa.RecordBatch.from_arrays([pa.array(own, pa.int64()), pa.array(np.diff(at)), pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(np.concatenate(arrays)))], ["cls", "n", "keys"])

    return rows.mapInArrow(run, "cls long, n long, keys array<long>")


def _bitmap(s: np.ndarray, width: int) -> np.ndarray:
    out = np.zeros(width, np.uint8)
    out[(s & np.uint64(width - 1)).astype(np.int64)] = 1
    return np.packbits(out).view(np.uint64)


def _width(n: int) -> int:
    return max(64, 1 << (2 * n - 1).bit_length())


def _folded(bits: np.ndarray, width: int) -> np.ndarray:
    """Bitmaps made as wide as width."""
    while bits.shape[-1] * 64 > width:
        half = bits.shape[-1] // 2
        bits = bits[..., :half] | bits[..., half:]
    return bits


class Tile:
    """The left classes of a tile, banded by the width of their bitmaps. Groups that a link joins count as one from then on."""

    def __init__(self, cls: np.ndarray, group: np.ndarray, arrays: list[np.ndarray]):
        self.cls, self.group, self.arrays = cls, group.copy(), arrays
        self.joined: dict[int, int] = {}
        self.members: dict[int, list[int]] = {}
        for i, g in enumerate(group.tolist()):
            self.members.setdefault(g, []).append(i)
        self.n = np.array([len(a) for a in arrays], np.int64)
        widths = np.array([_width(int(n)) for n in self.n])
        self.bands = {int(w): np.flatnonzero(widths == w) for w in np.unique(widths)}
        self.bits = {w: np.stack([_bitmap(arrays[i], w) for i in own]) for w, own in self.bands.items()}

    def linked(self, cls: int, group: int, s: np.ndarray) -> list[int]:
        """Left classes that link with s, one of each group that is not joined with its own yet."""
        n, out = len(s), []
        width = _width(n)
        group = self._find(group)
        for w, own in self.bands.items():
            if not width // 4 <= w <= width * 4:
                continue
            m = self.n[own]
            ok = (100 * np.minimum(m, n) >= 80 * np.maximum(m, n)) & (self.group[own] != group) & (self.cls[own] != cls)
            if not ok.any():
                continue
            at = min(w, width)
            theirs, mine = _folded(self.bits[w][ok], at), _folded(_bitmap(s, width), at)
            m, own = m[ok], own[ok]
            only_mine = np.bitwise_count(mine & ~theirs).sum(1, dtype=np.int64)
            only_theirs = np.bitwise_count(theirs & ~mine).sum(1, dtype=np.int64)
            most = np.minimum(n - only_mine, m - only_theirs)
            for i in own[100 * most >= 80 * (n + m - most)]:
                if self.group[i] == group:
                    continue
                a = self.arrays[i]
                found = np.searchsorted(s, a)
                found[found == n] = 0
                both = int((s[found] == a).sum())
                if 100 * both >= 80 * (n + len(a) - both):
                    out.append(int(i))
                    self._join(int(self.group[i]), group)
                    group = self._find(group)
        return out

    def _find(self, group: int) -> int:
        while (up := self.joined.get(group, group)) != group:
            self.joined[group] = self.joined.get(up, up)
            group = up
        return group

    def _join(self, a: int, b: int) -> None:
        """The smaller group's left classes get the larger one's number."""
        few, many = sorted((self._find(a), self._find(b)), key=lambda g: len(self.members.get(g, ())))
        if few != many:
            own = self.members.pop(few, [])
            self.group[own] = many
            self.members.setdefault(many, []).extend(own)
            self.joined[few] = many


def _compare(table: pa.Table) -> pa.Table:
    """Links of the tiles in table (tile, left, cls, grp, keys)."""
    table = table.combine_chunks()
    tile, left, cls, group = (table[c].to_numpy() for c in ("tile", "left", "cls", "grp"))
    keys = table["keys"].combine_chunks()
    flat, offsets = keys.flatten().to_numpy().view(np.uint64), np.append(0, np.cumsum(keys.value_lengths().to_numpy()))
    order = np.argsort(tile, kind="stable")
    a, b = [], []
    for own in np.split(order, np.flatnonzero(np.diff(tile[order])) + 1) if len(order) else []:
        array = lambda i: flat[offsets[i] : offsets[i + 1]]
        mine, asked = own[left[own]], own[~left[own]]
        if not len(mine):
            continue
        t = Tile(cls[mine], group[mine], [array(i) for i in mine])
        for i in asked:
            for j in t.linked(cls[i], group[i], array(i)):
                a.append(int(cls[i]))
                b.append(int(t.cls[j]))
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def _count(table: pa.Table) -> pa.Table:
    """For each right class of the tiles in table how many documents of left classes it links with (grp holds a class's documents)."""
    table = table.combine_chunks()
    tile, left, cls, docs = (table[c].to_numpy() for c in ("tile", "left", "cls", "grp"))
    keys = table["keys"].combine_chunks()
    flat, offsets = keys.flatten().to_numpy().view(np.uint64), np.append(0, np.cumsum(keys.value_lengths().to_numpy()))
    order = np.argsort(tile, kind="stable")
    out, n = [], []
    for own in np.split(order, np.flatnonzero(np.diff(tile[order])) + 1) if len(order) else []:
        array = lambda i: flat[offsets[i] : offsets[i + 1]]
        mine, asked = own[left[own]], own[~left[own]]
        if not len(mine):
            continue
        t = Tile(cls[mine], cls[mine], [array(i) for i in mine])
        for i in asked:
            t.group, t.joined, t.members = cls[mine].copy(), {}, {}  # every class is a group of its own
            out.append(int(cls[i]))
            n.append(int(docs[mine][t.linked(cls[i], cls[i], array(i))].sum()))
    return pa.table({"cls": pa.array(out, pa.int64()), "links": pa.array(n, pa.int64())})


def _cut(sides: DataFrame) -> DataFrame:
    """sides, a written table, with _block: 0 in a tile's side of up to its limit of shingles (left BLOCK, right PARTNERS); a larger
    one is banded by size, from a histogram, and each band is dealt by hash into as many blocks as its shingles need. So no task
    ever meets all classes of a tile."""
    limit = F.when(F.col("left"), BLOCK).otherwise(PARTNERS)
    sized = sides.withColumn("_band", F.floor(F.log(F.col("n")) / math.log(SIZE_BAND)).cast("long"))
    bands = sized.groupBy("tile", "left", "_band").agg(F.sum(F.greatest("n", F.lit(LIGHT))).alias("_w"))
    large = bands.groupBy("tile", "left").agg(F.sum("_w").alias("_all")).filter(F.col("_all") > limit).select("tile", "left")
    parts = saved(bands.join(large, ["tile", "left"]).select("tile", "left", "_band", F.ceil(F.col("_w") / limit).alias("_parts")), "join-blocks")
    block = F.col("_band") * (1 << 32) + F.pmod(F.xxhash64("cls"), F.col("_parts")) + 1
    return sized.join(small(parts), ["tile", "left", "_band"], "left").withColumn("_block", F.coalesce(block, F.lit(0).cast("long"))).drop("_band", "_parts")


def compare(left: DataFrame, right: DataFrame, signatures: DataFrame, task=_compare, schema: str = "a long, b long", rows: int | None = None) -> DataFrame:
    """Links (a, b) between the left and the right classes of each tile; both sides have tile, cls, grp, n. A written table.

    A tile's left classes are cut into blocks of about BLOCK shingles and its right ones into blocks of PARTNERS; every left
    block meets the right classes whose size can match. rows: a bound on the rows of both sides, if one is known.
    """
    weight = F.greatest("n", F.lit(LIGHT))
    both = left.distinct().withColumn("left", F.lit(True)).unionByName(right.distinct().withColumn("left", F.lit(False)))
    sides = _cut(saved(both, "join-sides", rows))
    left, right = sides.filter("left").withColumnRenamed("_block", "_l"), sides.filter("not left").withColumnRenamed("_block", "_r")
    spans = left.groupBy("tile", "_l").agg((F.min("n") * 80).alias("_from"), (F.max("n") * 100).alias("_to"))
    theirs = right.groupBy("tile", "_r").agg((F.max("n") * 100).alias("_high"), (F.min("n") * 80).alias("_low"))
    blocks = spans.join(theirs, "tile").filter("_high >= _from and _low <= _to").drop("_high", "_low")
    columns = ("tile", "_l", "_r", "left", "cls", "grp", "n")
    mine = left.join(blocks.drop("_from", "_to"), ["tile", "_l"])
    sent = right.join(blocks, ["tile", "_r"]).filter("n * 100 >= _from and n * 80 <= _to")
    asked = saved(mine.select(*columns).unionByName(sent.select(*columns)), "join-tiles")
    n, rows = asked.agg(F.coalesce(F.sum(weight), F.lit(0)), F.count_if(~F.col("left"))).collect()[0]
    tasks = asked.select(F.xxhash64("tile", "_l", "_r").alias("tile"), "left", "cls", "grp").withColumn("_task", F.pmod("tile", F.lit(max(1, -(-n // PARTNERS)))))
    full = tasks.join(signatures.select("cls", "keys").dropDuplicates(["cls"]), "cls")
    found = full.groupBy("_task").applyInArrow(task, schema)
    return saved(found.distinct() if task is _compare else found, "join-links", rows)


def _rare(signatures: DataFrame) -> DataFrame:
    """key, cls, n: for each class left, those of its rarest n - ceil(0.8 n) + 1 shingles that another class has too."""
    shared = signatures.select(F.explode("keys").alias("key")).groupBy("key").agg(F.count(F.lit(1)).alias("df")).filter("df > 1")
    postings = signatures.select("cls", "n", F.explode("keys").alias("key")).join(shared, "key")
    own = postings.groupBy("cls").agg(F.first("n").alias("n"), F.sort_array(F.collect_set(F.struct("df", "key"))).alias("k"))
    least = F.expr("(80 * n + 99) div 100")
    # shingles that no other class has come first in the order and need not be sent
    number = F.greatest(F.lit(0), F.col("n") - least + 1 - (F.col("n") - F.size("k"))).cast("int")
    kept = own.filter(F.size("k") >= least)
    return kept.select("cls", "n", F.explode(F.transform(F.slice("k", F.lit(1), number), lambda x: x["key"])).alias("key"))


def _still_apart(rare: DataFrame, groups: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Left and right sides of tiles for the groups that meet in a shingle and are not joined yet."""
    placed = saved(rare.join(groups, "cls", "left").withColumn("grp", F.coalesce("root", "cls")).drop("root"), "join-placed", rare.count())
    meets = placed.select("key", "grp").distinct()
    many = meets.groupBy("key").agg(F.count(F.lit(1)).alias("m")).filter("m > 1")
    few = meets.join(many.filter(F.col("m") <= MANY_GROUPS).select("key"), "key")
    pairs = few.join(few.select("key", F.col("grp").alias("other")), "key").filter("grp < other").select("grp", "other").distinct()
    members = placed.select("grp", "cls", "n").distinct()
    sizes = members.groupBy("grp").agg(F.count(F.lit(1)).alias("size"), F.min("n").alias("low"), F.max("n").alias("high"))
    other = sizes.select(*(F.col(c).alias(f"{c}_2") for c in sizes.columns))
    pairs = pairs.join(sizes, "grp").join(other, F.col("other") == F.col("grp_2")).filter("100 * high >= 80 * low_2 and 100 * high_2 >= 80 * low")
    first = F.col("size") >= F.col("size_2")
    pairs = saved(pairs.select(F.when(first, F.col("grp")).otherwise(F.col("other")).alias("tile"), F.when(first, F.col("other")).otherwise(F.col("grp")).alias("grp")).distinct(), "join-group-pairs")
    left = members.join(pairs.select(F.col("tile").alias("grp")).distinct(), "grp").select(F.concat(F.lit("g"), F.col("grp").cast("string")).alias("tile"), "cls", "grp", "n")
    right = members.join(pairs, "grp").select(F.concat(F.lit("g"), F.col("tile").cast("string")).alias("tile"), "cls", "grp", "n")
    crowd = placed.join(many.filter(F.col("m") > MANY_GROUPS).select("key"), "key").select(F.concat(F.lit("k"), F.col("key").cast("string")).alias("tile"), "cls", "grp", "n")
    return left.unionByName(crowd), right.unionByName(crowd)


def links(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", slack: float = SLACK) -> tuple[DataFrame, DataFrame, DataFrame]:
    """sets: _id, n, cls of every document. classes: cls, n, rep (its smallest id). links: pairs a, b of classes, each a true
    link, enough to join every group."""
    found = saved(sets(docs, id_col, text_col), "join-sets")
    classes = found.filter("n > 0").groupBy("cls").agg(F.first("n").alias("n"), F.min("_id").alias("rep"))
    by_key = Window.partitionBy("key")  # a task sends two rows of a key at most
    posted = _first_postings(docs, id_col, text_col, slack).withColumn("_low", F.min("cls").over(by_key)).withColumn("_high", F.max("cls").over(by_key))
    shared = posted.filter("known > 0 or _low <> _high").groupBy("cls").agg(F.sum(F.greatest("known", F.lit(1))).alias("shared"))
    left = saved(shared.join(classes, "cls").filter(F.col("shared") >= 1 + F.floor(F.col("n") * slack)).select(F.col("rep").alias("_id")), "join-left", found.count())
    signatures = saved(_signatures(docs, id_col, text_col, left), "join-signatures")
    rare = saved(_rare(signatures), "join-rare", signatures.agg(F.coalesce(F.sum("n"), F.lit(0))).collect()[0][0])
    hubs = rare.groupBy("key").agg(F.min(F.struct("cls", "n")).alias("hub"), F.max("cls").alias("last")).filter("hub.cls <> last")
    stars = rare.join(hubs, "key").filter("cls <> hub.cls and 100 * least(n, hub.n) >= 80 * greatest(n, hub.n)")
    tile = F.col("hub.cls").cast("string").alias("tile")
    one = compare(
        stars.select(tile, F.col("hub.cls").alias("cls"), F.col("hub.cls").alias("grp"), F.col("hub.n").alias("n")),
        stars.select(tile, "cls", F.col("cls").alias("grp"), "n"),
        signatures,
        rows=2 * rare.count(),
    )
    groups = components(one).select(F.col("node").alias("cls"), "root")
    two = compare(*_still_apart(rare, groups), signatures)
    return found, classes, one.unionByName(two)


def _grouped(docs: DataFrame, id_col: str, text_col: str, slack: float) -> DataFrame:
    """The rows of sets with component, the smallest id of the group, and root, a class that names the group."""
    found, classes, pairs = links(docs, id_col, text_col, slack)
    roots = components(pairs)
    joined = roots.join(classes, F.col("node") == F.col("cls")).select("cls", "root", "rep")
    least = joined.groupBy("root").agg(F.min("rep").alias("component"))
    named = classes.join(joined.join(least, "root").select("cls", "root", "component"), "cls", "left").select("cls", F.coalesce("component", "rep").alias("component"), F.coalesce("root", "cls").alias("root"))
    # documents without shingles belong to no class; a random key spreads them
    keyed = found.withColumn("cls", F.when(F.col("n") > 0, F.col("cls")).otherwise(F.xxhash64("_id", "_k1")))
    return keyed.join(named, "cls", "left")


def groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", slack: float = SLACK) -> DataFrame:
    """One row for each document: id, n_shingles, component_id, the smallest id that links reach from it."""
    out = _grouped(docs, id_col, text_col, slack)
    return out.select(F.col("_id").alias(id_col), F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("_id")).alias("component_id"))


def representatives(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", slack: float = SLACK) -> DataFrame:
    """docs with one row of each group: that with the smallest id, null last; of rows with one id and different texts, one; of
    repeated rows, one. Rows without words all stay."""
    least = F.min(F.struct(F.col("_id").isNull().alias("null"), F.col("_id"), F.col("_k1"), F.col("_k2"))).alias("least")
    kept = _grouped(docs, id_col, text_col, slack).filter("n > 0").groupBy("root").agg(least).select("least._k1", "least._k2")
    k1, k2, n = fresh(docs, "_k1"), fresh(docs, "_k2"), fresh(docs, "_n")
    blank = ~F.coalesce(F.col(text_col).cast("string").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    keyed = docs.filter(~blank).withColumns(dict(zip((k1, k2), row_key(id_col, text_col), strict=True)))
    same = Window.partitionBy(k1, k2).orderBy(k1)
    one = keyed.join(kept.toDF(k1, k2), [k1, k2], "left_semi").withColumn(n, F.row_number().over(same)).filter(F.col(n) == 1)
    return one.select(*docs.columns).unionByName(docs.filter(blank))


def link_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", slack: float = SLACK) -> DataFrame:
    """One row for each document: id, links, the number of other documents that it links with (copies of its set included)."""
    found, classes, pairs = links(docs, id_col, text_col, slack)
    copies = found.filter("n > 0").groupBy("cls").agg(F.count(F.lit(1)).alias("copies"))
    members = saved(components(pairs).withColumnRenamed("node", "cls").join(classes, "cls").join(copies, "cls"), "join-members")
    signatures = saved(_signatures(docs, id_col, text_col, members.select(F.col("rep").alias("_id"))), "join-signatures")
    side = members.select(F.col("root").cast("string").alias("tile"), "cls", F.col("copies").alias("grp"), "n")
    counted = compare(side, side, signatures, _count, "cls long, links long").groupBy("cls").agg(F.sum("links").alias("_near"))
    own = copies.join(counted, "cls", "left").select("cls", (F.coalesce("_near", F.lit(0)) + F.col("copies") - 1).alias("links"))
    keyed = found.withColumn("cls", F.when(F.col("n") > 0, F.col("cls")).otherwise(F.xxhash64("_id")))
    return keyed.join(own, "cls", "left").select(F.col("_id").alias(id_col), F.when(F.col("n") > 0, F.col("links")).otherwise(F.lit(0)).cast("long").alias("links"))
