import math
import pathlib
import zlib
from collections import Counter

import numpy as np
import pytest
from loomwright.llm import ann, common, components, langid, ngram_join, quality
from pyspark.sql import functions as F

from . import brute


# n-gram join


def variants(seed, base, n, edits):
    rng = np.random.default_rng(seed)
    out = []
    for _ in range(n):
        w = base.split()
        for k in rng.integers(0, len(w), edits):
            w[k] = f"v{rng.integers(1 << 30)}"
        out.append(" ".join(w))
    return out


def test_groups_are_those_of_all_pairs(spark):
    rows = [*brute.AWKWARD]
    text = [t for s in range(6) for t in variants(s, " ".join(f"s{s}w{k}" for k in range(80 + 30 * s)), 14, 1 + s)]
    text += variants(77, brute.BASE, 12, 5) + [brute.BASE[:600], brute.BASE[300:]]
    shared = " ".join(f"common{k}" for k in range(40))
    text += [" ".join(f"own{i}x{k}" for k in range(30 + i)) + " " + shared for i in range(25)]
    rows += [(100 + i, t, "en", "a") for i, t in enumerate(text)]
    got = ngram_join.groups(brute.frame(spark, rows)).collect()
    assert Counter(map(tuple, got)) == brute.groups(rows)


def test_groups_with_small_blocks_and_crowded_shingles(spark, monkeypatch):
    for name, value in (("BLOCK", 300), ("PARTNERS", 300), ("LIGHT", 1), ("MANY_GROUPS", 1)):
        monkeypatch.setattr(ngram_join, name, value)
    base = " ".join(f"w{k}" for k in range(70))
    rows = [(i, t, "en", "a") for i, t in enumerate(variants(1, base, 25, 2) + variants(2, base, 25, 4))]
    assert Counter(map(tuple, ngram_join.groups(brute.frame(spark, rows)).collect())) == brute.groups(rows)


def test_numbers_of_links_are_those_of_all_pairs(spark, monkeypatch):
    for name, value in (("BLOCK", 300), ("PARTNERS", 500), ("LIGHT", 1)):
        monkeypatch.setattr(ngram_join, name, value)
    base = " ".join(f"w{k}" for k in range(90))
    text = [*variants(1, base, 20, 1), *variants(2, base, 20, 3), base, base, "a b", "A  b", "", None]
    sets = [brute.shingles(t) for t in text]
    want = {i: sum(bool(s & o) and 100 * len(s & o) >= 80 * len(s | o) for j, o in enumerate(sets) if j != i) for i, s in enumerate(sets)}
    got = ngram_join.link_counts(brute.frame(spark, [(i, t, "en", "a") for i, t in enumerate(text)])).collect()
    assert {r["doc_id"]: r["links"] for r in got} == want


def test_join_of_an_empty_table(spark):
    assert ngram_join.groups(brute.frame(spark, []).limit(0)).count() == 0
    blank = ngram_join.groups(brute.frame(spark, [(1, None, "en", "a"), (2, " ", "en", "a")])).collect()
    assert sorted(map(tuple, blank)) == [(1, 0, 1), (2, 0, 2)]


def test_bitmap_bound_never_loses_a_link():
    rng = np.random.default_rng(5)
    for _ in range(300):
        n = int(rng.integers(1, 200))
        a = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64))
        b = np.unique(np.concatenate([a[rng.random(len(a)) < 0.92], rng.integers(0, 1 << 63, max(1, n // 12)).astype(np.uint64)]))
        both = len(np.intersect1d(a, b))
        want = 100 * both >= 80 * (len(a) + len(b) - both)
        assert bool(ngram_join.Tile(np.array([1]), np.array([1]), [a]).linked(2, 2, b)) == want


def test_components_of_a_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 99)], "a long, b long")
    got = {r["node"]: r["root"] for r in components.components(edges).collect()}
    assert got == {i: 0 for i in range(41)} | {99: 99, 100: 99}
    assert components.components(edges.limit(0)).count() == 0


@pytest.mark.parametrize("most", [1 << 19, 0])
def test_components_in_one_task_and_in_rounds(spark, monkeypatch, most):
    monkeypatch.setattr(components, "ONE_TASK", most)
    rng = np.random.default_rng(3)
    pairs = [tuple(map(int, p)) for p in rng.integers(-200, 200, (150, 2))] + [(1 << 40, -(1 << 40)), (5, 5), (900, 901), (901, 900)]
    root = {x: x for p in pairs for x in p}
    for _ in root:
        for a, b in pairs:
            root[a] = root[b] = min(root[a], root[b])
    edges = spark.createDataFrame(pairs, "a long, b long").repartition(3)
    got = components.components(edges).collect()
    assert len(got) == len(root) and {r["node"]: r["root"] for r in got} == root


@pytest.mark.parametrize("query", [ngram_join.groups, ngram_join.representatives])
def test_join_of_few_links_writes_few_tables(spark, query):
    texts = [t for s in range(4) for t in variants(s, " ".join(f"s{s}w{k}" for k in range(80)), 6, 2)]
    docs = brute.frame(spark, [(i, t, "en", "a") for i, t in enumerate(texts)])

    def written():
        folder = pathlib.Path(common.shared_dir(spark).removeprefix("file:"))
        return {p.name for p in folder.glob("*")}

    before = written()
    query(docs).collect()
    assert len(written() - before) <= 16



# nearest neighbours


def vectors(spark, n, d=8, seed=0):
    x = np.random.default_rng(seed).normal(size=(n, d))
    rows = [(i, v.tolist(), 0) for i, v in enumerate(x)]
    rows += [(n + i, x[3].tolist(), 0) for i in range(30)]  # copies
    rows += [(900, None, 0), (920, [0.0] * d, 0), (940, [math.nan, *[1.0] * (d - 1)], 0), (960, [1.0, None, *[1.0] * (d - 2)], 0), (980, [math.inf] * d, 0), (min(40, n - 1), x[min(40, n - 1)].tolist(), 0), (990, [1.0, 2.0], 0)]
    return rows, spark.createDataFrame(rows, "vec_id long, embedding array<double>, score int").repartition(3)


def test_nearest_against_brute_force(spark):
    rows, df = vectors(spark, 300)
    got = ann.nearest(df, lambda i: i % 20 == 0).collect()
    good = {i: np.array(v) for i, v, _ in rows if i < 900}
    found = Counter(r["query_id"] for r in got)
    assert set(found) == {i for i in good if i % 20 == 0} and set(found.values()) == {20}
    hits = 0
    for q in found:
        want = sorted((-(good[q] * v).sum(), i) for i, v in good.items() if i != q)[:20]
        own = sorted((r["rank"], r["vec_id"], r["score"]) for r in got if r["query_id"] == q)
        assert [r[0] for r in own] == list(range(1, 21))
        assert [(-s, i) for _, i, s in own] == sorted((-s, i) for _, i, s in own)
        for _, i, s in own:
            assert s == pytest.approx((good[q] * good[i]).sum(), abs=1e-12)
        hits += len({i for _, i in want} & {r[1] for r in own})
    assert hits / (20 * len(found)) >= 0.9


def test_recall_over_several_shards(spark, monkeypatch, sf):
    monkeypatch.setattr(ann, "SHARD_CELLS", 150 * 64)
    monkeypatch.setattr(ann, "BLOCK_QUERIES", 7)
    df = spark.read.parquet(f"{sf}/embeddings.parquet")
    rows = df.collect()
    x = np.array([r["embedding"] for r in rows], float)
    ids = np.array([r["vec_id"] for r in rows])
    got = {(r["query_id"], r["vec_id"]) for r in ann.nearest(df, lambda i: i % 20 == 0).collect()}
    want = set()
    for k in np.flatnonzero(ids % 20 == 0):
        s = x @ x[k]
        s[k] = -9
        want |= {(int(ids[k]), int(ids[j])) for j in np.lexsort((ids, -s))[:20]}
    assert len(got & want) / len(want) >= 0.9


def test_forest_ascends_to_enough_candidates():
    x = np.random.default_rng(1).normal(size=(500, 16))
    for least in (1, 200, 5_000):
        for q, near in zip(range(20), ann.Forest(x).candidates(x[:20], least), strict=True):
            assert q in near
    assert all(len(c) == 500 for c in ann.Forest(x).candidates(x[:3], 1e9))


def test_recall_of_many_vectors_by_a_part_of_them():
    n, k = 20_000, 21
    x = np.random.default_rng(4).normal(size=(n, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    x[100:200] = x[:100] + np.random.default_rng(5).normal(0, 0.01, (100, 64))
    asked = np.arange(0, n, 400)
    share, hits = [], 0
    for q, near in zip(asked, ann.Forest(x).candidates(x[asked], ann.TREES + ann.REACH * k + ann.EFFORT * n, k), strict=True):
        share.append(len(near) / n)
        want = np.argsort(-(x @ x[q]), kind="stable")[:k]
        hits += len(np.intersect1d(want, near))
    assert max(share) < 0.5 and hits / (k * len(asked)) >= 0.9


def test_vectors_of_each_length_are_searched(spark, monkeypatch):
    rows = [(i, [1.0, float(i)]) for i in range(0, 50)] + [(100 + i, [1.0, float(i), 2.0]) for i in range(0, 30)] + [(1000 + 20 * i, [3.0, 4.0]) for i in range(40)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = sorted(map(tuple, ann.nearest(df, lambda i: i % 20 == 0).collect()))
    monkeypatch.setattr(common, "HOT_ROWS", 5)
    assert sorted(map(tuple, ann.nearest(df, lambda i: i % 20 == 0).collect())) == got
    want = []
    for q, v in rows:
        if q % 20 == 0:
            near = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), i) for i, w in rows if i != q and len(w) == len(v))[:20]
            want += [(q, r + 1, i, -s) for r, (s, i) in enumerate(near)]
    assert got == sorted(want)


def test_nearest_of_nothing_and_of_few(spark):
    _, df = vectors(spark, 5)
    assert ann.nearest(df.limit(0), lambda i: i % 20 == 0).count() == 0
    assert ann.nearest(df.filter("vec_id in (0, 1)"), lambda i: i % 20 == 0).select("query_id", "rank", "vec_id").collect() == [(0, 1, 1)]


# language ID


def _counted(texts):
    counts = Counter()
    for lang, t in texts.items():
        b = b"\n\n\n" + t
        for i in range(3, len(b)):
            counts[(lang, b[i - 3] << 16 | b[i - 2] << 8 | b[i - 1], b[i])] += 1
    return counts


def _model(counts):
    return langid.Model.fit(*(list(c) for c in zip(*((*k, n) for k, n in sorted(counts.items())), strict=True)))


def _trees(counts, lang):
    trees = {}
    for (la, before, byte), n in counts.items():
        if la == lang:
            for k in range(4):
                trees.setdefault(before.to_bytes(3, "big")[3 - k :], Counter())[byte] += n
    return trees


def _chance(trees, before, byte):
    p = 1.0
    for k in (3, 2, 1, 0):
        c = trees.get(before[3 - k :])
        if c is None:
            continue
        n, d = sum(c.values()), len(c)
        if byte in c:
            return p * c[byte] / (n + d)
        p *= d / (n + d)
    return p / 256


def test_code_lengths_are_exact():
    import pyarrow as pa

    rng = np.random.default_rng(8)
    texts = {"en": b"the cat sat on the mat and the dog", "fr": "le chat est sur le tapis et le chien é".encode()}
    texts["ja"] = "日本語の文章はここにあります。".encode()
    texts["ru"] = "кошка сидит на ковре, собака лежит".encode()
    texts["zz"] = "".join(map(chr, [*range(1, 0x250), *rng.integers(0x400, 0x20000, 600)])).encode("utf-8", "ignore").replace(b"\xed", b"")
    texts["all"] = bytes(range(256)) * 2 + bytes(rng.integers(0, 256, 4000).tolist())
    counts = _counted(texts)
    assert len({k[2] for k in counts}) >= 250
    model = _model(counts)
    trees = [_trees(counts, la) for la in model.languages]
    asked = ["the cat", "", "le chien noir ÿ", "zzz the\n", "日本の猫", "собака\u0800\U00012345"]
    got = model.bits(pa.array(asked))
    for i, t in enumerate(asked):
        b = b"\n\n\n" + t.encode()
        want = [-sum(math.log2(_chance(tree, b[k - 3 : k], b[k])) for k in range(3, len(b))) for tree in trees]
        assert got[i] == pytest.approx(want, rel=1e-5, abs=1e-4)


def test_chances_after_a_context_add_up_to_one_at_most(monkeypatch):
    monkeypatch.setattr(langid, "LANES", 2)
    rng = np.random.default_rng(3)
    counts = _counted({f"l{i}": bytes(rng.integers(0, 240, 900).tolist()) for i in range(5)})
    model = _model(counts)
    for before in (0, 0x0A0A0A, *[k[1] for k in list(counts)[:20]]):
        gram = np.int64(before) << 8 | np.arange(256)
        total = np.concatenate([np.exp2(-c.bits(gram).astype(float)).sum(0) for c in model.costs()])
        assert len(total) == 5 and (total <= 1 + 1e-4).all() and (total > 0.5).all()


def test_windows_do_not_change_code_lengths(monkeypatch):
    import pyarrow as pa

    model = _model({("en", 0, 97): 3, ("fr", 5, 98): 2})
    texts = pa.array(["ab" * 50, "", "b", "a" * 33])
    whole = model.bits(texts)
    monkeypatch.setattr(langid, "WINDOW", 7)
    assert model.bits(texts) == pytest.approx(whole)


def test_held_out_languages(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = langid.train(docs.filter(~langid.held_out()))
    said = langid.predict(docs.coalesce(1), model)
    assert sorted(r["doc_id"] for r in said.select("doc_id").collect()) == sorted(r["doc_id"] for r in docs.select("doc_id").collect())
    got = said.join(docs, "doc_id").filter(langid.held_out())
    right, n = got.agg(F.avg((F.col("lang_pred") == F.col("lang")).cast("int")), F.count("*")).collect()[0]
    assert n > 200 and right > 0.97
    rows = got.limit(30).collect()
    assert all((zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) and 0 <= r["score"] <= 1 for r in rows)


def test_languages_of_awkward_rows(spark):
    docs = brute.frame(spark)
    model = langid.train(docs)
    got = langid.predict(docs, model).collect()
    assert Counter(r["doc_id"] for r in got) == Counter(r[0] for r in brute.AWKWARD)
    by = {r["doc_id"]: r for r in got}
    assert all(by[i]["lang_pred"] == "und" and by[i]["score"] == 0 for i in (2, 3, 4, 14))
    assert by[1]["lang_pred"] in {"en", "fr", "de", "es"}
    none = docs.limit(0)
    assert langid.train(none) is None and langid.predict(none, model).count() == 0
    assert {r["lang_pred"] for r in langid.predict(docs, None).collect()} == {"und"}


# quality


def test_chunks_cover_every_byte():
    hop = quality.CHUNK - quality.OVERLAP
    for n in (0, 1, quality.CHUNK, quality.CHUNK + 1, 3 * hop + 5, 5000):
        data = bytes(i % 251 for i in range(n))
        chunks, starts = quality.chunked([b"x", data])
        own = chunks[starts[1] : starts[2]]
        assert all((own[i // hop if i // hop < len(own) else -1][i - min(i // hop, len(own) - 1) * hop] == data[i]) for i in range(n))


def test_gradient_is_the_slope_of_the_loss():
    texts, labels = [b"good text here", b"###!!!" * 200, b""], np.array([1, 0, 1], np.float32)
    net = quality.Network(1)
    net.out[:] = np.random.default_rng(0).normal(0, 0.3, len(net.out))
    loss = lambda: -np.mean(labels * np.log(s := net.score(texts)) + (1 - labels) * np.log(1 - s)) + 0.5e-4 * (net.out**2).sum()
    g = net._gradient(texts, labels)
    for name, at in (("out", 3), ("out_bias", 0), ("bias", 2), ("filters", (5, 1))):
        w = getattr(net, name)
        old, step = w[at], 1e-2
        w[at] = old + step
        up = loss()
        w[at] = old - step
        down = loss()
        w[at] = old
        assert (up - down) / (2 * step) == pytest.approx(g[name][at], rel=0.15, abs=3e-4)


def _convolved(net, text: bytes) -> float:
    """The probability by plain loops over chunks, places, filters and bytes."""
    hop = quality.CHUNK - quality.OVERLAP
    chunks, at = [text[: quality.CHUNK]], 0
    while at + quality.CHUNK < len(text):
        at += hop
        chunks.append(text[at : at + quality.CHUNK])
    tops = []
    for c in chunks:
        values = [*c, *[quality.PAD] * (quality.CHUNK - len(c))]
        top = []
        for f in range(quality.FILTERS):
            best = -math.inf
            for place in range(0, quality.CHUNK - quality.WIDTH + 1, quality.STRIDE):
                r = 0.0
                for k in range(quality.WIDTH):
                    e = net.embed[values[place + k]]
                    r += sum(float(e[d]) * float(net.filters[k * quality.EMBED + d, f]) for d in range(quality.EMBED))
                best = max(best, r)
            top.append(math.tanh(best + float(net.bias[f])))
        tops.append(top)
    z = float(net.out_bias[0])
    for f in range(quality.FILTERS):
        own = [t[f] for t in tops]
        for part, value in enumerate((max(own), sum(own) / len(own), min(own))):
            z += value * float(net.out[part * quality.FILTERS + f])
    return 1 / (1 + math.exp(-z))


def test_score_is_that_of_plain_loops():
    r = np.random.default_rng(5)
    net = quality.Network(2)
    net.out[:], net.bias[:] = r.normal(0, 0.5, len(net.out)), r.normal(0, 0.2, quality.FILTERS)
    texts = [b"", b"a short one", bytes(r.integers(0, 256, 513).tolist()), b"abc " * 300]
    assert net.score(texts).tolist() == pytest.approx([_convolved(net, t) for t in texts], rel=1e-4)


def test_one_id_with_many_labels_does_not_swell_the_sample(spark):
    docs = spark.createDataFrame([(i % 3, f"text {i}", None) for i in range(60)], "doc_id long, text string, x string")
    labels = spark.createDataFrame([(0, 1)] * 500 + [(1, 0)], "doc_id long, quality int")
    assert quality.train(docs, labels).score([b"text"]).shape == (1,)


def test_quality_of_held_out_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    model = quality.train(docs, labels.filter(~quality.held_out()))
    got = quality.score(docs, model).join(labels, "doc_id").filter(quality.held_out()).collect()
    assert len(got) > 50 and np.mean([(r["score"] >= quality.THRESHOLD) == (r["quality"] == 1) for r in got]) > 0.93


def test_quality_of_awkward_rows(spark):
    docs = brute.frame(spark)
    labels = spark.createDataFrame([(1, 1), (5, 1), (9, 0), (14, 0), (2, None), (77, 1), (5, 1)], "doc_id long, quality int")
    model = quality.train(docs, labels)
    got = docs.withColumn("own", quality.score_column(F.col("text"), model))
    assert got.columns == [*docs.columns, "own"] and got.count() == len(brute.AWKWARD)
    assert all(0 <= r["score"] <= 1 for r in quality.score(docs, model).collect())
    assert quality.score(docs.limit(0), model).count() == 0
    assert quality.train(docs, labels.limit(0)).score([b"a"]).tolist() == [0.5]
    assert quality.train(docs, labels.filter("quality = 1")).score([b"a"])[0] > 0.5
