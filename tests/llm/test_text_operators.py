import hashlib
import math
import re
import struct
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import regex
import xxhash
from loomwright.llm import common, fingerprints, mixing, packing, secret_scan, shingles, token_counts, url_filter
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from . import brute

KINDS = [
    ("assign", re.compile(r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A), 1, 6),
    ("access", re.compile("AKIA[A-Z0-9]+"), 0, 20),
    ("hex", re.compile("[0-9a-f]+"), 0, 24),
]


def spans(text):
    found = [(m.start(), o, k, m.end()) for o, (k, p, g, n) in enumerate(KINDS) for m in p.finditer(text or "") if len(m.group(g)) >= n]
    return ",".join(f"{k}:{a}:{b}" for a, _, k, b in sorted(found))


# mixing


def test_shares_are_capped_and_dealt_out_again():
    got = mixing.shares([("b", 10, 1), (None, 1000, 5), ("a", 1, 1)])
    assert [x.source for x in got] == ["a", "b", None]
    assert got[0].target == 3 and got[1].target == 30 and got[2].target == pytest.approx(978)
    assert mixing.shares([]) == [] and mixing.shares([("a", 0, 2)])[0].target == 0


def test_mix_takes_what_the_queue_takes(spark):
    rows = [(i, "w " * (1 + i * 7 % 23), "en", ["a", "b", "c", None][i % 7 % 4]) for i in range(200)]
    docs = brute.frame(spark, rows)
    got = mixing.mix(docs).collect()
    total = sum(r["size"] for r in got)
    assert Counter(r["doc_id"] for r in got) == Counter(r[0] for r in rows)
    source = {r[0]: r[3] for r in rows}
    taken = defaultdict(int)
    for r in got:
        assert r["taken"] == r["copies"] * r["size"] <= 3 * r["size"]
        taken[source[r["doc_id"]]] += r["taken"]
    for r in got:
        assert abs(taken[source[r["doc_id"]]] - r["target"]) <= 2 * 23
    assert total - 2 * 23 <= sum(taken.values()) <= total
    again = mixing.mix(docs.repartition(7)).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, again))


def test_mix_is_that_of_a_plain_queue(spark, monkeypatch):
    rows = [(i, "w " * (1 + i * 11 % 17) + str(i), "en", "abcd"[i % 7 % 4]) for i in range(300)] + [(None, f"no id {i}", "en", "a") for i in range(40)] + [(999, "v " * 5000, "en", "b")]
    docs = brute.frame(spark, rows)
    for name, value in (("BUCKET_ROWS", 6), ("CELLS", 3)):
        monkeypatch.setattr(mixing, name, value)
    got = Counter((r["doc_id"], r["size"], r["copies"]) for r in mixing.mix(docs).collect())
    size = [len(brute.words(r[1])) for r in rows]
    tie = [int(hashlib.sha256(f"17:{'' if i is None else i}:{hashlib.md5(t.encode()).hexdigest()}".encode()).hexdigest()[:15], 16) for i, t, *_ in rows]
    plan = {x.source: x for x in mixing.shares([(s, sum(n for n, r in zip(size, rows, strict=True) if r[3] == s), 1) for s in "abcd"])}
    queue = []
    for s, x in plan.items():
        cum = 0
        for i in sorted((i for i, r in enumerate(rows) if r[3] == s), key=lambda i: tie[i]):
            cum += size[i]
            queue += [((e * x.size + cum) / x.target, tie[i], e, i) for e in range(3)]
    spent, copies = 0, Counter()
    for *_, i in sorted(queue):
        if (spent := spent + size[i]) > sum(size):
            break
        copies[i] += 1
    assert got == Counter((r[0], size[i], copies[i]) for i, r in enumerate(rows))


def test_mix_of_awkward_rows_and_of_none(spark):
    got = mixing.mix(brute.frame(spark)).collect()
    assert Counter((r["doc_id"], r["size"]) for r in got) == Counter((r[0], len(brute.words(r[1]))) for r in brute.AWKWARD)
    assert all(r["taken"] == 0 for r in got if r["size"] == 0)
    assert mixing.mix(brute.frame(spark, []).limit(0)).count() == 0


# secrets


def test_base_spans_of_awkward_texts(spark):
    got = secret_scan.scan(brute.frame(spark)).collect()
    told = Counter((r["doc_id"], ",".join(f"{x['kind']}:{x['start']}:{x['end']}" for x in r["spans"] if x["kind_order"] < 3)) for r in got)
    assert told == Counter((r[0], spans(r[1])) for r in brute.AWKWARD)
    assert secret_scan.scan(brute.frame(spark, []).limit(0)).count() == 0


def test_ownership_tells_copied_examples_from_live_values(spark):
    copied, own, leaked, local = ("ghp_" + x * 12 for x in ("Ab1", "Zx9", "Lk7", "Lo3"))
    rows = [(i, f"see {copied} here, {i}", "en", f"s{i}") for i in range(12)] + [(90, f"{own} and {copied}", "en", "s9"), (91, own, "en", "s9")]
    # one text in many repositories of many owners: a leak that was copied; many repositories of one owner: no example either
    rows += [(100 + i, f"oops {leaked}", "en", f"s{i}") for i in range(12)] + [(200 + i, f"{local} {i}", "en", "s1") for i in range(12)]
    # three owners, but few repositories
    few = "ghp_" + "Fe4" * 12
    rows += [(300 + i, f"{few} {i}", "en", f"s{i}") for i in range(3)]
    docs = brute.frame(spark, rows)
    got = {r["doc_id"]: r["spans"] for r in secret_scan.scan(docs).collect()}
    assert [got[i] for i in range(12)] == [[]] * 12
    assert [(x["kind"], x["start"], x["end"], x["owners"], x["repos"]) for x in got[90]] == [("hosted", 0, 40, 1, 2)]
    assert [(x["owners"], x["repos"]) for x in got[100]] == [(12, 1)] and [(x["owners"], x["repos"]) for x in got[205]] == [(1, 12)]
    assert [(x["owners"], x["repos"]) for x in got[301]] == [(3, 3)]
    masked = {r["doc_id"]: r["text"] for r in secret_scan.mask(docs).collect()}
    assert masked[0] == "see <example> here, 0" and masked[90] == "<secret> and <example>" and masked[104] == "oops <secret>"


def test_a_set_that_a_third_of_the_rows_have_is_split(spark, monkeypatch):
    rows = [(i, "password = hunter2secret", "en", f"s{i % 4}") for i in range(60)] + [(100 + i, f"token: abcdef{i}", "en", "s") for i in range(60)] + [(None, "clean", "en", None)]
    docs = brute.frame(spark, rows)
    want = sorted(map(str, secret_scan.scan(docs).collect()))
    masked = sorted(map(str, secret_scan.mask(docs).collect()))
    monkeypatch.setattr(common, "HOT_ROWS", 7)
    assert sorted(map(str, secret_scan.scan(docs).collect())) == want and sorted(map(str, secret_scan.mask(docs).collect())) == masked
    monkeypatch.setattr(common, "BROADCAST_ROWS", 0)
    assert sorted(map(str, secret_scan.scan(docs).collect())) == want


def test_mask_keeps_every_row_and_column(spark):
    docs = brute.frame(spark)
    got = secret_scan.mask(docs)
    assert got.columns == docs.columns
    rows = got.collect()
    assert Counter(r["doc_id"] for r in rows) == Counter(r[0] for r in brute.AWKWARD)
    text = {r["doc_id"]: r["text"] for r in rows}
    assert text[9] == "<secret>' <secret> api_key: x secret=abc <secret>"
    assert text[2] is None and text[3] == "" and text[1] == brute.AWKWARD[0][1]


# tokens


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_token_counts(spark, name):
    tok = Tokenizer.from_file(public_tokenizers.path(name))
    got = token_counts.count_tokens(brute.frame(spark), public_tokenizers.path(name)).collect()
    want = Counter((i, len((t or "").encode()), len(tok.encode(t or "", add_special_tokens=False).ids)) for i, t, *_ in brute.AWKWARD)
    assert Counter((r["doc_id"], r["n_bytes"], r["n_tokens"]) for r in got) == want
    assert all(r["over_limit"] == (r["n_tokens"] > 2048) for r in got)


def test_token_counts_of_pieces(spark):
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    assert token_counts.counts(["a b", "", "日本"], path).tolist() == [len(model.encode(t)) for t in ("a b", "", "日本")]
    assert "".join(token_counts.cut("ab " * 1000, 100)) == "ab " * 1000
    assert token_counts.count_tokens(brute.frame(spark, []).limit(0), path).count() == 0


def test_counts_by_words_are_those_of_whole_texts(monkeypatch):
    path = public_tokenizers.path("word_bpe_49k.json")
    assert token_counts.load(path)[1] == " \n" and token_counts.load(public_tokenizers.path("byte_bpe_50k.json"))[1] == ""
    tok = Tokenizer.from_file(path)
    rng = np.random.default_rng(21)
    odd = [" ", " ", "  ", "\n", "\r\n", "\t", "\x0b", "\x1c", "\x85", "\xa0", "\u2028", "\u3000", "'s", "'", "'ll", "dog", "The", "ing", "1", "23", "!?", "\u0301", "\u0308", "e\u0301", "é", "Σ", "ς", "İ", "ß", "日本", "가", "\u1100\u1161", "🎉", "<|endoftext|>", "<|", "|>", "\x00", "-" * 40, "q" * 90]
    texts = ["".join(rng.choice(odd, rng.integers(0, 60))) for _ in range(3_000)] + ["word " * 40_000 + "end", "x" * 200_000]
    want = [len(tok.encode(t, add_special_tokens=False).ids) for t in texts]
    for words in (1 << 18, 50):
        monkeypatch.setattr(token_counts, "WORDS", words)
        token_counts.remembered(path).clear()
        assert token_counts.counts(texts, path).tolist() == want
        assert token_counts.counts(texts[::-1], path).tolist() == want[::-1]
        assert len(token_counts.remembered(path)) <= words and all(len(w) <= token_counts.LONG_WORD for w in token_counts.remembered(path))


def test_calls_are_balanced_by_bytes():
    text = "日本 語の " * 500
    pieces = token_counts.cut(text, 200)
    assert "".join(pieces) == text and all(len(p.encode()) <= 220 for p in pieces)
    sizes = [len(p.encode()) for p in pieces] + [5_000, 10]
    runs = token_counts.calls(sizes, 1_000)
    assert [i for a, b in runs for i in range(a, b)] == list(range(len(sizes)))
    assert all(sum(sizes[a:b]) <= 1_000 or b == a + 1 for a, b in runs) and len(runs) <= sum(sizes) // 500 + 2


# packing


def test_ids_are_those_of_the_library_whatever_the_encoder():
    path = public_tokenizers.path("byte_bpe_50k.json")
    tok, encode = Tokenizer.from_file(path), packing._encoder(path)
    rng = np.random.default_rng(12)
    plain = [chr(c) for c in [*range(0x20, 0x7F), 9, 10, 13, *range(0xC0, 0xD7), *range(0xD8, 0xF7), *range(0xF8, 0x180)]] + list("€‘’“”–—…¿¡«»") + [" "] * 60 + ["'s", "'ll", "the", "ing", "\r\n", "   ", "12"]
    odd = ["\x0b", "\x85", "\xa0", "\u2028", "日本", "🎉", "e\u0301", "²", "\x00", "<|endoftext|>", "Ǆ", "א"]
    texts = ["".join(rng.choice(plain, rng.integers(0, 120))) for _ in range(1_500)] + ["".join(rng.choice(plain + odd * 8, rng.integers(0, 120))) for _ in range(500)]
    for t, ids in zip(texts, encode(texts), strict=True):
        assert ids.tolist() == tok.encode(t, add_special_tokens=False).ids, t


def test_plan_is_best_fit_over_counts():
    rng = np.random.default_rng(1)
    for _ in range(30):
        lengths = rng.integers(1, 65, rng.integers(1, 400))
        histogram = {int(n): int((lengths == n).sum()) for n in np.unique(lengths)}
        rooms: list[int] = []  # best fit, longest first, piece by piece
        for n in sorted(lengths.tolist(), reverse=True):
            fit = [i for i, r in enumerate(rooms) if r >= n]
            if fit:
                rooms[min(fit, key=lambda i: rooms[i])] -= n
            else:
                rooms.append(64 - n)
        runs = packing.plan(histogram, 64)
        places = defaultdict(list)
        ranks = defaultdict(list)
        for r in runs:
            for k in range(r.count):
                places[r.sequence + k // r.each].append((r.offset + k % r.each * r.length, r.length))
                ranks[r.length].append(r.first + k)
        assert {n: sorted(v) for n, v in ranks.items()} == {n: list(range(c)) for n, c in histogram.items()}
        for own in places.values():
            at = 0
            for offset, n in sorted(own):
                assert offset == at
                at += n
            assert at <= 64
        assert len(places) == len(rooms)


def test_packing_round_trip(spark):
    path = public_tokenizers.path("byte_bpe_50k.json")
    tok = Tokenizer.from_file(path)
    got = packing.pack(brute.frame(spark), path).collect()
    docs = defaultdict(list)
    for i, t, *_ in brute.AWKWARD:
        docs[i].append(np.array([*tok.encode(t or "", add_special_tokens=False).ids, 2], "<u4"))
    want = Counter((i, k, s, n, zlib.crc32(x[s : s + n].tobytes())) for i, xs in docs.items() for x in xs for k, (s, n) in enumerate(packing.cuts(len(x), 1024)))
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == want
    places = defaultdict(list)
    for r in got:
        places[r["sequence_id"]].append((r["offset"], r["length"]))
    for own in places.values():
        at = 0
        for offset, n in sorted(own):
            assert offset == at
            at += n
        assert at <= 1024
    assert packing.pack(brute.frame(spark, []).limit(0), path).count() == 0


def test_the_faster_encoder_gives_the_same_ids():
    path = public_tokenizers.path("byte_bpe_50k.json")
    tok = Tokenizer.from_file(path)
    texts = [t or "" for _, t, *_ in brute.AWKWARD] + ["don't  stop\n\n\tnow 123,456 'll", "é" * 50, "a\u00a0b\u2003c\u0085d", "ſ’s ßÿ", "１２ ٣ ²½", "\r\n \r\n  x "]
    for t, ids in zip(texts, packing._encoder(path)(texts), strict=True):
        assert ids.tolist() == tok.encode(t, add_special_tokens=False).ids


# shingles


def test_shingles_equal_word_tuples():
    texts = [t or "" for _, t, *_ in brute.AWKWARD] + ["a b c d e f", "A b c d e f g", "é " * 9]
    for array in (pa.array(texts), pa.array(["pad me", *texts]).slice(1)):
        got = shingles.shingle_sets(array)
        want = [brute.shingles(t) for t in texts]
        assert [len(x) for x in got] == [len(x) for x in want]
        for i in range(len(texts)):
            for j in range(i):
                assert len(np.intersect1d(got[i], got[j])) == len(want[i] & want[j])


# URLs


def test_urls_against_all_rules(spark):
    urls = [
        "http://example.com/en/7?x", "https://WWW.Example.COM/en/8#a", "ftp://com/en/", "http://notexample.com/en/71", "http://a.net/de/8", "http://b.example.net/de/89",
        "http://example.net/de/9", "x://org/es", "x://org/es/1", "nothing", "", None, "http://", "http:///en/", "http://a.com", "http://a.com?/en/", "://com/en/q", "http://com:80/en/", "http://u@a.com/en/", "http://.com/en/",
        "http://x.org/es/1\n2?3", "http://" + "a." * 300 + "com/en/" + "p" * 5000,
    ]
    pages = spark.createDataFrame([(i, u, "h", "p", "r") for i, u in enumerate([*urls, urls[0]])], "page_id long, url string, host string, path string, rule string")
    got = {r["page_id"]: r for r in url_filter.judge(pages, url_filter.rule_table(spark, url_filter.RULES)).collect()}
    assert len(got) == len(urls) + 1
    for i, u in enumerate(urls):
        rest = u.split("://", 1)[1] if u and "://" in u else ""
        host = re.match("[^/?#]*", rest)[0].translate(brute.LOWER)
        path = re.match("[^/?#]*([^?#]*)", rest)[1]
        fits = [(len(r), r, v) for v, r in url_filter.RULES for h, p in [r.split("/", 1)] if (host == h or host.endswith("." + h)) and path.startswith("/" + p)]
        want = max(fits, default=(0, None, "allow"))
        assert (got[i]["host"], got[i]["path"], got[i]["rule"], got[i]["verdict"]) == (host, path, want[1], want[2])
    assert url_filter.judge(pages.limit(0), url_filter.rule_table(spark, url_filter.RULES)).count() == 0
    assert {r["verdict"] for r in url_filter.judge(pages, url_filter.rule_table(spark, url_filter.RULES).limit(0)).collect()} == {"allow"}


# fingerprints


def test_edits_and_likeness(spark):
    rows = [(i, " ".join(f"t{(i * 31 + k * k) % 211}" for k in range(20 + i)), "en", "a") for i in range(60)]
    rows += [(100, rows[5][1], "en", "a"), (101, None, "en", "a"), (102, "", "en", "a"), (103, "🎉é" * 5, "en", "a"), (104, "🎉é" * 5, "en", "a")]
    got = {r["doc_id"]: r for r in fingerprints.compare_edits(brute.frame(spark, rows)).collect()}
    order = sorted(rows, reverse=True, key=lambda r: r[0])
    for k, (i, t, *_) in enumerate(order):
        t, following = t or "", order[(k + 1) % len(order)][1] or ""
        edited = t[: len(t) - len(t) // 2] + following[: len(t) // 2]
        assert got[i]["edited"] == edited and got[i]["n_chars"] == len(t)
        assert 0 <= got[i]["near_edited"] <= 1 and 0 <= got[i]["near_next"] <= 1
        if edited == t:
            assert got[i]["near_edited"] == 1
    assert got[5]["fingerprint"] == got[100]["fingerprint"] and got[101]["fingerprint"] == got[102]["fingerprint"]
    assert got[104]["near_next"] == 1
    assert sum(got[i]["near_edited"] for i in range(60)) > sum(got[i]["near_next"] for i in range(60)) * 0.5


def _xx(value, seed=42):
    return xxhash.xxh64_intdigest(value, seed=seed)


def _signed(x):
    return x - (1 << 64) if x >= 1 << 63 else x


def _long(x, seed=42):
    return _xx(struct.pack("<q", x), seed)


def _all(xs):
    h = 42
    for x in xs:
        h = _long(x, h)
    return h


def _terms(text):
    return {_signed(_xx(w.encode())) for w in regex.split(r"[^\p{L}\p{N}]+", (text or "").lower()) if w}


def _plain_print(text, lexicon):
    """I-Match term by term: the whole lexicon, then twice GROUPS families of nested random subsets of it."""
    text = text or ""
    own = sorted(_terms(text) & lexicon)
    out = ["%016X" % _all(own) if own else hashlib.sha256(text.encode()).hexdigest().upper()]
    for family in (own, sorted(_signed(_long(t)) for t in own)):
        for g in range(fingerprints.GROUPS):
            for level in range(fingerprints.LEVELS):
                kept = [t for t in family if not any(t >> (g * fingerprints.LEVELS + b) & 1 for b in range(level + 1))]
                out.append("%08X" % (_all(kept) & 0xFFFFFFFF) if kept else "--------")
    return " ".join(out)


def _plain_likeness(a, b):
    pairs = [(x, y) for x, y in zip(a.split(" "), b.split(" "), strict=True) if x != "-" * 8 or y != "-" * 8]
    return sum(x == y for x, y in pairs) / len(pairs)


@pytest.mark.parametrize("most", [4_000_000, 0])
def test_fingerprints_are_those_of_plain_i_match(spark, monkeypatch, most):
    monkeypatch.setattr(fingerprints, "LEXICON_TERMS", most)
    monkeypatch.setattr(fingerprints, "RANGE_ROWS", 40)
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang", "source").collect()]
    rows += [(7, "one more text of a known id", "en", "a"), (7, "and yet another of it", "en", "a")] + [(None, f"no id {i % 2} at all", "en", "a") for i in range(6)]
    df = Counter(t for r in rows for t in _terms(r[1]))
    log_n = math.log(len(rows))
    lexicon = {t for t, n in df.items() if 0.2 <= (log_n - math.log(n)) / log_n <= 0.8}
    ids = sorted({r[0] for r in rows if r[0] is not None}, reverse=True) + [None]
    first = {i: min((t for j, t, *_ in rows if j == i), key=lambda t: _signed(_xx(t.encode()))) for i in ids}
    follow = {i: first[ids[(k + 1) % len(ids)]] for k, i in enumerate(ids)}
    want = Counter()
    for i, t, *_ in rows:
        edited = t[: len(t) - len(t) // 2] + follow[i][: len(t) // 2]
        a, b, c = (_plain_print(x, lexicon) for x in (t, edited, follow[i]))
        want[(i, edited, a, b, round(_plain_likeness(a, b), 9), round(_plain_likeness(a, c), 9))] += 1
    monkeypatch.setattr(common, "HOT_ROWS", 2)
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").withColumn("_key", F.lit("clash")).withColumn("_lexicon", F.lit(1))
    got = fingerprints.compare_edits(docs).collect()
    assert Counter((r["doc_id"], r["edited"], r["fingerprint"], r["edited_fingerprint"], round(r["near_edited"], 9), round(r["near_next"], 9)) for r in got) == want


def test_document_frequencies_are_of_single_terms(spark):
    # two words that share the lower 22 bits of their hashes, each in one text; the ten texts of a group share ten terms
    word = F.concat(F.lit("u"), F.col("id").cast("string"))
    pair = spark.range(20_000).groupBy(F.xxhash64(word).bitwiseAND((1 << 22) - 1)).agg(F.collect_list(word).alias("w")).filter("size(w) = 2").first()["w"]
    rows = [(i, " ".join(f"g{i // 10}x{k}" for k in range(10)), "en", "a") for i in range(30)]
    for i, w in ((3, pair[0]), (14, pair[1])):
        rows[i] = (i, f"{rows[i][1]} {w}", "en", "a")
    docs = brute.frame(spark, rows)
    prints = {r["doc_id"]: r["fingerprint"] for r in fingerprints.fingerprints(docs).collect()}
    assert prints[3] == prints[4] != prints[14] == prints[15]
    buckets = fingerprints.lexicon(docs, band=(0.0, 1.0)).row.collect()[0]["_lexicon"]
    assert sum(map(len, buckets)) == 32 and len(buckets) == 8
    assert all(t & (len(buckets) - 1) == i for i, b in enumerate(buckets) for t in b)


def test_only_equal_texts_without_lexicon_terms_are_alike(spark):
    docs = spark.range(1_000).select(F.col("id").alias("doc_id"), F.concat(F.lit("only"), F.col("id").cast("string")).alias("text"))
    prints = fingerprints.fingerprints(docs)
    assert prints.select("fingerprint").distinct().count() == 1_000
    known = fingerprints.fingerprints(docs, band=(0.0, 1.0)).select(F.split("fingerprint", " ").alias("h")).collect()
    assert len({r["h"][0] for r in known}) == 1_000 and all(len(r["h"][0]) >= 16 and min(map(len, r["h"][1:])) >= 8 for r in known)


def test_fingerprints_of_repeated_and_missing_ids(spark):
    got = fingerprints.compare_edits(brute.frame(spark)).collect()
    assert len(got) == len(brute.AWKWARD)
    edited = {r["doc_id"]: r["edited"] for r in got}
    assert edited[7] == brute.AWKWARD[6][1][: -(len(brute.AWKWARD[6][1]) // 2)] + brute.BASE[: len(brute.AWKWARD[6][1]) // 2]
    one = fingerprints.compare_edits(brute.frame(spark, [(1, "a b c", "en", "s")])).collect()[0]
    assert one["edited"] == "a b" + "a "
    assert fingerprints.compare_edits(brute.frame(spark, []).limit(0)).count() == 0
    assert hashlib.sha256(one["edited"].encode()).hexdigest() == spark.range(1).select(F.sha2(F.lit(one["edited"]), 256)).collect()[0][0]


def test_what_holds_for_all_terms_is_not_computed_for_each(spark):
    # a term needs one look into its bucket, without an exception to leave a loop, and one bit for each level
    plan = fingerprints.fingerprints(brute.frame(spark))._jdf.queryExecution().optimizedPlan().toString()
    assert "exists(" in plan and "aggregate(" in plan
    assert not [x for x in ("array_contains(", "pmod(", "getbit(") if x in plan]
