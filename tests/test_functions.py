import json
import math
import random
import struct

import numpy as np
import pytest
from loomwright.functions import codec, completions, positions, prompts, signals, text
from loomwright.operators.corpus import Group, check_groups, rounds
from loomwright.operators.sampling import allocate, allocate_groups
from pyspark.sql import functions as F

# text


def test_newlines_lossy_and_preview(spark):
    df = spark.createDataFrame([("a\r\nb\rc\n", bytearray(b"ab\xff\xfe\xe2\x82"), "x" * 9 + "\n")], "t string, b binary, p string")
    got = df.select(text.unix_newlines(F.col("t")), text.lossy(F.col("b")), text.preview(F.col("p"), 5), text.base64_line(F.lit(b"x" * 100)), text.stripped(F.lit(" \n a b \x85")), text.shard_id(F.lit("train-shard-00003"))).first()
    assert got[0] == "a\nb\nc\n" and got[1] == b"ab\xff\xfe\xe2\x82".decode("utf-8", "replace") and got[2] == "xxxxx..."
    assert "\r" not in got[3] and got[4] == "a b" and got[5] == "00003"


def test_lossy_is_like_decoding_with_replacement(spark):
    rng = random.Random(3)
    rows = [(bytearray(rng.choice([0x41, 0xC3, 0xA9, 0xE2, 0x82, 0xAC, 0xF0, 0x9F, 0x98, 0x80, 0xFF, 0xED, 0xA0]) for _ in range(rng.randint(0, 9))),) for _ in range(200)]
    df = spark.createDataFrame(rows, "b binary")
    for r in df.select("b", text.lossy(F.col("b")).alias("t")).collect():
        assert r["t"] == bytes(r["b"]).decode("utf-8", "replace")


# positions


def one(spark, schema, row, *cols):
    return spark.createDataFrame([row], schema).select(*cols).first()


def test_masks(spark):
    e, g = [0.1, 0.7, 1.0, 0.3], [0.5, 0.1, 0.3, 0.05]
    got = one(spark, "e array<double>, g array<double>", (e, g), positions.at_least(F.col("e"), 0.7), positions.at_most(F.col("g"), 0.1))
    assert got[0] == [False, True, True, False] and got[1] == [False, True, False, True]
    a, b = [False, True, True, False], [True, True, False, False]
    got = one(spark, "a array<boolean>, b array<boolean>", (a, b), positions.combined(F.col("a"), F.col("b")), positions.combined(F.col("a"), F.col("b"), "intersection"))
    assert got[0] == [True, True, True, False] and got[1] == [False, True, False, False]
    with pytest.raises(ValueError):
        positions.combined(F.col("a"), F.col("b"), "xor")
    with pytest.raises(Exception, match="differ in length"):
        one(spark, "a array<boolean>, b array<boolean>", (a, b[:2]), positions.combined(F.col("a"), F.col("b")))


def plain_windows(mask, radius):
    out = []
    for i in (i for i, m in enumerate(mask) if m):
        s, e = max(0, i - radius), min(len(mask) - 1, i + radius)
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((s, e))
    return out


def plain_minimum(mask, least):
    out, need = list(mask), least - sum(mask)
    for i, m in enumerate(mask):
        if not m and need > 0:
            out[i], need = True, need - 1
    return out


def test_windows_and_minimum_against_plain_loops(spark):
    rng = random.Random(1)
    masks = [[], [True], [False], [False, True, False, False, True, False]] + [[rng.random() < rng.choice([0.1, 0.5, 0.9]) for _ in range(rng.randint(1, 40))] for _ in range(150)]
    df = spark.createDataFrame([(i, m) for i, m in enumerate(masks)], "i int, m array<boolean>")
    for radius in (0, 1, 3):
        got = {r[0]: [tuple(w) for w in r[1]] for r in df.select("i", positions.windows(F.col("m"), radius)).collect()}
        assert all(got[i] == [(*w, sum(m[w[0] : w[1] + 1])) for w in plain_windows(m, radius)] for i, m in enumerate(masks))
    for least in (0, 2, 7, 100):
        got = dict(map(tuple, df.select("i", positions.with_minimum(F.col("m"), least)).collect()))
        assert all(got[i] == plain_minimum(m, least) for i, m in enumerate(masks))


def test_overlapping_windows_merge_and_neighbours_do_not(spark):
    got = one(spark, "w array<struct<start:int,end:int>>", ([(2, 4), (0, 2), (8, 9), (5, 7)],), positions.merged(F.col("w")))[0]
    assert [tuple(w) for w in got] == [(0, 4), (5, 7), (8, 9)]


def test_policies_need_their_signals(spark):
    df = spark.createDataFrame([([0.1, 0.9], None)], "e array<double>, g array<double>")
    assert df.select(positions.select(F.col("e"), F.col("g"), None, None, minimum=1)).first()[0] == [True, False]
    with pytest.raises(Exception, match="per_token_top1_gap is required"):
        df.select(positions.select(F.col("e"), F.col("g"), None, 0.1)).collect()
    with pytest.raises(ValueError):
        positions.select(None, F.col("g"), 0.1, None)


# signals


def test_entropy_gap_width_and_padding(spark):
    rows = [[-0.1, -2.0, -3.0], [], [-0.5]]

    def entropy(r):
        p = [math.exp(x) for x in r]
        return -sum(x / sum(p) * math.log(x / sum(p)) for x in p)

    got = one(spark, "r array<array<double>>", (rows,), signals.mean_entropy(F.col("r")), signals.top_gaps(F.col("r")), signals.width(F.col("r")), F.transform("r", lambda x: signals.padded_logprobs(x, 2)))
    assert got[0] == pytest.approx((entropy(rows[0]) + 0) / 2) and got[1] == [pytest.approx(1.9), 0.0, 0.0] and got[2] == pytest.approx(4 / 3)
    assert got[3] == [[-0.1, -2.0], [0.0, 0.0], [-0.5, -0.5]]
    assert [tuple(x) for x in one(spark, "m map<int,double>", ({5: -1.0, 2: -1.0, 9: -0.5},), signals.top_k(F.col("m"), 2))[0]] == [(9, -0.5), (2, -1.0)]


@pytest.mark.parametrize(("ids", "lps", "entropy", "said"), [
    ([[1, 2]], [[-0.1, -0.2]], 0.5, None), ([[1]], [[-0.1], [-0.2]], 0.5, "differ in rows"), ([[1, 2]], [[-0.1]], 0.5, "differ in number"), ([[1, 2]], [[-0.3, -0.2]], 0.5, "descending"),
    ([[1]], [[float("nan")]], 0.5, "finite"), ([[1]], [[-0.1]], -1.0, "entropy"), ([[9]], [[-0.1]], 0.5, "vocabulary"), ([[1], [2]], [[-0.1], [-0.2]], 0.5, "as many rows"),
])
def test_checks_of_outputs(spark, ids, lps, entropy, said):
    got = one(spark, "i array<array<long>>, l array<array<double>>, e double", (ids, lps, entropy), signals.problem(F.col("i"), F.col("l"), F.col("e"), F.lit(2), 9))[0]
    assert got is None if said is None else said in got


# prompts, responses


def test_prompts(spark):
    df = spark.createDataFrame([("d1", 3, bytearray("50% {text} é".encode()))], "doc_id string, chunk_index int, raw_bytes binary")
    got = df.select(prompts.prompt("summarize_chunk", {"max_words": 7}), prompts.prompt("answer_question_from_chunk", {"question": "Why {chunk}?"}), prompts.prompt("continue_document"), prompts.prompt("extract_key_points")).first()
    assert got[0] == "Summarize the following chunk in at most 7 words.\nDocument: d1\nChunk: 3\n\nChunk text:\n50% {text} é\n"
    assert got[1].startswith("Answer the question using only the provided chunk.\nQuestion: Why {chunk}?\nDocument: d1\n")
    assert "about 128 tokens" in got[2] and "Current excerpt:\n50%" in got[2] and "up to 5 key points" in got[3]
    with pytest.raises(ValueError):
        prompts.template("none")


def test_completions(spark):
    body = '{"choices":[{"text":"hi","logprobs":{"prompt_token_ids":[11,22,33],"top_logprobs":[null,{"22":-0.2,"7":-0.5},{"33":-0.3,"x":-0.6}]}}],"tokens":[1,2,3]}'
    got = one(spark, "b string", (body,), completions.top_rows(F.col("b"), 2), completions.token_count(F.col("b")), completions.prompt_tokens(F.col("b")), completions.completion_text(F.col("b")))
    assert [[tuple(p) for p in r] for r in got[0]] == [[(22, -0.2), (7, -0.5)], [(33, -0.3)]]
    assert got[1] == 3 and got[2] == [11, 22, 33] and got[3] == "hi"
    bad = '{"choices":[{"logprobs":{"top_logprobs":[{"the":-0.2}]}}]}'
    assert one(spark, "b string", (bad,), completions.top_rows(F.col("b"), 2))[0] is None


# codec


def test_half_is_that_of_struct(spark):
    rng = random.Random(2)
    values = [0.0, 0.1, 1.23, -1.23, 65504.0, 1e-7, 6e-8, 2.9e-8, -5.96e-8, 1.0, 2.0**-14, 2.0**-15 * 1.3, 2048.5, 2049.5] + [rng.uniform(-10, 10) * 10 ** rng.randint(-8, 3) for _ in range(500)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    for v, h in df.select("v", codec.half(F.col("v"))).collect():
        assert h == struct.unpack("<e", struct.pack("<e", v))[0]
    with pytest.raises(Exception, match="16 bits"):
        spark.createDataFrame([(65_520.0,)], "v double").select(codec.half(F.col("v"))).collect()


def test_pack_and_decode(spark):
    for rows in ([[1, 2], [3, 255]], [[256]], [[70_000, 1]], []):
        packed = codec.pack(rows)
        assert codec.decode(packed) == rows
        flat = spark.createDataFrame([(rows,)], "r array<array<long>>").select(codec.pack_ids(F.col("r"))).first()[0].asDict()
        assert flat == packed
    assert codec.pack([[1], [2, 3]]) == [[1], [2, 3]] and codec.decode("x") == "x"
    assert codec.decode(codec.pack([0.1, -2.5], True)) == pytest.approx([0.1, -2.5], abs=1e-3)
    for bad in ([[-1]], [[2**32]]):
        with pytest.raises(OverflowError):
            codec.pack(bad)
    with pytest.raises(ValueError):
        codec.decode({"encoding": codec.ENCODING, "dtype": "int8", "shape": [1], "data_b64": "AA=="})


# allocation


def test_largest_remainders_and_their_ties():
    assert allocate(10, [1, 1, 1]) == [3, 3, 4] and allocate(11, [1, 1, 1]) == [3, 4, 4] and allocate(0, [1]) == [0] and allocate(5, [0, 0]) == [0, 0]
    assert allocate_groups(10, {"a": 33.3, "b": 33.3, "c": 33.4}) == {"a": 3, "b": 3, "c": 4}
    assert allocate_groups(1, {"a": 50, "b": 50}) == {"a": 0, "b": 1}


def test_rounds_are_one_by_one():
    rng = random.Random(4)
    order = lambda r, g: ((r * 7 + ord(g)) % 5, g)
    for _ in range(200):
        left = {g: rng.randint(0, 6) for g in "abcd"}
        short, want, rest, r = rng.randint(0, 30), dict.fromkeys("abcd", 0), dict(left), 0
        todo = min(short, sum(left.values()))
        while todo:
            r += 1
            for g in sorted((g for g in rest if rest[g]), key=lambda g: order(r, g)):  # noqa: B023
                if todo:
                    want[g], rest[g], todo = want[g] + 1, rest[g] - 1, todo - 1
        assert rounds(left, short, order) == want


def test_groups_are_checked():
    good = Group("a", 100, ("s",))
    check_groups([good], ["s"])
    for bad in ([], [good._replace(percentage=99)], [good._replace(name="")], [good._replace(sources=())], [good._replace(sources=("t",))]):
        with pytest.raises(ValueError):
            check_groups(bad, ["s"])


def test_lines_of_vectors_are_those_of_pack(spark):
    matrices = [None, [], [[]], [[], []], [[1, 2], [3, 400]], [[70_000]], [[1], [2, 3]], [[0] * 5] * 3]
    halves = [None, [], [0.5, -2.25], [1e-8, 65_000.0]]
    bools = [None, [], [True, False, True]]
    rows = [(i, matrices[i % 8], [halves[i % 4]] if i % 3 and halves[i % 4] is not None else None, halves[i % 4], bools[i % 3]) for i in range(60)]
    df = spark.createDataFrame(rows, "i int, m array<array<long>>, n array<array<double>>, v array<double>, b array<boolean>").repartition(3)
    packed = df.select("i", codec.packed_lines(F.col("m")).alias("m"), codec.packed_lines(F.col("n"), True).alias("n"), codec.packed_lines(F.col("v"), True).alias("v"), codec.packed_lines(F.col("b")).alias("b"))
    line = lambda x, floats=False: None if x is None else json.dumps(codec.pack([int(y) if isinstance(y, bool) else y for y in x], floats))
    assert {r[0]: tuple(r)[1:] for r in packed.collect()} == {i: (line(m), line(n, True), line(v, True), line(b)) for i, m, n, v, b in rows}
    back = packed.select("i", codec.unpacked_lines(F.col("m"), "array<array<long>>"), codec.unpacked_lines(F.col("n"), "array<array<double>>"), codec.unpacked_lines(F.col("v"), "array<double>"), codec.unpacked_lines(F.col("b"), "array<long>"))
    half = lambda v: None if v is None else np.array(v, "<f2").astype(float).tolist()
    assert {r[0]: tuple(r)[1:] for r in back.collect()} == {i: (m, None if n is None else [half(x) for x in n], half(v), None if b is None else [int(x) for x in b]) for i, m, n, v, b in rows}
    one_row = spark.createDataFrame([(json.dumps(codec.pack([4, 5])),), ("[6, 7]",)], "t string").select(codec.unpacked_lines(F.col("t"), "array<array<long>>"))
    assert [r[0] for r in one_row.collect()] == [[[4, 5]], [[6, 7]]]
    with pytest.raises(Exception, match="32 bits"):
        spark.createDataFrame([([-1],)], "v array<long>").select(codec.packed_lines(F.col("v"))).collect()


def test_masks_are_made_in_one_pass(spark):
    rows = spark.sql("""select * from values (array(1d, 3d, null, double('nan')), array(0.1d, null, 0.9d, 0.2d)), (array(), array()), (array(2d), array(5d)) as t(e, g)""")
    for mode in ("union", "intersection"):
        fused = positions.select(F.col("e"), F.col("g"), 2.0, 0.2, mode)
        apart = positions.combined(positions.at_least(F.col("e"), 2.0), positions.at_most(F.col("g"), 0.2), mode)
        got = rows.select(fused.alias("a"), apart.alias("b"), positions.selected(fused).alias("on"))
        assert got._jdf.queryExecution().analyzed().toString().split(" AS a#")[0].count("lambdafunction(") == 1
        for r in got.collect():
            assert r["a"] == r["b"] and r["on"] == [i for i, x in enumerate(r["a"]) if x]
    assert rows.select(positions.selected(F.lit(None).cast("array<boolean>")).alias("on")).first()["on"] == []
