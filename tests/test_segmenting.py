import math
import random
import re
import time
import tracemalloc

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from textjury.operators.segmenting import CUT_ROWS, HEAVY_LENGTH, cut_batch, cutter, row_slices, salted_join, segment

WORDS = ["比赛", "规则", "江苏", "江苏科技大学", "科技", "大学", "负责", "解释", "以上", "教职工", "摄影协会"]


def longest_match(text, known):
    longest = max(map(len, known))
    tokens = []
    for piece in re.findall(r"[一-鿿]+|[^\W_一-鿿]+|.", text, re.S):
        if not "一" <= piece[0] <= "鿿":
            tokens.append(piece)
            continue
        start = 0
        while start < len(piece):
            size = next(
                (n for n in range(longest, 1, -1) if piece[start : start + n] in known and start + n <= len(piece)), 1
            )
            tokens.append(piece[start : start + size])
            start += size
    return tokens


def messages():
    rng = random.Random(3)
    parts = WORDS + ["由", "共", "x号", " ", "，", "abc", "技大", "学江"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(0, 25))) for _ in range(60)]
    return texts + ["以上比赛规则由江苏科技大学教职工摄影协会负责解释"] * 40 + [""]


@pytest.mark.parametrize("broadcast_words", [1000, 2])
def test_both_ways_equal_brute_force(spark, broadcast_words):
    texts = messages()
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id LONG, text STRING")
    known = spark.createDataFrame([(w,) for w in WORDS], "token STRING")
    got = segment(df, known, broadcast_words=broadcast_words)
    for row in got.collect():
        assert row["words"] == longest_match(row["text"], set(WORDS)), row["text"]


@pytest.mark.parametrize("broadcast_words", [1000, 0])
def test_repeated_rows_and_nulls(spark, broadcast_words):
    rows = [(7, "abcd x"), (7, "abcd x"), (7, "cdab"), (None, "ab"), (8, None), (9, "")]
    df = spark.createDataFrame(rows, "doc_id LONG, text STRING")
    known = spark.createDataFrame([("ab",), ("cd",), ("cd",)], "token STRING")
    got = segment(df, known, script=r"\p{L}", broadcast_words=broadcast_words).collect()
    expected = [(7, ["ab", "cd", " ", "x"])] * 2 + [(7, ["cd", "ab"]), (None, ["ab"]), (8, []), (9, [])]
    assert sorted(((r["doc_id"], r["words"]) for r in got), key=repr) == sorted(expected, key=repr)


def likeliest(run, counts, total):
    """All cuts of a run, by brute force."""
    if not run:
        return 0.0, []
    options = []
    for n in range(1, len(run) + 1):
        word = run[:n]
        if n > 1 and word not in counts:
            continue
        weight = math.log(counts[word] / (total + 1)) if n > 1 else -math.log(total + 1)
        rest, tokens = likeliest(run[n:], counts, total)
        options.append((weight + rest, [word, *tokens]))
    return max(options, key=lambda o: o[0])


@pytest.mark.parametrize("broadcast_words", [1000, 0])
def test_frequency(spark, broadcast_words):
    counts = {"ab": 50, "abc": 2, "cd": 40, "bcd": 90, "de": 3, "dea": 30}
    rng = random.Random(5)
    texts = ["".join(rng.choice("abcde") for _ in range(rng.randrange(1, 9))) for _ in range(80)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id LONG, text STRING")
    known = spark.createDataFrame(list(counts.items()), "token STRING, term_count LONG")
    got = segment(df, known, script=r"\p{L}", method="frequency", broadcast_words=broadcast_words).collect()
    total = sum(counts.values())
    for row in got:
        score = sum(math.log(counts[w] / (total + 1)) if len(w) > 1 else -math.log(total + 1) for w in row["words"])
        assert "".join(row["words"]) == row["text"]
        assert score == pytest.approx(likeliest(row["text"], counts, total)[0])


@pytest.mark.parametrize("broadcast_words", [1000, 0])
def test_a_long_word_in_the_list_costs_nothing_elsewhere(spark, broadcast_words):
    df = spark.createDataFrame([(1, "xy" * 2000)], "doc_id LONG, text STRING")
    known = spark.createDataFrame([("z" * 1000,), ("yx",)], "token STRING")
    started = time.monotonic()
    words = segment(df, known, script=r"\p{L}", broadcast_words=broadcast_words).first()["words"]
    assert words == ["x", *["yx"] * 1999, "y"] and time.monotonic() - started < 30


def test_streams_need_a_list_that_can_be_sent(spark, tmp_path):
    stream = spark.readStream.schema("text STRING").parquet(str(tmp_path))
    known = spark.createDataFrame([("ab",), ("cd",)], "token STRING")
    with pytest.raises(ValueError, match="at most 1 words"):
        segment(stream, known, broadcast_words=1)
    with pytest.raises(ValueError, match="unknown method"):
        segment(stream, known, method="other")


def test_salted_join_keeps_every_row_of_a_hot_key(spark):
    left = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 50)).alias("token"))
    right = spark.createDataFrame([("hot",), ("k1",)], "token STRING")
    got = salted_join(left, right, "token").groupBy("token").count().collect()
    expected = left.join(right, "token").groupBy("token").count().collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, expected))


def test_a_batch_is_cut_with_few_tokens_as_python_objects():
    rows, length = 400, 5_000
    parts = pa.array([["ab" * (length // 2), " "]] * rows + [[]])
    marks = pa.array([[True, False]] * rows + [[]])
    cut = cutter([("ab", 1)], "longest", 1)
    tracemalloc.start()
    got = cut_batch(parts, marks, cut)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert got.value_lengths().to_pylist() == [length // 2 + 1] * rows + [0]
    assert got[rows - 1].as_py() == ["ab"] * (length // 2) + [" "]
    assert most < 25e6  # all tokens at once are 1,000,400 strings


def test_hot_and_long_runs_joined(spark):
    """Runs of all texts go by broadcast, rare and very long ones by the join; all are put together as in place."""
    long = "ab" * HEAVY_LENGTH
    texts = [f"abx, cab {chr(97 + i % 26) * (i // 26 + 1)}! {long if i % 2 else ''}{i}" for i in range(80)] + [None, "", "..."]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts * 2)], "id int, text string")
    known = spark.createDataFrame([("ab", 3), ("cab", 1), ("zz", 2)], "token string, term_count long")
    for method in ("longest", "frequency"):
        ways = [
            sorted((r["id"], r["words"]) for r in segment(df, known, script=r"\p{L}", method=method, **extra).collect())
            for extra in ({}, {"broadcast_words": 0})
        ]
        assert ways[0] == ways[1] and len(ways[0]) == len(texts) * 2
    assert ways[1][0][1][:4] == ["ab", "x", ",", " "]


def test_only_distinct_runs_of_a_text_are_joined(spark):
    """The pieces of a text do not become rows: what is exploded are its distinct runs."""
    df = spark.createDataFrame([("ab ab ab, ab!",)], "text string")
    known = spark.createDataFrame([("ab",)], "token string")
    cut = segment(df, known, script=r"\p{L}", broadcast_words=0)
    plan = cut._jdf.queryExecution().optimizedPlan().toString()
    assert "explode(array_distinct(" in plan and "posexplode(" not in plan
    assert cut.first()["words"] == ["ab", " ", "ab", " ", "ab", ",", " ", "ab", "!"]


def test_row_slices_cover_all_rows():
    lists = pa.array([["x"] * 9_000, None, ["y"] * 40_000, [], *[["z"]] * 600])
    sizes = [len(s[0]) for s in row_slices(lists)]
    assert sizes[:2] == [2, 1] and sum(sizes) == len(lists) and max(sizes) <= CUT_ROWS
    assert [len(s[0]) for s in row_slices(lists[:0])] == [0]
