from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from textjury.functions.arrays import counted
from textjury.functions.hashing import md5_bucket
from textjury.functions.text import char_ngrams, clean, strip
from textjury.operators.tokenizing import token_counts, token_rows, tokenize, vocabulary

SAMPLES = [
    "",
    "a",
    "Hello, World  x9!",
    "南口阿玛施新春第一批  春暖花开、冰蓝色",
    "Don’tSellaProduct\u3000tab\there\nnext",
    "\ue001private \u200bzero\u00ad-width\uf8ff",
    "emoji 😀😀 ok",
    None,
]
quick = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))


def texts(spark, values):
    return spark.createDataFrame(list(enumerate(values)), "doc_id LONG, text STRING")


def by_id(df, column):
    return {r["doc_id"]: r[column] for r in df.collect()}


def test_keep_all_loses_nothing(spark):
    words = by_id(tokenize(texts(spark, SAMPLES)), "words")
    for i, text in enumerate(SAMPLES):
        assert "".join(words[i]) == (text or "")
    assert words[2] == ["Hello", ",", " ", "World", " ", " ", "x9", "!"]


def test_word_mode_and_case(spark):
    words = by_id(tokenize(texts(spark, SAMPLES), "word", lowercase=True), "words")
    assert words[2] == ["hello", "world", "x9"]
    assert words[7] == []


def test_unknown_mode(spark):
    with pytest.raises(ValueError, match="unknown tokenizer mode"):
        tokenize(texts(spark, SAMPLES), "magic")


@pytest.mark.parametrize("n", [1, 2, 3])
def test_char_ngrams(spark, n):
    grams = by_id(texts(spark, SAMPLES).withColumn("g", char_ngrams(F.coalesce("text", F.lit("")), n)), "g")
    for i, text in enumerate(SAMPLES):
        text = text or ""
        assert grams[i] == [text[j : j + n] for j in range(len(text) - n + 1)]


@quick
@given(st.lists(st.lists(st.sampled_from(["a", "b", "c", "号", ""]), max_size=12), min_size=1, max_size=20))
def test_counted_equals_counter(spark, rows):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "doc_id LONG, words ARRAY<STRING>")
    got = by_id(df.select("doc_id", counted(F.col("words"), "v", "n").alias("c")), "c")
    for i, row in enumerate(rows):
        assert {c["v"]: c["n"] for c in got[i]} == Counter(row)
        assert len(got[i]) == len(set(row))


def test_clean(spark):
    got = by_id(texts(spark, SAMPLES).withColumn("c", clean(F.col("text"))), "c")
    assert got[4] == "Don’tSellaProduct tab here next"
    assert got[5] == "private zero-width"
    assert got[7] is None


@pytest.mark.parametrize("edge", [" ", "\t", "\u3000", "\u00a0", "\x85", "\x1c", "\u2028", ""])
def test_strip_is_python_strip(spark, edge):
    text = f"{edge}{edge}a{edge}b{edge}"
    assert texts(spark, [text]).select(strip(F.col("text"))).first()[0] == text.strip()


def test_vocabulary_and_counts(spark):
    df = tokenize(texts(spark, ["a b a", "b", "c c c", ""]), "word")
    rows = {r["token"]: (r["term_count"], r["doc_count"]) for r in vocabulary(df).collect()}
    assert rows == {"a": (2, 1), "b": (2, 2), "c": (3, 1)}
    counts = {(r["doc_id"], r["token"]): r["n"] for r in token_counts(df).collect()}
    assert counts == {(0, "a"): 2, (0, "b"): 1, (1, "b"): 1, (2, "c"): 3}
    assert token_rows(df).count() == 7


def test_counting_needs_no_shuffle(spark, capsys):
    token_counts(tokenize(texts(spark, ["a"]))).explain()
    assert "Exchange" not in capsys.readouterr().out


def test_md5_bucket(spark):
    import hashlib

    values = ["", "a", "号", "x" * 1000]
    got = by_id(texts(spark, values).withColumn("b", md5_bucket(F.col("text"), 97)), "b")
    for i, value in enumerate(values):
        assert got[i] == int(hashlib.md5(value.encode()).hexdigest()[:8], 16) % 97


@pytest.mark.parametrize(
    "text, expected",
    [
        ("以上比赛，ok 吗", ["以上", "上比", "比赛", "，", "ok", " ", "吗"]),
        ("plain, text", ["plain", ",", " ", "text"]),
        ("x号12かな", ["x", "号", "12", "かな"]),
        ("", []),
        (None, []),
    ],
)
def test_mixed_mode(spark, text, expected):
    df = spark.createDataFrame([(text,)], "text STRING")
    assert tokenize(df, "mixed").first()["words"] == expected
