from pathlib import Path

import pytest
from pyspark.sql import functions as F

from textjury.llm import token_counts

TEXTS = ["Hello world, hello!", "", None, "été  où\n\n\tx", "a" * 5000, "it's 1234 <|endoftext|> 😀", "Hello world, hello!"]
PUBLIC = Path(token_counts.TOKENIZERS, "byte_bpe_50k.json")


@pytest.fixture(scope="module")
def lengths():
    tokenizers = pytest.importorskip("tokenizers")
    tokenizer = tokenizers.Tokenizer.from_file(str(PUBLIC))
    tokenizer.encode_special_tokens = True
    return [len(tokenizer.encode(t or "", add_special_tokens=False).ids) for t in TEXTS]


def test_lengths_equal_another_library(documents, lengths):
    docs = documents(list(enumerate(TEXTS)))
    got = token_counts.token_lengths(docs.coalesce(1), token_counts.read_ranks()).collect()
    assert [r["n_tokens"] for r in got] == lengths


def brute(lengths):
    return sorted(
        (
            x,
            lengths.count(x),
            sum(y >= x for y in lengths),
            sum(y for y in lengths if y >= x),
            sum(y <= x for y in lengths),
            sum(min(x, y) for y in lengths),
        )
        for x in set(lengths)
    )


@pytest.mark.parametrize("per_block", [1, 3, 4096])
def test_suffix_sums(spark, per_block):
    lengths = [0, 0, 1, 2, 2, 3, 7, 8, 9, 100, 5000, 5000]
    table = spark.createDataFrame([(x,) for x in lengths], "n_tokens long")
    got = token_counts.suffix_sums(token_counts.histogram(table), per_block)
    assert sorted(map(tuple, got.collect())) == brute(lengths)


def test_limits_and_quantiles(spark):
    lengths = [0, 1, 2, 2, 10, 50]
    summed = token_counts.suffix_sums(token_counts.histogram(spark.createDataFrame([(x,) for x in lengths], "n_tokens long")))
    got = {r["context_limit"]: (r["docs_at_least"], r["total"]) for r in token_counts.truncated_totals(summed, [0, 2, 5, 50, 99]).collect()}
    assert got == {x: (sum(y >= x for y in lengths), sum(min(x, y) for y in lengths)) for x in (0, 2, 5, 50, 99)}
    at = {r["share"]: r["n_tokens"] for r in token_counts.quantiles(summed, [0.5, 0.9, 1.0, 0.01]).collect()}
    assert at == {0.5: 2, 0.9: 50, 1.0: 50, 0.01: 0}


def test_query_over_odd_rows(spark, documents, tmp_path, lengths):
    from textjury.llm.queries import QUERIES

    docs = documents([*enumerate(TEXTS), (None, "x")]).withColumns({"n_tokens": F.lit(1), "block": F.lit("b")})
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = QUERIES["op3_token_histogram"](spark, str(tmp_path))
    assert sorted(map(tuple, got.collect())) == brute([*lengths, 1])
    assert token_counts.token_histogram(docs.limit(0)).count() == 0


def encoding():
    ranks = token_counts.read_ranks()
    return token_counts.tiktoken.Encoding("t", pat_str=token_counts.PIECES, mergeable_ranks=ranks, special_tokens={})


RUNS = [" " * 40, "\n" * 30, " \n\t " * 20, "  　" * 15, "\x1c\x1d" * 20, "​" * 30, "\r\n" * 25]


@pytest.mark.parametrize("run", RUNS, ids=range(len(RUNS)))
def test_cut_runs_count_as_the_encoder_does(run):
    whole = encoding()
    cut = token_counts.counter(whole, long_run=8)
    for before in ("", "a", "x.", "1"):
        for after in ("", "b", "!", "2", "'s", " b", "é"):
            for text in (before + run + after, before + run + after + run, run + before + run * 2 + after):
                assert cut(text) == len(whole.encode_ordinary(text)), repr((before, after))


def test_millions_of_blanks(documents):
    n = 5_000_000
    docs = documents([(0, " " * n + "a"), (1, "a" + "\n" * n), (2, (" " * n + "\n") * 2), (3, "b")])
    rows = token_counts.token_lengths(docs.coalesce(1), token_counts.read_ranks()).collect()
    one = encoding()
    piece = lambda text: len(one._encode_single_piece(text))
    assert [r["n_tokens"] for r in rows] == [piece(" " * (n - 1)) + 1, 1 + piece("\n" * n), piece((" " * n + "\n") * 2), 1]


def test_same_name_another_vocabulary(documents):
    ranks = token_counts.read_ranks()
    few = {token: rank for token, rank in ranks.items() if len(token) == 1}
    docs = documents([(0, "hello there")]).coalesce(1)
    counts = [token_counts.token_lengths(docs, r).first()["n_tokens"] for r in (ranks, few, ranks)]
    assert counts == [2, 11, 2]
