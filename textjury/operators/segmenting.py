"""Word segmentation of text without blanks, with a word list."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textjury.functions.text import char_ngrams
from textjury.operators.joins import HEAVY_KEYS
from textjury.operators.unknown_words import cut_stretches, viterbi
from textjury.plans.storage import stored

HAN = r"\p{IsHan}"
BROADCAST_WORDS = 500_000
BROADCAST_CHARACTERS = 16 * 1024 * 1024
SALTS = 64
#: Longest run that goes by broadcast, however many texts share it.
HEAVY_LENGTH = 1_024
#: Runs whose tokens a task keeps, and the longest of them: a run as long as a text hardly repeats, and its tokens take space.
CACHED_RUNS, CACHED_LENGTH = 20_000, 32
#: Pieces and characters that a task cuts before their tokens become Arrow arrays; until then each is a Python object.
CUT_PIECES, CUT_CHARACTERS = 16_384, 262_144
#: Rows whose tokens leave a task at once.
CUT_ROWS = 256
METHODS = ("longest", "frequency")


def pieces(text: Column, script: str = HAN) -> Column:
    """Runs of ``script`` (a character class), other letter and digit runs, single characters."""
    pattern = rf"[{script}]+|[\p{{L}}\p{{N}}&&[^{script}]]+|[^\p{{L}}\p{{N}}]"
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(pattern), F.lit(0))


def cutter(
    words: Iterable[tuple[str, int]], method: str, total: int, places: dict | None = None
) -> Callable[[str], list[str]]:
    """Cuts a run with the (word, count) pairs.

    ``longest`` takes the longest word at each place, ``frequency`` the cut whose words
    are likeliest together; a character that starts no word is a token. Only lengths of
    words with the same two first characters are tried, so a long word in the list costs
    nothing where its beginning does not occur.
    """
    counts = dict(words)
    lengths: dict[str, list[int]] = {}
    for word in counts:
        lengths.setdefault(word[:2], []).append(len(word))
    heads = {head: sorted(set(sizes), reverse=True) for head, sizes in lengths.items()}

    def sizes_at(run: str, at: int) -> Iterable[int]:
        sizes = heads.get(run[at : at + 2], ())
        return (n for n in sizes if at + n <= len(run) and run[at : at + n] in counts)

    def longest(run: str) -> list[str]:
        tokens, at = [], 0
        while at < len(run):
            size = next(iter(sizes_at(run, at)), 1)
            tokens.append(run[at : at + size])
            at += size
        return tokens

    def likeliest(run: str) -> list[str]:
        alone = -math.log(total + 1)  # a character by itself, as if it occurred less than once
        best: list[tuple[float, int]] = [(0.0, 0)] * (len(run) + 1)  # score of the rest, size of its first token
        for at in range(len(run) - 1, -1, -1):
            options = [(alone + best[at + 1][0], 1)]
            options += [
                (math.log(counts[run[at : at + n]] / (total + 1)) + best[at + n][0], n) for n in sizes_at(run, at)
            ]
            best[at] = max(options)
        tokens, at = [], 0
        while at < len(run):
            tokens.append(run[at : at + best[at][1]])
            at += best[at][1]
        return tokens

    listed = longest if method == "longest" else likeliest
    if places is None:
        return listed
    unknown = viterbi(places)
    return lambda run: cut_stretches(listed(run), unknown)


def segment(
    df: DataFrame,
    vocabulary: DataFrame,
    text: str = "text",
    out: str = "words",
    script: str = HAN,
    method: str = "longest",
    broadcast_words: int = BROADCAST_WORDS,
    places: dict | None = None,
) -> DataFrame:
    """Add the token array ``out``, cut with the words in ``vocabulary.token``.

    Inside a run of ``script`` words are found by ``method`` (see :func:`cutter`;
    ``frequency`` weighs by ``vocabulary.term_count``). Everything else is kept piece by
    piece. A word list of up to ``broadcast_words`` words is sent to the executors and
    each message is cut where it lies. A longer one is joined with the distinct runs, and
    each distinct text is put together once; the rows of ``df`` may repeat in any way.
    Both ways cut with the same function, so they give the same tokens. With ``places``, a
    model of :func:`textjury.operators.unknown_words.place_model`, stretches that no listed
    word covers are cut into their likeliest words; without, into single characters.
    """
    if method not in METHODS:
        raise ValueError(f"unknown method {method!r}, use one of {METHODS}")
    count = F.col("term_count") if "term_count" in vocabulary.columns else F.lit(1)
    known = (
        vocabulary.where(F.length("token") > 1)
        .groupBy("token")
        .agg(F.sum(F.greatest(count, F.lit(1))).cast("long").alias("term_count"))
    )
    size = known.agg(
        F.count(F.lit(1)).alias("words"),
        F.coalesce(F.sum(F.length("token")), F.lit(0)).alias("characters"),
        F.coalesce(F.sum("term_count"), F.lit(0)).alias("total"),
        F.sort_array(F.collect_set(F.length("token"))).alias("lengths"),
    ).first()
    if size["words"] <= broadcast_words and size["characters"] <= BROADCAST_CHARACTERS:
        return _segment_in_place(df, known, size["total"], text, out, script, method, places)
    if df.isStreaming:
        raise ValueError(f"a stream can be cut with at most {broadcast_words} words, got {size['words']}")
    return _segment_by_join(df, known, size["total"], size["lengths"], text, out, script, method, places)


def _values(column: pa.Array) -> list:
    return column.to_numpy(zero_copy_only=False).tolist()


def cut_rows(rows: pa.Array, marks: pa.Array, cut: Callable[[str], list[str]]) -> Iterator[pa.Array]:
    """The tokens of a batch, some rows at a time: an iterator's batches need not be those it got."""
    if not len(rows):
        yield cut_batch(rows, marks, cut)
    for at in range(0, len(rows), CUT_ROWS):
        yield cut_batch(rows[at : at + CUT_ROWS], marks[at : at + CUT_ROWS], cut)


def cut_batch(rows: pa.Array, marks: pa.Array, cut: Callable[[str], list[str]]) -> pa.Array:
    """The pieces of all rows in one sequence, cut some at a time, so that few tokens are Python objects at once."""
    ends = np.concatenate([[0], np.cumsum(rows.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))])
    flat, inside = rows.flatten(), marks.flatten()
    size_of = np.concatenate([[0], np.cumsum(pc.utf8_length(flat).fill_null(0).to_numpy(zero_copy_only=False))])
    tokens, before, at = [], np.zeros(len(flat) + 1, np.int64), 0
    while at < len(flat):
        most = int(np.searchsorted(size_of, size_of[at] + CUT_CHARACTERS, "right")) - 1
        end = min(max(at + 1, most), at + CUT_PIECES, len(flat))
        chunk, sizes = [], []
        for part, in_script in zip(_values(flat[at:end]), _values(inside[at:end])):
            found = cut(part) if in_script else (part,)
            chunk.extend(found)
            sizes.append(len(found))
        tokens.append(pa.array(chunk, pa.string()))
        before[at + 1 : end + 1] = before[at] + np.cumsum(sizes)
        at = end
    every = pa.concat_arrays(tokens) if tokens else pa.array([], pa.string())
    return pa.ListArray.from_arrays(pa.array(before[ends].astype(np.int32)), every)


def _segment_in_place(
    df: DataFrame, known: DataFrame, total: int, text: str, out: str, script: str, method: str, places: dict | None
) -> DataFrame:
    listed = list(known.toPandas().itertuples(index=False, name=None))
    sent = df.sparkSession.sparkContext.broadcast((listed, places))

    @F.arrow_udf(T.ArrayType(T.StringType()))
    def cut_all(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        words, model = sent.value
        cut = cutter(words, method, total, model)  # once per task
        cut_short = lru_cache(maxsize=CACHED_RUNS)(cut)  # runs repeat
        for rows, marks in batches:
            yield from cut_rows(rows, marks, lambda run: cut_short(run) if len(run) <= CACHED_LENGTH else cut(run))

    parts = pieces(F.col(text), script)
    inside = F.transform(parts, lambda part: part.rlike(rf"^[{script}]"))
    return df.withColumn(out, cut_all(parts, inside))


def _segment_by_join(
    df: DataFrame,
    known: DataFrame,
    total: int,
    lengths: list[int],
    text: str,
    out: str,
    script: str,
    method: str,
    places: dict | None,
) -> DataFrame:
    context = df.sparkSession.sparkContext
    sent = context.broadcast(places)
    whole = F.coalesce(F.col(text), F.lit(""))
    text_id = F.unhex(F.md5(whole.cast("binary")))
    texts = df.select(text_id.alias("text_id"), whole.alias("text")).dropDuplicates(["text_id"])
    in_script = F.regexp_extract_all("text", F.lit(f"[{script}]+"), F.lit(0))
    held = texts.select("text_id", F.explode(F.array_distinct(in_script)).alias("run"))
    runs = stored(held.groupBy("run").agg(F.count(F.lit(1)).alias("weight")), "runs")
    parts = F.flatten(F.array(*[char_ngrams(F.col("run"), n) for n in lengths], F.array().cast("array<string>")))
    candidates = runs.select("run", "weight", F.explode(F.array_distinct(parts)).alias("token"))
    found = salted_join(candidates, known, "token").groupBy("run", "weight").agg(
        F.collect_list(F.struct("token", "term_count")).alias("found")  # the words of one run
    )

    @F.pandas_udf(T.ArrayType(T.StringType()))
    def cut_runs(run: pd.Series, words: pd.Series, counts: pd.Series) -> pd.Series:
        return pd.Series([cutter(zip(w, c), method, total, sent.value)(r) for r, w, c in zip(run, words, counts)])

    cut = stored(
        found.select("run", "weight", cut_runs("run", F.col("found.token"), F.col("found.term_count")).alias("tokens")), "cut-runs"
    )
    # Each text meets its own runs, once each: those that very many texts share by broadcast, the rest by a join.
    uses = runs.agg(F.sum("weight").alias("n")).first()["n"] or 0
    is_heavy = (F.col("weight") > max(32, -(-uses // HEAVY_KEYS))) & (F.char_length("run") <= HEAVY_LENGTH)
    heavy = cut.where(is_heavy)  # under HEAVY_KEYS rows
    shared = context.broadcast({r["run"]: r["tokens"] for r in heavy.collect()})
    others = held.join(F.broadcast(heavy.select("run")), "run", "left_anti")
    own = others.join(cut.where(~is_heavy).select("run", "tokens"), "run").groupBy("text_id").agg(
        F.collect_list(F.struct("run", "tokens")).alias("own")  # the runs of one text
    )

    @F.arrow_udf(T.ArrayType(T.StringType()))
    def put_together(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        common = shared.value
        without_words = cutter([], method, total, sent.value)
        for batch in batches:
            for rows, marks, names, tokens in row_slices(*batch):
                of = dict(zip(names.flatten().to_pylist(), tokens.flatten().to_pylist()))
                yield cut_batch(rows, marks, lambda run: of.get(run) or common.get(run) or without_words(run))

    every = pieces(F.col("text"), script)
    marks = F.transform(every, lambda part: part.rlike(rf"^[{script}]"))
    none = F.array().cast("array<struct<run:string,tokens:array<string>>>")
    rebuilt = texts.join(own, "text_id", "left").withColumn("own", F.coalesce("own", none)).select(
        F.col("text_id").alias("_text_id"), put_together(every, marks, F.col("own.run"), F.col("own.tokens")).alias("_tokens")
    )
    joined = df.withColumn("_text_id", text_id).join(rebuilt, "_text_id", "left")
    tokens = F.coalesce("_tokens", F.array().cast("array<string>"))
    return joined.withColumn(out, tokens).drop("_text_id", "_tokens")


def row_slices(rows: pa.Array, *others: pa.Array) -> Iterator[tuple[pa.Array, ...]]:
    """Slices of up to ``CUT_ROWS`` rows and about ``CUT_PIECES`` pieces, at least a row each; one empty slice without rows."""
    ends = np.cumsum(rows.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
    at, columns = 0, (rows, *others)
    if not len(rows):
        yield columns
    while at < len(rows):
        most = int(np.searchsorted(ends, (ends[at - 1] if at else 0) + CUT_PIECES, "right"))
        end = min(max(at + 1, most), at + CUT_ROWS)
        yield tuple(column[at:end] for column in columns)
        at = end


def salted_join(left: DataFrame, right: DataFrame, on: str) -> DataFrame:
    """Join a table with hot keys to a small one that holds each key once.

    The rows of a key spread over ``SALTS`` partitions; the right side, a word
    list, is repeated that many times.
    """
    others = [c for c in left.columns if c != on]
    salted = left.withColumn("salt", F.pmod(F.xxhash64(*others), F.lit(SALTS)).cast("int"))
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    return salted.join(right.withColumn("salt", salts), [on, "salt"]).drop("salt")
