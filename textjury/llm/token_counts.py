"""Token counts as an exact length histogram.

Documents are encoded once and aggregated by their number of tokens. Suffix sums over
the lengths then answer totals, quantiles and truncated totals for every context limit.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Callable, Iterator, Sequence
from pathlib import Path

import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textjury.llm.common import stored

TOKENIZERS = "/opt/tokenizers"
RANKS = "byte_bpe_50k.tiktoken"
#: How this vocabulary's encoder cuts a text into pieces. A fixed value that belongs to the vocabulary.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: White space as that pattern's \s has it. Runs longer than LONG_RUN are cut out before encoding.
BLANK = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
LONG_RUN = 10_000
#: Lengths are summed within blocks of so many and over the blocks, so no task sees all lengths.
LENGTHS_PER_BLOCK = 4_096


def read_ranks(folder: str = TOKENIZERS, name: str = RANKS) -> dict[bytes, int]:
    """A vocabulary file: one base64 token and its rank per line."""
    lines = Path(folder, name).read_bytes().splitlines()
    return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


def counter(encoding: tiktoken.Encoding, long_run: int = LONG_RUN) -> Callable[[str], int]:
    """A function that counts a text's tokens, whatever runs of white space it has.

    The encoder's pattern steps back over a whole run of blanks, which overflows on very long
    ones. By the same pattern a run is one piece, without its last blank if something follows:
    that blank begins the next piece. So long runs are encoded as the pieces they are.
    """
    runs = re.compile(f"[{BLANK}]{{{long_run},}}")

    def count(text: str) -> int:
        total, done = 0, 0
        for run in runs.finditer(text):
            end = run.end() - (run.end() < len(text))
            if end == run.start():
                continue
            total += len(encoding.encode_ordinary(text[done : run.start()]))
            total += len(encoding._encode_single_piece(text[run.start() : end]))
            done = end
        return total + len(encoding.encode_ordinary(text[done:] if done else text))

    return count


def token_lengths(
    docs: DataFrame, ranks: dict[bytes, int], name: str = RANKS, pattern: str = PIECES, text: str = "text"
) -> DataFrame:
    """``docs`` as (n_tokens): one row per input row, whole texts encoded; null and empty texts have none."""
    sent = docs.sparkSession.sparkContext.broadcast(ranks)  # one vocabulary
    digest = hashlib.sha256(pattern.encode())
    for token in sorted(ranks):
        digest.update(b"%d %b " % (ranks[token], base64.b64encode(token)))
    kept = f"{name}-{digest.hexdigest()}"  # another vocabulary under the same name is another encoder

    def count(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = tiktoken.registry.ENCODINGS  # kept by the worker from task to task
        if kept not in held:
            held[kept] = tiktoken.Encoding(kept, pat_str=pattern, mergeable_ranks=sent.value, special_tokens={})
        length = counter(held[kept])
        for batch in rows:
            counts = [length(v) if v else 0 for v in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(counts, pa.int64())], names=["n_tokens"])

    return docs.select(F.col(text).alias("text")).mapInArrow(count, "n_tokens long")


def histogram(lengths: DataFrame) -> DataFrame:
    """(n_tokens, n_docs), one row per length that occurs."""
    return lengths.groupBy("n_tokens").agg(F.count("*").alias("n_docs"))


def suffix_sums(counted: DataFrame, per_block: int = LENGTHS_PER_BLOCK) -> DataFrame:
    """Each length with what a context limit of that length means.

    docs_at_least and tokens_at_least are over documents at least that long; truncated_total
    is the sum of min(length, limit) over all documents; docs_at_most / all is the quantile.
    """
    rows = counted.withColumns(
        {
            "block": F.floor(F.col("n_tokens") / per_block),
            "tokens": F.col("n_tokens") * F.col("n_docs"),
        }
    )
    blocks = rows.groupBy("block").agg(F.sum("n_docs").alias("docs"), F.sum("tokens").alias("sum_tokens"))
    later = Window.orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select(
        "block",
        F.coalesce(F.sum("docs").over(later), F.lit(0)).alias("docs_later"),
        F.coalesce(F.sum("sum_tokens").over(later), F.lit(0)).alias("tokens_later"),
        F.sum("docs").over(Window.partitionBy()).alias("all_docs"),
        F.sum("sum_tokens").over(Window.partitionBy()).alias("all_tokens"),
    )
    inside = Window.partitionBy("block").orderBy(F.desc("n_tokens")).rowsBetween(Window.unboundedPreceding, 0)
    summed = rows.withColumns(
        {"docs_here": F.sum("n_docs").over(inside), "tokens_here": F.sum("tokens").over(inside)}
    ).join(blocks, "block")
    docs_at_least = F.col("docs_here") + F.col("docs_later")
    tokens_at_least = F.col("tokens_here") + F.col("tokens_later")
    return summed.select(
        "n_tokens",
        "n_docs",
        docs_at_least.alias("docs_at_least"),
        tokens_at_least.alias("tokens_at_least"),
        (F.col("all_docs") - docs_at_least + F.col("n_docs")).alias("docs_at_most"),
        (F.col("all_tokens") - tokens_at_least + F.col("n_tokens") * docs_at_least).alias("truncated_total"),
    )


def truncated_totals(summed: DataFrame, limits: Sequence[int]) -> DataFrame:
    """(context_limit, docs_at_least, total): tokens that stay if every document is cut at the limit.

    The shortest length at or above a limit answers it: documents that long count with the
    limit, all others whole. ``total`` is null for an empty histogram.
    """
    reached = lambda x: F.min(
        F.when(F.col("n_tokens") >= x, F.struct("n_tokens", "docs_at_least", "tokens_at_least"))
    )
    answers = [F.struct(F.lit(int(x)).cast("long").alias("context_limit"), reached(x).alias("at")) for x in limits]
    rows = summed.agg(
        F.sum(F.col("n_tokens") * F.col("n_docs")).alias("all_tokens"), F.array(*answers).alias("answers")
    ).select("all_tokens", F.inline("answers"))
    docs = F.coalesce("at.docs_at_least", F.lit(0))
    total = F.col("all_tokens") - F.coalesce("at.tokens_at_least", F.lit(0)) + F.col("context_limit") * docs
    return rows.select("context_limit", docs.alias("docs_at_least"), total.alias("total"))


def quantiles(summed: DataFrame, shares: Sequence[float]) -> DataFrame:
    """(share, n_tokens): the least length that so large a share of the documents does not exceed."""
    all_docs = F.max("docs_at_most").over(Window.partitionBy())
    rows = summed.select("n_tokens", (F.col("docs_at_most") / all_docs).alias("upto"))
    return rows.agg(
        F.array(
            *[F.struct(F.lit(float(s)).alias("share"), F.min(F.when(F.col("upto") >= s, F.col("n_tokens"))).alias("n_tokens")) for s in shares]
        ).alias("x")
    ).select(F.inline("x"))


def token_histogram(
    docs: DataFrame,
    folder: str = TOKENIZERS,
    vocabulary: str = RANKS,
    text: str = "text",
) -> DataFrame:
    """The suffix-summed length histogram of all whole texts under a byte-level BPE vocabulary.

    Null and empty texts have length 0. Repeated rows count each. An empty table gives an
    empty histogram. Other columns are ignored.
    """
    lengths = token_lengths(docs, read_ranks(folder, vocabulary), vocabulary, text=text)
    return suffix_sums(stored(histogram(lengths), "token-histogram"))
