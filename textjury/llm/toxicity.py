"""Toxicity by weak supervision.

Many small voters, each a word or a word beginning that is typical of labelled toxic
texts, vote on every document. A generative label model estimates from all documents
how accurate each voter is and how far voters fire together, and gives each pattern of
votes a posterior. A logistic regression over the votes is trained on these posteriors
and scores the documents.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textjury.llm.common import row_crc, stored, unused

#: Labelled rows that voters are mined from, at most: those with the least hash of their id.
FIT_ROWS = 20_000
VOTERS = 256
CANDIDATES = 50_000
LEAST_SUPPORT = 3  # labelled toxic rows
LEAST_RATIO = 10.0  # of a voter's rate in toxic rows to that in others
#: Evidence, in nats, that a voter's rows are not toxic by chance alone: above the log of all candidates.
LEAST_EVIDENCE = math.log(CANDIDATES) + 2
PREFIXES = (3, 4, 5, 6, 7)
REPEATS = 3
EM_ROUNDS = 4
THRESHOLD = 0.7

WORD = re.compile(r"[^\W\d_]+")


def terms(text: str | None) -> set[str]:
    """What voters look for: the text's words, and the beginnings of its longer words.

    A beginning is followed by a ``*`` for each different word that has it, up to three:
    ``ab*`` holds for one word or more, ``ab**`` for two or more.
    """
    found = set(WORD.findall(text.lower())) if text else set()
    heads = Counter([w[:k] for w in found for k in PREFIXES if len(w) > k])
    return found | {head + "*" * i for head, n in heads.items() for i in range(1, min(n, REPEATS) + 1)}


def learnable(key: str = "doc_id") -> Column:
    """Rows whose labels may be learned from; the rest is held out."""
    return row_crc(key) % 3 != 1


def fit_sample(docs: DataFrame, labels: DataFrame, key: str, text: str, label: str, rows: int) -> DataFrame:
    """(doc_id, text, toxic) of at most about ``rows`` labelled documents. Several labels of an id are averaged."""
    known = (
        labels.where(F.col(label).isNotNull() & F.col(key).isNotNull() & learnable(key))
        .groupBy(F.col(key).cast("long").alias("_id"))
        .agg((F.avg(label) >= 0.5).cast("int").alias("toxic"))
        .orderBy(F.xxhash64("_id"), "_id")
        .limit(rows)
    )
    joined = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text")).join(
        F.broadcast(known), F.col("doc_id") == F.col("_id")  # at most ``rows`` rows
    )
    return joined.select("doc_id", "text", "toxic")


def _term_counts(texts: DataFrame, only: frozenset[str] | None) -> DataFrame:
    """(term, n): in how many of the texts each term occurs."""

    def count(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[str] = Counter()
        for batch in rows:
            for value in batch.column(0).to_pylist():
                found = terms(value)
                counts.update(found if only is None else found & only)
        if counts:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())],
                names=["term", "n"],
            )

    return texts.select("text").mapInArrow(count, "term string, n long").groupBy("term").agg(F.sum("n").alias("n"))


def mine_voters(sample: DataFrame, voters: int = VOTERS) -> list[str]:
    """The terms that tell toxic rows best, most telling first."""
    sizes = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if not sizes.get(0) or not sizes.get(1):
        return []
    positive = _term_counts(sample.where("toxic = 1"), None).where(F.col("n") >= LEAST_SUPPORT)
    pos = {r["term"]: r["n"] for r in positive.orderBy(F.desc("n"), "term").limit(CANDIDATES).collect()}
    if not pos:
        return []
    negative = _term_counts(sample.where("toxic = 0"), frozenset(pos))
    neg = {r["term"]: r["n"] for r in negative.collect()}
    usual = sizes[1] / (sizes[0] + sizes[1])
    scored = []
    for term, n in pos.items():
        other = neg.get(term, 0)
        ratio = ((n + 0.5) / (sizes[1] + 1)) / ((other + 0.5) / (sizes[0] + 1))
        share = n / (n + other)
        evidence = n * math.log(share / usual) + (other * math.log((1 - share) / (1 - usual)) if other else 0.0)
        if ratio >= LEAST_RATIO and evidence >= LEAST_EVIDENCE:
            scored.append((-n * math.log(ratio), term))
    return [term for _, term in sorted(scored)[:voters]]


def cast_votes(docs: DataFrame, voters: list[str], key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, text_hash, votes): which voters fire on each whole text, as sorted numbers."""
    number = {term: i for i, term in enumerate(voters)}
    words = {t: i for t, i in number.items() if not t.endswith("*")}
    heads: dict[str, list[tuple[int, int]]] = {}
    for t, i in number.items():
        if head := t.rstrip("*") if t.endswith("*") else "":
            heads.setdefault(head, []).append((len(t) - len(head), i))
    lengths = sorted({len(h) for h in heads})
    short = min(lengths, default=0)
    openings = frozenset(h[:short] for h in heads)

    def vote(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            votes = []
            for value in batch.column(2).to_pylist():
                fired, begun = set(), Counter()
                for w in set(WORD.findall(value.lower())) if value else ():
                    if w in words:
                        fired.add(words[w])
                    if w[:short] in openings:
                        begun.update([w[:k] for k in lengths if len(w) > k and w[:k] in heads])
                fired.update(i for head, n in begun.items() for least, i in heads[head] if n >= least)
                votes.append(sorted(fired))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(votes, pa.list_(pa.int32()))],
                names=["doc_id", "text_hash", "votes"],
            )

    return docs.select(
        F.col(key).cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"), text
    ).mapInArrow(vote, "doc_id long, text_hash long, votes array<int>")


def _logit(p: np.ndarray | float) -> np.ndarray | float:
    return np.log(p) - np.log1p(-p)


class LabelModel:
    """A generative model of votes: a voter that fires is right with its accuracy.

    A document's posterior log-odds are those of the prior plus, for each voter that
    fires, what its accuracy adds to the prior, divided by the voter's crowding: one plus
    its squared correlations, given the class, with the others. Documents on which nobody
    votes have a posterior of their own.
    """

    def __init__(self, voters: int):
        self.voters = voters
        self.prior, self.silent = 0.1, 0.01
        self.accuracy = np.full(voters, 0.9)
        self.crowding = np.ones(voters)

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        weight = (_logit(self.accuracy) - _logit(self.prior)) / self.crowding
        odds = _logit(self.prior) + votes @ weight
        p = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
        return np.where(votes.any(axis=1), p, self.silent)

    def sums(self, patterns: DataFrame, pairs: bool, labelled_only: bool) -> dict[tuple[int, int], tuple[float, float]]:
        """Over all patterns, by (voter, voter) or (voter, voter), (-1, -1) all and (-2, -2) silent: rows, toxic share.

        ``patterns`` is (votes, label, n); labelled rows count as their label says.
        """
        model = self

        def add(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            k = model.voters
            total = np.zeros((2, k, k)) if pairs else np.zeros((2, k))
            every, silent = np.zeros(2), np.zeros(2)
            for batch in rows:
                n = batch.column(2).to_numpy(zero_copy_only=False).astype(float)
                lists = batch.column(0)
                matrix = np.zeros((batch.num_rows, k), np.float32)
                lengths = np.diff(lists.offsets.to_numpy())
                matrix[np.repeat(np.arange(batch.num_rows), lengths), lists.flatten().to_numpy()] = 1
                label = batch.column(1).to_numpy(zero_copy_only=False).astype(float)
                p = np.where(np.isnan(label), model.posterior(matrix), label)
                for c, weight in enumerate((n, n * p)):
                    total[c] += (matrix * weight[:, None]).T @ matrix if pairs else weight @ matrix
                    every[c] += weight.sum()
                    silent[c] += weight[lengths == 0].sum()
            a, b = np.nonzero(np.triu(total[0])) if pairs else (np.flatnonzero(total[0]),) * 2
            picked = total[:, a, b] if pairs else total[:, a]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.r_[a, -1, -2].astype(np.int32)),
                    pa.array(np.r_[b, -1, -2].astype(np.int32)),
                    pa.array(np.r_[picked[0], every[0], silent[0]].astype(np.float64)),
                    pa.array(np.r_[picked[1], every[1], silent[1]].astype(np.float64)),
                ],
                names=["a", "b", "n", "toxic"],
            )

        rows = patterns.where("label is not null") if labelled_only else patterns
        summed = (
            rows.select("votes", F.col("label").cast("double"), "n")
            .mapInArrow(add, "a int, b int, n double, toxic double")
            .groupBy("a", "b")
            .agg(F.sum("n").alias("n"), F.sum("toxic").alias("toxic"))
        )
        return {(r["a"], r["b"]): (r["n"], r["toxic"]) for r in summed.collect()}  # at most voters squared

    def update(self, sums: dict[tuple[int, int], tuple[float, float]]) -> None:
        share = lambda at: (sums.get(at, (0, 0))[1] + 0.5) / (sums.get(at, (0, 0))[0] + 1)
        self.prior = share((-1, -1))
        n, toxic = sums.get((-2, -2), (0.0, 0.0))
        self.silent = min((toxic + 0.01) / (n + 1), 0.5)
        self.accuracy = np.clip([share((j, j)) for j in range(self.voters)], 0.02, 0.9999)

    def correlate(self, sums: dict[tuple[int, int], tuple[float, float]]) -> None:
        """Crowding from the correlations of voters within toxic and within other rows."""
        k = self.voters
        n_all, n_toxic = sums[-1, -1]
        together = np.zeros((2, k, k))
        for (a, b), (n, toxic) in sums.items():
            if a >= 0:
                together[0, a, b] = together[0, b, a] = n - toxic
                together[1, a, b] = together[1, b, a] = toxic
        squared = np.zeros((k, k))
        for rows, joint in zip((n_all - n_toxic, n_toxic), together / np.maximum([[[n_all - n_toxic]], [[n_toxic]]], 1)):
            rate = np.diag(joint)
            spread = np.sqrt(np.outer(rate * (1 - rate), rate * (1 - rate)))
            known = (spread > 0) & (rows * np.minimum.outer(rate, rate) >= LEAST_SUPPORT)
            rho = np.where(known, (joint - np.outer(rate, rate)) / np.where(known, spread, 1), 0)
            squared = np.maximum(squared, np.clip(rho, 0, 1) ** 2)
        np.fill_diagonal(squared, 0)
        self.crowding = 1 + squared.sum(axis=1)


def train_linear(patterns: DataFrame, model: LabelModel) -> tuple[np.ndarray, float]:
    """Weights and bias of a logistic regression of the posteriors on the votes, over all patterns."""

    def soft(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            lists = batch.column(0)
            lengths = np.diff(lists.offsets.to_numpy())
            matrix = np.zeros((batch.num_rows, model.voters), np.float32)
            matrix[np.repeat(np.arange(batch.num_rows), lengths), lists.flatten().to_numpy()] = 1
            label = batch.column(1).to_numpy(zero_copy_only=False).astype(float)
            p = np.where(np.isnan(label), model.posterior(matrix), label)
            yield pa.RecordBatch.from_arrays([lists, batch.column(2), pa.array(p)], names=["votes", "n", "p"])

    rows = patterns.select("votes", F.col("label").cast("double"), "n").mapInArrow(
        soft, "votes array<int>, n long, p double"
    )
    indicator = F.transform(
        F.sequence(F.lit(0), F.lit(model.voters - 1)), lambda i: F.array_contains("votes", i).cast("double")
    )
    both = rows.select(
        array_to_vector(indicator).alias("features"),
        F.explode(F.array(F.struct(F.lit(1.0).alias("y"), (F.col("n") * F.col("p")).alias("w")),
                          F.struct(F.lit(0.0).alias("y"), (F.col("n") * (1 - F.col("p"))).alias("w")))).alias("x"),
    ).select("features", "x.y", "x.w").where("w > 0")
    fitted = LogisticRegression(
        labelCol="y", weightCol="w", regParam=1e-7, maxIter=200, tol=1e-9, standardization=False
    ).fit(stored(both, "posterior-labels"))
    return fitted.coefficients.toArray(), float(fitted.intercept)


def score_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    fit_rows: int = FIT_ROWS,
    voters: int = VOTERS,
) -> DataFrame:
    """(doc_id, text_hash, votes, score), one row per document row; score is from 0 to 1.

    Labels of rows with crc32(id) mod 3 = 1 are never read. Voters come from at most
    ``fit_rows`` labelled rows; the label model and the classifier from all documents.
    Null and empty texts have no words and get the score of a text on which no voter
    fires. Null labels and labels of null ids are ignored; null document ids are scored.
    Equal texts have equal scores. Without labels of both kinds every score is the share
    of toxic labels, 0 without any. An empty table gives no rows. Other columns are
    ignored.
    """
    sample = stored(fit_sample(docs, labels, key, text, label, fit_rows), "toxicity-sample")
    chosen = mine_voters(sample, voters)
    if not chosen:
        share = sample.agg(F.coalesce(F.avg("toxic"), F.lit(0.0))).first()[0]
        return docs.select(
            F.col(key).cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"),
            F.array().cast("array<int>").alias("votes"), F.lit(float(share)).alias("score"),
        )
    votes = stored(cast_votes(docs, chosen, key, text), "votes")
    known = F.broadcast(sample.groupBy(F.col("doc_id").alias("_id")).agg(F.max("toxic").alias("label")))
    patterns = stored(
        votes.join(known, F.col("doc_id") == F.col("_id"), "left").groupBy("votes", "label").agg(F.count("*").alias("n")),
        "vote-patterns",
    )
    model = LabelModel(len(chosen))
    model.update(model.sums(patterns, pairs=False, labelled_only=True))
    for _ in range(EM_ROUNDS):
        model.update(model.sums(patterns, pairs=False, labelled_only=False))
    model.correlate(model.sums(patterns, pairs=True, labelled_only=False))
    weights, bias = train_linear(patterns, model)
    weight = F.array(*[F.lit(float(w)) for w in weights])
    odds = F.aggregate("votes", F.lit(float(bias)), lambda total, j: total + F.get(weight, j))
    return votes.withColumn("score", 1 / (1 + F.exp(-odds)))


def without_toxic(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", **settings) -> DataFrame:
    """``docs`` without the rows that score at least the threshold."""
    doc, hashed = unused(docs, "_doc", "_hash")
    rejected = (
        score_toxicity(docs, labels, key, text, **settings)
        .where(F.col("score") >= THRESHOLD)
        .select(F.col("doc_id").alias(doc), F.col("text_hash").alias(hashed))
        .distinct()
    )
    return docs.join(
        rejected, F.col(key).cast("long").eqNullSafe(F.col(doc)) & (F.xxhash64(text) == F.col(hashed)), "left_anti"
    )
