"""One query per operator over the given tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from functools import reduce

import numpy as np
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textjury.functions.hashing import md5_bucket
from textjury.operators import evaluation, folds, selection, sketches, term_weights, tokenizing, unknown_words, voting
from textjury.operators.segmenting import segment
from textjury.operators.word_discovery import discover_words as word_discovery_of
from textjury.plans import boosting, fold_counts, nested, scoring
from textjury.plans.comparison import comparison_board
from textjury.plans.split import build_split, dictionary_tokenizer
from textjury.plans.storage import stored
from textjury.plans.training import retrain, train_on_split
from textjury.plans.workbench import FOLDS, Workbench, workbench
from textjury.sources.lines import checked_lines, parse_labelled, read_labelled, read_messages
from textjury.sources.requests import METHODS, split_valid, validate
from textjury.sources.tables import append_messages, first_messages, unlabelled_messages
from textjury.sources.tables import labelled_messages as from_labels
from textjury.streaming import rates
from textjury.streaming.ingest import ingest_labelled, ingested
from textjury.streaming.scoring import answer_requests, score_stream

Query = Callable[[Workbench], DataFrame]
QUERIES: dict[str, Query] = {}

BUCKETS = 1000
COLLISION_SIZES = [1_000, 10_000, 100_000]
MEMBER_WEIGHTS = [0.9, 0.5, 0.4, 0.3, 0.2]
SELECTED_BUCKETS = 100
DECIMALS = 6
FREQUENT = 50
SIMILAR_ROWS = 2
DISCOVERY = {"max_length": 4, "min_count": 20, "min_cohesion": 2.0, "min_entropy": 1.0}


def query(run: Query) -> Query:
    QUERIES[run.__name__] = run
    return run


def bound() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """The queries in the form (spark, sf_dir) -> DataFrame."""
    return {
        name: lambda spark, sf_dir, run=run: run(workbench(spark, sf_dir))
        for name, run in QUERIES.items()
    }


def _words(bench: Workbench, labelled: bool = False) -> DataFrame:
    rows = bench.labelled() if labelled else bench.documents()
    return tokenizing.tokenize(rows, "word", lowercase=True)


# Sources


@query
def labelled_messages(b: Workbench) -> DataFrame:
    return b.labelled()


@query
def unlabelled_texts(b: Workbench) -> DataFrame:
    return unlabelled_messages(b.table("documents"), b.table("labels"))


@query
def labelled_and_unlabelled_cover_all(b: Workbench) -> DataFrame:
    """Also where some labels are null, each document is in one of the two sets."""
    documents = b.table("documents")
    known = F.when(F.col("doc_id") % 10 != 0, F.col("toxic"))
    labels = b.table("labels").withColumn("toxic", known)
    sets = from_labels(documents, labels).select("doc_id", F.lit(1).alias("labelled"), F.lit(0).alias("unlabelled"))
    sets = sets.unionByName(
        unlabelled_messages(documents, labels).select(
            "doc_id", F.lit(0).alias("labelled"), F.lit(1).alias("unlabelled")
        )
    )
    found = sets.groupBy("doc_id").agg(F.sum("labelled").alias("labelled"), F.sum("unlabelled").alias("unlabelled"))
    both = documents.select("doc_id").join(found, "doc_id", "left")
    return both.agg(
        F.count("labelled").alias("n_found"),
        F.sum("labelled").alias("n_labelled"),
        F.count(F.when((F.col("labelled") > 0) & (F.col("unlabelled") > 0), 1)).alias("n_both"),
        F.count(F.when(F.col("labelled").isNull(), 1)).alias("n_neither"),
    )


@query
def parse_labelled_lines(b: Workbench) -> DataFrame:
    """Lines whose text holds a second tab, which must stay in the text."""
    rows = b.table("documents").join(b.table("labels"), "doc_id")
    line = F.concat_ws("\t", F.col("toxic").cast("string"), "source", "text")
    return parse_labelled(rows.select("doc_id", line.alias("value")))


@query
def parse_quarantine(b: Workbench) -> DataFrame:
    """Labelled lines pass; without a label the line has a wrong one or no tab at all."""
    rows = b.table("documents").join(b.table("labels").select("doc_id", "toxic"), "doc_id", "left")
    line = (
        F.when(F.col("toxic").isNotNull(), F.concat_ws("\t", F.col("toxic").cast("string"), "text"))
        .when(F.col("lang") == "en", F.concat_ws("\t", "lang", "text"))
        .otherwise(F.col("text"))
    )
    checked = checked_lines(rows.select("doc_id", line.alias("value")))
    shown = F.when(F.col("problem").isNull(), F.col("text")).otherwise(F.col("value"))
    return checked.select(
        "doc_id",
        F.coalesce("problem", F.lit("parsed")).alias("status"),
        F.length(shown).cast("bigint").alias("n_chars"),
    )


def _one_line(text: str = "text"):
    return F.regexp_replace(text, r"[\r\n]+", " ")


@query
def labelled_file_scan(b: Workbench) -> DataFrame:
    """Write labelled lines to text files, scan and parse them."""
    path = b.new_folder("labelled-lines")
    line = F.concat_ws("\t", F.col("label").cast("int").cast("string"), _one_line())
    b.labelled().select(line.alias("value")).write.text(path)
    return read_labelled(b.spark, path)


@query
def message_file_scan(b: Workbench) -> DataFrame:
    path = b.new_folder("messages")
    unlabelled = unlabelled_messages(b.table("documents"), b.table("labels"))
    unlabelled.select(_one_line().alias("value")).write.text(path)
    return read_messages(b.spark, path).groupBy("text").agg(F.count(F.lit(1)).alias("n"))


@query
def first_n_messages(b: Workbench) -> DataFrame:
    return first_messages(b.table("documents"), 100)


def _requests(conversations: DataFrame) -> DataFrame:
    offered = F.array(*[F.lit(m) for m in [*METHODS, "KNN"]])
    nth = F.pmod(F.col("conv_id") + F.col("turn"), F.lit(len(METHODS) + 1)).cast("int")
    return conversations.select(
        "conv_id", "turn", F.col("text").alias("message"), F.get(offered, nth).alias("method")
    )


@query
def request_validation(b: Workbench) -> DataFrame:
    checked = validate(_requests(b.table("conversations")))
    return checked.withColumn("ok", F.col("ok").cast("int"))


@query
def verdict_text(b: Workbench) -> DataFrame:
    accepted, _ = split_valid(_requests(b.table("conversations")))
    vote = md5_bucket(F.col("message"), 2)
    return accepted.select("conv_id", "turn", vote.alias("vote")).withColumn(
        "verdict", voting.verdict(F.col("vote"))
    )


# Text


@query
def clean_text(b: Workbench) -> DataFrame:
    return tokenizing.clean_text(b.documents()).select("doc_id", "text_clean")


@query
def tokenize_words(b: Workbench) -> DataFrame:
    return tokenizing.token_rows(_words(b))


@query
def tokenize_keep_all(b: Workbench) -> DataFrame:
    rows = tokenizing.tokenize(b.documents())
    return rows.select(
        "doc_id",
        F.size("words").cast("bigint").alias("n_tokens"),
        F.md5(F.array_join("words", "|")).alias("tokens_md5"),
    )


@query
def tokenize_char_bigrams(b: Workbench) -> DataFrame:
    return tokenizing.token_counts(
        tokenizing.tokenize(b.documents(), "char_ngram", n=2), token="gram"
    )


@query
def tokenize_dictionary(b: Workbench) -> DataFrame:
    """Letter runs of all documents cut with the words that occur in ``benchmark``."""
    known = tokenizing.vocabulary(tokenizing.tokenize(b.table("benchmark"), "word", lowercase=True))
    rows = b.documents().withColumn("text", F.lower("text"))
    return tokenizing.token_counts(segment(rows, known, script=r"\p{L}"))


@query
def tokenize_dictionary_joined(b: Workbench) -> DataFrame:
    """The same cut as a list too long to send would get, with every row there twice."""
    known = tokenizing.vocabulary(tokenizing.tokenize(b.table("benchmark"), "word", lowercase=True))
    rows = b.documents().withColumn("text", F.lower("text"))
    cut = segment(rows.unionByName(rows), known, script=r"\p{L}", broadcast_words=0)
    return tokenizing.token_counts(cut).distinct()


@query
def dictionary_split_roundtrip(b: Workbench) -> DataFrame:
    """A split whose tokenizer is a stored word list."""
    known = tokenizing.vocabulary(tokenizing.tokenize(b.table("benchmark"), "word", lowercase=True))
    tokenizer = dictionary_tokenizer(known, b.new_folder("words"), lowercase=True, script=r"\p{L}")
    split = build_split(b.labelled(), b.root, FOLDS, tokenizer=tokenizer)
    return split.rows(b.spark).groupBy("fold").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.size("words")).cast("bigint").alias("n_tokens")
    )


def _benchmark_words(b: Workbench) -> DataFrame:
    return tokenizing.tokenize(b.table("benchmark"), "word", lowercase=True)


@query
def place_counts(b: Workbench) -> DataFrame:
    """Places of characters in the words of all documents, as if these were written without blanks."""
    return unknown_words.place_counts(_words(b), script=r"\p{L}")


@query
def segment_unknown_words(b: Workbench) -> DataFrame:
    """Letter runs cut with the words of ``benchmark``, and what these leave over at its likeliest places."""
    segmented = _benchmark_words(b)
    places = unknown_words.place_model(unknown_words.place_counts(segmented, script=r"\p{L}"))
    rows = b.documents().withColumn("text", F.lower("text"))
    cut = segment(rows, tokenizing.vocabulary(segmented), script=r"\p{L}", places=places)
    return cut.select(
        "doc_id", F.size("words").cast("bigint").alias("n_tokens"), F.md5(F.array_join("words", "|")).alias("tokens_md5")
    )


def _without_blanks(b: Workbench) -> DataFrame:
    return b.documents().withColumn("text", F.regexp_replace(F.lower("text"), "[ \n]+", ""))


@query
def word_discovery(b: Workbench) -> DataFrame:
    """Words of all documents, found after their blanks are taken out."""
    found = word_discovery_of(_without_blanks(b), script=r"\p{L}", **DISCOVERY)
    measures = ("cohesion", "left_entropy", "right_entropy")
    return found.withColumns({name: F.round(name, 4) for name in measures})


@query
def segment_with_discovered_words(b: Workbench) -> DataFrame:
    """Every document cut with the list found in the documents themselves: nothing is lost on the way."""
    rows = _without_blanks(b)
    found = word_discovery_of(rows, script=r"\p{L}", **DISCOVERY)
    cut = segment(rows, found.select("token", "term_count"), script=r"\p{L}", method="frequency")
    return cut.select("doc_id", F.md5(F.array_join("words", "")).alias("text_md5"))


@query
def vocabulary(b: Workbench) -> DataFrame:
    return tokenizing.vocabulary(_words(b))


@query
def hash_collisions(b: Workbench) -> DataFrame:
    return term_weights.hash_collisions(_words(b), COLLISION_SIZES)


# Folds


@query
def frequent_words(b: Workbench) -> DataFrame:
    """Words with at least 50 occurrences; rarer ones are kept out of the shuffle by a sketch of all."""
    return sketches.frequent_words(_words(b), FREQUENT)


@query
def sketch_error(b: Workbench) -> DataFrame:
    """Sketched against exact counts: none may be below, and one word in a hundred above the bound."""
    words = _words(b)
    found = sketches.sketch_error(tokenizing.vocabulary(words), sketches.count_sketch(words))
    within = F.col("n_above") <= (1 - sketches.CONFIDENCE) * F.col("n_words")
    return found.select("n_words", "n_terms", "n_below", within.cast("int").alias("within_bound"))


@query
def similar_word_buckets(b: Workbench) -> DataFrame:
    """Buckets by the least hashes of a word's character bigrams."""
    return tokenizing.similar_words(_words(b), COLLISION_SIZES[-1], SIMILAR_ROWS)


@query
def fold_assignment(b: Workbench) -> DataFrame:
    return folds.assign_folds(b.table("documents"), FOLDS).select("doc_id", "fold")


@query
def fold_by_text(b: Workbench) -> DataFrame:
    """Equal texts share a fold."""
    rows = folds.assign_folds(b.table("documents"), FOLDS, salt="text:", key=F.md5("text"))
    return rows.select("doc_id", "fold")


@query
def fold_balance(b: Workbench) -> DataFrame:
    return folds.fold_balance(folds.assign_folds(b.labelled(), FOLDS))


@query
def leave_one_out_train_counts(b: Workbench) -> DataFrame:
    return folds.leave_one_out_counts(folds.assign_folds(b.labelled(), FOLDS), FOLDS)


@query
def leave_one_out_train_rows(b: Workbench) -> DataFrame:
    """The rows of all k training sets."""
    rows = folds.assign_folds(b.labelled().select("doc_id", "label"), FOLDS)
    return folds.all_training_rows(rows, FOLDS).select("held_out", "doc_id", "label")


@query
def split_roundtrip(b: Workbench) -> DataFrame:
    return b.split().rows(b.spark).groupBy("fold").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.size("words")).cast("bigint").alias("n_tokens")
    )


# Term weights


@query
def hashed_tf(b: Workbench) -> DataFrame:
    return term_weights.hashed_tf(_words(b), BUCKETS)


@query
def document_frequency(b: Workbench) -> DataFrame:
    return term_weights.document_frequency(_words(b), BUCKETS)


@query
def idf_all(b: Workbench) -> DataFrame:
    return term_weights.idf(_words(b), BUCKETS).withColumn("idf", F.round("idf", DECIMALS))


@query
def idf_leave_one_out(b: Workbench) -> DataFrame:
    rows = folds.assign_folds(_words(b, labelled=True), FOLDS)
    weights = term_weights.idf_leave_one_out(rows, BUCKETS, FOLDS)
    return weights.withColumn("idf", F.round("idf", DECIMALS))


@query
def chi_square_by_fold(b: Workbench) -> DataFrame:
    rows = folds.assign_folds(_words(b, labelled=True), FOLDS)
    return selection.chi_square_by_fold(rows, BUCKETS, FOLDS).withColumn("chi_square", F.round("chi_square", 4))


@query
def incremental_idf(b: Workbench) -> DataFrame:
    """English messages are counted first, the others added later: the same idf as from the whole table."""
    counts = fold_counts.FoldCounts(b.spark, b.new_folder("fold-counts"), BUCKETS, FOLDS)
    rows = _words(b, labelled=True).join(b.table("documents").select("doc_id", "lang"), "doc_id")
    counts.add(rows.where("lang = 'en'"), "first")
    counts.add(rows.where("lang <> 'en'"), "second")
    return counts.idf_leave_one_out().withColumn("idf", F.round("idf", DECIMALS))


@query
def tfidf(b: Workbench) -> DataFrame:
    return term_weights.tfidf(_words(b), BUCKETS).withColumn("tfidf", F.round("tfidf", DECIMALS))


@query
def term_vector_totals(b: Workbench) -> DataFrame:
    """Hashed ML vectors of the labelled messages: their counts add up to the tokens."""
    vectors = b.split().vectors(b.spark, BUCKETS)
    total = F.aggregate(F.unwrap_udt("tf")["values"], F.lit(0.0), lambda a, v: a + v)
    return vectors.select("doc_id", "fold", total.cast("bigint").alias("n_tokens"))


# Votes and metrics


@query
def majority_vote(b: Workbench) -> DataFrame:
    return _md5_votes(b, 5)


@query
def majority_vote_even_k(b: Workbench) -> DataFrame:
    return _md5_votes(b, 4)


def _md5_members(b: Workbench, k: int) -> tuple[DataFrame, list[str]]:
    names = [f"p{i}" for i in range(k)]
    said = {
        name: md5_bucket(F.concat_ws("-", F.lit(str(i)), F.col("doc_id").cast("string")), 2)
        for i, name in enumerate(names)
    }
    return b.table("documents").select("doc_id").withColumns(said), names


def _md5_votes(b: Workbench, k: int) -> DataFrame:
    rows, names = _md5_members(b, k)
    return voting.majority_vote(rows, names).select("doc_id", "votes", "vote")


@query
def weighted_vote(b: Workbench) -> DataFrame:
    rows, names = _md5_members(b, len(MEMBER_WEIGHTS))
    return voting.weighted_vote(rows, names, MEMBER_WEIGHTS).select("doc_id", "vote")


@query
def weighted_vote_from_counts(b: Workbench) -> DataFrame:
    """Members weighted by F1 from their counts; the last one is always wrong and has no weight."""
    members = _md5_members(b, 5)[0].join(b.table("labels").where("toxic is not null"), "doc_id")
    rows = members.withColumn("p5", 1 - F.col("toxic"))
    names = [f"p{i}" for i in range(6)]
    said = F.array(*[F.struct(F.lit(i).alias("fold"), F.col(n).alias("prediction")) for i, n in enumerate(names)])
    judged = rows.select(F.col("toxic").alias("label"), F.inline(said))
    counted = evaluation.confusion_counts(judged, len(names)).select("fold", voting.f1_weight().alias("weight"))
    weights = {r["fold"]: r["weight"] for r in counted.collect()}
    return voting.weighted_vote(rows, names, [weights[i] for i in range(len(names))]).select("doc_id", "vote")


def _judged(b: Workbench) -> DataFrame:
    """Four made-up judges of all labels; together they meet every 0/0 case."""
    toxic, quality = F.col("toxic").cast("double"), F.col("quality").cast("double")
    judges = {
        "low_quality": 1 - quality,
        "never": F.lit(0.0),
        "always": F.lit(1.0),
        "opposite": 1 - toxic,
    }
    said = F.array(
        *[F.struct(F.lit(n).alias("algorithm"), p.alias("prediction")) for n, p in judges.items()]
    )
    rows = folds.assign_folds(b.table("labels"), FOLDS)
    return rows.select("fold", toxic.alias("label"), F.inline(said))


@query
def confusion_counts(b: Workbench) -> DataFrame:
    return evaluation.confusion_counts(_judged(b), FOLDS, by=("algorithm",))


@query
def precision_recall_f1(b: Workbench) -> DataFrame:
    return _rounded(evaluation.evaluate(_judged(b), FOLDS, by=("algorithm",)))


@query
def macro_metrics(b: Workbench) -> DataFrame:
    metrics = evaluation.evaluate(_judged(b), FOLDS, by=("algorithm",))
    return _rounded(evaluation.macro_average(metrics, by=("algorithm",)))


def _rounded(metrics: DataFrame) -> DataFrame:
    return metrics.withColumns(
        {name: F.round(name, DECIMALS) for name in ("precision", "recall", "f1")}
    )


# Training, evaluation, scoring


def _cross_validated(algorithm: str) -> Query:
    def run(b: Workbench) -> DataFrame:
        return b.metrics(algorithm).select(
            "algorithm", "fold", "tp", "fp", "fn", "precision", "recall", "f1"
        )

    run.__name__ = f"cv_{algorithm.lower()}"
    return query(run)


for _algorithm in ("LR", "MP", "SVM", "DT", "GBDT"):
    _cross_validated(_algorithm)


MARKER = " zqmarker" * 100
MARKER_FEATURES = 2_000


def _marker_cv(algorithm: str) -> Query:
    """A marker word tells the classes apart, so what a tree must predict follows from the labels."""

    def run(b: Workbench) -> DataFrame:
        marked = F.concat("text", F.when(F.col("label") == 1, F.lit(MARKER)).otherwise(""))
        store = type(b.store)(b.spark, b.new_folder(f"marker-{algorithm}"))
        split = build_split(
            b.labelled().withColumn("text", marked), store.root, FOLDS, tokenizer={"mode": "word"}
        )
        ensemble = train_on_split(split, store, algorithm, num_features=MARKER_FEATURES)
        judged = scoring.out_of_fold(split, ensemble, store)
        return evaluation.evaluate(judged, FOLDS).select("fold", "tp", "fp", "fn")

    run.__name__ = f"marker_cv_{algorithm.lower()}"
    return query(run)


_marker_cv("DT")
_marker_cv("GBDT")


@query
def marker_cv_dt_selected(b: Workbench) -> DataFrame:
    """Trees at 10,000 buckets under a memory bound that refuses them, each on its own 100 best buckets."""
    marked = F.concat("text", F.when(F.col("label") == 1, F.lit(MARKER)).otherwise(""))
    store = type(b.store)(b.spark, b.new_folder("marker-selected"))
    split = build_split(b.labelled().withColumn("text", marked), store.root, FOLDS, tokenizer={"mode": "word"})
    bound = 1_000 * sum(c["n"] for c in split.class_counts(b.spark))
    try:
        train_on_split(split, store, "DT", max_dense_bytes=bound)
        raise AssertionError("dense rows above the bound were not refused")
    except ValueError:
        ensemble = train_on_split(split, store, "DT", max_dense_bytes=bound, select=SELECTED_BUCKETS)
    return evaluation.evaluate(scoring.out_of_fold(split, ensemble, store), FOLDS).select("fold", "tp", "fp", "fn")


@query
def similar_marker_cv(b: Workbench) -> DataFrame:
    """Trees on buckets of similar words still find the marker."""
    marked = F.concat("text", F.when(F.col("label") == 1, F.lit(MARKER)).otherwise(""))
    store = type(b.store)(b.spark, b.new_folder("marker-similar"))
    tokenizer = {"mode": "word", "similar": SIMILAR_ROWS}
    split = build_split(b.labelled().withColumn("text", marked), store.root, FOLDS, tokenizer=tokenizer)
    ensemble = train_on_split(split, store, "DT", num_features=MARKER_FEATURES)
    return evaluation.evaluate(scoring.out_of_fold(split, ensemble, store), FOLDS).select("fold", "tp", "fp", "fn")


@query
def hashing_comparison(b: Workbench) -> DataFrame:
    """Logistic regression on spread and on similar buckets, as few of them: counts over all folds.

    Not the mean F1 of the folds, as a fold with wrong findings only has F1 1 there.
    """
    store = type(b.store)(b.spark, b.new_folder("hashings"))
    boards = []
    for name, similar in (("spread", None), ("similar", SIMILAR_ROWS)):
        tokenizer = {"mode": "word", "lowercase": True, "similar": similar}
        split = build_split(b.labelled(), store.root, FOLDS, tokenizer=tokenizer)
        ensemble = train_on_split(split, store, "LR", num_features=BUCKETS, replace=True)
        judged = evaluation.evaluate(scoring.out_of_fold(split, ensemble, store), FOLDS)
        boards.append(judged.agg(F.lit(name).alias("hashing"), *[F.sum(c).alias(c) for c in ("tp", "fp", "fn")]))
    share = 2 * F.col("tp") / F.nullif(2 * F.col("tp") + F.col("fp") + F.col("fn"), F.lit(0))
    return reduce(DataFrame.unionByName, boards).withColumn("f1", share)


@query
def nested_vote_metrics(b: Workbench) -> DataFrame:
    """The vote on rows that no voting member saw, on the marker data."""
    marked = F.concat("text", F.when(F.col("label") == 1, F.lit(MARKER)).otherwise(""))
    store = type(b.store)(b.spark, b.new_folder("marker-nested"))
    split = build_split(b.labelled().withColumn("text", marked), store.root, FOLDS, tokenizer={"mode": "word"})
    judged = nested.nested_vote(split, store, "DT", num_features=MARKER_FEATURES)
    return evaluation.evaluate(judged, FOLDS).select("fold", "tp", "fp", "fn")


@query
def boosted_marker_cv(b: Workbench) -> DataFrame:
    marked = F.concat("text", F.when(F.col("label") == 1, F.lit(MARKER)).otherwise(""))
    store = type(b.store)(b.spark, b.new_folder("marker-boosted"))
    split = build_split(b.labelled().withColumn("text", marked), store.root, FOLDS, tokenizer={"mode": "word"})
    boosted = boosting.train_boosted(split, store, "DT", rounds=3, num_features=MARKER_FEATURES, settings={"maxDepth": 1})
    judged = boosting.boosted_out_of_fold(split, boosted, store)
    return evaluation.evaluate(judged, FOLDS).select("fold", "tp", "fp", "fn")


@query
def boosted_alphas(b: Workbench) -> DataFrame:
    """Errors, alphas and row weights recomputed from the judged rows of all rounds; mismatches must be 0."""
    store = type(b.store)(b.spark, b.new_folder("boosted"))
    boosted = boosting.train_boosted(b.split(), store, "DT", rounds=3, num_features=BUCKETS, settings={"maxDepth": 2})
    rows, weight, problems = None, F.lit(1.0), F.lit(0)
    for t in range(len(boosted.rounds)):
        judged = boosting.round_rows(b.spark, boosted.version.path, t).select(
            "doc_id", "label", F.col("prediction").alias(f"p{t}"), F.col("weight").alias(f"w{t}")
        )
        rows = judged if rows is None else rows.join(judged.drop("label"), "doc_id")
    sums, weights = [], []
    for t, alpha in enumerate(boosted.alphas):
        wrong = F.col(f"p{t}") != F.col("label")
        weights.append(weight)
        sums += [F.sum(F.when(wrong, weight).otherwise(0.0)).alias(f"wrong{t}"), F.sum(weight).alias(f"all{t}"), F.sum(f"w{t}").alias(f"stored{t}")]
        weight = weight * F.exp(F.when(wrong, alpha).otherwise(-alpha))
    totals = rows.agg(*sums).first()
    for t, (alpha, error) in enumerate(zip(boosted.alphas, boosted.errors)):
        again = totals[f"wrong{t}"] / totals[f"all{t}"]
        same_round = abs(again - error) < 1e-9 and abs(boosting.alpha_of(again) - alpha) < 1e-6
        scaled = weights[t] * totals[f"stored{t}"] / totals[f"all{t}"]
        same_row = F.abs(F.col(f"w{t}") - scaled) <= 1e-9 * F.col(f"w{t}")
        problems = problems + (~same_row | F.lit(not same_round)).cast("int")
    return rows.agg(F.count(F.lit(1)).alias("n_rows"), F.count(F.when(problems > 0, 1)).alias("n_mismatch"))


def _linear(model) -> tuple[np.ndarray, np.ndarray, list]:
    return model.coefficients.toArray()[None, :], np.array([model.intercept]), []


def _perceptron(model) -> tuple[np.ndarray, np.ndarray, list]:
    """First layer's weights (unit, input) and biases, and those of the layers above it."""
    flat, sizes, layers = model.weights.toArray(), model.getLayers(), []
    for n_in, n_out in zip(sizes, sizes[1:]):
        matrix, rest = flat[: n_in * n_out].reshape(n_in, n_out).T, flat[n_in * n_out :]
        layers.append((matrix, rest[:n_out]))
        flat = rest[n_out:]
    return *layers[0], layers[1:]


def _margin(sums: list[Column], bias: np.ndarray, layers: list) -> Column:
    values = [s + float(c) for s, c in zip(sums, bias)]
    for matrix, constants in layers:
        hidden = [1 / (1 + F.exp(-v)) for v in values]
        values = [
            sum((h * float(w) for h, w in zip(hidden, row)), F.lit(float(c))) for row, c in zip(matrix, constants)
        ]
    return values[-1]


def _margins(algorithm: str, parts: Callable) -> Query:
    """Margins and predictions recomputed in long form from weights, idf and term counts."""

    def run(b: Workbench) -> DataFrame:
        ensemble, split = b.ensemble(algorithm), b.split()
        vectors = split.vectors(b.spark, ensemble.version.num_features)
        weights, margin, shown = [], F.lit(None).cast("double"), None
        for fold, member in enumerate(ensemble.members):
            _, idf, model = member.stages
            first, bias, layers = parts(model)
            by_bucket = first * idf.getScalingVec().toArray()
            weights += [(fold, bucket, w) for bucket, w in enumerate(by_bucket.T.tolist())]
            sums = [F.coalesce(F.get("sums", i), F.lit(0.0)) for i in range(len(bias))]
            margin = F.when(F.col("fold") == fold, _margin(sums, bias, layers)).otherwise(margin)
            held = folds.held_out_rows(vectors, fold)
            judged = model.transform(idf.copy({idf.inputCol: "tf"}).transform(held)).select(
                "doc_id",
                vector_to_array("rawPrediction")[0].alias("other"),
                vector_to_array("rawPrediction")[1].alias("raw"),
                "prediction",
            )
            shown = judged if shown is None else shown.unionByName(judged)
        units = len(weights[0][2])
        table = b.spark.createDataFrame(weights, "fold INT, bucket INT, weight ARRAY<DOUBLE>")  # k times the buckets
        tf = F.unwrap_udt("tf")
        long = vectors.select(
            "doc_id", "fold", F.inline(F.arrays_zip(tf["indices"].alias("bucket"), tf["values"].alias("n")))
        )
        sums = long.join(F.broadcast(table), ["fold", "bucket"]).groupBy("doc_id").agg(
            F.array(*[F.sum(F.col("n") * F.get("weight", i)) for i in range(units)]).alias("sums")
        )
        both = vectors.select("doc_id", "fold").join(sums, "doc_id", "left").join(shown, "doc_id", "full")
        same = (F.abs(margin - F.col("raw")) <= 1e-6 * (1 + F.abs("raw"))) & (
            F.col("prediction") == (F.col("raw") > F.col("other")).cast("double")
        )
        return both.agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.count(F.when(~F.coalesce(same, F.lit(False)), 1)).alias("n_mismatch"),
        )

    run.__name__ = f"{algorithm.lower()}_margins"
    return query(run)


_margins("LR", _linear)
_margins("SVM", _linear)
_margins("MP", _perceptron)


@query
def vote_consistency(b: Workbench) -> DataFrame:
    """Votes add up, and the three ways of scoring agree, for every algorithm and document."""
    documents = b.documents()
    ensembles = {a: b.ensemble(a) for a in METHODS}
    wide = scoring.score_side_by_side(documents, list(ensembles.values())).drop("text")
    named = F.get(F.array(*[F.lit(a) for a in METHODS]), F.pmod("doc_id", F.lit(len(METHODS))).cast("int"))
    asked = documents.select("doc_id", F.col("text").alias("message"), named.alias("method"))
    routed = scoring.score_by_method(asked, list(ensembles.values())).select(
        "doc_id", "method", F.col("vote").alias("routed")
    )
    every = stored(wide.join(routed, "doc_id"), "votes")  # read by each algorithm
    results = []
    for algorithm, ensemble in ensembles.items():
        members = [F.col(f"p{i}") for i in range(len(ensemble.members))]
        added = sum(members[1:], members[0])
        good = (F.col("votes") == added) & (F.col("vote") == (added > len(members) / 2).cast("int"))
        good &= F.col("vote") == F.col(f"vote_{algorithm}")
        good &= (F.col("method") != algorithm) | (F.col("routed") == F.col("vote"))
        both = scoring.score(documents, ensemble).drop("text").join(every, "doc_id", "full")
        results.append(
            both.agg(
                F.lit(algorithm).alias("algorithm"),
                F.count(F.lit(1)).alias("n_rows"),
                F.count(F.when(~F.coalesce(good, F.lit(False)), 1)).alias("n_mismatch"),
            )
        )
    return reduce(DataFrame.unionByName, results)


@query
def out_of_fold_rows(b: Workbench) -> DataFrame:
    """Every labelled row is judged once per algorithm, by the member that never saw it."""
    parts = [
        scoring.out_of_fold(b.split(), b.ensemble(a), b.store).withColumn("algorithm", F.lit(a))
        for a in METHODS
    ]
    judged = parts[0]
    for part in parts[1:]:
        judged = judged.unionByName(part)
    return judged.where("prediction in (0.0, 1.0)").select("algorithm", "doc_id", "fold", "label")


@query
def run_records(b: Workbench) -> DataFrame:
    """Recorded positives per algorithm and fold: tp + fn."""
    for algorithm in METHODS:
        b.metrics(algorithm)
    return b.store.experiments().select(
        "algorithm", "fold", (F.col("tp") + F.col("fn")).alias("n_positive")
    )


@query
def ensemble_score(b: Workbench) -> DataFrame:
    return scoring.score(b.documents(), b.ensemble("LR")).select("doc_id", "votes", "vote")


@query
def score_unlabelled(b: Workbench) -> DataFrame:
    rows = unlabelled_messages(b.documents(), b.table("labels"))
    return scoring.score(rows, b.ensemble("SVM")).select("doc_id", "votes", "vote")


@query
def score_side_by_side(b: Workbench) -> DataFrame:
    ensembles = [b.ensemble(a) for a in ("LR", "MP", "SVM")]
    return scoring.score_side_by_side(b.documents(), ensembles).drop("text")


@query
def score_by_method(b: Workbench) -> DataFrame:
    accepted, _ = split_valid(_requests(b.table("conversations")))
    scored = scoring.score_by_method(accepted, [b.ensemble(a) for a in METHODS])
    return scored.select("conv_id", "turn", "method", "vote").withColumn(
        "verdict", voting.verdict(F.col("vote"))
    )


@query
def weighted_score(b: Workbench) -> DataFrame:
    scored = scoring.score_weighted(b.documents(), b.ensemble("MP"), b.metrics("MP"))
    return scored.select("doc_id", "vote")


@query
def cascade_score(b: Workbench) -> DataFrame:
    scored = scoring.cascade(b.documents(), b.ensemble("DT"), b.ensemble("SVM"))
    return scored.select("doc_id", "unsure", "vote")


@query
def algorithm_comparison(b: Workbench) -> DataFrame:
    for algorithm in METHODS:
        b.metrics(algorithm)
    return comparison_board(
        b.store, b.split(), [b.ensemble(a) for a in METHODS], b.documents()
    )


@query
def scoring_throughput(b: Workbench) -> DataFrame:
    run = scoring.measure(scoring.score(b.documents(), b.ensemble("LR")).select("doc_id", "vote"))
    return b.spark.createDataFrame(
        [(run["rows"], run["seconds"], run["seconds_per_message"])],
        "rows BIGINT, seconds DOUBLE, seconds_per_message DOUBLE",
    )


def _mismatches(left: DataFrame, right: DataFrame) -> DataFrame:
    both = left.join(right.withColumnRenamed("vote", "other"), "doc_id", "full")
    return both.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count(F.when(~F.col("vote").eqNullSafe(F.col("other")), 1)).alias("n_mismatch"),
    )


@query
def model_roundtrip(b: Workbench) -> DataFrame:
    """Members saved again and loaded give the same votes on all documents."""
    held = b.ensemble("GBDT")
    copy = replace(held.version, path=b.new_folder("copy"))
    for fold, member in enumerate(held.members):
        member.write().save(copy.member_path(fold))
    return _mismatches(
        scoring.score(b.documents(), held).select("doc_id", "vote"),
        scoring.score(b.documents(), b.store.load(copy)).select("doc_id", "vote"),
    )


def _stream(b: Workbench, table: str) -> DataFrame:
    # a stream reads a single file only through a glob; a folder matches it too
    return b.spark.readStream.schema(b.table(table).schema).parquet(f"{b.path(table)}*")


def _streamed(b: Workbench) -> DataFrame:
    messages = _stream(b, "documents").select("doc_id", "text")
    folder = b.new_folder("stream")
    running = score_stream(
        messages, b.ensemble("LR"), f"{folder}/votes", f"{folder}/checkpoint", available_now=True
    )
    running.awaitTermination()
    return b.spark.read.parquet(f"{folder}/votes")


def _voted_events(b: Workbench, events: DataFrame) -> DataFrame:
    """Events as messages of users, each with the vote on the document that has the user's number."""
    votes = majority_vote(b).select(F.col("doc_id").alias("user_id"), "vote")
    micros = F.expr("timestampdiff(MICROSECOND, TIMESTAMP_NTZ '1970-01-01 00:00:00', ts)")  # in any session time zone
    return events.select(F.timestamp_micros(micros).alias("ts"), "user_id").join(votes, "user_id")


@query
def windowed_spam_rate(b: Workbench) -> DataFrame:
    """Spam rate per hour over the stream of events."""
    folder = b.new_folder("rates")
    scored = _voted_events(b, _stream(b, "events"))
    rates.spam_rate_stream(
        scored, f"{folder}/rates", f"{folder}/checkpoint", available_now=True
    ).awaitTermination()
    found = rates.spam_rates(b.spark, f"{folder}/rates")
    return found.select(
        F.unix_timestamp("window_start").alias("window_start"), "n", "n_spam", F.round("spam_rate", DECIMALS).alias("spam_rate")
    )


@query
def stream_score(b: Workbench) -> DataFrame:
    return _streamed(b).select("doc_id", "votes", "vote")


@query
def stream_equals_batch(b: Workbench) -> DataFrame:
    return _mismatches(
        _streamed(b).select("doc_id", "vote"),
        scoring.score(b.documents(), b.ensemble("LR")).select("doc_id", "vote"),
    )


@query
def stream_requests(b: Workbench) -> DataFrame:
    """All conversation turns as a request stream; the invalid ones come back without a vote."""
    folder = b.new_folder("requests")
    answer_requests(
        _requests(_stream(b, "conversations")),
        [b.ensemble(a) for a in METHODS],
        f"{folder}/answers",
        f"{folder}/checkpoint",
        available_now=True,
    ).awaitTermination()
    answers = b.spark.read.parquet(f"{folder}/answers")
    return answers.select("conv_id", "turn", "method", F.col("ok").cast("int").alias("ok"), "vote", "verdict")


@query
def stream_requests_accepted(b: Workbench) -> DataFrame:
    """Accepted requests get a vote and its text, the others neither."""
    answered = stream_requests(b)
    complete = F.col("vote").isNotNull() & F.col("verdict").isNotNull()
    return answered.select("conv_id", "turn", "method", "ok", complete.cast("int").alias("answered"))


@query
def stream_ingest(b: Workbench) -> DataFrame:
    """Lines arrive as a text stream: with a label, without one, and some with a label of 2."""
    folder = b.new_folder("ingest")
    rows = b.table("documents").join(b.table("labels"), "doc_id", "left")
    label = F.when(F.col("toxic").isNotNull() & (F.col("doc_id") % 17 == 0), 2).otherwise(F.col("toxic"))
    line = F.concat_ws("\t", label.cast("string"), _one_line())
    rows.select(line.alias("value")).write.text(f"{folder}/lines")
    ingest_labelled(
        b.spark.readStream.text(f"{folder}/lines"),
        f"{folder}/table",
        f"{folder}/checkpoint",
        available_now=True,
    ).awaitTermination()
    table, rejected = ingested(b.spark, f"{folder}/table")
    return table.select("doc_id", F.col("label").cast("int").cast("string").alias("status")).unionByName(
        rejected.select("doc_id", F.col("problem").alias("status"))
    )


@query
def append_and_retrain(b: Workbench) -> DataFrame:
    """English messages arrive first, the other languages later; each time a version is trained."""
    path = b.new_folder("labelled")
    store = type(b.store)(b.spark, b.new_folder("retrained"))
    rows = b.labelled().join(b.table("documents").select("doc_id", "lang"), "doc_id")
    results = None
    for arrived in (rows.where("lang = 'en'"), rows.where("lang <> 'en'")):
        append_messages(arrived.drop("lang"), path)
        version = retrain(b.spark.read.parquet(path), store, "DT", k=FOLDS).version
        split, ensemble = scoring.load_all(store, "DT")
        judged = scoring.out_of_fold(split, ensemble, store)
        means = evaluation.macro_average(evaluation.evaluate(judged, FOLDS)).select(
            F.lit(version.version).alias("version"),
            F.lit(version.n_rows).cast("bigint").alias("n_train"),
            "f1",
        )
        results = means if results is None else results.unionByName(means)
    return results


@query
def training_sizes(b: Workbench) -> DataFrame:
    """Published versions with the labelled rows behind them."""
    for algorithm in METHODS:
        b.ensemble(algorithm)
    return b.store.registry().select("algorithm", "k", "num_features", "n_rows")
