from itertools import combinations

import pytest
from pyspark.sql import functions as F

from textjury.functions.hashing import similar_bucket, similar_signature
from textjury.operators.classifiers import estimator, warm_started
from textjury.operators.tokenizing import similar_words, tokenize
from textjury.operators.vectors import FEATURES
from textjury.plans.registry import ModelStore
from textjury.plans.scoring import score
from textjury.plans.split import build_split
from textjury.plans.training import train_on_split

K, M = 2, 1000


def grams(word):
    marked = f"\x02{word}\x03"
    return {marked[i : i + 2] for i in range(len(marked) - 1)}


def test_rows_agree_as_often_as_bigrams_do(spark):
    """Over many rows, the share of equal ones comes near the Jaccard similarity of the bigrams."""
    words = ["registration", "registrations", "registered", "banana", "", "é", "汉字汉字"]
    rows = 200
    asked = spark.createDataFrame([(w,) for w in words], "word string")
    got = {r["word"]: r["s"] for r in asked.select("word", similar_signature(F.col("word"), rows).alias("s")).collect()}
    cut = {w: [s[i : i + 8] for i in range(0, len(s), 8)] for w, s in got.items()}
    assert all(len(parts) == rows for parts in cut.values())
    for a, b in combinations(words, 2):
        same = sum(x == y for x, y in zip(cut[a], cut[b])) / rows
        assert same == pytest.approx(len(grams(a) & grams(b)) / len(grams(a) | grams(b)), abs=0.12)


def test_similar_words_share_buckets_more_often(spark):
    stems = [f"{a}{b}{c}" for a in ("stand", "manif", "proto", "regul") for b in ("ard", "est", "col", "ation") for c in ("ise", "ment", "ally")]
    words = spark.createDataFrame([(s, s + "s") for s in stems], "one string, other string")
    same = words.select((similar_bucket(F.col("one"), 100_000, 1) == similar_bucket(F.col("other"), 100_000, 1)).alias("s"))
    assert same.where("s").count() >= 0.6 * len(stems)


def test_null_and_empty(spark):
    df = spark.createDataFrame([(None,), ([],), (["a", None, "a", ""],)], "words array<string>")
    assert {r["token"] for r in similar_words(df, 10).collect()} == {"a", ""}
    assert spark.range(1).select(similar_signature(F.lit(None).cast("string")).alias("s")).first()["s"] is None
    texts = spark.createDataFrame([(None,), ("",), ("one two one",)], "text string")
    got = [r["words"] for r in tokenize(texts, "word", similar=2).collect()]
    assert got[:2] == [[], []] and got[2][0] == got[2][2] != got[2][1]
    with pytest.raises(ValueError, match="at least 1"):
        similar_signature(F.col("word"), 0)


@pytest.fixture(scope="module")
def labelled(spark):
    turns = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    spam = F.col("doc_id") % 3 == 0
    return turns.withColumn("doc_id", F.col("conv_id") * 1000 + F.col("turn")).select(
        "doc_id",
        spam.cast("double").alias("label"),
        F.when(spam, F.concat("text", F.lit(" jackpot jackpot"))).otherwise(F.col("text")).alias("text"),
    )


@pytest.fixture(scope="module")
def first(spark, tmp_path_factory, labelled):
    store = ModelStore(spark, str(tmp_path_factory.mktemp("warm")))
    split = build_split(labelled.where("doc_id div 1000 % 10 <> 0"), store.root, K, tokenizer={"mode": "word"})
    return store, train_on_split(split, store, "MP", num_features=M, warm_start=True)


def test_fewer_iterations_to_the_same_loss(spark, first, labelled):
    """The table has grown by a ninth; fits from the last version's weights come to almost no loss sooner."""
    store, ensemble = first
    split = build_split(labelled, store.root, K, tokenizer={"mode": "word"})
    taken = {"cold": 0, "warm": 0}
    for fold, member in enumerate(ensemble.members):
        _, idf, model = member.stages
        vectors = split.vectors(spark, M).where(F.col("fold") != fold)
        rows = idf.transform(vectors).select("label", FEATURES).coalesce(1).cache()
        cold = estimator("MP", M).setFeaturesCol(FEATURES)
        learners = {"cold": cold, "warm": warm_started(cold.copy(), model)}
        for name, learner in learners.items():
            losses = list(learner.fit(rows).summary().objectiveHistory)
            taken[name] += next(i for i, loss in enumerate(losses) if loss <= 1e-6)
        rows.unpersist()
    assert taken["warm"] < taken["cold"]


def test_warm_version_is_published_and_scores(first, labelled):
    store, _ = first
    split = build_split(labelled, store.root, K, tokenizer={"mode": "word"})
    second = train_on_split(split, store, "MP", num_features=M, replace=True, warm_start=True)
    assert second.version.version == store.latest("MP").version > 1
    assert score(labelled, second).where("vote in (0, 1)").count() == labelled.count()


def test_refused(spark, first, labelled):
    store, ensemble = first
    same = build_split(labelled, store.root, K, tokenizer={"mode": "word"})
    for settings in ({"salt": "x"}, {"group_key": F.col("text")}, {"k": 3}, {"tokenizer": {"mode": "keep_all"}}):
        other = build_split(labelled, store.root, **{"k": K, "tokenizer": {"mode": "word"}, **settings})
        with pytest.raises(ValueError, match="other folds"):
            train_on_split(other, store, "MP", num_features=M, replace=True, warm_start=True)
    with pytest.raises(ValueError, match="buckets, not"):
        train_on_split(same, store, "MP", num_features=M + 1, replace=True, warm_start=True)
    with pytest.raises(ValueError, match="no warm start"):
        train_on_split(same, store, "LR", num_features=M, warm_start=True)
    with pytest.raises(ValueError, match="no warm start with select"):
        train_on_split(same, store, "MP", num_features=M, replace=True, select=10, warm_start=True)
    with pytest.raises(ValueError, match="layers"):
        warm_started(estimator("MP", M + 1), ensemble.members[0].stages[-1])


def test_signatures_of_tokens_are_those_of_single_words(spark):
    """The tokenizer works them out per distinct token of a batch; nulls, marks and characters beyond the basic plane too."""
    texts = ["ab ab cd a", None, "", "𝒜b é 今天", "x" * 300, *[f"word{i % 7} same" for i in range(50)]]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, text string")
    for rows in (1, 3):
        signed = tokenize(tokenize(df, "word", out="plain"), "word", similar=rows)
        got = signed.withColumn("expected", F.transform("plain", lambda t: similar_signature(t, rows))).collect()
        assert len(got) == len(texts) and all(r["words"] == r["expected"] for r in got)
    assert "transform(" not in signed._jdf.queryExecution().optimizedPlan().toString()
