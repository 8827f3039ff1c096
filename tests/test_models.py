from dataclasses import replace
from types import SimpleNamespace

import numpy as np
import pytest
from pyspark.ml.feature import IDF, HashingTF
from pyspark.sql import functions as F

from textjury.operators.classifiers import ALGORITHMS, check_classes, estimator
from textjury.operators.folds import training_rows
from textjury.operators.vectors import FEATURES, fold_document_frequency, idf_stages
from textjury.plans import queries, training
from textjury.plans.comparison import comparison_board, evaluate_version
from textjury.plans.registry import Ensemble, ModelStore
from textjury.plans.scoring import (
    cascade,
    load_all,
    load_ensemble,
    measure,
    out_of_fold,
    predict,
    predict_member,
    score,
    score_by_method,
    score_side_by_side,
    score_weighted,
)
from textjury.plans.split import build_split, dictionary_tokenizer, open_split
from textjury.plans.training import check_memory, fit_tasks, fits_at_once, partial_sums, retrain, spread, train, train_on_split
from textjury.sources.requests import METHODS
from textjury.streaming.ingest import ingest_labelled, ingested
from textjury.streaming.scoring import answer_requests, judge_requests, score_stream

K, M = 3, 2000


@pytest.fixture(scope="module")
def messages(spark):
    """Given conversation turns; a third of them is made spam by a marker word."""
    turns = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    documents = turns.withColumn("doc_id", F.col("conv_id") * 1000 + F.col("turn"))
    spam = F.col("doc_id") % 3 == 0
    return documents.select(
        "doc_id",
        spam.cast("double").alias("label"),
        F.when(spam, F.concat("text", F.lit(" jackpot jackpot jackpot"))).otherwise(F.col("text")).alias("text"),
    )


@pytest.fixture(scope="module")
def store(spark, tmp_path_factory):
    return ModelStore(spark, str(tmp_path_factory.mktemp("store")))


@pytest.fixture(scope="module")
def split(store, messages):
    return build_split(messages, store.root, K, source_version="fixture", tokenizer={"mode": "word"})


@pytest.fixture(scope="module")
def ensembles(split, store):
    for algorithm in ALGORITHMS:
        train_on_split(split, store, algorithm, num_features=M)
    return {a: load_ensemble(store, a) for a in ALGORITHMS}


def votes(df):
    return {r["doc_id"]: r["vote"] for r in df.select("doc_id", "vote").collect()}


def test_split_is_reused_only_when_complete_and_equal(spark, store, split, messages):
    def again(**changes):
        settings = {"k": K, "source_version": "fixture", "tokenizer": {"mode": "word"}, **changes}
        return build_split(messages, store.root, **settings)

    assert again() == split
    assert open_split(spark, split.path) == split
    assert len({split.path, again(k=4).path, again(source_version="new").path, again(salt="s").path}) == 4
    with pytest.raises(RuntimeError, match="no complete split"):
        open_split(spark, f"{store.root}/absent")


def test_partial_split_is_rebuilt(spark, folder, messages):
    half = build_split(messages, folder, K, source_version="x")
    spark.createDataFrame([("other", "{}")], "fingerprint STRING, settings STRING").write.mode("overwrite").json(
        f"{half.path}/manifest"
    )
    spark.range(0).selectExpr("id doc_id", "0D label", "array('') words", "0 fold").write.mode("overwrite").parquet(
        f"{half.path}/rows"
    )
    rebuilt = build_split(messages, folder, K, source_version="x")
    assert rebuilt.rows(spark).count() == messages.count()


def test_idf_equals_spark_idf_on_the_training_rows(spark, split):
    vectors = split.vectors(spark, M)
    stages = idf_stages(fold_document_frequency(vectors, K, M))
    for fold, stage in enumerate(stages):
        fitted = IDF(inputCol="tf", outputCol="x").fit(training_rows(vectors, fold))
        assert np.allclose(stage.getScalingVec().toArray(), fitted.idf.toArray(), rtol=0, atol=1e-12)


def test_held_out_texts_do_not_leak(spark, folder, messages, split):
    before = idf_stages(fold_document_frequency(split.vectors(spark, M), K, M))
    fold = split.rows(spark).select("doc_id", "fold")
    changed = messages.join(fold, "doc_id").withColumn(
        "text", F.when(F.col("fold") == 1, F.lit("all different now")).otherwise(F.col("text"))
    )
    other = build_split(changed.drop("fold"), folder, K, tokenizer={"mode": "word"})
    after = idf_stages(fold_document_frequency(other.vectors(spark, M), K, M))
    assert before[1].getScalingVec() == after[1].getScalingVec()
    assert before[0].getScalingVec() != after[0].getScalingVec()


def test_vectors_are_hashing_tf(spark, split):
    expected = HashingTF(inputCol="words", outputCol="e", numFeatures=M).transform(split.rows(spark))
    both = expected.join(split.vectors(spark, M).select("doc_id", "tf"), "doc_id")
    assert all(r["e"] == r["tf"] for r in both.collect())


@pytest.mark.parametrize("algorithm", list(ALGORITHMS))
def test_each_algorithm_finds_the_marker(spark, store, split, ensembles, algorithm):
    metrics = evaluate_version(store, split, ensembles[algorithm]).collect()
    assert sorted(r["fold"] for r in metrics) == list(range(K))
    positives = sum(r["tp"] + r["fn"] for r in metrics)
    assert positives == split.rows(spark).where("label = 1").count()
    assert sum(r["tp"] for r in metrics) > 0
    if algorithm in ("DT", "GBDT"):
        assert all((r["precision"], r["recall"], r["f1"]) == (1.0, 1.0, 1.0) for r in metrics)


@pytest.mark.parametrize("algorithm", list(ALGORITHMS))
def test_published_member_equals_a_direct_fit(spark, split, ensembles, algorithm):
    vectors = split.vectors(spark, M)
    stage = idf_stages(fold_document_frequency(vectors, K, M))[0]
    rows = stage.transform(vectors.coalesce(1)).select("doc_id", "label", FEATURES, "fold")
    direct = estimator(algorithm, M).fit(rows.where("fold <> 0")).transform(rows)
    published = predict_member(vectors, ensembles[algorithm].members[0], "p")
    both = direct.select("doc_id", "prediction").join(published.select("doc_id", "p"), "doc_id")
    assert both.count() == vectors.count()
    assert both.where("prediction <> p").count() == 0


def test_scoring_ships_no_training_summary(ensembles):
    assert not any(m.stages[2].hasSummary for m in ensembles["LR"].members)


def test_out_of_fold_uses_the_member_that_never_saw_the_row(store, split, ensembles):
    judged = {r["doc_id"]: r["prediction"] for r in out_of_fold(split, ensembles["SVM"], store).collect()}
    words = split.rows(store.spark).withColumn("text", F.array_join("words", " "))
    members = {r["doc_id"]: r[f"p{r['fold']}"] for r in score(words.drop("words"), ensembles["SVM"]).collect()}
    assert judged == members


def test_out_of_fold_refuses_a_foreign_split(store, messages, ensembles):
    other = build_split(messages, store.root, 4, source_version="fixture", tokenizer={"mode": "word"})
    with pytest.raises(RuntimeError, match="another split"):
        out_of_fold(other, ensembles["LR"], store)


def test_vote_columns(messages, ensembles):
    scored = score(messages.select("doc_id", "text"), ensembles["SVM"])
    assert scored.columns == ["doc_id", "text", "p0", "p1", "p2", "votes", "vote"]
    for row in scored.collect():
        assert row["votes"] == row["p0"] + row["p1"] + row["p2"]
        assert row["vote"] == int(row["votes"] > 1)


def test_null_and_empty_texts_are_scored(spark, ensembles):
    df = spark.createDataFrame([(1, None), (2, "")], "doc_id LONG, text STRING")
    for ensemble in ensembles.values():
        assert score(df, ensemble).count() == 2


def test_side_by_side_and_by_method_equal_single_scores(messages, ensembles):
    texts = messages.select("doc_id", "text")
    single = {a: votes(score(texts, e)) for a, e in ensembles.items()}
    wide = score_side_by_side(texts, list(ensembles.values()))
    assert wide.columns == ["doc_id", "text", *[f"vote_{a}" for a in ensembles]]
    for row in wide.collect():
        assert all(row[f"vote_{a}"] == single[a][row["doc_id"]] for a in ensembles)

    names = F.array(*[F.lit(a) for a in ensembles])
    requests = texts.select(
        "doc_id", F.col("text").alias("message"), F.get(names, (F.col("doc_id") % len(ensembles)).cast("int")).alias("method")
    )
    for row in score_by_method(requests, list(ensembles.values())).collect():
        assert row["vote"] == single[row["method"]][row["doc_id"]]


def test_predict_a_single_message(ensembles):
    assert predict("jackpot jackpot jackpot", ensembles["GBDT"]) == 1
    assert predict("以上比赛规则由江苏科技大学教职工摄影协会负责解释", ensembles["GBDT"]) == 0


def test_weighted_score(spark, messages, ensembles):
    texts = messages.select("doc_id", "text")
    # Members 0 and 2 are always wrong: their reported F1 is 1, their weight 0.
    counts = [(0, 0, 3, 2, 1.0), (1, 5, 1, 0, 0.9), (2, 0, 0, 0, 1.0)]
    weights = spark.createDataFrame(counts, "fold INT, tp LONG, fp LONG, fn LONG, f1 DOUBLE")
    rows = score_weighted(texts, ensembles["SVM"], weights).collect()
    assert len(rows) == messages.count() and all(r["vote"] == r["p1"] for r in rows)


def test_cascade(messages, ensembles):
    texts = messages.select("doc_id", "text")
    first, second = votes(score(texts, ensembles["SVM"])), votes(score(texts, ensembles["DT"]))
    rows = cascade(texts, ensembles["SVM"], ensembles["DT"]).collect()
    assert len(rows) == len(first)
    for row in rows:
        assert row["vote"] == (second if row["unsure"] else first)[row["doc_id"]]


def test_stream_votes_equal_batch_votes(spark, folder, messages, ensembles):
    messages.select("doc_id", "text").repartition(3).write.parquet(f"{folder}/in")
    stream = spark.readStream.schema("doc_id LONG, text STRING").option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")

    def run():
        score_stream(stream, ensembles["GBDT"], f"{folder}/out", f"{folder}/ck", available_now=True).awaitTermination()
        return votes(spark.read.parquet(f"{folder}/out"))

    expected = votes(score(messages.select("doc_id", "text"), ensembles["GBDT"]))
    assert run() == expected
    spark.createDataFrame([(10**9, "jackpot jackpot jackpot")], "doc_id LONG, text STRING").write.mode("append").parquet(
        f"{folder}/in"
    )
    assert run() == {**expected, 10**9: 1}
    assert spark.read.parquet(f"{folder}/out").count() == len(expected) + 1


def test_registry_lifecycle(spark, folder, messages):
    store = ModelStore(spark, folder)
    with pytest.raises(RuntimeError, match="train one first"):
        load_ensemble(store, "LR")
    first = train(messages, store, "LogisticRegression", K, M, source_version="1").version
    assert (first.algorithm, first.version, first.n_rows) == ("LR", 1, messages.count())
    with pytest.raises(RuntimeError, match="exists"):
        train(messages, store, "LR", K, M)
    with pytest.raises(ValueError, match="labels must be 0 or 1"):
        retrain(messages.withColumn("label", F.lit(2.0)), store, "LR", k=K, num_features=M)
    assert store.latest("LR") == first and len(store.load(first).members) == K
    second = retrain(messages, store, "LR", k=K, num_features=M, source_version="1").version
    assert second.version == 2 and second.split == first.split
    split, ensemble = load_all(store, "LR")
    assert ensemble.version == second and split.path == second.split
    assert len(store.load(first).members) == K
    with pytest.raises(RuntimeError, match="cannot load"):
        store.load(replace(first, path=f"{folder}/nowhere"))


def test_unknown_algorithm(spark, folder, messages):
    with pytest.raises(ValueError, match="unknown algorithm"):
        train(messages, ModelStore(spark, folder), "KNN")


def test_one_class_training_folds():
    one_class = [{"fold": f, "n": 4, "n_zero": 4, "n_one": 0} for f in range(3)]
    check_classes("LR", one_class)
    with pytest.raises(ValueError, match="one class only"):
        check_classes("SVM", one_class)
    with pytest.raises(ValueError, match="nothing left"):
        check_classes("LR", [{"fold": 0, "n": 4, "n_zero": 2, "n_one": 2}])
    with pytest.raises(ValueError, match="no labelled"):
        check_classes("LR", [])


def test_tree_fits_that_need_too_much_memory_are_refused(split, store):
    check_memory("LR", 10**12, 10_000, 1)
    check_memory("DT", 10, 100, 4_000)
    with pytest.raises(ValueError, match="num_features up to 50 would fit"):
        check_memory("GBDT", 10, 101, 2_000)
    with pytest.raises(ValueError, match="max_dense_bytes"):
        train_on_split(split, store, "DT", M, replace=True, max_dense_bytes=1_000)


def test_equal_version_numbers_keep_their_own_records(spark, folder, messages):
    store = ModelStore(spark, folder)
    split = build_split(messages, folder, K, tokenizer={"mode": "word"})
    one = train_on_split(split, store, "DT", 100)
    other = replace(one.version, path=store.new_path("DT", one.version.version))
    metrics = evaluate_version(store, split, one).select("fold", "tp", "fp", "fn", "precision", "recall", "f1")
    store.record(other, metrics.withColumn("tp", F.lit(0).cast("long")))
    recorded = store.experiments().where("version = 1")
    assert recorded.count() == 2 * K and recorded.select("run").distinct().count() == 2


DICTIONARY = ["恭喜", "中奖", "点击", "领取", "今天", "一起", "吃饭", "开会"]


def unspaced(spark):
    spam, ham = ["恭喜您中奖请点击领取", "点击领取大奖恭喜中奖"], ["今天一起吃饭吗", "今天开会一起去"]
    rows = [(i, float(i % 2), (spam if i % 2 else ham)[i // 2 % 2] + "啊" * (i % 5)) for i in range(80)]
    return spark.createDataFrame(rows, "doc_id LONG, label DOUBLE, text STRING")


def test_dictionary_goes_with_the_version(spark, folder):
    rows = unspaced(spark)
    known = spark.createDataFrame([(w,) for w in DICTIONARY], "token STRING")
    tokenizer = dictionary_tokenizer(known, f"{folder}/words")
    store = ModelStore(spark, folder)
    train(rows, store, "DT", 2, 500, tokenizer=tokenizer)
    ensemble = load_ensemble(store, "DT")
    words = open_split(spark, ensemble.version.split).rows(spark).select(F.explode("words").alias("w")).distinct()
    assert set(DICTIONARY) <= {r["w"] for r in words.collect()}
    scored = {r["doc_id"]: r["vote"] for r in score(rows, ensemble).collect()}
    assert scored == {i: i % 2 for i in range(80)}
    assert predict("恭喜中奖", ensemble) == 1 and predict("今天开会", ensemble) == 0
    wide = score_side_by_side(rows, [ensemble]).collect()
    assert all(r["vote_DT"] == scored[r["doc_id"]] for r in wide)

    rows.select("doc_id", "text").write.parquet(f"{folder}/in")
    stream = spark.readStream.schema("doc_id LONG, text STRING").parquet(f"{folder}/in")
    score_stream(stream, ensemble, f"{folder}/out", f"{folder}/ck", available_now=True).awaitTermination()
    assert votes(spark.read.parquet(f"{folder}/out")) == scored

    dictionary_tokenizer(known.limit(3), f"{folder}/words")
    with pytest.raises(RuntimeError, match="not the one"):
        score(rows, ensemble)


def test_default_tokenizer_cuts_unspaced_scripts(spark, folder):
    store = ModelStore(spark, folder)
    ensemble = train(unspaced(spark), store, "DT", 2, 500)
    assert predict("您中奖了", ensemble) == 1 and predict("今天吃饭", ensemble) == 0


def test_files_per_fold_are_bounded(spark, folder):
    many = spark.range(4000).selectExpr("id doc_id", "0D label", "'a b' text").repartition(200)
    split = build_split(many, folder, 2, tokenizer={"mode": "word"})
    assert len(split.rows(spark).inputFiles()) <= 2 * spark.sparkContext.defaultParallelism


def test_fit_sizing():
    assert fit_tasks("LR", 4_000, 10_000, 800_000) == 1
    assert fit_tasks("DT", 4_000, 10_000, 800_000) == 3
    assert fits_at_once(8, 1, 5) == 5
    assert fits_at_once(4_000, fit_tasks("SVM", 10**10, 10_000, 10**12), 5) == 1


def test_tasks_of_large_fits_are_bounded():
    assert fit_tasks("GBDT", 200_000, 10_000, 0) == 120
    assert fit_tasks("GBDT", 200_000, 10_000, 0, cores=12) == 12  # a histogram per task and node
    assert fit_tasks("DT", 1_200_000, 10_000, 0, cores=12) == 45  # at most 1 GiB each
    assert fit_tasks("DT", 4_000, 10_000, 800_000, cores=12) == 3
    for entries in (10**6, 10**7, 2 * 10**7, 5 * 10**7, 3 * 10**8):
        tasks = fit_tasks("SVM", 10**6, 10_000, entries, cores=12)
        assert tasks <= 12 and partial_sums(tasks) <= 2  # gradients to the driver per pass
    assert [partial_sums(n) for n in (1, 2, 5, 6, 11, 12, 59)] == [1, 2, 5, 2, 2, 3, 7]
    assert fits_at_once(12, 11, 5) == 5
    assert fits_at_once(12, 12, 5, size=8 * 10**9) == 1  # what they cache together is bounded too


def test_tasks_of_a_fit_hold_as_many_rows(spark, folder, monkeypatch):
    """One write task had nearly all rows, so one file of each fold has; merged, its task has them too."""
    seen = []

    class Recorded:
        def setFeaturesCol(self, name):
            self.learner = estimator("LR", 100).setFeaturesCol(name)
            return self

        def fit(self, rows):
            seen.append([r["count"] for r in rows.groupBy(F.spark_partition_id()).count().collect()])
            return self.learner.fit(rows)

    monkeypatch.setattr(training, "estimator", lambda algorithm, width: Recorded())
    monkeypatch.setattr(training, "BYTES_PER_TASK", 1_000)
    rows = spark.range(800, numPartitions=4).where("id < 200 or id % 20 = 0")
    rows = rows.selectExpr("id doc_id", "double(id % 2) label", "if(id % 2 = 1, 'a b c', 'a d e') text")
    train(rows, ModelStore(spark, folder), "LR", 2, 100)
    assert len(seen) == 2 and all(len(sizes) > 1 for sizes in seen)
    assert all(max(sizes) <= min(sizes) + 8 for sizes in seen)  # at most one row more from each partition


def test_joint_votes_are_computed_once(spark, folder, messages, ensembles, monkeypatch):
    once = messages.select("doc_id", "text").limit(60)
    once.unionByName(once.limit(20)).unionByName(spark.sql("select null doc_id, 'a' text")).write.parquet(f"{folder}/documents")
    held = {a: Ensemble(replace(ensembles["LR"].version, algorithm=a), ensembles["LR"].members) for a in METHODS}
    bench = SimpleNamespace(ensemble=held.get, documents=lambda: spark.read.parquet(f"{folder}/documents"))

    def scans(found):
        leaves = found._jdf.queryExecution().optimizedPlan().collectLeaves()
        return sum("text#" in leaves.apply(i).toString() for i in range(leaves.size()))

    found = queries.vote_consistency(bench)
    monkeypatch.setattr(queries, "stored", lambda df, name: df)
    inline = queries.vote_consistency(bench)
    assert (scans(found), scans(inline)) == (len(METHODS), 3 * len(METHODS))
    rows = sorted(map(tuple, found.collect()))
    assert rows == sorted(map(tuple, inline.collect())) == sorted((a, 40 + 20 * 8 + 1, 1) for a in METHODS)


def test_many_partitions_are_merged_without_a_shuffle(spark):
    many = spark.range(100, numPartitions=8 * 3)
    assert spread(many, 3).rdd.getNumPartitions() == 3
    assert "Coalesce 3" in spread(many, 3)._jdf.queryExecution().executedPlan().toString()
    assert spread(many, 4).rdd.getNumPartitions() == 4
    assert "Exchange" in spread(many, 4)._jdf.queryExecution().executedPlan().toString()


def test_given_words_and_group_key(spark, folder, messages):
    words = messages.select("doc_id", "label", F.split("text", " ").alias("words"), "text")
    split = build_split(words, folder, K, tokenizer={"mode": "given"}, group_key=F.md5("text"))
    assert split.rows(spark).count() == messages.count()


def test_board_and_records(spark, folder, messages):
    store = ModelStore(spark, folder)
    split = build_split(messages, folder, K, tokenizer={"mode": "word"})
    trained = []
    for algorithm in ("LR", "DT"):
        train_on_split(split, store, algorithm, M)
        trained.append(load_ensemble(store, algorithm))
        evaluate_version(store, split, trained[-1])
        evaluate_version(store, split, trained[-1])  # replaces its records
    board = comparison_board(store, split, trained, messages.select("doc_id", "text"))
    rows = {r["algorithm"]: r for r in board.collect()}
    assert set(rows) == {"LR", "DT"} and rows["DT"]["f1"] == 1.0
    assert all(r["seconds"] > 0 for r in rows.values())
    assert store.experiments().count() == 2 * K


def test_throughput_of_nothing_is_null(spark, ensembles):
    nothing = spark.createDataFrame([], "doc_id LONG, text STRING")
    run = measure(score(nothing, ensembles["LR"]))
    assert run["rows"] == 0 and run["seconds_per_message"] is None


def test_request_stream_equals_batch(spark, folder, messages, ensembles):
    methods = F.array(*[F.lit(a) for a in [*ensembles, "KNN"]])
    requests = messages.select(
        "doc_id",
        F.when(F.col("doc_id") % 4 == 0, "jackpot jackpot jackpot").otherwise(F.col("text")).alias("message"),
        F.get(methods, (F.col("doc_id") % 6).cast("int")).alias("method"),
    )
    requests.write.parquet(f"{folder}/in")
    stream = spark.readStream.schema(requests.schema).parquet(f"{folder}/in")
    held = list(ensembles.values())
    answer_requests(stream, held, f"{folder}/out", f"{folder}/ck", available_now=True).awaitTermination()
    columns = ["doc_id", "method", "ok", "vote", "verdict"]
    got = spark.read.parquet(f"{folder}/out").select(*columns).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, judge_requests(requests, held).select(*columns).collect()))
    for row in got:
        assert row["ok"] == (row["vote"] is not None) == (row["verdict"] is not None)
        assert row["ok"] or row["doc_id"] % 4 or row["method"] == "KNN"


def test_ingest_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    lines = spark.readStream.text(str(tmp_path / "in"))

    def run():
        ingest_labelled(lines, f"{tmp_path}/table", f"{tmp_path}/ck", available_now=True).awaitTermination()

    (tmp_path / "in" / "a.txt").write_text("1\ta\nbad line\n2\td\nNaN\te\n")
    run()
    (tmp_path / "in" / "b.txt").write_text("0\tb\nx\tc\n-1\tf\n")
    run()
    table, bad = ingested(spark, f"{tmp_path}/table")
    assert sorted(map(tuple, table.select("label", "text").collect())) == [(0.0, "b"), (1.0, "a")]
    assert sorted(r["value"] for r in bad.collect()) == ["-1\tf", "2\td", "NaN\te", "bad line", "x\tc"]


def test_retrain_after_a_bad_label_arrived(spark, tmp_path):
    (tmp_path / "in").mkdir()
    good = "".join(f"{i % 2}\t{'jackpot now' if i % 2 else 'see you'} {i}\n" for i in range(60))
    (tmp_path / "in" / "a.txt").write_text(good + "2\tother label\n")
    lines = spark.readStream.text(str(tmp_path / "in"))
    ingest_labelled(lines, f"{tmp_path}/table", f"{tmp_path}/ck", available_now=True).awaitTermination()
    table, bad = ingested(spark, f"{tmp_path}/table")
    store = ModelStore(spark, f"{tmp_path}/store")
    assert bad.count() == 1 and retrain(table, store, "LR", k=2, num_features=100).version.n_rows == 60
