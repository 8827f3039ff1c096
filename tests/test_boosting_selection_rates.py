import datetime as dt
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from textjury import ModelStore, build_split, load_boosted, score_boosted, train_boosted
from textjury.operators.classifiers import DEFAULT_NUM_FEATURES
from textjury.operators.selection import best_buckets, chi_square_by_fold, fold_label_frequency
from textjury.plans import boosting, scoring
from textjury.plans import split as split_plans
from textjury.plans.split import folders_at_size, scanned_bytes
from textjury.plans.training import train_on_split
from textjury.streaming.rates import spam_rate_stream, spam_rates, windowed_counts, with_rate

M = 64
LABELLED = "doc_id string, label double, text string"


def rows(n=240, noise=0.15, seed=4):
    """Spam has two of three marks; some labels are wrong."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        marks = [m for m in ("win", "cash", "free") if rng.random() < 0.45]
        label = float((len(marks) >= 2) != (rng.random() < noise))
        out.append((str(i), label, " ".join(marks + rng.choices("abcdefgh", k=5))))
    return out


@pytest.fixture(scope="module")
def split(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("boost"))
    return build_split(spark.createDataFrame(rows(), LABELLED), root, 3, tokenizer={"mode": "word"}), ModelStore(spark, root)


@pytest.fixture(scope="module")
def boosted(split):
    return train_boosted(*split, "DT", rounds=3, num_features=M, settings={"maxDepth": 1})


def test_rounds_and_alphas(spark, split, boosted):
    assert 1 <= len(boosted.alphas) <= 3 and all(e < 0.5 for e in boosted.errors)
    assert all(math.isclose(a, 0.5 * math.log((1 - e) / e)) for a, e in zip(boosted.alphas, boosted.errors))
    weights = {}
    for t, alpha in enumerate(boosted.alphas):
        judged = boosting.round_rows(spark, boosted.version.path, t).collect()
        if t == 0:
            assert {r["weight"] for r in judged} == {1.0}
        else:
            assert all(math.isclose(r["weight"], weights[r["doc_id"]], rel_tol=1e-9) for r in judged)
        wrong = sum(r["weight"] for r in judged if r["prediction"] != r["label"]) / sum(r["weight"] for r in judged)
        assert math.isclose(wrong, boosted.errors[t])
        scale = 2 * math.sqrt(wrong * (1 - wrong)) * sum(r["weight"] for r in judged) / len(judged)
        weights = {r["doc_id"]: r["weight"] * math.exp(alpha if r["prediction"] != r["label"] else -alpha) / scale for r in judged}


def test_votes_follow_the_alphas(spark, split, boosted):
    where, store = split
    judged = {r["doc_id"]: r for r in boosting.boosted_out_of_fold(where, boosted, store).collect()}
    assert len(judged) == 240
    said = {}
    for t, alpha in enumerate(boosted.alphas):
        for fold, member in enumerate(boosted.rounds[t]):
            held = where.vectors(spark, M).where(F.col("fold") == fold)
            for r in scoring.predict_member(held, member, "p").collect():
                said[r["doc_id"]] = said.get(r["doc_id"], 0) + alpha * (2 * r["p"] - 1)
    assert {k: float(v > 0) for k, v in said.items()} == {k: r["prediction"] for k, r in judged.items()}


def test_published_and_loaded(spark, split, boosted):
    _, store = split
    again = load_boosted(store, "DT")
    assert (again.version, again.alphas) == (boosted.version, boosted.alphas)
    assert store.latest("DT") is None  # plain versions are apart
    df = spark.createDataFrame(rows()[:30], LABELLED).select("doc_id", "text")
    votes = [{r["doc_id"]: r["vote"] for r in score_boosted(df, b).collect()} for b in (boosted, again)]
    assert votes[0] == votes[1] and set(votes[0].values()) <= {0, 1}
    assert score_boosted(df, boosted).columns == ["doc_id", "text", "p0", "p1", "p2", "votes", "vote"]


def test_a_faultless_round_ends_it(spark, folder):
    data = [(str(i), float(i % 2), "spam" if i % 2 else "ham") for i in range(60)]
    where = build_split(spark.createDataFrame(data, LABELLED), folder, 2, tokenizer={"mode": "word"})
    got = train_boosted(where, ModelStore(spark, folder), "DT", rounds=5, num_features=M)
    assert len(got.rounds) == 1 and got.errors == (0.0,) and math.isfinite(got.alphas[0])


def test_refusals(split):
    with pytest.raises(ValueError, match="boosted"):
        train_boosted(*split, "MP")
    with pytest.raises(ValueError, match="rounds"):
        train_boosted(*split, "DT", rounds=0)
    with pytest.raises(ValueError, match="max_dense_bytes"):
        train_boosted(*split, "DT", max_dense_bytes=1)


# Selection


def by_hand(tokens, fold):
    """bucket -> chi-square from the expected counts of the 2 x 2 table."""
    train = [(label, set(b)) for f, label, b in tokens if f != fold]
    out = {}
    for bucket in {b for _, _, held in tokens for b in held}:
        table = np.zeros((2, 2))
        for label, held in train:
            table[int(bucket in held), int(label)] += 1
        expected = table.sum(axis=1, keepdims=True) * table.sum(axis=0, keepdims=True) / table.sum()
        out[bucket] = float(((table - expected) ** 2 / expected).sum()) if (expected > 0).all() else 0.0
    return out


def test_chi_square_equals_expected_counts(spark):
    rng = random.Random(2)
    data = [(i % 3, float(rng.random() < 0.4), rng.choices("abcdefgh", k=rng.randint(0, 5))) for i in range(90)]
    df = spark.createDataFrame(data, "fold int, label double, words array<string>")
    got = {(r["held_out"], r["bucket"]): r["chi_square"] for r in chi_square_by_fold(df, 16, 3).collect()}
    from textjury.functions.hashing import md5_bucket

    names = spark.createDataFrame([(c,) for c in "abcdefgh"], "w string").select("w", md5_bucket(F.col("w"), 16).alias("b")).collect()
    number = {r["w"]: r["b"] for r in names}
    tokens = [(f, label, [number[w] for w in words]) for f, label, words in data]
    for fold in range(3):
        for bucket, value in by_hand(tokens, fold).items():
            assert math.isclose(got[fold, bucket], value, abs_tol=1e-9)


def test_best_buckets_equal_chi_square(spark, split):
    where, _ = split
    n, pos = fold_label_frequency(where.vectors(spark, M), 3, M)
    vectors = [(r["fold"], r["label"], r["tf"].indices.tolist()) for r in where.vectors(spark, M).collect()]
    for fold, chosen in enumerate(best_buckets(n, pos, 3)):
        values = by_hand(vectors, fold)
        assert chosen == sorted(sorted(values, key=lambda b: (-round(values[b], 9), b))[:3])


def test_no_label_or_no_bucket_left():
    n = np.array([[0.0, 2.0, 2.0], [0.0, 1.0, 3.0]])
    assert best_buckets(n, np.zeros((2, 3)), 1) == [[0], [0]]


@pytest.mark.parametrize("algorithm", ["DT", "LR"])
def test_selected_members(spark, split, folder, algorithm):
    where, _ = split
    store = ModelStore(spark, folder)
    n_rows, wide = 240, DEFAULT_NUM_FEATURES["DT"]
    bound = 4 * n_rows * 10
    if algorithm == "DT":
        with pytest.raises(ValueError, match="max_dense_bytes"):
            train_on_split(where, store, "DT", num_features=wide, max_dense_bytes=bound)
    ensemble = train_on_split(where, store, algorithm, num_features=wide, max_dense_bytes=bound, select=10)
    assert all(len(m.stages) == 4 and len(m.stages[2].getIndices()) == 10 for m in ensemble.members)
    df = spark.createDataFrame(rows()[:40], LABELLED)
    scored = scoring.score(df, ensemble).collect()
    for i, member in enumerate(ensemble.members):
        words = df.withColumn("words", F.split("text", " "))
        direct = {r["doc_id"]: r["prediction"] for r in member.transform(words).collect()}
        assert direct == {r["doc_id"]: r[f"p{i}"] for r in scored}
    assert scoring.out_of_fold(where, ensemble, store).count() == n_rows


def test_select_must_be_positive(split):
    with pytest.raises(ValueError, match="select"):
        train_on_split(split[0], ModelStore(split[1].spark, split[1].root + "/none"), "DT", select=0)


# Files of a joined input


def test_file_count_follows_the_files_read(spark, folder):
    spark.range(20_000).selectExpr("id AS doc_id", "repeat('x', 20) AS text").repartition(40).write.parquet(f"{folder}/d")
    spark.range(20_000).selectExpr("id AS doc_id", "1.0 AS label").repartition(40).write.parquet(f"{folder}/l")
    joined = spark.read.parquet(f"{folder}/d").join(spark.read.parquet(f"{folder}/l").hint("shuffle_hash"), "doc_id")
    assert scanned_bytes(joined) < 10_000_000
    with_tasks = joined.repartition(64)
    assert folders_at_size(with_tasks, 5).rdd.getNumPartitions() <= spark.sparkContext.defaultParallelism


# Rates

T0 = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
EVENTS = "ts timestamp, vote int"


def at(hours, vote):
    return (T0 + dt.timedelta(hours=hours), vote)


def drop(spark, folder, n, events):
    spark.createDataFrame(events, EVENTS).coalesce(1).write.parquet(f"{folder}/in/{n}")


def run(spark, folder, **settings):
    stream = spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in/*")
    spam_rate_stream(stream, f"{folder}/out", f"{folder}/ck", available_now=True, **settings).awaitTermination()
    found = spam_rates(spark, f"{folder}/out")
    return {round((r["window_start"].timestamp() - T0.timestamp()) / 3600, 3): (r["n"], r["n_spam"], r["spam_rate"]) for r in found.collect()}


def test_restart_and_late_rows(spark, folder):
    drop(spark, folder, 0, [at(0.1, 1), at(0.9, 0), at(5.5, 1)])
    assert run(spark, folder, lateness="2 hours") == {0: (2, 1, 0.5), 5: (1, 1, 1.0)}
    # From the checkpoint: the state of window 5 goes on, window 0 is closed, window 4 is still open.
    drop(spark, folder, 1, [at(5.6, 0), at(0.5, 1), at(4.0, 1), at(30, None)])
    assert run(spark, folder, lateness="2 hours") == {0: (2, 1, 0.5), 4: (1, 1, 1.0), 5: (2, 1, 0.5), 30: (1, 0, 0.0)}
    assert run(spark, folder, lateness="2 hours")[5] == (2, 1, 0.5)


def test_a_repeated_batch_replaces_its_windows(spark, folder):
    drop(spark, folder, 0, [at(0, 1)])
    first = run(spark, folder)
    again = spark.createDataFrame([(T0, T0 + dt.timedelta(hours=1), 1, 1)], "window_start timestamp, window_end timestamp, n long, n_spam long")
    again.write.mode("overwrite").parquet(f"{folder}/out/batch=0")
    assert spam_rates(spark, f"{folder}/out").count() == len(first) == 1
    assert spam_rates(spark, f"{folder}/nothing") is None


def test_sliding_windows_and_missing_times(spark):
    df = spark.createDataFrame([at(0.5, 1), (None, 1), at(1.2, None)], EVENTS)
    found = with_rate(windowed_counts(df, "ts", "2 hours", "1 hour")).collect()
    got = {round((r["window_start"].timestamp() - T0.timestamp()) / 3600): (r["n"], r["n_spam"], r["spam_rate"]) for r in found}
    assert got == {-1: (1, 1, 1.0), 0: (2, 1, 0.5), 1: (1, 0, 0.0)}


def test_merged_write_tasks_stay_bounded(spark, monkeypatch):
    rows = spark.range(0, 64_000, numPartitions=64)  # 512,000 bytes
    assert folders_at_size(rows, 5).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    monkeypatch.setattr(split_plans, "BYTES_PER_TASK", 16_000)
    assert folders_at_size(rows, 5).rdd.getNumPartitions() == 32
