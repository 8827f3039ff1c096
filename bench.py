"""Headline queries, timed once each; prints one JSON line.

Every training query fits its algorithm from the raw tables: the split and its
vectors are stored by the first query that needs them, as in a real run.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession

from textjury import predict
from textjury.plans.queries import bound
from textjury.plans.workbench import workbench
from textjury.sources.tables import first_messages

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
PREDICTED = 100
HEADLINE = [
    "labelled_messages",
    "parse_labelled_lines",
    "clean_text",
    "tokenize_words",
    "tokenize_keep_all",
    "tokenize_char_bigrams",
    "tokenize_dictionary",
    "vocabulary",
    "hash_collisions",
    "hashed_tf",
    "idf_leave_one_out",
    "tfidf",
    "precision_recall_f1",
    "majority_vote",
    "split_roundtrip",
    "cv_lr",
    "cv_mp",
    "cv_svm",
    "cv_dt",
    "cv_gbdt",
    "ensemble_score",
    "score_side_by_side",
    "score_by_method",
    "stream_score",
    "algorithm_comparison",
    "scoring_throughput",
    "model_roundtrip",
]


def scale(folder: str) -> float | str:
    name = os.path.basename(folder.rstrip("/")).removeprefix("sf")
    return float(name) if name.replace(".", "", 1).isdigit() else name


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "12g"))
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    spark.range(1).write.format("noop").mode("overwrite").save()
    queries = bound()
    seconds = {}
    for name in HEADLINE:
        started = time.perf_counter()
        queries[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - started, 3)
    bench = workbench(spark, SF_DIR)
    first = first_messages(bench.table("conversations"), PREDICTED, "conv_id")
    messages = [row["text"] for row in first.collect()]
    fits, latency = {}, {}
    for algorithm, ensemble in bench.ensembles.items():
        fits[algorithm] = round(ensemble.version.fit_seconds, 3)
        started = time.perf_counter()
        for message in messages:
            predict(message, ensemble)
        latency[algorithm] = round((time.perf_counter() - started) / len(messages), 4)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "fit_all_folds_sec": fits,
                "predict_one_message_sec": latency,
                "sf": scale(SF_DIR),
            }
        )
    )


if __name__ == "__main__":
    main()
