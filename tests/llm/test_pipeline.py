"""The pipeline against brute force: each stage is checked on the rows that the one before really kept."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from test_decontamination import brute as brute_hits
from test_line_dedup import brute as brute_lines
from test_simhash import brute_components, brute_print

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    draw = random.Random(9)
    word = lambda: "".join(draw.choices("abcdefghijklmnop", k=draw.randint(2, 7)))
    line = lambda n: " ".join(word() for _ in range(n))
    items = [(i, line(draw.randint(14, 30))) for i in range(10)]
    shared = [line(12) for _ in range(5)]
    rows, labels = [], []
    for i in range(700):
        lines = [line(draw.randint(5, 30)) for _ in range(draw.randint(1, 6))]
        if i % 7 == 0:
            lines.append(" ".join(draw.choices(["vilex", "nasto", "grubo", "zorkem"], k=4)))
        if i % 5 == 0:
            lines.insert(0, draw.choice(shared))
        if i % 41 == 1:
            lines[0] += " " + draw.choice(items)[1].upper()
        text = "\n".join(lines)
        if i % 50 == 3:
            text = rows[-2][1]
        if i % 50 == 4 and rows[-4][1]:
            text = rows[-4][1] + " changed"
        rows.append((i, text, "en", f"s{i % 3}" if i % 4 else "hot", len(text)))
        if i % 3:
            labels.append((i, 1, int(i % 7 == 0)))
    rows += [(None, "row without an id of its own", "en", None, 1), (900, None, None, None, None), (901, "", "en", "s1", 0), (902, "", "en", "s1", 0)]
    path = tmp_path_factory.mktemp("corpus")
    spark.createDataFrame(rows, DOCUMENTS).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return str(path)


@pytest.fixture(scope="module")
def stages(spark, folder):
    """Rows before the first stage and after each one."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    out = [docs.collect()]
    for name, stage in corpus_pipeline.STAGES:
        result = stage(spark, docs, folder)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert result.dtypes == docs.dtypes
        result.write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        out.append(docs.collect())
    return out


def ids(rows):
    return sorted((r["doc_id"] for r in rows), key=repr)


def test_names():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "simhash_near_dedup", "benchmark_decontamination", "source_mixing"]


def test_toxicity(stages):
    before, after = stages[0], stages[1]
    bad = {"vilex", "nasto", "grubo", "zorkem"}
    assert ids(after) == ids([r for r in before if not bad & set((r["text"] or "").split())])


def test_line_dedup(stages):
    before, after = stages[1], stages[2]
    expected = sorted(((d, text) for d, _, _, text in brute_lines([(r["doc_id"], r["text"]) for r in before])), key=repr)
    assert sorted(((r["doc_id"], r["text"]) for r in after), key=repr) == expected
    assert all(r["n_chars"] == len(r["text"]) for r in after)


def test_near_copies(stages):
    before, after = stages[2], stages[3]
    label = brute_components([brute_print(r["text"]) for r in before], 2)
    least = {}
    for r, c in zip(before, label):
        place = (r["doc_id"] is None, r["doc_id"])
        least[c] = min(least.get(c, place), place)
    assert ids(after) == sorted((p[1] for p in least.values()), key=repr)
    assert len(after) < len(before)


def test_decontamination(spark, stages, folder):
    before, after = stages[3], stages[4]
    items = [tuple(r) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    hits = brute_hits([(r["doc_id"], r["text"]) for r in before], items)
    assert ids(after) == sorted((d for d, _, n, _ in hits if not n), key=repr)
    assert len(after) < len(before)


def test_mix(stages):
    before, after = stages[4], stages[5]
    assert ids(after) == ids(before)
    assert all(0 <= r["taken"] <= 2 * r["size"] for r in after)
    total = sum(len((r["text"] or "").split()) for r in before)
    assert abs(sum(r["taken"] for r in after) - 1.5 * total) <= 5


def test_run_and_empty_input(spark, folder, stages, tmp_path):
    got = corpus_pipeline.run(spark, folder)
    assert sorted(map(repr, got.collect())) == sorted(map(repr, stages[-1]))
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{folder}/{name}.parquet").where(F.lit(False)).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
