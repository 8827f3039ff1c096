"""A cascade cuts each text once where its ensembles have the same tokenizer."""

import pytest

from textjury.plans.registry import ModelStore
from textjury.plans.scoring import cascade, score
from textjury.plans.training import train


@pytest.fixture(scope="module")
def parts(spark, tmp_path_factory):
    rows = [(i, float(i % 2), f"w{i % 7} w{i % 5} " + ("bad" if i % 2 and i % 11 else "good")) for i in range(60)]
    table = spark.createDataFrame(rows, "doc_id LONG, label DOUBLE, text STRING")
    plain = ModelStore(spark, str(tmp_path_factory.mktemp("plain")))
    other = ModelStore(spark, str(tmp_path_factory.mktemp("words")))
    first, second = (train(table, plain, a, 2, 64, tokenizer={"mode": "word"}) for a in ("DT", "LR"))
    third = train(table, other, "LR", 2, 64, tokenizer={"mode": "keep_all"})
    return table.select("doc_id", "text"), first, second, third


def _cuts(df):
    return df._jdf.queryExecution().executedPlan().toString().count("regexp_extract_all(")


def test_texts_are_cut_once(parts):
    texts, first, second, third = parts
    assert _cuts(cascade(texts, first, second)) == _cuts(score(texts, first)) > 0
    assert _cuts(cascade(texts, first, third)) > _cuts(score(texts, first))


def test_votes_are_those_of_the_two_ensembles(parts):
    texts, first, *others = parts
    texts = texts.unionByName(texts.limit(1).selectExpr("doc_id + 1000 AS doc_id", "CAST(NULL AS STRING) AS text"))
    mine = {r["doc_id"]: r for r in score(texts, first).collect()}
    for second in others:
        its = {r["doc_id"]: r["vote"] for r in score(texts, second).collect()}
        rows = cascade(texts, first, second).collect()
        assert len(rows) == 61 and set(rows[0].asDict()) == {"doc_id", "text", "vote", "unsure"}
        for r in rows:
            assert r["unsure"] == (mine[r["doc_id"]]["votes"] == 1)
            assert r["vote"] == (its[r["doc_id"]] if r["unsure"] else mine[r["doc_id"]]["vote"])
