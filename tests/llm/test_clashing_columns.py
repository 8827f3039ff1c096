"""Functions that give back the columns of their input keep all of them, whatever they are called."""

import pytest
from pyspark.sql import functions as F

from textjury.llm import decontamination, line_dedup, simhash, toxicity
from textjury.llm.common import unused

NAMES = ["_doc", "_hash", "_key", "_no_key", "_dropped", "__hash", "text_hash", "dropped", "HASH", "fp", "component_fp", "score", "votes", "owner", "first"]
TEXT = "one common line of this text\nand another line of it"


@pytest.fixture
def docs(documents):
    rows = [(1, TEXT), (2, TEXT), (None, "a line of its own"), (4, None), (5, "trash words " * 30)]
    return documents(rows).withColumns({name: F.lit(f"own {name}") for name in NAMES})


def test_names_that_are_not_taken(spark):
    df = spark.range(1).withColumns({"_Doc": F.lit(1), "__doc": F.lit(1)})
    assert unused(df, "_doc", "_doc", "x") == ["___doc", "____doc", "x"]


def check(docs, kept, ids, extra=()):
    assert kept.columns == [*docs.columns, *extra]
    rows = kept.collect()
    assert sorted(r["doc_id"] or 0 for r in rows) == ids
    assert all(r[name] == f"own {name}" for r in rows for name in NAMES)


def test_dedup_lines(docs):
    kept = line_dedup.dedup_lines(docs)
    check(docs, kept, [0, 1, 2, 4, 5], ["n_lines", "n_dropped"])
    assert {r["doc_id"]: r["n_dropped"] for r in kept.collect()} == {1: 0, 2: 2, None: 0, 4: 0, 5: 0}


def test_near_dedup(docs):
    check(docs, simhash.near_dedup(docs), [0, 1, 4, 5])


def test_without_toxic(spark, docs):
    labels = spark.createDataFrame([(1, 0), (5, 1)], "doc_id long, toxic int")
    check(docs, toxicity.without_toxic(docs, labels), [0, 1, 2, 4, 5])


def test_without_contaminated(spark, docs):
    tests = spark.createDataFrame([(1, "a line of its own")], "item_id long, text string")
    check(docs, decontamination.without_contaminated(docs, tests), [1, 2, 4, 5])


def test_runs_leave_the_catalog_when_a_batch_fails(spark, docs, monkeypatch):
    monkeypatch.setattr(line_dedup.LineRuns, "_put", lambda self, keys, level: (self.levels.append([self._write(keys)]), 1 / 0))
    with pytest.raises(ZeroDivisionError):
        line_dedup.repeated_lines(docs)
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("line_run_")]
