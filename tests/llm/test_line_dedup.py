import hashlib
import random

import pytest
from pyspark.sql import functions as F

from textjury.llm import line_dedup

BLANKS = " \t\n\x0b\f\r"


def brute(rows):
    key = lambda line: "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(BLANKS))
    place = lambda d: 2**63 - 1 if d is None else d
    owner = {}
    for d, text in rows:
        for line in (text or "").split("\n"):
            owner[key(line)] = min(owner.get(key(line), 2**63), place(d))
    out = []
    for d, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if len(key(x)) < 10 or owner[key(x)] == place(d)]
        out.append((d, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def result(df):
    return sorted(((r["doc_id"], r["n_lines"], r["n_dropped"], r["text"]) for r in df.collect()), key=repr)


CASES = {
    "nulls and empty": [(1, None), (2, ""), (3, "\n\n"), (None, "a repeated line"), (4, "A Repeated LINE \t")],
    "all ids null": [(None, "a repeated line"), (None, "a repeated line\nx")],
    "repeats inside the owner stay": [(5, "long enough line\nlong enough line"), (6, "x\nlong enough line\ny")],
    "short lines stay": [(1, "123456789"), (2, "123456789"), (3, "1234567890"), (4, "1234567890")],
    "code points, not bytes": [(1, "ééééééééé"), (2, "ééééééééé"), (3, "éééééééééé"), (4, "éééééééééé")],
    "only ascii case": [(1, "ÉCOLE DE PARIS"), (2, "école de paris"), (3, "École de Paris"), (4, "École DE PARIS")],
    "other blanks count": [(1, " line of text"), (2, "line of text"), (3, "\x1cline of text")],
    "repeated rows": [(7, "the very same line"), (7, "the very same line"), (8, "the very same line")],
    "same id, other texts": [(7, "the very same line"), (7, "the very same line\nz"), (9, "z\nthe very same line")],
    "empty table": [],
}


@pytest.mark.parametrize("name", CASES)
def test_cases(spark, documents, name):
    rows = CASES[name]
    assert result(line_dedup.dedup_lines(documents(rows))) == sorted(brute(rows), key=repr)


def test_random_against_brute_force(spark, documents):
    draw = random.Random(3)
    lines = [f"{'Common' if i % 3 else 'common'} line number {i % 40}" for i in range(60)] + ["short", "", " "]
    rows = [(i, "\n".join(draw.choices(lines, k=draw.randint(0, 12)))) for i in range(300)]
    rows += [(1000, "\n".join(f"one of many lines {i}" for i in range(20_000))), (2000, "one of many lines 7")]
    draw.shuffle(rows)
    got = result(line_dedup.dedup_lines(documents(rows), batches=5, fan_out=2))
    assert got == sorted(brute(rows), key=repr)


def test_levels_are_compacted(spark, documents):
    runs = line_dedup.LineRuns(spark, fan_out=2, buckets=2)
    for i in range(5):
        batch = documents([(i, f"a line of batch {i}\nthe line of every batch")])
        dropped = runs.add(line_dedup.hash_lines(batch)).collect()
        assert len(dropped) == (1 if i else 0)
    assert [len(level) for level in runs.levels] == [1, 0, 1]
    assert sum(run.count() for run in runs.runs()) == 6
    runs.close()


def test_runs_join_without_moving(spark, documents):
    runs = line_dedup.LineRuns(spark, buckets=4)
    runs.add(line_dedup.hash_lines(documents([(1, "the line of every batch")])))
    (run,) = runs.runs()
    plan = run.groupBy(*line_dedup.HASH).count()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan.replace("ReusedExchange", "")
    runs.close()


def test_other_columns_stay(spark, documents):
    docs = documents([(1, "the very same line"), (2, "the very same line")]).withColumns(
        {"n_lines": F.lit("x"), "pos": F.lit(9), "h1": F.lit(1), "owner": F.lit(2)}
    )
    got = line_dedup.dedup_lines(docs)
    assert set(got.columns) == {*docs.columns, "n_dropped"}
    assert [r["text"] for r in got.orderBy("doc_id").collect()] == ["the very same line", ""]


def test_query_digest(spark, tmp_path, documents):
    from textjury.llm.queries import QUERIES

    documents([(1, "a line to keep\nx"), (2, "x\na line to keep")]).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: r for r in QUERIES["op5_line_dedup"](spark, str(tmp_path)).collect()}
    assert got[1]["kept_sha256"] == hashlib.sha256(b"a line to keep\nx").hexdigest()
    assert (got[2]["n_lines"], got[2]["n_dropped"]) == (2, 1)
    assert got[2]["kept_sha256"] == hashlib.sha256(b"x").hexdigest()
