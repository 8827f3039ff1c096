import duckdb
import pytest
from pyspark.sql import functions as F

from textjury.llm import mixing
from textjury.llm.queries import QUERIES

ROWS = [
    (1, "a b c", "en", "x"),
    (2, "  a\tb\x0bc\nd ", "en", "x"),
    (3, None, "en", "x"),
    (4, "", "en", "y"),
    (5, "w " * 1000, "en", "y"),
    (6, "one", "en", None),
    (6, "one", "en", None),
    (None, "no id here", None, "z"),
    (8, "\x85 　x", "en", "Z"),
    (9, "e f", "en", "é"),
]


def test_equals_sql(spark, documents):
    docs = documents(ROWS)
    got = mixing.mix(docs).select("doc_id", "size", "source_size", "target", "taken").toArrow()
    con = duckdb.connect()
    con.register("documents", docs.toArrow())
    expected = con.sql(mixing.MIX_SQL).to_arrow_table()
    assert sorted(map(repr, got.to_pylist())) == sorted(map(repr, expected.to_pylist()))


def test_targets_share_the_excess(spark):
    totals = spark.createDataFrame([("a", 10), ("b", 100), ("c", 1000), (None, 0)], "source string, source_size long")
    got = {r["source"]: r["target"] for r in mixing.source_targets(totals).collect()}
    assert got["a"] == 20 and got["b"] == 200 and got[None] == 0
    assert got["c"] == pytest.approx(1.5 * 1110 - 220)
    assert all(got[s] <= 2 * n for s, n in (("a", 10), ("b", 100), ("c", 1000)))


def test_taken_adds_up_and_is_bounded(spark, documents):
    docs = documents([(i, "w " * (i % 17), "en", f"s{i % 5}" if i % 3 else "hot") for i in range(600)])
    mixed = mixing.mix(docs)
    assert mixed.where("taken > 2 * size or taken < 0").count() == 0
    sums = mixed.groupBy("source").agg(F.sum("taken").alias("taken"), F.first("target").alias("target")).collect()
    assert all(r["taken"] == int(r["target"]) for r in sums)


def test_positions_follow_the_schedule(spark, documents):
    docs = documents([(i, "w", "en", "abc"[i % 3]) for i in range(3000)])
    mixed = mixing.mix(docs, weights=(1, 1, 1), budget=0.75, slopes=(-0.9, 0.0, 0.9))
    early = {r["source"]: r["n"] for r in mixed.where("first_position < 0.5").groupBy("source").agg(F.sum("taken").alias("n")).collect()}
    assert early["a"] > early["b"] > early["c"]
    # The integral of 1 + slope * (2t - 1) up to 0.5 is 0.5 - slope / 4.
    assert early["a"] == pytest.approx(750 * 0.725, abs=3) and early["c"] == pytest.approx(750 * 0.275, abs=3)


def test_training_order_is_range_sorted(spark, documents):
    docs = documents([(i, "w x", "en", "abc"[i % 3]) for i in range(300)])
    ordered = mixing.training_order(mixing.mix(docs), partitions=3)
    by_part = {}
    for r in ordered.select(F.spark_partition_id().alias("p"), "first_position").collect():
        by_part.setdefault(r["p"], []).append(2.0 if r["first_position"] is None else r["first_position"])
    parts = [by_part[p] for p in sorted(by_part)]
    assert all(v == sorted(v) for v in parts)
    assert all(a[-1] <= b[0] for a, b in zip(parts, parts[1:])) and sum(map(len, parts)) == 300


def test_empty_and_extra_columns(spark, documents):
    assert mixing.mix(documents([]).limit(0)).count() == 0
    clashing = documents([(1, "a b"), (2, "c")]).withColumns({"size": F.lit("x"), "target": F.lit(1), "draw": F.lit(0)})
    assert mixing.mix(clashing).agg(F.sum("size")).first()[0] == 3


def test_native_plan(spark, documents):
    plan = mixing.mix(documents([(1, "a b")]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan


def test_query_follows_the_schedule(spark, documents, tmp_path):
    """The rows of op6 come in the order of the curriculum, which sets the slopes of the sources apart."""
    docs = documents([(i, "w x y", "en", "abc"[i % 3]) for i in range(300)])
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    query = QUERIES["op6_source_mixing"](spark, str(tmp_path))
    assert "rangepartitioning(first_position" in query._jdf.queryExecution().executedPlan().toString()
    place = {r["doc_id"]: r["first_position"] for r in mixing.mix(docs).collect()}
    got = [2.0 if place[r["doc_id"]] is None else place[r["doc_id"]] for r in query.collect()]
    assert got == sorted(got) and len(set(got)) > 200


def test_every_pass_has_its_positions(spark, documents):
    """Source a is capped at twice its size: its words over time follow its schedule on both passes."""
    docs = documents([(i, "w", "en", "abc"[i % 3]) for i in range(3000)])
    mixed = mixing.mix(docs, weights=(5, 2, 1), budget=1.5, slopes=(-0.9, 0.0, 0.9))
    stream = mixing.training_stream(mixed, partitions=3)
    assert mixed.where("source = 'a' and taken = 2 and size(reads) = 2").count() == 1000
    for t in (0.25, 0.5, 0.75):
        taken = {r["source"]: (r["n"], r["all"]) for r in stream.groupBy("source").agg(F.sum(F.when(F.col("position") < t, F.col("words"))).alias("n"), F.sum("words").alias("all")).collect()}
        for source, slope in zip("abc", (-0.9, 0.0, 0.9)):
            n, everything = taken[source]
            assert n == pytest.approx(everything * (t * (1 - slope) + slope * t * t), abs=3)
    rows = stream.select(F.spark_partition_id().alias("p"), "position").collect()
    assert [r["position"] for r in rows] == sorted(r["position"] for r in rows) and len({r["p"] for r in rows}) == 3
    assert stream.agg(F.sum("words")).first()[0] == mixed.agg(F.sum("taken")).first()[0] == len(rows)


@pytest.mark.parametrize("more", [0, 500])
def test_stream_equals_sql(spark, documents, more):
    docs = documents(ROWS + [(10 + i, "w " * (i % 17), "en", f"s{i % 5}" if i % 3 else "hot") for i in range(more)])
    con = duckdb.connect()
    con.register("documents", docs.toArrow())
    key = lambda r: (repr(r["doc_id"]), r["pass"], r["words"], r["position"])
    expected = sorted(con.sql(mixing.STREAM_SQL).to_arrow_table().to_pylist(), key=key)
    got = sorted(mixing.training_stream(mixing.mix(docs)).toArrow().to_pylist(), key=key)
    columns = ("doc_id", "source", "pass", "words")
    assert [[r[c] for c in columns] for r in got] == [[r[c] for c in columns] for r in expected]
    assert [r["position"] for r in got] == pytest.approx([r["position"] for r in expected], abs=1e-12)
    assert max(r["pass"] for r in got) == 1
