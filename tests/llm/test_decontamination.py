import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from textjury.llm import decontamination as d


def words(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def brute(docs, items, window=10):
    windows = {}
    for item, text in items:
        found = words(text)
        size = min(window, len(found))
        for at in range(len(found) - size + 1) if found and item is not None else ():
            windows.setdefault(tuple(found[at : at + size]), set()).add(str(item))
    out = []
    for doc, text in docs:
        found, hit, shown = words(text), set(), set()
        for size in {len(w) for w in windows}:
            for at in range(len(found) - size + 1):
                if tuple(found[at : at + size]) in windows:
                    hit |= set(range(at, at + size))
                    shown |= windows[tuple(found[at : at + size])]
        out.append((doc, len(found), len(hit), sorted(shown)))
    return sorted(out, key=repr)


def result(df):
    return sorted(((r["doc_id"], r["n_words"], r["n_hit"], r["item_ids"]) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def items_table(spark):
    return lambda rows: spark.createDataFrame(rows, "item_id long, text string")


def test_words():
    text = "Ab1-É_é\x00z\x7f99 　x"
    assert [w.decode() for w in d.words(text.encode())] == words(text)


def corpus():
    draw = random.Random(2)
    vocabulary = ["the", "of", "and", "it", *[f"w{i}" for i in range(30)]]
    some = lambda n: " ".join(draw.choices(vocabulary, k=n))
    items = [(i, some(draw.randint(1, 25) if i % 4 else 30)) for i in range(25)]
    items += [(100, items[0][1].upper()), (101, ""), (102, None), (None, "w1 w2"), (103, "--"), (10, "the"), (104, items[4][1])]
    docs = []
    for i in range(200):
        parts = [some(draw.randint(0, 60))]
        if i % 3 == 0:
            parts += [draw.choice(items[:25])[1].replace(" ", ", "), some(5)]
        docs.append((i, " ".join(parts)))
    docs += [(None, items[4][1]), (3, items[4][1]), (3, items[4][1]), (900, None), (901, ""), (902, items[8][1] * 300)]
    return docs, items


@pytest.mark.parametrize("block_bytes", [10**6, 300])
def test_against_brute_force(spark, documents, items_table, block_bytes):
    docs, items = corpus()
    got = d.contamination(documents(docs), items_table(items), block_bytes=block_bytes)
    assert result(got) == brute(docs, items)


def test_long_items_only(spark, documents, items_table):
    docs, items = corpus()
    items = [(i, t) for i, t in items if t and len(words(t)) >= 10]
    assert result(d.contamination(documents(docs), items_table(items))) == brute(docs, items)


def test_rows_of_the_index_are_bounded(spark, documents, items_table, monkeypatch):
    docs, items = corpus()
    monkeypatch.setattr(d, "DOCUMENTS_PER_ROW", 7)
    monkeypatch.setattr(d, "WORDS_PER_ROW", 200)
    assert result(d.contamination(documents(docs), items_table(items))) == brute(docs, items)


def test_proximity(spark, documents, items_table):
    item = "one two three four five six seven eight nine ten"
    docs = [(1, item), (2, item.replace("five", "five extra")), (3, item.replace("three four", "four three")), (4, "one ten")]
    near = {r["doc_id"]: r["n_hit"] > 0 for r in d.contamination(documents(docs), items_table([(7, item)]), slop=1).collect()}
    assert near == {1: True, 2: True, 3: True, 4: False}
    exact = {r["doc_id"]: r["n_hit"] for r in d.contamination(documents(docs), items_table([(7, item)])).collect()}
    assert exact == {1: 10, 2: 0, 3: 0, 4: 0}


def test_spans(spark, documents, items_table):
    got = d.contamination(documents([(1, "x a b y a b a b")]), items_table([(7, "a b")])).first()
    assert [tuple(s) for s in got["spans"]] == [(1, 2), (4, 7)] and got["n_hit"] == 6


def test_empty_tables(spark, documents, items_table):
    docs = documents([(1, "a b c")])
    assert result(d.contamination(docs, items_table([]))) == [(1, 3, 0, [])]
    assert d.contamination(docs.limit(0), items_table([(1, "a")])).count() == 0


def test_filter_keeps_clean_rows_and_columns(spark, documents, items_table):
    docs = documents([(1, "a b c"), (None, "a b"), (None, "clean"), (4, None)]).withColumn("n_hit", F.lit(1))
    kept = d.without_contaminated(docs, items_table([(7, "a b")]))
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"], r["text"]) for r in kept.where("doc_id is not null").collect()) == [(4, None)]
    assert [r["text"] for r in kept.where("doc_id is null").collect()] == ["clean"]


def test_query(spark, tmp_path, documents, items_table):
    from textjury.llm.queries import QUERIES

    docs, items = corpus()
    documents(docs).write.parquet(f"{tmp_path}/documents.parquet")
    items_table(items).write.parquet(f"{tmp_path}/benchmark.parquet")
    got = QUERIES["op7_decontamination"](spark, str(tmp_path)).collect()
    digest = lambda ids: hashlib.sha256(",".join(ids).encode()).hexdigest()
    expected = [(i, n, h, len(x), digest(x), h > 0) for i, n, h, x in brute(docs, items)]
    assert sorted(map(tuple, got), key=repr) == sorted(expected, key=repr)


def test_many_equal_items_and_a_hot_passage(spark, documents, items_table):
    """10,000 equal items are one class; many items that share a passage are noted once per document."""
    passage = "one two three four five six seven eight nine ten"
    items = [(i, passage) for i in range(10_000)] + [(20_000 + i, f"w{i} {passage} x{i}") for i in range(50)]
    docs = [(i, f"start {passage} " * 3) for i in range(300)] + [(1000, "nothing of it"), (1001, passage), (1001, passage)]
    found = d.contamination(documents(docs), items_table(items))
    rows = {r["doc_id"]: (r["n_hit"], r["n_items"], r["least"]) for r in found.select(
        "doc_id", "n_hit", F.size("item_ids").alias("n_items"), F.get("item_ids", 0).alias("least")).collect()}
    assert rows[0] == (30, 10_050, "0") and rows[299] == rows[0] and rows[1000] == (0, 0, None) and rows[1001] == (10, 10_050, "0")
    assert found.count() == 303
    classes, ids, blocks = d.test_classes(items_table(items), "item_id", "text", 1_000)
    assert (classes.count(), ids.count(), blocks > 1) == (51, 10_050, True)


def test_a_class_is_noted_once_per_document(spark, documents, items_table):
    text = "a b c d e f g h i j " * 400
    classes, _, _ = d.test_classes(items_table([(1, "a b c d e f g h i j " * 4)]), "item_id", "text", 10**6)
    tests = d.Tests([(r["class"], bytes(r["words"])) for r in classes.collect()])
    empty = {n: F.array().cast(f"array<{t}>") for n, t in zip(d.HITS, ("long", "int", "int", "long"))}
    indexed = d.index(documents([(1, text), (2, text)]).coalesce(1), tests, True).withColumns(empty)
    (row,) = d.match(indexed, tests)[0].collect()
    assert len(row["classes"]) == 2 < len(row["hit_starts"])
