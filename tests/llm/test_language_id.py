import random
import zlib

import pytest
from pyspark.sql import functions as F

from textjury.llm import language_id

SOUNDS = {
    "xa": ("a e i".split(), "l m n r".split()),
    "xb": ("a e o".split(), "l m n r".split()),
    "ya": ("ö ü y".split(), "k t p sch".split()),
    "yb": ("ö ü ä".split(), "k t p z".split()),
}


def text(draw, lang, n):
    vowels, consonants = SOUNDS[lang]
    word = lambda: "".join(draw.choice(consonants) + draw.choice(vowels) for _ in range(draw.randint(1, 4)))
    return " ".join(word() for _ in range(n))


@pytest.fixture(scope="module")
def corpus():
    draw = random.Random(6)
    return [(i, text(draw, lang, draw.randint(20, 80)), lang, "hot") for i, lang in enumerate(draw.choices(list(SOUNDS), k=600))]


@pytest.fixture(scope="module")
def model(spark, corpus):
    rows = [(*r, 0) for r in corpus]
    return language_id.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long"))


def test_families(model):
    assert sorted(model.grouped) == [["xa", "xb"], ["ya", "yb"]]
    assert sorted(model.pairs) == [("#0", "#1"), ("xa", "xb"), ("ya", "yb")]


def test_held_out_accuracy(documents, corpus, model):
    got = {r["doc_id"]: r for r in language_id.predict(documents(corpus), model).collect()}
    held = [(lang, got[i]["lang_pred"]) for i, _, lang, _ in corpus if zlib.crc32(str(i).encode()) % 5 == 0]
    assert len(held) > 50 and sum(a == b for a, b in held) >= 0.97 * len(held)
    assert all(0 <= r["score"] <= 1 for r in got.values())


def test_odd_texts(documents, model):
    draw = random.Random(8)
    rows = [(1, None), (2, ""), (3, "12 -- 34 ! ½ ²"), (None, text(draw, "ya", 30)), (5, text(draw, "xb", 30_000)), (6, "x"), (6, "x")]
    docs = documents(rows).withColumns({"lang_pred": F.lit("no"), "score": F.lit(9)})
    got = [(r["doc_id"], r["lang_pred"], r["score"]) for r in language_id.predict(docs, model).collect()]
    assert [(i, p, s) for i, p, s in got if i in (1, 2, 3)] == [(1, "und", 0.0), (2, "und", 0.0), (3, "und", 0.0)]
    by_id = {i: p for i, p, _ in got}
    assert by_id[None] == "ya" and by_id[5] == "xb" and by_id[6] in SOUNDS and len(got) == 7


def test_language_is_not_an_input(documents, corpus, model):
    wrong = [(i, t, "xa", "other") for i, t, _, _ in corpus]
    one, other = (sorted(map(tuple, language_id.predict(documents(x), model).collect())) for x in (corpus, wrong))
    assert one == other


def test_few_languages(documents):
    docs = documents([(i, "aba cada", None if i % 2 else "one") for i in range(20)])
    got = language_id.predict(docs, language_id.fit(docs)).collect()
    assert {r["lang_pred"] for r in got} == {"one"} and all(r["score"] == pytest.approx(1.0, abs=1e-6) for r in got)
    none = docs.withColumn("lang", F.lit(None).cast("string"))
    assert {(r["lang_pred"], r["score"]) for r in language_id.predict(none, language_id.fit(none)).collect()} == {("und", 0.0)}
    assert language_id.predict(docs.limit(0), language_id.fit(docs.limit(0))).count() == 0
