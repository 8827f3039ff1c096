import random
import re

import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from textjury.llm.personal_data import KINDS, digest, personal_data, personal_data_sql

#: The base kinds as they are given, without regard to speed.
GIVEN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def holds(kind, found):
    number = re.sub("[^0-9]", "", found)
    if kind == "ip":
        return all(int(part) <= 255 for part in found.split("."))
    if kind == "card":
        doubled = [sum(divmod(2 * int(d), 10)) if i % 2 else int(d) for i, d in enumerate(reversed(number))]
        return 14 <= len(number) <= 19 and sum(doubled) % 10 == 0
    return 10 <= len(number) <= 15 if kind == "phone" else True


def base_spans(text):
    found = [
        (m.start(), rank, kind, m.end())
        for rank, (kind, pattern) in enumerate(GIVEN.items())
        for m in re.finditer(pattern, text or "")
        if holds(kind, m[0])
    ]
    return [f"{kind}:{start}:{end}" for start, _, kind, end in sorted(found)]


def by_sql(rows):
    connection = duckdb.connect()
    connection.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    connection.executemany("INSERT INTO documents VALUES (?, ?)", [list(r) for r in rows])
    return sorted(map(repr, connection.sql(personal_data_sql()).fetchall()))


def spans_of(spark, texts):
    rows = personal_data(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    return [[f"{s['kind']}:{s['start']}:{s['end']}" for s in r["spans"]] for r in sorted(rows)]


TEXTS = [
    None, "", "a@b.c_d@e.f", "x..y+z@a-b.c.d. end", "no@dot and a@b..c", "É a@b.co, \U0001f600 me@x.org",
    "1.2.3.4.5 256.1.1.1 001.02.3.255 1.2.3", "4111 1111 1111 1111 and 4111111111111112", "card 4012-8888-8888-1881x79927398713",
    "4111  1111 1111 1111", "call +1 (171) 555-2028, or +49 30 (((( none", "+1-2 +12345678901234567 +1 (017) 555-7713 ",
    "IBAN DE89 3704 0044 0532 0130 00 AND GB82WEST12345698765432 DE88370400440532013000", "XDE89370400440532013000",
    "ssn 123-45-6789", "order 123-45-6789", "123-45-6789", "tel (555) 123-4567 is mine", "555 123 4567", "my phone: 555.123.4567-8",
    "ssn 123-45-6789123-45-6789", "1" * 20_000, "a" * 5_000 + "@", ("a@b" + ".c" * 50_000), "+1" + "(" * 50_000, "4111111111111111 " * 3_000,
]


def test_equals_given_patterns_and_sql(spark):
    rows = list(enumerate(TEXTS))
    got = spans_of(spark, TEXTS)
    for text, spans in zip(TEXTS, got):
        assert [s for s in spans if s.split(":")[0] in GIVEN] == base_spans(text), (text or "")[:60]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(repr(tuple(r)) for r in digest(personal_data(frame)).collect()) == by_sql(rows)


def test_added_kinds_need_checksum_or_context(spark):
    got = spans_of(spark, TEXTS)
    kinds = lambda at: [s.split(":")[0] for s in got[at]]
    assert kinds(12).count("iban") == 2 and "iban" not in kinds(13)
    assert (kinds(14), kinds(15), kinds(16)) == (["ssn"], [], [])
    assert (kinds(17), kinds(18), kinds(19)) == (["local_phone"], [], [])


def test_scores(spark):
    text = "my card is 4111 1111 1111 1111. " + "filler " * 20 + "order 4111-1111-1111-1111 " + "filler " * 20 + "4111111111111111"
    (row,) = personal_data(spark.createDataFrame([(1, text)], "doc_id long, text string")).collect()
    assert [(s["kind"], s["score"]) for s in row["spans"]] == [("card", 1.0), ("card", 0.5), ("card", 0.8)]


def test_random_texts(spark):
    rng = random.Random(5)
    pieces = ["a@b.c", "1.2.3.4", "+1 (222) 333-4444", "4111 1111 1111 1111", "-", " ", ".", "@", "+", "é", "7", "x", "(", "order ", "tel ", "555 123 4567"]
    texts = ["".join(rng.choices(pieces, k=rng.randint(0, 40))) for _ in range(500)]
    for text, spans in zip(texts, spans_of(spark, texts)):
        assert [s for s in spans if s.split(":")[0] in GIVEN] == base_spans(text), text
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert sorted(repr(tuple(r)) for r in digest(personal_data(frame)).collect()) == by_sql(list(enumerate(texts)))


def test_null_ids_repeated_rows_clashing_columns_and_empty_table(spark):
    schema = "doc_id long, text string, spans string, found int, m int"
    rows = [(None, "a@b.c", "s", 1, 2), (1, "a@b.c", "s", 1, 2), (1, "a@b.c", "s", 1, 2)]
    got = digest(personal_data(spark.createDataFrame(rows, schema))).collect()
    assert sorted((r["doc_id"] or 0, r["n_email"], r["spans"]) for r in got) == [(0, 1, "email:0:5"), (1, 1, "email:0:5"), (1, 1, "email:0:5")]
    assert personal_data(spark.createDataFrame([], schema)).collect() == []


@pytest.mark.parametrize("kind", [k for k in KINDS if k.name in GIVEN], ids=lambda k: k.name)
def test_fixed_patterns_match_as_given(kind):
    @settings(max_examples=300)
    @given(st.text("aZ9 .@+-()_%1é", max_size=30))
    def same(text):
        spans = lambda pattern: [m.span() for m in re.finditer(pattern, text)]
        assert spans(kind.pattern) == spans(GIVEN[kind.name])

    same()


def test_no_python_workers(spark):
    plan = personal_data(spark.range(1).selectExpr("id AS doc_id", "'x' AS text"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan
