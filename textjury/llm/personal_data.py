"""Personal data in texts: patterns propose spans, checksums confirm them, nearby words adjust the score.

Only built-in functions are used, inside the row. A pattern's matches and the pieces of text
between them give the places of the matches, in code points, and the words around them.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textjury.functions.arrays import bind
from textjury.llm.common import LOWER, UPPER, lower_ascii

NEAR = 40  # code points on each side of a span in which words count, up to the next span of its kind
THRESHOLD = 50  # least score of a span of an added kind, in hundredths
CHECKED, NAMED, DENIED = 40, 30, -30  # what a checksum, a fitting word and a contrary word add
CONTRARY = "order|invoice|version|isbn|serial|part number|tracking"
#: Values from 0 to 255, leading zeros allowed.
BYTE = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
BLOCK = 256  # lengths added up at a time


@dataclass(frozen=True)
class Kind:
    """One kind of personal data.

    ``pattern`` proposes spans; ``fast`` has the same matches without trying every character of
    a long run anew. ``may`` holds for every text with a confirmed span. A span of a kind with
    ``apart`` has none of these characters right beside it. Base kinds keep every confirmed
    span, added ones those with a score of THRESHOLD.
    """

    name: str
    pattern: str
    may: str
    score: int
    words: str
    fast: str = ""
    apart: str = ""
    base: bool = False


_CALL = "phone|call|tel|mobile|fax|whatsapp|dial"
#: Fixed patterns of the base kinds, in the order in which spans with equal starts are listed; then the added kinds.
KINDS = [
    Kind("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", "@", 80, "mail|contact|write to", base=True,
         fast=r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"),
    Kind("ip", r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+", r"[0-9]\.[0-9]", 50, "address|server|host|login|logged|ip", base=True,
         fast=r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"),
    Kind("card", r"[0-9](?:[ -]?[0-9])+", "[0-9](?:[ -]?[0-9]){13}", 40, "card|visa|mastercard|amex|credit|payment|paid", base=True,
         fast=r"[0-9](?:[ -]?+[0-9])++"),
    Kind("phone", r"\+[0-9][ ().0-9-]+[0-9]", r"\+[0-9]", 60, _CALL, base=True),
    Kind("iban", r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?", "[A-Z]{2}[0-9]{2} ?[A-Z0-9]{4}", 30,
         "iban|account|bank|transfer|konto|compte|cuenta", apart="A-Za-z0-9"),
    Kind("ssn", r"[0-9]{3}-[0-9]{2}-[0-9]{4}", "[0-9]-[0-9]{2}-[0-9]", 30, "ssn|social security|tax", apart="0-9-"),
    Kind("local_phone", r"\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}", "[0-9]{3}[ .-][0-9]{4}", 30, _CALL, apart="0-9+(-"),
]
BASE = [kind.name for kind in KINDS if kind.base]
SPAN = "array<struct<start:bigint,rank:int,end:bigint,kind:string,score:double>>"


def digits(found: Column) -> Column:
    return F.regexp_replace(found, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether a string of digits passes Luhn's checksum."""

    def value(digit: Column, place: Column) -> Column:
        doubled = 2 * digit - F.when(digit > 4, 9).otherwise(0)
        return F.when(place % 2 == 0, digit).otherwise(doubled)

    values = F.transform(F.split(F.reverse(number), ""), lambda c, i: value(F.ascii(c) - 48, i))
    return F.aggregate(values, F.lit(0), lambda total, v: total + v) % 10 == 0


def mod_97(account: Column) -> Column:
    """Whether an account number leaves 1 modulo 97: first four characters last, A as 10 to Z as 35."""
    moved = F.concat(F.substr(account, F.lit(5)), F.substring(account, 1, 4))
    letter = lambda c: F.ascii(c) > 64
    value = lambda c: F.ascii(c) - F.when(letter(c), 55).otherwise(48)
    step = lambda rest, c: (rest * F.when(letter(c), 100).otherwise(10) + value(c)) % 97
    return F.aggregate(F.split(moved, ""), F.lit(0), step) == 1


def confirmed(kind: str, found: Column) -> Column:
    """Whether a proposed span holds: number of digits, ranges and checksums."""
    if kind == "ip":
        return found.rlike(rf"^{BYTE}(?:\.{BYTE}){{3}}$")
    if kind == "card":
        return bind(digits(found), lambda d: F.when(F.char_length(d).between(14, 19), luhn(d)).otherwise(False))
    if kind == "phone":
        return F.char_length(digits(found)).between(10, 15)
    if kind == "iban":
        return bind(F.replace(found, F.lit(" "), F.lit("")), lambda a: F.when(F.char_length(a).between(15, 34), mod_97(a)).otherwise(False))
    if kind == "ssn":
        return ~found.rlike("^(?:000|666|9)|-00-|-0000$")
    return F.lit(True)


def running_sums(values: Column) -> Column:
    """Sums of the first 1, 2, ... values. Blocks are summed on their own, so long arrays take little more than linear time."""

    def sums(part: Column) -> Column:
        add = lambda done, v: F.concat(done, F.array(F.coalesce(F.get(done, F.size(done) - 1), F.lit(0).cast("long")) + v))
        return F.aggregate(part, F.array().cast("array<bigint>"), add)

    starts = F.sequence(F.lit(1), F.greatest(F.size(values), F.lit(1)), F.lit(BLOCK))
    inside = F.transform(starts, lambda at: sums(F.slice(values, at, BLOCK)))

    def joined(parts: Column) -> Column:
        ends = sums(F.transform(parts, lambda p: F.coalesce(F.get(p, F.size(p) - 1), F.lit(0).cast("long"))))
        return bind(ends, lambda e: F.flatten(F.transform(parts, lambda p, i: F.transform(
            p, lambda v: v + F.when(i > 0, F.get(e, i - 1)).otherwise(F.lit(0).cast("long"))))))

    return bind(inside, joined)


def _beside(kind: Kind, before: Column, after: Column, first: Column, last: Column) -> Column:
    """Whether a span stands apart from what is right before and after it."""
    if not kind.apart:
        return F.lit(True)
    free = lambda piece, pattern, edge: F.when(piece == "", edge).otherwise(piece.rlike(pattern))
    return free(before, rf"[^{kind.apart}]\z", first) & free(after, rf"\A[^{kind.apart}]", last)


def _score(kind: Kind, before: Column, after: Column) -> Column:
    near = lower_ascii(F.concat_ws(" ", F.right(before, F.lit(NEAR)), F.left(after, F.lit(NEAR))))
    says = lambda words: near.rlike(rf"(?:\A|[^a-z])(?:{words})")
    total = (
        F.lit(kind.score + (CHECKED if kind.name in ("card", "iban") else 0))
        + F.when(says(kind.words), NAMED).otherwise(0)
        + F.when(says(CONTRARY), DENIED).otherwise(0)
    )
    return F.least(F.greatest(total, F.lit(0)), F.lit(100))


def proposed(text: Column, kind: Kind, rank: int) -> Column:
    """Spans of one kind, leftmost first."""
    pattern = kind.fast or kind.pattern

    def spans(found: Column, pieces: Column) -> Column:
        lengths = F.transform(found, lambda m, i: (F.char_length(m) + F.char_length(F.get(pieces, i))).cast("long"))
        placed = F.zip_with(found, running_sums(lengths), lambda m, end: F.struct(m.alias("m"), end.alias("end")))
        around = F.transform(
            placed,
            lambda s, i: F.struct(
                s["m"].alias("m"), s["end"].alias("end"), F.get(pieces, i).alias("before"), F.get(pieces, i + 1).alias("after"),
                (i == 0).alias("first"), (i == F.size(found) - 1).alias("last"),
            ),
        )
        kept = F.filter(around, lambda s: confirmed(kind.name, s["m"]) & _beside(kind, s["before"], s["after"], s["first"], s["last"]))
        scored = F.transform(
            kept,
            lambda s: F.struct(
                (s["end"] - F.char_length(s["m"])).alias("start"), F.lit(rank).alias("rank"), s["end"].alias("end"),
                F.lit(kind.name).alias("kind"), (_score(kind, s["before"], s["after"]) / 100).alias("score"),
            ),
        )
        return scored if kind.base else F.filter(scored, lambda s: s["score"] >= THRESHOLD / 100)

    none = F.array().cast(SPAN)
    every = bind(
        F.struct(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("found"), F.split(text, pattern, -1).alias("pieces")),
        lambda cut: F.when(F.size(cut["found"]) > 0, spans(cut["found"], cut["pieces"])).otherwise(none),
    )
    return F.when(text.rlike(kind.may), every).otherwise(none)


def listed(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    one = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(spans, one), ",")


def personal_data(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, spans), one row per input row.

    ``spans`` is an array<struct<start, rank, end, kind, score>> by start, then by the order of
    ``KINDS``; places in code points, end exclusive, scores from 0 to 1. Spans of different
    kinds may overlap. Base kinds stay whatever their score. Null and empty texts have no spans;
    null ids and repeated rows are kept, an empty table gives no rows, other columns are ignored.
    """
    whole = F.coalesce(F.col(text).cast("string"), F.lit(""))
    found = F.flatten(F.array(*[proposed(whole, kind, rank) for rank, kind in enumerate(KINDS)]))
    return docs.select(F.col(key).cast("long").alias("doc_id"), F.sort_array(found).alias("spans"))


def digest(found: DataFrame) -> DataFrame:
    """Counts of the base kinds, the hash of their spans, and all spans as text."""
    base = F.filter("spans", lambda s: s["kind"].isin(BASE))
    count: Callable[[str], Column] = lambda name: F.size(F.filter("spans", lambda s: s["kind"] == name)).cast("long")
    return found.select(
        "doc_id",
        *[count(name).alias(f"n_{name}") for name in BASE],
        F.sha2(listed(base).cast("binary"), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
    )


def personal_data_sql() -> str:
    """The same digest in DuckDB's SQL."""
    quoted = lambda value: "'" + value.replace("'", "''") + "'"
    number = "regexp_replace(m, '[^0-9]', '', 'g')"
    account = "replace(m, ' ', '')"
    luhn_sum = (
        f"list_sum(list_transform(string_split(reverse({number}), ''), lambda c, i: CASE WHEN i % 2 = 1 THEN c::INT "
        "ELSE 2 * c::INT - (CASE WHEN c::INT > 4 THEN 9 ELSE 0 END) END)) % 10 = 0"
    )
    rest = (
        f"list_reduce(string_split(substr({account}, 5) || substr({account}, 1, 4), '')"
        ".list_transform(lambda c: CASE WHEN ascii(c) > 64 THEN ascii(c) - 55 ELSE ascii(c) - 48 END), "
        "lambda r, v: (r * (CASE WHEN v > 9 THEN 100 ELSE 10 END) + v) % 97, 0) = 1"
    )
    holds = {
        "ip": f"regexp_matches(m, '^{BYTE}(?:\\.{BYTE}){{3}}$')",
        "card": f"length({number}) BETWEEN 14 AND 19 AND {luhn_sum}",
        "phone": f"length({number}) BETWEEN 10 AND 15",
        "iban": f"length({account}) BETWEEN 15 AND 34 AND {rest}",
        "ssn": "NOT regexp_matches(m, '^(?:000|666|9)|-00-|-0000$')",
    }
    says = lambda words: f"CASE WHEN regexp_matches(near, '(?:\\A|[^a-z])(?:{words})') THEN"
    parts = []
    for rank, kind in enumerate(KINDS):
        apart = "true"
        if kind.apart:
            apart = (
                f"(CASE WHEN before = '' THEN i = 1 ELSE regexp_matches(before, '[^{kind.apart}]\\z') END) AND "
                f"(CASE WHEN after = '' THEN i = n ELSE regexp_matches(after, '\\A[^{kind.apart}]') END)"
            )
        score = (
            f"greatest(0, least(100, {kind.score + (CHECKED if kind.name in ('card', 'iban') else 0)} + "
            f"{says(kind.words)} {NAMED} ELSE 0 END + {says(CONTRARY)} {DENIED} ELSE 0 END))"
        )
        parts.append(f"""
SELECT r, {rank} AS rank, '{kind.name}' AS kind, e - length(m) AS s, e FROM (
    SELECT *, sum(length(before) + length(m)) OVER (PARTITION BY r ORDER BY i) AS e,
           translate(right(before, {NEAR}) || ' ' || left(after, {NEAR}), '{UPPER}', '{LOWER}') AS near
    FROM (SELECT r, len(found) AS n, unnest(range(1, len(found) + 1)) AS i, unnest(found) AS m,
                 unnest(list_slice(pieces, 1, len(found))) AS before, unnest(list_slice(pieces, 2, len(found) + 1)) AS after
          FROM (SELECT r, regexp_extract_all(t, {quoted(kind.pattern)}) AS found,
                       string_split_regex(t, {quoted(kind.pattern)}) AS pieces FROM docs)))
WHERE ({holds.get(kind.name, 'true')}) AND {apart}{'' if kind.base else f' AND {score} >= {THRESHOLD}'}""")
    every = "\nUNION ALL".join(parts)
    joined = "string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, rank)"
    base = "kind IN (" + ", ".join(map(quoted, BASE)) + ")"
    counts = ", ".join(f"count(kind) FILTER (kind = '{name}') AS n_{name}" for name in BASE)
    return f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
spans AS ({every})
SELECT doc_id, {counts}, sha256(coalesce({joined} FILTER ({base}), '')) AS base_sha256, coalesce({joined} FILTER (kind IS NOT NULL), '') AS spans
FROM docs LEFT JOIN spans USING (r) GROUP BY r, doc_id
"""
