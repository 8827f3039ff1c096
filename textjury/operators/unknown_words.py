"""Words that no list has: a hidden Markov model over the places of characters in words.

A character begins a word (B), is inside it (M), ends it (E) or is one by itself (S).
Segmented text is counted in Spark; the model has at most four counts per character of
the script. The likeliest places cut a stretch that no listed word covers.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PLACES = "BMES"
#: Places that may come before each place, and at a stretch's ends.
BEFORE = {"B": "ES", "M": "BM", "E": "BM", "S": "ES"}
FIRST, LAST = "BS", "ES"
IMPOSSIBLE = -1e300
START, STEP, EMIT = "start", "step", "emit"
COUNTS = "kind STRING, place STRING, mark STRING, n BIGINT"


def place_counts(df: DataFrame, words: str = "words", script: str = r"\p{IsHan}") -> DataFrame:
    """(kind, place, mark, n) of segmented text: ``start`` of a run, ``step`` to the place ``mark``, ``emit`` of the character ``mark``.

    A run is a sequence of tokens in ``script`` (a character class) with no other token between.
    What is inside a word is counted once per distinct word, which leaves a map task as one row,
    and then spelled; what is between words is six numbers per message.
    """
    size = F.char_length
    inside = lambda w: w.rlike(rf"^[{script}]+$")
    rows = df.where(F.size(words) > 0).select(F.filter(F.col(words), lambda w: w != "").alias("tokens"))

    def item(kind: str, place: Column, mark: Column, n: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), place.alias("place"), mark.alias("mark"), n.cast("bigint").alias("n"))

    def place(at: Column) -> Column:
        return F.when(F.col("size") == 1, "S").when(at == 0, "B").when(at == F.col("size") - 1, "E").otherwise("M")

    word, at, n = F.col("word"), F.col("at"), F.col("n")
    distinct = rows.select(F.explode("tokens").alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    # A word of another script becomes null here and not in a filter, which would be moved before the counting.
    characters = F.split(F.when(inside(word), word), "")
    spelled = distinct.select("n", size("word").alias("size"), F.posexplode(characters).alias("at", "character"))
    shown, come = item(EMIT, place(at), F.col("character"), n), item(STEP, place(at - 1), place(at), n)
    within = spelled.select(F.inline(F.when(at == 0, F.array(shown)).otherwise(F.array(shown, come))))
    # Between words: S is a word of one character, W a longer one, which begins at B and ends at E; a blank is any other token.
    kinds = F.array_join(F.transform("tokens", lambda w: F.when(~inside(w), " ").when(size(w) == 1, "S").otherwise("W")), "")
    pairs = {f"{p}{q}": F.regexp_count("kinds", F.lit(f"{p}(?={q})")) for p in "SW" for q in "SW"}
    first = {q: F.regexp_count("kinds", F.lit(f"(?<![SW]){q}")) for q in "SW"}
    seams = rows.select(kinds.alias("kinds")).agg(*[F.sum(found).alias(name) for name, found in {**pairs, **first}.items()])
    after, before = {"S": "S", "W": "E"}, {"S": "S", "W": "B"}  # place that ends, and that begins, such a word
    between = [item(STEP, F.lit(after[name[0]]), F.lit(before[name[1]]), F.col(name)) for name in pairs]
    begun = [item(START, F.lit(before[q]), F.lit(""), F.col(q)) for q in first]
    joined = seams.select(F.inline(F.array(*between, *begun)))
    every = within.unionByName(joined.where("n > 0"))
    return every.groupBy("kind", "place", "mark").agg(F.sum("n").alias("n"))


def place_model(counts: DataFrame) -> dict:
    """Logarithms of start, step and emit probabilities, one added to every count.

    Plain values, so that a worker can use them without this package. The counts that come
    to the driver are bounded by the characters of the script.
    """
    rows = [(r["kind"], r["place"], r["mark"], r["n"]) for r in counts.collect()]
    of = {(kind, place, mark): n for kind, place, mark, n in rows}
    characters = sorted({mark for kind, _, mark, _ in rows if kind == EMIT})
    starts = {p: of.get((START, p, ""), 0) for p in FIRST}
    start = {p: math.log((n + 1) / (sum(starts.values()) + 2)) for p, n in starts.items()}
    step = {}
    for place in PLACES:
        after = {q: of.get((STEP, place, q), 0) for q in PLACES if place in BEFORE[q]}
        step |= {place + q: math.log((n + 1) / (sum(after.values()) + 2)) for q, n in after.items()}
    total = {p: sum(n for kind, place, _, n in rows if (kind, place) == (EMIT, p)) for p in PLACES}
    chance = lambda p, n: math.log((n + 1) / (total[p] + len(characters) + 1))
    emit = {c: [chance(p, of.get((EMIT, p, c), 0)) for p in PLACES] for c in characters}
    return {"start": start, "step": step, "emit": emit, "unseen": [chance(p, 0) for p in PLACES]}


def viterbi(model: dict) -> Callable[[str], list[str]]:
    """A function that cuts a stretch at its likeliest places; of equally likely ones, the first in ``BEFORE`` and ``LAST``."""
    start, step, emit, unseen = model["start"], model["step"], model["emit"], model["unseen"]

    def cut(stretch: str) -> list[str]:
        if not stretch:
            return []
        chances = [emit.get(c, unseen) for c in stretch]
        score = {p: start.get(p, IMPOSSIBLE) + chances[0][i] for i, p in enumerate(PLACES)}
        back = []
        for chance in chances[1:]:
            best = {p: max(BEFORE[p], key=lambda q: score[q] + step[q + p]) for p in PLACES}
            score = {p: score[best[p]] + step[best[p] + p] + chance[i] for i, p in enumerate(PLACES)}
            back.append(best)
        place = max(LAST, key=lambda p: score[p])
        places = [place]
        for best in reversed(back):
            place = best[place]
            places.append(place)
        words, begin = [], 0
        for end, place in enumerate(reversed(places), 1):
            if place in LAST:
                words.append(stretch[begin:end])
                begin = end
        return words

    return cut


def cut_stretches(tokens: list[str], cut: Callable[[str], list[str]]) -> list[str]:
    """``tokens`` of one run with every stretch of single characters cut again."""
    out, stretch = [], ""
    for token in [*tokens, ""]:
        if len(token) == 1:
            stretch += token
            continue
        out += cut(stretch) if len(stretch) > 1 else [stretch] * bool(stretch)
        out += [token] * bool(token)
        stretch = ""
    return out
