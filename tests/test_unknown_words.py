import itertools
import math
import random
from collections import Counter

import pytest

from textjury import build_split, dictionary_tokenizer, tokenize
from textjury.operators.segmenting import segment
from textjury.operators.unknown_words import BEFORE, FIRST, LAST, PLACES, cut_stretches, place_counts, place_model, viterbi
from textjury.operators.word_discovery import CLOSE, OPEN, discover_words, gram_counts
from textjury.plans.split import with_words

WORDS = [["今天", "天气", "很", "好", "。", "出去玩", "吧"], ["今", "天气预报", "x1", "好"], [], None, ["", "你好"]]


def expected_counts(rows, inside):
    found = Counter()
    for words in rows:
        before = None
        for word in words or []:
            if not word:
                continue
            if not inside(word):
                before = None
                continue
            places = "S" if len(word) == 1 else "B" + "M" * (len(word) - 2) + "E"
            for place, character in zip(places, word):
                found["emit", place, character] += 1
                found[("start", place, "") if before is None else ("step", before, place)] += 1
                before = place
    return found


def counted(spark, rows, **settings):
    df = spark.createDataFrame([(words,) for words in rows], "words array<string>")
    return place_counts(df, **settings)


def test_counts_by_hand(spark):
    got = {(r["kind"], r["place"], r["mark"]): r["n"] for r in counted(spark, WORDS).collect()}
    assert got == expected_counts(WORDS, lambda w: all("一" <= c <= "鿿" for c in w))
    assert got["start", "B", ""] == 3 and ("step", "S", "B") in got


def model_of(rows):
    class Rows:
        def __init__(self, found):
            self.found = found

        def collect(self):
            return [dict(zip(("kind", "place", "mark", "n"), (*key, n))) for key, n in self.found.items()]

    return place_model(Rows(expected_counts(rows, str.isalpha)))


def score(model, stretch, places):
    emit = [model["emit"].get(c, model["unseen"])[PLACES.index(p)] for c, p in zip(stretch, places)]
    return model["start"][places[0]] + sum(emit) + sum(model["step"][a + b] for a, b in zip(places, places[1:]))


@pytest.mark.parametrize("seed", range(6))
def test_viterbi_is_the_best_of_all_paths(seed):
    rng = random.Random(seed)
    model = model_of([["".join(rng.choices("abcd", k=rng.randint(1, 4))) for _ in range(30)]])
    cut = viterbi(model)
    for _ in range(40):
        stretch = "".join(rng.choices("abcdz", k=rng.randint(1, 6)))
        legal = [
            p
            for p in itertools.product(PLACES, repeat=len(stretch))
            if p[0] in FIRST and p[-1] in LAST and all(a in BEFORE[b] for a, b in zip(p, p[1:]))
        ]
        words = cut(stretch)
        assert "".join(words) == stretch
        chosen = "".join("S" if len(w) == 1 else "B" + "M" * (len(w) - 2) + "E" for w in words)
        assert math.isclose(score(model, stretch, chosen), max(score(model, stretch, p) for p in legal))


def test_probabilities_add_up():
    model = model_of([["ab", "c", "abc"]])
    assert math.isclose(sum(math.exp(v) for v in model["start"].values()), 1)
    for place in PLACES:
        assert math.isclose(sum(math.exp(v) for pair, v in model["step"].items() if pair[0] == place), 1)
        seen = sum(math.exp(v[PLACES.index(place)]) for v in model["emit"].values())
        assert math.isclose(seen + math.exp(model["unseen"][PLACES.index(place)]), 1)


def test_only_uncovered_stretches_are_cut_again():
    halves = lambda s: [s[: len(s) // 2], s[len(s) // 2 :]]
    assert cut_stretches(["ab", "c", "d", "e", "f", "gh", "i"], halves) == ["ab", "cd", "ef", "gh", "i"]
    assert cut_stretches([], halves) == [] and cut_stretches(["a"], halves) == ["a"]
    assert viterbi(model_of([]))("") == []


@pytest.mark.parametrize("method", ["longest", "frequency"])
def test_both_ways_of_segmenting_agree(spark, method):
    rows = [["今天", "天气", "好"], ["明天", "出去玩"], ["天气", "预报"]]
    places = place_model(counted(spark, rows))
    known = spark.createDataFrame([("天气", 3), ("今天", 1)], "token string, term_count long")
    texts = spark.createDataFrame([(1, "今天明日天气预告好"), (2, None), (3, "x 你们出去吧"), (4, "x 你们出去吧")], "id int, text string")
    ways = [
        sorted((r["id"], r["words"]) for r in segment(texts, known, method=method, places=places, **extra).collect())
        for extra in ({}, {"broadcast_words": 0})
    ]
    assert ways[0] == ways[1]
    for (_, words), text in zip(ways[0], ["今天明日天气预告好", "", "x 你们出去吧", "x 你们出去吧"]):
        assert "".join(words) == text
    assert "天气" in ways[0][0][1] and any(len(w) > 1 for w in ways[0][2][1] if w not in ("今天", "天气"))


def test_place_counts_travel_with_the_split(spark, folder):
    segmented = spark.createDataFrame([(["出去", "玩", "你们"],)], "words array<string>")
    known = spark.createDataFrame([("天气", 1)], "token string, term_count long")
    tokenizer = dictionary_tokenizer(known, f"{folder}/words", places=place_counts(segmented))
    labelled = spark.createDataFrame([(str(i), float(i % 2), "出去天气") for i in range(20)], "doc_id string, label double, text string")
    split = build_split(labelled, folder, 2, tokenizer=tokenizer)
    assert {tuple(r["words"]) for r in split.rows(spark).collect()} == {("出去", "天气")}
    place_counts(spark.createDataFrame([(["变"],)], "words array<string>")).write.mode("overwrite").parquet(tokenizer["places"])
    with pytest.raises(RuntimeError, match="place counts"):
        with_words(labelled, tokenizer)


def brute_words(texts, max_length, min_count, min_cohesion, min_entropy):
    grams, neighbours = Counter(), {}
    for text in texts:
        for run in "".join(c if "a" <= c <= "z" else " " for c in text or "").split():
            for n in range(1, max_length + 1):
                for at in range(len(run) - n + 1):
                    gram = run[at : at + n]
                    grams[gram] += 1
                    for side, beside in (("l", run[at - 1] if at else "^"), ("r", run[at + n] if at + n < len(run) else "$")):
                        neighbours.setdefault((gram, side), Counter())[beside] += 1
    totals = Counter()
    for gram, n in grams.items():
        totals[len(gram)] += n
    share = lambda g: math.log(grams[g] / totals[len(g)])

    def entropy(counts):
        total = sum(counts.values())
        return -sum(n / total * math.log(n / total) for n in counts.values())

    found = {}
    for gram, n in grams.items():
        if len(gram) > 1 and n >= min_count:
            cohesion = min(share(gram) - share(gram[:i]) - share(gram[i:]) for i in range(1, len(gram)))
            sides = entropy(neighbours[gram, "l"]), entropy(neighbours[gram, "r"])
            if cohesion >= min_cohesion and min(sides) >= min_entropy:
                found[gram] = (n, round(cohesion, 6), *(round(s, 6) for s in sides))
    return found


def test_discovery_equals_brute_force(spark):
    rng = random.Random(3)
    words = ["wort", "stadt", "aber", "und", "xyz", "qq"]
    texts = ["".join(rng.choices(words, k=rng.randint(0, 12))) + rng.choice(["", " ", "7ab"]) for _ in range(300)] + [None, "", "a"]
    settings = {"max_length": 4, "min_count": 10, "min_cohesion": 0.5, "min_entropy": 0.5}
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    got = {
        r["token"]: (r["term_count"], *(round(r[c], 6) for c in ("cohesion", "left_entropy", "right_entropy")))
        for r in discover_words(df, script="a-z", **settings).collect()
    }
    assert got == brute_words(texts, **settings)
    assert {"wort", "aber", "und"} <= set(got) and "rt" not in got


def test_discovery_of_nothing(spark):
    empty = spark.createDataFrame([("",), (None,)], "text string")
    assert discover_words(empty).collect() == []


def test_discovered_list_cuts_unspaced_text(spark):
    rng = random.Random(1)
    words = ["天气", "今天", "出去", "他们", "不好", "上山"]
    texts = spark.createDataFrame([("".join(rng.choices(words, k=8)),) for _ in range(300)], "text string")
    found = discover_words(texts, min_cohesion=1.0)
    assert set(words) <= {r["token"] for r in found.collect()}
    cut = segment(texts, found.select("token", "term_count"), method="frequency")
    tokens = [w for r in cut.select("words").collect() for w in r["words"]]
    assert sum(w in words for w in tokens) / len(tokens) > 0.9
    assert tokenize(texts, "mixed").select("words").first()["words"]


def test_places_are_counted_by_distinct_word(spark):
    """Steps and starts between and inside words of every length, repeated words, characters beyond the basic plane."""
    rng = random.Random(5)
    words = ["a", "b", "ab", "abc", "abcd", "abcde", "1", "x1", "", ",", "𝒜", "𝒜b", "é𝒜b"]
    rows = [rng.choices(words, k=rng.randint(0, 30)) for _ in range(200)] + [None, []]
    got = {(r["kind"], r["place"], r["mark"]): r["n"] for r in counted(spark, rows, script=r"\p{L}").collect()}
    assert got == expected_counts(rows, str.isalpha)


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0].splitlines()


def test_words_are_grouped_before_they_are_spelled(spark):
    """The characters come from distinct words: their Generate is above an aggregation by word."""
    df = spark.createDataFrame([(["ab", "c"],)] * 3, "words array<string>")
    lines = final_plan(place_counts(df, script=r"\p{L}"))
    spelled = next(i for i, line in enumerate(lines) if "Generate posexplode" in line)
    assert any("HashAggregate(keys=[word" in line for line in lines[spelled:])


def test_grams_follow_from_windows(spark):
    texts = ["abcab", "a", "", None, "ab1abc", "𝒜b𝒜b"] * 3
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    expected = Counter()
    for text in texts:
        for run in "".join(c if c.isalpha() else " " for c in text or "").split():
            run = OPEN + run + CLOSE
            expected.update(run[at : at + n] for n in range(1, 4) for at in range(len(run) - n + 1))
    grams = gram_counts(df, 3, script=r"\p{L}")
    assert {(r["gram"], r["size"]): r["n"] for r in grams.collect()} == {(g, len(g)): n for g, n in expected.items()}
    assert any("HashAggregate(keys=[window" in line for line in final_plan(grams))  # one row per character, not one per n-gram
