"""Language identification by hierarchical discrimination.

Languages are grouped into families of similar spelling. A text's family is decided
first, by one-versus-one linear support vector machines between families; machines
between each two languages of that family then decide the language.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textjury.llm.common import row_crc, stored

#: Labelled rows per language that machines are fitted on, at most: those with the least hash of their id.
FIT_ROWS = 1_000
#: And of all languages together, so their ids can be broadcast.
FIT_ROWS_IN_ALL = 200_000
BINS_LOG2 = 12
BINS = 1 << BINS_LOG2
GRAMS = (1, 2, 3, 4)  # bytes of lower-cased words
RIDGE = 1e-4
STEPS = 200
SHARPNESS = 3.0
UNKNOWN = "und"

WORD = re.compile(r"[^\W\d_]+")


def spelled(text: str | None) -> np.ndarray | None:
    """Hashed byte n-grams within the words of a whole text, square roots of counts at length one; None without letters."""
    words = WORD.findall(text.lower()) if text else []
    if not any(c.isalpha() for w in words for c in w):
        return None
    codes = np.frombuffer(f" {' '.join(words)} ".encode(), np.uint8).astype(np.uint32)
    counts = np.zeros(BINS)
    gram = codes
    for n in GRAMS:
        if n > 1:
            gram = gram[: len(codes) - n + 1] * np.uint32(257) + codes[n - 1 :]
        mixed = (gram + np.uint32(n)) * np.uint32(2654435761)
        counts += np.bincount(mixed >> np.uint32(32 - BINS_LOG2), minlength=BINS)
    root = np.sqrt(counts)
    return (root / np.linalg.norm(root)).astype(np.float32)


def learnable(key: str = "doc_id") -> Column:
    """Rows that may be learned from; the rest is held out."""
    return row_crc(key) % 5 != 0


def fit_sample(docs: DataFrame, key: str, text: str, lang: str, rows: int) -> DataFrame:
    """(lang, text, place): at most ``rows`` learnable texts with letters of each language."""
    usable = docs.where(
        F.col(lang).isNotNull() & (F.col(lang) != "") & F.col(text).rlike(r"\p{L}") & learnable(key)
    ).select(F.xxhash64(key, text).alias("draw"), F.col(lang).cast("string").alias("lang"))
    usable = stored(usable.distinct(), "language-rows")
    counts = stored(usable.groupBy("lang").agg(F.count("*").alias("n")), "language-counts")
    most = min(rows, max(1, FIT_ROWS_IN_ALL // max(counts.count(), 1)))
    # Draws are spread evenly, so a large language's least ones lie below a share of their
    # range. Only those are ranked, and no task sees a whole language.
    few = (F.col("draw") / 2.0**64 + 0.5) * F.col("n") <= 4 * most + 100
    place = F.row_number().over(Window.partitionBy("lang").orderBy("draw"))
    chosen = (
        usable.join(counts, "lang").where(few).select("draw", "lang", place.alias("place")).where(F.col("place") <= most)
    )
    texts = docs.where(learnable(key)).select(
        F.xxhash64(key, text).alias("draw"), F.col(lang).cast("string").alias("lang"), F.col(text).alias("text")
    )
    return texts.join(F.broadcast(chosen), ["draw", "lang"]).dropDuplicates(["draw", "lang"]).select("lang", "text", "place")


def families(sample: DataFrame) -> list[list[str]]:
    """Languages grouped by the likeness of their mean spelling, into about as many groups as the root of their number."""

    def add(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in rows:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if (x := spelled(text)) is not None:
                    sums[lang] = sums.get(lang, 0) + x
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(sums), pa.string()), pa.array([s.tolist() for s in sums.values()], pa.list_(pa.float64()))],
            names=["lang", "sums"],
        )

    def total(parts: pa.Table) -> pa.Table:
        sums = np.zeros(BINS)
        for vector in parts["sums"].to_pylist():
            sums += vector
        return pa.table({"lang": parts["lang"].slice(0, 1), "sums": pa.array([sums.tolist()], pa.list_(pa.float64()))})

    schema = "lang string, sums array<double>"
    parts = sample.select("lang", "text").mapInArrow(add, schema).groupBy("lang").applyInArrow(total, schema)
    means = {row["lang"]: np.array(row["sums"]) for row in parts.collect()}  # a row per language
    langs = sorted(means)
    if not langs:
        return []
    matrix = np.array([means[x] / np.linalg.norm(means[x]) for x in langs])
    matrix = matrix - matrix.mean(axis=0)
    matrix /= np.maximum(np.linalg.norm(matrix, axis=1, keepdims=True), 1e-12)
    likeness = matrix @ matrix.T
    groups = [[i] for i in range(len(langs))]
    while len(groups) > math.ceil(math.sqrt(len(langs))):
        a, b = max(
            combinations(range(len(groups)), 2), key=lambda p: likeness[np.ix_(groups[p[0]], groups[p[1]])].mean()
        )
        groups[a] += groups.pop(b)
    return [sorted(langs[i] for i in group) for group in groups]


def fit_machine(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, float]:
    """A linear support vector machine: squared hinge loss, classes weighted equally, accelerated gradient steps.

    The last column of ``x`` is 1 and takes the bias.
    """
    share = np.where(y > 0, 0.5 / max((y > 0).sum(), 1), 0.5 / max((y < 0).sum(), 1)).astype(x.dtype)
    w = ahead = np.zeros(x.shape[1], x.dtype)
    momentum = 1.0
    for _ in range(STEPS):
        slack = np.maximum(0, 1 - y * (x @ ahead))
        step = ahead - (RIDGE * ahead - 2 * ((share * y * slack) @ x)) / (4 + RIDGE)
        after = (1 + math.sqrt(1 + 4 * momentum * momentum)) / 2
        ahead = step + (momentum - 1) / after * (step - w)
        w, momentum = step, after
    return w[:-1], float(w[-1])


def fit_machines(sample: DataFrame, grouped: list[list[str]], rows: int) -> dict[tuple[str, str], tuple[np.ndarray, float]]:
    """A machine for each two families ('#0', '#1', ...) and each two languages of a family; one task each."""
    memberships: dict[str, list[tuple[str, str, float, int]]] = {}
    for a, b in combinations(range(len(grouped)), 2):
        for f, y in ((a, 1.0), (b, -1.0)):
            for lang in grouped[f]:
                most = -(-rows // len(grouped[f]))  # a large family does not get more rows
                memberships.setdefault(lang, []).append((f"#{a}", f"#{b}", y, most))
    for langs in grouped:
        for a, b in combinations(langs, 2):
            memberships.setdefault(a, []).append((a, b, 1.0, rows))
            memberships.setdefault(b, []).append((a, b, -1.0, rows))
    if not memberships:
        return {}
    spark = sample.sparkSession
    problems = spark.createDataFrame(
        [(lang, *m) for lang, ms in memberships.items() for m in ms], "lang string, a string, b string, y float, most int"
    )

    def fit(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        x = np.ones((len(rows), BINS + 1), np.float32)
        for i, text in enumerate(rows["text"]):
            if (vector := spelled(text)) is not None:
                x[i, :-1] = vector
        w, bias = fit_machine(x, rows["y"].to_numpy(np.float32))
        return pd.DataFrame({"a": [key[0]], "b": [key[1]], "w": [w.tolist()], "bias": [bias]})

    fitted = (
        sample.join(F.broadcast(problems), "lang")
        .where(F.col("place") <= F.col("most"))
        .groupBy("a", "b")
        .applyInPandas(fit, "a string, b string, w array<float>, bias float")
    )
    return {(r["a"], r["b"]): (np.array(r["w"], np.float32), r["bias"]) for r in fitted.collect()}


class Hierarchy:
    """Families, their languages and the machines between them."""

    def __init__(self, grouped: list[list[str]], machines: dict[tuple[str, str], tuple[np.ndarray, float]]):
        self.grouped = grouped
        self.pairs = list(machines)
        self.w = np.array([machines[p][0] for p in self.pairs], np.float32).reshape(len(self.pairs), BINS)
        self.bias = np.array([machines[p][1] for p in self.pairs], np.float32)

    def _decide(self, names: list[str], margins: dict[tuple[str, str], float]) -> tuple[str, float]:
        """The name with most won duels, then the greatest sum of margins; and its least margin."""
        duels: dict[str, list[float]] = {n: [] for n in names}
        for a, b in combinations(names, 2):
            duels[a].append(margins[a, b])
            duels[b].append(-margins[a, b])
        best = max(names, key=lambda n: (sum(m > 0 for m in duels[n]), sum(duels[n])))
        return best, min(duels[best], default=math.inf)

    def predict(self, x: np.ndarray) -> list[tuple[str, float]]:
        found = []
        for margins in (x @ self.w.T + self.bias).tolist():
            by_pair = dict(zip(self.pairs, margins))
            family, first = self._decide([f"#{i}" for i in range(len(self.grouped))], by_pair)
            lang, second = self._decide(self.grouped[int(family[1:])], by_pair)
            found.append((lang, 1 / (1 + math.exp(-SHARPNESS * max(min(first, second, 10.0), -10.0)))))
        return found


def fit(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", rows: int = FIT_ROWS) -> Hierarchy:
    """Learned from learnable rows with a language; held-out rows are never read."""
    sample = stored(fit_sample(docs, key, text, lang, rows), "language-sample")
    grouped = families(sample)
    return Hierarchy(grouped, fit_machines(sample, grouped, rows))


def predict(docs: DataFrame, model: Hierarchy, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score), one row per input row, from the whole text alone.

    Null texts and texts without a letter are ``und`` with score 0, as is everything when
    no language could be learned; with a single learned language the score is 1. The
    score rises with the least margin of the chosen language. Null ids are kept, equal
    texts get equal results, an empty table gives no rows, other columns are ignored.
    """
    # Machines by bins: bounded by languages. Plain values, as an executor may lack this package.
    sent = docs.sparkSession.sparkContext.broadcast(vars(model))

    def read(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = object.__new__(Hierarchy)
        vars(model).update(sent.value)
        for batch in rows:
            langs, scores = [UNKNOWN] * batch.num_rows, [0.0] * batch.num_rows
            for first in range(0, batch.num_rows, 512):
                vectors = [spelled(v) for v in batch.column(1).slice(first, 512).to_pylist()]
                at = [i for i, x in enumerate(vectors) if x is not None] if model.grouped else []
                if at:
                    for i, (lang, score) in zip(at, model.predict(np.array([vectors[i] for i in at]))):
                        langs[first + i], scores[first + i] = lang, score
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                names=["doc_id", "lang_pred", "score"],
            )

    return docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(
        read, "doc_id long, lang_pred string, score double"
    )
