"""Benchmark decontamination with a distributed positional inverted index.

The index is cut by documents: a stored row holds the postings of some documents, one
list of (document, position) per term. Test items become windows of consecutive words;
in each row a window's lists are intersected, offset by its words' places, from the
rarest term on. What is left are its exact phrase matches, or with ``slop`` its
proximity matches. Documents never leave their row, so nothing is shuffled and a
passage that many documents hold makes no hot key.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textjury.llm.common import lookup, stored, unused

WINDOW = 10
DOCUMENTS_PER_ROW = 2_000
WORDS_PER_ROW = 1_000_000
#: Test texts are sent to the executors in blocks of about so many bytes.
BLOCK_BYTES = 16_000_000

_KEPT = frozenset(b"0123456789abcdefghijklmnopqrstuvwxyz") | frozenset(range(128, 256))
_SPACED = bytes(b if b in _KEPT else 32 for b in range(256))
_DOC = 32  # a posting is document << 32 | position

INDEX = (
    "doc_ids array<long>, text_hashes array<long>, n_words array<int>, "
    "terms array<binary>, starts array<long>, postings array<long>"
)
MATCHES = INDEX + ", hit_starts array<long>, hit_sizes array<int>, class_docs array<int>, classes array<long>"
HITS = ["hit_starts", "hit_sizes", "class_docs", "classes"]
RESULT = (
    "doc_id long, text_hash long, n_words long, n_hit long, classes array<long>, "
    "spans array<struct<first: int, last: int>>"
)


def words(text: bytes | None) -> list[bytes]:
    """Lower-cased runs of 0-9, a-z and characters beyond ASCII."""
    return text.lower().translate(_SPACED).split() if text else []


class Tests:
    """A block of test classes, (number, spaced words), as windows."""

    def __init__(self, classes: list[tuple[int, bytes]], window: int = WINDOW):
        of_window: dict[tuple[bytes, ...], set[int]] = defaultdict(set)
        for c, text in classes:
            found = tuple(text.split())
            size = min(window, len(found))
            for at in range(len(found) - size + 1):
                of_window[found[at : at + size]].add(c)
        self.windows = list(of_window)
        self.window_classes = [sorted(c) for c in of_window.values()]
        self.term_ids = {t: i for i, t in enumerate(sorted({t for w in self.windows for t in w}))}
        #: By term, the windows in which it is the one that fewest windows have.
        uses = Counter(t for w in self.windows for t in set(w))
        self.by_rarest: dict[bytes, list[int]] = defaultdict(list)
        for i, w in enumerate(self.windows):
            self.by_rarest[min(w, key=lambda t: (uses[t], t))].append(i)
        #: By window size, whether a window of that size has the term.
        self.by_size = {size: np.zeros(len(self.term_ids), bool) for size in {len(w) for w in self.windows}}
        for w in self.windows:
            self.by_size[len(w)][[self.term_ids[t] for t in w]] = True

    def reachable(self, ids: np.ndarray) -> np.ndarray:
        """Where an exact match can lie: in a run, as long as a window, of words of windows that long."""
        keep = np.zeros(len(ids), bool)
        for size, known in self.by_size.items():
            inside = np.zeros(len(ids) + 2, np.int8)
            inside[1:-1] = (ids >= 0) & known[ids]
            edges = np.flatnonzero(np.diff(inside))
            for first, end in zip(edges[::2], edges[1::2]):
                if end - first >= size:
                    keep[first:end] = True
        return keep


def test_classes(tests: DataFrame, item_key: str, item_text: str, block_bytes: int) -> tuple[DataFrame, DataFrame, int]:
    """(class, words, block) of the items with words, (class, item_id) of all of these, and the number of blocks.

    Items of equal words are one class, so that a task gets each text once, whatever its
    copies. Blocks are cut in Spark, by a hash of the words.
    """

    def spaced(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            pairs = [(i, b" ".join(f)) for i, t in zip(*(c.to_pylist() for c in batch.columns)) if (f := words(t))]
            ids, texts = zip(*pairs) if pairs else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.string()), pa.array(texts, pa.binary())], names=["item_id", "words"])

    rows = tests.where(F.col(item_key).isNotNull() & F.col(item_text).isNotNull()).select(
        F.col(item_key).cast("string").alias("item_id"), F.col(item_text).cast("binary").alias("text")
    )
    items = stored(rows.mapInArrow(spaced, "item_id string, words binary"), "test-items")
    texts = items.groupBy("words").agg(F.count("*").alias("weight"))
    size, n = texts.agg(F.sum(F.octet_length("words")), F.sum("weight")).first()
    blocks = max(1, -(-(size or 0) // block_bytes))
    block = F.pmod(F.xxhash64("words"), F.lit(blocks)).cast("int").alias("block")
    classes = stored(texts.select(F.monotonically_increasing_id().alias("class"), "words", "weight", block), "test-classes")
    named = lookup(items, classes.drop("block"), ["words"], "weight", n or 0).select("class", "item_id")
    return classes.select("class", "words", "block"), stored(named.distinct(), "test-ids"), blocks


def index(docs: DataFrame, tests: Tests | None, exact: bool, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The positional index of ``docs``, in rows of bounded size.

    With ``tests``, only postings that can take part in a match are kept: those of test
    terms and, for exact phrases, those in long enough runs of test terms. Without, all.
    """
    vocabulary = None if tests is None else tests.term_ids

    def build(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, hashes, counts, parts, total = [], [], [], [], 0
        names = list(vocabulary) if vocabulary is not None else []
        own = vocabulary if vocabulary is not None else {}

        def row() -> pa.RecordBatch:
            term, posting = (np.concatenate([p[i] for p in parts]) if parts else np.zeros(0, np.int64) for i in (0, 1))
            order = np.argsort(term, kind="stable")
            term, posting = term[order], posting[order]
            held, starts = np.unique(term, return_index=True)
            columns = [
                (ids, pa.int64()), (hashes, pa.int64()), (counts, pa.int32()),
                ([names[t] for t in held], pa.binary()), (np.append(starts, len(term)), pa.int64()), (posting, pa.int64()),
            ]
            return pa.RecordBatch.from_arrays(
                [pa.array([values], pa.list_(kind)) for values, kind in columns],
                names=["doc_ids", "text_hashes", "n_words", "terms", "starts", "postings"],
            )

        for batch in rows:
            for doc_id, text_hash, value in zip(*(c.to_pylist() for c in batch.columns)):
                found = words(value)
                if vocabulary is None:
                    for w in found:
                        if w not in own:
                            own[w] = len(names)
                            names.append(w)
                if found:
                    term = np.fromiter(map(own.get, found, repeat(-1)), np.int64, len(found))
                    keep = tests.reachable(term) if tests is not None and exact else term >= 0
                    at = np.flatnonzero(keep)
                    if len(at):
                        parts.append((term[at], at + (len(ids) << _DOC)))
                ids.append(doc_id)
                hashes.append(text_hash)
                counts.append(len(found))
                total += len(found)
                if len(ids) >= DOCUMENTS_PER_ROW or total >= WORDS_PER_ROW:
                    yield row()
                    ids, hashes, counts, parts, total = [], [], [], [], 0
                    if vocabulary is None:
                        names, own = [], {}
        if ids:
            yield row()

    return docs.select(
        F.col(key).cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"), F.col(text).cast("binary")
    ).mapInArrow(build, INDEX)


def intersect(lists: list[np.ndarray], offsets: list[int], slop: int) -> np.ndarray:
    """Starts of a window whose words have these postings at these places, give or take ``slop``."""
    order = sorted(range(len(lists)), key=lambda i: len(lists[i]))
    starts = lists[order[0]] - offsets[order[0]]
    for i in order[1:]:
        if not len(starts):
            break
        wanted = starts + offsets[i]
        low = np.searchsorted(lists[i], wanted - slop, "left")
        high = np.searchsorted(lists[i], wanted + slop, "right")
        starts = starts[high > low]
    return starts


def match(indexed: DataFrame, tests: Tests, slop: int = 0) -> tuple[DataFrame, Broadcast]:
    """``indexed`` with the matches of a block of tests added to those it has, and what was sent for it.

    A class is noted once per document, however often and in however many windows it occurs.
    """
    sent = indexed.sparkSession.sparkContext.broadcast((tests.windows, dict(tests.by_rarest), tests.window_classes))

    def search(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows, by_rarest, window_classes = sent.value
        for batch in rows:
            added: list[tuple[list, ...]] = []
            for r in range(batch.num_rows):
                get = lambda name: batch.column(name)[r].values  # noqa: B023, E731
                bounds, postings = get("starts").to_numpy(), get("postings").to_numpy()
                lists = {t: postings[a:b] for t, a, b in zip(get("terms").to_pylist(), bounds, bounds[1:])}
                starts, sizes, class_docs, classes = (list(batch.column(n)[r].as_py()) for n in HITS)
                noted: dict[int, set[int]] = {}
                for w in (w for term in lists for w in by_rarest.get(term, ())):
                    window = windows[w]
                    if not all(map(lists.__contains__, window)):
                        continue
                    found = intersect([lists[t] for t in window], list(range(len(window))), slop)
                    if len(found):
                        starts += found.tolist()
                        sizes += [len(window)] * len(found)
                        for doc in np.unique((found + len(window) - 1) >> _DOC).tolist():
                            noted.setdefault(doc, set()).update(window_classes[w])
                for doc, held in noted.items():
                    class_docs += [doc] * len(held)
                    classes += held
                added.append((starts, sizes, class_docs, classes))
            kinds = [pa.list_(k()) for k in (pa.int64, pa.int32, pa.int32, pa.int64)]
            columns = [pa.array(values, kind) for values, kind in zip(zip(*added), kinds)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:6], *columns],
                names=[*batch.schema.names[:6], *HITS],
            )

    return indexed.mapInArrow(search, MATCHES), sent


def judged(matched: DataFrame) -> DataFrame:
    """One row per document: its words, those inside a match, the classes matched, ascending, and the spans."""

    def judge(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.struct([("first", pa.int32()), ("last", pa.int32())])
        for batch in rows:
            for row in batch.select(["doc_ids", "text_hashes", "n_words", *HITS]).to_pylist():
                ids, n = row["doc_ids"], len(row["doc_ids"])
                hit, found, spans = [0] * n, [set() for _ in range(n)], [[] for _ in range(n)]
                for doc, held in zip(row["class_docs"], row["classes"]):
                    found[doc].add(held)
                for start, size in sorted(zip(row["hit_starts"], row["hit_sizes"])):
                    start = max(start, (start + size - 1) >> _DOC << _DOC)  # slop may reach before the text
                    doc, first = start >> _DOC, start & (1 << _DOC) - 1
                    last = min(first + size, row["n_words"][doc]) - 1
                    if spans[doc] and first <= spans[doc][-1][1] + 1:
                        grown = max(0, last - spans[doc][-1][1])
                        spans[doc][-1][1] += grown
                        hit[doc] += grown
                    else:
                        spans[doc].append([first, last])
                        hit[doc] += last - first + 1
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(ids, pa.int64()),
                        pa.array(row["text_hashes"], pa.int64()),
                        pa.array(row["n_words"], pa.int64()),
                        pa.array(hit, pa.int64()),
                        pa.array([sorted(f) for f in found], pa.list_(pa.int64())),
                        pa.array([[{"first": a, "last": b} for a, b in s] for s in spans], pa.list_(kind)),
                    ],
                    names=["doc_id", "text_hash", "n_words", "n_hit", "classes", "spans"],
                )

    return matched.mapInArrow(judge, RESULT)


def with_items(found: DataFrame, ids: DataFrame) -> DataFrame:
    """``found`` with ``item_ids``, sorted as text, in place of its classes.

    Documents with the same classes share one list, which is put together once; a list that
    very many documents share goes to them by broadcast.
    """
    kept = ["doc_id", "text_hash", "n_words", "n_hit"]
    hit = found.where(F.size("classes") > 0)
    sets = stored(hit.groupBy("classes").agg(F.count("*").alias("weight")), "class-sets")
    total = sets.agg(F.sum("weight")).first()[0] or 0
    uses = sets.select("classes", F.explode("classes").alias("class"))
    lists = uses.join(ids, "class").groupBy("classes").agg(F.sort_array(F.collect_set("item_id")).alias("item_ids"))
    named = lookup(hit, stored(sets.join(lists, "classes"), "item-lists"), ["classes"], "weight", total)
    none = found.where(F.size("classes") == 0).select(*kept, F.array().cast("array<string>").alias("item_ids"), "spans")
    return named.select(*kept, "item_ids", "spans").unionByName(none)


def contamination(
    docs: DataFrame,
    tests: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    slop: int = 0,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """(doc_id, text_hash, n_words, n_hit, item_ids, spans), one row per document row.

    ``n_hit`` counts the document's words inside any occurrence of a window of a test
    item; an item shorter than a window is one window. ``item_ids`` are those items as
    text, sorted; ``spans`` the stretches of words hit. With ``slop``, each word of a
    window may lie so many places off its own; the window's span counts as hit.

    Null and empty texts have no words and match nothing, nor do items without words or
    with a null id. Equal items and repeated rows each keep their own ids and rows. Null
    document ids are kept. Empty tables: no documents give no rows, no items give no
    hits. Other columns are ignored.
    """
    classes, ids, blocks = test_classes(tests, item_key, item_text, block_bytes)
    block = lambda b: Tests([(r["class"], bytes(r["words"])) for r in classes.where(F.col("block") == b).collect()], window)
    pruned = block(0) if blocks == 1 else None
    found = stored(index(docs, pruned, slop == 0, key, text), "positional-index").withColumns(
        {
            "hit_starts": F.array().cast("array<long>"),
            "hit_sizes": F.array().cast("array<int>"),
            "class_docs": F.array().cast("array<int>"),
            "classes": F.array().cast("array<long>"),
        }
    )
    for b in range(blocks):
        found, sent = match(found, pruned or block(b), slop)
        if blocks > 1:  # one block at a time on the driver and the executors
            found = stored(found, "matched")
            sent.unpersist()
    return with_items(stored(judged(found), "contamination"), ids)


def without_contaminated(docs: DataFrame, tests: DataFrame, key: str = "doc_id", text: str = "text", **settings) -> DataFrame:
    """``docs`` without the rows in which a test item occurs."""
    doc, hashed = unused(docs, "_doc", "_hash")
    found = contamination(docs, tests, key, text, **settings).where("n_hit > 0")
    bad = found.select(F.col("doc_id").alias(doc), F.col("text_hash").alias(hashed)).distinct()
    return docs.join(
        bad, F.col(key).cast("long").eqNullSafe(F.col(doc)) & (F.xxhash64(text) == F.col(hashed)), "left_anti"
    )
