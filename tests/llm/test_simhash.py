import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from textjury.llm import simhash


def brute_print(text, n=3):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + n]) for i in range(max(1, len(words) - n + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints, radius):
    label = list(range(len(prints)))
    for i, a in enumerate(prints):
        for j in range(i):
            if (a ^ prints[j]).bit_count() <= radius:
                one, other = label[i], label[j]
                label = [min(one, other) if x in (one, other) else x for x in label]
    return label


@pytest.mark.parametrize(
    "text",
    ["", None, " \t", "one", "Two Words", "a b c", "a b c d", "A  b\x0bC\nd É é", "x " * 500, "\x85a　b c", "\x00 a b c"],
)
def test_fingerprint(text):
    assert simhash.fingerprint(text.encode() if text is not None else None) == brute_print(text)


def test_long_text_in_parts(monkeypatch):
    text = " ".join(f"w{i % 97}" for i in range(5000))
    whole = simhash.fingerprint(text.encode())
    monkeypatch.setattr(simhash, "SHINGLES_AT_A_TIME", 7)
    assert simhash.fingerprint(text.encode()) == whole == brute_print(text)


@pytest.mark.parametrize("radius", [0, 1, 2, 3])
def test_forest_finds_all_pairs(radius):
    draw = np.random.default_rng(radius)
    base = draw.integers(0, 2**63, 20, dtype=np.uint64)
    flips = np.uint64(1) << draw.integers(0, 64, (3, 400)).astype(np.uint64)
    bits = np.unique(base[draw.integers(0, 20, 400)] ^ flips[0] ^ flips[1] ^ flips[2])
    group = np.sort(draw.integers(0, 3, len(bits)))
    got = {(a, b) for x, y in simhash.BKForest(group, bits).near(radius) for a, b in zip(x.tolist(), y.tolist())}
    expected = {
        (i, j)
        for i in range(len(bits))
        for j in range(len(bits))
        if i != j and group[i] == group[j] and (int(bits[i]) ^ int(bits[j])).bit_count() <= radius
    }
    assert got == expected


@pytest.mark.parametrize("divide_above", [4096, 5])
def test_components_against_brute_force(spark, monkeypatch, divide_above):
    """Chains of small steps, also where hot shard groups are divided."""
    draw = random.Random(5)
    prints = [0, 1, 3, 7, 15, 2**63, 2**63 + 2**62]
    for _ in range(12):
        at = draw.getrandbits(64)
        for _ in range(20):
            prints.append(at)
            for _ in range(draw.choice([1, 2, 2, 3, 4])):
                at ^= 1 << draw.randrange(64)
    prints += prints[:20]
    rows = [(i * 7 % 1000, 0, p - 2**64 if p >= 2**63 else p) for i, p in enumerate(prints)]
    table = spark.createDataFrame(rows, "doc_id long, text_hash long, fp long")
    monkeypatch.setattr(simhash, "fingerprints", lambda *a: table)
    got = {r["doc_id"]: r["component_id"] for r in simhash.simhash_components(table, divide_above=divide_above).collect()}
    label = brute_components(prints, 2)
    ids = [r[0] for r in rows]
    least = {c: min(d for d, x in zip(ids, label) if x == c) for c in set(label)}
    assert got == {d: least[c] for d, c in zip(ids, label)}


def test_long_chains_of_links(spark):
    order = list(range(200))
    random.Random(1).shuffle(order)
    links = spark.createDataFrame(list(zip(order, order[1:])) + [(500, 501), (600, 600)], "a long, b long")
    got = {r["node"]: r["component"] for r in simhash.components(links).collect()}
    assert got == {**dict.fromkeys(range(1, 200), 0), 501: 500}


def test_nulls_repeats_and_empty(spark, documents):
    docs = documents([(9, None), (4, ""), (None, " "), (5, "a b c d"), (5, "a b c d"), (3, "A B c D"), (None, "only null ids")])
    got = sorted(((r["doc_id"], r["component_id"]) for r in simhash.simhash_components(docs).collect()), key=repr)
    assert got == sorted([(9, 4), (4, 4), (None, 4), (5, 3), (5, 3), (3, 3), (None, None)], key=repr)
    kept = [r["doc_id"] for r in simhash.near_dedup(docs).collect()]
    assert sorted(kept, key=repr) == sorted([4, 3, None], key=repr)
    assert simhash.simhash_components(documents([]).limit(0)).count() == 0
    assert simhash.near_dedup(documents([]).limit(0)).count() == 0


def test_one_of_repeated_rows_stays(spark, documents):
    docs = documents([(5, "a b c d"), (5, "a b c d"), (5, "other words of that id")]).withColumn("fp", F.lit("x"))
    kept = simhash.near_dedup(docs)
    assert kept.columns == docs.columns
    assert sorted(r["text"] for r in kept.collect()) == ["a b c d", "other words of that id"]
