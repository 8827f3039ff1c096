import hashlib
import random
import zlib

import duckdb
import numpy as np
import pytest

from textjury.llm.prefix_trie import TRIE_SQL, Parentheses, prefix_trie

CONVERSATIONS = "conv_id long, turn long, role string, text string"


def by_sql(rows):
    connection = duckdb.connect()
    connection.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    if rows:
        connection.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", [list(r[:4]) for r in rows])
    return sorted(map(repr, connection.sql(TRIE_SQL).fetchall()))


def found(df, **settings):
    return sorted(repr(tuple(r)) for r in prefix_trie(df, **settings).collect())


def brute_force(rows):
    """Nodes as a dictionary of prefixes, written out one by one."""
    whole = {}
    for conv, _, role, text in sorted(
        (r for r in rows if r[0] is not None),
        key=lambda r: (r[0], r[1] is not None, r[1] or 0, hashlib.md5(f"{len(r[2] or '')}:{r[2] or ''}{r[3] or ''}".encode()).hexdigest()),
    ):
        whole.setdefault(conv, []).append((role or "", text or ""))
    nodes = {}
    for conv, own in whole.items():
        h = zlib.crc32(str(conv).encode()) % 6
        family = conv - int(np.fmod(conv, 100))
        said = tuple(whole.get(family, [])[:h] + own[h:])
        for d in range(len(said) + 1):
            node = nodes.setdefault(said[:d], {"members": [], "ends": []})
            node["members"].append(conv)
            if d == len(said):
                node["ends"].append(conv)
    out = []
    for prefix, node in nodes.items():
        below = [p for p in nodes if p[: len(prefix)] == prefix]
        children = [p for p in below if len(p) == len(prefix) + 1]
        leaves = [p for p in below if not any(len(q) == len(p) + 1 and q[: len(p)] == p for q in below)]
        saved = sum((len(nodes[p]["members"]) - 1) * len(p[-1][1]) for p in below if p)
        ends = hashlib.sha256(",".join(map(str, sorted(node["ends"]))).encode()).hexdigest()
        parent = min(nodes[prefix[:-1]]["members"]) if prefix else None
        out.append(repr((min(node["members"]), len(prefix), parent, len(node["members"]), len(children), len(leaves), saved, ends)))
    return sorted(out)


def family(seed, conversations=60, turns=7, words=2):
    """Conversations that share beginnings often, with copies of one of them."""
    rng = random.Random(seed)
    rows = []
    for conv in rng.sample(range(-150, 450), conversations):
        for turn in range(rng.randint(1, turns)):
            rows.append((conv, turn, rng.choice(["user", "assistant", None]), rng.choice(["a", "bé", "", None][:words])))
    copies = [r for r in rows if r[0] == rows[0][0]]
    rows += [(1000 + i, *r[1:]) for i in range(40) for r in copies]
    return rows


@pytest.mark.parametrize("seed, words, per_shard", [(2, 2, 5), (3, 4, 3)])
def test_equals_brute_force_and_sql(spark, seed, words, per_shard):
    rows = family(seed, words=words)
    random.Random(seed).shuffle(rows)
    got = found(spark.createDataFrame(rows, CONVERSATIONS), nodes_per_shard=per_shard)
    assert got == brute_force(rows)
    assert got == by_sql(rows)


def test_long_conversation_and_hot_first_turn(spark):
    rows = [(7, t, "user", f"t{t}") for t in range(60)]
    rows += [(8, t, "user", f"t{t}") for t in range(40)] + [(c, t, "user", "hello" if t == 0 else f"{c}") for c in range(300, 400) for t in range(2)]
    assert found(spark.createDataFrame(rows, CONVERSATIONS)) == brute_force(rows) == by_sql(rows)


def test_nulls_ties_repeated_rows_and_clashing_columns(spark):
    rows = [
        (None, 1, "user", "lost"), (1, None, "user", "first"), (1, 1, None, None), (1, 1, None, None), (1, 1, "user", "x"),
        (2, 5, "", "y" * 5000), (2, None, "user", None), (100, 0, "user", "only"), (101, 0, "a", "b"), (103, 0, "a", "b"),
    ]
    df = spark.createDataFrame([(*r, 1, "p", 2) for r in rows], CONVERSATIONS + ", depth int, path string, a int")
    assert found(df) == brute_force(rows) == by_sql(rows)


def test_empty(spark):
    assert prefix_trie(spark.createDataFrame([], CONVERSATIONS)).collect() == []


def test_only_turnless(spark):
    conv = next(c for c in range(1, 99) if zlib.crc32(str(c).encode()) % 6 > 1)  # its family is absent
    rows = [(conv, 0, "user", "dropped")]
    assert found(spark.createDataFrame(rows, CONVERSATIONS)) == brute_force(rows)


@pytest.mark.parametrize("seed", range(5))
def test_parentheses(seed):
    rng = np.random.default_rng(seed)
    depth = [1]
    for _ in range(2000):
        depth.append(int(rng.integers(max(1, depth[-1] - (30 if rng.random() < 0.1 else 2)), depth[-1] + 2)))
    depth = np.array(depth)
    leaf = np.r_[depth[1:] <= depth[:-1], seed % 2 == 0]
    weight = rng.integers(0, 9, len(depth))
    leaves, total, goes_on = Parentheses(depth, leaf, weight).subtrees()
    for i in range(len(depth)):
        end = next((j for j in range(i + 1, len(depth)) if depth[j] <= depth[i]), len(depth))
        closed = end < len(depth) or (i == len(depth) - 1 and leaf[-1])
        assert (leaves[i], total[i], not goes_on[i]) == (leaf[i:end].sum(), weight[i:end].sum(), closed)
