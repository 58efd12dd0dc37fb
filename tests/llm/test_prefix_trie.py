"""The prefix trie against a dictionary of prefixes; centroid sums against plain ones."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from larder.llm import centroids, prefix_trie
from larder.llm.common import ready

SCHEMA = "conv_id long, turn long, role string, text string, depth string, path int"


def brute(rows):
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            turns[conv].append(((turn is not None, turn or 0), (role or "", text or "")))
    turns = {c: [t for _, t in sorted(own, key=lambda x: x[0])] for c, own in turns.items()}
    rebuilt, members, kids = {}, defaultdict(list), defaultdict(list)
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 9
        rebuilt[c] = tuple(turns.get(c - c % 5, [])[:h] + own[h:])
        for d in range(len(rebuilt[c]) + 1):
            members[rebuilt[c][:d]].append(c)
    leaves, saved = {}, {}
    for s in sorted(members, key=len, reverse=True):
        if s:
            kids[s[:-1]].append(s)
        leaves[s] = sum(leaves[k] for k in kids[s]) if kids[s] else 1
        saved[s] = sum(saved[k] for k in kids[s])
        saved[s] += (len(members[s]) - 1) * len(s[-1][1].encode()) if s else 0
    return sorted(
        (
            min(m), len(s), min(members[s[:-1]]) if s else -1, len(m), len(kids[s]), leaves[s], saved[s],
            hashlib.sha256(",".join(str(c) for c in sorted(m) if rebuilt[c] == s).encode()).hexdigest(),
        )
        for s, m in members.items()
    )


def check(spark, rows, limit=4096):
    ready(spark)
    table = spark.createDataFrame([(*r, "clash", 3) for r in rows], SCHEMA)
    found = [list(r) for r in prefix_trie.prefix_trie(table, limit=limit).collect()]
    for r in found:
        r[2] = -1 if r[2] is None else r[2]
    assert sorted(map(tuple, found)) == brute(rows)


@pytest.mark.parametrize("limit", [4096, 5])
def test_conversations_that_share_beginnings(spark, limit):
    rng = random.Random(3)
    rows = [
        (c, t, rng.choice(["user", "assistant", None]), rng.choice(["x", "ÿ", "", None]))
        for c in range(70)
        for t in range(rng.randint(1, 12))
    ]
    check(spark, rows, limit)


def test_long_and_turnless_conversations(spark, monkeypatch):
    monkeypatch.setattr(centroids, "BLOCK", 64)
    monkeypatch.setattr(prefix_trie, "BLOCK", 64)
    rows = [(10, t, "u", f"t{t}") for t in range(700)] + [(11, t, "u", f"z{t}") for t in range(3)]
    # 3 and 18 have no base; null turns come first; rows without an id belong nowhere
    rows += [(15, 0, None, None), (3, 0, "u", "q"), (18, 0, "u", "q"), (15, None, "a", "b"), (None, 1, "u", "w")]
    rows += [(20, 4, "u", "same")] * 3
    check(spark, rows, 50)


def test_many_equal_conversations(spark):
    rows = [(c, t, "u", f"w{t}") for c in range(0, 6000, 5) for t in range(2)]
    rows += [(c, 0, "u", f"own {c}") for c in range(1, 1000, 5)]
    check(spark, rows, 64)


def test_empty_table(spark):
    check(spark, [])


def random_forest(rng, n, reach):
    parent = np.array([-1 if rng.random() < 0.01 or not i else rng.randint(max(0, i - reach), i - 1) for i in range(n)])
    depth = np.zeros(n, np.int64)
    for i in range(n):
        depth[i] = 0 if parent[i] < 0 else depth[parent[i]] + 1
    return parent, depth


@pytest.mark.parametrize("reach", [1, 3, 50, 400])
def test_decomposition_of_forests(reach):
    rng = random.Random(reach)
    parent, depth = random_forest(rng, 400, reach)
    own = np.array([[rng.randint(-9, 9), 1] for _ in parent])
    wanted = own.copy()
    for i in range(len(parent) - 1, 0, -1):
        if parent[i] >= 0:
            wanted[parent[i]] += wanted[i]
    got = centroids.decompose(parent, depth, wanted[:, 1].copy(), own, np.zeros_like(own))
    assert got.tolist() == wanted.tolist()
    shuffled = np.array(rng.sample(range(400), 400))
    place = np.argsort(shuffled)
    moved = np.where(parent[shuffled] < 0, -1, place[parent[shuffled]])
    got = centroids.decompose(moved, depth[shuffled], wanted[shuffled, 1], own[shuffled], np.ones_like(own))
    assert got.tolist() == (wanted[shuffled] + 1).tolist()


def test_no_join_is_without_a_key(spark):
    ready(spark)
    rows = [(c, t, "u", f"w{t} {c % 7}", "clash", 3) for c in range(200) for t in range(3)]
    found = prefix_trie.prefix_trie(spark.createDataFrame(rows, SCHEMA), limit=20)
    text = found._jdf.queryExecution().toString()
    assert "NestedLoop" not in text and "Cartesian" not in text
