import random
import zlib
from collections import Counter

import numpy as np
import pytest

from msgmart.llm import trie
from msgmart.llm.scratch import Scratch

from .plain import sha

DDL = "conv_id long, turn long, role string, text string"


def plain(rows, every=5, most=8):
    """Every node, by listing all prefixes."""
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            own.setdefault(conv, []).append((turn is not None, turn or 0, role or "", sha(text or ""), text or ""))
    own = {c: [(r, t) for _, _, r, _, t in sorted(x)] for c, x in own.items()}
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % (most + 1)
        base = c - int(np.fmod(c, every))
        built[c] = tuple(own.get(base, [])[:h] + turns[h:])
    members = {}
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members.setdefault(turns[:d], []).append(c)
    children = Counter(k[:-1] for k in members if k)
    leaves, saved = Counter(), Counter()
    for k, cs in members.items():
        for d in range(len(k) + 1):
            leaves[k[:d]] += k not in children
            saved[k[:d]] += (len(cs) - 1) * len(k[-1][1].encode()) if k else 0
    return sorted((min(cs), len(k), min(members[k[:-1]]) if k else -1, len(cs), children[k], leaves[k], saved[k], sha(",".join(str(c) for c in sorted(cs) if built[c] == k))) for k, cs in members.items())


def run(spark, rows, **options):
    frame = spark.createDataFrame(rows, DDL).repartition(5)
    return sorted((r[0], r[1], -1 if r[2] is None else r[2], *r[3:]) for r in map(tuple, trie.trie(frame, Scratch(spark, "test"), **options).collect()))


def _talks(n, seed):
    """Conversations of a small vocabulary; a third are one and the same, and one is very long."""
    rng = random.Random(seed)
    rows = []
    for c in range(n):
        same = c % 3 == 0
        length = 400 if c == 7 else 6 if same else rng.randint(1, 9)
        rows += [(c, t, "user" if t % 2 else "assistant", "same" if same or c == 7 else rng.choice("abé")) for t in range(length)]
    return rows


@pytest.mark.parametrize("local", [5, 60, 100_000])
def test_against_plain(spark, local):
    """Small bounds split components by rounds over the whole table, large ones inside tasks."""
    rows = _talks(100, local)
    assert run(spark, rows, local=local) == plain(rows)


def test_one_chain(spark, monkeypatch):
    monkeypatch.setattr(trie, "STRETCH", 7)
    monkeypatch.setattr(trie, "IDS", 3)
    rows = [(c, t, "user", "x") for c in range(12) for t in range(40 + c)]
    assert run(spark, rows, local=8, branch=False) == plain(rows, every=1, most=0)


def test_odd_rows(spark):
    """Nulls, no id, ids below zero, repeated rows, turns that tie, no turns left, a very long text."""
    rows = [(None, 0, "user", "x"), (0, None, None, None), (0, 1, "", ""), (0, 1, "", ""), (1, 0, "user", "b"), (1, 0, "user", "a"), (1, 0, "assistant", "b")]
    rows += [(-3, t, "user", "y") for t in range(3)] + [(2**60, 5, "user", "é" * 300_000), (3, 9, "user", "gone"), (13, 1, None, "gone"), (12, 1, "a", "ab"), (11, 1, "aa", "b")]
    got = run(spark, rows)
    assert got == plain(rows)
    assert any(r[1] == 0 and r[3] == 8 for r in got)


def test_other_columns_are_not_read(spark):
    rows = [(1, 0, "user", "a"), (2, 0, "user", "a")]
    frame = spark.createDataFrame(rows, DDL).selectExpr("*", "'x' AS conv", "'y' AS k1", "1 AS uid", "2 AS depth", "3 AS p")
    assert len(trie.trie(frame, Scratch(spark, "test")).collect()) == len(plain(rows))


def test_empty(spark):
    assert trie.trie(spark.createDataFrame([], DDL), Scratch(spark, "test")).collect() == []
    assert run(spark, [(None, 1, "user", "x")]) == []


@pytest.mark.parametrize("shape", ["chain", "star", "random", "forest"])
def test_decomposition(shape):
    rng = random.Random(2)
    n = 500
    parent = {"chain": list(range(-1, n - 1)), "star": [-1] + [0] * (n - 1), "random": [-1] + [rng.randrange(k) for k in range(1, n)], "forest": [-1 if k % 9 == 0 else rng.randrange(k - k % 9, k) for k in range(n)]}[shape]
    values = np.array([[rng.randint(0, 9), 1] for _ in range(n)])
    want = values.copy()
    for v in reversed(range(n)):
        if parent[v] >= 0:
            want[parent[v]] += want[v]
    assert trie.decompose(parent, values).tolist() == want.tolist()
