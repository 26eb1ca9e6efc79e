import random

from pyspark.sql import functions as F

from msgmart.llm import chat
from msgmart.llm.scratch import Scratch

SCHEMA = "tree long, node long, parent long, role string, text string, score double"
PIECES = ["<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "[ROLE]", "[/ROLE]", "[/TEXT]", "\\", " ", "\n", "a", "é", "<", "["]


def branches(spark, rows, k=1):
    found = chat.best_branches(spark.createDataFrame(rows, SCHEMA), Scratch(spark, "test"), k)
    out = {}
    for r in found.collect():
        out.setdefault((r.tree, r.branch), {})[r.position] = r.node
    return {key: [path[p] for p in sorted(path)] for key, path in out.items()}


def plain_branches(rows, k):
    parent, score, trees = {}, {}, {}
    for tree, node, up, _, _, s in rows:
        parent[tree, node], score[tree, node] = up, s or 0
        trees.setdefault(tree, set()).add(node)
    out = {}
    for tree, nodes in trees.items():
        inner = {parent[tree, n] for n in nodes}
        paths = []
        for leaf in nodes - inner:
            path = [leaf]
            while parent[tree, path[-1]] in nodes:
                path.append(parent[tree, path[-1]])
            paths.append((-sum(score[tree, n] for n in path), leaf, path[::-1]))
        for rank, (_, _, path) in enumerate(sorted(paths)[:k], 1):
            out[tree, rank] = path
    return out


def test_branches_against_plain(spark):
    rng = random.Random(1)
    rows = []
    for tree in range(30):
        for node in range(rng.randint(1, 40)):
            rows.append((tree, node, rng.choice([None, *range(node)]) if node else None, "user", "x", float(rng.randint(0, 5))))
    for k in (1, 3):
        assert branches(spark, rows, k) == plain_branches(rows, k)


def test_deep_chain_and_cycles(spark):
    rows = [(1, k, k - 1 if k else None, "user", "x", None) for k in range(300)]
    rows += [(2, 1, 2, "u", "", 0.0), (2, 2, 1, "u", "", 0.0), (2, 3, 2, "u", "", 0.0), (2, 4, None, "u", "", 0.0), (3, 1, 99, "u", "", 0.0), (None, 1, None, "u", "", 0.0), (None, 2, 1, "u", "", 0.0)]
    assert branches(spark, rows, 2) == {(1, 1): list(range(300)), (2, 1): [4], (3, 1): [1], (None, 1): [1, 2]}


def test_texts_come_back(spark):
    rng = random.Random(4)
    rows = []
    for tree in range(300):
        for node in range(rng.randint(1, 6)):
            role = rng.choice(["user", "assistant", "system", "tool", None, "", "[/ROLE] ", "a [/ROLE] b"])
            rows.append((tree, node, node - 1 if node else None, role, None if rng.random() < 0.1 else "".join(rng.choices(PIECES, k=rng.randint(0, 12))), 0.0))
    done = chat.read_back(chat.format_chats(spark.createDataFrame(rows, SCHEMA))).collect()
    turns = {}
    for tree, _, _, role, text, _ in rows:
        turns.setdefault(tree, []).append((role or "", text or ""))
    assert len(done) == 300
    for r in done:
        assert [(t.role, t.text) for t in r.turns] == turns[r.tree]
        assert r.loss_texts == [x for role, x in turns[r.tree] if role == "assistant"]


def test_ordinary_text_is_left_alone(spark):
    row = chat.format_chats(spark.createDataFrame([(1, 1, None, "user", "a [b] <c> \\d", 0.0), (1, 2, 1, "assistant", "fine", 0.0)], SCHEMA)).first()
    assert row.formatted == "[INST] a [b] <c> \\d [/INST]<s> fine </s>"
    assert [row.formatted[s.start : s.end] for s in row.loss_spans] == ["fine"]


def test_long_texts_and_runs_of_backslashes(spark):
    texts = ["\\" * 20_000, "\\" * 5000 + "</s>", "word " * 50_000, "[INST] " * 5000]
    done = chat.read_back(chat.format_chats(spark.createDataFrame([(k, 1, None, "assistant", t, 0.0) for k, t in enumerate(texts)], SCHEMA))).collect()
    assert {r.tree: r.turns[0].text for r in done} == dict(enumerate(texts))


def test_repeated_rows_and_empty(spark):
    rows = [(1, 1, None, "user", "b", 0.0), (1, 1, None, "user", "a", 0.0), (1, 1, None, "user", "a", 0.0)]
    frame = spark.createDataFrame(rows, SCHEMA)
    extra = frame.withColumns({"n": F.lit(1), "t": F.lit(2), "up": F.lit(3), "formatted": F.lit("x")})
    assert [r.formatted for r in chat.format_chats(extra).collect()] == ["[INST] a [/INST]"]
    assert chat.format_chats(frame.limit(0)).collect() == []
