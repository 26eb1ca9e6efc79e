import random

import pytest
from pyspark.sql import functions as F

from msgmart.llm import merkle
from msgmart.llm.scratch import Scratch

from .plain import sha

DDL = "doc_id long, source string, lang string, n_chars long, text string"


def leaf(row):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def plain(rows, arity, change):
    """doc_id, leaf, subroot, root, siblings, folded root of every row, sorted."""

    def tree(nodes):
        """The root, and for each node the pairs (before, after) up to it."""
        above, spans = [[] for _ in nodes], [[i] for i in range(len(nodes))]
        while len(nodes) > 1:
            parents, wider = [], []
            for at in range(0, len(nodes), arity):
                run = nodes[at : at + arity]
                for k in range(len(run)):
                    for i in spans[at + k]:
                        above[i].append(("".join(run[:k]), "".join(run[k + 1 :])))
                parents.append(sha("".join(run)))
                wider.append(sum(spans[at : at + arity], []))
            nodes, spans = parents, wider
        return nodes[0], above

    groups = {}
    for row in rows:
        groups.setdefault(b"" if row[1] is None else b"s" + row[1].encode(), []).append(row)
    names = sorted(groups)
    lower = {}
    for name in names:
        groups[name].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        lower[name] = tree([leaf(r) for r in groups[name]])
    root, tops = tree([lower[name][0] for name in names])
    out = []
    for name, top in zip(names, tops, strict=True):
        subroot, above = lower[name]
        for row, path in zip(groups[name], above, strict=True):
            h = leaf(change(row))
            for before, after in path + top:
                h = sha(before + h + after)
            out.append((row[0], leaf(row), subroot, root, sha("".join(a + b for a, b in path + top)), h))
    return sorted(out, key=str)


def run(frame, arity=16, hit=None):
    hit = F.lit(False) if hit is None else hit
    found = merkle.manifest(frame, Scratch(frame.sparkSession, "test"), arity=arity, altered={"text": F.upper("text")}, hit=hit)
    path = F.col("path")
    rows = found.select("id", "leaf", "subroot", "root", merkle.proof_digest(path), merkle.folded(F.col("altered"), path)).collect()
    return sorted(map(tuple, rows), key=str)


@pytest.mark.parametrize("arity", [2, 3, 16])
def test_against_plain(spark, arity):
    """Groups of 1 to 300 rows; one has two thirds of all, one is null; one in three texts is altered."""
    rng = random.Random(arity)
    rows = [(k, rng.choice(["hot", "hot", "hot", "é", "z", "a", None, f"s{rng.randint(0, 30)}"]), "en", k % 7, f"text {k}") for k in range(450)]
    frame = spark.createDataFrame(rows, DDL).repartition(5)
    got = run(frame, arity, F.col("doc_id") % 3 == 0)
    want = plain(rows, arity, lambda r: (*r[:4], r[4].upper()) if r[0] % 3 == 0 else r)
    assert got == want
    root = want[0][3]
    assert {r[0] for r in got if r[5] != root} == {k for k in range(450) if k % 3 == 0}


@pytest.mark.parametrize("n", [1, 2, 16, 17, 256, 257])
def test_full_and_short_runs(spark, n):
    rows = [(k, "one", None, None, str(k)) for k in range(n)]
    assert run(spark.createDataFrame(rows, DDL)) == plain(rows, 16, lambda r: r)


def test_odd_rows(spark):
    """Nulls in every column, empty and very long texts, repeated rows, clashing extra columns."""
    rows = [(1, "a", "en", 3, "abc"), (1, "a", "en", 3, "abc"), (None, "a", None, None, None), (None, None, None, None, None), (2, None, "", 0, ""), (3, "a", "-", -1, "é:" * 200_000), (-5, "", "x", 1, "\x00\n")]
    frame = spark.createDataFrame(rows, DDL).selectExpr("*", "'x' AS id", "'y' AS tree", "1 AS place", "2 AS uid", "'z' AS leaf")
    assert run(frame) == plain(rows, 16, lambda r: r)


def test_fields_are_told_apart():
    rows = [(1, "a", "b", 1, None), (1, "a", "b", 1, "-"), (1, "ab", "", 1, "-"), (1, "a", "b1:1", None, "-")]
    assert len({leaf(r) for r in rows}) == 4


def test_empty(spark):
    got = merkle.manifest(spark.createDataFrame([], DDL), Scratch(spark, "test"))
    assert got.columns == ["id", "leaf", "altered", "subroot", "root", "path"] and got.collect() == []


def test_levels_are_equijoins_of_single_nodes(spark):
    """No window and no grouping puts a tree into one task; what two joins have made is written."""
    nodes = spark.range(100).selectExpr("'1' AS tree", "id AS place", "100L AS n", "struct(string(id) AS digest) AS item")
    plan = merkle.runs(nodes, 16, Scratch(spark, "test"), "runs")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join LeftOuter, ((tree") == 3 and "Aggregate" not in plan and "Window" not in plan


def test_levels_and_paths_are_never_broadcast(spark):
    """However small their files are: what they unpack to may not fit the driver."""
    frame = spark.createDataFrame([(k, f"s{k % 3}", "en", k, str(k)) for k in range(300)], DDL)
    nodes = frame.selectExpr("source AS tree", "doc_id AS place", "300L AS n", "struct(text AS digest) AS item")
    for found in (merkle.runs(nodes, 2, Scratch(spark, "test"), "runs"), merkle.manifest(frame, Scratch(spark, "test"))):
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Broadcast" not in plan
