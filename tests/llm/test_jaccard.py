import random

import numpy as np
import pytest

from msgmart.llm import jaccard
from msgmart.llm.components import components
from msgmart.llm.scratch import Scratch

from . import plain


def near_docs(n, seed=6):
    rng = random.Random(seed)
    docs = []
    for _ in range(n):
        base = docs[rng.randrange(len(docs))][1].split() if docs and rng.random() < 0.6 else [f"u{rng.randint(0, 10**6)}" for _ in range(rng.randint(1, 120))]
        for _ in range(rng.randint(0, 2)):
            base[rng.randrange(len(base))] = f"n{rng.randint(0, 10**6)}"
        docs.append((len(docs), " ".join(base)))
    return docs


def test_against_plain(spark):
    docs = near_docs(400)
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(6)
    got = {r.doc_id: (r.class_id, r.n_links) for r in jaccard.similar(frame).collect()}
    assert got == plain.jaccard(docs)


def test_large_groups_are_met_in_parts(spark):
    words = [f"w{k}" for k in range(200)]
    docs = [(k, " ".join([*words[:-1], f"end{k % 90}"])) for k in range(120)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    got = jaccard.similar(frame, jaccard.Settings(block=16)).collect()
    assert {(r.class_id, r.n_links, r.group_rows) for r in got} == {(0, 119, 120)}
    assert sum(r.first for r in got) == 1


def test_pruning_keeps_what_may_reach_the_threshold():
    assert jaccard.least_matches(16, 0.8, 1e-7) <= 4
    assert 70 <= jaccard.least_matches(128, 0.8, 1e-7) < 103
    same = np.ones((3, 128), np.uint32)
    assert jaccard.surviving(same, same, jaccard.Settings()).shape == (2, 9)
    assert not jaccard.surviving(same, same + 1, jaccard.Settings()).size


@pytest.mark.parametrize("every", [1, 40])
def test_overlaps(every):
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 300, 80, dtype=np.uint64)) for _ in range(60)]
    pairs = [(i, j) for i in range(60) for j in range(i + 1, 60)][::every]
    i, j = np.array(pairs).T
    assert jaccard.overlaps(sets, i, j).tolist() == [len(np.intersect1d(sets[a], sets[b])) for a, b in pairs]


def test_components(spark):
    edges = [(k, k + 1) for k in range(0, 50)] + [(100, 101), (200, 101), (7, 7)]
    frame = spark.createDataFrame(edges, "a long, b long")
    got = {r.node: r.component for r in components(frame, Scratch(spark, "test")).collect()}
    assert got == {**dict.fromkeys(range(51), 0), 100: 100, 101: 100, 200: 100}


def test_hub_keeps_its_links_to_all_families(spark):
    # a hub in a band of more than 33 parts: the leasts of one family, then one class of another
    hub, family, other = 1000, list(range(40)), 500
    links = [(a, hub) for a in (*family, other)] + [(other, 2000)]
    moved = jaccard.to_least(spark.createDataFrame(links, "a long, b long"))
    got = {r.node: r.component for r in components(moved, Scratch(spark, "test")).collect()}
    assert got == dict.fromkeys([*family, other, hub, 2000], 0)


def test_odd_rows(odd_docs, no_docs):
    rows = jaccard.similar(odd_docs).collect()
    assert len(rows) == 12
    of = {r.doc_id: r for r in rows if r.doc_id is not None and r.doc_id != 9}
    assert (of[1].class_id, of[1].n_links, of[3].class_id) == (1, 3, 1)
    assert of[7].class_id == of[8].class_id == 7
    assert all(of[k].n_links == 0 and of[k].first for k in (4, 5, 6))
    assert sorted(r.first for r in rows if r.doc_id == 9) == [False, True]
    kept = jaccard.keep_first(odd_docs)
    assert kept.columns == odd_docs.columns
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in kept.collect()) == [(False, k) for k in (1, 4, 5, 6, 7, 9)] + [(True, 0)]
    assert jaccard.similar(no_docs).collect() == [] and jaccard.keep_first(no_docs).collect() == []


def test_clashing_names_stay(odd_docs, no_docs):
    """Columns named as the helpers' are kept as they are."""
    clash = "*", "'u' AS _uid", "'t' AS _text", "'b' AS _bytes", "1 AS _h", "2 AS _fp", "'s' AS _spans", "3 AS _base"
    got = jaccard.keep_first(odd_docs.selectExpr(*clash))
    assert got.columns == [*odd_docs.columns, "_uid", "_text", "_bytes", "_h", "_fp", "_spans", "_base"]
    rows = got.collect()
    assert rows and {(r._uid, r._text, r._bytes, r._h, r._fp, r.uid) for r in rows} == {("u", "t", "b", 1, 2, "x")}
    assert jaccard.keep_first(no_docs.selectExpr(*clash)).collect() == []
