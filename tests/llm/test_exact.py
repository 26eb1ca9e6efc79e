import random

import numpy as np
import pytest

from msgmart.llm import exact, golomb

from . import plain


@pytest.mark.parametrize("n", [0, 1, 2, 1000])
@pytest.mark.parametrize("bits", [8, 40, 62])
def test_golomb_round_trip(n, bits):
    values = np.unique(np.random.default_rng(n + bits).integers(0, 2**bits, n, dtype=np.uint64))
    assert golomb.decode(golomb.encode(values)).tolist() == values.tolist()


def test_golomb_is_compact():
    values = np.unique(np.random.default_rng(1).integers(0, 2**60, 100_000, dtype=np.uint64))
    assert len(golomb.encode(values)) < 6 * len(values)


def test_against_plain(spark):
    rng = random.Random(3)
    docs = [(k, "".join(rng.choices("ab \n", k=rng.randint(0, 6)))) for k in range(500)]
    got = exact.copies(spark.createDataFrame(docs, "doc_id long, text string").repartition(7))
    assert sorted(map(tuple, got.collect())) == plain.exact(docs)


def test_odd_rows(odd_docs):
    rows = exact.copies(odd_docs).collect()
    assert len(rows) == 12
    by_id = {r.doc_id: r for r in rows if r.doc_id is not None and r.doc_id != 9}
    assert {by_id[k].keep_id for k in (1, 2, 3)} == {3} and by_id[1].group_size == 4
    assert {by_id[k].keep_id for k in (4, 5, 6)} == {6} and by_id[6].kept and by_id[4].group_size == 4
    assert sorted(r.kept for r in rows if r.doc_id == 9) == [False, True]
    assert [r.kept for r in rows if r.doc_id is None] == [False, False]
    assert by_id[7].group_size == 1 and by_id[7].kept


def test_rows_that_stay(odd_docs):
    kept = exact.drop_copies(odd_docs)
    assert kept.columns == odd_docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [3, 6, 7, 8, 9]


def test_empty(no_docs):
    assert exact.copies(no_docs).collect() == []
    assert exact.drop_copies(no_docs).collect() == []


def test_clashing_names_stay(odd_docs, no_docs):
    """Columns named as the helpers' are kept as they are."""
    clash = "*", "'u' AS _uid", "'t' AS _text", "'b' AS _bytes", "1 AS _h", "2 AS _fp", "'s' AS _spans", "3 AS _base"
    got = exact.drop_copies(odd_docs.selectExpr(*clash))
    assert got.columns == [*odd_docs.columns, "_uid", "_text", "_bytes", "_h", "_fp", "_spans", "_base"]
    rows = got.collect()
    assert rows and {(r._uid, r._text, r._bytes, r._h, r._fp, r.uid) for r in rows} == {("u", "t", "b", 1, 2, "x")}
    assert exact.drop_copies(no_docs.selectExpr(*clash)).collect() == []
