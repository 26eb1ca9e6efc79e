"""The registered queries: against their SQL where there is one, else against the plain versions."""

import os
from collections import Counter

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from msgmart.llm import queries

from ..oracle import compare, connect
from . import plain

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    connection = connect(FOLDER)
    yield connection
    connection.close()


@pytest.fixture(scope="module")
def docs(con):
    return con.execute("SELECT doc_id, text FROM documents ORDER BY doc_id").fetchall()


def test_all_are_registered():
    assert {x.split("_")[0] for x in queries.QUERIES} == {f"op{k}" for k in range(1, 14)}
    assert set(queries.QUERIES) | {"pipeline"} <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_agrees_with_sql(spark, con, name):
    assert compare(spark, con, queries.QUERIES[name], queries.ORACLE[name], FOLDER) is None


def test_jaccard(spark, docs):
    got = {r.doc_id: (r.class_id, r.n_links) for r in queries.QUERIES["op3_jaccard_join"](spark, FOLDER).collect()}
    assert got == plain.jaccard(docs)


def test_language(spark, con):
    rows = queries.QUERIES["op4_language_id"](spark, FOLDER).collect()
    known = dict(con.execute("SELECT doc_id, lang FROM documents").fetchall())
    held = [r for r in rows if r.held_out]
    assert held and sum(r.lang_pred == known[r.doc_id] for r in held) >= 0.95 * len(held)


def test_quality(spark, docs):
    rows = {r.doc_id: r for r in queries.QUERIES["op8_quality_rules"](spark, FOLDER).collect()}
    for i, text in docs:
        assert (rows[i].n_words, rows[i].word_chars, rows[i].n_symbols, rows[i].n_dup_lines, rows[i].n_repeat_words) == plain.base_counts(text)


def test_personal_data(spark, docs):
    rows = {r.doc_id: r for r in queries.QUERIES["op9_pii"](spark, FOLDER).collect()}
    kinds = ("email", "ip", "card", "phone")
    for i, text in docs:
        spans = plain.personal(text)
        n = Counter(k for _, k, _ in spans)
        assert (rows[i].n_email, rows[i].n_ip, rows[i].n_card, rows[i].n_phone) == tuple(n[k] for k in range(4))
        assert rows[i].base_sha256 == plain.sha(",".join(f"{kinds[k]}:{a}:{b}" for a, k, b in spans))


def test_bytes_come_back(spark, docs):
    rows = {r.doc_id: r for r in queries.QUERIES["op7_byte_bpe"](spark, FOLDER).collect()}
    assert all(rows[i].decoded_sha256 == plain.sha(text or "") for i, text in docs)


def test_pipeline(spark, docs):
    """What is packed at the end is one of each plain group of copies and near copies."""
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language ID", "exact dedup", "n-gram Jaccard join", "PII", "best-fit packing"]
    identified = [(i, t) for i, t in docs if any(c.isalpha() for c in t or "")]
    staying = {i for i, _, _, kept, _ in plain.exact(identified) if kept}
    groups = plain.jaccard([(i, t) for i, t in identified if i in staying])
    want = {group for group, _ in groups.values()}
    rows = corpus_pipeline.run(spark, FOLDER).collect()
    assert {r.doc_id for r in rows} == want
    assert len({(r.doc_id, r.piece) for r in rows}) == len(rows)


def test_stages_keep_the_columns(spark):
    stage = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns = stage.columns
    for _, function in corpus_pipeline.STAGES[:-1]:
        stage = function(spark, stage, FOLDER)
        assert stage.columns == columns
