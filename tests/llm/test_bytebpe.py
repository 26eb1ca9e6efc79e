import random

import public_tokenizers
import pytest
import tiktoken

from msgmart.llm import bytebpe

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bytebpe.ranks_of(RANKS), special_tokens={})


def round_trip(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = bytebpe.decode(bytebpe.encode(docs, RANKS), RANKS).orderBy("doc_id").collect()
    return [r.ids for r in rows], [bytes(r.bytes).decode() for r in rows], [r.offsets for r in rows]


def test_as_the_library(spark, library):
    rng = random.Random(5)
    parts = ["'", "s", "re", "ve", "ll", "m", "d", "r", "v", " ", "  ", "\n", "\t", "1", "23", "é", "!", "?", "''", "a", "中", "́", "\x1c", "\x85", " ", "😀", "\0", "<|endoftext|>"]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 30))) for _ in range(4000)]
    texts += ["a" * 3000, "\n" * 2000 + "x", " " * 3000, "!" * 2000, "'s" * 500, ""]
    ids, back, offsets = round_trip(spark, texts)
    assert ids == [library.encode_ordinary(x) for x in texts]
    assert back == texts
    for text, own, places in zip(texts, ids, offsets, strict=True):
        assert places == [len(library.decode_bytes(own[:k])) for k in range(len(own))] if len(own) < 50 else True


def test_blocked_scan_is_the_plain_one():
    import numpy as np

    follow, starts = bytebpe.automaton()
    kind = np.random.default_rng(2).integers(0, 9, 5000).astype(np.uint8)
    state, want = 0, []
    for k in kind:
        want.append(bool(starts[k, state]))
        state = follow[k, state]
    assert bytebpe.match_starts(kind).tolist() == want


def test_long_and_short_merges_agree():
    ranks = bytebpe.ranks_of(RANKS)
    merger = bytebpe.Merger(ranks)
    rng = random.Random(8)
    pieces = [bytes(rng.choices(b"etaoin shrdlu", k=rng.randint(1, 40))) for _ in range(2000)]
    import array

    for piece, ids in zip(pieces, merger.merge(pieces), strict=True):
        assert ids == array.array("i", [ranks[piece]] if piece in ranks else bytebpe._merge_long(piece, ranks)).tobytes()


def test_odd_rows(odd_docs, no_docs, library):
    rows = bytebpe.encode(odd_docs, RANKS).collect()
    assert len(rows) == 12
    assert all(r.ids == [] for r in rows if r.doc_id in (4, 5))
    assert bytebpe.decode(bytebpe.encode(no_docs, RANKS), RANKS).collect() == []
