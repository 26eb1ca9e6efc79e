import random
import time

import numpy as np
import pyarrow as pa
import pytest

from msgmart.llm import substring, texts

from . import plain


def rows(frame):
    return sorted((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in frame.collect())


def test_levels():
    assert substring.levels(4, 13) == [4, 8, 13]
    assert substring.levels(13, 13) == [13]


def test_against_plain(spark):
    rng = random.Random(4)
    shared = ["a b c d e f g h i j k l m n".split(), [f"s{k}" for k in range(40)], ["x"] * 30]
    docs = []
    for k in range(300):
        words = []
        for _ in range(rng.randint(0, 4)):
            words += rng.choice(shared)[: rng.randint(5, 40)] if rng.random() < 0.5 else [f"u{rng.randint(0, 10**6)}" for _ in range(rng.randint(1, 20))]
        docs.append((k, rng.choice([" ", "\n", "\t "]).join(words)))
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    assert rows(substring.remove_repeats(frame)) == plain.substring(docs)
    assert rows(substring.remove_repeats(frame, base=7)) == plain.substring(docs)
    assert rows(substring.remove_repeats(frame, length=5, base=5)) == plain.substring(docs, 5)


def test_odd_rows(odd_docs, no_docs):
    out = substring.remove_repeats(odd_docs).collect()
    assert len(out) == 12
    removed = {(r.doc_id, r.n_words): r.n_removed for r in out}
    assert removed[1, 15] == 0 and removed[2, 15] == 15 and removed[3, 15] == 15
    assert removed[None, 15] == 15 and removed[None, 0] == 0
    assert removed[8, 30001] == 30_000  # all but the last word
    assert sum(r.doc_id == 9 and r.n_removed == 0 for r in out) == 2  # rows of one id leave each other alone
    assert substring.remove_repeats(no_docs).collect() == []


@pytest.mark.parametrize("size", [1, 40, 1 << 19])
def test_words_of_slices(monkeypatch, size):
    """Words of texts that touch, odd bytes, zeros, and words around the lengths at which hashing changes."""
    monkeypatch.setattr(texts, "SLICE", size)
    rng = random.Random(5)
    docs = [b"", b" \t\n\x0b\x0c\r", b"a", b"a", b"a\0", b"\0", b"x" * 8 + b" " + b"x" * 9, b"", b"\x1c\x85\xa0", *(b"y" * n + b" z" for n in (7, 16, 63, 64, 65, 300))]
    docs += [bytes(rng.choice(b"ab\0\xff \n") for _ in range(rng.randint(0, 90))) for _ in range(300)]
    hashes: dict[bytes, int] = {}
    at = 0
    for first, end, data, bounds in texts.slices(pa.array([b"before", *docs], pa.binary()).slice(1)):
        assert first == at
        starts, ends, sizes = texts.word_places(data, bounds)
        words = [data[a:b].tobytes() for a, b in zip(starts, ends, strict=True)]
        assert words == [w for d in docs[first:end] for w in d.split()]
        assert sizes.tolist() == [len(d.split()) for d in docs[first:end]]
        for word, h in zip(words, texts.place_hashes(data, starts, ends).tolist(), strict=True):
            assert hashes.setdefault(word, h) == h
        kept = np.array([rng.random() < 0.5 for _ in words], bool)
        text, to = texts.joined(data, starts, ends, sizes, kept)
        left = iter(kept.tolist())
        assert [text[a:b].tobytes() for a, b in zip(to[:-1], to[1:], strict=True)] == [b" ".join([w for w in d.split() if next(left)]) for d in docs[first:end]]
        at = end
    assert at == len(docs)
    assert len(set(hashes.values())) == len(hashes)


def test_words_are_not_hashed_one_by_one():
    """A pass over texts of rare words takes less than looking up each of their words."""
    rng = random.Random(6)
    batch = pa.RecordBatch.from_arrays([pa.array([b" ".join(b"%x" % rng.getrandbits(30) for _ in range(400)) for _ in range(1000)], pa.binary())], names=["text"])

    def seconds(step):
        begun = time.process_time()
        step()
        return time.process_time() - begun

    def one_by_one():
        hashes = texts.word_hashes()
        for text in batch.column(0).to_pylist():
            hashes(text)

    send = substring._send([4], [], 5)
    assert min(seconds(lambda: list(send([batch]))) for _ in range(3)) < min(seconds(one_by_one) for _ in range(3))


def test_tasks_follow_the_input(spark, monkeypatch):
    docs = [(k, " ".join(f"w{(k // 2 * 31 + j) % 500}" for j in range(30))) for k in range(200)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    size = sum(len(t) for _, t in docs)
    monkeypatch.setattr(substring, "CHUNK_BYTES", size / 7)
    out = substring.remove_repeats(frame)
    assert rows(out) == plain.substring(docs)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(chunk" in plan and "hashpartitioning(owner" in plan
    assert plan.count(", 14), REPARTITION_BY_NUM") >= 3
