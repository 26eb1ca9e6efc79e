import random
import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from msgmart.llm import packing

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


def ids_of(texts):
    tokenizer = Tokenizer.from_file(VOCABULARY)
    return [x.ids + [0] for x in tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def held(rows, capacity):
    """The number of sequences, each filled without gaps and not beyond the capacity."""
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences)


def test_pieces_are_the_tokenizers(spark):
    texts = ["It's HERE: <|endoftext|> 'tis", "a\x1cb  c d ́x\n\nÀÉ 12345 !?#", "Ｆｕｌｌ 　 ﬁ", "", None, "word " * 3000, "中" * 500, "x" * 300]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = packing.pack(docs, VOCABULARY, 64, ids=True).collect()
    want = {}
    for k, ids in enumerate(ids_of(texts)):
        for p in range(0, len(ids), 64):
            part = np.array(ids[p : p + 64], "<u4").tobytes()
            want[k, p // 64] = (p, len(part) // 4, zlib.crc32(part), part)
    assert {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32, bytes(r.ids)) for r in rows} == want
    held(rows, 64)


def test_few_sequences(spark):
    rng = random.Random(2)
    docs = spark.createDataFrame([(k, "a " * rng.randint(0, 300)) for k in range(1500)], "doc_id long, text string")
    rows = packing.pack(docs, VOCABULARY, 256, packing.Settings(block=400)).collect()
    least = -(-sum(r.length for r in rows) // 256)
    assert least <= held(rows, 256) <= least * 1.02 + 4


def test_assembled(spark):
    docs = spark.createDataFrame([(k, f"text number {k}") for k in range(50)], "doc_id long, text string")
    packed = packing.pack(docs, VOCABULARY, 32, ids=True)
    for r in packing.assemble(packed).collect():
        ids = np.frombuffer(bytes(r.ids), "<u4").tolist()
        want = [i for d in r.doc_ids for i in ids_of([f"text number {d}"])[0]]
        assert ids == want


def evolved(lengths, capacity):
    return packing.evolve(lengths, capacity, [], packing.Settings(generations=30), random.Random(1))[0]


def test_genetic_operators_keep_all_items():
    rng = random.Random(3)
    lengths = [rng.randint(20, 60) for _ in range(120)]
    a, b = packing.Packing(lengths, 100), packing.Packing(lengths, 100)
    a.best_fit(list(range(120)))
    b.best_fit(list(range(119, -1, -1)))
    for child in (packing.crossover(a, b, rng), packing.mutate(a, rng), packing.Packing.of(a.coded(), lengths, 100)):
        assert sorted(i for x in child.bins for i in x) == list(range(120))
        assert all(r == 100 - sum(lengths[i] for i in x) >= 0 for x, r in zip(child.bins, child.room, strict=True))


def test_evolution_beats_its_start():
    rng = random.Random(0)
    lengths = []
    while len(lengths) < 180:  # threes that fill a bin exactly
        x = rng.randint(26, 47)
        y = rng.randint(26, 100 - x - 26)
        lengths += [x, y, 100 - x - y]
    start = packing.Packing(lengths, 100)
    start.best_fit(sorted(range(len(lengths)), key=lambda i: -lengths[i]))
    assert 60 <= len(evolved(lengths, 100).bins) <= len(start.bins)


def test_odd_rows(odd_docs, no_docs):
    rows = packing.pack(odd_docs, VOCABULARY).collect()
    held(rows, 2048)
    assert sum(r.doc_id == 9 for r in rows) == 2 and sum(r.doc_id is None for r in rows) == 2
    assert [(r.start, r.length) for r in rows if r.doc_id == 4] == [(0, 1)]
    assert packing.pack(no_docs, VOCABULARY).collect() == []


def test_words_are_the_tokenizers():
    """Marks, apostrophes, odd blanks and letters of other scripts, one by one and together."""
    import itertools

    import pyarrow as pa

    parts = ["don't", "'tis", "it's", "dogs'", "'", '"Quote"', "a.b", "x,,", "###", "Ofth###", "ß", "ÀÉ,", "µm", "ªº.", "İ", "ﬁ", "é", "12ab3", "a\x85b", "a\xa0b.", "x\x1cy", "Ⅷ", "中文。", "😀!", "<|endoftext|>", "o’clock", "́", "The`", "no_w", "tag>"]
    texts = [*parts, " ".join(parts), "", "  \t", " lead", "trail \n", *(a + b for a, b in itertools.product(parts, repeat=2))]
    words = packing.Words(VOCABULARY)
    assert words.direct
    got = [np.frombuffer(x, "<u4").tolist() for x in words.blobs(pa.array(texts))]
    assert got == ids_of(texts)


def test_evolution_saves_bins():
    """Lengths that best fit decreasing packs badly: crossover and mutation need fewer bins than it."""
    rng = random.Random(4)
    saved = 0
    for seed in range(6):
        lengths = [rng.randint(150, 520) for _ in range(160)]
        start = packing.Packing(lengths, 1000)
        start.best_fit(sorted(range(len(lengths)), key=lambda i: -lengths[i]))
        settings = packing.Settings(generations=60, population=6, children=4)
        best = packing.evolve(lengths, 1000, [], settings, random.Random(seed))[0]
        assert sorted(i for items in best.bins for i in items) == list(range(len(lengths)))
        assert all(sum(lengths[i] for i in items) <= 1000 for items in best.bins)
        assert len(best.bins) <= len(start.bins)
        saved += len(start.bins) - len(best.bins)
    assert saved > 0
