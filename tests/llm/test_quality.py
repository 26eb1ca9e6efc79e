import random
import string

import zstandard

from msgmart.llm import quality

from . import plain


def prose(n, seed=1):
    rng = random.Random(seed)
    parts = "the of an er in re on at th st ing tion and nd ou ea ha is or it".split()
    return " ".join("".join(rng.choices(parts, k=rng.randint(1, 4))) for _ in range(n))


def test_counts_against_plain(spark):
    rng = random.Random(7)
    texts = ["".join(rng.choices(["a", "b", "cc", "#", "$", " ", " ", "\n", "\t", "é", "\x85"], k=rng.randint(0, 120))) for _ in range(600)] + [None, ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in quality.measure(docs).collect():
        want = plain.base_counts(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert not (r.kept and r.base_failed)


def test_verdicts(spark):
    rng = random.Random(3)
    noise = " ".join("".join(chr(rng.randint(0x21, 0x2FFF)) for _ in range(8)) for _ in range(900))
    mixed = " ".join(f"{a} {b}" for a, b in zip(["spam"] * 4000, map(str, range(4000)), strict=True))
    texts = [prose(60), prose(400), prose(9000), noise, mixed]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in quality.measure(docs).collect()}
    assert [got[k].kept for k in range(3)] == [True] * 3
    assert not got[3].base_failed and not got[3].kept and got[3].ratio > 0.6


def test_bands_by_length():
    settings = quality.Settings()
    assert settings.within(50, 1.2) and not settings.within(50_000, 0.9) and not settings.within(50_000, 0.01)


def in_words(letters, n, rng):
    return " ".join("".join(rng.choices(letters, k=8)) for _ in range(n // 9 + 1))[:n]


def test_noise_and_repetition_of_every_length_are_outside():
    rng, settings, packer = random.Random(4), quality.Settings(), zstandard.ZstdCompressor(level=3)
    for n in (250, 300, 499, 500, 800, 999, 3000, 20_000):
        for letters in (string.printable[:94], string.ascii_letters + string.digits + "+/"):
            ratio, chunks, outside = quality.ratios(in_words(letters, n, rng).encode(), settings, packer)
            assert not settings.within(n, ratio) and outside == chunks
        repeated, _, _ = quality.ratios(("the same again " * n)[:n].encode(), settings, packer)
        clean, chunks, outside = quality.ratios(prose(n)[:n].encode(), settings, packer)
        assert not settings.within(n, repeated) and settings.within(n, clean) and outside == 0


def test_a_document_may_not_be_noise_or_repetition_in_part(spark):
    rng = random.Random(4)
    noise = [in_words(string.printable[:94], 4096, rng) for _ in range(5)]
    clean = [prose(2000, k)[:4096] for k in range(15)]
    texts = ["".join(clean[:10]), "".join(clean[:5] + noise), "".join(clean[:5] + ["the same again " * 1366]), "".join(clean + noise), in_words(string.printable[:94], 800, rng)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in quality.measure(docs).collect()}
    assert not any(got[k].base_failed for k in (0, 1, 3, 4))
    assert [got[k].kept for k in range(5)] == [True, False, False, False, False]


def test_odd_rows(odd_docs, no_docs):
    rows = quality.measure(odd_docs).collect()
    assert len(rows) == 12
    assert all(r.base_failed and not r.kept and r.n_words == 0 for r in rows if r.doc_id in (4, 5, 6))
    assert quality.measure(no_docs).collect() == []
