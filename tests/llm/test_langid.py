import itertools
import zlib

import numpy as np

from msgmart.llm import langid

WORDS = {"xa": "the and of with there ing tion", "xb": "die und der mit nicht ung keit", "xc": "les des avec pour tion eaux une"}


def labelled(spark):
    rows = [(k, " ".join((WORDS[lang] + " ").split() * (1 + k % 5)), lang) for k, lang in enumerate(list(WORDS) * 40)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


def test_predictions(spark):
    model = langid.train(labelled(spark))
    assert model.languages == ["xa", "xb", "xc"]
    texts = [WORDS["xa"], WORDS["xb"], f"{WORDS['xb']} {WORDS['xb']} {WORDS['xc']}", "12 34 !?", "", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in langid.predict(docs, model, ["doc_id"]).collect()}
    assert [got[k].lang_pred for k in range(6)] == ["xa", "xb", "xb", "und", "und", "und"]
    assert got[0].languages == ["xa"] and got[0].score == 1.0
    assert got[2].languages == ["xb", "xc"] and 0.55 < got[2].score < 0.8
    assert got[3].score == 0.0


def test_shares_are_those_of_the_mixture():
    rng = np.random.default_rng(1)
    likely = rng.normal(0, 4, (400, 2))
    part, value = langid.shares(likely, np.ones(400))
    grid = [float(np.log(np.exp(likely) @ [p, 1 - p]).sum()) for p in np.linspace(0.01, 0.99, 99)]
    assert value >= max(grid) - 1e-3 and abs(part.sum() - 1) < 1e-9


def test_a_sample_is_bounded_and_nothing_can_be_learned(spark):
    some = langid.train(labelled(spark), per_language=5)
    assert some.languages == ["xa", "xb", "xc"]
    nothing = langid.train(labelled(spark).where("false"))
    row = langid.predict(labelled(spark).limit(1), nothing, ["doc_id"]).first()
    assert (row.lang_pred, row.score, row.languages) == ("und", 0.0, [])


def test_trigrams_stay_within_words():
    one, _ = langid.trigrams(["ab"])
    both, starts = langid.trigrams(["ab", "c", "ab"])
    assert starts.tolist() == [0, 2, 3] and both[:2].tolist() == one.tolist() == both[3:].tolist()


def test_held_out(spark):
    rows = spark.range(100).withColumnRenamed("id", "doc_id").select("doc_id", langid.held_out().alias("h")).collect()
    assert all(r.h == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)


def test_odd_rows(spark, odd_docs, no_docs):
    model = langid.train(odd_docs)
    rows = langid.predict(odd_docs, model, ["doc_id"]).collect()
    assert len(rows) == 12
    kept = langid.keep_identified(odd_docs, model)
    assert kept.columns == odd_docs.columns
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in kept.collect()) == [(False, k) for k in (1, 2, 3, 7, 8, 9, 9)] + [(True, 0)]
    assert langid.predict(no_docs, model, ["doc_id"]).collect() == [] and langid.train(no_docs).languages == []


def test_no_language_is_left_out(spark):
    """300 values of lang, each with letters of its own: all are learned and told apart by a smaller table."""
    own = lambda k: " ".join(chr(0x4E00 + 40 * k + i) * 2 + chr(0x4E00 + 40 * k + i + 1) for i in range(30))
    docs = spark.createDataFrame([(k * 10 + i, own(k), f"l{k:03}") for k in range(300) for i in range(3)], "doc_id long, text string, lang string")
    model = langid.train(docs)
    assert model.languages == [f"l{k:03}" for k in range(300)] and model.logs.size <= langid.CELLS
    got = langid.predict(docs.where("doc_id % 10 = 0"), model, ["doc_id", "lang"]).collect()
    assert len(got) == 300 and sum(r.lang == r.lang_pred for r in got) >= 297


def test_language_sets_against_all_subsets():
    """The set found by adding languages is the best of all subsets, where they are told apart."""
    rng = np.random.default_rng(4)
    for size in (1, 2, 3):
        likely = rng.normal(-12, 1, (300, 5))
        for k in range(300):
            likely[k, k % size] += 8
        chosen, _ = langid.mixture(likely, np.ones(300), 1.0)
        subsets = [s for r in range(1, 6) for s in itertools.combinations(range(5), r)]
        worth = {s: langid.shares(likely[:, s], np.ones(300), 300)[1] - (len(s) - 1) * 0.5 * np.log(300) for s in subsets}
        assert tuple(sorted(chosen)) == max(worth, key=worth.get) == tuple(range(size))
