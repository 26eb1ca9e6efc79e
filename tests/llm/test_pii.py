import random

from msgmart.llm import pii
from msgmart.llm.sieve import BITS

from . import plain


def test_base_spans_against_plain():
    rng = random.Random(9)
    parts = ["a", "B", "@", ".", "-", "_", "+", "1", "22", "255", "256", "0000", "4845168114407329", " ", "(", ")", ".com", "a@b.c", "é", "1.2.3.4", "+1 (017) 555-7713", "٣"]
    for _ in range(20_000):
        text = "".join(rng.choices(parts, k=rng.randint(0, 25)))
        assert pii.base_spans(text) == plain.personal(text)
    for text in ("a@b@c.d.e", "x" * 50_000, "1" * 50_000, "1." * 20_000, "+1" + " " * 20_000, "@" * 5000, "4 8 4 5 1 6 8 1 1 4 4 0 7 3 2 9"):
        assert pii.base_spans(text) == (plain.personal(text) if len(text) < 1000 else [x for x in pii.base_spans(text) if x[1] == 1])


def corpus(spark, more=()):
    rng = random.Random(2)
    word = lambda: "".join(rng.choices("abcdefghijklmnop", k=8))
    rows = []
    for k in range(400):
        words = [word() for _ in range(30)]
        if k % 40 == 0:
            words[10:10] = ["goldfinch", "boss@example.com", "common"]
        if k % 3 == 0:
            words[20:20] = ["common"]
        rows.append((k, " ".join(words)))
    return spark.createDataFrame([*rows, *more], "doc_id long, text string")


def test_disclosing_terms_are_found_everywhere(spark):
    docs = corpus(spark, [(1000, "we met Goldfinch near common ground")])
    rows = {r.doc_id: r for r in pii.annotate(docs, ["doc_id"], pii.Settings(generalise=0.8)).collect()}
    assert len(rows) == 401
    assert rows[1000]._base == "" and rows[1000]._spans == "term:7:16"
    assert [x.split(":")[0] for x in rows[40]._spans.split(",")] == ["term", "email"]
    assert rows[1]._spans == "" == rows[1]._base


def test_copies_prove_nothing(spark):
    text = "the unusual goldfinch wrote to boss@example.com about something quite different"
    docs = corpus(spark).where("doc_id % 40 != 0").unionByName(spark.createDataFrame([(2000 + k, text) for k in range(50)], "doc_id long, text string"))
    assert all(r._spans == r._base for r in pii.annotate(docs, ["doc_id"]).collect())


def test_cleaned():
    assert pii.cleaned("a b@c.de x", [(2, 0, 8)]) == "a <EMAIL> x"
    assert pii.cleaned("call +1 234567890123 now", [(5, 3, 20), (8, 2, 20)]) == "call <PHONE> now"
    assert pii.cleaned("secret word", [(0, 5, 6)]) == " word"


def test_odd_rows(odd_docs, no_docs):
    assert len(pii.annotate(odd_docs, ["doc_id"]).collect()) == 12
    clean = pii.sanitise(odd_docs.selectExpr("*", "9 AS n_chars"))
    assert clean.columns == [*odd_docs.columns, "n_chars"]
    rows = {r.doc_id: r for r in clean.collect()}
    assert rows[4].text is None and rows[4].n_chars == 9 and rows[5].n_chars == 0
    assert pii.annotate(no_docs, ["doc_id"]).collect() == [] and pii.sanitise(no_docs).collect() == []


def test_edited_copies_prove_nothing(spark):
    rng = random.Random(5)
    words = "unusual goldfinch letter wrote about something quite different yesterday evening".split()
    texts = []
    for _ in range(200):
        copy = [w if rng.random() < 0.8 else "".join(rng.choices("abcdefgh", k=7)) for w in words]
        texts.append(" ".join([*copy[:5], "boss@example.com", *copy[5:]]))
    docs = corpus(spark).where("doc_id % 40 != 0").unionByName(spark.createDataFrame([(2000 + k, t) for k, t in enumerate(texts)], "doc_id long, text string"))
    assert all(r._spans == r._base for r in pii.annotate(docs, ["doc_id"]).collect())


def among_others(spark, make, more=4000):
    """The terms found in each of the texts of `make`, which gets a function for other words, among `more` other texts."""
    rng = random.Random(8)
    some = lambda n: " ".join("".join(rng.choices("abcdefghijklmnop", k=8)) for _ in range(n))
    texts = make(some)
    docs = spark.createDataFrame(list(enumerate([*texts, *(some(12) for _ in range(more))])), "doc_id long, text string")
    rows = pii.annotate(docs, ["doc_id"]).where(f"doc_id < {len(texts)}").collect()
    return {r.doc_id: {texts[r.doc_id][a:b] for a, k, b in pii._parsed(r._spans) if k > 3} for r in rows}


def test_equally_strong_terms_all_disclose(spark):
    got = among_others(spark, lambda some: ["ask Maria about it", *(f"{some(12)} Maria Fernanda Lopez Garcia +49 170 5557713 {some(12)}" for _ in range(8))])
    assert got[0] == {"Maria"} and got[1] == {"Maria", "Fernanda", "Lopez", "Garcia"}


def test_copies_and_constant_sides_hide_nothing(spark):
    def texts(some):
        copied = [f"{some(12)} goldfinch boss@example.com {some(12)}" for _ in range(5)]
        return [*(t for t in copied for _ in range(10)), *(f"{some(20)} kingfisher desk@example.com" for _ in range(5)), *(f"first@example.com nightjar {some(20)}" for _ in range(5))]

    got = among_others(spark, texts)
    assert all(got[k] == {"goldfinch"} for k in range(50))
    assert all(got[k] == {"kingfisher"} for k in range(50, 55)) and all(got[k] == {"nightjar"} for k in range(55, 60))


def test_short_and_distant_words_disclose(spark):
    got = among_others(spark, lambda some: [f"Ann {some(20)} boss@example.com {some(20)} kx7 {some(3)}" for _ in range(6)])
    assert all(x == {"Ann", "kx7"} for x in got.values())


def test_clashing_names_stay(odd_docs, no_docs):
    """Columns named as the helpers' are kept as they are."""
    clash = "*", "'u' AS _uid", "'t' AS _text", "'b' AS _bytes", "1 AS _h", "2 AS _fp", "'s' AS _spans", "3 AS _base"
    got = pii.sanitise(odd_docs.selectExpr(*clash))
    assert got.columns == [*odd_docs.columns, "_uid", "_text", "_bytes", "_h", "_fp", "_spans", "_base"]
    rows = got.collect()
    assert rows and {(r._uid, r._text, r._bytes, r._h, r._fp, r.uid) for r in rows} == {("u", "t", "b", 1, 2, "x")}
    assert pii.sanitise(no_docs.selectExpr(*clash)).collect() == []


def test_letters_of_one_template_disclose(spark):
    """A closing block beside words of each letter's own; the more letters, the more is known."""
    for letters in (40, 6):
        got = among_others(spark, lambda some, n=letters: [f"{some(15)} thank you for your time and kind regards Maria Lopez boss@example.com" for _ in range(n)])
        assert all({"Maria", "Lopez"} <= x for x in got.values()) and len(got) == letters


def test_surroundings_of_their_own_against_plain(spark):
    rng = random.Random(6)
    families = [[rng.choice("abcdefghijklmnopqrstuvwxyz") * rng.randint(1, 3) for _ in range(rng.choice([1, 2, 4, 9, 14, 40]))] for _ in range(60)]
    rows = []
    for text in range(500):
        words = [w if rng.random() < 0.9 else rng.choice("xyz") * 5 for w in rng.choice(families)]
        rows.append((text, sorted(rng.sample(range(6), rng.randint(1, 3))), " ".join(words + rng.choice([[], words[:5], ["kind", "regards", "from", "us"]]))))
    owner, want = {}, set()
    split = {t: [b.split()[k : k + 3] for k in range(max(1, len(b.split()) - 2))] for t, _, b in rows}
    for t, entities, _ in rows:
        for e in entities:
            for at, run in enumerate(split[t]):
                owner.setdefault((e, *run), (t, at))
    places = {(e, *place) for (e, *_), place in owner.items()}
    for t, entities, _ in rows:
        n = len(split[t])
        need = min(n, 8, max(4, -(-n // 2)))
        want |= {(e, t) for e in entities for k in range(n - need + 1) if all((e, t, k + i) in places for i in range(need))}
    got = pii.own_surroundings(spark.createDataFrame(rows, "text long, entities array<long>, body string").repartition(5)).collect()
    assert {tuple(r) for r in got} == want and len(got) == len(want) and 20 < len(want) < 900


def test_disclosure_against_plain(spark):
    """Terms of 500 texts, with whole and edited copies and letters of one template, against the definition."""
    rng = random.Random(12)
    vocabulary = ["".join(rng.choices("abcdefghijkmnop", k=6)) for _ in range(300)]
    texts = []
    for k in range(500):
        words = rng.choices(vocabulary, k=rng.randint(15, 30))
        if k % 9 == 0:
            words[5:5] = [f"name{k % 4}", f"box{k % 4}@example.com"]
        if k % 20 == 0:
            words += ["kind", "regards", "from", "Office", "+49 170 5557713"]
        texts.append(" ".join(words))
        if k % 25 == 0:
            texts += [texts[-1]] * 3 + [" ".join(w if rng.random() < 0.9 else "edit" for w in words) for _ in range(3)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    settings = pii.Settings(generalise=0.6, remove=0.9)
    rows = pii.annotate(docs, ["doc_id"], settings).collect()
    got = {(r.doc_id, a, b) for r in rows for a, k, b in pii._parsed(r._spans) if k > 3}
    found = plain.disclosing(texts, settings.support, settings.generalise)
    want = {(k, a, b) for k, text in enumerate(texts) for a, b, word in plain.terms(text) if word in found}
    assert found and got == want


def test_passing_words_against_plain(monkeypatch):
    """Terms that pass a filter and their places, cut at bytes and searched for, as the words of the text give them."""
    rng = random.Random(14)
    parts = ["Ab", "ab", "B", "7", "é", "É", "ß", "İ", "Σ", "σ", "ς", "ſ", "\u212a", "中", "_", "-", "'", " ", "\n", "\x1c", "\x85", "\u2003", "\u0301", ".", "😀"]
    texts = ["", *("".join(rng.choices(parts, k=rng.randint(1, 40))) for _ in range(4000)), "ab " * 100 + " ".join(f"w{k}" for k in range(90))]
    words = sorted({m[0].lower() for text in texts for m in pii.WORD.finditer(text)})
    wanted = {pii._hash(w) for w in words[::2]}
    bitmap = bytearray(1 << (BITS - 3))
    for h in wanted:
        cell = (h >> (64 - BITS)) & ((1 << BITS) - 1)
        bitmap[cell >> 3] |= 1 << (cell & 7)
    for size in (50, 8_000_000):
        monkeypatch.setattr(pii, "SLICE", size)
        got = list(pii.passing(bytes(bitmap), texts))
        assert [text for text, _ in got] == texts
        for text, terms in got:
            want = [(m.start(), m.end(), h) for m in pii.WORD.finditer(text) if pii.passes_one(bitmap, h := pii._hash(m[0].lower()))]
            assert {h for _, _, h in want} == set(terms.values()) and pii._places(text, terms) == want


def test_no_task_takes_two_workers(spark):
    """Python functions one behind the other in one stage would each hold a worker of the executor."""
    letters = spark.range(20).selectExpr("2000 + id AS doc_id", "concat(repeat(concat('w', id, ' '), 3), 'kind words of ', 'goldfinch boss@example.com ', array_join(transform(sequence(1, 30), x -> concat('o', id, 'p', x)), ' ')) AS text")
    for docs in (corpus(spark).where("doc_id % 40 != 0"), corpus(spark).where("doc_id % 40 != 0").unionByName(letters)):
        plan = pii.sanitise(docs)._jdf.queryExecution().executedPlan().toString()
        above, seen = [], 0
        for line in plan.split("\n"):
            at = next((k for k, x in enumerate(line) if x.isalpha()), 0)
            above = [(k, name) for k, name in above if k < at]
            name = line[at:].split("(")[0].split(" ")[0]
            if name == "MapInArrow":
                seen += 1
                stage = above[max((k for k, (_, x) in enumerate(above) if x.endswith("Exchange")), default=0) :]
                assert all(x != "MapInArrow" for _, x in stage), plan
            above.append((at, name))
        assert seen in (1, 2), plan
    assert seen == 2


def test_terms_are_cleaned(spark):
    """The cleaned texts are the texts without the spans that annotate finds, terms included."""
    rng = random.Random(3)
    some = lambda n: " ".join("".join(rng.choices("abcdefghijklmnop", k=8)) for _ in range(n))
    texts = [*(f"{some(15)} goldfinch boss@example.com {some(15)}" for _ in range(8)), "ask goldfinch", *(some(12) for _ in range(500)), None, ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    spans = {r.doc_id: pii._parsed(r._spans) for r in pii.annotate(docs, ["doc_id"]).collect()}
    got = {r.doc_id: r.text for r in pii.sanitise(docs).collect()}
    assert got == {k: x if x is None else pii.cleaned(x, spans[k]) for k, x in enumerate(texts)}
    assert all("<EMAIL>" in got[k] and "goldfinch" not in got[k] for k in range(8)) and "goldfinch" not in got[8]
