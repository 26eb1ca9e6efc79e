"""Personal data: fixed patterns, and terms that give protected entities away.

Patterns find emails, addresses, cards and phone numbers. What they find are the protected
entities. A term (a word of letters and digits outside of these) that stands in the same text as an
entity discloses it as far as knowing the term makes the entity more likely. Counted over the whole corpus,

    disclosure = log(P(entity | term) / P(entity)) / -log P(entity)

is 1 if the term never appears without the entity, and 0 if it says nothing about it. P(entity | term)
is the share of the texts with the term in which the entity stands too. Everything is counted in
distinct texts (a hash of the text without case and differences of white space), so repeated
documents count once for the entity, for the term and for both.

Edited copies prove nothing either, while letters of one template do: a term and an entity need `support`
texts that have surroundings of their own. Among the texts with an entity, each run of `WINDOW` words belongs to
the text of the least hash that has it. A text has surroundings of its own if `OWN` runs in a row belong to it (of
a shorter text half of its runs, but no fewer than four, or all). So what a template repeats counts once, and changed
words inside of a copy are too short to count. There is no limit on distance, length of words or the
terms of an entity. Terms of a disclosure of `generalise` or more are replaced by a
placeholder, those of `remove` or more are deleted, wherever they stand.

A null text is empty (and stays null when cleaned). Rows are independent but for the corpus counts;
repeated rows and null ids pass through, an empty table gives an empty result. Columns that are
not asked for are not read; names that begin with an underscore are free for use here.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from msgmart.llm.scratch import Scratch
from msgmart.llm.sieve import passes, passes_one, sieve
from msgmart.llm.skew import join_groups
from msgmart.llm.texts import few, own_names, row_numbers, tidy

KINDS = ("email", "ip", "card", "phone")
#: Spans of terms: replaced, deleted.
TERMS = ("term", "key")
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
#: A match can only begin where a run of digits does, so that long runs are read once.
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGITS = re.compile(r"[^0-9]")
WORD = re.compile(r"[^\W_]+")
ROWS = 2000
#: Characters of texts, the last one whole, whose distinct words are judged together.
SLICE = 8_000_000


@dataclass(frozen=True)
class Settings:
    support: int = 3
    generalise: float = 0.9
    remove: float = 0.98


#: Words of a run, and how many runs in a row make surroundings of a text's own.
WINDOW, OWN = 3, 8
#: The entities of a text are dealt to so many rows, so that a text with very many of them is the work of many tasks.
DEALS = 64


def luhn(digits: str) -> bool:
    total = 0
    for k, x in enumerate(reversed(digits)):
        x = int(x) * (1 + k % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """The matches of EMAIL. One can only begin where the characters allowed before an @ do."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        found = EMAIL.match(text, start) if start < at else None
        if found:
            done = found.end()
            yield start, done
        at = text.find("@", max(done, at + 1))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of all base spans, in order."""
    spans = [(a, 0, b) for a, b in emails(text)]
    for m in IP.finditer(text):
        if all(len(x := part.lstrip("0")) <= 3 and int(x or 0) <= 255 for part in m[0].split(".")):
            spans.append((m.start(), 1, m.end()))
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 14 and 14 <= len(digits := DIGITS.sub("", m[0])) <= 19 and luhn(digits):
            spans.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 10 <= len(DIGITS.sub("", m[0])) <= 15:
                spans.append((m.start(), 3, m.end()))
    return sorted(spans)


def written(spans: list[tuple[int, int, int]]) -> str:
    names = (*KINDS, *TERMS)
    return ",".join(f"{names[k]}:{a}:{b}" for a, k, b in spans)


def _hash(x: str) -> int:
    return xxhash.xxh3_64_intdigest(x.encode()) - (1 << 63)


def _same(text: str) -> str:
    """What texts that count as one have in common."""
    return " ".join(text.lower().split())


@tidy
def _entities(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The hash of each text and its entities."""
    for batch in few(batches):
        texts, found = [], []
        for text in batch.column(0).to_pylist():
            there = set()
            for start, kind, end in base_spans(text):
                value = text[start:end].lower() if kind == 0 else text[start:end] if kind == 1 else DIGITS.sub("", text[start:end])
                there.add(_hash(f"{kind} {value}"))
            texts.append(_hash(_same(text)))
            found.append(list(there))
        yield pa.RecordBatch.from_arrays([pa.array(texts, pa.int64()), pa.array(found, pa.list_(pa.int64()))], names=["text", "entities"])


def _bodies(filter_):
    """Texts that pass the filter."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in few(batches):
            rows = [(h, text) for text in batch.column(0).to_pylist() if passes_one(filter_.value, h := _hash(_same(text)))]
            yield pa.RecordBatch.from_arrays([pa.array([h for h, _ in rows], pa.int64()), pa.array([x for _, x in rows], pa.string())], names=["text", "body"])

    return run


#: Terms that a task counts before it sends them on.
COUNTED = 200_000


def _inside(text: str, spans: list[tuple[int, int, int]]) -> bytearray:
    """For each character whether a span covers it."""
    inside = bytearray(len(text))
    for a, _, b in spans:
        inside[a:b] = b"\1" * (b - a)
    return inside


def _outside(text: str, words: list[re.Match]) -> list[re.Match]:
    """The words that are no part of a base span."""
    if not words or not (spans := base_spans(text)):
        return words
    inside = _inside(text, spans)
    return [m for m in words if not any(inside[m.start() : m.end()])]


@tidy
def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each row's text and entities, and the hashes of its runs of words in order; a text of fewer words is one run."""
    for batch in few(batches):
        runs = []
        for body in batch.column("body").to_pylist():
            words = [m[0] for m in WORD.finditer(body.lower())]
            runs.append([_hash(" ".join(words[k : k + WINDOW])) for k in range(max(1, len(words) - WINDOW + 1))])
        kept = ("text", "entities")
        yield pa.RecordBatch.from_arrays([*(batch.column(x) for x in kept), pa.array(runs, pa.list_(pa.int64()))], names=[*kept, "runs"])


def own_surroundings(rows: DataFrame) -> DataFrame:
    """entity, text: the texts with surroundings of their own, of `rows` (text, entities, body).

    A run that many texts share is reduced to its least text in every task before the shuffle.
    """
    runs = rows.select("text", "entities", "body").mapInArrow(_windows, "text long, entities array<long>, runs array<long>")
    runs = runs.select("text", "entities", F.size("runs").alias("of"), F.posexplode("runs").alias("at", "run"))
    runs = runs.select(F.explode("entities").alias("entity"), "run", F.struct("text", "at", "of").alias("place"))
    owned = runs.groupBy("entity", "run").agg(F.min("place").alias("place")).select("entity", "place.*")
    owned = owned.groupBy("entity", "text").agg(F.max("of").alias("of"), F.array_sort(F.collect_list("at")).alias("ats"))
    start = F.struct(F.lit(-2).alias("last"), F.lit(0).alias("now"), F.lit(0).alias("best"))

    def step(seen: Column, at: Column) -> Column:
        now = F.when(at == seen["last"] + 1, seen["now"] + 1).otherwise(1)
        return F.struct(at.alias("last"), now.alias("now"), F.greatest(seen["best"], now).alias("best"))

    longest = F.aggregate("ats", start, step, lambda seen: seen["best"])
    wanted = F.least(F.col("of"), F.lit(OWN), F.greatest(F.lit(4), F.ceil(F.col("of") / 2).cast("int")))
    return owned.where(longest >= wanted).select("entity", "text")


@tidy
def _together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """In how many distinct texts each term stands with each entity of `known`, and how many of them prove it, counted by task."""
    memo: dict[str, int] = {}
    counts: Counter[tuple[int, int, int, bool]] = Counter()

    def told() -> pa.RecordBatch:
        columns = [*zip(*counts, strict=True)] or [[]] * 4
        types = pa.int64(), pa.int64(), pa.int64(), pa.bool_()
        arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
        return pa.RecordBatch.from_arrays([*arrays, pa.array(counts.values(), pa.int64())], names=["entity", "alone", "term", "proves", "n"])

    for batch in few(batches):
        for known, text in zip(batch.column("known").to_pylist(), batch.column("body").to_pylist(), strict=True):
            terms = {_term(m[0], memo) for m in _outside(text, list(WORD.finditer(text)))}
            for x in known:
                counts.update((x["entity"], x["alone"], h, x["proves"]) for h in terms)
                if len(counts) > COUNTED:
                    yield told()
                    counts.clear()
    yield told()


@tidy
def _met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """In how many of the texts each term stands, counted by task."""
    memo: dict[str, int] = {}
    counts: Counter[int] = Counter()

    def told() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.int64()), pa.array(counts.values(), pa.int64())], names=["term", "n"])

    for batch in few(batches):
        for text in batch.column(0).to_pylist():
            counts.update({_term(m[0], memo) for m in _outside(text, list(WORD.finditer(text)))})
            if len(counts) > COUNTED:
                yield told()
                counts.clear()
    yield told()


def _disclosure(members: Column, total: int) -> Column:
    """How far a term of so many texts, `together` of them with its entity, gives away that entity, which `alone` of all texts have."""
    likely = F.least(F.lit(1.0), F.col("together") / members)
    rarity = F.greatest(F.lit(1e-9), -F.log(F.least(F.lit(1.0), F.col("alone") / F.lit(max(1, total)))))
    return 1 + F.log(likely) / rarity


#: Capitals to small letters, all other ASCII characters that are no digits or small letters to spaces.
PLAIN = bytes(x | 32 if 65 <= x <= 90 else x if x >= 128 or chr(x).isalnum() else 32 for x in range(256))


def _judged(filter_: bytes, pieces: set[bytes]) -> dict[bytes, list[tuple[str, int]]]:
    """Pieces with terms that pass the filter: the terms, and their hashes."""
    order = [(x, x) for x in pieces if x.isascii()]
    order += [(x, w.encode()) for x in pieces if not x.isascii() for w in {w.lower() for w in WORD.findall(x.decode())}]
    digests = np.fromiter((xxhash.xxh3_64_intdigest(w) for _, w in order), np.uint64, len(order))
    hashes = (digests ^ np.uint64(1 << 63)).view(np.int64)
    found: dict[bytes, list[tuple[str, int]]] = {}
    for k in np.flatnonzero(passes(filter_, hashes)).tolist():
        piece, word = order[k]
        found.setdefault(piece, []).append((word.decode(), int(hashes[k])))
    return found


def passing(filter_: bytes, texts: list[str]) -> Iterator[tuple[str, dict[str, int]]]:
    """Each text with those of its terms that pass the filter, and their hashes.

    Texts are cut, as bytes, at all ASCII characters that no word contains, and each distinct piece of some texts is
    judged once for all of these; only pieces beyond ASCII are looked at more closely.
    """
    at = 0
    while at < len(texts):
        end, size = at, 0
        while end < len(texts) and size < SLICE:
            size += len(texts[end])
            end += 1
        sets = [set(text.encode().translate(PLAIN).split()) for text in texts[at:end]]
        judged = _judged(filter_, set().union(*sets))
        pieces = set(judged)
        for text, there in zip(texts[at:end], sets, strict=True):
            yield text, dict(x for piece in there & pieces for x in judged[piece])
        at = end


def _places(text: str, terms: dict[str, int]) -> list[tuple[int, int, int]]:
    """Start, end and hash of the words that are one of the terms, in order.

    Few terms are searched for one by one, where small letters have the places of the text: one capital becomes two
    characters, and the form of another depends on what follows the word.
    """
    low = text.lower()
    if len(terms) > 50 or len(low) != len(text) or "\u03a3" in text:
        words = ((m.start(), m.end(), terms.get(m[0].lower())) for m in WORD.finditer(text))
        return [x for x in words if x[2] is not None]
    found = []
    for term, h in terms.items():
        at = low.find(term)
        while at >= 0:
            end = at + len(term)
            if not (low[at - 1 : at].isalnum() or low[end : end + 1].isalnum()):
                found.append((at, end, h))
            at = low.find(term, end)
    return sorted(found)


def _frequency(filter_, repeated):
    """How many texts have each term that passes the filter, counted by task; texts that may be repeated are named."""

    def told(counts: Counter[tuple[int, int | None]]) -> pa.RecordBatch:
        columns = [[k[0] for k in counts], [k[1] for k in counts], list(counts.values())]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["term", "text", "n"])

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[tuple[int, int | None]] = Counter()
        for batch in few(batches, 2 * ROWS):
            for text, hits in passing(filter_.value, batch.column(0).to_pylist()):
                terms = set(hits.values())
                if hits and (spans := base_spans(text)):
                    inside = _inside(text, spans)
                    terms = {h for a, b, h in _places(text, hits) if not any(inside[a:b])}
                if terms:
                    name = h if passes_one(repeated.value, h := _hash(_same(text))) else None
                    counts.update({(h, name) for h in terms})
                if len(counts) > COUNTED:
                    yield told(counts)
                    counts.clear()
        yield told(counts)

    return run


def _term(word: str, memo: dict[str, int], limit: int = 200_000) -> int:
    if (h := memo.get(word)) is None:
        if len(memo) >= limit:
            memo.clear()
        h = memo[word] = _hash(word.lower())
    return h


def _text() -> Column:
    return F.coalesce(F.col("text").cast("string"), F.lit("")).alias("_text")


def disclosing_terms(docs: DataFrame, settings: Settings, scratch: Scratch) -> DataFrame | None:
    """term (a hash), kind ("term" or "key"), members (documents with it); None if there are none."""
    seen = scratch.keep(docs.select(_text()).mapInArrow(_entities, "text long, entities array<long>"), "entities")
    # what stands in fewer texts than the support can have no term
    stands = seen.select("text", F.explode("entities").alias("entity")).distinct()
    alone = scratch.keep(stands.groupBy("entity").agg(F.count(F.lit(1)).alias("alone")).where(F.col("alone") >= settings.support), "alone")
    many = alone.agg(F.sum("alone")).first()[0]
    if not many:
        return None
    stands = scratch.keep(join_groups(stands, alone, ["entity"], "alone", many), "stands")
    texts = stands.select("text").distinct()
    bodies = docs.select(_text()).mapInArrow(_bodies(sieve(texts, "text")), "text long, body string").join(texts, "text", "left_semi")
    bodies = scratch.keep(bodies.groupBy("text").agg(F.min("body").alias("body")), "bodies")
    dealt = stands.groupBy("text", F.pmod(F.xxhash64("entity"), F.lit(DEALS)).alias("deal")).agg(F.collect_list("entity").alias("entities"))
    dealt = dealt.join(bodies, "text").repartition("text", "deal")
    proofs = scratch.keep(own_surroundings(dealt).withColumn("proves", F.lit(True)), "proofs")
    enough = proofs.groupBy("entity").agg(F.count(F.lit(1)).alias("proofs")).where(F.col("proofs") >= settings.support)
    wide = scratch.keep(alone.join(enough.select("entity"), "entity"), "wide")
    known = join_groups(stands.drop("alone"), wide, ["entity"], "alone", many).join(proofs, ["entity", "text"], "left")
    known = known.select("text", F.pmod(F.xxhash64("entity"), F.lit(DEALS)).alias("deal"), F.struct("entity", "alone", F.col("proves").isNotNull().alias("proves")).alias("entity"))
    known = known.groupBy("text", "deal").agg(F.collect_list("entity").alias("known")).join(bodies, "text").repartition("text", "deal")
    pairs = known.select("known", "body").mapInArrow(_together, "entity long, alone long, term long, proves boolean, n long")
    proven = F.sum(F.when(F.col("proves"), F.col("n")).otherwise(0))
    pairs = pairs.groupBy("entity", "term").agg(F.max("alone").alias("alone"), F.sum("n").alias("together"), proven.alias("proofs"))
    pairs = scratch.keep(pairs.where(F.col("proofs") >= settings.support), "pairs")
    copies = seen.groupBy("text").agg(F.count(F.lit(1)).alias("copies"))
    total = copies.count()
    # a term stands in at least as many texts as it does among those with an entity; where that is too many already, no scan is needed
    least = bodies.select("body").mapInArrow(_met, "term long, n long").groupBy("term").agg(F.sum("n").alias("least"))
    least = scratch.keep(pairs.groupBy("term").agg(F.count(F.lit(1)).alias("pairs")).join(least, "term"), "least")
    pairs = join_groups(pairs, least, ["term"], "pairs", pairs.count()).where(_disclosure(F.col("least"), total) >= settings.generalise)
    pairs = scratch.keep(pairs.select("entity", "term", "alone", "together"), "possible")
    candidates = scratch.keep(pairs.groupBy("term").agg(F.count(F.lit(1)).alias("pairs")), "candidates")
    if candidates.isEmpty():
        return None
    frequency = docs.select(_text()).mapInArrow(_frequency(sieve(candidates, "term"), sieve(copies.where("copies > 1"), "text")), "term long, text long, n long")
    frequency = frequency.groupBy("term", "text").agg(F.sum("n").alias("n")).groupBy("term").agg(F.sum(F.when(F.col("text").isNull(), F.col("n")).otherwise(1)).alias("members"))
    sized = scratch.keep(candidates.join(frequency, "term"), "frequency")
    rated = join_groups(pairs, sized, ["term"], "pairs", pairs.count()).withColumn("disclosure", _disclosure(F.col("members"), total))
    found = rated.groupBy("term").agg(F.max("disclosure").alias("disclosure"), F.max("members").alias("members")).where(F.col("disclosure") >= settings.generalise)
    kind = F.when(F.col("disclosure") >= settings.remove, TERMS[1]).otherwise(TERMS[0])
    found = scratch.keep(found.select("term", kind.alias("kind"), "members"), "terms")
    return None if found.isEmpty() else found


def _scan(filter_, keep: int):
    """The first `keep` columns, the base spans, and the places of terms that pass the filter."""
    extra = [("_uid", pa.int64()), ("_base", pa.string()), ("_terms", pa.list_(pa.int64())), ("_starts", pa.list_(pa.int32())), ("_ends", pa.list_(pa.int32()))]

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells, numbers = filter_.value if filter_ else None, row_numbers()
        for batch in few(batches, ROWS):
            rows, texts = [], batch.column(keep).to_pylist()
            for text, there in passing(cells, texts) if cells else ((x, None) for x in texts):
                hits = [(h, a, b) for a, b, h in _places(text, there)] if there else []
                rows.append((next(numbers), written(base_spans(text)), *(map(list, zip(*hits, strict=True)) if hits else (None, None, None))))
            columns = [pa.array(c, t) for c, (_, t) in zip(zip(*rows, strict=True), extra, strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:keep], *columns], names=[*batch.schema.names[:keep], *(n for n, _ in extra)])

    return run


def _parsed(spans: str) -> list[tuple[int, int, int]]:
    names = {x: k for k, x in enumerate((*KINDS, *TERMS))}
    return [(int(a), names[k], int(b)) for k, a, b in (x.split(":") for x in spans.split(","))] if spans else []


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Puts confirmed terms, where no base span has the place, among the base spans."""
    for batch in few(batches):
        out = []
        for base, found in zip(batch.column("_base").to_pylist(), batch.column("_found").to_pylist(), strict=True):
            spans = _parsed(base)
            own = _parsed(",".join(found or []))
            taken = [(a, b) for a, _, b in spans]
            spans += [x for x in own if not any(a < x[2] and x[0] < b for a, b in taken)]
            out.append(written(sorted(spans)))
        names = [x for x in batch.schema.names if x != "_found"]
        yield pa.RecordBatch.from_arrays([*(batch.column(x) for x in names), pa.array(out, pa.string())], names=[*names, "_spans"])


def _based(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of a scan without terms: the base spans are all spans."""
    for batch in batches:
        names = batch.schema.names[: batch.schema.get_field_index("_uid")]
        base = batch.column("_base")
        yield pa.RecordBatch.from_arrays([*(batch.column(x) for x in names), base, base], names=[*names, "_base", "_spans"])


Step = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def _in_turn(*steps: Step) -> Step:
    """The steps one behind the other in one worker; Spark would take a worker for each."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for step in steps:
            batches = step(batches)
        yield from batches

    return run


def annotate(docs: DataFrame, columns: list[str], settings: Settings = Settings(), scratch: Scratch | None = None, then: Step | None = None, into: T.StructType | None = None) -> DataFrame:
    """`columns` of `docs`, with _base and _spans: base spans and all spans as kind:start:end, joined by commas.

    Or what the step `then` makes of these, which has the schema `into`.
    """
    scratch = scratch or Scratch(docs.sparkSession, "pii")
    found = disclosing_terms(docs, settings, scratch)
    fields = [docs.schema[x] for x in columns]
    scanned = T.StructType([*fields, T.StructField("_uid", T.LongType()), T.StructField("_base", T.StringType()), *(T.StructField(x, T.ArrayType(t)) for x, t in (("_terms", T.LongType()), ("_starts", T.IntegerType()), ("_ends", T.IntegerType())))])
    source = docs.select(*columns, _text())
    into = into or T.StructType([*fields, T.StructField("_base", T.StringType()), T.StructField("_spans", T.StringType())])
    last = [then] if then else []
    if found is None:
        return source.mapInArrow(_in_turn(_scan(None, len(columns)), _based, *last), into)
    rows = scratch.keep(source.mapInArrow(_scan(sieve(found, "term"), len(columns)), scanned), "scanned")
    open_ = rows.where("_terms is not null")
    hits = open_.select("_uid", F.explode(F.arrays_zip("_terms", "_starts", "_ends")).alias("h")).select("_uid", F.col("h._terms").alias("term"), F.concat_ws(":", "h._starts", "h._ends").alias("place"))
    total = open_.select(F.sum(F.size("_terms"))).first()[0] or 0
    sure = join_groups(hits, found, ["term"], "members", total).groupBy("_uid").agg(F.collect_list(F.concat_ws(":", "kind", "place")).alias("_found"))
    closed = open_.join(sure, "_uid", "left").select(*columns, "_base", "_found").mapInArrow(_in_turn(_merge, *last), into)
    plain = rows.where("_terms is null").select(*columns, "_base", F.col("_base").alias("_spans"))
    return (plain.mapInArrow(_in_turn(then), into) if then else plain).unionByName(closed)


def cleaned(text: str, spans: list[tuple[int, int, int]]) -> str:
    """The text with placeholders for its spans; of overlapping spans one placeholder, that of the first."""
    out, at = [], 0
    names = (*KINDS, *TERMS)
    for start, kind, end in spans:
        if start >= at:
            out.append(text[at:start])
            if names[kind] != "key":
                out.append(f"<{names[kind].upper()}>")
        at = max(at, end)
    out.append(text[at:])
    return "".join(out)


def _clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in few(batches):
        texts = [x if x is None or not s else cleaned(x, _parsed(s)) for x, s in zip(batch.column("text").to_pylist(), batch.column("_spans").to_pylist(), strict=True)]
        names = [x for x in batch.schema.names if x not in ("_base", "_spans")]
        yield pa.RecordBatch.from_arrays([pa.array(texts, batch.schema.field("text").type) if x == "text" else batch.column(x) for x in names], names=names)


def sanitise(docs: DataFrame, settings: Settings = Settings(), scratch: Scratch | None = None) -> DataFrame:
    """`docs` with cleaned texts, and n_chars, where it is a column, of the texts as cleaned."""
    names = docs.columns
    docs = own_names(docs, ("doc_id", "text", "n_chars"))
    rows = annotate(docs, docs.columns, settings, scratch, _clean, docs.schema)
    if "n_chars" in docs.columns:
        rows = rows.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text").cast(docs.schema["n_chars"].dataType)))
    return rows.select(*docs.columns).toDF(*names)
