"""Language identification by a mixture of languages in each document.

Training counts the letter trigrams of every language over a bounded sample of labelled rows. A
document is then a mixture: each of its words was drawn from one of the languages, with a
likelihood that comes from its trigrams. Expectation-maximisation estimates the languages' shares.
Which languages take part is decided by penalised likelihood: beginning with the best single one, a
language joins while the likelihood grows by more than `penalty` times half the log of the number of
words. A document can't gain more than its words' best likelihoods allow; where that is too little,
the search ends without another fit.

A null text, one without letters, and every text if nothing could be learned is "und" with score
0. Rows are independent; repeated rows and null ids pass through, an empty table gives an empty
result. Columns other than the id and the text don't enter a prediction.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from msgmart.llm.texts import tidy

#: Trigram buckets, and the count that every bucket has before any text.
BUCKETS, PRIOR = 1 << 17, 0.05
#: Cells (buckets x languages) of a model. With more than CELLS / BUCKETS = 64 languages, neighbouring buckets fall together.
CELLS = 1 << 23
#: Words whose likelihoods a task remembers, the numbers that they may take (words x languages), and documents worked on together.
REMEMBERED, NUMBERS, ROWS = 200_000, 1 << 24, 400
UNKNOWN = "und"


@dataclass(frozen=True)
class Model:
    languages: list[str]
    #: Log probability of a trigram bucket in each language: buckets x languages.
    logs: np.ndarray


def buckets(languages: int) -> int:
    """How many trigram buckets a model of so many languages has: a power of two, and at least 256."""
    size = BUCKETS
    while size > 256 and size * languages > CELLS:
        size //= 2
    return size


def letters(word: str) -> str:
    word = word.lower()
    return word if word.isalpha() else "".join(filter(str.isalpha, word))


def trigrams(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The trigram buckets of all words, each with a mark at either end, and where each word's begin."""
    codes = np.frombuffer("\1".join(["", *words, ""]).encode("utf-32-le"), "<u4").astype(np.uint64)
    mixed = (codes[:-2] * np.uint64(0x9E3779B97F4A7C15) + codes[1:-1] * np.uint64(0xC2B2AE3D27D4EB4F) + codes[2:] * np.uint64(0x165667B19E3779F9)) >> np.uint64(40)
    marks = np.flatnonzero(codes == 1)
    inside = np.ones(len(mixed), bool)
    inside[marks[1:-1] - 1] = False  # a letter, a mark, a letter: between two words
    # of n letters between marks there are n trigrams; the one centred on the mark is left out
    lengths = np.diff(marks) - 1
    return (mixed[inside] % np.uint64(BUCKETS)).astype(np.int64), np.concatenate([[0], np.cumsum(lengths)[:-1]])


def _count(size: int):
    """Occurrences of trigram buckets by language. What is counted of many languages is told in between."""

    def told(totals: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
        for lang, counts in totals.items():
            there = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(there), pa.string()), pa.array(there.astype(np.int32)), pa.array(counts[there])], names=["lang", "bucket", "n"])
        totals.clear()

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words = [w for w in map(letters, text.split()) if w]
                if words:
                    if lang not in totals and (len(totals) + 1) * size > CELLS:
                        yield from told(totals)
                    own = totals.setdefault(lang, np.zeros(size, np.int64))
                    own += np.bincount(trigrams(words)[0] & (size - 1), minlength=size)
        yield from told(totals)

    return run


def train(labelled: DataFrame, per_language: int = 2000) -> Model:
    """Learns from `labelled` (doc_id, text, lang): about `per_language` rows of each value of lang.

    The sample is chosen by a hash of the id, whatever the order of rows. Every value of lang that has
    a text with letters is learned, however many there are: the more, the fewer buckets (`buckets`), so that the model keeps
    its size. Only beyond 32,768 values, at 256 buckets, does it grow with them.
    """
    known = labelled.where("lang is not null and text is not null")
    sizes = known.groupBy("lang").agg(F.count(F.lit(1)).alias("rows")).toArrow()
    if not sizes.num_rows:
        return Model([], np.zeros((BUCKETS, 0), np.float32))
    size = buckets(sizes.num_rows)
    # one short row for each language of the model, which is sent to every task anyway
    parts = labelled.sparkSession.createDataFrame(sizes).select("lang", (F.lit(float(per_language)) / F.col("rows")).alias("part"))
    draw = F.pmod(F.xxhash64(F.lit("sample"), F.col("doc_id")), F.lit(1_000_000)) / 1_000_000
    drawn = known.select("lang", "text", draw.alias("draw")).join(F.broadcast(parts), "lang").where("draw < part")
    counts = drawn.select("lang", "text").mapInArrow(_count(size), "lang string, bucket int, n long")
    counts = counts.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow()
    names = sorted(set(counts["lang"].to_pylist()))
    table = np.full((size, len(names)), PRIOR)
    at = {x: k for k, x in enumerate(names)}
    table[counts["bucket"].to_numpy(), [at[x] for x in counts["lang"].to_pylist()]] += counts["n"].to_numpy()
    return Model(names, np.log(table / table.sum(axis=0)).astype(np.float32))


def shares(likely: np.ndarray, counts: np.ndarray, rounds: int = 30) -> tuple[np.ndarray, float]:
    """The shares of the languages in the columns of `likely` (log likelihoods by word), and the log likelihood reached."""
    top = likely.max(axis=1)
    x = np.exp(likely - top[:, None])
    n, part = counts.sum(), np.full(likely.shape[1], 1 / likely.shape[1])
    mix = x @ part
    for _ in range(rounds):
        before = part
        part = part * ((counts / mix) @ x) / n
        mix = np.maximum(x @ part, 1e-300)
        if np.abs(part - before).max() < 1e-4:
            break
    return part, float(counts @ (np.log(mix) + top))


def mixture(likely: np.ndarray, counts: np.ndarray, penalty: float) -> tuple[list[int], np.ndarray]:
    """The languages of a document and their shares."""
    single = counts @ likely
    chosen, part = [int(single.argmax())], np.ones(1)
    value, most = float(single[chosen[0]]), float(counts @ likely.max(axis=1))
    price = penalty * 0.5 * np.log(max(2.0, counts.sum()))
    while len(chosen) < likely.shape[1] and most - value > price:
        gain = counts @ np.maximum(likely - likely[:, chosen].max(axis=1)[:, None], 0)
        trial = [*chosen, int(gain.argmax())]
        found, reached = shares(likely[:, trial], counts)
        if reached - value <= price:
            break
        chosen, part, value = trial, found, reached
    return chosen, part


PREDICTED = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("languages", T.ArrayType(T.StringType())), T.StructField("shares", T.ArrayType(T.DoubleType()))]


def _predict(model, penalty: float):
    """Columns but the last, which is the text, and the prediction."""
    types = [pa.string(), pa.float64(), pa.list_(pa.string()), pa.list_(pa.float64())]

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: Model = model.value
        place: dict[str, int] = {}
        learned = [0]
        remembered = min(REMEMBERED, NUMBERS // max(1, len(known.languages)))
        table = np.zeros((remembered, len(known.languages)), np.float32)

        def learn(words: list[str]) -> None:
            """Puts words into the table; words without letters get place -1."""
            nonlocal table
            plain = [letters(w) for w in words]
            real = [(w, p) for w, p in zip(words, plain, strict=True) if p]
            place.update((w, -1) for w, p in zip(words, plain, strict=True) if not p)
            if real:
                grams, starts = trigrams([p for _, p in real])
                first = learned[0]
                end = first + len(real)
                if end > len(table):
                    table = np.concatenate([table, np.zeros((end - len(table), table.shape[1]), np.float32)])
                table[first:end] = np.add.reduceat(known.logs[grams & (len(known.logs) - 1)], starts, axis=0)
                place.update((w, first + k) for k, (w, _) in enumerate(real))
                learned[:] = [end]

        for batch in batches:
            kept, texts = batch.columns[:-1], batch.column(batch.num_columns - 1).to_pylist()
            for at in range(0, len(texts), ROWS):
                lists = [x.split() for x in texts[at : at + ROWS]]
                if known.languages:
                    every = {w for words in lists for w in words}
                    new = [w for w in every if w not in place]
                    if len(place) + len(new) > remembered:
                        place.clear()
                        learned[:], new = [0], list(every)
                    step = max(1, remembered // 10)
                    for k in range(0, len(new), step):
                        learn(new[k : k + step])
                out = []
                for words in lists:
                    index = np.fromiter(map(place.__getitem__, words), np.int64, len(words)) if known.languages else np.empty(0, np.int64)
                    index, counts = np.unique(index[index >= 0], return_counts=True)
                    if not len(index):
                        out.append((UNKNOWN, 0.0, [], []))
                        continue
                    chosen, part = mixture(table[index].astype(np.float64), counts.astype(np.float64), penalty)
                    order = np.argsort(-part, kind="stable")
                    out.append((known.languages[chosen[order[0]]], float(min(1.0, part[order[0]])), [known.languages[chosen[k]] for k in order], part[order].tolist()))
                columns = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)]
                yield pa.RecordBatch.from_arrays([*(c.slice(at, len(out)) for c in kept), *columns], names=[*batch.schema.names[:-1], *(f.name for f in PREDICTED)])

    return run


def predict(docs: DataFrame, model: Model, columns: list[str], penalty: float = 1.0) -> DataFrame:
    """`columns` of `docs`, lang_pred, score (the share of the predicted language), languages, shares, from the column text."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(*columns, F.coalesce(F.col("text").cast("string"), F.lit("")).alias("_text"))
    return rows.mapInArrow(_predict(sent, penalty), T.StructType([*(docs.schema[x] for x in columns), *PREDICTED]))


def keep_identified(docs: DataFrame, model: Model, least_share: float = 0.3) -> DataFrame:
    """The rows of `docs` in a known language, as they are: not those without one, or with none of a share of `least_share`."""
    # under names of their own, since the table may have columns of these names
    renamed = docs.toDF(*(f"_{k}" for k in range(len(docs.columns)))).withColumn("text", F.col(f"_{docs.columns.index('text')}"))
    found = predict(renamed, model, renamed.columns[:-1]).where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= least_share))
    return found.select(*(F.col(f"_{k}").alias(x) for k, x in enumerate(docs.columns)))


def held_out() -> Column:
    """Rows that training leaves out: crc32 of the id as text, modulo 4, is 2. A null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 4 == 2
