"""Packing of tokenised documents into sequences by a grouping genetic algorithm on islands.

Documents become pieces of at most `capacity` tokens. A full piece is a sequence of its own. All
others are dealt to blocks of about `Settings.block` pieces by a hash, so that no task sees more,
whatever the input. For each block several islands evolve packings of that block:

* a packing is a list of bins; crossover puts whole well-filled bins of one parent into the other,
  dissolves the bins that held the same pieces, and best-fits the displaced ones, longest first;
* mutation dissolves the emptiest bins and a few others, and best-fits their pieces;
* after every epoch each island's best packing moves to the next island of its block.

The best packing of each block counts. It can't need fewer bins than the tokens fill; islands that
reach this bound stop. Blocks cost at most a part of one sequence each.

Null texts are empty: such a document is its closing id alone. Repeated rows and null ids are packed
as rows of their own. An empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import itertools
import math
import os
import random
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from msgmart.llm.scratch import Scratch
from msgmart.llm.texts import held, only_of_this_stage, packed, row_numbers, tidy

#: Stems of words of each of two generations whose ids a worker remembers, and the length up to which it does.
REMEMBERED, WORD = 250_000, 100
#: Bytes of texts that are worked on together.
SLICE = 4 << 20
#: ASCII and Latin-1 letters, taken in lower case and as one run, and the marks behind them, another run.
STEM_AND_MARKS = "^(?P<stem>[A-Za-z\u00aa\u00b5\u00ba\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+)(?P<marks>[!-/:-@\\[-`{-~]*)$"
#: Byte-level vocabularies write a byte that is no printable Latin-1 character as the next character from U+0100 on.
PRINTABLE = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
BYTES = {b: 0x100 + k for k, b in enumerate(x for x in range(256) if x not in PRINTABLE)}
PROBES = ("the", "internationalisation", "straße", "élève", "àâîôûçñäöü", "qzxjv", "ÿ\u00aa")


@dataclass(frozen=True)
class Settings:
    block: int = 4096
    islands: int = 2
    population: int = 4
    children: int = 2
    generations: int = 5
    epochs: int = 3
    seed: int = 7


class Words:
    """The ids of words, remembered by a worker's tasks."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.stems: dict[str, bytes] = {}
        # what was known before the last time there was too much of it; what is used again comes back from there
        self.old_stems: dict[str, bytes] = {}
        # a run of letters is one text for the merges; whether that holds for this tokenizer is tried out
        self.direct = all(self.runs([x])[0] == self.whole([x])[0] for x in PROBES)

    def whole(self, stems: list[str]) -> list[bytes]:
        """The ids of each stem, as the tokenizer gives them."""
        return [np.array(x.ids, "<u4").tobytes() for x in self.tokenizer.encode_batch_fast(stems, add_special_tokens=False)]

    def runs(self, stems: list[str]) -> list[bytes]:
        """The same for stems of plain lower-case letters, by the merges alone."""
        tokenize = self.tokenizer.model.tokenize
        found = [[t.id for t in tokenize(x if x.isascii() else x.encode().decode("latin-1").translate(BYTES))] for x in stems]
        data = np.fromiter(itertools.chain.from_iterable(found), "<u4").tobytes()
        ends = [0, *(4 * np.cumsum([len(x) for x in found], dtype=np.int64)).tolist()]
        return [data[a:b] for a, b in zip(ends, ends[1:], strict=False)]

    def encode(self, stems: list[str]) -> list[bytes]:
        """The ids of each stem."""
        letters = [x for x in stems if x.isalpha() and max(x) < "\u0100"] if self.direct else []
        found = dict(zip(letters, self.runs(letters), strict=True))
        other = [x for x in stems if x not in found]
        found.update(zip(other, self.whole(other), strict=True))
        return [found[x] for x in stems]

    def known(self, stems: list[str]) -> list[bytes]:
        """The ids of distinct stems, encoding those that aren't remembered."""
        if len(self.stems) > REMEMBERED:
            self.old_stems, self.stems = self.stems, {}
        found = list(map(self.stems.get, stems))
        missing = [i for i, x in enumerate(found) if x is None]
        new = []
        for i in missing:
            ids = self.old_stems.get(stems[i])
            if ids is None:
                new.append(i)
            else:
                found[i] = self.stems[stems[i]] = ids
        for k in range(0, len(new), 20_000):
            part = new[k : k + 20_000]
            for i, ids in zip(part, self.encode([stems[i] for i in part]), strict=True):
                found[i] = ids
                if len(stems[i]) <= WORD:
                    self.stems[stems[i]] = ids
        return found

    def of_words(self, words: pa.Array) -> pa.ListArray:
        """The ids of each of the distinct `words`: those of a stem and of the marks behind it.

        Stems of plain letters are in lower case, as the tokenizer takes them.
        """
        split = pc.extract_regex(words, STEM_AND_MARKS)
        plain = split.is_valid()
        stem = pc.if_else(plain, pc.utf8_lower(split.field("stem")), words)
        mark = pc.if_else(plain, split.field("marks"), "")
        parts = pa.chunked_array([stem, mark]).combine_chunks().dictionary_encode()
        ids = self.known(parts.dictionary.to_pylist())
        lists = packed(np.fromiter(map(len, ids), np.int64, len(ids)) // 4, pa.array(np.frombuffer(b"".join(ids), "<u4")))
        both = parts.indices.to_numpy().reshape(2, -1).T.ravel()
        each = lists.take(pa.array(both))
        counts = pc.list_value_length(each).to_numpy().reshape(-1, 2).sum(axis=1)
        return packed(counts, each.flatten())

    def blobs(self, texts: pa.Array) -> list[bytes]:
        """The ids of each text and id 0, as little-endian 32-bit numbers."""
        # The tokenizer never joins across these blanks, so words are encoded once each. Blanks at the ends give empty words, without ids.
        lists = pc.ascii_split_whitespace(texts)
        coded = lists.flatten().dictionary_encode()
        ids = self.of_words(coded.dictionary).take(coded.indices)
        ends = np.concatenate([[0], np.cumsum(pc.list_value_length(ids).to_numpy())])
        words = np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy())])
        data = memoryview(ids.flatten().to_numpy()).cast("B")
        cuts = (4 * ends[words]).tolist()
        return [bytes(data[a:b]) + bytes(4) for a, b in zip(cuts, cuts[1:], strict=False)]


def slices(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about `SLICE` bytes, of one row at least."""
    sizes = np.cumsum(pc.binary_length(texts).to_numpy())
    at = 0
    while at < len(texts):
        done = sizes[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(sizes, done + SLICE, "right")))
        yield at, to
        at = to


def _pieces(path: str, capacity: int, ids: bool):
    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blobs, numbers = held(Words, path).blobs, row_numbers()
        for batch in batches:
            doc_ids, texts = batch.column(0).to_pylist(), batch.column(1)
            for at, to in slices(texts):
                rows = []
                for doc_id, blob in zip(doc_ids[at:to], blobs(texts.slice(at, to - at)), strict=True):
                    for piece, start in enumerate(range(0, len(blob), 4 * capacity)):
                        part = blob[start : start + 4 * capacity]
                        rows.append((next(numbers), doc_id, piece, start // 4, len(part) // 4, zlib.crc32(part), part if ids else None))
                columns = list(zip(*rows, strict=True))
                types = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
                names = ["uid", "doc_id", "piece", "start", "length", "ids_crc32", "ids"]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

    return run


def pieces(docs: DataFrame, path: str, capacity: int, ids: bool = False) -> DataFrame:
    """Each document's ids by the tokenizer in the file `path`, closed by id 0 and cut at `capacity`.

    `ids`: also return them, as little-endian 32-bit numbers.
    """
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return source.mapInArrow(_pieces(path, capacity, ids), "uid long, doc_id long, piece int, start long, length long, ids_crc32 long, ids binary")


class Packing:
    """Bins of items; `room` is what each bin has left."""

    def __init__(self, lengths: list[int], capacity: int):
        self.lengths, self.capacity = lengths, capacity
        self.bins: list[list[int]] = []
        self.room: list[int] = []

    def add(self, items: list[int]) -> None:
        self.bins.append(items)
        self.room.append(self.capacity - sum(map(self.lengths.__getitem__, items)))

    def best_fit(self, items: list[int]) -> None:
        """Puts each item where least room is left; bins are found by the lowest set bit of a mask of rooms."""
        lengths, bins, room = self.lengths, self.bins, self.room
        having: list[list[int]] = [[] for _ in range(self.capacity + 1)]
        mask = 0
        for b, r in enumerate(room):
            having[r].append(b)
        for r in range(1, self.capacity + 1):
            if having[r]:
                mask |= 1 << r
        for item in items:
            need = lengths[item]
            if fits := mask >> need:
                r = need + (fits & -fits).bit_length() - 1
                b = having[r].pop()
                if not having[r]:
                    mask ^= 1 << r
                bins[b].append(item)
            else:
                b, r = len(bins), self.capacity
                bins.append([item])
                room.append(r)
            room[b] = r = r - need
            if r:
                having[r].append(b)
                mask |= 1 << r

    def fitness(self) -> tuple[float, float]:
        """Fewer bins first, then bins as unevenly filled as possible."""
        return -len(self.bins), sum((1 - r / self.capacity) ** 2 for r in self.room)

    def coded(self) -> bytes:
        out = np.empty(len(self.lengths), "<i4")
        for b, items in enumerate(self.bins):
            out[items] = b
        return out.tobytes()

    @classmethod
    def of(cls, code: bytes, lengths: list[int], capacity: int) -> Packing:
        out = cls(lengths, capacity)
        place = np.frombuffer(code, "<i4")
        order = np.argsort(place, kind="stable")
        for items in np.split(order, np.flatnonzero(np.diff(place[order])) + 1):
            out.add(items.tolist())
        return out


def _longest_first(items: list[int], lengths: list[int]) -> list[int]:
    return sorted(items, key=lambda i: (-lengths[i], i))


def crossover(into: Packing, giver: Packing, rng: random.Random) -> Packing:
    """`into` with some of the best-filled bins of `giver`."""
    filled = sorted(range(len(giver.bins)), key=giver.room.__getitem__)[: max(1, len(giver.bins) // 2)]
    size = rng.randint(1, max(1, len(filled) // 2))
    first = rng.randint(0, len(filled) - size)
    child = Packing(into.lengths, into.capacity)
    moved: set[int] = set()
    for b in filled[first : first + size]:
        child.add(list(giver.bins[b]))
        moved.update(giver.bins[b])
    displaced: list[int] = []
    for items in into.bins:
        if moved.isdisjoint(items):
            child.add(list(items))
        else:
            displaced.extend(i for i in items if i not in moved)
    child.best_fit(_longest_first(displaced, into.lengths))
    return child


def mutate(packing: Packing, rng: random.Random) -> Packing:
    """The emptiest bins and as many others are dissolved."""
    n = len(packing.bins)
    emptiest = sorted(range(n), key=lambda b: -packing.room[b])[: max(1, n // 50)]
    gone = {*emptiest, *rng.sample(range(n), min(n, len(emptiest)))}
    child = Packing(packing.lengths, packing.capacity)
    for b, items in enumerate(packing.bins):
        if b not in gone:
            child.add(list(items))
    child.best_fit(_longest_first([i for b in gone for i in packing.bins[b]], packing.lengths))
    return child


def evolve(lengths: list[int], capacity: int, population: list[Packing], settings: Settings, rng: random.Random) -> list[Packing]:
    """One epoch of one island; the first of the result is the best."""
    least = -(-sum(lengths) // capacity)
    items = range(len(lengths))
    while len(population) < settings.population:
        shake = 0.0 if not population else 0.1 * len(population)
        weight = [-x * (1 + shake * rng.random()) for x in lengths]
        fresh = Packing(lengths, capacity)
        fresh.best_fit(sorted(items, key=weight.__getitem__))
        population.append(fresh)
        if len(fresh.bins) == least:
            break
    population.sort(key=Packing.fitness, reverse=True)
    for _ in range(settings.generations):
        if len(population[0].bins) == least or len(population) < 2:
            break
        for _ in range(settings.children):
            a, b = rng.sample(population, 2)
            child = crossover(a, b, rng)
            population.append(mutate(child, rng) if rng.random() < 0.5 else child)
        population.sort(key=Packing.fitness, reverse=True)
        del population[settings.population :]
    return population


STATE = "block long, island int, lengths array<int>, population array<binary>, bins int"


def _epoch(capacity: int, settings: Settings, number: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        only_of_this_stage()
        row = pdf.iloc[0]
        lengths = [int(x) for x in row["lengths"]]
        codes = [] if row["population"] is None else list(row["population"])
        if row["migrant"] is not None:
            codes.append(row["migrant"])
        population = [Packing.of(x, lengths, capacity) for x in dict.fromkeys(codes)]
        rng = random.Random(f"{settings.seed} {number} {row['block']} {row['island']}")
        population = evolve(lengths, capacity, population, settings, rng)
        return pd.DataFrame({"block": [row["block"]], "island": [row["island"]], "lengths": [lengths], "population": [[p.coded() for p in population]], "bins": [len(population[0].bins)]})

    return run


def _places(pdf: pd.DataFrame) -> pd.DataFrame:
    """The sequence and the offset of each item of a block."""
    only_of_this_stage()
    row = pdf.iloc[0]
    place, lengths = np.frombuffer(row["best"], "<i4").astype(np.int64), np.asarray(row["lengths"], np.int64)
    order = np.argsort(place, kind="stable")
    ahead = np.cumsum(lengths[order]) - lengths[order]
    first = np.searchsorted(place[order], place[order])
    offset = np.empty(len(order), np.int64)
    offset[order] = ahead - ahead[first]
    return pd.DataFrame({"uid": np.asarray(row["uids"], np.int64), "sequence_id": (int(row["block"]) << 32) + place, "offset": offset})


def place(items: DataFrame, capacity: int, scratch: Scratch, settings: Settings = Settings()) -> DataFrame:
    """uid, sequence_id, offset for rows (uid, length) with lengths below `capacity`."""
    blocks = max(1, math.ceil(items.count() / settings.block))
    dealt = items.select(F.pmod(F.xxhash64("uid"), F.lit(blocks)).alias("block"), F.struct((-F.col("length")).alias("a"), F.col("uid").alias("b")).alias("item"))
    lists = dealt.groupBy("block").agg(F.sort_array(F.collect_list("item")).alias("items"))
    lists = scratch.keep(lists.select("block", F.expr("transform(items.a, x -> cast(-x as int))").alias("lengths"), F.col("items.b").alias("uids")), "blocks")
    nobody = F.lit(None).cast("array<binary>")
    state = lists.select("block", F.explode(F.sequence(F.lit(0), F.lit(settings.islands - 1))).alias("island"), "lengths", nobody.alias("population"), F.lit(None).cast("binary").alias("migrant"))
    for number in range(settings.epochs):
        state = scratch.keep(state.groupBy("block", "island").applyInPandas(_epoch(capacity, settings, number), STATE), f"epoch{number}")
        if number:
            scratch.drop(f"epoch{number - 1}")
        if number + 1 < settings.epochs:
            moved = state.select("block", F.expr(f"cast((island + 1) % {settings.islands} as int)").alias("island"), F.col("population")[0].alias("migrant"))
            state = state.drop("bins").join(moved, ["block", "island"])
    best = state.groupBy("block").agg(F.min(F.struct("bins", "island")).alias("best")).select("block", "best.island")
    best = state.join(best, ["block", "island"]).select("block", F.col("population")[0].alias("best"))
    return lists.join(best, "block").groupBy("block").applyInPandas(_places, "uid long, sequence_id long, offset long")


def pack(docs: DataFrame, path: str, capacity: int = 2048, settings: Settings = Settings(), scratch: Scratch | None = None, ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset (and ids) of each piece of `docs` (doc_id, text)."""
    scratch = scratch or Scratch(docs.sparkSession, "packing")
    columns = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset", *(["ids"] if ids else [])]
    cut = scratch.keep(pieces(docs, path, capacity, ids), "pieces")
    rest = cut.where(F.col("length") < capacity)
    full = cut.where(F.col("length") == capacity).select("*", (-1 - F.col("uid")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    placed = rest.join(place(rest.select("uid", "length"), capacity, scratch, settings), "uid")
    return placed.select(*columns).unionByName(full.select(*columns))


def assemble(packed: DataFrame) -> DataFrame:
    """sequence_id, ids, doc_ids: the ids of each sequence, from what `pack` gives with `ids`."""
    rows = packed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids", "doc_id"))).alias("rows"))
    return rows.select("sequence_id", F.expr("aggregate(rows.ids, X'', (a, x) -> concat(a, x))").alias("ids"), F.col("rows.doc_id").alias("doc_ids"))
