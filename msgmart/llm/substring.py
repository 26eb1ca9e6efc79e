"""Removal of passages that an earlier document has, by level-wise doubling.

A window of `length` words can only be repeated if its parts are. So windows of `base` words are
compared first; where these are repeated, windows of twice the length are, and so on up to
`length` (the last step is shorter where doubling would pass it). Every level but the last only
has to tell which windows may be repeated:

1. Tasks hash the candidate windows of a level, and deal the hashes to owners as sorted,
   Golomb-coded messages of a few bytes a window.
2. Owners find the hashes that came twice, and answer with their part of a bitmap of fixed size.
   A bitmap that fills up lets more candidates pass, never fewer.
3. Every task keeps a window as a candidate for the next level if all its parts pass.

At the last level owners compare the surviving windows themselves, by 96 bits of hash. A task deals
out its windows in chunks, each window once with the smallest document that has it there. The
answer is a bit for each: whether an earlier document elsewhere has the window too. Documents are
then finished chunk by chunk; those without a surviving window take no part and are not shuffled.

All steps look at slices of many texts at once, in numpy. Owners and chunks are dealt to twice as
many tasks as the texts would fill chunks, so that a task has no more to read from large inputs than
from small ones. A chunk's hashes are made again when it is finished, which takes less than to store them.

Words are `[^\\x20\\x09-\\x0D]+`. A null text has no words; a null id is larger than all others and
not smaller than another null. Rows of one id don't remove each other's words. An empty table gives
an empty result, other columns are not read.
"""

from __future__ import annotations

import hashlib
import itertools
import math
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from msgmart.llm import golomb
from msgmart.llm.scratch import Scratch
from msgmart.llm.texts import joined, only_of_this_stage, packed, place_hashes, row_numbers, scramble, slices, text_bytes, window_hashes, word_places

#: Bits of a window's hash in messages, and of the bitmap (16 MB) that the leading ones address.
HASH_BITS, MAP_BITS = 42, 27
#: Hashes a task sends at once, and hashes an owner gets, about.
SENT, OWNED = 2_000_000, 3_000_000
LAST = 2**63 - 1


def levels(base: int, length: int) -> list[int]:
    """base, twice base, ..., length."""
    out = [min(base, length)]
    while out[-1] < length:
        out.append(min(2 * out[-1], length))
    return out


def _longer(hashes: np.ndarray, step: int, places: np.ndarray | slice) -> np.ndarray:
    """64-bit hashes of windows that are `step` words longer, made of those of their first and last part, which cover them."""
    n = max(0, len(hashes) - step)
    return scramble(hashes[:n][places] * np.uint64(0x9E3779B97F4A7C15) + hashes[step:][places])


def _hashes(words: np.ndarray, lengths: list[int], places: np.ndarray | slice = slice(None)) -> np.ndarray:
    """64-bit hashes of the last length's windows at these places."""
    hashes = window_hashes(words, lengths[0])
    for shorter, longer in itertools.pairwise(lengths[:-1]):
        hashes = _longer(hashes, longer - shorter, slice(None))
    return _longer(hashes, lengths[-1] - lengths[-2], places) if len(lengths) > 1 else hashes[places]


def _windows(words: np.ndarray, sizes: np.ndarray, lengths: list[int], bitmap: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the last length's windows in texts of these `sizes` whose parts pass the bitmap of the length before.

    What passes a bitmap has passed those before.
    """
    n = max(0, len(words) - lengths[-1] + 1)
    left = np.repeat(np.cumsum(sizes), sizes)[:n] - np.arange(n)  # words of its text from this one on
    ok = left >= lengths[-1]
    if bitmap is None:
        places = np.flatnonzero(ok)
        return places, _hashes(words, lengths, places)
    step = lengths[-1] - lengths[-2]
    hashes = _hashes(words, lengths[:-1])
    cells = hashes >> np.uint64(64 - MAP_BITS)
    passes = (bitmap[cells >> np.uint64(3)] >> (np.uint64(7) - (cells & np.uint64(7))).astype(np.uint8)) & 1 == 1
    places = np.flatnonzero(ok & passes[:n] & passes[step : step + n])
    return places, _longer(hashes, step, places)


def _low(words: np.ndarray, places: np.ndarray, length: int) -> np.ndarray:
    """32 more bits of hash of the windows at these places, from the words themselves."""
    out = np.zeros(len(places), np.uint64)
    for j in range(length):
        out = out * np.uint64(0xD6E8FEB86659FD93) + words[places + j]
    return (out >> np.uint64(32)).astype(np.uint32)


def _opened_map(maps: list) -> np.ndarray | None:
    """The last level's bitmap, eight cells a byte."""
    return np.frombuffer(maps[-1].value, np.uint8) if maps else None


def _send(lengths: list[int], maps: list, owner_bits: int):
    """Messages to owners: the hashes of all candidate windows, and once more those that the task has seen twice."""
    low = np.uint64(HASH_BITS - owner_bits)

    def messages(hashes: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        values, counts = np.unique(np.concatenate(hashes), return_counts=True)
        owner = (values >> low).astype(np.int64)
        to, sent = [], []
        bounds = np.searchsorted(owner, np.arange((1 << owner_bits) + 1))
        for k in np.unique(owner):
            part = slice(bounds[k], bounds[k + 1])
            own = values[part] & ((np.uint64(1) << low) - np.uint64(1))
            for message in (own, own[counts[part] > 1]):
                if len(message):
                    to.append(int(k))
                    sent.append(golomb.encode(message))
        yield pa.RecordBatch.from_arrays([pa.array(to, pa.int32()), pa.array(sent, pa.binary())], names=["owner", "message"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only_of_this_stage()
        bitmap = _opened_map(maps)
        waiting: list[np.ndarray] = []
        n = 0
        for batch in batches:
            for _, _, data, bounds in slices(batch.column(0)):
                starts, ends, sizes = word_places(data, bounds)
                found = _windows(place_hashes(data, starts, ends), sizes, lengths, bitmap)[1] >> np.uint64(64 - HASH_BITS)
                waiting.append(found)
                n += len(found)
                if n >= SENT:
                    yield from messages(waiting)
                    waiting, n = [], 0
        if n:
            yield from messages(waiting)

    return run


def _answer(owner_bits: int):
    """An owner's part of the bitmap: a bit for the leading bits of every hash that came twice."""
    size = MAP_BITS - owner_bits

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        hashes = np.sort(np.concatenate([golomb.decode(x) for x in pdf["message"]]))
        twice = hashes[1:][hashes[1:] == hashes[:-1]]
        bits = np.zeros(1 << size, np.uint8)
        bits[twice >> np.uint64(HASH_BITS - MAP_BITS)] = 1
        return pd.DataFrame({"owner": [pdf["owner"].iloc[0]], "bits": [np.packbits(bits).tobytes()]})

    return run


def bitmap(texts: DataFrame, lengths: list[int], maps: list, owner_bits: int, tasks: int):
    """A broadcast bitmap of the windows of the last of these lengths that may be repeated."""
    sent = texts.mapInArrow(_send(lengths, maps, owner_bits), "owner int, message binary").repartition(tasks, "owner")
    parts = sent.groupBy("owner").applyInPandas(_answer(owner_bits), "owner int, bits binary").toArrow()
    size = 1 << (MAP_BITS - owner_bits - 3)
    table = np.zeros(1 << (MAP_BITS - 3), np.uint8)
    for owner, bits in zip(parts["owner"].to_pylist(), parts["bits"].to_pylist(), strict=True):
        table[owner * size : (owner + 1) * size] = np.frombuffer(bits, np.uint8)
    return texts.sparkSession.sparkContext.broadcast(table.tobytes())


SURVEYED = "kind int, chunk long, doc_id long, n_words long, kept_sha256 string, owner int, message binary"
#: Candidate windows, and bytes of text, at which a chunk ends.
CHUNK, CHUNK_BYTES = 500_000, 16_000_000
DONE = "doc_id long, n_words long, n_removed long, kept_sha256 string, kept_text string"


def _digests(data: np.ndarray, bounds: np.ndarray, which: Iterable[int]) -> list[str]:
    """SHA-256 of the texts with these numbers."""
    data, bounds = memoryview(data), bounds.tolist()
    return [hashlib.sha256(data[bounds[k] : bounds[k + 1]]).hexdigest() for k in which]


class _Chunk:
    """Documents with candidate windows, until they leave the task together."""

    def __init__(self, number: int):
        self.number, self.bytes, self.windows, self.words = number, 0, 0, 0
        self.docs: list[pa.RecordBatch] = []
        self.counts: list[np.ndarray] = []
        self.ranks: list[np.ndarray] = []
        self.places: list[np.ndarray] = []
        self.high: list[np.ndarray] = []
        self.low: list[np.ndarray] = []

    def add(self, ids: pa.Array, texts: pa.Array, words: int, counts: np.ndarray, places: np.ndarray, high: np.ndarray, low: np.ndarray) -> None:
        """Documents with so many `words` together and so many windows each; places count the words of all of them."""
        self.docs.append(pa.RecordBatch.from_arrays([ids, texts], names=["doc_id", "text"]))
        self.counts.append(counts)
        self.ranks.append(np.repeat(_ranks(ids), counts))
        self.places.append(places + self.words)
        self.high.append(high)
        self.low.append(low)
        self.bytes += texts.nbytes
        self.windows += len(places)
        self.words += words

    def leave(self, owner_bits: int) -> Iterator[pa.RecordBatch]:
        if not self.docs:
            return
        ranks, high, low = map(np.concatenate, (self.ranks, self.high, self.low))
        order, new = _equal(high, low)
        ranks = np.minimum.reduceat(ranks[order], np.flatnonzero(new))  # of each window the smallest document
        high, low = high[order][new], low[order][new]
        steps = np.diff(np.concatenate(self.places), prepend=0).astype(np.int32)
        docs = pa.Table.from_batches(self.docs).combine_chunks().to_batches()[0]
        yield _batch(1, [[0], [self.number], None, None, None, None, [_stored(docs, np.concatenate(self.counts), steps)]])
        owner = (high >> np.uint64(64 - owner_bits)).astype(np.int64)
        bounds = np.searchsorted(owner, np.arange((1 << owner_bits) + 1))
        owners = np.unique(owner).tolist()
        sent = [_message(int(bounds[k]), high[bounds[k] : bounds[k + 1]], low[bounds[k] : bounds[k + 1]], ranks[bounds[k] : bounds[k + 1]]) for k in owners]
        yield _batch(len(owners), [np.ones(len(owners), np.int32), np.full(len(owners), self.number), None, None, None, owners, sent])


def _ranks(ids: pa.Array) -> np.ndarray:
    """The ids; a null one is larger than all others."""
    return ids.fill_null(LAST).to_numpy(zero_copy_only=False)


def _equal(high: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order by both parts of a hash, and where in it another one begins."""
    order = np.argsort(high)
    new = np.ones(len(order), bool)
    new[1:] = high[order][1:] != high[order][:-1]
    if (~new[1:] & (low[order][1:] != low[order][:-1])).any():  # two hashes agree in the high part only
        order = np.lexsort((low, high))
        new[1:] = (high[order][1:] != high[order][:-1]) | (low[order][1:] != low[order][:-1])
    return order, new


def _batch(n: int, columns: list) -> pa.RecordBatch:
    types = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int32(), pa.binary()]
    arrays = [pa.nulls(n, t) if c is None else pa.array(c, t) for c, t in zip(columns, types, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, names=[x.split()[0] for x in SURVEYED.split(", ")])


def _stored(docs: pa.RecordBatch, counts: np.ndarray, steps: np.ndarray) -> bytes:
    """The documents of a chunk and the steps between their windows' places as one compressed message."""
    batch = pa.RecordBatch.from_arrays([*docs.columns, packed(counts, pa.array(steps))], names=["doc_id", "text", "steps"])
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema) as out:
        out.write_batch(batch)
    return zstandard.ZstdCompressor(level=3).compress(sink.getvalue())


def _message(first: int, high: np.ndarray, low: np.ndarray, ranks: np.ndarray) -> bytes:
    """A chunk's windows of one owner: the place of the first, their hashes and smallest documents."""
    starts = np.ones(len(high), bool)
    starts[1:] = high[1:] != high[:-1]
    coded = golomb.encode(high[starts] & np.uint64((1 << 63) - 1))
    ids, place = np.unique(ranks, return_inverse=True)
    parts = (coded, np.packbits(starts).tobytes(), low.tobytes(), ids.tobytes(), place.astype(_width(len(ids))).tobytes())
    head = np.array([first, len(high), len(ids), *map(len, parts)], "<i8").tobytes()
    return zstandard.ZstdCompressor(level=1).compress(head + b"".join(parts))


def _width(n: int) -> np.dtype:
    """Of a number below n."""
    return np.min_scalar_type(max(0, n - 1))


def _opened(message: bytes) -> tuple[int, np.ndarray, np.ndarray, np.ndarray]:
    """First place, hashes (63 and 32 bits) and documents of a message."""
    data = zstandard.ZstdDecompressor().decompress(message)
    first, n, n_ids, *sizes = np.frombuffer(data, "<i8", 8).tolist()
    at = np.cumsum([64, *sizes]).tolist()
    coded, starts, low, ids, place = (data[a:b] for a, b in zip(at[:-1], at[1:], strict=True))
    high = golomb.decode(coded)[np.cumsum(np.unpackbits(np.frombuffer(starts, np.uint8), count=n)) - 1]
    return first, high, np.frombuffer(low, np.uint32), np.frombuffer(ids, np.int64)[np.frombuffer(place, _width(n_ids))]


def _resolve(pdf: pd.DataFrame) -> pd.DataFrame:
    """An owner's answers: a bit for each window of a chunk, set if another chunk has it in an earlier document."""
    opened = [_opened(x) for x in pdf["message"]]
    high, low, ranks = (np.concatenate([x[k] for x in opened]) for k in (1, 2, 3))
    order, new = _equal(high, low)
    least = np.minimum.reduceat(ranks[order], np.flatnonzero(new))
    earlier = np.empty(len(order), bool)
    earlier[order] = ranks[order] > least[np.cumsum(new) - 1]
    rows, at = [], 0
    for chunk, (first, own, _, _) in zip(pdf["chunk"], opened, strict=True):
        bits = earlier[at : at + len(own)]
        at += len(own)
        if bits.any():
            rows.append((chunk, first, len(own), np.packbits(bits).tobytes()))
    return pd.DataFrame(rows, columns=["chunk", "first", "n", "bits"])


def _survey(lengths: list[int], maps: list, owner_bits: int):
    """Documents without candidate windows are finished; others leave in chunks, with messages to the owners of their windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers, bitmap = row_numbers(), _opened_map(maps)
        chunk = _Chunk(next(numbers))
        for batch in batches:
            for first, end, data, bounds in slices(batch.column(1)):
                ids = batch.column(0).slice(first, end - first)
                starts, ends, sizes = word_places(data, bounds)
                words = place_hashes(data, starts, ends)
                places, high = _windows(words, sizes, lengths, bitmap)
                text, at = joined(data, starts, ends, sizes)
                behind = np.concatenate([[0], np.cumsum(sizes)])
                counts = np.diff(np.searchsorted(places, behind))
                open_ = counts > 0
                done = np.flatnonzero(~open_)
                if len(done):
                    hashes = _digests(text, at, done)
                    yield _batch(len(done), [np.full(len(done), 2, np.int32), None, ids.take(pa.array(done)), sizes[done], hashes, None, None])
                if len(done) < len(ids):
                    texts = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(ids), [None, pa.py_buffer(at.astype(np.int64)), pa.py_buffer(text)])
                    gone = np.repeat(np.cumsum(np.where(open_, 0, sizes)), counts)  # words before that belong to finished documents
                    which = pa.array(np.flatnonzero(open_))
                    chunk.add(ids.take(which), texts.take(which), int(sizes[open_].sum()), counts[open_], places - gone, high, _low(words, places, lengths[-1]))
                    if chunk.windows >= CHUNK or chunk.bytes >= CHUNK_BYTES:
                        yield from chunk.leave(owner_bits)
                        chunk = _Chunk(next(numbers))
        yield from chunk.leave(owner_bits)

    return run


def _finish(lengths: list[int]):
    """The documents of a chunk without the words that its own and its owners' answers tell to remove."""

    def run(stored: pa.Table, answers: pa.Table) -> pa.Table:
        docs = pa.ipc.open_stream(zstandard.ZstdDecompressor().decompress(stored["message"][0].as_py())).read_next_batch()
        at = np.cumsum(docs["steps"].flatten().to_numpy(), dtype=np.int64)
        ranks = np.repeat(_ranks(docs["doc_id"]), docs["steps"].value_lengths().to_numpy())
        parts, high, low = [], [], []
        behind = 0
        for _, _, data, bounds in slices(docs["text"]):
            starts, ends, sizes = word_places(data, bounds)
            words = place_hashes(data, starts, ends)
            own = slice(*np.searchsorted(at, [behind, behind + len(words)]).tolist())
            parts.append((data, starts, ends, sizes, own, behind))
            high.append(_hashes(words, lengths, at[own] - behind))
            low.append(_low(words, at[own] - behind, lengths[-1]))
            behind += len(words)
        order, new = _equal(np.concatenate(high), np.concatenate(low))
        least = np.minimum.reduceat(ranks[order], np.flatnonzero(new))
        slots = np.empty(len(order), np.int64)
        slots[order] = np.cumsum(new) - 1
        elsewhere = np.zeros(len(least), bool)
        for first, n, bits in zip(*(answers[c].to_pylist() for c in ("first", "n", "bits")), strict=True):
            elsewhere[first : first + n] = np.unpackbits(np.frombuffer(bits, np.uint8), count=n)
        earlier = elsewhere[slots] | (least[slots] < ranks)
        n_words, removed, digests, kept_text = [], [], [], []
        for data, starts, ends, sizes, own, behind in parts:
            inside = at[own][earlier[own]] - behind
            edges = np.zeros(len(starts) + 1, np.int32)
            edges[inside] += 1
            edges[inside + lengths[-1]] -= 1
            covered = np.cumsum(edges[:-1]) > 0
            text, to = joined(data, starts, ends, sizes, ~covered)
            gone = np.diff(np.concatenate([[0], np.cumsum(covered)])[np.concatenate([[0], np.cumsum(sizes)])])
            n_words.append(sizes)
            removed.append(gone)
            digests += _digests(text, to, range(len(sizes)))
            kept_text += [str(text[a:b], "utf-8") if n else None for a, b, n in zip(to[:-1].tolist(), to[1:].tolist(), gone.tolist(), strict=True)]
        columns = [docs["doc_id"], np.concatenate(n_words), np.concatenate(removed), digests, kept_text]
        types = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string())
        return pa.table([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=[x.split()[0] for x in DONE.split(", ")])

    return run


def remove_repeats(docs: DataFrame, length: int = 13, base: int = 4, scratch: Scratch | None = None, words: int = 0) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 and kept_text (the words left, joined by a space; null where nothing was removed).

    Every word is removed that a window covers whose words also start in a document of a smaller
    id. `words`: about how many words the documents have, to choose the number of owners (0: counted).
    """
    scratch = scratch or Scratch(docs.sparkSession, "substring")
    texts = docs.select(text_bytes())
    size = 6 * words or docs.select(F.sum(F.octet_length(F.coalesce("text", F.lit("")))).alias("n")).first()["n"] or 0
    owner_bits = min(MAP_BITS - 3, max(5, math.ceil(math.log2(max(1, size / 6 / OWNED)))))
    tasks = max(1, math.ceil(2 * size / CHUNK_BYTES))
    lengths, maps = levels(base, length), []
    for k in range(1, len(lengths)):
        maps.append(bitmap(texts, lengths[:k], maps[:], owner_bits, tasks))
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_bytes())
    surveyed = scratch.keep(source.mapInArrow(_survey(lengths, maps, owner_bits), SURVEYED), "surveyed")
    done = surveyed.where("kind = 2").select("doc_id", "n_words", F.lit(0).cast("long").alias("n_removed"), "kept_sha256", F.lit(None).cast("string").alias("kept_text"))
    sent = surveyed.where("kind = 1").select("chunk", "owner", "message").repartition(tasks, "owner")
    answers = sent.groupBy("owner").applyInPandas(_resolve, "chunk long, first long, n long, bits binary").repartition(tasks, "chunk")
    open_ = surveyed.where("kind = 0").select("chunk", "message").repartition(tasks, "chunk")
    removed = open_.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(_finish(lengths), DONE)
    return done.unionByName(removed)
