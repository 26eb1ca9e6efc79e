"""Helpers for functions over batches of texts, run inside tasks."""

from __future__ import annotations

import ctypes
import functools
import gc
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def text_bytes(name: str = "text") -> Column:
    """The UTF-8 bytes of a text; a null text counts as empty."""
    return F.coalesce(F.col(name).cast("string"), F.lit("")).cast("binary").alias("text")


def own_names(docs: DataFrame, read: Sequence[str] = ("doc_id", "text")) -> DataFrame:
    """`docs` with neutral names for all columns but those `read`, so that none clashes with a helper's.

    The order stays: `toDF` with the old names takes them back.
    """
    return docs.toDF(*(x if x in read else f"column{k}" for k, x in enumerate(docs.columns)))


_held: dict = {}


def only_of_this_stage() -> None:
    """Lets go of what tasks of other stages have left in this worker, which lives longer than they do."""
    context = TaskContext.get()
    stage = context.stageId() if context else None
    if _held.get("stage") != stage:
        _held.clear()
        _held["stage"] = stage
        gc.collect()
        let_go()


def let_go() -> None:
    """Gives memory that nothing uses back to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # where the C library has it
    if trim:
        trim(0)


def tidy(run: Callable) -> Callable:
    """`run`, a function over the batches of a task, in a worker that keeps little: nothing of other stages, and once it ends only what is `held`.

    Workers wait for tasks while the JVM goes on, and then count as the executor's memory too.
    """

    @functools.wraps(run)
    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only_of_this_stage()
        yield from run(batches)
        let_go()

    return whole


def few(batches: Iterator[pa.RecordBatch], rows: int = 500) -> Iterator[pa.RecordBatch]:
    """The batches' rows, a few at a time."""
    return (batch.slice(at, rows) for batch in batches for at in range(0, batch.num_rows, rows))


def held(make: Callable, *arguments):
    """`make(*arguments)`, shared by the tasks of one stage in this worker."""
    only_of_this_stage()
    key = (make, arguments)
    if key not in _held:
        _held[key] = make(*arguments)
    return _held[key]


class Memo(dict):
    """What `make` gives for a key, remembered for at most `limit` keys."""

    def __init__(self, make: Callable, limit: int = 300_000):
        super().__init__()
        self.make, self.limit = make, limit

    def __missing__(self, key):
        if len(self) >= self.limit:
            self.clear()
        value = self[key] = self.make(key)
        return value


def word_hashes(limit: int = 300_000) -> Callable[[bytes], np.ndarray]:
    """A function from a text to the 64-bit hashes of its words `[^\\x20\\x09-\\x0D]+`.

    bytes.split() without an argument splits at exactly these six characters.
    """
    only_of_this_stage()
    memo = Memo(xxhash.xxh3_64_intdigest, limit)

    def hashes(text: bytes) -> np.ndarray:
        words = text.split()
        return np.fromiter(map(memo.__getitem__, words), dtype=np.uint64, count=len(words))

    return hashes


#: Bytes of text that are looked at together, and of the longest words that are hashed together.
SLICE, WORD = 1 << 19, 64


def slices(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """First and last row (exclusive) of some texts that lie one behind the other, their bytes, and where each starts and the last ends.

    A slice has about SLICE bytes, or one longer text. There are no nulls.
    """
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    if not len(column):
        return
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data else np.empty(0, np.uint8)
    at = 0
    while at < len(column):
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + SLICE, "right")) - 1)
        yield at, to, data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at]
        at = to


def word_places(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words `[^\\x20\\x09-\\x0D]+` of the texts of a slice, and how many each text has."""
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = (data != 32) & (data - np.uint8(9) > 4)
    first = inside[1:] & ~inside[:-1]
    last = ~inside[1:] & inside[:-1]
    inner = bounds[1:-1][(bounds[1:-1] > 0) & (bounds[1:-1] < len(data))]
    split = inner[inside[inner] & inside[inner + 1]]  # words of two texts that touch
    first[split] = last[split] = True
    starts, ends = np.flatnonzero(first), np.flatnonzero(last)
    return starts, ends, np.diff(np.searchsorted(starts, bounds))


def place_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the words at these places: eight bytes of all words at a time, xxh3 where they are longer than WORD."""
    eights = np.zeros(len(data) // 8 + 3, "<u8")
    eights.view(np.uint8)[: len(data)] = data
    masks = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)

    def eight(at: np.ndarray, left: np.ndarray) -> np.ndarray:
        cell, shift = at >> 3, ((at & 7) << 3).astype(np.uint64)
        return ((eights[cell] >> shift) | (eights[cell + 1] << (np.uint64(63) - shift) << np.uint64(1))) & masks[np.minimum(left, 8)]

    sizes = ends - starts
    out = scramble(eight(starts, sizes) + sizes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    more = np.flatnonzero((sizes > 8) & (sizes <= WORD))
    for at in range(8, WORD, 8):
        more = more[sizes[more] > at]
        if not len(more):
            break
        out[more] = scramble(out[more] * np.uint64(0x9E3779B97F4A7C15) + eight(starts[more] + at, sizes[more] - at))
    for k in np.flatnonzero(sizes > WORD).tolist():
        out[k] = xxhash.xxh3_64_intdigest(data[starts[k] : ends[k]].tobytes())
    return out


def joined(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, sizes: np.ndarray, kept: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The (`kept`) words of each text joined by one space: all texts' bytes, and where each starts and the last ends."""
    text = np.repeat(np.arange(len(sizes)), sizes)
    if kept is not None:
        starts, ends, text = starts[kept], ends[kept], text[kept]
        sizes = np.bincount(text, minlength=len(sizes))
    behind = np.zeros(len(text), np.int64)  # a byte between two words of a text becomes the space
    behind[:-1] = text[1:] == text[:-1]
    edges = np.zeros(len(data) + 1, np.int8)
    edges[starts] += 1
    edges[ends + behind] -= 1
    out = data.copy()
    out[ends[behind > 0]] = 32
    at = np.concatenate([[0], np.cumsum(ends + behind - starts)])
    return out[np.cumsum(edges[:-1], dtype=np.int8).view(bool)], at[np.concatenate([[0], np.cumsum(sizes)])]


def scramble(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit over all bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def window_hashes(words: np.ndarray, length: int, seed: int = 0) -> np.ndarray:
    """64-bit hashes of all runs of `length` words, from the words' hashes."""
    n = len(words) - length + 1
    if n <= 0:
        return np.empty(0, dtype=np.uint64)
    out = np.full(n, seed, dtype=np.uint64)
    for j in range(length):
        out *= np.uint64(0x9E3779B97F4A7C15)
        out += words[j : n + j]
        out ^= out >> np.uint64(32)
    return scramble(out)


def row_numbers() -> Iterator[int]:
    """Numbers that no other row of this job gets. They hold once the rows are written."""
    only_of_this_stage()
    at = TaskContext.get().partitionId() << 36
    while True:
        yield at
        at += 1


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def packed(lengths: np.ndarray, values: pa.Array) -> pa.Array:
    """A list array from the lists' lengths and all their values."""
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)), values)


def grouped(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.Table]:
    """Runs of rows that agree in the first `keys` columns, which are whole numbers; rows come sorted by them."""
    waiting: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        key = np.stack([batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(keys)])
        cuts = np.flatnonzero((key[:, 1:] != key[:, :-1]).any(axis=0)) + 1
        for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows], strict=True):
            now = tuple(key[:, a].tolist())
            if waiting and now != last:
                yield pa.Table.from_batches(waiting)
                waiting = []
            waiting.append(batch.slice(a, b - a))
            last = now
    if waiting:
        yield pa.Table.from_batches(waiting)
