"""Quality rules by compression: bands of zstandard ratios.

The ratio of a text is its compressed over its own bytes. Repetitive text compresses too well,
noise too badly. Whole documents and fixed chunks of `Settings.chunk` bytes are each held against a
band, whose limits depend on how long the compressed piece is, since short text compresses less. A document is rejected if the
whole is outside its band, or more than `Settings.outside` of its chunks are outside theirs.

Base counts come with the verdict: words `[^\\x20\\x09-\\x0D]+`, code points in words, symbols, lines
equal to an earlier line, words in repeated three-word windows.

A null text has no words. Rows are independent: repeated rows, null ids and empty tables pass
through. Columns other than the id and the text are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql import functions as F

from msgmart.llm.texts import text_bytes, window_hashes, word_hashes

BLANKS = b" \t\n\v\f\r"
SYMBOLS = b"#*$%&|<>"
ROWS = 500


@dataclass(frozen=True)
class Settings:
    #: Length in bytes from which a band holds, and its least and greatest ratio. Prose of the test tables lies between
    #: 0.33 and 0.70 from 500 bytes on, repeated words and lines below 0.2; the shortest texts are all frame and have no limit.
    #: Upper limits lie between prose and noise: at 250 bytes 0.86 and 0.89, at 500 0.72 and 0.83, at 1000 0.62 and 0.77,
    #: at 4000 0.53 and 0.74 (greatest of the test tables' documents and slices, least of base64 in words of eight).
    bands: tuple[tuple[int, float, float], ...] = ((0, 0.0, math.inf), (200, 0.20, 0.88), (250, 0.20, 0.82), (500, 0.25, 0.75), (1000, 0.25, 0.70), (4000, 0.22, 0.70), (16000, 0.18, 0.65))
    chunk: int = 4096
    #: The part of a document's chunks that may be outside their band.
    outside: float = 0.2
    level: int = 3
    #: Base rules: fewer words, or a larger part of words in repeated windows, reject.
    least_words: int = 50
    repeated_percent: int = 50

    def within(self, size: int, ratio: float) -> bool:
        low, high = next((a, b) for least, a, b in reversed(self.bands) if size >= least)
        return low <= ratio <= high


def counts(text: bytes, hashes) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    words = hashes(text)
    lines = [x for x in text.split(b"\n") if x.strip()]
    repeated = 0
    if len(words) > 3:
        windows = window_hashes(words, 3)
        _, place, times = np.unique(windows, return_inverse=True, return_counts=True)
        twice = times[place] > 1
        if twice.any():
            covered = np.zeros(len(words), bool)
            for k in range(3):
                covered[k : k + len(twice)] |= twice
            repeated = int(covered.sum())
    solid = text.translate(None, BLANKS)
    return len(words), len(solid.decode()), len(text) - len(text.translate(None, SYMBOLS)), len(lines) - len(set(lines)), repeated


def ratios(text: bytes, settings: Settings, packer: zstandard.ZstdCompressor) -> tuple[float, int, int]:
    """The ratio of the whole, the number of chunks, and how many of these are outside their band."""
    if not text:
        return 0.0, 0, 0
    size = lambda part: len(packer.compress(part))
    chunks = [text[k : k + settings.chunk] for k in range(0, len(text), settings.chunk)]
    if len(chunks) == 1:
        whole = size(text) / len(text)
        return whole, 1, int(not settings.within(len(text), whole))
    outside = sum(not settings.within(len(x), size(x) / len(x)) for x in chunks)
    return size(text) / len(text), len(chunks), outside


def _measure(settings: Settings):
    types = [pa.int64()] * 5 + [pa.bool_(), pa.float64(), pa.int64(), pa.int64(), pa.bool_()]
    names = [f.name for f in FIELDS]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, packer = word_hashes(), zstandard.ZstdCompressor(level=settings.level)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for at in range(0, len(texts), ROWS):
                rows = []
                for text in texts[at : at + ROWS]:
                    base = counts(text, hashes)
                    failed = base[0] < settings.least_words or 100 * base[4] > settings.repeated_percent * base[0]
                    whole, chunks, outside = ratios(text, settings, packer)
                    good = settings.within(len(text), whole) and outside <= settings.outside * chunks
                    rows.append((*base, failed, whole, chunks, outside, not failed and good))
                columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(rows)), *columns], names=["doc_id", *names])

    return run


FIELDS = [
    *(T.StructField(x, T.LongType()) for x in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")),
    T.StructField("base_failed", T.BooleanType()),
    T.StructField("ratio", T.DoubleType()),
    T.StructField("n_chunks", T.LongType()),
    T.StructField("n_outside", T.LongType()),
    T.StructField("kept", T.BooleanType()),
]


def measure(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """doc_id, base counts, base_failed, ratio, n_chunks, n_outside, kept for each row of `docs` (doc_id, text)."""
    return docs.select(F.col("doc_id"), text_bytes()).mapInArrow(_measure(settings), T.StructType([docs.schema["doc_id"], *FIELDS]))
