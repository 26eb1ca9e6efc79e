"""Exact deduplication by exchange of Golomb-coded fingerprints.

1. Every task fingerprints its texts and deals the fingerprints to owners by their leading bits.
   A task's share for an owner travels sorted, each value once, as one Golomb-coded message.
2. Owners merge their messages and answer each with a bitmap: which of its fingerprints are held
   by more than one row.
3. Only the rows under a set bit are suspects. Their texts are shuffled and grouped by their bytes.

Null texts count as empty; rows are told apart by a number of their own, so repeated rows and
repeated or null ids are fine (a null id is larger than all others). An empty table gives an empty
result; very long texts travel whole, where they are suspects. Other columns are neither read nor returned by `copies`, and kept by `drop_copies`.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from msgmart.llm import golomb
from msgmart.llm.scratch import Scratch
from msgmart.llm.sieve import passes, sieve
from msgmart.llm.skew import join_groups
from msgmart.llm.texts import few, own_names, row_numbers, signed, text_bytes, tidy

#: Deleted before texts are compared.
BLANKS = b" \t\n\v\f\r"
#: Rows whose fingerprints one task sends together.
CHUNK = 200_000
#: Rows worked on together.
ROWS = 500
#: Fingerprints an owner gets, about.
OWNED = 500_000

PRINTS = "kind int, uid long, doc_id long, chars long, fp long, sha binary, chunk long, owner int, rank int, message binary"
REPLIES = "chunk long, owner int, bitmap array<long>"


def normal(text: bytes) -> bytes:
    return text.translate(None, BLANKS)


def _fingerprint(text: bytes) -> int:
    return xxhash.xxh3_64_intdigest(text)


def _prints(bits: int):
    """Rows of kind 0 describe documents, rows of kind 1 are messages to owners."""

    def flush(chunk: int, columns: list[list]) -> Iterator[pa.RecordBatch]:
        uid, doc_id, chars, fp, sha = columns
        fp = np.array(fp, dtype=np.uint64)
        values, place, counts = np.unique(fp, return_inverse=True, return_counts=True)
        owner = (values >> np.uint64(64 - bits)).astype(np.int64)
        first = np.searchsorted(owner, np.arange((1 << bits) + 1))
        rank = np.arange(len(values)) - first[owner]
        n = len(fp)
        none = lambda kind, k=n: pa.nulls(k, kind)
        schema = pa.schema([("kind", pa.int32()), ("uid", pa.int64()), ("doc_id", pa.int64()), ("chars", pa.int64()), ("fp", pa.int64()), ("sha", pa.binary()), ("chunk", pa.int64()), ("owner", pa.int32()), ("rank", pa.int32()), ("message", pa.binary())])
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.zeros(n, np.int32)), pa.array(uid, pa.int64()), pa.array(doc_id, pa.int64()), pa.array(chars, pa.int64()), pa.array(signed(fp)), pa.array(sha, pa.binary()),
             pa.array(np.full(n, chunk)), pa.array(owner[place].astype(np.int32)), pa.array(rank[place].astype(np.int32)), none(pa.binary())], schema=schema)
        to, message = [], []
        for k in np.unique(owner):
            a, b = first[k], first[k + 1]
            low = values[a:b] & np.uint64((1 << (64 - bits)) - 1)
            repeated = np.packbits(counts[a:b] > 1).tobytes()
            coded = golomb.encode(low)
            to.append(int(k))
            message.append(len(repeated).to_bytes(8, "little") + repeated + coded)
        m = len(to)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.ones(m, np.int32)), none(pa.int64(), m), none(pa.int64(), m), none(pa.int64(), m), none(pa.int64(), m), none(pa.binary(), m), pa.array(np.full(m, chunk)), pa.array(to, pa.int32()), none(pa.int32(), m), pa.array(message, pa.binary())], schema=schema)

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = row_numbers()
        columns: list[list] = [[], [], [], [], []]
        for batch in few(batches, ROWS):
            for doc_id, text, chars in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                text = normal(text)
                for column, x in zip(columns, (next(numbers), doc_id, chars, _fingerprint(text), hashlib.sha256(text).digest()), strict=True):
                    column.append(x)
                if len(columns[0]) >= CHUNK:
                    yield from flush(columns[0][0], columns)
                    columns = [[], [], [], [], []]
        if columns[0]:
            yield from flush(columns[0][0], columns)

    return run


def _reply(pdf: pd.DataFrame) -> pd.DataFrame:
    """What an owner answers: a bit for each fingerprint it was sent, set if another row has it too."""
    values, flags, sizes = [], [], []
    for message in pdf["message"]:
        k = int.from_bytes(message[:8], "little")
        coded = golomb.decode(message[8 + k :])
        values.append(coded)
        flags.append(np.unpackbits(np.frombuffer(message, np.uint8, k, 8), count=len(coded)).astype(bool))
        sizes.append(len(coded))
    _, place, counts = np.unique(np.concatenate(values), return_inverse=True, return_counts=True)
    marked = (counts[place] > 1) | np.concatenate(flags)
    rows, at = [], 0
    for chunk, owner, n in zip(pdf["chunk"], pdf["owner"], sizes, strict=True):
        bits = marked[at : at + n]
        at += n
        if bits.any():
            words = np.packbits(np.pad(bits, (0, -n % 64)), bitorder="little").view("<i8")
            rows.append((chunk, owner, words.tolist()))
    return pd.DataFrame(rows, columns=["chunk", "owner", "bitmap"])


def suspects(docs: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """All rows' fingerprints, and those that another row may share."""
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_bytes(), F.coalesce(F.length("text"), F.lit(0)).cast("long").alias("chars"))
    bits = max(4, math.ceil(math.log2(max(1, docs.count() / OWNED))))
    both = scratch.keep(source.mapInArrow(_prints(bits), PRINTS), "prints")
    prints = both.where("kind = 0").drop("kind", "message")
    replies = both.where("kind = 1").select("chunk", "owner", "message").groupBy("owner").applyInPandas(_reply, REPLIES)
    replies = scratch.keep(replies, "replies")
    bit = F.expr("shiftright(bitmap[cast(rank div 64 as int)], cast(rank % 64 as int)) & 1") == 1
    found = prints.join(replies, ["chunk", "owner"]).where(bit).select("uid", "doc_id", "chars", "fp", "sha")
    return prints, scratch.keep(found, "suspects")


def _sift(filter_, at: int, wanted: bool, number: bool = False):
    """Rows whose text, column `at`, fails the filter; or, if `wanted`, those that pass.

    These come with both hashes of the text and a row number, or as the hashes and the text without blanks.
    """

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap, numbers = filter_.value, row_numbers()
        for batch in few(batches, ROWS):
            texts = [normal(x or b"") for x in batch.column(at).cast(pa.binary()).to_pylist()]
            fps = np.fromiter(map(_fingerprint, texts), dtype=np.uint64, count=len(texts))
            hit = np.flatnonzero(passes(bitmap, fps) == wanted)
            if not len(hit):
                continue
            if not wanted:
                yield batch.take(pa.array(hit))
                continue
            own = [texts[i] for i in hit]
            hashes = [pa.array(signed(fps[hit])), pa.array([hashlib.sha256(x).digest() for x in own], pa.binary())]
            if number:
                whole = batch.take(pa.array(hit))
                last = pa.array([next(numbers) for _ in own], pa.int64())
                yield pa.RecordBatch.from_arrays([*whole.columns, *hashes, last], names=[*whole.schema.names, "_fp", "_sha", "_uid"])
            else:
                yield pa.RecordBatch.from_arrays([*hashes, pa.array(own, pa.binary())], names=["_fp", "_sha", "_text"])

    return run


def verified(texts: DataFrame) -> DataFrame:
    """Groups of equal bytes among the suspects' texts: sha, members.

    The grouping compares whole texts, combined in every task before the shuffle. Two texts of one
    hash, should they ever appear, stop the job.
    """
    groups = texts.groupBy("_fp", "_sha", "_text").agg(F.count(F.lit(1)).alias("members")).groupBy(F.col("_sha").alias("sha")).agg(F.sum("members").alias("members"), F.count(F.lit(1)).alias("texts"))
    return groups.select("sha", F.when(F.col("texts") == 1, F.col("members")).otherwise(F.raise_error(F.lit("two texts have one SHA-256")).cast("long")).alias("members")).where("members > 1")


def _best(rows: DataFrame) -> DataFrame:
    """For each sha the row with the most code points, then the smallest id."""
    order = F.struct("chars", F.col("doc_id").isNotNull().alias("a"), F.coalesce(F.bitwise_not("doc_id"), F.lit(0)).alias("b"), F.bitwise_not("uid").alias("c"))
    return rows.groupBy("sha").agg(F.max(order).alias("best")).select("sha", F.when(F.col("best.a"), F.bitwise_not("best.b")).alias("keep_id"), F.bitwise_not("best.c").alias("keep_uid"))


def copies(docs: DataFrame, scratch: Scratch | None = None) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 for every row of `docs` (doc_id, text)."""
    scratch = scratch or Scratch(docs.sparkSession, "exact")
    prints, found = suspects(docs, scratch)
    passed = docs.select(text_bytes()).mapInArrow(_sift(sieve(found, "fp"), 0, True), "_fp long, _sha binary, _text binary")
    groups = scratch.keep(verified(passed).join(_best(found), "sha"), "groups")
    total = prints.count()
    rows = join_groups(prints.select("uid", "doc_id", "sha"), groups, ["sha"], "members", total, "left")
    alone = F.col("members").isNull()
    return rows.select(
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("members", F.lit(1)).cast("long").alias("group_size"),
        (alone | (F.col("uid") == F.col("keep_uid"))).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )


def drop_copies(docs: DataFrame, scratch: Scratch | None = None) -> DataFrame:
    """The rows of `docs` that stay, with all their columns, whatever their names. Only suspects are shuffled."""
    scratch = scratch or Scratch(docs.sparkSession, "exact")
    plain = own_names(docs)
    _, found = suspects(plain, scratch)
    filter_, at = sieve(found, "fp"), plain.columns.index("text")
    clear = plain.mapInArrow(_sift(filter_, at, False), plain.schema)
    fields = [T.StructField("_fp", T.LongType()), T.StructField("_sha", T.BinaryType()), T.StructField("_uid", T.LongType())]
    rows = scratch.keep(plain.mapInArrow(_sift(filter_, at, True, number=True), T.StructType([*plain.schema.fields, *fields])), "rows")
    text = F.translate(F.coalesce("text", F.lit("")), BLANKS.decode(), "")
    groups = verified(rows.select("_fp", "_sha", text.alias("_text")))
    narrow = rows.select(F.col("_uid").alias("uid"), F.col("_sha").alias("sha"), F.coalesce(F.length("text"), F.lit(0)).alias("chars"), F.col("doc_id").cast("long").alias("doc_id"))
    best = _best(narrow).join(groups, "sha", "left").select(F.col("keep_uid").alias("_uid"))
    return clear.unionByName(rows.join(best, "_uid", "left_semi").select(*plain.columns)).toDF(*docs.columns)
