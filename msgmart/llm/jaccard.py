"""Similarity join on word n-grams, with Bayesian pruning of candidates.

Every text is the set of its runs of `width` words. Rows of equal sets are one class. Then:

1. MinHash values of each class are cut into bands; classes that agree in a band are candidates. With
   `Settings.bands` bands of `Settings.rows` values a pair at the threshold agrees nowhere with a
   probability of 5e-8. Bands with the same members count once.
2. Within a band the MinHash values are compared a few at a time. Of n values m agree; with a
   uniform prior the similarity then follows a Beta(m + 1, n - m + 1) distribution. A pair is dropped
   as soon as the probability that it reaches the threshold falls below `Settings.tolerance`.
3. Of the pairs that are left a forest is kept, and its components found. Both classes of every such pair
   are in one component. Only for these classes sets are built and shuffled.
4. In each component the pairs that survive the same comparison are verified exactly, on the sets.

Bands and components of more than about `Settings.block` classes are cut into parts, and each two parts
meet in one task, so no task gets a whole group. Nothing is returned for each pair: tasks count the
links of each class and keep a forest of the links, which is enough to connect them. Every link
between different sets is counted.

Words are `[^\\x20\\x09-\\x0D]+`, unchanged. A text of fewer than `width` words, but at least one,
has one run, all its words. Null texts and those without words have no runs and no links. Repeated
rows and null ids are rows of their own. An empty table gives an empty result; other columns are
not read.
"""

from __future__ import annotations

import functools
import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from msgmart.llm.components import components
from msgmart.llm.scratch import Scratch
from msgmart.llm.sieve import passes, sieve
from msgmart.llm.skew import join_groups
from msgmart.llm.texts import grouped, own_names, packed, row_numbers, scramble, signed, text_bytes, tidy, window_hashes, word_hashes

ROWS = 500


@dataclass(frozen=True)
class Settings:
    width: int = 5
    #: Similarity to reach, as a fraction.
    parts: int = 4
    whole: int = 5
    bands: int = 32
    rows: int = 4
    #: MinHash values compared at a time, and the probability below which a pair is dropped.
    step: int = 16
    tolerance: float = 1e-7
    block: int = 256
    seed: int = 5

    @property
    def values(self) -> int:
        return self.bands * self.rows


def shingles(words: np.ndarray, width: int) -> np.ndarray:
    """The sorted distinct hashes of all runs of `width` words."""
    return np.unique(window_hashes(words, min(width, len(words)))) if len(words) else np.empty(0, np.uint64)


@functools.cache
def _factors(n: int, seed: int) -> np.ndarray:
    return (np.random.default_rng(seed).integers(0, 2**63, (n, 1), dtype=np.uint64) << np.uint64(1)) | np.uint64(1)


def minhash(runs: np.ndarray, settings: Settings) -> np.ndarray:
    """The MinHash values, 32 bits each."""
    factors = _factors(settings.values, settings.seed)
    out = np.full(settings.values, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(runs), 2048):
        part = factors * runs[None, at : at + 2048]
        np.minimum(out, (part >> np.uint64(32)).min(axis=1).astype(np.uint32), out=out)
    return out


def least_matches(n: int, threshold: float, tolerance: float) -> int:
    """The fewest of n agreeing values with which P(similarity >= threshold) is not below tolerance.

    The probability is that of a Beta(m + 1, n - m + 1) variable, summed as a binomial: the chance of at most m successes of n + 1.
    """
    logs = [math.lgamma(n + 2) - math.lgamma(k + 1) - math.lgamma(n + 2 - k) + k * math.log(threshold) + (n + 1 - k) * math.log(1 - threshold) for k in range(n + 2)]
    total = 0.0
    for m in range(n + 1):
        total += math.exp(logs[m])
        if total >= tolerance:
            return m
    return n


SIGNED = [*(T.StructField(x, T.LongType()) for x in ("_uid", "_runs", "_set_a", "_set_b")), T.StructField("_minhash", T.BinaryType()), T.StructField("_bands", T.ArrayType(T.LongType()))]


def _sign(settings: Settings):
    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, numbers = word_hashes(), row_numbers()
        offsets = np.arange(settings.bands, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        for batch in batches:
            texts = batch.column(batch.num_columns - 1).to_pylist()
            for at in range(0, len(texts), ROWS):
                rows, bands = [], []
                for text in texts[at : at + ROWS]:
                    runs = shingles(hashes(text), settings.width)
                    digest = np.frombuffer(hashlib.blake2b(runs.tobytes(), digest_size=16).digest(), "<i8")
                    values = minhash(runs, settings)
                    if len(runs):
                        band = offsets.copy()
                        for column in values.reshape(settings.bands, settings.rows).T:
                            band = scramble(band ^ column)
                        bands.append(signed(band))
                    else:
                        bands.append(np.empty(0, np.int64))
                    rows.append((next(numbers), len(runs), int(digest[0]), int(digest[1]), values.tobytes()))
                columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), [*[pa.int64()] * 4, pa.binary()], strict=True)]
                lists = packed(np.fromiter(map(len, bands), np.int64, len(bands)), pa.array(np.concatenate(bands)))
                kept = [c.slice(at, len(rows)) for c in batch.columns]
                yield pa.RecordBatch.from_arrays([*kept, *columns, lists], names=[*batch.schema.names, *(f.name for f in SIGNED)])

    return run


def _runs_of(filter_, settings: Settings):
    """uid and runs of the rows (uid, hash of uid, text) that pass the filter."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = word_hashes()
        for batch in batches:
            hit = np.flatnonzero(passes(filter_.value, batch.column(1).to_numpy()))
            for at in range(0, len(hit), ROWS):
                part = batch.take(pa.array(hit[at : at + ROWS]))
                runs = pa.array([shingles(hashes(x), settings.width).tobytes() for x in part.column(2).to_pylist()], pa.binary())
                yield pa.RecordBatch.from_arrays([part.column(0), runs], names=["uid", "sets"])

    return run


def surviving(a: np.ndarray, b: np.ndarray, settings: Settings) -> np.ndarray:
    """Which pairs of rows of the MinHash matrices a and b are left, as an array of index pairs."""
    threshold = settings.parts / settings.whole
    agree = np.zeros((len(a), len(b)), np.int16)
    alive = None
    for n in range(settings.step, settings.values + 1, settings.step):
        part = slice(n - settings.step, n)
        least = least_matches(n, threshold, settings.tolerance)
        if alive is None:
            for k in range(part.start, part.stop):
                agree += a[:, k, None] == b[None, :, k]
            i, j = np.nonzero(agree >= least)
            alive, found = np.stack([i, j]), agree[i, j].astype(np.int32)
        else:
            i, j = alive
            found = found + (a[i, part] == b[j, part]).sum(axis=1)
            keep = found >= least
            alive, found = alive[:, keep], found[keep]
        if not alive.size:
            break
    return alive


def overlaps(sets: list[np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The sizes of the intersections of the sets i and j, through an index of which set has which run."""
    used = np.unique(np.concatenate([i, j]))
    place = {int(x): k for k, x in enumerate(used)}
    sizes = np.array([len(sets[x]) for x in used])
    _, runs, times = np.unique(np.concatenate([sets[x] for x in used]), return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(len(used)), sizes)
    shared = times[runs] > 1
    runs, owner = runs[shared], owner[shared]
    _, runs = np.unique(runs, return_inverse=True)
    pairs = np.stack([[place[int(x)] for x in i], [place[int(x)] for x in j]]).astype(np.int64)
    out = np.zeros(len(i), np.int64)
    total = int(runs.max()) + 1 if len(runs) else 0
    if len(i) * 20 > len(used) * len(used):  # many of all pairs: a product of incidence matrices, a slice of runs at a time
        product = np.zeros((len(used), len(used)), np.float32)
        order = np.argsort(runs, kind="stable")
        runs, owner = runs[order], owner[order]
        for at in range(0, total, 4096):
            a, b = np.searchsorted(runs, [at, at + 4096])
            table = np.zeros((len(used), min(4096, total - at)), np.float32)
            table[owner[a:b], runs[a:b] - at] = 1
            product += table @ table.T
        return product[pairs[0], pairs[1]].astype(np.int64)
    order = np.argsort(owner, kind="stable")
    bounds = np.searchsorted(owner[order], np.arange(len(used) + 1))
    members = [runs[order[a:b]] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
    mark = np.zeros(total, bool)
    last = -1
    for k in np.argsort(pairs[0], kind="stable"):
        x, y = pairs[:, k]
        if x != last:
            mark[:] = False
            mark[members[x]] = True
            last = x
        out[k] = int(mark[members[y]].sum())
    return out


class Forest:
    """Links that are enough to connect what all links connect."""

    def __init__(self, n: int):
        self.parent = list(range(n))
        self.links: list[tuple[int, int]] = []

    def root(self, x: int) -> int:
        parent = self.parent
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    def add(self, i: np.ndarray, j: np.ndarray) -> None:
        for x, y in zip(i.tolist(), j.tolist(), strict=True):
            a, b = self.root(x), self.root(y)
            if a != b:
                self.parent[a] = b
                self.links.append((x, y))


def _meetings(group: pa.Table, settings: Settings) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Surviving pairs of a group of rows (key, one, two, part, uid, minhash, ...): those of part one with those of part two."""
    part = group["part"].to_numpy()
    one, two = group["one"][0].as_py(), group["two"][0].as_py()
    values = np.frombuffer(b"".join(group["minhash"].to_pylist()), np.uint32).reshape(group.num_rows, -1)
    left, right = np.flatnonzero(part == one), np.flatnonzero(part == two)
    for at in range(0, len(left), settings.block):
        mine = left[at : at + settings.block]
        for to in range(at if one == two else 0, len(right), settings.block):
            other = right[to : to + settings.block]
            pairs = surviving(values[mine], values[other], settings)
            i, j = mine[pairs[0]], other[pairs[1]]
            if one == two and at == to:
                i, j = i[i < j], j[i < j]
            if len(i):
                yield i, j


def _prune(settings: Settings):
    """What the surviving candidates of each band connect, as links to the least of each part."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a: list[int] = []
        b: list[int] = []
        for group in grouped(batches, 3):
            uid = group["uid"].to_pylist()
            forest = Forest(len(uid))
            for i, j in _meetings(group, settings):
                forest.add(i, j)
            least: dict[int, int] = {}
            parts = [forest.root(x) for x in range(len(uid))] if forest.links else []
            for x, part in zip(uid, parts, strict=False):
                least[part] = min(x, least.get(part, x))
            stars = [(least[part], x) for x, part in zip(uid, parts, strict=False) if least[part] != x]
            a += [x for x, _ in stars]
            b += [x for _, x in stars]
            if len(a) > 50_000:
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])
                a, b = [], []
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return run


LINKS = "uid long, peer long, links long"


def _compare(settings: Settings):
    """Verified links: for each class how many rows it is linked to (no peer), and a forest of the links."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in grouped(batches, 3):
            uid, members = group["uid"].to_numpy(), group["members"].to_numpy()
            sets = [np.frombuffer(x, np.uint64) for x in group["sets"].to_pylist()]
            sizes = np.array([len(x) for x in sets], np.int64)
            links, forest = np.zeros(len(uid), np.int64), Forest(len(uid))
            for i, j in _meetings(group, settings):
                # sizes alone rule out so high a similarity
                fit = np.minimum(sizes[i], sizes[j]) * settings.whole >= np.maximum(sizes[i], sizes[j]) * settings.parts
                i, j = i[fit], j[fit]
                if not len(i):
                    continue
                common = overlaps(sets, i, j)
                sure = common * settings.whole >= (sizes[i] + sizes[j] - common) * settings.parts
                i, j = i[sure], j[sure]
                np.add.at(links, i, members[j])
                np.add.at(links, j, members[i])
                forest.add(i, j)
            linked = np.flatnonzero(links)
            ends = np.array(forest.links, np.int64).reshape(-1, 2)
            nobody = pa.nulls(len(linked), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(uid[linked]), nobody, pa.array(links[linked])], names=["uid", "peer", "links"])
            yield pa.RecordBatch.from_arrays([pa.array(uid[ends[:, 0]]), pa.array(uid[ends[:, 1]]), pa.array(np.zeros(len(ends), np.int64))], names=["uid", "peer", "links"])

    return run


def _meet(rows: DataFrame, key: str, settings: Settings) -> DataFrame:
    """Rows (key, parts, uid, ...) dealt so that each two parts of a group meet, sorted by group."""
    part = F.pmod(F.xxhash64("uid"), F.col("parts")).cast("int")
    rows = rows.withColumn("part", part).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    rest = [x for x in rows.columns if x not in (key, "parts", "part", "other")]
    rows = rows.select(key, F.least("part", "other").alias("one"), F.greatest("part", "other").alias("two"), "part", *rest)
    return rows.repartition(key, "one", "two").sortWithinPartitions(key, "one", "two")


def _parts(settings: Settings):
    return F.ceil(F.col("size") / settings.block).cast("int").alias("parts")


def to_least(links: DataFrame) -> DataFrame:
    """Links (a, b), a < b, that connect what `links` connect: all but that to the least a of a b lead from this one to the other a.

    A class has a link for each band and each part it meets there; where they move to, most are the same.
    """
    lists = links.groupBy("b").agg(F.array_sort(F.collect_set("a")).alias("less"))
    others = F.slice("less", 2, F.greatest(F.size("less") - 1, F.lit(0)))
    return lists.select(F.col("less")[0].alias("a"), F.explode(F.concat(F.array("b"), others)).alias("b")).distinct()


def sign(docs: DataFrame, settings: Settings, scratch: Scratch) -> DataFrame:
    """`docs` with a row number, the number of runs, a 128-bit hash of the set, MinHash values and bands."""
    return scratch.keep(docs.select("*", text_bytes().alias("_text")).mapInArrow(_sign(settings), T.StructType([*docs.schema.fields, T.StructField("_text", T.BinaryType()), *SIGNED])), "signed")


def classify(signed_rows: DataFrame, settings: Settings, scratch: Scratch) -> DataFrame:
    """uid, doc_id, copy_of, class_id, group_rows, n_links, first for each row of `sign`."""
    rows = signed_rows.select(F.col("_uid").alias("uid"), F.col("doc_id").cast("long").alias("doc_id"), F.col("_runs").alias("runs"), F.col("_set_a").alias("set_a"), F.col("_set_b").alias("set_b"), F.col("_bands").alias("bands"), F.col("_minhash").alias("minhash"), F.col("_text").alias("text"))
    key = ["set_a", "set_b"]
    total = rows.count()
    order = F.struct(F.col("doc_id").isNull().alias("a"), "doc_id", "uid")
    classes = rows.where("runs > 0").groupBy(*key).agg(F.min(order).alias("first"), F.count(F.lit(1)).alias("members"))
    classes = scratch.keep(classes.select(*key, F.col("first.uid").alias("rep"), F.col("first.doc_id").alias("copy_of"), "members"), "classes")
    heads = scratch.keep(rows.select("uid", "minhash", "bands").join(classes.select(F.col("rep").alias("uid"), "members"), "uid"), "heads")

    # bands of several classes, one of those with the same members
    bands = heads.select("uid", F.explode("bands").alias("band"))
    several = bands.groupBy("band").agg(F.count(F.lit(1)).alias("size"), F.bit_xor(F.xxhash64("uid")).alias("x"), F.bit_xor(F.xxhash64("uid", F.lit(1))).alias("y")).where("size > 1")
    several = several.groupBy("size", "x", "y").agg(F.min("band").alias("band")).select("band", "size", _parts(settings))
    several = scratch.keep(several, "bands")
    candidates = join_groups(bands, several, ["band"], "size", total * settings.bands).select("band", "parts", "uid")
    left = _meet(candidates.join(heads.select("uid", "minhash"), "uid"), "band", settings).mapInArrow(_prune(settings), "a long, b long")
    left = scratch.keep(to_least(left), "candidates")
    near = scratch.keep(components(left, scratch, "near").withColumnRenamed("node", "uid"), "near")

    sizes = near.groupBy("component").agg(F.count(F.lit(1)).alias("size")).select("component", "size", _parts(settings))
    dealt = join_groups(near, scratch.keep(sizes, "sizes"), ["component"], "size", total).select("component", "parts", "uid")
    texts = rows.select("uid", F.xxhash64("uid").alias("h"), "text").mapInArrow(_runs_of(sieve(near, F.xxhash64("uid")), settings), "uid long, sets binary")
    full = dealt.join(heads.select("uid", "members", "minhash"), "uid").join(texts, "uid")
    links = scratch.keep(_meet(full, "component", settings).mapInArrow(_compare(settings), LINKS), "links")

    joined = components(links.where("peer is not null").select(F.col("uid").alias("a"), F.col("peer").alias("b")), scratch, "joined").withColumnRenamed("node", "rep")
    counted = links.where("peer is null").groupBy(F.col("uid").alias("rep")).agg(F.sum("links").alias("links"))
    told = classes.join(joined, "rep", "left").join(counted, "rep", "left")
    told = scratch.keep(told.select(*key, "rep", "copy_of", "members", F.coalesce("component", "rep").alias("component"), F.coalesce("links", F.lit(0)).alias("links")), "told")
    best = F.struct(F.col("copy_of").isNull().alias("a"), "copy_of", "rep")
    first = told.groupBy("component").agg(F.min(best).alias("first"), F.sum("members").alias("group_rows"), F.count(F.lit(1)).alias("sets"))
    first = scratch.keep(first.select("component", F.col("first.copy_of").alias("class_id"), F.col("first.rep").alias("stays"), "group_rows", "sets"), "first")
    named = scratch.keep(join_groups(told, first, ["component"], "sets", total), "named")
    out = join_groups(rows.select("uid", "doc_id", *key), named, key, "members", total, "left")
    alone = F.col("rep").isNull()
    return out.select(
        "uid",
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("copy_of")).alias("copy_of"),
        F.when(alone, F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("group_rows", F.lit(1)).cast("long").alias("group_rows"),
        (F.coalesce("links", F.lit(0)) + F.coalesce("members", F.lit(1)) - 1).cast("long").alias("n_links"),
        (alone | (F.col("stays") == F.col("uid"))).alias("first"),
    )


def similar(docs: DataFrame, settings: Settings = Settings(), scratch: Scratch | None = None) -> DataFrame:
    """doc_id, copy_of, class_id, group_rows, n_links, first for each row of `docs` (doc_id, text).

    class_id: the least doc_id among all rows that links connect, group_rows: how many these are,
    first: whether this row stands for them. copy_of: the least doc_id among the rows of the same set.
    n_links: the other rows of the threshold's similarity or more, those of the same set included.
    """
    scratch = scratch or Scratch(docs.sparkSession, "jaccard")
    return classify(sign(docs.select("doc_id", "text"), settings, scratch), settings, scratch).drop("uid")


def keep_first(docs: DataFrame, settings: Settings = Settings(), scratch: Scratch | None = None) -> DataFrame:
    """One row of each group of `docs`, with all its columns, whatever their names. Only rows that may have to go are shuffled."""
    scratch = scratch or Scratch(docs.sparkSession, "jaccard")
    names, docs = docs.columns, own_names(docs)
    rows = sign(docs, settings, scratch)
    gone = scratch.keep(classify(rows, settings, scratch).where("not first").select(F.col("uid").alias("_uid")), "gone")
    plain = rows.select(*docs.columns, "_uid", F.xxhash64("_uid").alias("_h"))
    filter_ = sieve(gone, F.xxhash64("_uid"))
    sure = plain.mapInArrow(_sorted_out(filter_, False), plain.schema)
    open_ = plain.mapInArrow(_sorted_out(filter_, True), plain.schema).join(gone, "_uid", "left_anti")
    return sure.select(*docs.columns).unionByName(open_.select(*docs.columns)).toDF(*names)


def _sorted_out(filter_, wanted: bool):
    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hit = passes(filter_.value, batch.column(batch.num_columns - 1).to_numpy())
            yield batch.filter(pa.array(hit == wanted))

    return run
