"""URL filters: rules as a sorted array of 64-bit digests, mapped into memory, probed by binary search.

A rule is a host, a start of a path and a verdict, "allow" or "block". It fits its host and all
subdomains, where the path starts with the rule's. Of several that fit, the one with the most code
points in host and path wins, then the one with the longer host.

1. `build` makes an index of the rules: entries for whole rules, and for each host the lengths of
   the paths it has rules for. Entries are dealt to shards by the leading bits of the XXH64 of their
   key; a shard holds its digests in order and, behind them, the keys and what they stand for.
   Spark's tasks write the shards as files to the shared folder.
2. `judge` hands these files to the executors, whose workers map them: pages are read when a search
   touches them, and shared by all workers of a machine. A batch of URLs gives the digests of all
   ends of its hosts, then those of the path starts that some rule of that host has the length of.
   Both are searched at once; a hit counts only if the stored key is the one that was looked for.

An index of more than `MAPPED` bytes isn't handed out: its rules are joined with the same keys.

The host of a URL stands behind the first `://` up to `/`, `?`, `#` or the end, with A-Z in lower
case; the path goes on from there up to `?`, `#` or the end. Both are empty if the URL is null or has
no `://`; then, and where no rule fits, the verdict is `otherwise` and the rule null. Rules
without a host are left out; a null path is empty; of rules that differ in the verdict alone, block
counts. A verdict of another name is an error. No rules and no rows are fine, repeated rows are
judged one by one, and very long URLs cost no more than the rules' lengths. Only the columns in
`keep` and the URL are read; kept columns called host, path, rule or verdict go.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from msgmart.llm.scratch import Scratch
from msgmart.llm.skew import join_groups
from msgmart.llm.texts import held

#: Entries of a shard, about.
SHARD = 200_000
#: Bytes of an index that is handed to every executor, at most.
MAPPED = 1 << 30
#: The seed with which Spark's xxhash64 hashes a single column.
SEED = 42
#: Between shards of one file; keeps arrays at multiples of eight bytes.
GAP = "\n" * 8
#: A key is one of these and the host, or host and path.
HOST, RULE = b"h", b"r"
VERDICTS = ("allow", "block")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Index:
    rules: DataFrame
    files: tuple[str, ...]
    bits: int
    size: int
    #: Bytes and labels of the longest host.
    host: int
    labels: int


def host_and_path(url: Column) -> tuple[Column, Column]:
    """The host, in lower case, and the path."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), "^[^?#]*", 0)
    return F.translate(host, UPPER, LOWER), path


def _ints(values) -> bytes:
    return np.asarray(values, "<i8").tobytes()


def _shard(pdf: pd.DataFrame) -> pd.DataFrame:
    """The entries of a shard, by digest and key: sizes, digests, where keys and values end, keys, values."""
    pdf = pdf.assign(digest=pdf["digest"].to_numpy().view(np.uint64)).sort_values(["digest", "key"])
    keys, values = list(pdf["key"]), list(pdf["value"])
    body = pdf["digest"].to_numpy().astype("<u8").tobytes() + _ints(np.cumsum([0, *map(len, keys)])) + _ints(np.cumsum([0, *map(len, values)])) + b"".join(keys) + b"".join(values)
    body += bytes(-len(body) % 8)
    blob = _ints([24 + len(body), pdf["shard"].iloc[0], len(keys)]) + body
    return pd.DataFrame({"blob": [blob]})


def entries(rules: DataFrame) -> DataFrame:
    """key, value: each rule with its verdict, and each host with the lengths of its rules' paths in bytes."""
    whole = rules.select(F.concat(F.lit(RULE), F.col("host").cast("binary"), F.col("path").cast("binary")).alias("key"), F.col("verdict").cast("binary").alias("value"))
    lengths = F.array_join(F.sort_array(F.collect_set(F.octet_length("path"))), " ")
    hosts = rules.groupBy("host").agg(lengths.alias("lengths")).select(F.concat(F.lit(HOST), F.col("host").cast("binary")).alias("key"), F.col("lengths").cast("binary").alias("value"))
    return whole.unionByName(hosts)


def build(rules: DataFrame, scratch: Scratch) -> Index:
    """The index of `rules` (host, path, verdict), whose files lie in the scratch folder."""
    verdict = F.when(F.col("verdict").isin(*VERDICTS), F.col("verdict")).otherwise(F.raise_error(F.concat(F.lit("unknown verdict: "), F.coalesce("verdict", F.lit("null")))).cast("string"))
    host = F.translate(F.col("host").cast("string"), UPPER, LOWER).alias("host")
    clean = rules.select(host, F.coalesce(F.col("path").cast("string"), F.lit("")).alias("path"), verdict.alias("verdict")).where("host <> ''")
    clean = scratch.keep(clean.groupBy("host", "path").agg(F.max("verdict").alias("verdict")), "rules")
    keyed = scratch.keep(entries(clean).select(F.xxhash64("key").alias("digest"), "key", "value"), "entries")
    n, size = keyed.select(F.count(F.lit(1)), F.coalesce(F.sum(F.length("key") + F.length("value") + 24), F.lit(0))).first()
    longest = clean.select(F.coalesce(F.max(F.octet_length("host")), F.lit(0)), F.coalesce(F.max(F.size(F.split("host", r"\."))), F.lit(0))).first()
    if not n or size > MAPPED:
        return Index(clean, (), 0, size, *longest)
    bits = max(0, math.ceil(math.log2(n / SHARD)))
    shard = F.shiftrightunsigned("digest", 64 - bits) if bits else F.lit(0).cast("long")
    blobs = keyed.withColumn("shard", shard).groupBy("shard").applyInPandas(_shard, "blob binary")
    blobs.select(F.col("blob").cast("string").alias("value")).write.option("lineSep", GAP).text(scratch.path("index"))
    listed = rules.sparkSession.read.format("binaryFile").option("pathGlobFilter", "part-*").load(scratch.path("index")).where("length > 0").select("path")
    return Index(clean, tuple(sorted(r["path"] for r in listed.collect())), bits, size, *longest)


class Mapped:
    """The shards of an index in files mapped into memory."""

    def __init__(self, files: tuple[str, ...], bits: int):
        self.bits = np.uint64(64 - bits)
        self.whole = bits == 0
        self.shards: dict[int, tuple] = {}
        for file in files:
            data = np.memmap(file, np.uint8, "r")
            at = 0
            while at < len(data):
                size, shard, n = data[at : at + 24].view("<i8").tolist()
                digests = data[at + 24 : at + 24 + 8 * n].view("<u8")
                ends = data[at + 24 + 8 * n : at + 40 + 24 * n].view("<i8")
                keys = at + 40 + 24 * n
                self.shards[shard] = data, digests, ends[: n + 1], ends[n + 1 :], keys, keys + int(ends[n])
                at += size + len(GAP)

    def find(self, keys: list[bytes]) -> list[bytes | None]:
        """What each key stands for, if it is in the index."""
        out: list[bytes | None] = [None] * len(keys)
        digests = np.fromiter((xxhash.xxh64_intdigest(x, SEED) for x in keys), np.uint64, len(keys))
        shards = np.zeros(len(keys), np.int64) if self.whole else (digests >> self.bits).astype(np.int64)
        for shard in np.unique(shards).tolist():
            if shard not in self.shards:
                continue
            data, known, key_ends, value_ends, first_key, first_value = self.shards[shard]
            here = np.flatnonzero(shards == shard)
            place = np.searchsorted(known, digests[here])
            hit = place < len(known)
            hit[hit] = known[place[hit]] == digests[here[hit]]
            for i, at in zip(here[hit].tolist(), place[hit].tolist(), strict=True):
                # several keys may have one digest
                while at < len(known) and known[at] == digests[i]:
                    if data[first_key + key_ends[at] : first_key + key_ends[at + 1]].tobytes() == keys[i]:
                        out[i] = data[first_value + value_ends[at] : first_value + value_ends[at + 1]].tobytes()
                        break
                    at += 1
        return out


def _ends(host: bytes, longest: int) -> Iterator[bytes]:
    """The host and what stands behind each of its dots, where that isn't longer than any rule's host."""
    if len(host) <= longest:
        yield host
    at = host.find(b".", max(0, len(host) - longest - 1))
    while at >= 0:
        yield host[at + 1 :]
        at = host.find(b".", at + 1)


def _judged(names: tuple[str, ...], bits: int, longest: int, otherwise: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = held(Mapped, tuple(map(SparkFiles.get, names)), bits)
        for batch in batches:
            k = batch.num_columns - 2
            coded = batch.column(k).dictionary_encode()
            hosts = [x.encode() for x in coded.dictionary.to_pylist()]
            looked = [(i, end) for i, host in enumerate(hosts) for end in _ends(host, longest)]
            lengths: list[list[tuple[bytes, list[int]]]] = [[] for _ in hosts]
            for (i, end), value in zip(looked, index.find([HOST + end for _, end in looked]), strict=True):
                if value is not None:
                    lengths[i].append((end, list(map(int, value.split()))))
            wanted: list[tuple[int, bytes, bytes]] = []
            for row, (i, path) in enumerate(zip(coded.indices.to_pylist(), batch.column(k + 1).to_pylist(), strict=True)):
                if lengths[i]:
                    path = path.encode()
                    wanted += [(row, end, path[:n]) for end, ns in lengths[i] for n in ns if n <= len(path)]
            best: dict[int, tuple[int, int, str, str]] = {}
            for (row, end, start), value in zip(wanted, index.find([RULE + end + start for _, end, start in wanted]), strict=True):
                if value is not None:
                    host, rule = end.decode(), (end + start).decode()
                    found = (len(rule), len(host), rule, value.decode())
                    best[row] = max(best.get(row, found), found)
            rows = [best.get(row, (0, 0, None, otherwise)) for row in range(batch.num_rows)]
            columns = [*batch.columns, pa.array([r[2] for r in rows], pa.string()), pa.array([r[3] for r in rows], pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, "rule", "verdict"])

    return run


def _joined(rows: DataFrame, index: Index, otherwise: str, scratch: Scratch) -> DataFrame:
    """The same by joins, for an index too large to be handed out."""
    rows = scratch.keep(rows.withColumn("row", F.monotonically_increasing_id()), "urls")
    total = rows.count()
    labels = F.slice(F.reverse(F.split("host", r"\.")), 1, index.labels)
    ends = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda n: F.array_join(F.reverse(F.slice(labels, 1, n)), "."))
    hosts = rows.groupBy("host").agg(F.count(F.lit(1)).alias("n"))
    having = index.rules.groupBy(F.col("host").alias("end")).agg(F.sort_array(F.collect_set(F.length("path"))).alias("lengths"))
    hosts = hosts.select("host", "n", F.explode(ends).alias("end")).join(having, "end").groupBy("host", "n").agg(F.collect_list(F.struct("end", "lengths")).alias("ends"))
    known = join_groups(rows.select("row", "host", "path"), hosts, ["host"], "n", total).select("row", "path", F.explode("ends").alias("e"))
    known = known.select("row", "path", "e.end", F.explode("e.lengths").alias("length")).where("length <= length(path)")
    wanted = scratch.keep(known.select("row", "end", F.expr("substring(path, 1, length)").alias("start")), "wanted")
    keys = wanted.groupBy("end", "start").agg(F.count(F.lit(1)).alias("n"))
    keys = keys.join(index.rules.select(F.col("host").alias("end"), F.col("path").alias("start"), F.col("verdict").alias("found")), ["end", "start"])
    hits = join_groups(wanted, keys, ["end", "start"], "n", total)
    rule = F.concat("end", "start")
    best = hits.groupBy("row").agg(F.max(F.struct(F.length(rule).alias("a"), F.length("end").alias("b"), rule.alias("rule"), F.col("found").alias("verdict"))).alias("best"))
    named = rows.join(best, "row", "left")
    return named.select(*[c for c in rows.columns if c != "row"], F.col("best.rule").alias("rule"), F.coalesce("best.verdict", F.lit(otherwise)).alias("verdict"))


def judge(pages: DataFrame, index: Index, scratch: Scratch, keep: Sequence[str] = (), url: str = "url", otherwise: str = "allow") -> DataFrame:
    """The columns `keep` of `pages`, and host, path, rule and verdict of each URL."""
    kept = [c for c in keep if c.lower() not in ("host", "path", "rule", "verdict")]
    host, path = host_and_path(F.coalesce(F.col(url).cast("string"), F.lit("")))
    names = [f"kept{i}" for i in range(len(kept))]
    rows = pages.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(kept, names, strict=True)], host.alias("host"), path.alias("path"))
    if index.size > MAPPED:
        done = _joined(rows, index, otherwise, scratch)
    else:
        context = pages.sparkSession.sparkContext
        for file in index.files:
            context.addFile(file)
        schema = T.StructType([*rows.schema.fields, T.StructField("rule", T.StringType()), T.StructField("verdict", T.StringType())])
        done = rows.mapInArrow(_judged(tuple(f.rsplit("/", 1)[1] for f in index.files), index.bits, index.host, otherwise), schema)
    return done.select(*[F.col(n).alias(c) for c, n in zip(kept, names, strict=True)], "host", "path", "rule", "verdict")
