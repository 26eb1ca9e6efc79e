"""Prefix trie of conversations, with totals of subtrees by centroid decomposition.

A node stands for a sequence of first turns (role, text) that some conversations share, its members.
Nodes are keyed by 128 bits: the XOR of one hash for each turn at its place, so that keys of all
prefixes are a running XOR, which `msgmart.operators.ranks` gives for conversations of any length,
and a turn's own hash leads from a key to the parent's.

Totals over subtrees are made by decomposing the forest of parent edges. A component is a connected
part of the trie below its top node. In each round every component is split at its centroid, the deepest node
that has more than half of the component's weight below it (weights are conversations times turns, known
from the start). The nodes with more than half are just those on the way from the centroid to the top. What the
centroid and the components below it hold together is added to all of these, their weights lose what
lay below, and the parts go on by themselves. Two nodes one above the other are parted once, by a
centroid between them; so each value is added once to each of its ancestors, and in a round a
node is written once. Weights halve, so about log2(weight) rounds do, but components of up to
`LOCAL` nodes are finished inside tasks, which decompose them the same way.

Which component a node falls into is told by its owner, the smallest member, whose own turns pass
the centroid and the child below it, or don't. A node is looked up by the owner's turn at that
depth; stretches of an owner's nodes are looked up together.

Rows without a conversation are left out. Null roles and texts are empty. Turns are ordered by turn, null
first, then by role and by the SHA-256 of the text; repeated rows are turns of their own. Very long
texts are hashed where they are read. Conversations with no turns are members of the root only. An
empty table has no nodes. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from msgmart.llm.scratch import Scratch
from msgmart.llm.skew import join_groups
from msgmart.operators.ranks import numbered, running

#: Nodes of a component that one task finishes.
LOCAL = 50_000
#: Nodes of one owner that are looked up together.
STRETCH = 4096
#: Ids of a node that travel as one text.
IDS = 4096
KEY = ["k1", "k2"]
TOP = ["c1", "c2"]


def placed_turns(conversations: DataFrame, scratch: Scratch) -> DataFrame:
    """conv, p (place from 1), bytes, t1, t2 of every turn; t1 and t2 stand for role and text."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv"),
        F.col("turn").alias("turn"),
        role.alias("role"),
        F.sha2(text, 256).alias("sha"),
        F.octet_length(text).cast("long").alias("bytes"),
        F.monotonically_increasing_id().alias("uid"),
    )
    order = [F.col("turn").asc_nulls_first(), F.col("role"), F.col("sha"), F.col("uid")]
    placed = numbered(scratch.keep(rows, "rows"), ["conv"], order, scratch.path("turn-ranges"), "p")
    half = lambda k: F.conv(F.substring("both", 1 + 16 * k, 16), 16, -10).cast("long").alias(f"t{k + 1}")
    both = F.sha2(F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "sha"), 256).alias("both")
    placed = placed.select("conv", "p", "bytes", both).select("conv", "p", "bytes", half(0), half(1))
    return scratch.keep(placed, "turns")


def branched(turns: DataFrame, scratch: Scratch, every: int = 5, most: int = 8) -> DataFrame:
    """Conversations that begin as another one does: conv, pos, length, bytes, t1, t2.

    Conversation c starts with the first h turns of c - c % `every` and goes on with its own turns behind
    its first h; h is crc32 of the decimal c, modulo `most` + 1. Each also has a row without a turn, pos 0.
    """
    sizes = scratch.keep(turns.groupBy("conv").agg(F.max("p").alias("n")), "sizes")
    h = F.crc32(F.col("conv").cast("string").cast("binary")) % (most + 1)
    convs = sizes.select("conv", "n", h.alias("h"), (F.col("conv") - F.col("conv") % every).alias("base"))
    convs = convs.join(sizes.select(F.col("conv").alias("base"), F.col("n").alias("there")), "base", "left")
    taken = F.least("h", F.coalesce("there", F.lit(0)))
    convs = convs.withColumn("taken", taken).withColumn("length", F.col("taken") + F.greatest(F.col("n") - F.col("h"), F.lit(0)))
    convs = scratch.keep(convs.select("conv", "n", "h", "base", "taken", "length"), "convs")
    total = convs.select(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    own = join_groups(turns, convs, ["conv"], "n", total).where("p > h").select("conv", (F.col("p") - F.col("h") + F.col("taken")).alias("pos"), "length", "bytes", "t1", "t2")
    heads = turns.where(F.col("p") <= most).withColumnRenamed("conv", "base")
    lent = convs.where("taken > 0").select("conv", "base", "taken", "length").join(heads, "base").where("p <= taken").select("conv", F.col("p").alias("pos"), "length", "bytes", "t1", "t2")
    none = [F.lit(0).cast("long").alias(c) for c in ("bytes", "t1", "t2")]
    roots = convs.select("conv", F.lit(0).cast("long").alias("pos"), "length", *none)
    return own.unionByName(lent).unionByName(roots)


def paths(branches: DataFrame, scratch: Scratch) -> DataFrame:
    """`branches` with the key of the node at each place, k1 and k2, and that of its parent, p1 and p2 (0 for the root's)."""
    mark = [F.when(F.col("pos") == 0, 0).otherwise(F.xxhash64(F.lit(k), "pos", "t1", "t2")).cast("long").alias(f"x{k}") for k in (1, 2)]
    rows = scratch.keep(branches.select("conv", "pos", "length", "bytes", *mark), "branches")
    keyed = running(rows, ["conv"], [F.col("pos")], {"k1": ("xor", F.col("x1")), "k2": ("xor", F.col("x2"))}, scratch.path("path-ranges"))
    parent = [F.when(F.col("pos") > 0, F.col(f"k{k}").bitwiseXOR(F.col(f"x{k}"))).otherwise(0).cast("long").alias(f"p{k}") for k in (1, 2)]
    return scratch.keep(keyed.select("conv", "pos", "length", "bytes", *KEY, *parent), "paths")


def trie_nodes(walked: DataFrame, scratch: Scratch) -> DataFrame:
    """One row per node: key, parent's key, depth, conv (the smallest member), n_convs, bytes, weight, n_children."""
    nodes = walked.groupBy(*KEY).agg(
        F.max("p1").alias("p1"),
        F.max("p2").alias("p2"),
        F.max("pos").alias("depth"),
        F.min("conv").alias("conv"),
        F.count(F.lit(1)).alias("n_convs"),
        F.max("bytes").alias("bytes"),
        F.sum(F.col("length") - F.col("pos") + 1).alias("weight"),
    )
    nodes = scratch.keep(nodes, "nodes")
    children = nodes.where("depth > 0").groupBy(F.col("p1").alias("k1"), F.col("p2").alias("k2")).agg(F.count(F.lit(1)).alias("n_children"))
    return scratch.keep(nodes.join(children, KEY, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0))), "trie")


def _id_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows k1, k2, conv as texts of up to `IDS` ids of one key."""
    key, ids, out = None, [], []

    def row():
        return *key, ids[0], ",".join(map(str, ids))

    def batch():
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.int64(), pa.int64(), pa.int64(), pa.string()), strict=True)], names=["k1", "k2", "first", "ids"])

    for part in batches:
        for k1, k2, conv in zip(*(c.to_pylist() for c in part.columns), strict=True):
            if ids and (key != (k1, k2) or len(ids) == IDS):
                out.append(row())
                ids = []
                if len(out) == 2000:
                    yield batch()
                    out = []
            key = k1, k2
            ids.append(conv)
    if ids:
        out.append(row())
    if out:
        yield batch()


def _id_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows k1, k2, first, ids as one digest of each key's texts, joined by commas."""
    key = state = None
    for part in batches:
        out = []
        for k1, k2, ids in zip(*(part.column(c).to_pylist() for c in ("k1", "k2", "ids")), strict=True):
            if key != (k1, k2):
                if key is not None:
                    out.append((*key, state.hexdigest()))
                key, state = (k1, k2), hashlib.sha256(ids.encode())
            else:
                state.update(b"," + ids.encode())
        yield _digest_rows(out)
    if key is not None:
        yield _digest_rows([(*key, state.hexdigest())])


def _digest_rows(rows: list[tuple[int, int, str]]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [(), (), ()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.string()), strict=True)], names=["k1", "k2", "ends_sha256"])


def ends(walked: DataFrame) -> DataFrame:
    """k1, k2, ends_sha256: for each node the digest of the ids of the conversations that end there.

    Ids are sorted and turned into texts in ranges, so that the task that digests a node gets few rows.
    """
    last = walked.where("pos = length").select(*KEY, "conv")
    texts = last.repartitionByRange(*KEY, "conv").sortWithinPartitions(*KEY, "conv").mapInArrow(_id_texts, "k1 long, k2 long, first long, ids string")
    return texts.repartition(*KEY).sortWithinPartitions(*KEY, "first").mapInArrow(_id_digests, "k1 long, k2 long, ends_sha256 string")


def decompose(parent: list[int], values: np.ndarray) -> np.ndarray:
    """Totals of subtrees: `values` has a row per node, parents stand before their children and are -1 at the top."""
    n = len(parent)
    parts: dict[int, list[int]] = {}
    top = list(range(n))
    for v in range(n):
        if parent[v] >= 0:
            top[v] = top[parent[v]]
        parts.setdefault(top[v], []).append(v)
    waiting = list(parts.values())
    total, size, place = np.zeros_like(values), [0] * n, [0] * n
    while waiting:
        part = waiting.pop()
        if len(part) == 1:
            total[part[0]] += values[part[0]]
            continue
        for v in part:
            size[v] = 1
        for v in reversed(part[1:]):
            size[parent[v]] += size[v]
        centroid = part[0]
        for v in part:
            if 2 * size[v] > len(part):
                centroid = v
        # 0: not below the centroid; else the number of the component below it
        rest, below, held = [], [], [centroid]
        for v in part:
            place[v] = 0
            if v == centroid:
                place[v] = -1
                continue
            up = place[parent[v]] if v != part[0] else 0
            if up == 0:
                rest.append(v)
                continue
            if up == -1:
                below.append([])
                up = len(below)
            place[v] = up
            below[up - 1].append(v)
            held.append(v)
        share = values[held].sum(axis=0)
        v = centroid
        while True:
            total[v] += share
            if v == part[0]:
                break
            v = parent[v]
        waiting += [rest] if rest else []
        waiting += below
    return total


def _finished(pdf: pd.DataFrame) -> pd.DataFrame:
    """The totals of whole components of a bucket."""
    pdf = pdf.sort_values("depth", kind="stable").reset_index(drop=True)
    at = {key: i for i, key in enumerate(zip(pdf["k1"], pdf["k2"], strict=True))}
    tops = (pdf["k1"] == pdf["c1"]) & (pdf["k2"] == pdf["c2"])
    parent = [-1 if top else at[p1, p2] for top, p1, p2 in zip(tops, pdf["p1"], pdf["p2"], strict=True)]
    values = decompose(parent, pdf[["leaf", "saved"]].to_numpy(np.int64))
    return pd.DataFrame({"k1": pdf["k1"], "k2": pdf["k2"], "leaves": pdf["leaves"] + values[:, 0], "total": pdf["total"] + values[:, 1]})


def rollup(nodes: DataFrame, walked: DataFrame, scratch: Scratch, local: int | None = None) -> DataFrame:
    """k1, k2, leaves, total: sums of leaf and saved over each node's subtree.

    `nodes`: k1, k2, p1, p2, depth, conv, weight, leaf, saved; `walked`: what `paths` gives.
    """
    local = LOCAL if local is None else local
    zero = F.lit(0).cast("long")
    state = scratch.keep(nodes.select(*KEY, "p1", "p2", "depth", "conv", "weight", "leaf", "saved", zero.alias("c1"), zero.alias("c2"), zero.alias("leaves"), zero.alias("total")), "state-0")
    done: list[DataFrame] = []
    small: list[DataFrame] = []
    step = 0
    while True:
        comps = scratch.keep(state.groupBy(*TOP).agg(F.count(F.lit(1)).alias("n"), F.max("weight").alias("all")), f"components-{step}")
        count, most = comps.select(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.max("n"), F.lit(0))).first()
        if most <= local:
            break
        sized = scratch.keep(join_groups(state, comps, TOP, "n", count), f"sized-{step}")
        small.append(sized.where(F.col("n") <= local).select(*state.columns))
        big = sized.where(F.col("n") > local)
        way = F.col("weight") * 2 > F.col("all")
        deepest = F.max(F.struct("depth", *KEY, "weight")).alias("m")
        centroids = big.where(way).groupBy(*TOP, "n").agg(deepest).select(*TOP, "n", F.col("m.depth").alias("m_depth"), F.col("m.k1").alias("m1"), F.col("m.k2").alias("m2"), F.col("m.weight").alias("m_weight"))
        centroids = scratch.keep(centroids, f"centroids-{step}")
        rows = join_groups(big.drop("n"), centroids, TOP, "n", count).drop("n")
        rows = rows.withColumn("stretch", F.expr(f"depth div {STRETCH}")).withColumn("way", way)
        rows = scratch.keep(rows, f"split-{step}")
        deeper = rows.where("depth > m_depth AND NOT way")
        asked = deeper.select("conv", "stretch", *TOP, "m1", "m2", F.col("m_depth")).distinct()
        steps = walked.select("conv", (F.col("pos") - 1).alias("m_depth"), F.col("p1").alias("m1"), F.col("p2").alias("m2"), F.col("k1").alias("new1"), F.col("k2").alias("new2"))
        below = asked.join(steps, ["conv", "m_depth", "m1", "m2"]).select("conv", "stretch", *TOP, "new1", "new2")
        moved = deeper.join(below, ["conv", "stretch", *TOP], "left")
        none = F.lit(None).cast("long")
        others = rows.where("depth <= m_depth OR way").select("*", none.alias("new1"), none.alias("new2"))
        rows = scratch.keep(moved.select(*others.columns).unionByName(others), f"moved-{step}")
        is_centroid = (F.col("k1") == F.col("m1")) & (F.col("k2") == F.col("m2"))
        shares = rows.where(F.col("new1").isNotNull() | is_centroid).groupBy(*TOP).agg(F.sum("leaf").alias("share_leaf"), F.sum("saved").alias("share_saved"))
        on_way = rows.where("way")
        lengths = on_way.groupBy(*TOP).agg(F.count(F.lit(1)).alias("n"))
        shares = scratch.keep(shares.join(lengths, TOP), f"shares-{step}")
        added = join_groups(on_way, shares, TOP, "n", count)
        added = added.withColumns({"leaves": F.col("leaves") + F.col("share_leaf"), "total": F.col("total") + F.col("share_saved"), "weight": F.col("weight") - F.col("m_weight")})
        added = scratch.keep(added, f"added-{step}")
        done.append(added.where(is_centroid).select(*KEY, "leaves", "total"))
        left = added.where(~is_centroid).select(*state.columns)
        others = rows.where("NOT way").withColumns({"c1": F.coalesce("new1", "c1"), "c2": F.coalesce("new2", "c2")})
        state = scratch.keep(left.unionByName(others.select(*state.columns)), f"state-{step + 1}")
        step += 1
    rest = state
    for part in small:
        rest = rest.unionByName(part)
    buckets = max(1, 2 * count // local) if not step else max(1, 2 * rest.count() // local)
    dealt = rest.withColumn("bucket", F.pmod(F.xxhash64(*TOP), F.lit(buckets)))
    out = dealt.groupBy("bucket").applyInPandas(_finished, "k1 long, k2 long, leaves long, total long")
    for part in done:
        out = out.unionByName(part)
    return out


def trie(conversations: DataFrame, scratch: Scratch, local: int | None = None, branch: bool = True) -> DataFrame:
    """Every node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    conv_id is the smallest member and, with depth, tells nodes apart. saved_tokens sums over the
    subtree what the node's last text costs, in bytes, for every member but one. `branch`: see `branched`.
    """
    turns = placed_turns(conversations, scratch)
    if branch:
        branches = branched(turns, scratch)
    else:
        branches = branched(turns, scratch, every=1, most=0)
    walked = paths(branches, scratch)
    nodes = trie_nodes(walked, scratch)
    total = walked.count()
    values = nodes.withColumns({"leaf": (F.col("n_children") == 0).cast("long"), "saved": (F.col("n_convs") - 1) * F.col("bytes")})
    sums = scratch.keep(rollup(values, walked, scratch, local), "sums")
    owners = nodes.select(F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv").alias("parent_conv_id"), F.col("n_convs").alias("n"))
    parents = join_groups(nodes.where("depth > 0").select(*KEY, "p1", "p2"), owners, ["p1", "p2"], "n", total).select(*KEY, "parent_conv_id")
    known = nodes.join(sums, KEY).join(parents, KEY, "left").join(ends(walked), KEY, "left")
    return known.select(
        F.col("conv").alias("conv_id"),
        "depth",
        "parent_conv_id",
        "n_convs",
        "n_children",
        F.col("leaves").alias("n_leaves"),
        F.col("total").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
    )
