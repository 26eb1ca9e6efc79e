"""Merkle manifest of a dataset: a tree over the rows of each group, and one over the groups' roots.

A leaf is the digest of a row's fields. The leaves of a group stand in order; of the nodes of a level,
every `arity` consecutive ones, a run, become their parent, until one node, the group's subroot, is
left. The subroots, ordered by group, become the root in the same way. Digests are lowercase hex
SHA-256 of what is concatenated, digests as hex text.

Places in a group come from ranges of (group, order), see `msgmart.operators.ranks`. Each level is
then made by self-joins of nodes with a computed sibling: the one whose place differs in one bit
(XOR) where the arity is a power of two, else the one as many slots ahead. A join takes in runs of
twice the length of the one before, so a level takes log2(arity) joins, and half as many rows each
time; the rows of slot zero then hold their whole run and emit the parent. Keys are single nodes, so
a group of any size is spread evenly. Proofs come back down the same levels: a run adds its members'
siblings to the path of its parent, and only runs, not leaves, are moved. Levels and paths are merged,
never broadcast: hex digests and paths that runs share unpack to many times the size of their files,
from which Spark would judge them small.

All is done with DataFrame functions. A null field is `-`, any other its UTF-8 length, `:` and itself.
Rows are ordered by `order`, null first, then by leaf; equal rows are leaves of their own, in any
order. A null group is a group of its own, before all others. An empty table gives no rows; very long
texts are hashed where they are read, and not moved. Columns that aren't fields are not read.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from msgmart.llm.scratch import Scratch
from msgmart.llm.skew import join_groups
from msgmart.operators.ranks import numbered

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
PATH = "array<struct<before:string,after:string>>"


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def leaf(values: Sequence[Column]) -> Column:
    texts = [v.cast("string") for v in values]
    return digest(*[F.when(t.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t)) for t in texts])


def sibling(place: Column, width: int, arity: int) -> Column:
    """The place of the node whose run of `width` goes on behind the run at `place`, and the other way round."""
    if arity & (arity - 1) == 0:
        return place.bitwiseXOR(F.lit(width))
    return F.when((place % arity) % (2 * width) == 0, place + width).otherwise(place - width)


def runs(nodes: DataFrame, arity: int, scratch: Scratch, name: str) -> DataFrame:
    """tree, run, n, members of the runs of `nodes` (tree, place, n, item): the items of each in order.

    A join reads the one before on both its sides, so what two have made is written.
    """
    rows = nodes.select("tree", "place", "n", F.array("item").alias("members"))
    slot = F.col("place") % arity
    width = 1
    while width < arity:
        if width > 1 and width.bit_length() % 2:
            rows = scratch.keep(rows, f"{name}-{width}")
        ahead = rows.where(slot % (2 * width) == width).select("tree", sibling(F.col("place"), width, arity).alias("place"), F.col("members").alias("more"))
        here = rows.where(slot % (2 * width) == 0).join(ahead.hint("merge"), ["tree", "place"], "left")
        rows = here.select("tree", "place", "n", F.when(F.col("more").isNull(), F.col("members")).otherwise(F.concat("members", "more")).alias("members"))
        width *= 2
    return rows.select("tree", F.expr(f"place div {arity}").alias("run"), "n", "members")


class Forest:
    """The levels of the trees over `nodes` (tree, place, n, item): place from 0, n nodes in the tree, item with a field digest.

    `most`: nodes of the largest tree.
    """

    def __init__(self, nodes: DataFrame, most: int, arity: int, scratch: Scratch, name: str):
        self.arity, self.levels, self.scratch, self.name = arity, [], scratch, name
        self.lone = nodes.where("n = 1")
        self.roots = self.lone.select("tree", F.col("item.digest").alias("digest"))
        while most > 1:
            label = f"{name}-{len(self.levels)}"
            level = scratch.keep(runs(nodes.where("n > 1"), arity, scratch, f"{label}-run"), label)
            self.levels.append(level)
            most = -(-most // arity)
            parent = F.struct(digest(F.array_join("members.digest", "")).alias("digest")).alias("item")
            nodes = level.select("tree", F.col("run").alias("place"), F.expr(f"(n + {arity - 1}) div {arity}").alias("n"), parent)
            self.roots = self.roots.unionByName(nodes.where("n = 1").select("tree", F.col("item.digest").alias("digest")))

    def proofs(self, ends: DataFrame | None = None) -> DataFrame:
        """tree, item, path and the other columns of `ends` for every node of the first level.

        `ends` (tree, path, ...) tells how each tree's root goes on; without it paths end there. A path
        has what stands before and behind the node in its run, level by level.
        """
        rest = [c for c in ends.columns if c not in ("tree", "path")] if ends is not None else []
        go_on = lambda frame: frame.withColumn("path", F.array().cast(PATH)) if ends is None else frame.join(ends.hint("merge"), "tree")
        above = None
        for k in reversed(range(len(self.levels))):
            level = self.levels[k].withColumn("last", F.col("n") <= self.arity)
            found = go_on(level.where("last").drop("last", "n"))
            if above is not None:
                upper = above.select("tree", F.col("place").alias("run"), "path", *rest)
                found = found.unionByName(level.where("not last").drop("last", "n").join(upper.hint("merge"), ["tree", "run"]))
            if k:
                found = self.scratch.keep(found, f"{self.name}-path{k}")
            above = self._members(found, rest)
        alone = go_on(self.lone.select("tree", "item"))
        if above is None:
            return alone
        return above.drop("place").unionByName(alone)

    def _members(self, found: DataFrame, rest: list[str]) -> DataFrame:
        each = found.select("tree", "run", "members", "path", *rest, F.posexplode("members").alias("slot", "item"))
        digests = F.col("members.digest")
        before = F.array_join(F.slice(digests, 1, F.col("slot")), "").alias("before")
        after = F.array_join(F.slice(digests, F.col("slot") + 2, self.arity), "").alias("after")
        path = F.concat(F.array(F.struct(before, after)), "path").alias("path")
        return each.select("tree", (F.col("run") * self.arity + F.col("slot")).alias("place"), "item", path, *rest)


def folded(start: Column, path: Column) -> Column:
    """The root that the digest `start` and its siblings give."""
    return F.aggregate(path, start, lambda h, p: digest(p["before"], h, p["after"]))


def proof_digest(path: Column) -> Column:
    """The digest of all siblings of a path, level by level, left to right."""
    return digest(F.array_join(F.transform(path, lambda p: F.concat(p["before"], p["after"])), ""))


def no_rows(spark: SparkSession, id_type: str) -> DataFrame:
    return spark.createDataFrame([], f"id {id_type}, leaf string, altered string, subroot string, root string, path {PATH}")


def manifest(
    docs: DataFrame,
    scratch: Scratch,
    fields: Sequence[str] = FIELDS,
    group: str = "source",
    order: str = "doc_id",
    arity: int = 16,
    altered: Mapping[str, Column] | None = None,
    hit: Column | None = None,
) -> DataFrame:
    """id (the order column), leaf, altered, subroot, root, path for every row of `docs`.

    `altered` is the leaf with other values, `{field: value}`, of the rows that are `hit`, else the
    leaf. It takes no part in the trees: folded with the path it shows whether the change is found.
    """
    if arity < 2:
        raise ValueError("a run has two nodes at least")
    whole = leaf([F.col(f) for f in fields])
    changed = leaf([(altered or {}).get(f, F.col(f)) for f in fields])
    name = F.col(group).cast("string")
    tree = F.when(name.isNull(), "0").otherwise(F.concat(F.lit("1"), name)).alias("tree")
    rows = docs.select(F.col(order).alias("id"), tree, F.monotonically_increasing_id().alias("uid"), whole.alias("leaf"), F.when(hit, changed).alias("altered") if altered and hit is not None else F.lit(None).cast("string").alias("altered"))
    rows = scratch.keep(rows, "leaves")
    sizes = scratch.keep(rows.groupBy("tree").agg(F.count(F.lit(1)).alias("n")), "sizes")
    total, most, trees = sizes.select(F.sum("n"), F.max("n"), F.count(F.lit(1))).first()
    if not total:
        return no_rows(docs.sparkSession, docs.schema[order].dataType.simpleString())
    placed = numbered(rows, ["tree"], [F.col("id").asc_nulls_first(), F.col("leaf"), F.col("uid")], scratch.path("ranges"), "place")
    item = F.struct(F.col("leaf").alias("digest"), "id", "altered").alias("item")
    nodes = join_groups(placed.select("tree", (F.col("place") - 1).alias("place"), item), sizes, ["tree"], "n", total)
    lower = Forest(scratch.keep(nodes, "nodes"), most, arity, scratch, "lower")
    subroots = scratch.keep(lower.roots, "subroots")
    ordered = numbered(subroots, [], [F.col("tree")], scratch.path("groups"), "place")
    of_tree = F.struct("digest", F.col("tree").alias("below")).alias("item")
    upper = Forest(scratch.keep(ordered.select(F.lit("").alias("tree"), (F.col("place") - 1).alias("place"), F.lit(trees).cast("long").alias("n"), of_tree), "tops"), trees, arity, scratch, "upper")
    root = upper.roots.first()["digest"]
    ends = scratch.keep(upper.proofs().select(F.col("item.below").alias("tree"), F.col("item.digest").alias("subroot"), "path"), "ends")
    found = lower.proofs(ends)
    return found.select("item.id", F.col("item.digest").alias("leaf"), F.coalesce("item.altered", "item.digest").alias("altered"), "subroot", F.lit(root).alias("root"), "path")
