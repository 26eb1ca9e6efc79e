"""Chat formatting: branches of reply trees as marked-up conversations. DataFrame functions only.

A message has a tree, a node, a parent, a role, a text and a score. Branches, the paths from a root
to a leaf, are found by self-joins that double what they span: after k rounds every node knows its
ancestor 2^k steps up, the sum of scores on the way and, once the root is reached, its depth. So a tree
of depth d takes about log2 d rounds, of narrow rows. The best branches of each tree are then
unfolded by the same pointers, and only their messages are joined with texts.

Template, one turn after another (`\\` stands for one backslash):

    user       [INST] text [/INST]
    assistant  <s> text </s>
    system     <<SYS>> text <</SYS>>
    other      [ROLE] role [/ROLE] text [/TEXT]

Control strings inside roles and texts get one more backslash in front, which reading takes away.
A template's control strings stand between blanks or at the ends, so none is ever behind a backslash.
The loss mask is a list of spans, in code points, of the assistant texts as escaped.

Null texts and roles are empty, a null score is 0, null trees are one tree. A parent that isn't
there counts as none. Of several rows of one node the first by parent, role and text counts.
Messages in or below a cycle have no root, and so no branch. Of branches with equal scores the one with the smaller leaf ranks first. An
empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from msgmart.llm.scratch import Scratch

#: Fixed values of the template.
OPEN = {"user": "[INST]", "assistant": "<s>", "system": "<<SYS>>"}
CLOSE = {"user": "[/INST]", "assistant": "</s>", "system": "<</SYS>>"}
OTHER, NAMED, LAST = "[ROLE]", "[/ROLE]", "[/TEXT]"
CONTROLS = r"<s>|</s>|<<SYS>>|<</SYS>>|\[/?INST\]|\[/?ROLE\]|\[/TEXT\]"
TURN = r"(?s)(\[INST\]|<s>|<<SYS>>|\[ROLE\]) (.*?) (?:\[/INST\]|</s>|<</SYS>>|\[/TEXT\])"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, rf"(?<!\\)(\\*+)({CONTROLS})", r"$1\\$2")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, rf"(?<!\\)\\(\\*+)({CONTROLS})", "$1$2")


def best_branches(messages: DataFrame, scratch: Scratch, branches: int = 1) -> DataFrame:
    """tree, branch (its rank), position, node for the messages of the `branches` best branches of each tree.

    `messages`: tree, node, parent, role, text, score.
    """
    links = messages.groupBy("tree", "node").agg(F.min(F.struct("parent", "role", "text", "score")).alias("first"))
    links = scratch.keep(links.select("tree", "node", F.col("first.parent").alias("parent"), F.coalesce("first.score", F.lit(0)).cast("double").alias("score")), "links")
    above = links.select(F.col("tree").alias("t"), F.col("node").alias("n"))
    there = F.col("tree").eqNullSafe(F.col("t")) & (F.col("parent") == F.col("n"))
    # up: the ancestor 2^k steps above, null beyond the root; depth and total: of the steps and scores passed on the way to it
    state = links.join(above, there, "left").select("tree", "node", F.col("n").alias("up"), F.lit(0).cast("long").alias("depth"), F.col("score").alias("total"), F.col("n").isNull().alias("ended"))
    state = state.withColumn("depth", F.when(F.col("ended"), 0).otherwise(1).cast("long"))
    rounds, open_before = 0, -1
    state = scratch.keep(state, "round0")
    while (still := state.where("up is not null").count()) and still != open_before:
        open_before = still
        upper = state.select(F.col("tree").alias("t"), F.col("node").alias("n"), F.col("up").alias("up2"), F.col("depth").alias("d2"), F.col("total").alias("s2"))
        # only messages that have not reached their root go on
        joined = state.where("up is not null").join(upper, F.col("tree").eqNullSafe(F.col("t")) & (F.col("up") == F.col("n")))
        moved = joined.select("tree", "node", F.col("up2").alias("up"), (F.col("depth") + F.col("d2")).alias("depth"), (F.col("total") + F.col("s2")).alias("total"), F.col("up2").isNull().alias("ended"))
        state = state.where("up is null").unionByName(moved)
        rounds += 1
        state = scratch.keep(state, f"round{rounds}")
    parents = scratch.spark.read.schema(state.schema).parquet(scratch.path("round0")).where("up is not null").select(F.col("tree").alias("t"), F.col("up").alias("n"))
    leaves = state.where("up is null").join(parents, F.col("tree").eqNullSafe(F.col("t")) & (F.col("node") == F.col("n")), "left_anti")
    rank = F.row_number().over(Window.partitionBy("tree").orderBy(F.desc("total"), "node"))
    paths = leaves.withColumn("branch", rank).where(F.col("branch") <= branches).select("tree", "branch", "node", F.col("depth").alias("position"))
    for k in range(rounds):
        step = scratch.spark.read.schema(state.schema).parquet(scratch.path(f"round{k}")).where("up is not null").select(F.col("tree").alias("t"), F.col("node").alias("n"), "up")
        more = paths.join(step, F.col("tree").eqNullSafe(F.col("t")) & (F.col("node") == F.col("n"))).select("tree", "branch", F.col("up").alias("node"), (F.col("position") - (1 << k)).alias("position"))
        paths = scratch.keep(paths.unionByName(more), f"paths{k}")
    return paths


def render(role: Column, text: Column) -> tuple[Column, Column, Column]:
    """What stands before a turn's text, the escaped text, and what stands behind it."""
    ahead = F.concat(F.lit(f"{OTHER} "), escape(role), F.lit(f" {NAMED} "))
    behind = F.lit(f" {LAST}")
    for name in OPEN:
        ahead = F.when(role == name, F.lit(f"{OPEN[name]} ")).otherwise(ahead)
        behind = F.when(role == name, F.lit(f" {CLOSE[name]}")).otherwise(behind)
    return ahead, escape(text), behind


def format_branches(messages: DataFrame, paths: DataFrame) -> DataFrame:
    """tree, branch, formatted, loss_spans (start, end in code points) of the branches in `paths`."""
    texts = messages.groupBy(F.col("tree").alias("t"), F.col("node").alias("n")).agg(F.min(F.struct("parent", "role", "text", "score")).alias("m"))
    rows = paths.join(texts, F.col("tree").eqNullSafe(F.col("t")) & (F.col("node") == F.col("n")))
    role, text = F.coalesce("m.role", F.lit("")), F.coalesce("m.text", F.lit(""))
    ahead, body, behind = render(role, text)
    turns = rows.select("tree", "branch", "position", (role == "assistant").alias("learned"), ahead.alias("ahead"), body.alias("body"), behind.alias("behind"))
    turns = turns.withColumn("turn", F.concat("ahead", "body", "behind"))
    whole = Window.partitionBy("tree", "branch").orderBy("position").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum(F.length("turn")).over(whole), F.lit(0)) + F.length("ahead")
    turns = turns.select("tree", "branch", "position", "turn", F.when(F.col("learned"), F.struct(start.alias("start"), (start + F.length("body")).alias("end"))).alias("span"))
    done = turns.groupBy("tree", "branch").agg(F.sort_array(F.collect_list(F.struct("position", "turn", "span"))).alias("turns"))
    return done.select("tree", "branch", F.array_join("turns.turn", "").alias("formatted"), F.filter("turns.span", lambda x: x.isNotNull()).alias("loss_spans"))


def read_back(formatted: DataFrame) -> DataFrame:
    """`formatted` with turns (role, text) and loss_texts, both from the formatted text and the mask alone."""
    opened, bodies = (F.regexp_extract_all("formatted", F.lit(TURN), k) for k in (F.lit(1), F.lit(2)))
    split = lambda x: F.instr(x, f" {NAMED} ")

    def turn(open_: Column, body: Column) -> Column:
        role, text = F.substring(body, F.lit(1), F.instr(body, f" {NAMED} ") - 1), F.substring(body, split(body) + len(NAMED) + 2, F.length(body))
        for name, mark in OPEN.items():
            role, text = F.when(open_ == mark, F.lit(name)).otherwise(role), F.when(open_ == mark, body).otherwise(text)
        return F.struct(unescape(role).alias("role"), unescape(text).alias("text"))

    loss = F.transform("loss_spans", lambda s: unescape(F.substring(F.col("formatted"), (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int"))))
    return formatted.withColumns({"turns": F.zip_with(opened, bodies, turn), "loss_texts": loss})


def format_chats(messages: DataFrame, branches: int = 1, scratch: Scratch | None = None) -> DataFrame:
    """tree, branch, formatted, loss_spans for the best branches of each reply tree in `messages` (tree, node, parent, role, text, score)."""
    scratch = scratch or Scratch(messages.sparkSession, "chat")
    return format_branches(messages, best_branches(messages, scratch, branches))
