"""Operator 3: chat formatting of reply trees (DataFrame functions only).

Messages (tree, node, parent, role, text, score) form reply trees.  Self-joins
that double their reach give every node its depth and the score of its way from
the root; leaves are ranked in their tree by that score, and for each chosen
leaf the joins run backwards over the kept reaches and list its path.  Each path
is formatted as one conversation.

Template: ``<|role|>`` role ``<|text|>`` text ``<|end|>`` for each turn.  Control
strings inside roles and texts (``<|name|>``, ``<s>``, ``</s>``, ``[INST]``,
``[/INST]``) get a backslash after their first character, also where they have
some already; ``unescape`` takes one away, so any text comes back unchanged and
no text can open or close a turn.  ``loss_spans`` are the character ranges of
the assistants' texts in the formatted string.

Scale: log2(depth) joins up and as many down, each level written to the shared
folder.  Texts are joined once, to the paths that are formatted.  A parent with
a third of all replies is a skewed key of a left join, which adaptive execution
splits; ranks in a large tree are cut to ``top`` before the shuffle.

Defined results: a null role or text counts as empty; a null tree is a tree of
its own; a parent that is not in the tree counts as none (the node is a root);
nodes on a cycle or below one have no root and no path; of rows that share
(tree, node) the smallest stays; equal scores: the smaller leaf first; a null
score counts as 0; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize

ROLE, TEXT, END = "<|role|>", "<|text|>", "<|end|>"
LEARNT = "assistant"
_TAIL = r"(/?(?:s>|INST\]|\|[A-Za-z0-9_]{1,32}\|>))"
_PLAIN, _MARKED = r"([<\[])(\\*)" + _TAIL, r"([<\[])\\(\\*)" + _TAIL


def escape(text: Column) -> Column:
    return F.regexp_replace(text, _PLAIN, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, _MARKED, "$1$2$3")


def _same(a: DataFrame, b: DataFrame, left: str, right: str) -> Column:
    return a["tree"].eqNullSafe(b["t"]) & (a[left] == b[right])


def _nodes(messages: DataFrame) -> DataFrame:
    """tree, node, up (a parent that exists), score, role, text; one row a node."""
    m = messages.select("tree", "node", "parent", F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("score"),
                        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")).filter(F.col("node").isNotNull())
    if not m.groupBy("tree", "node").count().filter("count > 1").isEmpty():
        m = m.groupBy("tree", "node").agg(F.min(F.struct("parent", "score", "role", "text")).alias("r")).select("tree", "node", "r.*")
    there = m.select(F.col("tree").alias("t"), F.col("node").alias("up"))
    return m.join(there, _same(m, there, "parent", "up"), "left").select("tree", "node", "up", "score", "role", "text")


def paths(nodes: DataFrame, top: int = 1) -> DataFrame:
    """tree, leaf, rank, path_score, node, back (steps from the leaf) of the chosen paths."""
    reach = materialize(nodes.select("tree", "node", "up", "score", F.lit(1).cast("long").alias("steps")), "reach")
    parents = reach.filter(F.col("up").isNotNull()).select(F.col("tree").alias("t"), F.col("up").alias("p"))
    levels, most = [], reach.count().bit_length() + 1
    while len(levels) < most and not reach.filter(F.col("up").isNotNull()).isEmpty():
        levels.append(reach.select("tree", "node", "up").filter(F.col("up").isNotNull()))
        above = reach.select(F.col("tree").alias("t"), F.col("node").alias("n"), F.col("up").alias("far"), F.col("score").alias("s"), F.col("steps").alias("k"))
        reach = materialize(reach.join(above, _same(reach, above, "up", "n"), "left").select(
            "tree", "node", F.col("far").alias("up"), (F.col("score") + F.coalesce("s", F.lit(0.0))).alias("score"),
            (F.col("steps") + F.coalesce("k", F.lit(0))).alias("steps")), "reach")
    rooted = reach.filter(F.col("up").isNull())
    leaves = rooted.join(parents, _same(rooted, parents, "node", "p"), "left_anti")
    best = Window.partitionBy("tree").orderBy(F.desc("score"), "node")
    chosen = leaves.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= top)
    walk = chosen.select("tree", F.col("node").alias("leaf"), "rank", F.col("score").alias("path_score"), "node", F.lit(0).cast("long").alias("back"))
    for k in range(len(levels) - 1, -1, -1):
        hop = levels[k].toDF("t", "n", "up")
        walk = materialize(walk, "walk")
        up = walk.join(hop, _same(walk, hop, "node", "n")).select("tree", "leaf", "rank", "path_score", F.col("up").alias("node"), (F.col("back") + (1 << k)).alias("back"))
        walk = walk.union(up)
    return walk


def format_trees(messages: DataFrame, top: int = 1) -> DataFrame:
    """tree, leaf, rank, path_score, formatted, loss_spans (array of first, past)."""
    nodes = materialize(_nodes(messages), "nodes")
    walk = paths(nodes, top)
    texts = nodes.select(F.col("tree").alias("t"), F.col("node").alias("n"), "role", "text")
    lines = walk.join(texts, _same(walk, texts, "node", "n"))
    head, body = F.concat(F.lit(ROLE), escape(F.col("role")), F.lit(TEXT)), escape(F.col("text"))
    pieces = lines.select("tree", "leaf", "rank", "path_score", "back", head.alias("head"), body.alias("body"), (F.col("role") == LEARNT).alias("learnt"))
    path = ["tree", "leaf", "rank", "path_score"]
    earlier = Window.partitionBy("tree", "leaf").orderBy(F.desc("back")).rowsBetween(Window.unboundedPreceding, -1)
    size = F.length("head") + F.length("body") + len(END)
    placed = pieces.withColumn("first", F.coalesce(F.sum(size).over(earlier), F.lit(0)) + F.length("head"))
    turn = F.struct((-F.col("back")).alias("at"), F.concat("head", "body", F.lit(END)).alias("piece"), "first", (F.col("first") + F.length("body")).alias("past"), "learnt")
    turns = placed.groupBy(*path).agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    return turns.select(
        *path,
        F.array_join(F.transform("turns", lambda x: x["piece"]), "").alias("formatted"),
        F.transform(F.filter("turns", lambda x: x["learnt"]), lambda x: F.struct(x["first"].alias("first"), x["past"].alias("past"))).alias("loss_spans"),
    )


def read_turns(formatted: Column) -> Column:
    """Roles and texts of a formatted conversation, unescaped."""
    pieces = F.split(formatted, r"<\|end\|>")
    head = lambda x: F.substring_index(x, TEXT, 1)
    return F.transform(F.slice(pieces, F.lit(1), F.size(pieces) - F.lit(1)), lambda x: F.struct(
        unescape(F.substr(head(x), F.lit(len(ROLE) + 1))).alias("role"),
        unescape(F.substr(x, F.length(head(x)) + F.lit(len(TEXT) + 1))).alias("text")))


def read_loss(formatted: Column, loss_spans: Column) -> Column:
    """Texts under the loss mask, unescaped, in order."""
    return F.transform(loss_spans, lambda s: unescape(F.substr(formatted, s["first"] + F.lit(1), s["past"] - s["first"])))
