"""Chat formatting of reply trees.

A tree is a set of messages (tree, node, parent, role, text, score). Iterative self-joins with
pointer doubling give every message its ancestor 2^k steps up, its depth and the score
of its path; leaves are ranked per tree by path score; the chosen leaves walk up again through
the same jump tables, which enumerates exactly the messages of the chosen root-to-leaf
paths, and each path becomes one formatted conversation. The rounds grow with the
logarithm of the depth, and the rows of a round never exceed messages (ranking) or messages of
chosen paths (enumeration): unchosen branches are never expanded. A path is one result row, so it is
gathered in one place by nature; everything before that is spread by message.

Template: each message is ``<|turn|>`` role ``<|text|>`` text ``<|end|>`` and a line feed. Inside
roles and texts every backslash is doubled and a backslash is put behind the first character
of every control string (this template's and those of other common ones, :data:`CONTROL`),
so no control string survives in a text and :func:`unescape` gives the text
back. The loss mask covers the texts of ``assistant`` messages, as (start, length) spans
in code points of the formatted string.

Cases: null texts and roles count as empty; an unknown or null parent makes a root; messages on
a cycle (and below one) reach no root and are left out, as are messages without a tree or
node; repeated rows of one node id are merged into one message (the smallest role and text), so that ids
stay unique; ties of scores go to the smaller node id; extra columns are not read; an empty
table gives no rows; a path of one message is a conversation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinscore.llm.common import require, saved

TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>\n"
#: fixed values: control strings that must not survive in a text, as a regular expression with
#: the first character in a group of its own
CONTROL = r"([<\[])(\||s>|/s>|<SYS>>|</SYS>>|INST\]|/INST\])"
LEARNT_ROLE = "assistant"


def escape(c: Column) -> Column:
    doubled = F.regexp_replace(F.coalesce(c, F.lit("")), r"\\", r"\\\\")
    return F.regexp_replace(doubled, CONTROL, r"$1\\$2")


def unescape(c: Column) -> Column:
    return F.regexp_replace(c, r"\\([\s\S])", "$1")


def format_turns(turns: Column) -> tuple[Column, Column]:
    """(formatted string, loss mask) of an array of (role, text) structs."""
    parts = F.transform(turns, lambda t: F.struct(
        F.concat(F.lit(TURN), escape(t["role"]), F.lit(TEXT)).alias("head"), escape(t["text"]).alias("body"),
        (F.coalesce(t["role"], F.lit("")) == LEARNT_ROLE).alias("learnt"),
    ))
    formatted = F.concat_ws("", F.transform(parts, lambda p: F.concat(p["head"], p["body"], F.lit(END))))
    sized = F.transform(parts, lambda p: F.struct(
        F.length(p["head"]).alias("head"), F.length(p["body"]).alias("body"), p["learnt"].alias("learnt")
    ))
    start = F.struct(F.lit(0).alias("at"), F.expr("cast(array() as array<struct<start: int, length: int>>)").alias("spans"))
    mask = F.aggregate(
        sized,
        start,
        lambda a, p: F.struct(
            (a["at"] + p["head"] + p["body"] + len(END)).alias("at"),
            F.when(p["learnt"], F.array_append(a["spans"], F.struct((a["at"] + p["head"]).alias("start"), p["body"].alias("length"))))
            .otherwise(a["spans"])
            .alias("spans"),
        ),
        lambda a: a["spans"],
    )
    return formatted, mask


def read_turns(formatted: Column) -> Column:
    """The array of (role, text) of a formatted string."""
    pieces = F.filter(F.split(formatted, r"<\|turn\|>"), lambda p, i: i > 0)
    return F.transform(pieces, lambda p: F.struct(
        unescape(F.substring_index(p, TEXT, 1)).alias("role"),
        unescape(F.substring_index(F.substring_index(p, TEXT, -1), END, 1)).alias("text"),
    ))


def masked_text(formatted: Column, mask: Column) -> Column:
    """All text under the mask, unescaped, nothing between."""
    return F.concat_ws("", F.transform(mask, lambda s: unescape(F.substring(formatted, s["start"] + 1, s["length"]))))


def chosen_paths(messages: DataFrame, top: int = 1) -> DataFrame:
    """(tree, leaf, rank, path_score, step, node) of the ``top`` best root-to-leaf paths of each
    tree, ``step`` counting from 0 at the root. ``messages``: tree, node, parent, score."""
    require(messages, "tree", "node", "parent", "score")
    own = messages.select("tree", "node", "parent", F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("score"))
    known = own.select("tree", F.col("node").alias("parent"), F.lit(True).alias("known"))
    start = own.join(known, ["tree", "parent"], "left").select(
        "tree", "node", F.when(F.col("known"), F.col("parent")).alias("up"), F.lit(1).alias("hops"), "score"
    )
    # jumps[k]: the ancestor 2^k steps up, the messages passed and their score, of the messages that are
    # deep enough to have one; ``done``: those that reached their root, with all they passed
    first = saved(start)
    jumps, done = [first.where("up is not null")], first.where("up is null")
    limit = max(1, first.count()).bit_length() + 1
    while len(jumps) <= limit and not jumps[-1].isEmpty():
        low = jumps[-1]
        high = done.unionByName(low).select("tree", F.col("node").alias("up"), F.col("up").alias("next"),
                                            F.col("hops").alias("more_hops"), F.col("score").alias("more"))
        doubled = low.join(high, ["tree", "up"]).select(
            "tree", "node", F.col("next").alias("up"), (F.col("hops") + F.col("more_hops")).alias("hops"),
            (F.col("score") + F.col("more")).alias("score"),
        )
        doubled = saved(doubled)
        done = done.unionByName(doubled.where("up is null"))
        jumps.append(doubled.where("up is not null"))
    # what never gets done runs in a cycle; a leaf is nobody's parent
    parents = jumps[0].select("tree", F.col("up").alias("node")).distinct()
    leaves = done.join(parents, ["tree", "node"], "left_anti")
    order = Window.partitionBy("tree").orderBy(F.desc(F.col("score") / F.col("hops")), "node")
    best = leaves.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    walk = best.select(
        "tree", F.col("node").alias("leaf"), "rank", (F.col("score") / F.col("hops")).alias("path_score"),
        (F.col("hops") - 1).alias("step"), "node",
    )
    for k in range(len(jumps) - 1, -1, -1):
        jump = jumps[k].select("tree", "node", "up")
        above = walk.join(jump, ["tree", "node"]).select(
            "tree", "leaf", "rank", "path_score", (F.col("step") - 2**k).alias("step"), F.col("up").alias("node")
        )
        walk = saved(walk.unionByName(above))
    return walk


def format_paths(messages: DataFrame, top: int = 1) -> DataFrame:
    """(tree, rank, leaf, path_score, n_turns, formatted, loss_mask), one row per chosen path."""
    require(messages, "tree", "node", "parent", "role", "text", "score")
    body = F.min(F.struct(F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")))
    merged = saved(
        messages.where("tree is not null and node is not null")
        .groupBy("tree", "node")
        .agg(F.min("parent").alias("parent"), F.max("score").alias("score"), body.alias("body"))
    )
    paths = chosen_paths(merged, top)
    turns = paths.join(merged.select("tree", "node", "body"), ["tree", "node"])
    turns = turns.groupBy("tree", "rank", "leaf", "path_score").agg(
        F.sort_array(F.collect_list(F.struct("step", "body"))).alias("t")
    )
    turns = turns.withColumn("turns", F.transform("t", lambda t: t["body"]))
    formatted, mask = format_turns(F.col("turns"))
    return turns.select(
        "tree", "rank", "leaf", "path_score", F.size("turns").alias("n_turns"),
        formatted.alias("formatted"), mask.alias("loss_mask"),
    )


def turns_as_trees(conversations: DataFrame) -> DataFrame:
    """A table of (conv_id, turn, role, text) as reply trees: every turn answers the one before it.

    Rows with the same turn follow each other by role and text; nothing is merged. A tree is
    named by its conv_id as text, a null one by the empty text."""
    order = Window.partitionBy("conv_id").orderBy(
        F.col("turn").asc_nulls_first(), F.col("role").asc_nulls_first(), F.col("text").asc_nulls_first()
    )
    n = F.row_number().over(order)
    return conversations.select(
        F.coalesce(F.col("conv_id").cast("string"), F.lit("")).alias("tree"), n.cast("long").alias("node"),
        F.when(n > 1, n - 1).cast("long").alias("parent"), "role", "text", F.lit(0.0).alias("score"),
    )
