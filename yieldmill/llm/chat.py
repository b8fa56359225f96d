"""Chat formatting of reply trees, in DataFrame operations only.

Messages form trees by their parent.  Self-joins that double their reach follow
the parents: after k rounds every message knows its 2**k-th ancestor and the sum
of scores on the way, so a chain of n messages takes log2(n) rounds.  The leaves
of a tree are ranked by the mean score of their path, the chosen paths are
enumerated with the same jumps, and each becomes one conversation.

Template: ``<|im_start|>``, role, line feed, text, ``<|im_end|>``, line feed.  In
texts and roles every ``<``, backslashes, ``|`` gets one more backslash, so no
text holds a control string and reading takes the backslash away again; in roles
``%`` and line feeds are written as ``%25`` and ``%0A``.

Defined results: a null text is empty, a null role is an empty role, a null score
counts 0; a parent that is missing or null makes a root; rows that repeat a node
count once; a tree of null id is a tree; equal scores rank by node; a cycle of
parents is an error; an empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from yieldmill.session import materialise

START, END = "<|im_start|>", "<|im_end|>\n"
MOST_ROUNDS = 40  # 2**40 messages in one path
TRAINED_ROLE = "assistant"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", "<$1|")


def escape_role(role: Column) -> Column:
    return escape(F.replace(F.replace(role, F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A")))


def unescape_role(role: Column) -> Column:
    return F.replace(F.replace(unescape(role), F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%"))


def chosen_paths(nodes: DataFrame, branches: int | None) -> DataFrame:
    """tree, leaf, rank, score, node, depth (0 at the leaf) of every chosen path.

    ``nodes`` has tree, node, parent, score, with tree not null and nodes distinct.
    """
    known = nodes.select("tree", F.col("node").alias("up"), F.lit(True).alias("known"))
    jumps = nodes.select("tree", "node", F.col("parent").alias("up"), "score").join(
        known, ["tree", "up"], "left"
    )
    jumps = materialise(
        jumps.select(
            "tree",
            "node",
            F.when(F.col("known"), F.col("up")).alias("up"),
            "score",
            F.lit(1).cast("long").alias("steps"),
        ),
        "chat-jumps",
    )
    first, tables = jumps, []
    # ``up`` is null once a node's jump has reached its root; score and steps then are those of its path.
    while jumps.where("up IS NOT NULL").limit(1).count():
        if len(tables) == MOST_ROUNDS:
            raise ValueError("the parents form a cycle")
        tables.append(jumps.where("up IS NOT NULL").select("tree", "node", "up"))
        done, open_ = jumps.where("up IS NULL"), jumps.where("up IS NOT NULL")
        far = jumps.select(
            "tree",
            F.col("node").alias("up"),
            F.col("up").alias("next"),
            F.col("score").alias("more"),
            F.col("steps").alias("beyond"),
        )
        moved = open_.join(far, ["tree", "up"]).select(
            "tree",
            "node",
            F.col("next").alias("up"),
            (F.col("score") + F.col("more")).alias("score"),
            (F.col("steps") + F.col("beyond")).alias("steps"),
        )
        jumps = materialise(done.unionByName(moved), "chat-jumps")

    parents = first.where("up IS NOT NULL").select("tree", F.col("up").alias("node")).distinct()
    order = Window.partitionBy("tree").orderBy(F.col("score").desc(), "leaf")
    leaves = (
        jumps.join(parents, ["tree", "node"], "left_anti")
        .select("tree", F.col("node").alias("leaf"), (F.col("score") / F.col("steps")).alias("score"))
        .withColumn("rank", F.row_number().over(order))
    )
    if branches is not None:
        leaves = leaves.where(F.col("rank") <= branches)
    paths = leaves.select(
        "tree", "leaf", "rank", "score", F.col("leaf").alias("node"), F.lit(0).cast("long").alias("depth")
    )
    for k, table in enumerate(tables):
        # All ancestors nearer than 2**k are known; the jump adds those up to 2**(k + 1).
        farther = paths.join(table, ["tree", "node"]).select(
            "tree", "leaf", "rank", "score", F.col("up").alias("node"), (F.col("depth") + 2**k).alias("depth")
        )
        paths = materialise(paths.unionByName(farther), "chat-paths")
    return paths


def format_trees(messages: DataFrame, branches: int | None = None) -> DataFrame:
    """One row per chosen path: tree_id, leaf, rank, score, ``formatted``, ``loss_mask``.

    ``messages`` has tree_id, node, parent, role, text, score.  The mask lists
    the spans (code points, end exclusive) of the texts that are trained on.
    """
    tree = F.coalesce(F.concat(F.lit("i"), F.col("tree_id").cast("string")), F.lit("n"))
    turns = materialise(
        messages.select(
            tree.alias("tree"),
            "tree_id",
            "node",
            "parent",
            F.coalesce("score", F.lit(0.0)).cast("double").alias("score"),
            F.coalesce("role", F.lit("")).alias("role"),
            F.coalesce("text", F.lit("")).alias("text"),
        ).dropDuplicates(["tree", "node"]),
        "chat-turns",
    )
    paths = chosen_paths(turns.select("tree", "node", "parent", "score"), branches)
    body = escape(F.col("text"))
    head = F.concat(F.lit(START), escape_role(F.col("role")), F.lit("\n"))
    written = paths.join(
        turns.select(
            "tree",
            "tree_id",
            "node",
            F.concat(head, body, F.lit(END)).alias("turn"),
            F.length(head).alias("from"),
            F.length(body).alias("size"),
            (F.col("role") == TRAINED_ROLE).alias("trained"),
        ),
        ["tree", "node"],
    )
    earlier = (
        Window.partitionBy("tree", "leaf").orderBy(F.col("depth").desc()).rowsBetween(Window.unboundedPreceding, -1)
    )
    begin = F.coalesce(F.sum(F.length("turn")).over(earlier), F.lit(0)) + F.col("from")
    placed = written.withColumn("begin", begin)
    turn = F.struct(
        (-F.col("depth")).alias("at"),
        "turn",
        F.when(
            F.col("trained"),
            F.struct(F.col("begin").alias("start"), (F.col("begin") + F.col("size")).alias("end")),
        ).alias("span"),
    )
    path = placed.groupBy("tree", "leaf").agg(
        F.first("tree_id").alias("tree_id"),
        F.first("rank").alias("rank"),
        F.first("score").alias("score"),
        F.sort_array(F.collect_list(turn)).alias("turns"),
    )
    spans = F.filter(F.transform("turns", lambda t: t["span"]), lambda s: s.isNotNull())
    return path.select(
        "tree_id",
        "leaf",
        "rank",
        "score",
        F.array_join(F.transform("turns", lambda t: t["turn"]), "").alias("formatted"),
        spans.alias("loss_mask"),
    )


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted conversation: an array of role and text."""
    pieces = F.split(formatted, r"<\|im_end\|>\n", -1)
    # After the last end mark stands an empty piece.
    whole = F.slice(pieces, 1, F.size(pieces) - 1)
    bare = F.transform(whole, lambda p: F.substr(p, F.lit(len(START) + 1)))
    return F.transform(
        bare,
        lambda p: F.struct(
            unescape_role(F.substring_index(p, "\n", 1)).alias("role"),
            unescape(F.substr(p, F.length(F.substring_index(p, "\n", 1)) + 2)).alias("text"),
        ),
    )


def read_loss(formatted: Column, mask: Column) -> Column:
    """The unescaped text under a loss mask, one piece after the other."""
    part = lambda s: F.substr(formatted, (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int"))
    return F.array_join(F.transform(mask, lambda s: unescape(part(s))), "")


def linear_trees(rows: DataFrame, tree_id: str, turn: str, role: str, text: str) -> DataFrame:
    """Conversations without branches as trees: each turn answers the one before."""
    order = Window.partitionBy(tree_id).orderBy(F.col(turn).asc_nulls_first(), role, text)
    node = F.row_number().over(order).cast("long")
    return rows.select(
        F.col(tree_id).alias("tree_id"), node.alias("node"), F.col(role).alias("role"), F.col(text).alias("text")
    ).select(
        "tree_id", "node", F.nullif(F.col("node") - 1, F.lit(0)).alias("parent"), "role", "text",
        F.lit(0.0).alias("score"),
    )
