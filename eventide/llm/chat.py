"""Chat formatting over reply trees.

Messages point to the message they answer.  Iterative self-joins double the
reach of the parent pointers, so that all root-to-leaf paths are enumerated in
about log2(depth) rounds; only ids take part.  Branches are ranked by score,
and each chosen path becomes one conversation with a loss mask.

Template: ``<|im_start|>role\\ntext<|im_end|>\\n`` per turn.  Inside roles and
texts ``<|`` gains a backslash (``<\\|``), and an existing run of backslashes in
that place gains one more, so that no text holds a control string and the
escape can be undone.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window, functions as F

from eventide.llm.common import cut

START, END = "<|im_start|>", "<|im_end|>\n"
LOSS_ROLE = "assistant"


def escape(c: Column) -> Column:
    return F.regexp_replace(c, r"<(\\*)\|", r"<$1\\|")


def unescape(s: str) -> str:
    return re.sub(r"<\\(\\*)\|", r"<\1|", s)


def _escape_role(c: Column) -> Column:
    """Roles end at the first line feed, so theirs is escaped too."""
    return escape(F.replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n")))


def unescape_role(s: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(s))


def reply_paths(messages: DataFrame) -> DataFrame:
    """(t, leaf, node, up): for every leaf the messages from it (up 0) to its root.

    ``messages`` has t (a struct, so that null trees compare equal), node, parent.
    A parent that is not in the tree counts as none.  Messages whose ancestors
    form a cycle have no root, and give no path.
    """
    nodes = messages.select("t", "node", "parent")
    ids = nodes.select("t", F.col("node").alias("parent")).distinct()
    jump = cut(nodes.join(ids, ["t", "parent"]).select("t", "node", F.col("parent").alias("to")))
    answered = jump.select("t", F.col("to").alias("node")).distinct()
    paths = cut(nodes.select("t", "node").join(answered, ["t", "node"], "left_anti")
                .select("t", F.col("node").alias("leaf"), "node", F.lit(0).cast("long").alias("up")))
    roots = nodes.select("t", "node").join(jump.select("t", "node"), ["t", "node"], "left_anti")
    longest = nodes.groupBy("t").count().agg(F.max("count")).first()[0] or 0
    step = 1
    while step <= longest and not jump.isEmpty():
        paths = cut(paths.unionByName(paths.join(jump, ["t", "node"]).select(
            "t", "leaf", F.col("to").alias("node"), (F.col("up") + step).alias("up"))))
        jump = cut(jump.join(jump.select("t", F.col("node").alias("to"), F.col("to").alias("far")), ["t", "to"])
                   .select("t", "node", F.col("far").alias("to")))
        step *= 2
    rooted = paths.join(roots, ["t", "node"]).select("t", "leaf")
    return paths.join(rooted, ["t", "leaf"], "left_semi")


def format_conversations(messages: DataFrame, branches: int | None = 1, tree: str = "tree_id",
                         node: str = "msg_id", parent: str = "parent_id", role: str = "role",
                         text: str = "text", score: str = "score") -> DataFrame:
    """(tree_id, leaf, rank, score, formatted, loss_spans): one row per chosen path.

    The branches of a tree rank by the mean score of their messages (null: 0), ties
    by the smaller leaf; ``branches`` of each tree are kept (None: all).
    ``loss_spans`` are code point ranges of ``formatted`` (end exclusive) that hold
    the texts of assistant turns.  Null roles and texts are empty; the null tree is
    a tree.  Rows with a null id are left out; of rows that repeat an id in a tree the
    first by (parent, role, text, score) counts.  Other columns are not read.  One
    conversation is one output row, so its turns meet in one task.
    """
    rows = messages.where(F.col(node).isNotNull()).select(
        F.struct(F.col(tree).alias("id")).alias("t"), F.col(node).alias("node"),
        F.struct(F.col(parent).alias("parent"), F.coalesce(F.col(role), F.lit("")).alias("role"),
                 F.coalesce(F.col(text), F.lit("")).alias("text"),
                 F.coalesce(F.col(score).cast("double"), F.lit(0.0)).alias("score")).alias("m"))
    rows = cut(rows.groupBy("t", "node").agg(F.min("m").alias("m")).select("t", "node", "m.*"))
    paths = cut(reply_paths(rows))
    by = Window.partitionBy("t").orderBy(F.desc("score"), "leaf")
    ranked = (paths.join(rows.select("t", "node", "score"), ["t", "node"])
              .groupBy("t", "leaf").agg(F.avg("score").alias("score"))
              .withColumn("rank", F.row_number().over(by)))
    if branches is not None:
        ranked = ranked.where(F.col("rank") <= branches)
    head = F.concat(F.lit(START), _escape_role(F.col("role")), F.lit("\n"))
    body = escape(F.col("text"))
    turn = (paths.join(ranked.select("t", "leaf"), ["t", "leaf"], "left_semi")
            .join(rows.select("t", "node", "role", "text"), ["t", "node"])
            .select("t", "leaf", "up", F.col("role").alias("who"), head.alias("head"), body.alias("body")))
    order = Window.partitionBy("t", "leaf").orderBy(F.desc("up"))
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    size = F.length("head") + F.length("body") + len(END)
    turn = turn.withColumn("at", F.coalesce(F.sum(size.cast("long")).over(before), F.lit(0).cast("long"))
                           + F.length("head"))
    span = F.when(F.col("who") == LOSS_ROLE, F.struct(
        F.col("at").alias("start"), (F.col("at") + F.length("body")).alias("end")))
    done = (turn.select("t", "leaf", F.struct(
                (-F.col("up")).alias("o"), F.concat("head", "body", F.lit(END)).alias("s"), span.alias("span")).alias("x"))
            .groupBy("t", "leaf").agg(F.sort_array(F.collect_list("x")).alias("x")))
    done = done.select("t", "leaf", F.array_join("x.s", "").alias("formatted"),
                       F.filter("x.span", lambda s: s.isNotNull()).alias("loss_spans"))
    return done.join(ranked, ["t", "leaf"]).select(
        F.col("t.id").alias(tree), "leaf", "rank", "score", "formatted", "loss_spans")


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of each turn, read back from a formatted conversation."""
    turns = []
    for part in formatted.split(END)[:-1]:
        head, _, body = part.removeprefix(START).partition("\n")
        turns.append((unescape_role(head), unescape(body)))
    return turns


def read_loss(formatted: str, spans) -> str:
    """All text under the loss mask, unescaped, nothing between."""
    return "".join(unescape(formatted[s["start"]:s["end"]]) for s in spans)
