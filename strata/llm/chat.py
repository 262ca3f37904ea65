"""Chat formatting (native): root-to-leaf paths of reply trees as formatted conversations with a loss mask.

Method: messages point to their parents. Iterative self-joins find the paths: round k joins each message's ancestor 2^k
steps up with that ancestor's own, so a path of n messages takes about log2(n) rounds, not n. On the way up each message
gathers its depth and the scores of its path. Leaves are ranked per tree by the mean score of
their path; the chosen leaves collect their ancestors through the same tables, top step first. DataFrame functions only.

Template: ``<|turn|>role\\ntext<|end|>\\n`` per turn. Control strings in texts and roles (this template's and other
common ones) are escaped by one backslash after their first character, which is taken out again on reading; a text that already
has backslashes there gets one more, so every text comes back as it was. The loss mask covers the texts of assistant turns, as spans
of code points of the formatted text.

Defined results: a null text or role is empty. Repeated rows (tree, id, parent, role, text, score) count once. A parent that is not in
the tree makes a root; messages on a cycle have no root and no path. A null tree id is a tree of its own. Of equal scores the
longer path, then the smaller leaf id comes first. A null score counts as 0. Empty table: no rows.

One conversation is one row, so that it must fit in a task's memory; nothing else is gathered.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import shared_table

#: The template's control strings.
TURN, TEXT, END, BREAK = "<|turn|>", "\n", "<|end|>\n", "<|break|>"
LOSS_ROLE = "assistant"
#: What follows `<` or `[` in control strings of this and other templates.
TAILS = r"(\||/?s>|/?INST\]|</?SYS>>)"
ESCAPE = rf"([<\[])(\\*){TAILS}", r"$1\\$2$3"
UNESCAPE = rf"([<\[])\\(\\*){TAILS}", "$1$2$3"
_NO_TREE = -(2**63)


def escape(c: Column) -> Column:
    return F.regexp_replace(c, *ESCAPE)


def unescape(c: Column) -> Column:
    return F.regexp_replace(c, *UNESCAPE)


def reply_paths(messages: DataFrame, branches: int | None = None) -> DataFrame:
    """(tree, leaf, rank, node, depth): the messages of the best ``branches`` paths of each tree, depth 1 is the root.

    ``messages`` has tree, id, parent (longs; ids are unique in a tree) and score.
    """
    links = messages.select("tree", "id", "parent", F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("score")).distinct()
    known = links.select("tree", F.col("id").alias("parent"), F.lit(True).alias("known")).distinct()
    rooted = links.join(known, ["tree", "parent"], "left").select("tree", "id", F.when(F.col("known"), F.col("parent")).alias("up"), "score", F.lit(1).cast("long").alias("depth"))
    # up: the ancestor 2^k steps above, null beyond the root; score and depth are of the messages below it.
    # A round takes up only the messages that have not reached their root, so short paths cost nothing in later rounds.
    steps = [shared_table(rooted, "reply-steps")]
    done, left = [steps[0].where("up IS NULL")], steps[0].where("up IS NOT NULL")
    rounds = (steps[0].count() + 1).bit_length()
    while len(steps) <= rounds and not left.isEmpty():
        high = reduce(DataFrame.union, [*done, left])
        high = high.select("tree", F.col("id").alias("up"), F.col("up").alias("next"), F.col("score").alias("more"), F.col("depth").alias("deeper"))
        joined = left.join(high, ["tree", "up"])
        steps.append(shared_table(joined.select("tree", "id", F.col("next").alias("up"), (F.col("score") + F.col("more")).alias("score"), (F.col("depth") + F.col("deeper")).alias("depth")), "reply-steps"))
        done, left = [*done, steps[-1].where("up IS NULL")], steps[-1].where("up IS NOT NULL")
    whole = reduce(DataFrame.union, done)
    parents = steps[0].where("up IS NOT NULL").select("tree", F.col("up").alias("id")).distinct()
    leaves = whole.join(parents, ["tree", "id"], "left_anti")
    best_first = Window.partitionBy("tree").orderBy(F.desc(F.col("score") / F.col("depth")), F.desc("depth"), "id")
    leaves = leaves.withColumn("rank", F.row_number().over(best_first))
    if branches is not None:
        leaves = leaves.where(F.col("rank") <= branches)
    paths = leaves.select("tree", F.col("id").alias("leaf"), F.col("rank").cast("long").alias("rank"), F.col("id").alias("node"), "depth")
    for k in range(len(steps) - 2, -1, -1):
        jump = steps[k].where("up IS NOT NULL").select("tree", F.col("id").alias("node"), "up")
        above = paths.join(jump, ["tree", "node"]).select("tree", "leaf", "rank", F.col("up").alias("node"), (F.col("depth") - 2**k).alias("depth"))
        paths = shared_table(paths.unionByName(above), "reply-paths")
    return paths


def format_paths(messages: DataFrame, branches: int | None = None) -> DataFrame:
    """(tree, leaf, rank, n_turns, formatted, loss_spans): one row per path; a span has start and end, end exclusive."""
    paths = reply_paths(messages, branches)
    texts = messages.select("tree", F.col("id").alias("node"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")).distinct()
    head = F.concat(F.lit(TURN), F.replace(escape(F.col("role")), F.lit("\n"), F.lit(BREAK)), F.lit(TEXT))
    turns = paths.join(texts, ["tree", "node"]).select("tree", "leaf", "rank", "depth", head.alias("head"), escape(F.col("text")).alias("body"), (F.col("role") == LOSS_ROLE).alias("loss"))
    turns = turns.withColumn("chars", F.char_length("head") + F.char_length("body") + len(END))
    before = Window.partitionBy("tree", "leaf", "rank").orderBy("depth").rowsBetween(Window.unboundedPreceding, -1)
    turns = turns.withColumn("start", F.coalesce(F.sum(F.col("chars").cast("long")).over(before), F.lit(0)) + F.char_length("head"))
    turn = F.struct("depth", F.concat("head", "body", F.lit(END)).alias("piece"), F.when(F.col("loss"), F.struct("start", (F.col("start") + F.char_length("body")).alias("end"))).alias("span"))
    gathered = turns.groupBy("tree", "leaf", "rank").agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    return gathered.select(
        "tree", "leaf", "rank",
        F.size("turns").cast("long").alias("n_turns"),
        F.array_join(F.col("turns.piece"), "").alias("formatted"),
        F.array_compact(F.col("turns.span")).alias("loss_spans"),
    )


def read_turns(formatted: Column) -> Column:
    """The (role, text) turns of a formatted conversation."""
    parts = F.split(formatted, r"<\|end\|>\n", -1)
    own = F.slice(parts, 1, F.size(parts) - 1)

    def turn(s: Column) -> Column:
        at = F.instr(s, TEXT)
        role = F.substring(s, F.lit(len(TURN) + 1), at - len(TURN) - 1)
        return F.struct(unescape(F.replace(role, F.lit(BREAK), F.lit("\n"))).alias("role"), unescape(F.substring(s, at + 1, F.char_length(s))).alias("text"))

    return F.transform(own, turn)


def conversation_paths(rows: DataFrame) -> DataFrame:
    """Messages of rows (conv_id, turn, role, text): all rows of a conversation by (turn, role, text) as one path, repeated rows and equal turns too."""
    rows = rows.select(F.coalesce(F.col("conv_id").cast("long"), F.lit(_NO_TREE)).alias("tree"), "turn", "role", "text")
    numbered = rows.withColumn("id", F.row_number().over(Window.partitionBy("tree").orderBy("turn", "role", "text")).cast("long"))
    return numbered.select("tree", "id", F.when(F.col("id") > 1, F.col("id") - 1).alias("parent"), "role", "text", F.lit(0.0).alias("score"))


def conv_id(tree: Column) -> Column:
    return F.when(tree != _NO_TREE, tree)
