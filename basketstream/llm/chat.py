r"""Chat formatting of reply trees.

Built-in Spark expressions only. A message names the message it answers; a
conversation is a tree, or several. Each root-to-leaf path is a branch.

*Paths.* Iterative self-joins enumerate them by doubling: every message starts
with a jump to its parent, and each round replaces a jump by the jump of where it
lands while the depth and the score along the way are added up. After
log2(longest path) rounds every message knows its depth and the sum of scores
from its root. A cycle of answers has no root and never ends; after
``MAX_ROUNDS`` rounds (paths of 2^24 messages) it is an error.

*Ranking.* Branches of a conversation are ranked by mean score, then by length,
then by leaf; the ``branches`` best are formatted. Going down from the chosen
leaves with the same jumps, in the opposite order, marks each branch's messages.

*Template.* ``[INST]user[/INST]``, ``[OUT]assistant</s>``, ``[SYS]system[/SYS]``,
and ``[ROLE]name[TEXT]text[/ROLE]`` for every other role. Inside a text each
backslash is doubled, and each string of the template gets a backslash after its
first character, so none of them occurs in an escaped text; taking away single
backslashes gives the text back. The loss mask covers the escaped text of
assistant turns, as spans of code points.

Defined cases: a null text counts as empty, a null role as the empty role;
messages are told apart by position, so repeated rows are separate turns; an
answer to a message that does not exist is a root; rows with a null conversation
are one conversation; an empty table gives an empty result; further columns are
ignored.
"""

from pyspark.sql import Column, DataFrame, Window, functions as F

from basketstream.llm.common import write_once

MAX_ROUNDS = 24
CONTROL = r"\\|\[(?=/?(?:INST|SYS|ROLE)\]|(?:OUT|TEXT)\])|<(?=/?s>)"
TURN = r"(?s)\[(INST|SYS|OUT|ROLE)\](.*?)(?:\[/(?:INST|SYS|ROLE)\]|</s>)"
NAMED = {"user": ("[INST]", "[/INST]"), "assistant": ("[OUT]", "</s>"), "system": ("[SYS]", "[/SYS]")}


def escape(text: Column) -> Column:
    # A backslash becomes two; the first character of a template string gets one behind it.
    return F.regexp_replace(text, CONTROL, r"$0\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"\\(\\?)", "$1")


def as_tree(turns: DataFrame, conv_column="conv_id", turn_column="turn", role_column="role", text_column="text") -> DataFrame:
    """Rows of linear conversations as messages that answer the one before: conv_id, node, parent, role, text, score."""
    rows = turns.select(
        F.col(conv_column).cast("long").alias("conv_id"), F.col(turn_column).alias("turn"),
        F.coalesce(F.col(role_column), F.lit("")).alias("role"), F.coalesce(F.col(text_column), F.lit("")).alias("text"))
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    numbered = rows.withColumn("node", F.row_number().over(order).cast("long"))
    return numbered.select("conv_id", "node", F.when(F.col("node") > 1, F.col("node") - 1).alias("parent"), "role", "text",
                           F.lit(0.0).alias("score"))


def _jumps(messages: DataFrame):
    """[jumps by 1, by 2, by 4, ...] and, per message, depth and sum of scores from its root.

    Jumps have conv_id, node, to; a message whose jump would pass its root has none.
    """
    nodes = messages.select("conv_id", "node", "parent", F.coalesce("score", F.lit(0.0)).alias("score"))
    exists = nodes.select("conv_id", F.col("node").alias("parent"), F.lit(True).alias("found"))
    same = F.col("n.conv_id").eqNullSafe(F.col("p.conv_id"))
    now = write_once(nodes.alias("n").join(exists.alias("p"), same & (F.col("n.parent") == F.col("p.parent")), "left").select(
        "n.conv_id", "n.node", F.when(F.col("p.found"), F.col("n.parent")).alias("to"), "n.score", F.lit(1).cast("long").alias("depth")),
        "jumps")
    steps = []
    while not now.where("to IS NOT NULL").isEmpty():
        if len(steps) == MAX_ROUNDS:
            raise ValueError("answers form a cycle")
        moving = now.where("to IS NOT NULL")
        steps.append(moving.select("conv_id", "node", "to"))
        landed = now.select("conv_id", F.col("node").alias("to"), F.col("to").alias("next"),
                            F.col("score").alias("more"), F.col("depth").alias("deeper"))
        same = F.col("n.conv_id").eqNullSafe(F.col("p.conv_id"))
        moved = moving.alias("n").join(landed.alias("p"), same & (F.col("n.to") == F.col("p.to"))).select(
            "n.conv_id", "n.node", F.col("p.next").alias("to"), (F.col("n.score") + F.col("p.more")).alias("score"),
            (F.col("n.depth") + F.col("p.deeper")).alias("depth"))
        # Messages that have reached their root are not joined again: later rounds cost what long paths cost.
        now = write_once(now.where("to IS NULL").unionByName(moved), "jumps")
    return steps, now.select("conv_id", "node", "depth", "score")


def best_branches(messages: DataFrame, branches: int = 1) -> DataFrame:
    """conv_id, branch (rank from 1 on), leaf, node, position: the messages of the best root-to-leaf paths."""
    steps, reached = _jumps(messages)
    parents = messages.select("conv_id", F.col("parent").alias("node")).where("node IS NOT NULL").distinct()
    same = F.col("r.conv_id").eqNullSafe(F.col("p.conv_id")) & (F.col("r.node") == F.col("p.node"))
    leaves = reached.alias("r").join(parents.alias("p"), same, "left_anti")
    order = Window.partitionBy("conv_id").orderBy(F.desc(F.col("score") / F.col("depth")), F.desc("depth"), "node")
    chosen = leaves.withColumn("branch", F.row_number().over(order)).where(F.col("branch") <= branches)
    path = write_once(chosen.select("conv_id", "branch", "node"), "path")
    # Each round adds to every marked message the one a power of two above it.
    for jump in reversed(steps):
        same = F.col("c.conv_id").eqNullSafe(F.col("j.conv_id")) & (F.col("c.node") == F.col("j.node"))
        above = path.alias("c").join(jump.alias("j"), same).select("c.conv_id", "c.branch", F.col("j.to").alias("node"))
        path = write_once(path.unionByName(above), "path")  # else each round would double the plan
    same = F.col("c.conv_id").eqNullSafe(F.col("r.conv_id")) & (F.col("c.node") == F.col("r.node"))
    return path.distinct().alias("c").join(reached.alias("r"), same).select(
        "c.conv_id", "c.branch", "c.node", F.col("r.depth").alias("position"))


def render(role: Column, text: Column):
    """(opening, escaped text, closing) of a turn."""
    opening, closing = F.concat(F.lit("[ROLE]"), escape(role), F.lit("[TEXT]")), F.lit("[/ROLE]")
    for name, (a, b) in NAMED.items():
        opening, closing = F.when(role == name, a).otherwise(opening), F.when(role == name, b).otherwise(closing)
    return opening, escape(text), closing


def format_messages(messages: DataFrame, branches: int = 1) -> DataFrame:
    """conv_id, branch, formatted, loss_spans (start and length in code points, from 0) of each chosen path."""
    messages = write_once(messages, "messages")
    path = best_branches(messages, branches)
    same = F.col("m.conv_id").eqNullSafe(F.col("p.conv_id")) & (F.col("m.node") == F.col("p.node"))
    turns = messages.alias("m").join(path.alias("p"), same).select(
        "m.conv_id", "p.branch", "p.position", F.coalesce("m.role", F.lit("")).alias("role"), F.coalesce("m.text", F.lit("")).alias("text"))
    opening, body, closing = render(F.col("role"), F.col("text"))
    parts = turns.select("conv_id", "branch", "position", F.concat(opening, body, closing).alias("turn"),
                         F.when(F.col("role") == "assistant", F.length(opening)).alias("skip"), F.length(body).alias("body"))
    so_far = Window.partitionBy("conv_id", "branch").orderBy("position")
    placed = parts.withColumn("start", F.sum(F.length("turn")).over(so_far) - F.length("turn") + F.col("skip"))
    joined = placed.groupBy("conv_id", "branch").agg(
        F.sort_array(F.collect_list(F.struct("position", "turn", "start", "body"))).alias("parts"))
    spans = F.transform(F.filter("parts", lambda p: p["start"].isNotNull()),
                        lambda p: F.struct(p["start"].cast("int").alias("start"), p["body"].alias("length")))
    return joined.select("conv_id", "branch", F.array_join("parts.turn", "").alias("formatted"), spans.alias("loss_spans"))


def read_back(formatted: DataFrame) -> DataFrame:
    """``formatted`` with turns (role, text) and loss_text, both taken from the formatted string."""
    names = F.create_map(*[F.lit(x) for name, (a, _) in NAMED.items() for x in (a[1:-1], name)])
    pieces = formatted.withColumn("_turns", F.arrays_zip(
        F.regexp_extract_all("formatted", F.lit(TURN), 1).alias("kind"), F.regexp_extract_all("formatted", F.lit(TURN), 2).alias("body")))
    return pieces.withColumns({
        "turns": F.transform("_turns", lambda t: F.struct(
            F.coalesce(names[t["kind"]], unescape(F.split_part(t["body"], F.lit("[TEXT]"), F.lit(1)))).alias("role"),
            unescape(F.when(t["kind"] == "ROLE", F.split_part(t["body"], F.lit("[TEXT]"), F.lit(2))).otherwise(t["body"])).alias("text"))),
        "loss_text": F.array_join(F.transform("loss_spans", lambda s: unescape(
            F.col("formatted").substr(s["start"] + 1, s["length"]))), ""),
    }).drop("_turns")
