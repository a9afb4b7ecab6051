r"""Repair of conversation structure by depth-first branch-and-bound.

A conversation's rows, by turn, shall read ``(s?(ua)+)?`` by the initials of their
roles: perhaps a system row, then user and assistant by turns, or nothing. Edits: a
row is kept (K, cost 0), given the role user or assistant (R, 2) or deleted (D, 3;
blank and duplicate rows must be); an empty user or assistant row may be inserted
anywhere (I, 2); an undeleted truncated row adds 1. The cheapest edits are taken, and
of equally cheap ones those whose letters in order, the *audit*, sort first. An audit
fixes the roles: all undeleted rows, odd in number if the first is a system row.

*Search.* A node is (rows done, state of the automaton). A stack holds prefixes (node,
cost, audit). A prefix is dropped if its cost and the lower bound of what is left (per
row the cheapest edit that its faults, and in system rows the state, allow) exceed the best whole solution, or equal
it with a later audit; or if its node was reached before at a lower cost, or at the
same cost with an earlier audit (equally dear audits of one node are never prefixes of
each other, so what follows cannot turn their order). When the stack is empty, the
incumbent is proved best. Conversations of the same pattern are solved once per task.

*Long conversations.* Rows are range-partitioned by conversation, turn, role, text
and copy, so a conversation of any length is a run over several tasks. Its rows are solved in
blocks of ``BLOCK``, from every state to every state, and a block is a small matrix of
(cost, audit); the matrices are folded in order. Texts move three times: into order,
to their edits, and to whatever reads the result.

Defined cases: a null role or text is one space, null turns come first, rows of a null
conversation are one conversation; a role that begins with none of s, u, a (also an
empty one) cannot be kept; rows of equal turn go by role, the first ``HEAD`` characters
of the text and its SHA-256; repeated rows are duplicates; an empty table gives empty results; further columns are ignored. Texts
of any length pass whole; the search sees none of them.
"""

import hashlib
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from basketstream.llm.common import batch_of, write_once

BLOCK = 32
PATTERNS = 1 << 16  # cached solutions per worker
HEAD = 64  # characters of a text that order rows of the same turn and role, before its digest does
SPACE = r"[\x20\x09-\x0D]"
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1  # costs
START, SYSTEM, USER, ASSISTANT = range(4)
GOALS = (START, ASSISTANT)
NEXT = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
LEGAL = {"su", "ua", "au"}


def _cheapest(code: str, keepable: str) -> int:
    """Least cost of a row in states that may keep the initials ``keepable``."""
    if code == "x":
        return DELETE
    late = TRUNCATED if code.isupper() else 0
    return late + KEEP if code.lower() in keepable else min(late + REROLE, DELETE)


@lru_cache(PATTERNS)
def solve(pattern: str, start: int = START, goals: tuple = GOALS):
    """Cheapest (cost, audit) from ``start`` to one of ``goals``, or None.

    ``pattern`` has a letter per row: s, u, a or o (other) by the role's initial, upper
    case if truncated; x if the row must be deleted.
    """
    rows = len(pattern)
    # A system row is kept in the first state only, to which no way leads back.
    bounds = []
    for keepable in ("sua", "ua"):
        bound = [0] * (rows + 1)
        for i in range(rows - 1, -1, -1):
            bound[i] = bound[i + 1] + _cheapest(pattern[i], keepable)
        bounds.append(bound)
    best, reached = None, {}
    stack = [(0, start, 0, "")]
    while stack:
        at, state, cost, audit = stack.pop()
        least = cost + bounds[state != START][at]
        if best and (least > best[0] or least == best[0] and audit > best[1][: len(audit)]):
            continue
        if reached.get((at, state), (cost + 1, "")) < (cost, audit):
            continue
        if at == rows and state in goals and (best is None or (cost, audit) < best):
            best = cost, audit
        steps = [(at, NEXT[state, r], cost + INSERT, audit + "I") for r in "ua" if (state, r) in NEXT]
        if at < rows:
            code = pattern[at]
            steps.append((at + 1, state, cost + DELETE, audit + "D"))
            if code != "x":
                late = cost + (TRUNCATED if code.isupper() else 0)
                if (state, code.lower()) in NEXT:
                    steps.append((at + 1, NEXT[state, code.lower()], late + KEEP, audit + "K"))
                steps += [(at + 1, NEXT[state, r], late + REROLE, audit + "R") for r in "ua" if (state, r) in NEXT]
        # The most promising prefix is looked at first: its solution bounds the others.
        for step in sorted(steps, key=lambda s: (s[2] + bounds[s[1] != START][s[0]], s[3]), reverse=True):
            node, value = step[:2], step[2:]
            if reached.get(node, (value[0] + 1, "")) > value:
                reached[node] = value
                stack.append(step)
    return best


@lru_cache(PATTERNS)
def transfers(pattern: str, whole: bool):
    """[(start, end, cost, audit)] of a block; of a whole conversation only the solution."""
    if whole:
        return [(START, START, *solve(pattern))]
    found = [(a, b, solve(pattern, a, (b,))) for a in range(4) for b in range(4)]
    return [(a, b, *one) for a, b, one in found if one]


def ordered(turns: DataFrame, conv_column="conv_id", turn_column="turn", role_column="role", text_column="text") -> DataFrame:
    """Written rows conv, row (grows with the order), turn, role, text, digest."""
    rows = turns.select(
        F.col(f"`{conv_column}`").alias("conv"), F.col(f"`{turn_column}`").alias("turn"),
        F.coalesce(F.col(f"`{role_column}`"), F.lit(" ")).alias("role"), F.coalesce(F.col(f"`{text_column}`"), F.lit(" ")).alias("text"),
        F.monotonically_increasing_id().alias("tie"))
    # The bounds of the ranges hold samples of these columns, so no whole text is among them.
    rows = rows.withColumns({"head": F.left("text", F.lit(HEAD)), "digest": F.sha2(F.col("text").cast("binary"), 256)})
    order = ["conv", "turn", "role", "head", "digest", "tie"]
    placed = rows.repartitionByRange(*order).sortWithinPartitions(*order).drop("head", "tie")
    return write_once(placed.withColumn("row", F.monotonically_increasing_id()), "ordered-turns")


def faults(text: Column):
    """(blank, truncated): no visible character; the last one is no end of a sentence."""
    return ~text.rlike(rf"(?s)[^{SPACE[1:-1]}]"), ~text.rlike(rf"[.!?]{SPACE}*\z")


def _flags(rows: DataFrame) -> DataFrame:
    """conv, row, code (as ``solve`` takes it), initial, fault (b, d, t or empty)."""
    blank, cut = faults(F.col("text"))
    seen = rows.select("conv", "row", "role", "digest", blank.alias("blank"), cut.alias("cut"), F.substring("role", 1, 1).alias("initial"))
    seen = write_once(seen, "turn-digests")
    first = seen.where("NOT blank").groupBy("conv", "role", "digest").agg(F.min("row").alias("row")).select("row", F.lit(True).alias("first"))
    fault = F.when(F.col("blank"), "b").when(F.col("first").isNull(), "d").when(F.col("cut"), "t").otherwise("")
    letter = F.when(F.col("initial").isin("s", "u", "a"), F.col("initial")).otherwise("o")
    code = F.when(F.col("fault").isin("b", "d"), "x").when(F.col("fault") == "t", F.upper(letter)).otherwise(letter)
    return seen.join(first, "row", "left").withColumn("fault", fault).select("conv", "row", code.alias("code"), "initial", "fault")


BLOCKS = ("first_row long, n_rows long, opening string, closing string, blank long, duplicate long, truncated long, illegal long, "
          "moves array<struct<start: int, end: int, cost: long, audit: string>>")
MOVES = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())]))


def _column(df: DataFrame, name: str):
    """(Arrow type, Spark type) of a column."""
    return df.select(name).limit(0).toArrow().schema.field(0).type, df.schema[name].dataType.simpleString()


def _blocks(flags: DataFrame, block: int) -> DataFrame:
    """One row per block of a conversation's rows; conversations that may go on in another task are left open."""
    arrow, kind = _column(flags, "conv")
    longs = [(n, pa.int64()) for n in ("blank", "duplicate", "truncated", "illegal")]
    schema = pa.schema([("conv", arrow), ("first_row", pa.int64()), ("n_rows", pa.int64()), ("opening", pa.string()),
                        ("closing", pa.string()), *longs, ("moves", MOVES)])
    keys = ("start", "end", "cost", "audit")

    def settle(conv, first, codes, initials, found, whole):
        pairs = sum(a + b not in LEGAL for a, b in zip(initials, initials[1:]))
        moves = [dict(zip(keys, move)) for move in transfers("".join(codes), whole)]
        return (conv, first, len(codes), initials[0], initials[-1], found.count("b"), found.count("d"), found.count("t"), pairs, moves)

    def each(batches):
        part = conv = None
        edge, first, codes, initials, found = True, 0, [], [], []

        def close(whole):
            return settle(conv, first, codes, initials, found, whole)

        for batch in batches:
            out = []
            for c, row, code, initial, fault in zip(*(column.to_pylist() for column in batch.columns)):
                same = part == row >> 33 and conv == c
                if codes and not same:
                    # A run that begins or ends a task of the ordering may be part of a longer one.
                    out.append(close(not edge and part == row >> 33))
                    edge = part != row >> 33
                elif len(codes) == block:
                    out.append(close(False))
                    edge = True
                if not codes or not same or len(codes) == block:
                    part, conv, first, codes, initials, found = row >> 33, c, row, [], [], []
                codes.append(code)
                initials.append(initial)
                found.append(fault)
            if out:
                yield batch_of(schema, zip(*out))
        if codes:
            yield batch_of(schema, zip(close(False)))

    # The tasks of the ordering are dealt whole, so the order of rows is that of their numbers.
    dealt = flags.repartition(F.shiftright("row", 33)).sortWithinPartitions("row").select("conv", "row", "code", "initial", "fault")
    return dealt.mapInArrow(each, f"conv {kind}, {BLOCKS}")


def _best(moves):
    """{end: (cost, audit)} of the cheapest of (end, cost, audit)."""
    out = {}
    for end, cost, audit in moves:
        if end not in out or (cost, audit) < out[end]:
            out[end] = cost, audit
    return out


def _fold(blocks: DataFrame) -> DataFrame:
    """Summary row of every conversation, with its blocks (first row, number of rows)."""
    arrow, kind = _column(blocks, "conv")
    counts = ["blank", "duplicate", "truncated", "illegal"]
    parts = pa.list_(pa.struct([("first_row", pa.int64()), ("n_rows", pa.int64())]))
    schema = pa.schema([("conv", arrow), *((n, pa.int64()) for n in (*counts, "cost")), ("audit", pa.string()), ("blocks", parts)])

    def each(batches):
        conv = state = None

        def close():
            ends = [state["ends"][goal] for goal in GOALS if goal in state["ends"]]
            return (conv, *(state[n] for n in counts), *min(ends), state["blocks"])

        for batch in batches:
            out = []
            for row in batch.to_pylist():
                if state is None or row["conv"] != conv:
                    if state:
                        out.append(close())
                    conv = row["conv"]
                    state = {"ends": {START: (0, "")}, "blocks": [], "closing": None, **dict.fromkeys(counts, 0)}
                state["illegal"] += state["closing"] is not None and state["closing"] + row["opening"] not in LEGAL
                state["closing"] = row["closing"]
                for name in counts:
                    state[name] += row[name]
                state["blocks"].append({"first_row": row["first_row"], "n_rows": row["n_rows"]})
                state["ends"] = _best((m["end"], state["ends"][m["start"]][0] + m["cost"], state["ends"][m["start"]][1] + m["audit"])
                                      for m in row["moves"] if m["start"] in state["ends"])
            if out:
                yield batch_of(schema, zip(*out))
        if state:
            yield batch_of(schema, zip(close()))

    return blocks.repartition("conv").sortWithinPartitions("conv", "first_row").mapInArrow(
        each, f"conv {kind}, " + ", ".join(f"{n} long" for n in (*counts, "cost")) + ", audit string, blocks array<struct<first_row: long, n_rows: long>>")


def _edits(summary: DataFrame, batch_rows: int = 1 << 15) -> DataFrame:
    """conv, seq, edit, row (null if inserted), given (the role of rerolled and inserted rows)."""
    arrow, kind = _column(summary, "conv")
    schema = pa.schema([("conv", arrow), ("seq", pa.int64()), ("edit", pa.string()), ("row", pa.int64()), ("given", pa.string())])

    def letters(conv, audit, blocks):
        # With a system row in front the number of undeleted rows is odd.
        place = -1 if (len(audit) - audit.count("D")) % 2 else 0
        rows = (b["first_row"] + i for b in blocks for i in range(b["n_rows"]))
        for seq, edit in enumerate(audit):
            yield conv, seq, edit, None if edit == "I" else next(rows), ("user", "assistant")[place % 2] if edit in "RI" else None
            place += edit != "D"

    def each(batches):
        for batch in batches:
            out = []
            for conv, audit, blocks in zip(*(column.to_pylist() for column in batch.columns)):
                for letter in letters(conv, audit, blocks):
                    out.append(letter)
                    if len(out) == batch_rows:
                        yield batch_of(schema, zip(*out))
                        out = []
            if out:
                yield batch_of(schema, zip(*out))

    return summary.select("conv", "audit", "blocks").mapInArrow(each, f"conv {kind}, seq long, edit string, row long, given string")


def repair(turns: DataFrame, conv_column="conv_id", turn_column="turn", role_column="role", text_column="text", block: int = BLOCK):
    """(summary, edits).

    ``summary``: conv, gaps, blank, duplicate, truncated, illegal, cost, audit of every
    conversation with rows. ``edits``: conv, seq, edit, turn, role, text of every row
    and inserted row in order; those with another edit than D are the repaired rows.
    """
    rows = ordered(turns, conv_column, turn_column, role_column, text_column)
    folded = write_once(_fold(_blocks(_flags(rows), block)), "repairs")
    turn = F.col("turn").cast("long")
    gaps = rows.groupBy("conv").agg(F.coalesce(F.max(turn) - F.min(turn) + 1 - F.count_distinct(turn), F.lit(0)).alias("gaps"))
    same = F.col("f.conv").eqNullSafe(F.col("g.conv"))
    summary = folded.alias("f").join(gaps.alias("g"), same).select("f.conv", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")
    edits = write_once(_edits(folded), "edits")
    kept = edits.where("row IS NOT NULL").join(rows.select("row", "turn", "role", "text"), "row").select(
        "conv", "seq", "edit", "turn", F.coalesce("given", "role").alias("role"), "text")
    new = edits.where("row IS NULL").select(
        "conv", "seq", "edit", F.lit(None).cast(rows.schema["turn"].dataType).alias("turn"), F.col("given").alias("role"), F.lit("").alias("text"))
    return summary, kept.unionByName(new)


def digests(edits: DataFrame) -> DataFrame:
    """conv, sha256 of the repaired ``role:text`` lines; a conversation's rows pass through the hash one by one."""
    arrow, kind = _column(edits, "conv")
    schema = pa.schema([("conv", arrow), ("sha256", pa.string())])

    def each(batches):
        conv = state = None
        for batch in batches:
            out = []
            for c, line in zip(*(column.to_pylist() for column in batch.columns)):
                if state is None or c != conv:
                    if state:
                        out.append((conv, state.hexdigest()))
                    conv, state, joint = c, hashlib.sha256(), b""
                state.update(joint)
                state.update(line)
                joint = b"\n"
            if out:
                yield batch_of(schema, zip(*out))
        if state:
            yield batch_of(schema, zip((conv, state.hexdigest())))

    lines = edits.where("edit <> 'D'").select("conv", "seq", F.concat_ws(":", "role", "text").cast("binary").alias("line"))
    return lines.repartition("conv").sortWithinPartitions("conv", "seq").select("conv", "line").mapInArrow(each, f"conv {kind}, sha256 string")
