"""Conversation repair against exhaustive search over all edits, on whole and on cut conversations."""

import hashlib
import itertools
import random
import re

import pytest

from basketstream.llm import repair

TYPE = "conv_id long, turn long, role string, text string, conv string, row long, seq long, edit string"


def every_edit(pattern, inserts=2):
    """Cheapest (cost, audit) by trying all edits and judging the roles by the pattern alone."""
    best = None
    choices = []
    for code in pattern:
        late = code.isupper()
        some = [("D", 3, "")]
        if code != "x":
            some += [("K", late, code.lower()), ("R", 2 + late, "u"), ("R", 2 + late, "a")]
        choices.append(some)
    gaps = [""] + ["".join(p) for n in range(1, inserts + 1) for p in itertools.product("ua", repeat=n)]
    for made in itertools.product(*choices):
        for put in itertools.product(gaps, repeat=len(pattern) + 1):
            roles = "".join(p + m for p, m in itertools.zip_longest(put, (m[2] for m in made), fillvalue=""))
            if re.fullmatch("(s?(ua)+)?", roles):
                audit = "".join("I" * len(p) + m for p, m in itertools.zip_longest(put, (m[0] for m in made), fillvalue=""))
                cost = sum(m[1] for m in made) + 2 * sum(map(len, put))
                best = min(best or (cost, audit), (cost, audit))
    return best


@pytest.mark.parametrize("rows", [0, 1, 2, 3])
def test_search_finds_the_cheapest_edits(rows):
    for pattern in map("".join, itertools.product("suaoSUAOx"[: 9 if rows < 3 else 5] + "Ux"[: 2 * (rows == 3)], repeat=rows)):
        assert repair.solve(pattern) == every_edit(pattern, 2 if rows < 3 else 1), pattern


def table_search(pattern):
    """Cheapest (cost, audit) by a forward table of the best prefix per state."""
    now = {0: (0, "")}

    def put(table, state, value):
        if state not in table or value < table[state]:
            table[state] = value

    def inserted(table):
        for _ in range(3):
            for state, (cost, audit) in list(table.items()):
                for role in "ua":
                    if (state, role) in repair.NEXT:
                        put(table, repair.NEXT[state, role], (cost + 2, audit + "I"))
        return table

    for code in pattern:
        after = {}
        for state, (cost, audit) in inserted(now).items():
            put(after, state, (cost + 3, audit + "D"))
            for role, letter, more in ((code.lower(), "K", 0), ("u", "R", 2), ("a", "R", 2)):
                if code != "x" and (state, role) in repair.NEXT:
                    put(after, repair.NEXT[state, role], (cost + more + code.isupper(), audit + letter))
        now = after
    return min(v for s, v in inserted(now).items() if s in repair.GOALS)


def test_long_patterns_and_blocks_agree_with_a_table():
    draw = random.Random(5)
    for size in (9, 20, 40):
        for letters in ("suaoSUAOx", "ua", "u", "s", "uuuax"):
            pattern = "".join(draw.choice(letters) for _ in range(size))
            assert repair.solve(pattern) == table_search(pattern)
            for cut in (1, 7):
                ends = {0: (0, "")}
                for at in range(0, size, cut):
                    ends = repair._best((b, ends[a][0] + cost, ends[a][1] + audit)
                                        for a, b, cost, audit in repair.transfers(pattern[at : at + cut], False) if a in ends)
                assert min(ends[g] for g in repair.GOALS if g in ends) == table_search(pattern)


def plain(rows):
    """{conv: (gaps, blank, duplicate, truncated, illegal, cost, audit, repaired lines)} in plain Python."""
    out = {}
    key = lambda r: (r[1] is not None, r[1] or 0, r[2] or " " if r[2] is None else r[2], (r[3] if r[3] is not None else " ")[:64],
                     hashlib.sha256((r[3] if r[3] is not None else " ").encode()).hexdigest())
    for conv in {r[0] for r in rows}:
        mine = sorted((r for r in rows if r[0] == conv), key=key)
        turns = [r[1] for r in mine if r[1] is not None]
        codes, seen, faults = "", set(), ""
        mine = [(" " if r is None else r, " " if t is None else t) for _, _, r, t in mine]
        for role, text in mine:
            shown = text.strip("\x20\x09\x0a\x0b\x0c\x0d")
            fault = "b" if not shown else "d" if (role, text) in seen else "t" if shown[-1] not in ".!?" else " "
            seen.add((role, text))
            letter = role[:1] if role[:1] in ("s", "u", "a") else "o"
            codes += "x" if fault in "bd" else letter.upper() if fault == "t" else letter
            faults += fault
        cost, audit = table_search(codes)
        left, lines, odd = iter(mine), [], len(audit.replace("D", "")) % 2
        for edit in audit:
            role, text = ("", "") if edit == "I" else next(left)
            if edit != "D":
                given = ("user", "assistant")[(len(lines) - odd) % 2]
                lines.append((role if edit == "K" else given) + ":" + text)
        pairs = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(mine, mine[1:]))
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        out[conv] = (gaps, faults.count("b"), faults.count("d"), faults.count("t"), pairs, cost, audit, lines)
    return out


def found(spark, rows, block=repair.BLOCK):
    turns = spark.createDataFrame([(*r, "x", 1, 2, "e") for r in rows], TYPE).repartition(5)
    summary, edits = repair.repair(turns, block=block)
    lines = {}
    for row in sorted(edits.where("edit <> 'D'").collect(), key=lambda r: r.seq):
        lines.setdefault(row.conv, []).append(f"{row.role}:{row.text}")
    digests = {r.conv: r.sha256 for r in repair.digests(edits).collect()}
    for conv, mine in lines.items():
        assert digests[conv] == hashlib.sha256("\n".join(mine).encode()).hexdigest()
    assert set(digests) == set(lines)
    rows = summary.collect()
    assert len({r.conv for r in rows}) == len(rows)
    return {r.conv: (*tuple(r)[1:], lines.get(r.conv, [])) for r in rows}


ODD = [
    (1, 0, "system", "Be kind."), (1, 1, "user", "Hi there"), (1, 2, "assistant", "Hello."),
    (2, 0, None, None), (2, None, "user", "no turn."), (2, 5, "user", ""), (2, 5, "user", " \n"),
    (None, 1, "user", "a?"), (None, 1, "user", "a?"), (None, 1, "user", "a?"), (None, None, None, "x"),
    (3, 0, "tool", "{}"), (3, 1, "", "empty role."), (3, 9, "assistant", "ok!  \n"), (3, 9, "System", "Big."),
    (4, 0, "user", "word " * 40000 + "."), (4, 1, "assistant", "ü𝄞."), (4, 2, "user", "word " * 40000 + "."),
    (5, -3, "assistant", "x" * 70 + "b."), (5, -3, "assistant", "x" * 70 + "a."), (5, 2, "system", "late."),
    (6, None, "user", "x "),
]


def test_odd_conversations(text_spark):
    assert found(text_spark, ODD) == plain(ODD)


def test_conversations_cut_into_blocks_and_over_tasks(text_spark):
    draw = random.Random(3)
    texts = ["Yes.", "No", " ", "Why?", "So it is.", "and then"]
    rows = [(draw.choice([7, 7, 7, 8, 9, None]), draw.choice([*range(300), None]), draw.choice(["user", "assistant", "system", "tool", None]),
             draw.choice(texts) + str(draw.randrange(60)) * draw.randrange(2)) for _ in range(1500)]
    assert found(text_spark, rows, 4) == plain(rows)


def test_empty_table(text_spark):
    summary, edits = repair.repair(text_spark.createDataFrame([], TYPE))
    assert summary.collect() == [] == edits.collect()
    assert repair.digests(edits).collect() == []


def test_op11_gives_every_conversation(text_spark, tmp_path):
    from basketstream.llm.queries import REGISTRY
    import zlib

    gone = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    text_spark.createDataFrame([(gone, 0, "user", "Hi."), (None, None, None, None)], "conv_id long, turn long, role string, text string").write.parquet(
        f"{tmp_path}/conversations.parquet")
    rows = {r.conv_id: tuple(r)[1:] for r in REGISTRY["op11_conversation_repair"](text_spark, str(tmp_path)).collect()}
    assert rows[gone] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert set(rows) == {gone, None}
