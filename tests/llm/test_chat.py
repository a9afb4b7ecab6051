import hashlib
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from basketstream.llm import chat

CONTROLS = ["\\", "[INST]", "[/INST]", "[SYS]", "[/SYS]", "[ROLE]", "[/ROLE]", "[OUT]", "[TEXT]", "</s>", "<s>"]
TEXTS = ["", " ", "plain", "\n", *CONTROLS, "".join(CONTROLS), "\\".join(CONTROLS), "</s</s>>", "[[INST]", "<\\/s>", "\\</s>", "end<", "end["]


def test_escape_is_reversible_and_hides_template_strings(text_spark):
    rows = text_spark.createDataFrame([(t,) for t in TEXTS], "t string").select("t", chat.escape(F.col("t")).alias("e")).withColumn(
        "back", chat.unescape(F.col("e"))).collect()
    for row in rows:
        assert row.back == row.t
        assert not re.search(r"\[/?(INST|SYS|ROLE)\]|\[(OUT|TEXT)\]|</?s>", row.e)


@pytest.fixture(scope="module")
def turns(text_spark):
    rows = [(1, n, role, TEXTS[n % len(TEXTS)]) for n, role in enumerate(["system", "user", "assistant", "user", "assistant", "tool", "INST", ""] * 5)]
    rows += [(2, 0, "user", None), (2, 0, "user", None), (2, 1, None, "x"), (None, 3, "assistant", "y"), (3, None, "assistant", "z"),
             (4, 0, "a\nb[TEXT]", "𝄞 ü"), (4, 1, "assistant", "𝄞 ü")]
    return text_spark.createDataFrame([(*r, 1.0, "p") for r in rows], "conv_id long, turn long, role string, text string, score double, node string")


def test_read_back_equals_the_turns(turns):
    want = defaultdict(list)
    for r in turns.collect():
        want[r.conv_id].append((r.turn if r.turn is not None else -1, r.role or "", r.text or ""))
    rows = {r.conv_id: r for r in chat.read_back(chat.format_messages(chat.as_tree(turns))).collect()}
    assert set(rows) == set(want)
    for key, row in rows.items():
        own = sorted(want[key])
        assert [(t.role, t.text) for t in row.turns] == [(role, text) for _, role, text in own]
        assert row.loss_text == "".join(text for _, role, text in own if role == "assistant")
        assert len(row.loss_spans) == sum(role == "assistant" for _, role, _ in own)


def branches(messages):
    """All root-to-leaf paths by plain recursion: {conversation: [(mean score, path)]} best first."""
    out = {}
    for conv in {m[0] for m in messages}:
        own = {m[1]: m for m in messages if m[0] == conv}
        parents = {m[2] for m in own.values()}
        paths = []
        for node in own:
            if node not in parents:
                path, at = [], node
                while at in own:
                    path.append(at)
                    at = own[at][2]
                paths.append((-sum(own[n][4] for n in path) / len(path), -len(path), node, path[::-1]))
        out[conv] = [p[3] for p in sorted(paths)]
    return out


def test_trees_like_recursion(text_spark):
    messages = [(c, n, None if n == 0 else (n * 7 + c) % n if n % 5 else n - 1, "user", ((n * 37 + c) % 11) / 4) for c in range(6) for n in range(40)]
    messages += [(9, 5, 77, "user", 1.0), (9, 6, 5, "user", 0.0)]  # answers a message that is not there
    frame = text_spark.createDataFrame([(c, n, p, r, f"m{n}", s) for c, n, p, r, s in messages],
                                       "conv_id long, node long, parent long, role string, text string, score double")
    found = defaultdict(dict)
    for r in chat.best_branches(frame, 3).collect():
        found[r.conv_id, r.branch][r.position] = r.node
    want = branches(messages)
    assert {k: [v[p] for p in sorted(v)] for k, v in found.items()} == {
        (c, i + 1): path for c, paths in want.items() for i, path in enumerate(paths[:3])}


def test_cycles_are_an_error_and_nothing_gives_nothing(text_spark, turns, monkeypatch):
    monkeypatch.setattr(chat, "MAX_ROUNDS", 3)
    ring = text_spark.createDataFrame([(1, 1, 2, "user", "a", 0.0), (1, 2, 1, "user", "b", 0.0)],
                                      "conv_id long, node long, parent long, role string, text string, score double")
    with pytest.raises(ValueError):
        chat.best_branches(ring)
    assert chat.format_messages(chat.as_tree(turns.where("1 = 0"))).count() == 0
