"""Exact and near phrase matches against a plain scan of every text."""

import random
import re

import pytest

from basketstream.llm import phrase_index
from basketstream.llm.common import table
from conftest_data import ROWS, documents

ITEM_TYPE = "item_id long, text string, row long, id long, window long, term string, pos long, n_words long"


def words(text):
    low = (text or "").translate({c: c + 32 for c in range(65, 91)})
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", low)


def windows(text, size):
    w = words(text)
    return [tuple(w[i : i + size]) for i in range(max(len(w) - size, 0) + 1)] if w else []


def plain(docs, items, size):
    wanted = {}
    for item, text in items:
        for window in windows(text, size):
            wanted.setdefault(window, set()).add(item)
    out = []
    for doc, text in docs:
        w, hit, ids = words(text), set(), set()
        for length in {len(k) for k in wanted}:
            for i in range(len(w) - length + 1):
                if tuple(w[i : i + length]) in wanted:
                    hit |= set(range(i, i + length))
                    ids |= wanted[tuple(w[i : i + length])]
        spans = [[i for i in sorted(hit) if i - 1 not in hit], [i + 1 for i in sorted(hit) if i + 1 not in hit]]
        out.append((doc, len(w), len(hit), tuple(sorted(map(str, ids))), tuple((a, b - a) for a, b in zip(*spans))))
    return sorted(out, key=str)


def found(docs, items, size):
    rows = phrase_index.mark_documents(docs, items, size).collect()
    assert all(r.n_items == len(r["items"]) for r in rows)
    return sorted(((r.id, r.n_words, r.n_hit, tuple(r["items"]), tuple(map(tuple, r.spans or []))) for r in rows), key=str)


def items_of(spark, rows):
    return spark.createDataFrame([(i, t, 1, 2, 3, "t", 4, 5) for i, t in rows], ITEM_TYPE)


ITEMS = [
    (1, "QUICK brown fox jumps over the lazy dog again and again"), (2, "a b c a b c a b"), (3, None), (4, " ... "), (5, "two"),
    (6, "one TWO"), (7, "nowhere to be found at all"), (1, "another text"), (10, "w0x0 w7919x1"), (9, "ü ß 𝄞"),
    (11, " ".join(f"w{i * 7919 % 20000}x{i}" for i in range(500, 560))),
]


@pytest.mark.parametrize("size", [1, 2, 3, 10])
def test_odd_rows(odd, text_spark, size):
    assert found(odd, items_of(text_spark, ITEMS), size) == plain(ROWS, ITEMS, size)


def test_frequent_words_and_repeats(text_spark):
    draw = random.Random(4)
    docs = [(i, " ".join(draw.choice("abcde") if draw.random() < 0.9 else f"r{draw.randrange(30)}" for _ in range(draw.randrange(120)))) for i in range(80)]
    items = [(i, " ".join(draw.choice("abcde") if draw.random() < 0.8 else f"r{draw.randrange(30)}" for _ in range(draw.randrange(1, 9)))) for i in range(60)]
    items += [(100, docs[3][1]), (101, docs[3][1]), (102, "a a a a a a")]
    for size in (4, 10):
        assert found(documents(text_spark, docs), items_of(text_spark, items), size) == plain(docs, items, size)


def test_shuffled_joins_give_the_same(text_spark, odd, monkeypatch):
    monkeypatch.setattr(phrase_index, "BROADCAST_ROWS", 0)
    assert found(odd, items_of(text_spark, ITEMS), 3) == plain(ROWS, ITEMS, 3)


def test_empty_tables(text_spark, odd, nothing):
    assert phrase_index.mark_documents(nothing, items_of(text_spark, ITEMS)).collect() == []
    rows = phrase_index.mark_documents(odd, items_of(text_spark, [])).collect()
    assert len(rows) == len(ROWS) and not any(r.n_hit or r.n_items for r in rows)


def near(docs, items, size, slack):
    counts = {}
    for _, text in docs:
        for w in words(text):
            counts[w] = counts.get(w, 0) + 1
    return {(doc, item) for doc, text in docs for item, itext in items for window in windows(itext, size)
            if all(w in counts for w in window) and near_starts(words(text), window, counts, slack)}


def near_starts(w, window, counts, slack):
    least = min(counts[x] for x in window)
    starts = set()
    offset = next(i for i, x in enumerate(window) if counts[x] == least)
    for p in (i for i, x in enumerate(w) if x == window[offset]):
        if all(any(abs(q - (p - offset + o)) <= slack for q in range(len(w)) if w[q] == x) for o, x in enumerate(window) if o != offset):
            starts.add(p - offset)
    return starts


def test_near_matches_bear_moved_and_inserted_words(text_spark):
    docs = [(1, "we saw that red hats are rarely worn here"), (2, "red and blue hats are now rarely worn"), (3, "worn hats are red rarely"),
            (4, "red " + "x " * 30 + "hats rarely worn"), (5, None)]
    items = [(1, "red hats rarely worn"), (2, "blue hats")]
    for slack in (0, 1, 2, 3):
        rows = phrase_index.near_matches(documents(text_spark, docs), items_of(text_spark, items), slack, 4).collect()
        assert {(r.id, r.item_id) for r in rows} == near(docs, items, 4, slack)
    exact = phrase_index.near_matches(documents(text_spark, docs), items_of(text_spark, items), 0, 2).collect()
    assert {(r.id, r.item_id) for r in exact} == {(1, 1), (2, 2), (2, 1), (1, 1), (4, 1)}


def test_plan_is_native(text_spark):
    sf = "/root/testdata/sf0.001"
    marked = phrase_index.mark_documents(table(text_spark, sf, "documents"), table(text_spark, sf, "benchmark"))
    plan = marked._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Cartesian|NestedLoop", plan)
