import random

import numpy as np
import pytest

import corpus_pipeline
from basketstream.llm import similar
from conftest_data import ROWS


def grams(text):
    words = [w.decode("utf-8", "surrogateescape") for w in text.encode().lower().split()]
    return {" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def root(parent, i):
    while parent[i] != i:
        i = parent[i]
    return i


def plain_roots(texts):
    """First index of each text's component, by brute force over all pairs."""
    sets, parent = [grams(t) for t in texts], list(range(len(texts)))
    for i in range(len(sets)):
        for j in range(i):
            if sets[i] == sets[j] or 10 * len(sets[i] & sets[j]) >= 8 * len(sets[i] | sets[j]):
                a, b = root(parent, i), root(parent, j)
                parent[max(a, b)] = min(a, b)
    return [root(parent, i) for i in range(len(texts))]


def plain_keep(texts):
    """Ids kept, if they are positions."""
    return set(plain_roots(texts))


def planted(seed=4):
    """Texts of 200 words with copies in which a block of words is new: similarities from 0.7 to 0.95, and chains."""
    draw, texts = random.Random(seed), []
    word = lambda: f"w{draw.randrange(10**6)}"
    for _ in range(40):
        base = [word() for _ in range(200)]
        texts.append(" ".join(base))
        for changed in (2, 6, 10, 16, 17, 18, 26, 32):
            at = draw.randrange(10, 150)
            texts.append(" ".join(base[:at] + [word() for _ in range(changed)] + base[at + changed :]))
    return texts + ["", " \n", "one two", "One  two", "one three"]


@pytest.mark.parametrize("block", [1000, 3])
def test_planted_copies_like_brute_force(text_spark, block):
    texts = planted()
    docs = text_spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    kept = similar.keep_one(docs, block=block)
    assert kept.schema == docs.schema
    assert sorted(r.doc_id for r in kept.collect()) == sorted(plain_keep(texts))


def test_odd_and_no_rows(odd, nothing):
    """Null and repeated ids and texts, and columns that the operator uses inside."""
    kept = similar.keep_one(odd)
    assert kept.schema == odd.schema
    texts = [t or "" for _, t in ROWS]
    sets, groups = [grams(t) for t in texts], {}
    for i, root in enumerate(plain_roots(texts)):
        groups.setdefault(root, []).append(ROWS[i])
    rows = [(r.doc_id, r.text) for r in kept.collect()]
    assert len(rows) == len(groups) and len(sets) == len(ROWS)
    for members in groups.values():
        least = min((i for i, _ in members if i is not None), default=None)
        assert sum(row in members and row[0] == least for row in rows) == 1
    assert similar.keep_one(nothing).collect() == [] and similar.keep_one(nothing).schema == nothing.schema


def test_a_cloud_of_copies_and_shuffled_joins(text_spark, monkeypatch):
    """Half of all texts are one text with a word changed; no side of a join is broadcast."""
    base = [f"w{i}" for i in range(80)]
    texts = [" ".join(base[:i] + ["new"] + base[i + 1 :]) for i in range(80)] + [" ".join(f"t{i}x{j}" for j in range(60)) for i in range(80)]
    monkeypatch.setattr(similar, "BROADCAST_ROWS", 0)
    docs = text_spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(7)
    assert sorted(r.doc_id for r in similar.keep_one(docs, block=20).collect()) == sorted(plain_keep(texts))


def test_walk_gives_the_links(text_spark):
    texts = planted(9)[:120]
    sets = [similar.shingles(t.encode()) for t in texts] + [np.empty(0, np.uint64)]
    parent = list(range(len(sets)))
    for a, b in similar.forest(sets):
        both = len(np.intersect1d(sets[a], sets[b]))
        assert both >= 0.8 * (len(sets[a]) + len(sets[b]) - both) - 1e-9
        x, y = (root(parent, i) for i in (a, b))
        assert x != y
        parent[max(x, y)] = min(x, y)
    assert [root(parent, i) for i in range(len(texts))] == plain_roots(texts)


def test_stage_drops_copies_of_similarity_above_the_bound(text_spark, tmp_path):
    texts = planted()
    text_spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(str(tmp_path / "docs"))
    docs = text_spark.read.parquet(str(tmp_path / "docs"))
    assert {r.doc_id for r in corpus_pipeline.near_duplicates(text_spark, docs, "").collect()} == plain_keep(texts)


def test_anchors_propose_without_bands(text_spark, monkeypatch):
    """Copies that differ in one word of a long text meet at anchors alone; fingerprints agree with those of op3 on distinct shingles."""
    draw = random.Random(9)
    bases = [[f"w{draw.randrange(10**6)}" for _ in range(1500)] for _ in range(12)]
    texts = [" ".join(words) for base in bases for words in (base, base[:700] + ["other"] + base[701:])]
    prints = [similar.simhash.fingerprint_of(similar.shingles(t.encode())) for t in texts]
    assert prints == [similar.simhash.fingerprint(t.encode(), similar.SHINGLE) for t in texts]
    monkeypatch.setattr(similar, "_banded", lambda distinct: distinct.selectExpr("print AS a", "print AS b").where("1 = 0"))
    docs = text_spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    near = {i + 1 for i in range(0, len(texts), 2) if (prints[i] ^ prints[i + 1]).bit_count() <= 3}
    assert len(near) >= 6
    assert {r.doc_id for r in similar.keep_one(docs).collect()} == set(range(len(texts))) - near
