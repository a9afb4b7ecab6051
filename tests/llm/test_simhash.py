import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from basketstream.llm import simhash
from basketstream.llm.components import components
from conftest_data import ROWS

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(UPPER))
    if not words:
        return 0
    grams = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints, ids):
    parent = list(range(len(prints)))

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if bin(prints[i] ^ prints[j]).count("1") <= 3:
                parent[top(i)] = top(j)
    least = {}
    for i, own in enumerate(ids):
        if own is not None:
            least[top(i)] = min(own, least.get(top(i), own))
    return [least.get(top(i)) for i in range(len(prints))]


def near_prints(count, seed):
    """Clouds of fingerprints around centres, some with several flipped bits."""
    draw = random.Random(seed)
    centres = [draw.getrandbits(64) for _ in range(12)]
    return [draw.choice(centres) ^ sum(1 << b for b in draw.sample(range(64), draw.choice([0, 1, 1, 2, 2, 3, 4, 6]))) for _ in range(count)]


def test_fingerprint_is_the_definition():
    for _, text in ROWS:
        assert simhash.fingerprint(None if text is None else text.encode()) == plain_fingerprint(text)


def test_every_pair_within_three_bits_meets_at_a_home_anchor():
    draw = random.Random(1)
    for _ in range(400):
        a = draw.getrandbits(64)
        b = a ^ sum(1 << bit for bit in draw.sample(range(64), draw.randint(1, 3)))
        keys, index, home = simhash.anchors(np.array([a, b], np.uint64))
        one, two = set(keys[index == 0].tolist()), set(keys[index == 1].tolist())
        assert set(keys[home].tolist()) & one & two
        assert len(one) <= 32


@pytest.mark.parametrize("block", [1 << 14, 7])
def test_components_like_brute_force(text_spark, block):
    prints = near_prints(700, 5)
    rows = text_spark.createDataFrame([(i, p - (1 << 64) if p >> 63 else p) for i, p in enumerate(prints)], "id long, print long")
    groups = {r.print % (1 << 64): r.component_id for r in simhash._groups(rows.repartition(5), 3, block).collect()}
    assert [groups[p] for p in prints] == plain_components(prints, range(700))


def test_marks_odd_rows(odd, nothing):
    rows = simhash.mark_components(odd).collect()
    texts = sorted(ROWS, key=str)
    want = plain_components([plain_fingerprint(t) for _, t in texts], [i for i, _ in texts])
    assert sorted((r.id, r.print % (1 << 64), r.component_id) for r in rows if r.id is not None) == sorted(
        (i, plain_fingerprint(t), c) for (i, t), c in zip(texts, want) if i is not None)
    kept = simhash.keep_one(odd)
    assert kept.schema == odd.schema
    # Components by their roots: two of them share the repeated id 12.
    assert kept.count() == len(set(plain_components([plain_fingerprint(t) for _, t in texts], range(len(texts)))))
    assert simhash.mark_components(nothing).count() == 0 and simhash.keep_one(nothing).count() == 0


def test_star_contraction(text_spark):
    chain = text_spark.range(1, 400).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    ring = text_spark.createDataFrame([(1000, 1001), (1001, 1002), (1002, 1000), (7000, 7000)], "a long, b long")
    found = {r.node: r.root for r in components(chain.unionByName(ring)).collect()}
    assert found == {**{i: 1 for i in range(2, 401)}, 1001: 1000, 1002: 1000}
    assert components(ring.where("a < 0")).count() == 0
