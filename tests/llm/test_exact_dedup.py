import hashlib
import random
import re
from collections import defaultdict

from basketstream.llm import exact_dedup
from basketstream.llm.common import squeeze
from basketstream.llm.queries import ORACLES, REGISTRY
from compare import mismatch, open_tables
from conftest_data import ROWS, documents


def expected(rows):
    groups = defaultdict(list)
    for i, text in rows:
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", text or "")].append(i)
    out = []
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        out += [(i, min(known) if known else None, len(ids), hashlib.sha256(text.encode()).hexdigest()) for i in ids]
    return sorted(out, key=str)


def found(marked):
    return sorted(((r.id, r.keep_id, r.group_size, r.text_sha256) for r in marked.collect()), key=str)


def test_squeeze():
    for text in ["", " ", "a", " a", "a \t\n b ", "\x0b\x0c", "\x1ca\x1d", "  b"]:
        assert squeeze(text.encode()).decode() == re.sub(r"[\x20\x09-\x0D]+", " ", text)


def test_marks_like_brute_force(odd):
    marked = exact_dedup.mark_rows(odd)
    assert found(marked) == expected(ROWS)
    kept = [r for r in marked.collect() if r.kept]
    assert len(kept) == len({r.text_sha256 for r in kept}) == len({r[3] for r in expected(ROWS)})
    assert all(r.id == r.keep_id for r in kept)


def test_few_hash_bits_and_a_small_trie_spill_by_subtree(text_spark):
    draw = random.Random(3)
    texts = ["".join(draw.choice("ab") for _ in range(12)) for _ in range(400)]
    rows = [(i, texts[draw.randrange(400)]) for i in range(900)]
    marked = exact_dedup.mark_rows(documents(text_spark, rows).repartition(4), hash_bits=0, trie_bytes=2000, combine_bytes=3000)
    assert found(marked) == expected(rows)


def test_trie_splits_merges_and_cuts():
    trie = exact_dedup.Trie()
    for number, key in enumerate([b"abcd", b"abxy", b"abcd", b"abce", b"zzzz"]):
        trie.insert(key, number, min)
    assert dict(trie.terminals()) == {b"abcd": 0, b"abxy": 1, b"abce": 3, b"zzzz": 4}
    lead, cut = trie.cut_largest()
    assert lead == b"ab" and dict(cut) == {b"abcd": 0, b"abxy": 1, b"abce": 3}
    assert dict(trie.terminals()) == {b"zzzz": 4} and trie.cut_largest() is None


def test_keep_first_keeps_columns(odd, nothing):
    kept = exact_dedup.keep_first(odd)
    assert kept.schema == odd.schema
    assert kept.count() == len({r[3] for r in expected(ROWS)})
    assert exact_dedup.keep_first(nothing).collect() == [] and exact_dedup.mark_rows(nothing).count() == 0


def test_query_equals_oracle(text_spark):
    small = "/root/testdata/sf0.001"
    for name in ("op8_exact_dedup", "op10_url_filter", "op5_chat", "op6_warc"):
        assert mismatch(REGISTRY[name](text_spark, small), open_tables(small), ORACLES[name]) is None, name
