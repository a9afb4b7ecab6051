from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from basketstream.llm import packing
from basketstream.llm.queries import REGISTRY
from conftest_data import ROWS, documents


@pytest.fixture(scope="module")
def reference_ids():
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids + [1]


def rebuild(pieces):
    documents_found, sequences = defaultdict(list), defaultdict(list)
    for r in pieces:
        ids = np.frombuffer(bytes(r.ids), "<u4").tolist()
        assert len(ids) == r.length
        documents_found[r.doc_id, r.doc_tokens].append((r.start, ids))
        sequences[r.sequence_id].append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= packing.LENGTH
    return documents_found, {s: sum(n for _, n in parts) for s, parts in sequences.items()}


@pytest.mark.parametrize("windows", [1, 64])
def test_every_id_once_and_in_place(odd, reference_ids, windows):
    found, filled = rebuild(packing.pack(odd, open_windows=windows, merge_tasks=2).collect())
    want = defaultdict(list)
    for i, text in ROWS:
        ids = reference_ids(text)
        want[i, len(ids)].append(ids)
    assert set(found) == set(want)
    for key, parts in found.items():
        total = sum(len(ids) for _, ids in parts)
        assert total == sum(map(len, want[key]))
        if len(want[key]) == 1:
            assert [x for _, ids in sorted(parts) for x in ids] == want[key][0]
            assert [s for s, _ in sorted(parts)] == np.cumsum([0] + [len(ids) for _, ids in sorted(parts)])[:-1].tolist()
    assert sum(filled.values()) == sum(len(reference_ids(t)) for _, t in ROWS)


def test_little_padding(text_spark, reference_ids):
    rows = [(i, " ".join(f"word{i * j % 97}" for j in range(1 + i * 37 % 900))) for i in range(300)]
    _, filled = rebuild(packing.pack(documents(text_spark, rows).repartition(4), open_windows=8, merge_tasks=2).collect())
    padding = sum(packing.LENGTH - n for n in filled.values() if n & (n - 1))
    assert padding < 0.01 * sum(filled.values())


def test_ids_are_those_of_the_named_tokenizer(reference_ids, text_spark):
    coder = packing.encoder(packing.VOCABULARY)
    given = [r.text for r in text_spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()]
    for text in [t or "" for t in given] + ["a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|><|endoftext|>y z", "<|endoftext |>", "  two  spaces ", "tab\t x", "x \n y", "", " ", "it's  don't"]:
        coder.learn([text])
        assert np.frombuffer(coder.ids(text), np.uint32).tolist() == reference_ids(text)[:-1]


def test_empty_table(nothing):
    assert packing.pack(nothing).collect() == []


def test_query_covers_every_document(text_spark):
    rows = REGISTRY["op1_packing"](text_spark, "/root/testdata/sf0.001").collect()
    ends = defaultdict(int)
    for r in rows:
        ends[r.doc_id, r.doc_tokens] += r.length
    assert all(total == tokens for (_, tokens), total in ends.items())
    assert len(ends) == text_spark.read.parquet("/root/testdata/sf0.001/documents.parquet").count()
