import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from basketstream.llm import sentencepiece_codec as codec
from basketstream.llm.queries import REGISTRY
from conftest_data import ROWS


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(codec.MODEL))


def odd_texts():
    draw = random.Random(2)
    made = ["".join(draw.choice("abcdet hioné ▁.\n日ü12") for _ in range(draw.randint(0, 200))) for _ in range(150)]
    return made + [t or "" for _, t in ROWS if len(t or "") < 6000] + ["    " * 20 + "x", "<s></s><0x41>", "\x00"]


def test_ids_and_texts_equal_the_library(library):
    coder = codec.pieces(codec.MODEL)
    for text in odd_texts():
        ids = np.frombuffer(coder.encode(text), np.int32).tolist()
        assert ids == library.encode(text)
        assert coder.decode(ids) == text.replace("▁", " ")


@pytest.mark.parametrize("every", [1, 5, 64])
def test_window_commits_do_not_change_the_path(library, every):
    draw = random.Random(4)
    text = "".join(draw.choice("abcdethion") for _ in range(3000))
    assert codec.pieces(codec.MODEL).search("▁" + text, every) == library.encode(text)


def test_tables(odd, nothing, library):
    rows = codec.decode(codec.encode(odd, carry=F.col("lang"))).collect()
    assert sorted((str(r.doc_id), r.text) for r in rows) == sorted((str(i), (t or "").replace("▁", " ")) for i, t in ROWS)
    assert all(r.carried == "en" for r in rows)
    assert codec.decode(codec.encode(nothing)).count() == 0


def test_null_ids_decode_to_nothing(text_spark):
    coded = text_spark.createDataFrame([(1, None), (2, []), (3, [22557])], "doc_id long, ids array<int>")
    assert {r.doc_id: r.text for r in codec.decode(coded).collect()} == {1: "", 2: "", 3: "Hello"}


def test_query_round_trips(text_spark):
    rows = REGISTRY["op2_sentencepiece"](text_spark, "/root/testdata/sf0.001")
    assert rows.where("NOT round_trip OR n_ids = 0").count() == 0 and rows.count() == 200
