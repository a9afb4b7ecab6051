from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from basketstream.llm import quality_model, toxicity
from basketstream.llm.labelled import remainder
from basketstream.llm.queries import REGISTRY
from conftest_data import ROWS

SF = "/root/testdata/sf0.01"


def held_out(text_spark, name, label):
    labels = text_spark.read.parquet(f"{SF}/labels.parquet")
    rows = REGISTRY[name](text_spark, SF)
    assert rows.count() == 1000 and rows.where("score IS NULL OR score < 0 OR score > 1").count() == 0
    return [(r[label], r.predicted) for r in rows.where("held_out").join(labels, "doc_id").collect()]


def test_quality_on_held_out_rows(text_spark):
    pairs = held_out(text_spark, "op7_quality_model", "quality")
    assert len(pairs) > 40 and np.mean([a == b for a, b in pairs]) > 0.97


def test_toxicity_on_held_out_rows(text_spark):
    # 26 toxic examples are few: only that most are found and few clean ones are blamed can be asked here.
    pairs = held_out(text_spark, "op4_toxicity", "toxic")
    assert np.mean([a == b for a, b in pairs]) > 0.93


def test_nearest_is_exact():
    draw = np.random.default_rng(3)
    vectors = []
    for _ in range(500):
        numbers = np.sort(draw.choice(60, draw.integers(1, 9), replace=False))
        weights = draw.random(len(numbers)) + 0.1
        vectors.append((numbers, weights / np.linalg.norm(weights)))
    ids = draw.permutation(1000)[:500].tolist()
    index = toxicity.Index(ids, draw.integers(0, 2, 500).tolist(), vectors, 60)
    dense = np.zeros((500, 60))
    for row, (numbers, weights) in enumerate(vectors):
        dense[row, numbers] = weights
    for query in range(60):
        places, cosines = index.nearest(*vectors[query], leave_out=ids[query])
        scores = dense @ dense[query]
        want = sorted((-round(s, 12), i) for s, i in zip(scores, ids) if s > 0 and i != ids[query])[: toxicity.NEIGHBOURS]
        assert index.ids[places].tolist() == [i for _, i in want]
        assert np.allclose(cosines, [-s for s, _ in want])


def test_neighbours_from_raw_texts_count_every_term(text_spark):
    """Evidence like brute force over whole texts; the only link of a pair of texts is a word that two of 400 have."""
    draw = np.random.default_rng(8)
    common = [f"word{c}" for c in "abcdefghijklmnopqrstuvwxyz"]
    texts = [" ".join(draw.choice(common, 12)) for _ in range(400)]
    texts[399], texts[398] = "zebu quagga", "quagga okapi okapi"
    docs = text_spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    labels = text_spark.createDataFrame([(i, int(i % 5 == 3)) for i in range(399)], "doc_id long, toxic int")
    model = toxicity.train(docs, labels, F.lit(True))
    counts = [Counter(text.split()) for text in texts]
    df = Counter(t for own in counts for t in own)
    vocabulary = sorted(df)
    idf = np.log(401 / (1 + np.array([df[t] for t in vocabulary]))) + 1
    dense = np.array([[1 + np.log(own[t]) if t in own else 0 for t in vocabulary] for own in counts]) * idf
    dense /= np.linalg.norm(dense, axis=1, keepdims=True)
    at_once = {r.doc_id: r for r in toxicity.score_corpus(docs, labels, F.lit(True)).collect()}
    for row in model.score(docs).collect():
        assert row == at_once[row.doc_id]
        scores = dense[:399] @ dense[row.doc_id]
        want = sorted((-round(s, 9), i) for i, s in enumerate(scores) if s > 0)[: toxicity.EVIDENCE]
        assert [e.doc_id for e in row.evidence] == [i for _, i in want] or np.allclose(
            [scores[e.doc_id] for e in row.evidence], [-s for s, _ in want])
        assert np.allclose([e.cosine for e in row.evidence], [-s for s, _ in want])
        if row.doc_id == 399:
            assert [(e.doc_id, e.label) for e in row.evidence] == [(398, 1)]


def test_nearest_by_whole_texts_is_exact(monkeypatch):
    """Blocks of 8 and a head of 10 terms, so that lists and their maxima decide."""
    monkeypatch.setattr(toxicity, "BLOCK", 8)
    monkeypatch.setattr(toxicity, "HEAD", 10)
    draw = np.random.default_rng(4)
    chance = 1 / np.arange(1, 301) ** 1.1
    vectors = []
    for _ in range(400):
        numbers = np.sort(draw.choice(300, draw.integers(1, 30), replace=False, p=chance / chance.sum()))
        weights = draw.random(len(numbers)) + 0.1
        vectors.append((numbers, weights / np.linalg.norm(weights)))
    ids = draw.permutation(1000)[:400].tolist()
    index = toxicity.WholeIndex(ids, draw.integers(0, 2, 400).tolist(), vectors, 300)
    dense = np.zeros((400, 300))
    for row, (numbers, weights) in enumerate(vectors):
        dense[row, numbers] = weights
    for query, (places, cosines) in enumerate(index.nearest_of(vectors, leave_out=ids)):
        scores = dense @ dense[query]
        want = sorted((-round(s, 12), i) for s, i in zip(scores, ids) if s > 0 and i != ids[query])[: toxicity.NEIGHBOURS]
        assert index.ids[places].tolist() == [i for _, i in want]
        assert np.allclose(cosines, [-s for s, _ in want])


def test_rarest_terms_weigh_alike(text_spark, monkeypatch):
    monkeypatch.setattr(toxicity, "RAREST", 0.05)
    docs = text_spark.createDataFrame([(i, "all " + ("some " if i < 50 else "") + f"own{'abcdefghij'[i % 10] * (i // 10 + 1)}") for i in range(100)], "doc_id long, text string")
    found = toxicity.document_frequencies(toxicity.count_terms(docs, ["some"]), ["some"])
    hashes = np.array([toxicity.Terms()(w)[0][0][0] for w in ("all", "some", "owna", "never")] + [toxicity.telling_hash("some")])
    assert np.allclose(found.idf(hashes), [np.log(101 / (1 + n)) + 1 for n in (100, 50, 5, 5, 50)])
    assert len(found.table()[0]) == 3


def test_contexts_and_pooling_like_plain_loops():
    draw = np.random.default_rng(5)
    index = quality_model.index_vectors([f"t{i}" for i in range(20)])
    assert (np.abs(index).sum(1) == quality_model.NONZERO).all()
    numbers = draw.integers(0, 20, 700).astype(np.int32)
    want = np.zeros(index.shape)
    for i, token in enumerate(numbers):
        for j in range(max(0, i - 2), min(len(numbers), i + 3)):
            if j != i:
                want[token] += index[numbers[j]]
    found = np.zeros(index.shape)
    quality_model.context_sums(numbers, index, found)
    assert np.allclose(found, want)
    pooled = quality_model.pool(numbers, index)
    assert np.allclose(pooled[: quality_model.DIMENSIONS], index[numbers].mean(0), atol=1e-5)
    assert not quality_model.pool(numbers[:0], index).any()


@pytest.mark.parametrize("module,column", [(quality_model, "quality"), (toxicity, "toxic")])
def test_odd_rows_and_missing_classes(text_spark, odd, nothing, module, column):
    none = text_spark.createDataFrame([], "doc_id long, quality int, toxic int")
    some = text_spark.createDataFrame([(i, i % 2, i % 2) for i in range(1, 15)] + [(None, 1, 1), (3, None, None)], none.schema)
    ones = some.where("quality = 1")
    for labels in (none, ones, some):
        model = module.train(odd, labels, remainder("doc_id", 5) != 0)
        rows = model.score(odd).collect()
        assert len(rows) == len(ROWS) and all(0 <= r.score <= 1 for r in rows)
        assert model.score(nothing).count() == 0
    assert module.train(nothing, some, remainder("doc_id", 5) != 0).score(odd).count() == len(ROWS)
    if module is quality_model:
        kept = model.filter(odd, 0.0)
        assert kept.schema == odd.schema and kept.count() == len(ROWS)
