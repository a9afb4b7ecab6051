from collections import defaultdict

import pytest

import corpus_pipeline
from basketstream.llm import exact_dedup, packing, quality_model, quality_rules, simhash
from basketstream.llm.labelled import remainder
from basketstream.llm.queries import QUALITY_THRESHOLD
from test_exact_dedup import expected
from test_quality_rules import plain
from test_similar import plain_keep

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(text_spark):
    """Rows after each stage."""
    docs, out = text_spark.read.parquet(f"{SF}/documents.parquet"), []
    for _, stage in corpus_pipeline.STAGES:
        out.append(docs)
        docs = exact_dedup.write_once(stage(text_spark, docs, SF), "test-stage")
    return [*out, docs]


def texts(frame):
    return {r.doc_id: r.text for r in frame.collect()}


def test_classifier_stage(stages, text_spark):
    labels = text_spark.read.parquet(f"{SF}/labels.parquet")
    model = quality_model.train(stages[0], labels, remainder("doc_id", 5) != 0)
    want = {r.doc_id for r in model.score(stages[0]).collect() if r.score >= QUALITY_THRESHOLD}
    assert set(texts(stages[1])) == want and 0 < len(want) < 200


def test_rules_stage(stages, text_spark):
    labels = text_spark.read.parquet(f"{SF}/labels.parquet").where(remainder("doc_id", 5) != 0)
    rules = quality_rules.learn(quality_rules.measure(stages[1]), labels)
    want = set()
    for doc, text in texts(stages[1]).items():
        words, chars, symbols, lines, repeats = plain(text)
        rates = {"symbol_rate": symbols / max(words, 1), "repeat_rate": repeats / max(words, 1), "dup_line_rate": lines / max(words, 1),
                 "shout_rate": text.count("!") / max(words, 1), "word_length": chars / max(words, 1)}
        rejected = any(all((rates[c.feature] > c.threshold) == c.above for c in rule) for rule in rules)
        if not (words < 50 or 100 * repeats > 50 * words or rejected):
            want.add(doc)
    assert set(texts(stages[2])) == want


def test_dedup_stages(stages):
    rows = list(texts(stages[2]).items())
    assert set(texts(stages[3])) == {keep for _, keep, _, _ in expected(rows)}
    ids, rows = zip(*sorted(texts(stages[3]).items()))
    assert set(texts(stages[4])) == {ids[i] for i in plain_keep(rows)}
    for before, after in zip(stages[:4], stages[1:5]):
        assert after.columns == before.columns
        kept = texts(before)
        assert all(kept[i] == t for i, t in texts(after).items())


def test_run_packs_what_is_left(stages, text_spark):
    sizes = defaultdict(int)
    for r in corpus_pipeline.run(text_spark, SF).collect():
        sizes[r.doc_id, r.doc_tokens] += r.length
    coder, want = packing.encoder(packing.VOCABULARY), {}
    for doc, text in texts(stages[4]).items():
        coder.learn([text])
        want[doc] = len(coder.ids(text)) // 4 + 1
    assert {k[0]: v for k, v in sizes.items()} == want and all(k[1] == v for k, v in sizes.items())


def test_odd_and_empty_tables_pass_every_stage(text_spark, odd, nothing, monkeypatch):
    labels = text_spark.createDataFrame([(1, 1, 0), (2, 0, 1)], "doc_id long, quality int, toxic int")
    monkeypatch.setattr(corpus_pipeline, "table", lambda spark, sf, name: labels)
    for docs in (exact_dedup.write_once(odd, "odd"), exact_dedup.write_once(nothing, "nothing")):
        for name, stage in corpus_pipeline.STAGES[:4]:
            kept = stage(text_spark, docs, "")
            assert kept.schema == docs.schema, name
            assert kept.count() <= docs.count()
