import re

import pytest
from pyspark.sql import functions as F

from basketstream.llm import quality_rules
from basketstream.llm.queries import REGISTRY
from conftest_data import ROWS, documents

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text):
    words = WORD.findall(text or "")
    lines = [line for line in (text or "").split("\n") if WORD.search(line)]
    seen, covered = {}, set()
    for i in range(len(words) - 2):
        seen.setdefault(tuple(words[i : i + 3]), []).append(i)
    for at in seen.values():
        if len(at) > 1:
            covered.update(p for i in at for p in (i, i + 1, i + 2))
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered))


NAMES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def test_measures_like_brute_force(odd, nothing):
    found = quality_rules.measure(odd).select("doc_id", *NAMES).collect()
    assert sorted(map(str, map(tuple, found))) == sorted(str((i, *plain(t))) for i, t in ROWS)
    assert quality_rules.measure(nothing).count() == 0


def test_learned_list_finds_the_planted_rule(text_spark):
    good = [(i, " ".join(f"w{(i * 31 + j) * j % 1009}" for j in range(80))) for i in range(300)]
    bad = [(1000 + i, " ".join(f"w{(i * 17 + j) * j % 1009}!!" for j in range(80))) for i in range(150)]
    docs = documents(text_spark, good + bad)
    labels = text_spark.createDataFrame([(i, int(i < 1000)) for i, _ in good + bad] + [(1000, 1), (None, 0), (5, None)], "doc_id long, quality int")
    rules = quality_rules.learn(quality_rules.measure(docs), labels)
    assert rules and rules[0][0].feature == "shout_rate" and rules[0][0].above
    kept = {r.doc_id for r in quality_rules.keep_good(docs, labels).collect()}
    assert kept == {i for i, _ in good}
    assert quality_rules.keep_good(docs, labels).schema == docs.schema


def test_no_labels_reject_only_by_the_base(odd, text_spark):
    labels = text_spark.createDataFrame([], "doc_id long, quality int")
    judged = quality_rules.score_documents(odd, labels)
    assert judged.where("kept = base_failed").count() == 0 and judged.count() == len(ROWS)
    failed = {str((i, plain(t)[0])) for i, t in ROWS if plain(t)[0] < 50 or 100 * plain(t)[4] > 50 * plain(t)[0]}
    assert {str((r.doc_id, r.n_words)) for r in judged.where("base_failed").collect()} == failed


@pytest.fixture(scope="module")
def middle(text_spark):
    return REGISTRY["op9_quality_rules"](text_spark, "/root/testdata/sf0.01")


def test_clean_documents_stay(middle, text_spark):
    labels = text_spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    joined = middle.join(labels, "doc_id").where("NOT base_failed")
    counts = {(r.quality, r.kept): r["count"] for r in joined.groupBy("quality", "kept").count().collect()}
    assert counts.get((1, False), 0) == 0 and counts.get((0, True), 0) <= 1


def test_plan_is_native(middle):
    plan = middle._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)
    assert middle.agg(F.count("*")).first()[0] == 1000
