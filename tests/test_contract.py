import copy
import json

import pytest
from pyspark.sql import functions as F

from basketstream import fixed_values as fixed
from basketstream.operators import contract

SOURCE = {"dataset": fixed.DATASET, "file": "add_to_cart.parquet", "row_number": 7}
REPLAY = {"run_id": "5b0c3f52-8e1d-4f7a-b6a4-0d9e27c1f883", "published_at": "2031-03-05T06:07:08Z"}
EVENT = {
    "schema_version": "1.0.0", "event_id": "2167e60c-7417-5c99-aac2-ad2db74dab4a", "event_type": "add_to_cart",
    "event_time": "2023-02-11 09:41:03", "event_time_timezone": None, "client_id": 40417,
    "payload": {"sku": 7313}, "source": SOURCE, "replay": REPLAY,
}
PRODUCT = {
    "schema_version": "1.0.0", "record_id": "2167e60c-7417-5c99-aac2-ad2db74dab4a", "sku": 88231,
    "category_id": 412, "price_bucket": 61, "name_vector_raw": "[17 4 250]",
    "source": {**SOURCE, "file": fixed.PRODUCT_FILE}, "replay": REPLAY,
}
DLQ = {
    "schema_version": "1.0.0", "dlq_id": "2167e60c-7417-5c99-aac2-ad2db74dab4a", "original_topic": fixed.EVENT_TOPIC,
    "source": SOURCE, "replay": {"run_id": REPLAY["run_id"], "failed_at": "2031-03-05T06:07:08Z"},
    "error": {"stage": "transformation", "type": "ValueError", "message": "client is missing"},
    "raw_record": {"client_id": 10, "anything": [1]},
}
ABSENT = object()


def changed(record, path, value):
    record = copy.deepcopy(record)
    *parents, last = path.split(".")
    holder = record
    for name in parents:
        holder = holder[name]
    if value is ABSENT:
        del holder[last]
    else:
        holder[last] = value
    return json.dumps(record)


def broken(spark, kind, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    judged = contract.add_contract_errors(df, kind, F.col("text"), "codes")
    return [row["codes"] for row in judged.orderBy("i").collect()]


def search(vector):
    record = {**EVENT, "event_type": "search_query", "payload": {"query_vector_raw": vector}}
    return json.dumps(record)


def test_event_cases(spark):
    cases = [
        (json.dumps(EVENT), []),
        (json.dumps({**EVENT, "event_type": "page_visit", "payload": {"url_id": 3}}), []),
        (search("[1 2]"), []),
        (search("no brackets"), ["payload"]),
        (search("[1\n2]"), ["payload"]),
        (changed(EVENT, "event_type", "page_visit"), ["payload"]),
        (changed(EVENT, "payload.extra", 1), ["payload"]),
        (changed(EVENT, "payload.sku", -1), ["payload"]),
        (changed(EVENT, "payload.sku", True), ["payload"]),
        (changed(EVENT, "payload.sku", 1.0), []),
        (changed(EVENT, "payload.sku", 1.5), ["payload"]),
        (changed(EVENT, "event_id", "123-abc"), ["event_id"]),
        (changed(EVENT, "event_time", "2023-02-11T09:41:03Z"), ["event_time"]),
        (changed(EVENT, "event_time_timezone", "UTC"), ["event_time_timezone"]),
        (changed(EVENT, "event_time_timezone", ABSENT), ["keys", "event_time_timezone"]),
        (changed(EVENT, "client_id", "5"), ["client_id"]),
        (changed(EVENT, "replay.published_at", "2031-03-05T06:07:08"), ["replay_published_at"]),
        (changed(EVENT, "replay.published_at", "2031-03-05T06:07:08.25+08:00"), []),
        (changed(EVENT, "replay.published_at", "2026-02-30T08:00:00Z"), ["replay_published_at"]),
        (changed(EVENT, "source.file", fixed.PRODUCT_FILE), ["source_file"]),
        (changed(EVENT, "source.more", 1), ["source_keys"]),
        (changed(EVENT, "schema_version", 1), ["schema_version"]),
        (changed(EVENT, "colour", "red"), ["keys"]),
        ("{", ["not_an_object"]),
        ("[]", ["not_an_object"]),
        (None, ["not_an_object"]),
    ]
    assert broken(spark, "event", [text for text, _ in cases]) == [codes for _, codes in cases]


def test_product_cases(spark):
    cases = [
        (json.dumps(PRODUCT), []),
        (changed(PRODUCT, "price_bucket", 99), []),
        (changed(PRODUCT, "price_bucket", 100), ["price_bucket"]),
        (changed(PRODUCT, "weight", "2 kg"), ["keys"]),
        (changed(PRODUCT, "name_vector_raw", "x"), ["name_vector_raw"]),
        (changed(PRODUCT, "source.file", "add_to_cart.parquet"), ["source_file"]),
    ]
    assert broken(spark, "product", [text for text, _ in cases]) == [codes for _, codes in cases]


def test_dlq_cases(spark):
    cases = [
        (json.dumps(DLQ), []),
        (changed(DLQ, "error.stage", "unknown"), ["error_stage"]),
        (changed(DLQ, "error.message", ""), ["error_message"]),
        (changed(DLQ, "original_topic", "some.topic"), ["original_topic"]),
        (changed(DLQ, "raw_record", ABSENT), ["keys", "raw_record"]),
        (changed(DLQ, "raw_record", [1]), ["raw_record"]),
        # An unknown object right behind the open record, in the order of the schema text, and one elsewhere.
        (changed(DLQ, "reason", {"x": 1}), ["keys"]),
        (changed(DLQ, "zzz", {"x": 1}), ["keys"]),
        (changed(DLQ, "raw_record", {"replay": {"x": [{"y": 1}]}}), []),
    ]
    assert broken(spark, "dlq", [text for text, _ in cases]) == [codes for _, codes in cases]


@pytest.mark.parametrize("name,value,code", [
    ("events_previous_day", None, "events_previous_day_not_finite"),
    ("events_previous_day", -1.0, "events_previous_day_negative"),
    ("events_previous_day", 1.5, "events_previous_day_not_whole"),
    ("hours_since_last_sku_event", float("nan"), "hours_since_last_sku_event_not_finite"),
    ("hours_since_last_sku_event", float("inf"), "hours_since_last_sku_event_not_finite"),
    ("hours_since_last_sku_event", -0.5, "hours_since_last_sku_event_negative"),
    ("hours_since_last_sku_event", 1.5, None),
])
def test_feature_rows(spark, name, value, code):
    names = [*fixed.COUNT_FEATURES, *fixed.RECENCY_FEATURES]
    df = spark.createDataFrame([tuple(value if n == name else 1.0 for n in names)], ", ".join(f"{n} double" for n in names))
    rules = contract.feature_row_errors(df, fixed.COUNT_FEATURES, fixed.RECENCY_FEATURES)
    assert df.select(rules.alias("x")).collect()[0]["x"] == ([code] if code else [])


def test_feature_columns(spark):
    df = spark.createDataFrame([(1, 2)], "events_previous_day bigint, extra bigint")
    with pytest.raises(ValueError, match="scoring input lacks"):
        contract.feature_row_errors(df, fixed.COUNT_FEATURES, fixed.RECENCY_FEATURES)
    assert contract.unexpected_columns(df, fixed.COUNT_FEATURES, fixed.RECENCY_FEATURES) == ["extra"]
