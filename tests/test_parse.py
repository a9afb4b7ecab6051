import json

import pytest

from basketstream import fixed_values as fixed
from basketstream.operators import parse
from basketstream.schemas import BRONZE_COLUMNS, KAFKA_RECORD, names
from test_contract import ABSENT, EVENT, PRODUCT, changed

BASE = {**EVENT, "client_id": 52077, "payload": {"sku": 6120}, "event_time": "2023-05-17 21:08:54"}
KEY = "52077"


def records(spark, pairs, topic=fixed.EVENT_TOPIC):
    rows = [
        (key.encode() if key is not None else None, value.encode() if value is not None else None, topic, 0, i, None, 0)
        for i, (key, value) in enumerate(pairs)
    ]
    return spark.createDataFrame(rows, KAFKA_RECORD)


def codes(df):
    return [row["validation_error"] for row in df.orderBy("kafka_offset").collect()]


EVENT_CASES = [
    (KEY, json.dumps(BASE), None),
    (KEY, "{", "malformed_json"),
    (KEY, "null", "malformed_json"),
    (KEY, "[" + json.dumps(BASE) + "]", "malformed_json"),
    (KEY, changed(BASE, "client_id", "12"), "malformed_json"),
    (KEY, None, "invalid_schema_version"),
    (KEY, "", "invalid_schema_version"),
    (KEY, changed(BASE, "schema_version", "2"), "invalid_schema_version"),
    (KEY, changed(BASE, "event_id", "x"), "invalid_event_id"),
    (KEY, changed(BASE, "event_type", "wishlist"), "invalid_event_type"),
    (KEY, changed(BASE, "event_time", "2022-02-30 12:00:00"), "invalid_event_time"),
    (KEY, changed(BASE, "event_time_timezone", "UTC"), "unexpected_event_time_timezone"),
    ("-1", changed(BASE, "client_id", -1), "invalid_client_id"),
    ("999", json.dumps(BASE), "invalid_message_key"),
    (None, json.dumps(BASE), "invalid_message_key"),
    (KEY, changed(BASE, "payload", {}), "missing_sku"),
    (KEY, changed({**BASE, "event_type": "page_visit"}, "payload", {}), "missing_url_id"),
    (KEY, changed({**BASE, "event_type": "page_visit"}, "payload", {"url_id": 42}), None),
    (KEY, changed({**BASE, "event_type": "search_query"}, "payload", {}), "missing_query_vector"),
    (KEY, changed({**BASE, "event_type": "search_query"}, "payload", {"query_vector_raw": "[1 2]"}), None),
    (KEY, changed(BASE, "source.dataset", "x"), "invalid_source_dataset"),
    (KEY, changed(BASE, "source.file", "x"), "invalid_source_file"),
    (KEY, changed(BASE, "source.row_number", -1), "invalid_source_row_number"),
    (KEY, changed(BASE, "source.row_number", ABSENT), "invalid_source_row_number"),
    (KEY, changed(BASE, "replay.run_id", "x"), "invalid_replay_run_id"),
    (KEY, changed(BASE, "replay.published_at", "2031-03-05T06:07:08+08:00"), "invalid_published_at"),
    (KEY, changed(BASE, "replay.published_at", "2031-03-05T06:07:08.5Z"), "invalid_published_at"),
    # The first broken rule is reported.
    ("999", changed(BASE, "event_time", "bad"), "invalid_event_time"),
    # Looser than the contract: unknown keys and negative products pass.
    (KEY, changed(BASE, "colour", "red"), None),
    (KEY, changed(BASE, "payload.sku", -5), None),
]


def test_event_codes(spark):
    df = parse.transform_events(records(spark, [case[:2] for case in EVENT_CASES]))
    assert codes(df) == [case[2] for case in EVENT_CASES]


PRODUCT_KEY = "88231"
PRODUCT_CASES = [
    (PRODUCT_KEY, json.dumps(PRODUCT), None),
    (PRODUCT_KEY, "{invalid-json", "malformed_json"),
    (PRODUCT_KEY, None, "malformed_json"),
    (PRODUCT_KEY, "", "invalid_schema_version"),
    (PRODUCT_KEY, changed(PRODUCT, "record_id", "x"), "invalid_record_id"),
    ("-1", changed(PRODUCT, "sku", -1), "invalid_sku"),
    ("999", json.dumps(PRODUCT), "invalid_message_key"),
    (PRODUCT_KEY, changed(PRODUCT, "category_id", None), "invalid_category_id"),
    (PRODUCT_KEY, changed(PRODUCT, "price_bucket", 100), "invalid_price_bucket"),
    (PRODUCT_KEY, changed(PRODUCT, "name_vector_raw", "no brackets"), "invalid_name_vector"),
    (PRODUCT_KEY, changed(PRODUCT, "source.dataset", "x"), "invalid_source_dataset"),
    (PRODUCT_KEY, changed(PRODUCT, "source.file", "x"), "invalid_source_file"),
    (PRODUCT_KEY, changed(PRODUCT, "source.row_number", -1), "invalid_source_row_number"),
    (PRODUCT_KEY, changed(PRODUCT, "replay.run_id", "x"), "invalid_replay_run_id"),
    (PRODUCT_KEY, changed(PRODUCT, "replay.published_at", "2026"), "invalid_published_at"),
]


def test_product_codes(spark):
    df = parse.transform_products(records(spark, [case[:2] for case in PRODUCT_CASES], fixed.PRODUCT_TOPIC))
    assert codes(df) == [case[2] for case in PRODUCT_CASES]


def test_every_code_is_covered():
    assert {code for code, _ in parse.event_rules()} == {case[2] for case in EVENT_CASES} - {None}
    covered = {case[2] for case in PRODUCT_CASES} - {None}
    assert {code for code, _ in parse.product_rules()} == covered


def test_split_and_columns(spark):
    df = parse.transform_events(records(spark, [(KEY, json.dumps(BASE)), (KEY, "{")]))
    valid, invalid = parse.split_valid(df)
    assert sorted(valid.columns) == sorted(names(BRONZE_COLUMNS["events"]))
    assert dict(valid.dtypes)["event_time_local"] == "timestamp_ntz"
    assert [row["validation_error"] for row in invalid.collect()] == ["malformed_json"]
    assert "is_valid" not in invalid.columns
    summary = {row["outcome"]: row["records"] for row in parse.validation_summary(df).collect()}
    assert summary == {"valid": 1, "malformed_json": 1}


def test_json_is_parsed_once(spark):
    valid, _ = parse.split_valid(parse.transform_events(records(spark, [(KEY, json.dumps(BASE))])))
    plan = valid._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1


def test_latest_per_key(spark):
    rows = [("1", 0, 5, "old"), ("1", 0, 9, "new"), ("2", 1, 3, "only")]
    df = spark.createDataFrame(rows, "message_key string, kafka_partition int, kafka_offset bigint, x string")
    latest = parse.latest_products(df)
    assert sorted(row["x"] for row in latest.collect()) == ["new", "only"]
    plan = latest._jdf.queryExecution().executedPlan().toString()
    assert "row_number(), 1, Partial" in plan
    assert [row["x"] for row in parse.sample_records(df, 2).collect()] == ["old", "new"]


@pytest.mark.parametrize("stage", ["transformation", "unknown"])
def test_dlq_landing(spark, stage):
    from test_contract import DLQ
    text = changed(DLQ, "error.stage", stage)
    (row,) = parse.transform_dlq(records(spark, [("k", text)], fixed.DLQ_TOPIC)).collect()
    assert row["error_stage"] == stage
    assert row["contract_errors"] == ([] if stage == "transformation" else ["error_stage"])
    assert json.loads(row["raw_record"]) == DLQ["raw_record"]
