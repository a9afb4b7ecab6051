import json
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from basketstream import fixed_values as fixed
from basketstream.operators import envelope

RUN = "5b0c3f52-8e1d-4f7a-b6a4-0d9e27c1f883"
AT = datetime(2031, 3, 5, 6, 7, 8, tzinfo=timezone.utc)
RAW = ("source_file string, source_row_number bigint, client_id bigint, timestamp string, "
       "sku bigint, url bigint, query string")
STAMP = "2023-02-11 09:41:03"
VECTOR = "[240 170 240 207]"


def raw(spark, *rows):
    return spark.createDataFrame(list(rows), RAW)


def outcomes(df):
    return [row.asDict() for row in df.collect()]


def valid(kind, number=0):
    """A raw row of a type and the payload it must get; only the type's own field is filled."""
    value = f"[{number} {number + 5}]" if kind == "search_query" else 1000 + number
    field = {"page_visit": "url", "search_query": "query"}.get(kind, "sku")
    row = {"source_file": f"{kind}.parquet", "source_row_number": number, "client_id": 31 + number, "timestamp": "2031-02-28 08:00:09",
           "sku": None, "url": None, "query": None, field: value}
    return row, {{"url": "url_id", "query": "query_vector_raw"}.get(field, field): value}


def test_every_type_has_its_own_payload(spark):
    made = [valid(kind, number) for number, kind in enumerate(fixed.EVENT_TYPES)]
    rows = outcomes(envelope.replay(raw(spark, *[tuple(row.values()) for row, _ in made]), RUN, AT))
    assert len(rows) == len(made)
    for got in rows:
        record = json.loads(got["value"])
        row, payload = made[record["source"]["row_number"]]
        assert (got["topic"], got["key"], got["error_stage"]) == (fixed.EVENT_TOPIC, str(row["client_id"]), None)
        assert record == {
            "schema_version": fixed.SCHEMA_VERSION, "event_id": record["event_id"], "event_type": row["source_file"][:-8],
            "event_time": row["timestamp"], "event_time_timezone": None, "client_id": row["client_id"], "payload": payload,
            "source": {"dataset": fixed.DATASET, "file": row["source_file"], "row_number": row["source_row_number"]},
            "replay": {"run_id": RUN, "published_at": "2031-03-05T06:07:08Z"}}
        assert [key for key in record if key in ("payload", "source", "replay")] == ["payload", "source", "replay"]


def test_a_row_broken_everywhere_is_mended_rule_by_rule(spark):
    """The first rule that a row breaks names it; with that mended, the next one does."""
    row = {"source_file": "basket.parquet", "source_row_number": -1, "client_id": None, "timestamp": None, "sku": None, "url": None, "query": None}
    steps = [
        (f"{fixed.MSG_UNSUPPORTED_FILE}basket.parquet", {"source_file": "remove_from_cart.parquet"}),
        ("client_id must be an integer", {"client_id": -9}),
        ("client_id must be non-negative", {"client_id": 9}),
        ("timestamp must be a string", {"timestamp": "28 Feb 2031"}),
        (fixed.MSG_TIME_FORMAT, {"timestamp": "2031-02-29 08:00:09"}),
        (fixed.MSG_TIME_CALENDAR, {"timestamp": "2031-02-28 08:00:09"}),
        ("sku must be an integer", {"sku": -4}),
        ("sku must be non-negative", {"sku": 4}),
        ("row_number must be non-negative", {"source_row_number": 12}),
    ]
    for message, mend in steps:
        (got,) = outcomes(envelope.replay(raw(spark, tuple(row.values())), RUN, AT))
        assert (got["error_stage"], got["error_type"], got["error_message"]) == ("transformation", "ValueError", message)
        assert got["topic"] == fixed.DLQ_TOPIC
        row |= mend
    (got,) = outcomes(envelope.replay(raw(spark, tuple(row.values())), RUN, AT))
    assert got["error_stage"] is None and got["topic"] == fixed.EVENT_TOPIC


@pytest.mark.parametrize("kind,change,message", [
    ("page_visit", {"url": None}, "url must be an integer"),
    ("page_visit", {"url": -1, "sku": 3}, "url must be non-negative"),
    ("search_query", {"query": None}, "query must be a string"),
    ("search_query", {"query": "5 10"}, fixed.MSG_QUERY_VECTOR),
])
def test_browsing_payloads_are_checked_by_their_own_field(spark, kind, change, message):
    row = valid(kind)[0] | change
    (got,) = outcomes(envelope.replay(raw(spark, tuple(row.values())), RUN, AT))
    assert (got["error_stage"], got["error_message"]) == ("transformation", message)


def test_dead_letter_keeps_the_raw_record(spark):
    (row,) = outcomes(envelope.replay(raw(spark, ("add_to_cart.parquet", 4, 10, "invalid-timestamp", 100, None, None)), RUN, AT))
    letter = json.loads(row["value"])
    assert row["key"] == letter["dlq_id"]
    assert letter["raw_record"] == {"client_id": 10, "timestamp": "invalid-timestamp", "sku": 100}
    assert letter["original_topic"] == fixed.EVENT_TOPIC
    assert letter["error"]["stage"] == "transformation"


def test_contract_catches_what_the_builder_lets_through(spark):
    df = raw(spark, ("search_query.parquet", 0, 1, STAMP, None, None, "[1\n2]"))
    (row,) = outcomes(envelope.replay(df, RUN, AT))
    assert (row["error_stage"], row["error_message"]) == ("contract_validation", "payload")
    (unchecked,) = outcomes(envelope.replay(df, RUN, AT, validate=False))
    assert unchecked["error_stage"] is None


def test_products(spark):
    schema = "source_file string, source_row_number bigint, sku bigint, category bigint, price int, name string"
    rows = [
        (fixed.PRODUCT_FILE, 0, 88231, 412, 61, "[17 4 250]"),
        (fixed.PRODUCT_FILE, 1, 1, 2, 100, "[1]"),
        (fixed.PRODUCT_FILE, 2, None, 2, 100, "no"),
        (fixed.PRODUCT_FILE, 3, None, -1, 5, "[1]"),
    ]
    got = outcomes(envelope.replay(spark.createDataFrame(rows, schema), RUN, AT, products=True))
    by_row = {row["source_row_number"]: row for row in got}
    assert (by_row[0]["topic"], by_row[0]["key"]) == (fixed.PRODUCT_TOPIC, "88231")
    assert json.loads(by_row[0]["value"])["category_id"] == 412
    assert [by_row[i]["error_message"] for i in (1, 2, 3)] == [
        fixed.MSG_PRICE_RANGE, fixed.MSG_NAME_VECTOR, "sku must be an integer"]


def test_kafka_rows_and_summary(spark):
    df = raw(spark, ("search_query.parquet", 0, 7, STAMP, None, None, "[é]"), ("search_query.parquet", 1, None, STAMP, None, None, "[1]"))
    outcome = envelope.replay(df, RUN, AT)
    rows = {bytes(row["key"]): row for row in envelope.publish_rows(outcome).collect()}
    good = rows[b"7"]
    assert "é" in bytes(good["value"]).decode("utf-8")
    assert [(h["key"], bytes(h["value"])) for h in good["headers"]] == [
        ("content-type", b"application/json"), ("schema-version", b"1.0.0")]
    (summary,) = outcomes(envelope.replay_summary(outcome))
    assert (summary["processed"], summary["dead_lettered"]) == (2, 1)
    assert [r["source_row_number"] for r in envelope.preview(outcome, 1).collect()] == [0]
    assert envelope.dead_letters(outcome).select(F.count("*")).collect()[0][0] == 1


def odd_raw(spark):
    rows = [tuple(valid(kind, number)[0].values()) for number, kind in enumerate(fixed.EVENT_TYPES)]
    rows += [
        (None, 5, 1, STAMP, 7, 8, VECTOR), ("page_visit.parquet", None, 1, STAMP, None, 8, None), ("add_to_cart.parquet/part-1.parquet", 6, 1, STAMP, 7, None, None),
        ("search_query.parquet", 7, 1, STAMP, None, None, '["\\ é中\n\t/]'), ("search_query.parquet", 8, 1, STAMP, 3, 4, None),
        ("other.parquet", 9, 1, STAMP, 7, None, None), ("add_to_cart.parquet", 10, -1, None, None, None, None), ("product_buy.parquet", 11, 2**62, STAMP, 2**62, None, None)]
    return raw(spark, *rows)


def test_text_from_fields_is_that_of_the_variant(spark):
    df = odd_raw(spark)
    wanted = envelope.build_events(df, RUN, AT).select("source_row_number", "source_file", envelope.serialize(F.col("envelope")).alias("text"))
    found = envelope.build_events(df, RUN, AT, fields=True).select("source_row_number", "source_file", envelope.event_text(F.col("envelope")).alias("text"))
    assert sorted(map(str, found.collect())) == sorted(map(str, wanted.collect()))


def test_records_judged_by_field_and_by_text_agree_without_reading_back(spark):
    df = odd_raw(spark)
    by_field = envelope.replay(df, RUN, AT)
    # Another type of number than the contract's: these records are judged by their text.
    by_text = envelope.replay(df.withColumns({name: F.col(name).cast("decimal(20,0)") for name in ("sku", "url")}), RUN, AT)
    assert sorted(map(str, by_field.collect())) == sorted(map(str, by_text.collect()))
    plan = by_field.select("error_message")._jdf.queryExecution().executedPlan().toString()
    assert "schema_of_variant" not in plan and "parse_json" not in plan
