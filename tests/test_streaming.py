import json
import os

import pytest
from pyspark.sql import functions as F

from basketstream.functions.ids import record_id
from basketstream.operators.membership import LandingIndex
from basketstream.plans.incremental import Warehouse
from basketstream.sources import kafka
from basketstream.streaming import sinks
from test_contract import PRODUCT, changed
from test_landing import event
from test_parse import records


def send(spark, inbox, ids, damaged=()):
    rows = [event(i) for i in ids] + [(str(i), changed(json.loads(event(i)[1]), "event_type", "x")) for i in damaged]
    records(spark, rows).write.mode("append").parquet(inbox)


def test_both_queries_and_rerun(spark, tmp_path):
    inbox, paths = str(tmp_path / "inbox"), sinks.StreamPaths(str(tmp_path), "events")
    send(spark, inbox, [1, 2, 3], damaged=[4])
    for _ in range(2):
        sinks.run_topic(spark, sinks.file_stream(spark, inbox, 1), paths)
        assert spark.read.parquet(paths.bronze).count() == 3
        (bad,) = spark.read.parquet(paths.quarantine).collect()
        assert bad["validation_error"] == "invalid_event_type"
    # Bronze keeps what is sent again; only the new file is read.
    send(spark, inbox, [1, 5])
    sinks.run_topic(spark, sinks.file_stream(spark, inbox), paths)
    assert spark.read.parquet(paths.bronze).count() == 5


def test_failure_stops_both_queries(spark, tmp_path):
    inbox = str(tmp_path / "inbox")
    send(spark, inbox, [1])
    paths = sinks.StreamPaths(str(tmp_path), "events")
    os.makedirs(str(tmp_path / "bronze"))
    with open(paths.bronze, "w") as blocker:
        blocker.write("a file where the sink needs a folder")
    with pytest.raises(Exception):
        sinks.run_topic(spark, sinks.file_stream(spark, inbox), paths)
    assert spark.streams.active == []


def test_landing_stream_lands_once(spark, tmp_path):
    inbox, store = str(tmp_path / "inbox"), Warehouse(str(tmp_path / "warehouse"), 8)
    transform = sinks.TRANSFORMS["events"]
    for ids in ([1, 2, 2], [2, 3]):
        send(spark, inbox, ids)
        valid = transform(sinks.file_stream(spark, inbox, 1)).where("is_valid").drop("is_valid", "validation_error")
        sinks.start_landing(valid, "events", store, str(tmp_path / "checkpoint")).awaitTermination()
    assert sorted(row["client_id"] for row in store.read_landing(spark, "events").collect()) == [1, 2, 3]


def test_landing_stream_refuses_what_the_load_refuses(spark, tmp_path):
    inbox, store, rejects = str(tmp_path / "inbox"), Warehouse(str(tmp_path / "warehouse"), 8), str(tmp_path / "rejects")
    send(spark, inbox, [1, 2, 3])
    valid = sinks.TRANSFORMS["events"](sinks.file_stream(spark, inbox)).where("is_valid").drop("is_valid", "validation_error")
    # Record 2 breaks a rule; record 3 claims the source row of record 1 under its own id.
    damaged = valid.withColumns({
        "kafka_offset": F.when(F.col("client_id") == 2, -5).otherwise(F.col("kafka_offset")),
        "source_row_number": F.when(F.col("client_id") == 3, 1).otherwise(F.col("source_row_number"))})
    with pytest.raises(Exception, match="Landing rules broken"):
        sinks.start_landing(damaged, "events", store, str(tmp_path / "strict")).awaitTermination()
    assert store.read_landing(spark, "events").count() == 0
    sinks.start_landing(damaged, "events", store, str(tmp_path / "checkpoint"), rejects).awaitTermination()
    refused = {(r["client_id"], r["violations"]) for r in spark.read.parquet(rejects).collect()}
    assert refused == {(2, "kafka_offset_negative"), (1, "source_row_claimed"), (3, "source_row_claimed")}
    assert store.read_landing(spark, "events").count() == 0


def test_connector_options(monkeypatch):
    """The connector is not installed here: check what it would be asked for."""
    class Reader:
        def __init__(self):
            self.seen = {}

        def format(self, name):
            self.seen["format"] = name
            return self

        def option(self, key, value):
            self.seen[key] = value
            return self

        def options(self, **more):
            self.seen.update(more)
            return self

        def load(self):
            return self.seen

    class Session:
        read, readStream = Reader(), Reader()

    batch = kafka.kafka_batch(Session, "host:9092", "topic")
    assert batch["startingOffsets"] == "earliest" and batch["endingOffsets"] == "latest"
    assert batch["failOnDataLoss"] == "true" and batch["subscribe"] == "topic"
    stream = kafka.kafka_stream(Session, "host:9092", "topic", 500)
    assert stream["maxOffsetsPerTrigger"] == "500" and "endingOffsets" not in stream
    assert kafka.PRODUCER_OPTIONS["kafka.acks"] == "all"


def own_ids(rows):
    return rows.withColumn("event_id", record_id(F.col("source_file"), F.col("source_row_number")))


def test_repeats_within_the_retention_do_not_ask_the_landing(spark, tmp_path, monkeypatch):
    inbox, store = str(tmp_path / "inbox"), Warehouse(str(tmp_path / "warehouse"), 4)
    asked = []
    holders = LandingIndex.holders
    monkeypatch.setattr(LandingIndex, "holders", lambda *a: asked.append(holders(*a)) or asked[-1])
    for ids in ([1, 2, 2], [2, 3], [1, 2, 3]):
        send(spark, inbox, ids)
        valid = sinks.TRANSFORMS["events"](sinks.file_stream(spark, inbox)).where("is_valid").drop("is_valid", "validation_error")
        sinks.start_landing(own_ids(valid), "events", store, str(tmp_path / "checkpoint")).awaitTermination()
    assert sorted(row["client_id"] for row in store.read_landing(spark, "events").collect()) == [1, 2, 3]
    assert all(paths == [] for paths in asked)


def test_repeats_after_the_retention_are_found_in_the_landing(spark, tmp_path):
    inbox, store = str(tmp_path / "inbox"), Warehouse(str(tmp_path / "warehouse"), 4)
    for ids in ([1, 2], [3], [4], [1, 2, 5]):
        send(spark, inbox, ids)
        valid = sinks.TRANSFORMS["events"](sinks.file_stream(spark, inbox)).where("is_valid").drop("is_valid", "validation_error")
        sinks.start_landing(own_ids(valid), "events", store, str(tmp_path / "checkpoint"), retention="1 millisecond").awaitTermination()
    assert sorted(row["client_id"] for row in store.read_landing(spark, "events").collect()) == [1, 2, 3, 4, 5]


def test_a_batch_that_is_run_again_lands_nothing_twice(spark, tmp_path, monkeypatch):
    inbox, store = str(tmp_path / "inbox"), Warehouse(str(tmp_path / "warehouse"), 4)
    send(spark, inbox, [1, 2, 3])

    def start():
        valid = sinks.TRANSFORMS["events"](sinks.file_stream(spark, inbox)).where("is_valid").drop("is_valid", "validation_error")
        return sinks.start_landing(own_ids(valid), "events", store, str(tmp_path / "checkpoint"))

    def die(self, *rows):
        append(self, *rows)
        raise RuntimeError("killed after the rows were written")

    append = Warehouse.append_landing
    with monkeypatch.context() as patched:
        patched.setattr(Warehouse, "append_landing", die)
        with pytest.raises(Exception, match="killed"):
            start().awaitTermination()
    assert store.read_landing(spark, "events").count() == 3
    start().awaitTermination()
    assert sorted(row["client_id"] for row in store.read_landing(spark, "events").collect()) == [1, 2, 3]


def test_a_mended_record_follows_a_refused_one(spark, tmp_path):
    inbox, store, rejects = str(tmp_path / "inbox"), Warehouse(str(tmp_path / "warehouse"), 4), str(tmp_path / "rejects")
    for offset in (-1, 5):
        send(spark, inbox, [1])
        valid = sinks.TRANSFORMS["events"](sinks.file_stream(spark, inbox)).where("is_valid").drop("is_valid", "validation_error")
        rows = own_ids(valid).withColumn("kafka_offset", F.lit(offset).cast("bigint"))
        sinks.start_landing(rows, "events", store, str(tmp_path / "checkpoint"), rejects).awaitTermination()
    assert store.read_landing(spark, "events").count() == 1 and spark.read.parquet(rejects).count() == 1


def test_latest_products_as_a_stream(spark, tmp_path):
    inbox, table = str(tmp_path / "inbox"), str(tmp_path / "latest")
    for price, offsets in ((10, [0, 7]), (20, [3, 2]), (30, [9, 1])):
        rows = [("88231", changed(PRODUCT, "price_bucket", price)), ("5", changed({**PRODUCT, "sku": 5}, "price_bucket", price))]
        batch = records(spark, rows).withColumn("offset", F.when(F.col("key").cast("string") == "5", offsets[1]).otherwise(offsets[0]).cast("bigint"))
        batch.write.mode("append").parquet(inbox)
        valid = sinks.TRANSFORMS["products"](sinks.file_stream(spark, inbox, 1)).where("is_valid").drop("is_valid", "validation_error")
        sinks.start_latest(valid, table, str(tmp_path / "checkpoint")).awaitTermination()
    found = {r["message_key"]: (r["kafka_offset"], r["price_bucket"]) for r in sinks.read_latest(spark, table).collect()}
    assert found == {"88231": (9, 30), "5": (7, 10)}


def test_a_cap_bounds_each_batch_and_a_timed_trigger_runs(spark, tmp_path):
    inbox, paths = str(tmp_path / "inbox"), sinks.StreamPaths(str(tmp_path), "events")
    for ids in ([1], [2], [3]):
        send(spark, inbox, ids)
    stream = sinks.TRANSFORMS["events"](sinks.file_stream(spark, inbox, 1)).where("is_valid").drop("is_valid", "validation_error")
    query = sinks.start_sink(stream, "capped", paths.bronze, paths.checkpoint("bronze"))
    query.awaitTermination()
    files = len([p for p in os.listdir(inbox) if p.endswith(".parquet")])
    sizes = [p["numInputRows"] for p in query.recentProgress if p["numInputRows"]]
    assert sum(sizes) == 3 and len(query.recentProgress) >= files and max(sizes) == 1
    timed = sinks.start_sink(stream, "timed", paths.bronze, paths.checkpoint("bronze"), every="1 second")
    try:
        send(spark, inbox, [4])
        timed.processAllAvailable()
        assert spark.read.parquet(paths.bronze).count() == 4 and timed.isActive
    finally:
        timed.stop()
