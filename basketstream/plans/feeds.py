"""Feeds with defects, derived from the given tables.

The given events are clean, so the reject paths would never run. Here every row
stays, and the value ``k`` of its ``props`` (or the part's size) decides whether
and how it is damaged; the expected outcome of every row is therefore known.
"""

from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from basketstream import fixed_values as fixed
from basketstream.functions.once import add_once, isolate
from basketstream.operators.envelope import build_events, build_products, event_text, serialize
from basketstream.sources.driver_tables import PUBLISHED_AT, RUN_ID, raw_events, raw_products

PUBLISHED = datetime(2031, 3, 5, 6, 7, 8, tzinfo=timezone.utc)
WRONG_KEY = "999999999"
BAD_TIME = "2022-02-30 12:00:00"


def _damage(key, column, changes: dict):
    """``column`` with the change that the row's ``key`` calls for."""
    whens = [F.when(key == value, change) for value, change in changes.items()]
    chained = reduce(lambda acc, item: acc.when(key == item[0], item[1]), list(changes.items())[1:], whens[0])
    return chained.otherwise(column)


def damaged_raw_events(spark, sf_dir) -> DataFrame:
    """Raw events of which some cannot be built (k 0-7, 9) or break the contract (8)."""
    raw = raw_events(spark, sf_dir)
    k, stamp = F.col("k"), F.col("timestamp")
    with_t = F.concat(F.substring(stamp, 1, 10), F.lit("T"), F.substring(stamp, 12, 8))
    month_13 = F.concat(F.substring(stamp, 1, 5), F.lit("13"), F.substring(stamp, 8, 12))
    bare = F.regexp_replace("query", r"[\[\]]", "")
    two_lines = F.replace("query", F.lit(" "), F.lit("\n"))
    nothing = F.lit(None)
    damaged = raw.withColumns({
        "source_file": _damage(k, F.col("source_file"), {7: F.lit("unknown.parquet")}),
        "client_id": _damage(k, F.col("client_id"), {0: nothing, 1: -1 - F.col("client_id"), 9: nothing}),
        "timestamp": _damage(k, stamp, {2: nothing, 3: with_t, 4: month_13, 9: with_t}),
        "sku": _damage(k, F.col("sku"), {5: nothing, 6: -1 - F.col("sku")}),
        "url": _damage(k, F.col("url"), {5: nothing, 6: -1 - F.col("url")}),
        "query": _damage(k, F.col("query"), {5: nothing, 6: bare, 8: two_lines}),
    })
    return isolate(damaged)


def damaged_raw_products(spark, sf_dir) -> DataFrame:
    """Raw products with one defect per price value 1-8."""
    raw = raw_products(spark, sf_dir)
    price, nothing = F.col("price"), F.lit(None)
    damaged = raw.withColumn("_price", price).withColumns({
        "name": _damage(F.col("_price"), F.col("name"), {1: nothing, 2: F.lit("1 2 3"), 8: F.lit("[1\n2]")}),
        "price": _damage(F.col("_price"), price, {3: nothing, 4: -price, 5: price + 95}),
        "sku": _damage(F.col("_price"), F.col("sku"), {6: nothing}),
        "category": _damage(F.col("_price"), F.col("category"), {7: -1 - F.col("category")}),
    }).drop("_price")
    return isolate(damaged)


def _swap(value, old: str, new: str):
    return F.replace(value, F.lit(old), F.lit(new))


def _kafka_shape(df: DataFrame, topic, partition_of, partitions, key, value, offset) -> DataFrame:
    return add_once(df, "value", F.encode(value, "UTF-8")).select(
        F.encode(key, "UTF-8").alias("key"),
        "value",
        F.lit(topic).alias("topic"),
        F.pmod(partition_of, F.lit(partitions)).cast("int").alias("partition"),
        offset.alias("offset"),
        F.lit(PUBLISHED_AT).cast("timestamp").alias("timestamp"),
        F.lit(0).alias("timestampType"),
        "source_row_number",
    )


def _envelope_text(built: DataFrame, text=serialize) -> DataFrame:
    return add_once(built, "_value", text(F.col("envelope")))


def kafka_events(spark, sf_dir, damaged: bool = False) -> DataFrame:
    """Event envelopes as Kafka records; ``damaged`` breaks those with k 0-21."""
    built = _envelope_text(build_events(raw_events(spark, sf_dir), RUN_ID, PUBLISHED, fields=True), event_text)
    value, key = F.col("_value"), F.col("client_id").cast("string")
    if damaged:
        client = F.concat(F.lit('"client_id":'), F.col("client_id").cast("string"))
        payload = F.regexp_replace(value, r'"payload":\{[^}]*\}', '"payload":{}')
        stamp = F.concat(F.lit('"event_time":"'), F.col("timestamp"), F.lit('"'))
        bad_time = F.replace(value, stamp, F.lit(f'"event_time":"{BAD_TIME}"'))
        published = f'"published_at":"{PUBLISHED_AT}"'
        negative = F.regexp_replace(value, r'"sku":([0-9]+)', r'"sku":-1$1')
        value = _damage(F.col("k"), value, {
            0: F.lit("{"),
            1: _swap(value, '"schema_version":"1.0.0"', '"schema_version":"2.0.0"'),
            2: F.regexp_replace(value, '"event_id":"[^"]*"', '"event_id":"123-abc"'),
            3: F.regexp_replace(value, '"event_type":"[^"]*"', '"event_type":"wishlist"'),
            4: bad_time,
            5: _swap(value, '"event_time_timezone":null', '"event_time_timezone":"UTC"'),
            6: F.replace(value, client, F.lit('"client_id":-5')),
            8: payload,
            9: _swap(value, f'"dataset":"{fixed.DATASET}"', '"dataset":"other"'),
            10: F.regexp_replace(value, '"file":"[^"]*"', '"file":"other.parquet"'),
            11: F.regexp_replace(value, '"row_number":[0-9]+', '"row_number":-1'),
            12: _swap(value, f'"run_id":"{RUN_ID}"', '"run_id":"x"'),
            13: _swap(value, published, '"published_at":"2031-03-05 06:07:08"'),
            14: F.lit(None),
            15: F.lit(""),
            16: bad_time,
            17: _swap(value, '{"schema_version"', '{"colour":"red","schema_version"'),
            18: negative,
            19: _swap(value, published, '"published_at":"2031-03-05T06:07:08+08:00"'),
            20: F.replace(value, client, F.lit('"client_id":"12"')),
            21: F.concat(F.lit("["), value, F.lit("]")),
        })
        key = _damage(F.col("k"), key, {6: F.lit("-5"), 7: F.lit(WRONG_KEY), 16: F.lit(WRONG_KEY)})
    return _kafka_shape(built, fixed.EVENT_TOPIC, F.col("client_id"), 6, key, value, F.col("source_row_number"))


def kafka_products(spark, sf_dir, damaged: bool = False) -> DataFrame:
    """Product envelopes as Kafka records; ``damaged`` breaks those with price 1-16."""
    built = _envelope_text(build_products(raw_products(spark, sf_dir), RUN_ID, PUBLISHED))
    value, key = F.col("_value"), F.col("sku").cast("string")
    if damaged:
        sku = F.concat(F.lit('"sku":'), F.col("sku").cast("string"))
        value = _damage(F.col("price"), value, {
            1: F.lit("{invalid-json"),
            2: _swap(value, '"schema_version":"1.0.0"', '"schema_version":"2.0.0"'),
            3: F.regexp_replace(value, '"record_id":"[^"]*"', '"record_id":"123-abc"'),
            4: F.replace(value, sku, F.lit('"sku":-5')),
            6: F.regexp_replace(value, '"category_id":[0-9]+', '"category_id":null'),
            7: F.regexp_replace(value, '"price_bucket":[0-9]+', '"price_bucket":100'),
            8: F.regexp_replace(value, '"name_vector_raw":"[^"]*"', '"name_vector_raw":"no brackets"'),
            9: _swap(value, f'"dataset":"{fixed.DATASET}"', '"dataset":"other"'),
            10: _swap(value, fixed.PRODUCT_FILE, "other.parquet"),
            11: F.regexp_replace(value, '"row_number":[0-9]+', '"row_number":-1'),
            12: _swap(value, f'"run_id":"{RUN_ID}"', '"run_id":"x"'),
            13: _swap(value, PUBLISHED_AT, "2031-03-05"),
            14: F.lit(None),
            15: F.lit(""),
            16: _swap(value, '{"schema_version"', '{"currency":"EUR","schema_version"'),
        })
        key = _damage(F.col("price"), key, {4: F.lit("-5"), 5: F.lit(WRONG_KEY)})
    return _kafka_shape(built, fixed.PRODUCT_TOPIC, F.col("sku"), 3, key, value, F.col("source_row_number"))


def redelivered(df: DataFrame, again, offset_column: str, shift: int) -> DataFrame:
    """All rows, plus those that ``again`` selects a second time at later offsets."""
    repeat = df.where(again).withColumn(offset_column, F.col(offset_column) + shift)
    return df.unionByName(repeat)
