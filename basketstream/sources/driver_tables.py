"""The given test tables seen as raw behavioural files, products and landing rows.

Every derived column is a plain expression, so column pruning and the filters on
``ts`` and ``event_type`` still reach the Parquet scan.
"""

import os

from pyspark.sql import DataFrame, functions as F

from basketstream import fixed_values as fixed
from basketstream.functions.ids import record_id
from basketstream.functions.times import day_bounds

RUN_ID = "5b0c3f52-8e1d-4f7a-b6a4-0d9e27c1f883"
PUBLISHED_AT = "2031-03-05T06:07:08Z"

# Event type of the given table -> behavioural event type.
TYPE_MAP = {
    "view": "page_visit",
    "click": "add_to_cart",
    "purchase": "product_buy",
    "error": "remove_from_cart",
    "signup": "search_query",
}
# Return flag of a line item -> behavioural event type.
FLAG_MAP = {"A": "add_to_cart", "N": "product_buy", "R": "remove_from_cart"}


def table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def lookup(column, mapping: dict):
    """Constant lookup as a CASE, which the optimizer can fold into filters."""
    result = None
    for key, value in mapping.items():
        condition = column == key
        result = F.when(condition, value) if result is None else result.when(condition, value)
    return result


def _events_table(spark, sf_dir, types=None, first_day=None, last_day=None) -> DataFrame:
    events = table(spark, sf_dir, "events")
    if types is not None:
        wanted = [given for given, ours in TYPE_MAP.items() if ours in types]
        events = events.where(F.col("event_type").isin(wanted))
    if first_day is not None:
        lower, upper = day_bounds(first_day)[0], day_bounds(last_day or first_day)[1]
        bounds = [F.lit(text).cast("timestamp_ntz") for text in (lower, upper)]
        events = events.where((F.col("ts") >= bounds[0]) & (F.col("ts") < bounds[1]))
    return events


def typed_events(spark, sf_dir, types=None, first_day=None, last_day=None) -> DataFrame:
    """Events with parsed values: type, client, sku / url / query, event time."""
    events = _events_table(spark, sf_dir, types, first_day, last_day)
    kind = lookup(F.col("event_type"), TYPE_MAP)
    k = F.get_json_object("props", "$.k").cast("bigint")
    is_sku = kind.isin(fixed.SKU_EVENT_TYPES)
    vector = F.concat(F.lit("["), k.cast("string"), F.lit(" "), (k + 1).cast("string"), F.lit("]"))
    return events.select(
        kind.alias("event_type"),
        F.concat(kind, F.lit(".parquet")).alias("source_file"),
        F.col("event_id").alias("source_row_number"),
        F.col("user_id").alias("client_id"),
        F.date_trunc("second", "ts").cast("timestamp_ntz").alias("event_time"),
        F.when(is_sku, k).alias("sku"),
        F.when(kind == "page_visit", k).alias("url"),
        F.when(kind == "search_query", vector).alias("query"),
        k.alias("k"),
    )


def raw_events(spark, sf_dir, types=None, first_day=None, last_day=None) -> DataFrame:
    """Events as the raw files hold them: time is text in the source's own clock."""
    events = typed_events(spark, sf_dir, types, first_day, last_day)
    stamp = F.date_format("event_time", fixed.SOURCE_TIME_FORMAT)
    return events.withColumn("timestamp", stamp).drop("event_time")


def raw_tables(spark, sf_dir) -> dict[str, DataFrame]:
    """One table per event type, each with only that type's columns."""
    value_column = {"page_visit": "url", "search_query": "query"}
    return {
        kind: raw_events(spark, sf_dir, [kind]).select(
            "source_file", "source_row_number", "client_id", "timestamp",
            value_column.get(kind, "sku"),
        )
        for kind in fixed.EVENT_TYPES
    }


def raw_products(spark, sf_dir) -> DataFrame:
    part = table(spark, sf_dir, "part")
    size = F.length("p_name").cast("string")
    return part.select(
        F.lit(fixed.PRODUCT_FILE).alias("source_file"),
        F.col("p_partkey").alias("source_row_number"),
        F.col("p_partkey").alias("sku"),
        F.regexp_extract("p_brand", "([0-9]+)", 1).cast("bigint").alias("category"),
        F.col("p_size").cast("int").alias("price"),
        F.concat(F.lit("["), size, F.lit("]")).alias("name"),
    )


def order_events(spark, sf_dir) -> DataFrame:
    """Orders and line items as a second, larger source of client-product events."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_returnflag"
    )
    joined = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return joined.select(
        lookup(F.col("l_returnflag"), FLAG_MAP).alias("event_type"),
        F.col("o_custkey").alias("client_id"),
        F.col("l_partkey").alias("sku"),
        (F.col("o_orderdate") + F.make_dt_interval(hours=F.col("l_linenumber"))).alias("event_time"),
    )


def _message_columns(topic, key, partitions):
    return [
        key.cast("string").alias("message_key"),
        F.lit(topic).alias("kafka_topic"),
        F.pmod(key, F.lit(partitions)).cast("int").alias("kafka_partition"),
        F.col("source_row_number").alias("kafka_offset"),
        F.lit(fixed.SCHEMA_VERSION).alias("schema_version"),
    ]


def _lineage_columns():
    instant = F.lit(PUBLISHED_AT).cast("timestamp")
    return [
        F.lit(fixed.DATASET).alias("source_dataset"),
        "source_file",
        "source_row_number",
        F.lit(RUN_ID).alias("replay_run_id"),
        F.lit(PUBLISHED_AT).alias("published_at_raw"),
        instant.alias("published_at_utc"),
        instant.alias("processed_at_utc"),
        instant.alias("loaded_at_utc"),
    ]


def landing_events(spark, sf_dir, types=None, first_day=None, last_day=None) -> DataFrame:
    """Landing rows of the events, as they are after a clean load."""
    events = typed_events(spark, sf_dir, types, first_day, last_day)
    instant = F.lit(PUBLISHED_AT).cast("timestamp")
    return events.select(
        *_message_columns(fixed.EVENT_TOPIC, F.col("client_id"), 6),
        F.lit("{}").alias("raw_json"),
        instant.alias("kafka_timestamp"),
        F.lit(0).alias("kafka_timestamp_type"),
        record_id(F.col("source_file"), F.col("source_row_number")).alias("event_id"),
        "event_type",
        F.date_format("event_time", fixed.SOURCE_TIME_FORMAT).alias("event_time_raw"),
        F.col("event_time").alias("event_time_local"),
        F.lit(None).cast("string").alias("event_time_timezone"),
        "client_id",
        "sku",
        F.col("url").alias("url_id"),
        F.col("query").alias("query_vector_raw"),
        *_lineage_columns(),
    )


def landing_products(spark, sf_dir) -> DataFrame:
    instant = F.lit(PUBLISHED_AT).cast("timestamp")
    return raw_products(spark, sf_dir).select(
        *_message_columns(fixed.PRODUCT_TOPIC, F.col("sku"), 3),
        F.lit("{}").alias("raw_json"),
        instant.alias("kafka_timestamp"),
        F.lit(0).alias("kafka_timestamp_type"),
        record_id(F.col("source_file"), F.col("source_row_number")).alias("record_id"),
        "sku",
        F.col("category").alias("category_id"),
        F.col("price").alias("price_bucket"),
        F.col("name").alias("name_vector_raw"),
        *_lineage_columns(),
    )
