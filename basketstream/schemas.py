"""Explicit schemas and column lists of every table the engine reads or writes."""

from pyspark.sql import types as T

_SOURCE = "struct<dataset:string,file:string,row_number:bigint>"
_PUBLISHED = "struct<run_id:string,published_at:string>"

EVENT_JSON = (
    "schema_version string, event_id string, event_type string, event_time string, "
    "event_time_timezone string, client_id bigint, "
    "payload struct<sku:bigint,url_id:bigint,query_vector_raw:string>, "
    f"source {_SOURCE}, replay {_PUBLISHED}, _corrupt_record string"
)

PRODUCT_JSON = (
    "schema_version string, record_id string, sku bigint, category_id bigint, "
    "price_bucket int, name_vector_raw string, "
    f"source {_SOURCE}, replay {_PUBLISHED}, _corrupt_record string"
)

# raw_record is an open object, so it stays a VARIANT instead of a fixed struct.
DLQ_JSON = (
    "schema_version string, dlq_id string, original_topic string, "
    f"source {_SOURCE}, replay struct<run_id:string,failed_at:string>, "
    "error struct<stage:string,type:string,message:string>, "
    "raw_record variant, _corrupt_record string"
)

# What the Kafka source delivers (without headers).
KAFKA_RECORD = T.StructType([
    T.StructField("key", T.BinaryType()),
    T.StructField("value", T.BinaryType()),
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("timestampType", T.IntegerType()),
])

_MESSAGE_COLUMNS = [
    ("message_key", "string"),
    ("raw_json", "string"),
    ("kafka_topic", "string"),
    ("kafka_partition", "int"),
    ("kafka_offset", "bigint"),
    ("kafka_timestamp", "timestamp"),
    ("kafka_timestamp_type", "int"),
    ("schema_version", "string"),
]
_LINEAGE_COLUMNS = [
    ("source_dataset", "string"),
    ("source_file", "string"),
    ("source_row_number", "bigint"),
    ("replay_run_id", "string"),
    ("published_at_raw", "string"),
    ("published_at_utc", "timestamp"),
    ("processed_at_utc", "timestamp"),
]

# Columns of valid records, per source.
BRONZE_COLUMNS = {
    "events": [
        *_MESSAGE_COLUMNS,
        ("event_id", "string"),
        ("event_type", "string"),
        ("event_time_raw", "string"),
        ("event_time_local", "timestamp_ntz"),
        ("event_time_timezone", "string"),
        ("client_id", "bigint"),
        ("sku", "bigint"),
        ("url_id", "bigint"),
        ("query_vector_raw", "string"),
        *_LINEAGE_COLUMNS,
    ],
    "products": [
        *_MESSAGE_COLUMNS,
        ("record_id", "string"),
        ("sku", "bigint"),
        ("category_id", "bigint"),
        ("price_bucket", "int"),
        ("name_vector_raw", "string"),
        *_LINEAGE_COLUMNS,
    ],
}
PRIMARY_KEY = {"events": "event_id", "products": "record_id"}

LANDING_COLUMNS = {
    source: [*columns, ("loaded_at_utc", "timestamp")]
    for source, columns in BRONZE_COLUMNS.items()
}

LEDGER_COLUMNS = [
    ("source_name", "string"),
    ("relative_path", "string"),
    ("file_size_bytes", "bigint"),
    ("file_sha256", "string"),
    ("row_count", "bigint"),
    ("inserted_count", "bigint"),
    ("completed_at_utc", "timestamp"),
    ("file_modified_at_utc", "timestamp"),
]


def ddl(columns):
    """Column list as a schema string for readers and createDataFrame."""
    return ", ".join(f"{name} {kind}" for name, kind in columns)


def names(columns):
    return [name for name, _ in columns]
