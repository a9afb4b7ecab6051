"""Parsing, flattening and validating Kafka records, the same in batch and stream."""

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from basketstream import fixed_values as fixed
from basketstream import schemas
from basketstream.functions.checks import first_failure, null_or
from basketstream.functions.ids import is_uuid
from basketstream.functions.once import add_once
from basketstream.functions.times import published_time, source_time
from basketstream.operators.contract import add_contract_errors
from basketstream.sources.tables import table_of

_MESSAGE = ["message_key", "raw_json", "kafka_topic", "kafka_partition", "kafka_offset",
            "kafka_timestamp", "kafka_timestamp_type"]


def kafka_metadata(records: DataFrame) -> DataFrame:
    return records.select(
        F.col("key").cast("string").alias("message_key"),
        F.col("value").cast("string").alias("raw_json"),
        *[
            F.col(given).alias(ours)
            for given, ours in [
                ("topic", "kafka_topic"),
                ("partition", "kafka_partition"),
                ("offset", "kafka_offset"),
                ("timestamp", "kafka_timestamp"),
                ("timestampType", "kafka_timestamp_type"),
            ]
        ],
    )


def parse_json_text(records: DataFrame, schema: str) -> DataFrame:
    """Add ``doc``: the parsed record, with the text kept when it cannot be parsed."""
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}
    return add_once(records, "doc", F.from_json("raw_json", schema, options))


def _field(path: str) -> Column:
    return F.col(f"doc.{path}")


def _common_tail() -> list:
    """Source and replay rules that events and products share, files aside."""
    row, run = _field("source.row_number"), _field("replay.run_id")
    return [
        ("invalid_source_row_number", null_or(row, row < 0)),
        ("invalid_replay_run_id", null_or(run, ~is_uuid(run))),
        ("invalid_published_at", F.col("published_at_utc").isNull()),
    ]


def _not_equal(path: str, text: str) -> Column:
    return null_or(_field(path), _field(path) != text)


def event_rules() -> list:
    """Event rules as (code, failing condition), in order of precedence."""
    kind, client, key = _field("event_type"), _field("client_id"), F.col("message_key")
    file = _field("source.file")
    return [
        ("malformed_json", _field("_corrupt_record").isNotNull()),
        ("invalid_schema_version", _not_equal("schema_version", fixed.SCHEMA_VERSION)),
        ("invalid_event_id", null_or(_field("event_id"), ~is_uuid(_field("event_id")))),
        ("invalid_event_type", null_or(kind, ~kind.isin(fixed.EVENT_TYPES))),
        ("invalid_event_time", F.col("event_time_local").isNull()),
        ("unexpected_event_time_timezone", _field("event_time_timezone").isNotNull()),
        ("invalid_client_id", null_or(client, client < 0)),
        ("invalid_message_key", null_or(key, key != client.cast("string"))),
        ("missing_sku", kind.isin(fixed.SKU_EVENT_TYPES) & _field("payload.sku").isNull()),
        ("missing_url_id", (kind == "page_visit") & _field("payload.url_id").isNull()),
        ("missing_query_vector", (kind == "search_query") & _field("payload.query_vector_raw").isNull()),
        ("invalid_source_dataset", _not_equal("source.dataset", fixed.DATASET)),
        ("invalid_source_file", null_or(file, ~table_of(file).isin(list(fixed.EVENT_FILES.values())))),
        *_common_tail(),
    ]


def product_rules() -> list:
    sku, key, name = _field("sku"), F.col("message_key"), _field("name_vector_raw")
    category, price = _field("category_id"), _field("price_bucket")
    return [
        ("malformed_json", F.col("raw_json").isNull() | _field("_corrupt_record").isNotNull()),
        ("invalid_schema_version", _not_equal("schema_version", fixed.SCHEMA_VERSION)),
        ("invalid_record_id", null_or(_field("record_id"), ~is_uuid(_field("record_id")))),
        ("invalid_sku", null_or(sku, sku < 0)),
        ("invalid_message_key", null_or(key, key != sku.cast("string"))),
        ("invalid_category_id", null_or(category, category < 0)),
        ("invalid_price_bucket", null_or(price, ~price.between(0, fixed.MAX_PRICE_BUCKET))),
        ("invalid_name_vector", null_or(name, ~name.rlike(fixed.VECTOR_PATTERN))),
        ("invalid_source_dataset", _not_equal("source.dataset", fixed.DATASET)),
        ("invalid_source_file", null_or(_field("source.file"), table_of(_field("source.file")) != fixed.PRODUCT_FILE)),
        *_common_tail(),
    ]


def _lineage(instant: str) -> list:
    return [
        _field("source.dataset").alias("source_dataset"),
        _field("source.file").alias("source_file"),
        _field("source.row_number").alias("source_row_number"),
        _field("replay.run_id").alias("replay_run_id"),
        _field(f"replay.{instant}").alias(f"{instant}_raw"),
        f"{instant}_utc",
    ]


def _outcome(rules) -> list:
    code = first_failure(rules)
    return [code.alias("validation_error"), code.isNull().alias("is_valid"),
            F.current_timestamp().alias("processed_at_utc")]


def _published() -> dict:
    return {"published_at_utc": published_time(_field("replay.published_at"))}


def transform_events(records: DataFrame) -> DataFrame:
    """Kafka records -> one flat row each, with ``validation_error`` and ``is_valid``."""
    parsed = parse_json_text(kafka_metadata(records), schemas.EVENT_JSON).withColumns(
        {"event_time_local": source_time(_field("event_time")), **_published()}
    )
    return parsed.select(
        *_MESSAGE,
        *[_field(name).alias(name) for name in ("schema_version", "event_id", "event_type")],
        _field("event_time").alias("event_time_raw"),
        "event_time_local",
        *[_field(name).alias(name) for name in ("event_time_timezone", "client_id")],
        *[_field(f"payload.{name}").alias(name) for name in ("sku", "url_id", "query_vector_raw")],
        *_lineage("published_at"),
        *_outcome(event_rules()),
    )


def transform_products(records: DataFrame) -> DataFrame:
    parsed = parse_json_text(kafka_metadata(records), schemas.PRODUCT_JSON).withColumns(_published())
    own = ("schema_version", "record_id", "sku", "category_id", "price_bucket", "name_vector_raw")
    return parsed.select(
        *_MESSAGE,
        *[_field(name).alias(name) for name in own],
        *_lineage("published_at"),
        *_outcome(product_rules()),
    )


def transform_dlq(records: DataFrame) -> DataFrame:
    """Dead letters flattened for landing, with their contract violations."""
    judged = add_contract_errors(kafka_metadata(records), "dlq", F.col("raw_json"), "contract_errors")
    parsed = parse_json_text(judged, schemas.DLQ_JSON).withColumn(
        "failed_at_utc", published_time(_field("replay.failed_at"))
    )
    return parsed.select(
        *_MESSAGE,
        *[_field(name).alias(name) for name in ("schema_version", "dlq_id", "original_topic")],
        *_lineage("failed_at"),
        *[_field(f"error.{name}").alias(f"error_{name}") for name in ("stage", "type", "message")],
        F.to_json(_field("raw_record")).alias("raw_record"),
        "contract_errors",
    )


def split_valid(transformed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Bronze rows (both flag columns dropped) and quarantine rows (reason kept)."""
    valid = transformed.where("is_valid").drop("is_valid", "validation_error")
    invalid = transformed.where("not is_valid").drop("is_valid")
    return valid, invalid


def latest_products(products: DataFrame) -> DataFrame:
    """Last record per message key, as a compacted topic keeps it.

    The rank filter is also applied before the shuffle, so a key with very many
    versions sends at most one of them per map task.
    """
    newest = W.partitionBy("message_key").orderBy(F.desc("kafka_offset"), F.desc("kafka_partition"))
    ranked = products.withColumn("_rank", F.row_number().over(newest))
    return ranked.where(F.col("_rank") == 1).drop("_rank")


def sample_records(df: DataFrame, n: int) -> DataFrame:
    """First ``n`` records by partition and offset."""
    return df.orderBy("kafka_partition", "kafka_offset").limit(n)


def validation_summary(transformed: DataFrame) -> DataFrame:
    """Records per validation outcome; valid records appear as ``valid``."""
    outcome = F.coalesce("validation_error", F.lit("valid"))
    return transformed.groupBy(outcome.alias("outcome")).agg(F.count("*").alias("records"))
