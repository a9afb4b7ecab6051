"""Versioned envelopes, dead letters and Kafka rows from raw records.

Every raw row yields exactly one outcome: an envelope, or an error text that says
why none can be built. Both are columns of the same row, so splitting good from
bad needs no second pass and no shuffle.
"""

from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F, types as T

from basketstream import fixed_values as fixed
from basketstream.functions import checks
from basketstream.functions.ids import dead_letter_id, record_id
from basketstream.functions.once import add_once
from basketstream.functions.times import utc_literal
from basketstream.operators.contract import add_built_errors
from basketstream.sources.tables import table_of

_KEEP_NULLS = {"ignoreNullFields": "false"}


def event_type_of(source_file: Column) -> Column:
    """Event type of a source file, by its table; null for an unknown table."""
    table = table_of(source_file)
    return F.when(table.isin(list(fixed.EVENT_FILES.values())), F.substring_index(table, ".parquet", 1))


def one_of_kind(event_type: Column, sku, page, search) -> Column:
    return (
        F.when(event_type.isin(fixed.SKU_EVENT_TYPES), sku)
        .when(event_type == "page_visit", page)
        .when(event_type == "search_query", search)
    )


def _payload_fields(event_type: Column) -> Column:
    """Every type's payload field; null but for that of the event's own type."""
    return F.struct(
        one_of_kind(event_type, F.col("sku"), None, None).alias("sku"),
        one_of_kind(event_type, None, F.col("url"), None).alias("url_id"),
        one_of_kind(event_type, None, None, F.col("query")).alias("query_vector_raw"),
    )


def payload(event_type: Column) -> Column:
    """The one-key payload of an event as VARIANT, so the other keys stay absent."""
    return F.parse_json(F.to_json(_payload_fields(event_type)))


def event_build_error() -> Column:
    """Why a raw event cannot be built (first reason), else null."""
    kind = event_type_of(F.col("source_file"))
    return F.coalesce(
        F.when(kind.isNull(), F.concat(F.lit(fixed.MSG_UNSUPPORTED_FILE), F.col("source_file"))),
        checks.integer_error(F.col("client_id"), "client_id"),
        checks.event_time_error(F.col("timestamp")),
        one_of_kind(
            kind,
            checks.integer_error(F.col("sku"), "sku"),
            checks.integer_error(F.col("url"), "url"),
            checks.vector_error(F.col("query"), "query", fixed.MSG_QUERY_VECTOR),
        ),
        F.when(F.col("source_row_number") < 0, F.lit("row_number" + fixed.MSG_NEGATIVE)),
    )


def product_build_error() -> Column:
    price = F.col("price")
    return F.coalesce(
        checks.vector_error(F.col("name"), "name", fixed.MSG_NAME_VECTOR),
        checks.integer_error(price, "price"),
        F.when(price > fixed.MAX_PRICE_BUCKET, F.lit(fixed.MSG_PRICE_RANGE)),
        F.when(F.col("source_row_number") < 0, F.lit("row_number" + fixed.MSG_NEGATIVE)),
        checks.integer_error(F.col("sku"), "sku"),
        checks.integer_error(F.col("category"), "category"),
    )


def _source() -> Column:
    return F.struct(
        F.lit(fixed.DATASET).alias("dataset"),
        F.col("source_file").alias("file"),
        F.col("source_row_number").alias("row_number"),
    )


def _replay(run_id: str, instant_text: Column, name: str) -> Column:
    return F.struct(F.lit(run_id.lower()).alias("run_id"), instant_text.alias(name))


def build_events(raw: DataFrame, run_id: str, published_at: datetime, fields: bool = False) -> DataFrame:
    """Raw event rows plus ``envelope`` (null when unbuildable) and ``build_error``.

    With ``fields``, the payload is a struct of all types' fields and no VARIANT:
    quicker, if the envelope is only judged and written as text (``event_text``).
    """
    kind = event_type_of(F.col("source_file"))
    envelope = F.struct(
        F.lit(fixed.SCHEMA_VERSION).alias("schema_version"),
        record_id(F.col("source_file"), F.col("source_row_number")).alias("event_id"),
        kind.alias("event_type"),
        F.col("timestamp").alias("event_time"),
        F.lit(None).cast("string").alias("event_time_timezone"),
        "client_id",
        (_payload_fields(kind) if fields else payload(kind)).alias("payload"),
        _source().alias("source"),
        _replay(run_id, utc_literal(published_at), "published_at").alias("replay"),
    )
    tried = add_once(raw, "build_error", event_build_error())
    return tried.withColumn("envelope", F.when(F.col("build_error").isNull(), envelope))


def build_products(raw: DataFrame, run_id: str, published_at: datetime) -> DataFrame:
    envelope = F.struct(
        F.lit(fixed.SCHEMA_VERSION).alias("schema_version"),
        record_id(F.col("source_file"), F.col("source_row_number")).alias("record_id"),
        "sku",
        F.col("category").alias("category_id"),
        F.col("price").alias("price_bucket"),
        F.col("name").alias("name_vector_raw"),
        _source().alias("source"),
        _replay(run_id, utc_literal(published_at), "published_at").alias("replay"),
    )
    tried = add_once(raw, "build_error", product_build_error())
    return tried.withColumn("envelope", F.when(F.col("build_error").isNull(), envelope))


def serialize(envelope: Column) -> Column:
    """Compact JSON; declared nulls are written, absent payload keys are not."""
    return F.to_json(envelope, _KEEP_NULLS)


def event_text(envelope: Column) -> Column:
    """``serialize`` for an event envelope whose payload is a struct of all types' fields."""
    content, kind = envelope["payload"], envelope["event_type"]
    one = lambda name: serialize(envelope.withField("payload", F.struct(content[name].alias(name))))
    # A null source file gives no type and no build error: its payload is empty.
    empty = serialize(envelope.withField("payload", F.parse_json(F.lit("{}"))))
    return F.coalesce(one_of_kind(kind, one("sku"), one("url_id"), one("query_vector_raw")), empty)


def plain_events(raw: DataFrame) -> bool:
    """Whether the payload columns have the contract's types: they are then written as they are."""
    types = {field.name: field.dataType for field in raw.schema}
    return all(isinstance(types[name], (T.ByteType, T.ShortType, T.IntegerType, T.LongType)) for name in ("sku", "url")) and (
        isinstance(types["query"], T.StringType))


def raw_record(products: bool = False) -> Column:
    """The raw row as a JSON object with the columns its file has, nulls included."""

    def as_json(*columns):
        return F.to_json(F.struct(*columns), _KEEP_NULLS)

    if products:
        return as_json("sku", "category", "price", "name")
    common = ["client_id", "timestamp"]
    kind = event_type_of(F.col("source_file"))
    typed = one_of_kind(kind, as_json(*common, "sku"), as_json(*common, "url"), as_json(*common, "query"))
    return F.coalesce(typed, as_json(*common, "sku", "url", "query"))


def _dead_letter(run_id: str, failed_at: datetime, topic: str, products: bool) -> Column:
    return F.struct(
        F.lit(fixed.SCHEMA_VERSION).alias("schema_version"),
        dead_letter_id(F.col("source_file"), F.col("source_row_number")).alias("dlq_id"),
        F.lit(topic).alias("original_topic"),
        _source().alias("source"),
        _replay(run_id, utc_literal(failed_at), "failed_at").alias("replay"),
        F.struct(
            F.col("error_stage").alias("stage"),
            F.col("error_type").alias("type"),
            F.col("error_message").alias("message"),
        ).alias("error"),
        F.parse_json(raw_record(products)).alias("raw_record"),
    )


def replay(raw: DataFrame, run_id: str, published_at: datetime, products: bool = False, validate: bool = True) -> DataFrame:
    """Outcome of every raw row: stage and error if any, destination, key and JSON value.

    Rows that cannot be built, or that the contract refuses, go to the dead-letter
    topic with the raw record; all others go to their own topic. Output columns:
    source_file, source_row_number, error_stage, error_type, error_message, topic,
    key, value.
    """
    plain = not products and plain_events(raw)
    contract = "product" if products else "event"
    topic = fixed.PRODUCT_TOPIC if products else fixed.EVENT_TOPIC
    key = F.col("envelope.sku" if products else "envelope.client_id")

    tried = build_products(raw, run_id, published_at) if products else build_events(raw, run_id, published_at, plain)
    text = event_text if plain else serialize
    built = add_once(tried.withColumn("_key", key.cast("string")), "_json", text(F.col("envelope")))
    unbuildable = F.col("build_error").isNotNull()
    if validate:
        built = add_built_errors(built, contract, "envelope", F.col("_json"), "_broken")
    else:
        built = built.withColumn("_broken", F.array().cast("array<string>"))
    refused = ~unbuildable & (F.size("_broken") > 0)
    judged = built.select(
        "*",
        F.when(unbuildable, fixed.STAGE_TRANSFORMATION).when(refused, fixed.STAGE_CONTRACT).alias("error_stage"),
        F.when(unbuildable, fixed.BUILD_ERROR_TYPE).when(refused, "ContractViolation").alias("error_type"),
        F.when(unbuildable, F.col("build_error")).when(refused, F.array_join("_broken", ",")).alias("error_message"),
    )
    failed = F.col("error_stage").isNotNull()
    letter = _dead_letter(run_id, published_at, topic, products)
    return judged.select(
        "source_file",
        "source_row_number",
        "error_stage",
        "error_type",
        "error_message",
        F.when(failed, fixed.DLQ_TOPIC).otherwise(topic).alias("topic"),
        F.when(failed, letter["dlq_id"]).otherwise(F.col("_key")).alias("key"),
        F.when(failed, F.to_json(letter, _KEEP_NULLS)).otherwise(F.col("_json")).alias("value"),
    )


def dead_letters(outcome: DataFrame) -> DataFrame:
    return outcome.where(F.col("error_stage").isNotNull())


def replay_summary(outcome: DataFrame) -> DataFrame:
    """Processed and dead-lettered rows per source file, by stage."""
    stage = F.col("error_stage")
    return outcome.groupBy("source_file").agg(
        F.count("*").alias("processed"),
        F.count_if(stage.isNotNull()).alias("dead_lettered"),
        F.count_if(stage == fixed.STAGE_TRANSFORMATION).alias("failed_transformation"),
        F.count_if(stage == fixed.STAGE_CONTRACT).alias("failed_contract"),
    )


def publish_rows(outcome: DataFrame) -> DataFrame:
    """Rows as the Kafka sink takes them: topic, binary key and value, headers."""
    headers = F.array(*[
        F.struct(F.lit(name).alias("key"), F.encode(F.lit(text), "UTF-8").alias("value"))
        for name, text in fixed.MESSAGE_HEADERS.items()
    ])
    return outcome.select(
        "topic",
        F.encode("key", "UTF-8").alias("key"),
        F.encode("value", "UTF-8").alias("value"),
        headers.alias("headers"),
    )


def preview(df: DataFrame, n: int) -> DataFrame:
    """First ``n`` records in row order, for a dry run that writes nothing."""
    return df.orderBy("source_file", "source_row_number").limit(n)
