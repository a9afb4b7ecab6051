"""Kafka reads and writes. Needs the Kafka connector on the cluster's classpath."""

from pyspark.sql import DataFrame


def _reader(reader, servers: str, topic: str, options: dict):
    configured = reader.format("kafka").option("kafka.bootstrap.servers", servers)
    return configured.option("subscribe", topic).options(**options)


def kafka_batch(spark, servers: str, topic: str, headers: bool = False) -> DataFrame:
    """Everything in the topic now, earliest to latest; lost offsets fail the read."""
    options = {
        "startingOffsets": "earliest",
        "endingOffsets": "latest",
        "failOnDataLoss": "true",
        "includeHeaders": str(headers).lower(),
    }
    records = _reader(spark.read, servers, topic, options).load()
    return with_text(records) if headers else records


def with_text(records: DataFrame) -> DataFrame:
    """Key and value as text, next to topic, position and headers."""
    return records.selectExpr(
        "cast(key as string) as key", "cast(value as string) as value",
        "topic", "partition", "offset", "timestamp", "headers",
    )


def kafka_stream(spark, servers: str, topic: str, max_offsets_per_trigger: int | None = None) -> DataFrame:
    """The topic as a stream. Without a limit a drain takes all there is in a few large batches."""
    options = {"startingOffsets": "earliest", "failOnDataLoss": "true"}
    if max_offsets_per_trigger:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    return _reader(spark.readStream, servers, topic, options).load()


PRODUCER_OPTIONS = {
    "kafka.acks": "all",
    "kafka.enable.idempotence": "true",
    "kafka.compression.type": "zstd",
    "kafka.linger.ms": "20",
}


def publish(rows: DataFrame, servers: str) -> None:
    """Write (topic, key, value, headers) rows; each row names its own topic."""
    writer = rows.write.format("kafka").option("kafka.bootstrap.servers", servers)
    writer.options(**PRODUCER_OPTIONS).option("includeHeaders", "true").save()
