"""Streaming queries: one bronze and one quarantine query per topic."""

import hashlib
import os
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from basketstream.functions.checks import all_failures
from basketstream.functions.ids import record_id
from basketstream.operators.landing import insert_absent, landing_rules, normalize_bronze
from basketstream.operators.membership import Landed, only_files
from basketstream.operators.parse import latest_products, split_valid, transform_events, transform_products
from basketstream.operators.quality import SOURCE_ROW, QualityError, new_source_row_conflicts
from basketstream.schemas import KAFKA_RECORD, PRIMARY_KEY
from basketstream.session import cut_lineage

TRANSFORMS = {"events": transform_events, "products": transform_products}
# Rolls bronze files; at this count even rows of 20 KB stay below the 2 GB that the file inventory can hash.
MAX_RECORDS_PER_FILE = 100_000
POLL_SECONDS = 1
# Column with the time of the micro-batch that a record arrived with.
ARRIVED = "_arrived"


@dataclass
class StreamPaths:
    """Where one topic's queries write; each query has its own checkpoint."""

    root: str
    source: str

    @property
    def bronze(self):
        return os.path.join(self.root, "bronze", self.source)

    @property
    def quarantine(self):
        return os.path.join(self.root, "quarantine", self.source)

    def checkpoint(self, leg):
        return os.path.join(self.root, "checkpoints", self.source, leg)


def file_stream(spark, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Kafka-shaped Parquet files as a stream, for replays and tests without a broker."""
    reader = spark.readStream.schema(KAFKA_RECORD)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.parquet(path)


def start_sink(df: DataFrame, name: str, path: str, checkpoint: str, every: str | None = None):
    """Append ``df`` as Parquet. Without ``every``: drain what is there, then stop."""
    writer = (
        df.writeStream.format("parquet").outputMode("append").queryName(name)
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .option("maxRecordsPerFile", str(MAX_RECORDS_PER_FILE))
    )
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return writer.trigger(**trigger).start()


def start_topic(records: DataFrame, paths: StreamPaths, every: str | None = None) -> list:
    """Start both queries of a topic. They share nothing: each keeps its own offsets."""
    valid, invalid = split_valid(TRANSFORMS[paths.source](records))
    legs = {"bronze": (valid, paths.bronze), "quarantine": (invalid, paths.quarantine)}
    return [
        start_sink(df, f"{paths.source}_{leg}", path, paths.checkpoint(leg), every)
        for leg, (df, path) in legs.items()
    ]


def run_topic(spark, records: DataFrame, paths: StreamPaths, every: str | None = None) -> None:
    """Run until drained, or (with ``every``) until a query ends; a failure stops both."""
    queries = start_topic(records, paths, every)
    try:
        # Only this topic's queries are looked at, in turn, so that either one's failure is seen at once.
        running = list(queries)
        while running:
            ended = [query for query in running if query.awaitTermination(POLL_SECONDS)]
            if ended and every:
                break
            running = [query for query in running if query not in ended]
    finally:
        for query in queries:
            if query.isActive:
                query.stop()


def drop_repeated(records: DataFrame, key: str, retention: str) -> DataFrame:
    """Stream without records whose id and source row came before, for ``retention`` or longer after they first came.

    A record's time is that of the micro-batch it arrives with, which the checkpoint
    keeps, so no record is ever late and none is dropped for its age.
    """
    stamped = records.withColumn(ARRIVED, F.current_timestamp()).withWatermark(ARRIVED, retention)
    return stamped.dropDuplicatesWithinWatermark([key, *SOURCE_ROW])


def start_landing(bronze: DataFrame, source: str, warehouse, checkpoint: str, rejects: str | None = None, every: str | None = None,
                  retention: str = "1 day"):
    """Insert-if-absent into the warehouse's landing, batch by batch, under the rules of the batch load.

    Records that come again within ``retention`` are dropped by keyed state. The
    others are looked up in the landing, of which only the files are opened that may
    hold their ids; files that this stream landed within the retention are not
    among them, for what they hold is still in the state. A batch that is run again
    after a failure looks into what it landed before. Records that break a landing rule
    do not enter the state, so a mended one may follow. They, and records whose source
    row another id claims, are appended to ``rejects`` with their codes; without that
    folder they end the stream with an error.
    """
    key = PRIMARY_KEY[source]
    order = ["kafka_partition", "kafka_offset"]
    writer = hashlib.sha256(checkpoint.encode()).hexdigest()
    rows = normalize_bronze(bronze, source).withColumn("loaded_at_utc", F.current_timestamp())
    judged = rows.withColumn("violations", F.array_join(all_failures(landing_rules(source)), ","))
    sound = drop_repeated(judged.where("violations = ''"), key, retention)
    broken = judged.where("violations <> ''").withColumn(ARRIVED, F.lit(None).cast("timestamp"))

    def land(batch, batch_id):
        spark = batch.sparkSession
        strange = ~F.col(key).eqNullSafe(record_id(F.col("source_file"), F.col("source_row_number")))
        batch = cut_lineage(spark, batch, "stream-batch")
        counted = batch.agg(F.max(ARRIVED).alias("arrived"), F.count_if(strange).alias("foreign"), F.max("violations").alias("violations")).first()
        index, new = warehouse.index(source), batch.where("violations = ''")
        index.refresh(spark)
        since = F.lit(counted["arrived"]) - F.expr(f"INTERVAL {retention}")
        paths = index.holders(spark, new, Landed(writer, batch_id, since)) if counted["arrived"] else []
        landed = only_files(warehouse.read_landing(spark, source), paths)
        first = insert_absent(landed, new, key, order).drop(ARRIVED)
        fresh = first if paths == [] else cut_lineage(spark, first, "stream-fresh")
        claimed = new_source_row_conflicts(landed, fresh, key, index.foreign(spark)).distinct()
        # Ids that all follow from their source rows cannot clash in a landing whose ids do.
        some = counted["foreign"] > 0 or not index.foreign(spark).isEmpty()
        clashing = fresh.join(claimed, SOURCE_ROW, "left_semi").withColumn("violations", F.lit("source_row_claimed"))
        bad = batch.where("violations <> ''").drop(ARRIVED)
        bad = cut_lineage(spark, bad.unionByName(clashing), "stream-rejects") if some else bad
        if counted["violations"] or some and not bad.isEmpty():
            if rejects is None:
                raise QualityError(f"Landing rules broken: {bad.first()['violations']}")
            # Named by batch: a batch that is run again replaces its own rejects.
            bad.write.mode("overwrite").parquet(os.path.join(rejects, f"batch_id={batch_id}"))
            if some:
                fresh = fresh.join(bad.select(*order, "kafka_topic").distinct(), ["kafka_topic", *order], "left_anti")
        warehouse.append_landing(fresh, source)
        index.refresh(spark, writer, batch_id, foreign=counted["foreign"] > 0)

    query = sound.unionByName(broken).writeStream.foreachBatch(land).option("checkpointLocation", checkpoint)
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return query.queryName(f"{source}_landing").trigger(**trigger).start()


def start_latest(products: DataFrame, path: str, checkpoint: str, every: str | None = None):
    """Keeps the last record per message key, as a compacted topic does, in a table of changes below ``path``.

    Keyed state holds each key's last record; a micro-batch writes the keys that it
    changed into a folder of its own number, so that a batch run again replaces its own.
    """
    newest = F.struct("kafka_offset", "kafka_partition")
    last = products.groupBy("message_key").agg(F.max_by(F.struct(*products.columns), newest).alias("last"))

    def write(batch, batch_id):
        batch.select("last.*").write.mode("overwrite").parquet(os.path.join(path, f"batch_id={batch_id}"))

    query = last.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint)
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return query.queryName("products_latest").trigger(**trigger).start()


def read_latest(spark, path: str) -> DataFrame:
    """The last record per message key of ``start_latest``: that of the key's last change."""
    return latest_products(spark.read.option("basePath", path).parquet(path).drop("batch_id"))
