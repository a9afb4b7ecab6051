"""Landing: type normalisation, row rules, insert-if-absent, and the file ledger."""

from pyspark.sql import DataFrame, Window as W, functions as F, types as T

from basketstream import fixed_values as fixed
from basketstream.functions.checks import all_failures, null_or
from basketstream.functions.ids import is_uuid
from basketstream.operators.quality import QualityError, new_source_row_conflicts
from basketstream.schemas import BRONZE_COLUMNS, LANDING_COLUMNS, PRIMARY_KEY, names

_UUID_COLUMNS = {"event_id", "record_id", "replay_run_id"}
_UTC_COLUMNS = {"kafka_timestamp", "published_at_utc", "processed_at_utc"}


def normalize_bronze(df: DataFrame, source: str, keep: list[str] | None = None) -> DataFrame:
    """Bronze columns in landing types: canonical ids, UTC instants, zone-free event time.

    An id that is not a UUID fails the job; nulls pass (the row rules judge them).
    ``keep`` names further columns to carry along.
    """
    types = {field.name: field.dataType for field in df.schema}
    out = []
    for name, kind in BRONZE_COLUMNS[source]:
        column = F.col(name)
        if name in _UUID_COLUMNS:
            bad = column.isNotNull() & ~is_uuid(column)
            column = F.when(bad, F.raise_error(F.concat(F.lit(f"{name} is not a UUID: "), column)))
            column = column.otherwise(F.lower(name))
        elif name in _UTC_COLUMNS:
            if not isinstance(types[name], (T.TimestampType, T.TimestampNTZType)):
                raise TypeError(f"{name} must be a timestamp")
            # A zone-free value is taken as UTC, which is the session zone.
            column = column.cast("timestamp")
        elif name == "event_time_local":
            if not isinstance(types[name], T.TimestampNTZType):
                raise TypeError("event_time_local must be a zone-free timestamp")
        else:
            column = column.cast(kind)
        out.append(column.alias(name))
    return df.select(*out, *(keep or []))


def _required(name):
    return f"{name}_missing", F.col(name).isNull()


def _minimum_zero(name):
    return f"{name}_negative", F.col(name) < 0


def landing_rules(source: str) -> list:
    """Row rules of a landing table as (code, failing condition)."""
    optional = {"kafka_timestamp", "kafka_timestamp_type", "event_time_timezone", "url_id",
                "query_vector_raw", "loaded_at_utc"}
    if source == "events":
        optional.add("sku")
    rules = [_required(name) for name in names(LANDING_COLUMNS[source]) if name not in optional]
    rules.append(("schema_version_wrong", F.col("schema_version") != fixed.SCHEMA_VERSION))
    whole = ["kafka_partition", "kafka_offset", "source_row_number"]
    if source == "events":
        rules.append(("event_type_unknown", ~F.col("event_type").isin(fixed.EVENT_TYPES)))
        whole.append("client_id")
    else:
        rules.append(("price_bucket_out_of_range", ~F.col("price_bucket").between(0, fixed.MAX_PRICE_BUCKET)))
        whole += ["sku", "category_id"]
    return rules + [_minimum_zero(name) for name in whole]


def landing_violations(df: DataFrame, source: str) -> DataFrame:
    """Rows that break a rule, with the codes of all rules they break."""
    judged = df.withColumn("violations", all_failures(landing_rules(source)))
    return judged.where(F.size("violations") > 0)


def first_per_key(batch: DataFrame, key: str, order: list) -> DataFrame:
    """First row of every key in ``order``.

    The optimizer also applies the rank filter below the shuffle, so each map
    task sends at most one row per key however many copies it holds.
    """
    ranked = batch.withColumn("_rank", F.row_number().over(W.partitionBy(key).orderBy(*order)))
    return ranked.where(F.col("_rank") == 1).drop("_rank")


def insert_absent(target: DataFrame, batch: DataFrame, key: str, order: list) -> DataFrame:
    """Rows of ``batch`` to append: first of each key that ``target`` does not have.

    Only the key column of the target is read. Keys are hash ids, hence spread
    evenly, and each occurs once on either side of the anti join.
    """
    return first_per_key(batch, key, order).join(target.select(key), key, "left_anti")


def insert_counts(target: DataFrame, batch: DataFrame, key: str) -> DataFrame:
    """Rows processed, inserted and already present, without choosing the rows."""
    per_key = batch.groupBy(key).agg(F.count("*").alias("_rows"))
    known = target.select(key, F.lit(1).alias("_known"))
    joined = per_key.join(known, key, "left")
    inserted = F.count_if(F.col("_known").isNull())
    processed = F.coalesce(F.sum("_rows"), F.lit(0))
    return joined.agg(
        processed.alias("processed"),
        inserted.alias("inserted"),
        (processed - inserted).alias("already_present"),
    )


def assert_source_row_unique(landed: DataFrame, fresh: DataFrame, key: str, foreign_landed: DataFrame | None = None,
                             foreign_fresh: bool = True) -> None:
    """Two ids for one source row are an error, not a skip.

    One of the two does not follow from the source row. A caller that knows says that
    no id of ``fresh`` is such a ``foreign`` one; ``fresh`` has each id once.
    """
    if not foreign_fresh and foreign_landed is not None and foreign_landed.isEmpty():
        return
    clash = new_source_row_conflicts(landed, fresh, key, foreign_landed).limit(1).collect()
    if clash:
        raise QualityError(f"Source row claimed by several ids: {clash[0].asDict()}")


def save_bucketed(df: DataFrame, table: str, key: str, buckets: int, path: str | None = None, part: str | None = None) -> None:
    """Append to a landing table bucketed by its key, one file per bucket and value of the partition column ``part``.

    Joins on the key then read the table without a shuffle: only the new batch moves.
    """
    writer = df.repartition(buckets, key).write.format("parquet").mode("append").bucketBy(buckets, key).sortBy(key)
    if part:
        writer = writer.partitionBy(part)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(table)


# Ledger of loaded files


def ledger_violations(ledger: DataFrame) -> DataFrame:
    inserted, rows = F.col("inserted_count"), F.col("row_count")
    sources, digest = F.col("source_name"), F.col("file_sha256")
    rules = [
        ("source_name_unknown", null_or(sources, ~sources.isin("events", "products"))),
        ("relative_path_empty", null_or(F.col("relative_path"), F.col("relative_path") == "")),
        ("file_size_not_positive", null_or(F.col("file_size_bytes"), F.col("file_size_bytes") <= 0)),
        ("file_sha256_malformed", null_or(digest, ~digest.rlike("^[0-9a-f]{64}$"))),
        ("row_count_negative", null_or(rows, rows < 0)),
        ("inserted_count_out_of_range", null_or(inserted, (inserted < 0) | (inserted > rows))),
    ]
    judged = ledger.withColumn("violations", all_failures(rules))
    return judged.where(F.size("violations") > 0)


def classify_files(inventory: DataFrame, ledger: DataFrame) -> DataFrame:
    """Inventory rows with ``state``: load (unrecorded), skip (identical) or changed.

    Which side is small is left to the optimizer: neither has a fixed bound.
    """
    recorded = ledger.select(
        "source_name",
        "relative_path",
        F.struct("file_size_bytes", "file_sha256", "row_count").alias("_recorded"),
    )
    joined = inventory.join(recorded, ["source_name", "relative_path"], "left")
    found = F.struct("file_size_bytes", "file_sha256", "row_count")
    state = (
        F.when(F.col("_recorded").isNull(), "load")
        .when(F.col("_recorded") == found, "skip")
        .otherwise("changed")
    )
    return joined.withColumn("state", state).drop("_recorded")


def looked_at(listed: DataFrame, ledger: DataFrame) -> DataFrame:
    """Listed files with ``state``: load (unrecorded), skip (recorded, same size and time), look (one of them differs).

    Brings along what the ledger recorded, to be compared with a fresh hash.
    """
    recorded = ledger.select(
        "source_name", "relative_path", F.lit(True).alias("_known"),
        F.col("file_size_bytes").alias("recorded_bytes"), F.col("file_sha256").alias("recorded_sha256"),
        F.col("row_count").alias("recorded_rows"), F.col("file_modified_at_utc").alias("recorded_at"))
    same = (F.col("recorded_bytes") == F.col("file_size_bytes")) & (F.col("recorded_at") == F.col("file_modified_at_utc"))
    state = F.when(F.col("_known").isNull(), "load").when(same, "skip").otherwise("look")
    return listed.join(recorded, ["source_name", "relative_path"], "left").withColumn("state", state).drop("_known", "recorded_at")
