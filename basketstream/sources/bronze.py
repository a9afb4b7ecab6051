"""Reads of the bronze folders: records and file inventory."""

import os

from pyspark.sql import DataFrame, functions as F

from basketstream.schemas import BRONZE_COLUMNS, names
from basketstream.sources.tables import relative_path

SOURCES = list(BRONZE_COLUMNS)
_RECORD_ORDER = ["kafka_topic", "kafka_partition", "kafka_offset"]


def check_source(source: str) -> None:
    if source not in SOURCES:
        raise ValueError(f"{source} is not a bronze folder; there are {SOURCES}")


def check_columns(df: DataFrame, source: str) -> DataFrame:
    """Fail on missing bronze columns, drop any others."""
    wanted = names(BRONZE_COLUMNS[source])
    missing = sorted(set(wanted) - set(df.columns))
    if missing:
        raise ValueError(f"Bronze files lack {missing}")
    return df.select(*wanted)


def scan_bronze(spark, root: str, source: str, limit: int | None = None) -> DataFrame:
    check_source(source)
    df = check_columns(spark.read.parquet(os.path.join(root, source)), source)
    if limit is None:
        return df
    # A sample in record order is the same sample every time; only ``limit`` rows per task are kept.
    return df.orderBy(*_RECORD_ORDER).limit(limit)


_BRONZE_FILES = {"recursiveFileLookup": "true", "pathGlobFilter": "*.parquet"}


def _named(files: DataFrame, source: str, folder: str) -> DataFrame:
    return files.withColumns({
        "source_name": F.lit(source),
        "relative_path": relative_path(F.col("path"), os.path.normpath(folder.split("://")[-1])),
    })


def list_bronze(spark, root: str, source: str) -> DataFrame:
    """Name, size and modification time of every committed bronze file, without reading any."""
    check_source(source)
    folder = os.path.join(root, source)
    files = spark.read.format("binaryFile").options(**_BRONZE_FILES).load(folder)
    return _named(files, source, folder).select(
        "source_name", "relative_path", "path", F.col("length").alias("file_size_bytes"),
        F.col("modificationTime").alias("file_modified_at_utc"))


def bronze_inventory(spark, root: str, source: str, paths: list[str] | None = None) -> DataFrame:
    """Name, size, SHA-256, row count and modification time of every committed bronze file.

    Hidden and work-in-progress paths are left out by the readers, and so are
    files that a stream wrote but never committed. Row counts come from a count
    per file, sizes and hashes from the file bytes. A file is one row, so the
    reader refuses one of 2 GB or more with an error; the sinks roll their files
    long before. ``paths`` narrows the inventory to given files.
    """
    check_source(source)
    folder = os.path.join(root, source)
    files = (
        spark.read.format("binaryFile").options(**_BRONZE_FILES).load(paths or folder)
        .select("path", "length", "modificationTime", F.sha2("content", 256).alias("file_sha256"))
    )
    counts = (
        spark.read.options(**_BRONZE_FILES).parquet(*(paths or [folder]))
        .groupBy(F.col("_metadata.file_path").alias("path"))
        .agg(F.count("*").alias("row_count"))
    )
    return _named(files.join(counts, "path", "left"), source, folder).select(
        "source_name", "relative_path", "path",
        F.col("length").alias("file_size_bytes"),
        "file_sha256",
        F.coalesce("row_count", F.lit(0)).cast("bigint").alias("row_count"),
        F.col("modificationTime").alias("file_modified_at_utc"),
    )
