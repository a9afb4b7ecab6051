"""Scans of the raw event and product files.

A record is identified by its file and its physical row in that file, so scans
carry ``source_file`` and ``source_row_number``.
"""

import os

from pyspark.sql import DataFrame, functions as F

from basketstream.fixed_values import EVENT_FILES, PRODUCT_FILE
from basketstream.functions.times import check_window, day_bounds, source_time_or_fail
from basketstream.sources.tables import relative_path


def scan_source(spark, path: str, source_file: str | None = None, limit: int | None = None) -> DataFrame:
    """Scan with zero-based physical row numbers, optionally only the first ``limit`` rows.

    The row number comes from the reader, so no sort and no shuffle is needed. A
    table of one file is named by ``source_file``, or by the end of its path. A
    table of several files numbers the rows of each file, so a row's source file
    is then the table's name and the file's path below the table, such as
    ``add_to_cart.parquet/part-00003.parquet``: ids stay apart, and the event type
    still follows from the table. A fixed ``source_file`` for several files would
    give several rows one id and is an error.
    """
    df = spark.read.parquet(path)
    folder = os.path.normpath(path.split("://")[-1])
    table = os.path.basename(folder)
    if len(df.inputFiles()) > 1:
        if source_file:
            raise ValueError(f"{path} has several files; one name for all would repeat row identities")
        own = F.concat(F.lit(table + "/"), relative_path(F.col("_metadata.file_path"), folder))
    else:
        own = F.lit(source_file or table)
    numbered = df.select(own.alias("source_file"), F.col("_metadata.row_index").alias("source_row_number"), *df.columns)
    if limit is None:
        return numbered
    if len(df.inputFiles()) > 1:
        return numbered.orderBy("source_file", "source_row_number").limit(limit)
    return numbered.where(F.col("source_row_number") < limit)


def scan_request(spark, path: str, source_file: str, start: str | None = None, end: str | None = None,
                 limit: int | None = None) -> DataFrame:
    """A replay's scan: the first ``limit`` rows of a file, or the first ``limit`` matches of a time window."""
    check_window_request(source_file, start, end)
    if start is None:
        return scan_source(spark, path, source_file, limit)
    return scan_window(scan_source(spark, path, source_file), start, end, limit)


def scan_window(df: DataFrame, start: str, end: str, max_selected: int | None = None) -> DataFrame:
    """Rows with ``start <= timestamp < end`` under their original row numbers.

    ``max_selected`` keeps the first matches in row order: it counts matches,
    not scanned rows. The comparison is on the raw text, which reaches the scan.
    """
    check_window(start, end)
    if max_selected is not None and max_selected <= 0:
        raise ValueError("max_selected must be positive")
    stamp = F.col("timestamp")
    matches = df.where((stamp >= start) & (stamp < end))
    if max_selected is not None:
        matches = matches.orderBy("source_file", "source_row_number").limit(max_selected)
    return matches


def check_window_request(source_file: str, start: str | None, end: str | None) -> None:
    """Both bounds or neither, and none at all for products."""
    if (start is None) != (end is None):
        raise ValueError("Give both window bounds or neither")
    if start is not None and source_file == PRODUCT_FILE:
        raise ValueError("Time windows apply to behavioural events only")


def day_events(raw: DataFrame, activity_date, last_date=None) -> DataFrame:
    """Events of one source day (or of a range of days) with parsed ``event_time``.

    The day filter compares text, so it can be pushed into the scan; a value
    inside the day that is not a canonical timestamp fails the job.
    """
    lower, upper = day_bounds(activity_date)
    if last_date is not None:
        upper = day_bounds(last_date)[1]
    stamp = F.col("timestamp")
    inside = raw.where(stamp.isNotNull() & (stamp >= lower) & (stamp < upper))
    return inside.withColumn("event_time", source_time_or_fail(stamp))


def all_events(raw: dict[str, DataFrame]) -> DataFrame:
    """One relation out of the five typed event tables; absent columns are null."""
    unknown = set(raw) - set(EVENT_FILES)
    if unknown:
        raise ValueError(f"Unsupported event types: {sorted(unknown)}")
    merged = None
    for event_type, df in raw.items():
        typed = df.withColumn("event_type", F.lit(event_type))
        merged = typed if merged is None else merged.unionByName(typed, allowMissingColumns=True)
    return merged
