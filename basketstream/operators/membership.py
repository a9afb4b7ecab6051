"""Which landing files may hold a record: zones of source rows, Bloom filters, and the ids that do not follow from them.

A record's id normally follows from its source row, so a batch need not look for its
ids among all that were ever landed. Beside the landing lie

* *zones*: per landing file and source file the first and last source row, the first
  and last id, and who landed it when;
* *blooms*: per landing file a blocked Bloom filter of its ids, one row per 64-bit
  word, sized for about four ids a word and three bits an id;
* *foreign* rows: those whose id is not that of their source row. Ids are computed
  once, when rows are landed.

A batch's proper ids can only be in files of the same bucket whose zone covers their
source rows, or among the foreign rows; its foreign ids can be in any file of their
bucket. The Bloom filters of these files decide which of them are opened. New source
rows thus open no file, whatever the landing holds, and the answer is exact: files
that are left out hold none of the ids.

The index is brought up to date before it is asked: files that a failed run landed
without entering them are entered then. An entry's zones are written last.
"""

import os
import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, functions as F

from basketstream.functions.ids import record_id
from basketstream.operators.loads import Loads, load_of
from basketstream.operators.quality import SOURCE_ROW
from basketstream.sources.tables import read_or_empty

# File names the driver holds at a time. A batch that may be in more files reads the whole landing table instead.
MAX_FILES = 10_000
IDS_PER_WORD = 4
_ZONES = (
    "path string, bucket int, source_file string, low bigint, high bigint, rows bigint, min_id string, max_id string, "
    "words bigint, generation string, writer string, batch bigint, landed_at timestamp")
_FOREIGN = "id string, source_dataset string, source_file string, source_row_number bigint, path string"
_BLOOMS = "path string, word bigint, bits bigint"


def _bits(value):
    """Three of 64 bits."""
    drawn = F.xxhash64(F.lit(1), value)
    one = lambda skip: F.call_function("shiftleft", F.lit(1).cast("bigint"), F.shiftrightunsigned(drawn, skip).bitwiseAND(F.lit(63)).cast("int"))
    return one(0).bitwiseOR(one(6)).bitwiseOR(one(12))


def _word(value, words):
    return F.pmod(F.xxhash64(value), words)


@dataclass
class Landed:
    """Files that a writer need not look into: its own of earlier batches, landed at the column ``since`` or later."""

    writer: str
    batch: int
    since: object


class LandingIndex:
    """Index of one landing table below ``root``; ``files`` is the folder of the table, bucketed by ``key``."""

    def __init__(self, root: str, files: str, key: str, buckets: int, loads: Loads | None = None):
        self.root, self.files, self.key, self.buckets, self.loads = root, files, key, buckets, loads

    def _read(self, spark, part, schema):
        return read_or_empty(spark, os.path.join(self.root, part), schema)

    def zones(self, spark) -> DataFrame:
        return self._read(spark, "zones", _ZONES)

    def foreign(self, spark) -> DataFrame:
        return self._read(spark, "foreign", _FOREIGN)

    def unknown_files(self, spark) -> list[str]:
        """Landing files without an entry, at most ``MAX_FILES``, but for those of unpublished loads; no file is opened."""
        try:
            listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(self.files).select("path")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return []
        new = listed.join(self.zones(spark).select("path"), "path", "left_anti")
        # Asked after the listing: a listed file's load has claimed.
        unseen = self.loads.unpublished(spark) if self.loads else []
        return [row["path"] for row in new.where(~load_of("path").isin(unseen)).limit(MAX_FILES).collect()]

    def refresh(self, spark, writer: str = "", batch: int = -1, rows: int | None = None, foreign: bool = True) -> int:
        """Enter landed files that have no entry yet; gives their number.

        A caller that knows them says how many ``rows`` the new files hold in all, and
        that none of them is ``foreign``.
        """
        entered = 0
        while paths := self.unknown_files(spark):
            # The first entry makes the table of foreign rows, be it empty.
            first = not self.zones(spark).inputFiles()
            self._enter(spark, paths, writer, batch, rows, foreign or first)
            entered += len(paths)
        return entered

    def _enter(self, spark, paths, writer, batch, n_rows, any_foreign):
        kept = spark.read.schema(f"{self.key} string, source_dataset string, source_file string, source_row_number bigint, loaded_at_utc timestamp")
        rows = only_files(kept.parquet(self.files), paths).select(
            F.col(self.key).alias("id"), *SOURCE_ROW, "loaded_at_utc", F.col("_metadata.file_path").alias("path"))
        if n_rows is None:
            n_rows = rows.count()
        # Ids are hashes: the files of one append are about equally large.
        words, generation = max(1, -(-n_rows // (len(paths) * IDS_PER_WORD))), uuid.uuid4().hex
        if any_foreign:
            proper = record_id(F.col("source_file"), F.col("source_row_number"))
            foreign = rows.where(~F.col("id").eqNullSafe(proper)).select("id", *SOURCE_ROW, "path")
            foreign.write.mode("append").parquet(os.path.join(self.root, "foreign"))
        blooms = rows.groupBy("path", _word(F.col("id"), F.lit(words)).alias("word")).agg(F.bit_or(_bits(F.col("id"))).alias("bits"))
        blooms.write.parquet(os.path.join(self.root, "blooms", generation))
        bounds = rows.groupBy("path", "source_file").agg(
            F.min("source_row_number").alias("low"), F.max("source_row_number").alias("high"), F.count("*").alias("rows"),
            F.min("id").alias("min_id"), F.max("id").alias("max_id"), F.max("loaded_at_utc").alias("landed_at"))
        # A file without rows has an entry without a zone.
        entry = spark.createDataFrame([(path,) for path in paths], "path string").join(bounds, "path", "left").select(
            "path", F.pmod(F.hash("min_id"), F.lit(self.buckets)).alias("bucket"), "source_file", "low", "high", "rows", "min_id", "max_id",
            F.lit(words).cast("bigint").alias("words"), F.lit(generation).alias("generation"), F.lit(writer).alias("writer"),
            F.lit(batch).cast("bigint").alias("batch"), "landed_at")
        # Not coalesce, which would make the counts above one task's work.
        entry.repartition(1).write.mode("append").parquet(os.path.join(self.root, "zones"))

    def holders(self, spark, batch: DataFrame, landed: Landed | None = None, part: str | None = None) -> list[str] | None:
        """Files that may hold an id of ``batch`` or claim one of its source rows; None if there are too many to name.

        ``batch`` has the key and the source row. With ``landed``, files are left out
        whose ids the caller has removed from the batch by other means. ``part`` is a
        column by whose values source rows lie together, as in the files they come from.
        """
        source = F.col("source_file"), F.col("source_row_number")
        parts = [part] if part else []
        rows = batch.select(F.col(self.key).alias("id"), *SOURCE_ROW, *parts, record_id(*source).alias("proper"))
        strange = ~F.col("id").eqNullSafe(F.col("proper"))
        near = rows.where("proper IS NOT NULL").select(F.col("proper").alias("id"), *SOURCE_ROW, *parts)
        far = rows.where(strange & F.col("id").isNotNull()).select("id")
        bucket = F.pmod(F.hash("id"), F.lit(self.buckets)).alias("bucket")
        zones = self.zones(spark).where("rows > 0")
        if not zones.inputFiles():
            return []
        file = ["path", "generation", "words", "bucket"]
        spans = near.groupBy(bucket, "source_file", *parts).agg(
            F.min("source_row_number").alias("first"), F.max("source_row_number").alias("last"))
        own = zones
        if landed:
            own = zones.where(~((F.col("writer") == landed.writer) & (F.col("batch") < landed.batch) & (F.col("landed_at") >= landed.since)))
        covering = own.join(spans, ["bucket", "source_file"]).where("low <= last AND high >= first").select(*file, "low", "high")
        anywhere = zones.join(far.withColumn("bucket", bucket), "bucket").where(F.col("id").between(F.col("min_id"), F.col("max_id"))).select(*file)
        likely = covering.unionByName(anywhere, True).groupBy(*file).agg(
            F.min("low").alias("low"), F.max("high").alias("high"), F.bool_or(F.col("low").isNull()).alias("anywhere")).limit(MAX_FILES + 1).collect()
        if len(likely) > MAX_FILES:
            return None
        known, found = self.foreign(spark), []
        # Ids that all follow from their source rows need not be sorted to meet none.
        if not known.isEmpty():
            # The batch is never broadcast: every load would send its ids through the driver.
            found.append(known.join(rows.select("id").distinct().hint("merge"), "id", "left_semi").select("path"))
            found.append(known.join(rows.select(*SOURCE_ROW).distinct().hint("merge"), SOURCE_ROW, "left_semi").select("path"))
        if likely:
            chosen = F.broadcast(spark.createDataFrame(
                likely, "path string, generation string, words bigint, bucket int, low bigint, high bigint, anywhere boolean"))
            folders = sorted({os.path.join(self.root, "blooms", row["generation"]) for row in likely})
            blooms = spark.read.schema(_BLOOMS).parquet(*folders)
            # A proper id is asked of the files that hold source rows on both sides of its own.
            placed = near.withColumn("bucket", bucket).join(chosen, "bucket").where(F.col("source_row_number").between(F.col("low"), F.col("high")))
            strangers = far.withColumn("bucket", bucket).join(chosen, "bucket").where("anywhere")
            asked = placed.select("id", "path", "words").unionByName(strangers.select("id", "path", "words")).select(
                "path", _word(F.col("id"), F.col("words")).alias("word"), _bits(F.col("id")).alias("mask"))
            hit = asked.join(blooms, ["path", "word"]).where(F.col("bits").bitwiseAND(F.col("mask")) == F.col("mask"))
            found.append(hit.select("path"))
        if not found:
            return []
        paths = [row["path"] for row in reduce(DataFrame.unionByName, found).distinct().limit(MAX_FILES + 1).collect()]
        return None if len(paths) > MAX_FILES else paths


def only_files(landed: DataFrame, paths: list[str] | None) -> DataFrame:
    """Rows of a landing table in the given files; the others are not opened, and the bucketing stays."""
    if paths is None:
        return landed
    return landed.where(F.col("_metadata.file_path").isin(paths)) if paths else landed.where(F.lit(False))
