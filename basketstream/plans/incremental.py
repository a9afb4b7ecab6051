"""Incremental load of bronze files into landing, recorded in a file ledger."""

import hashlib
import os
from bisect import bisect_right
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from itertools import batched

from pyspark.sql import Column, functions as F

from basketstream.functions.checks import all_failures
from basketstream.functions.ids import record_id
from basketstream.operators.landing import (
    assert_source_row_unique, insert_absent, landing_rules, looked_at, normalize_bronze, save_bucketed,
)
from basketstream.operators.loads import LOAD, UNCLAIMED, Loads
from basketstream.operators.membership import MAX_FILES, LandingIndex, only_files
from basketstream.operators.quality import QualityError
from basketstream.schemas import BRONZE_COLUMNS, LANDING_COLUMNS, LEDGER_COLUMNS, PRIMARY_KEY, ddl, names
from basketstream.session import cut_lineage
from basketstream.sources.bronze import bronze_inventory, check_columns, list_bronze
from basketstream.sources.tables import read_or_empty

# Files whose names the driver holds at a time; a load takes as many batches as it needs.
BATCH_FILES = 1000


@dataclass
class Warehouse:
    """Landing tables, bucketed by record id, and the ledger below one folder.

    Both have a folder per load; readers see those of published loads and rows
    appended without a claim (see ``operators.loads``).

    ``buckets`` is a lasting property of the folder: it is set once, for the size
    the landing will reach. The catalog entry is made anew in each session.
    """

    root: str
    buckets: int = 64

    def landing(self, source):
        return os.path.join(self.root, "landing", f"{source}-{self.buckets}")

    @property
    def ledger(self):
        return os.path.join(self.root, "ledger")

    def landing_table(self, spark, source):
        path = self.landing(source)
        name = f"landing_{source}_{hashlib.sha256(path.encode()).hexdigest()[:24]}"
        key = PRIMARY_KEY[source]
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} ({ddl(LANDING_COLUMNS[source])}, {LOAD} string) USING parquet PARTITIONED BY ({LOAD}) "
            f"CLUSTERED BY ({key}) SORTED BY ({key}) INTO {self.buckets} BUCKETS LOCATION '{path}'")
        return name

    def read_landing(self, spark, source):
        name = self.landing_table(spark, source)
        # Files are listed anew, and before the loads: a listed file's load has claimed.
        spark.catalog.refreshTable(name)
        rows, unseen = spark.table(name), self.loads(source).unpublished(spark)
        return (rows.where(~F.col(LOAD).isin(unseen)) if unseen else rows).drop(LOAD)

    def loads(self, source):
        return Loads(os.path.join(self.root, "loads", source))

    def index(self, source):
        root = os.path.join(self.root, "landing-index", f"{source}-{self.buckets}")
        return LandingIndex(root, self.landing(source), PRIMARY_KEY[source], self.buckets, self.loads(source))

    def append_landing(self, rows, source, load=UNCLAIMED):
        """Append whole landing rows, each bucket in one file per load; they are seen at once, or with the claimed ``load``.

        ``load`` is a name, or a column of the rows with names.
        """
        spark = rows.sparkSession
        load = load if isinstance(load, Column) else F.lit(load)
        columns = rows.select(*names(LANDING_COLUMNS[source]), load.alias(LOAD))
        save_bucketed(columns, self.landing_table(spark, source), PRIMARY_KEY[source], self.buckets, self.landing(source), LOAD)

    def read_ledger(self, spark):
        entries = read_or_empty(spark, self.ledger, f"{ddl(LEDGER_COLUMNS)}, {LOAD} string")
        unseen = [load for source in PRIMARY_KEY for load in self.loads(source).unpublished(spark)]
        return (entries.where(~F.col(LOAD).isin(unseen)) if unseen else entries).drop(LOAD)


@dataclass
class LoadResult:
    """Files loaded and skipped, rows inserted, unrecorded files that the caller's limit left over, and rows read."""

    loaded: int
    skipped: int
    inserted: int
    pending: int = 0
    processed: int = 0

    @property
    def present(self):
        """Rows that were landed already, or came twice."""
        return self.processed - self.inserted


def incremental_load(spark, bronze_root, warehouse: Warehouse, source, max_new_files=None, max_file_rows=None, batch_files=BATCH_FILES):
    """Load all unrecorded files in path order, or the first ``max_new_files``.

    Files are listed without being read. Read and hashed are the unrecorded ones,
    and recorded ones whose size or modification time differs from the ledger
    (``audit_recorded`` hashes all). A recorded file that changed, or a new one
    with more than ``max_file_rows`` rows, ends the run with an error; files
    before it are loaded and recorded, it is not. A batch's rows and ledger
    entries become visible together: a run that dies shows nothing of its batch,
    and of two runs at once the one that is second to publish a batch fails. The
    listing is sorted and numbered once; a batch reads its range of numbers.

    Small batches that follow each other are read, judged and written by the same
    Spark jobs, as the jobs of a batch take about as long for two files as for
    hundreds. Each is still published by itself, in order, with its own rows and
    ledger entries. If something is wrong with one of them, the group is halved,
    down to the batch itself: those before it are published, and it fails alone.
    """
    for given in (max_new_files, max_file_rows, batch_files):
        if given is not None and given < 1:
            raise ValueError("Limits must be positive")
    # Asked before anything is read: a load that is published later makes this one fail.
    generation = warehouse.loads(source).latest(spark)
    listed = cut_lineage(spark, list_bronze(spark, bronze_root, source), "listing")
    files = cut_lineage(spark, looked_at(listed, warehouse.read_ledger(spark)), "files")
    numbered = cut_lineage(spark, files.where("state <> 'skip'").orderBy("relative_path").withColumn(
        "_number", F.monotonically_increasing_id()), "numbered")
    warehouse.index(source).refresh(spark)
    loaded, inserted, processed, same, last, barrier = 0, 0, 0, 0, "", None
    # The names of a group's files are held by the driver, and those of the landing files that it makes.
    together = max(1, min(BATCH_FILES // batch_files, MAX_FILES // warehouse.buckets))
    for group in batched(_ranges(numbered, batch_files), together):
        tries = [group]
        while tries and not barrier and (max_new_files is None or loaded < max_new_files):
            ranges = tries.pop()
            try:
                chosen = _choose(spark, bronze_root, source, numbered, ranges, max_new_files and max_new_files - loaded, max_file_rows)
                fresh = _judge(spark, bronze_root, warehouse, source, chosen.batches) if chosen.batches else None
            except Exception:
                if len(ranges) == 1:
                    raise
                # Whatever it is, it is found again: in its own batch, when those before it are published.
                half = len(ranges) // 2
                tries += [ranges[half:], ranges[:half]]
                continue
            if fresh:
                inserted += _land(spark, warehouse, source, chosen.batches, fresh, generation)
                generation += len(chosen.batches)
            rows = [row["row_count"] for batch in chosen.batches for row in batch]
            loaded, processed, same = loaded + len(rows), processed + sum(rows), same + chosen.same
            last, barrier = chosen.last or last, chosen.barrier
        if barrier or max_new_files is not None and loaded >= max_new_files:
            break
    if barrier:
        raise QualityError(f"Bronze file {source}/{barrier[0]} {barrier[1]}")
    after = F.col("relative_path") > last
    whole = max_new_files is None or loaded < max_new_files
    counts = files.agg(
        F.count_if((F.col("state") == "skip") & (F.lit(whole) | ~after)).alias("skipped"),
        F.count_if((F.col("state") == "load") & after & F.lit(not whole)).alias("pending")).first()
    return LoadResult(loaded, counts["skipped"] + same, inserted, counts["pending"], processed)


def _ranges(numbered, size):
    """First and last number of each batch of ``size`` files; one small row per task of the sort is collected."""
    counts = numbered.groupBy(F.shiftright("_number", 33).alias("part")).count().collect()
    for part, count in sorted(map(tuple, counts)):
        for first in range(0, count, size):
            yield (part << 33) + first, (part << 33) + first + size - 1


@dataclass
class _Chosen:
    """Files to load of each batch that has some, recorded files found unchanged, the last path visited, and what ends the run."""

    batches: list
    same: int = 0
    last: str = ""
    barrier: tuple | None = None


def _choose(spark, bronze_root, source, numbered, ranges, most, max_file_rows) -> _Chosen:
    """What to load of consecutive ranges of numbers, at most ``most`` files; files behind these are not read."""
    listed = numbered.where(F.col("_number").between(ranges[0][0], ranges[-1][1])).orderBy("_number").collect()
    if most is not None:
        new = [at for at, row in enumerate(listed) if row["state"] == "load"]
        listed = listed[:new[most - 1] + 1] if len(new) >= most else listed
    found = {row["path"]: row for row in bronze_inventory(spark, bronze_root, source, [row["path"] for row in listed]).collect()}
    chosen, batches = _Chosen([]), [[] for _ in ranges]
    starts = [low for low, _ in ranges]
    for row in listed:
        now = found[row["path"]]
        if row["state"] == "look":
            if (now["file_sha256"], now["row_count"], now["file_size_bytes"]) != (
                    row["recorded_sha256"], row["recorded_rows"], row["recorded_bytes"]):
                chosen.barrier = row["relative_path"], "has changed"
                break
            chosen.same += 1
        elif max_file_rows is not None and now["row_count"] > max_file_rows:
            chosen.barrier = row["relative_path"], "has too many rows"
            break
        else:
            batches[bisect_right(starts, row["_number"]) - 1].append(now)
        chosen.last = row["relative_path"]
    chosen.batches = [batch for batch in batches if batch]
    return chosen


def audit_recorded(spark, bronze_root, warehouse: Warehouse, source):
    """Recorded files whose content is no longer what the ledger says, by hashing all of them."""
    recorded = warehouse.read_ledger(spark).where(F.col("source_name") == source).select(
        "relative_path", F.struct("file_size_bytes", "file_sha256", "row_count").alias("_recorded"))
    found = F.struct("file_size_bytes", "file_sha256", "row_count")
    return bronze_inventory(spark, bronze_root, source).join(recorded, "relative_path").where(found != F.col("_recorded")).drop("_recorded")


def _read(spark, source, batches):
    """Bronze rows of the batches' files with their file, their row in it, and their batch's place."""
    # Each batch's schema is asked of its own files; the driver waits for most of that time.
    with ThreadPoolExecutor(8) as pool:
        frames = list(pool.map(lambda batch: spark.read.parquet(*[row["path"] for row in batch]), batches))
    if any(raw.schema != frames[0].schema for raw in frames[1:]):
        raise QualityError("Batches of several schemas are not read together")
    raw = frames[0]
    if len(batches) > 1:
        raw = spark.read.schema(raw.schema).parquet(*[row["path"] for batch in batches for row in batch])
    check_columns(raw, source)
    placed = raw.select(
        *names(BRONZE_COLUMNS[source]),
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.row_index").alias("_row"),
    )
    if len(batches) == 1:
        return placed.withColumn("_batch", F.lit(0))
    # Names of files only, at most ``BATCH_FILES``; without a join, as each row's file is one of a constant list.
    files, places = zip(*[(F.lit(row["path"]), F.lit(at)) for at, batch in enumerate(batches) for row in batch])
    return placed.withColumn("_batch", F.get(F.array(*places), F.array_position(F.array(*files), F.col("_file")).cast("int") - 1))


@dataclass
class _Fresh:
    """Rows to land, written once, and what was counted over them."""

    rows: object
    inserted: int
    foreign: int


def _judge(spark, bronze_root, warehouse, source, batches) -> _Fresh:
    """The rows that consecutive batches bring anew, by their place; an error if a rule is broken, a source row claimed or a file rewritten."""
    key, pending = PRIMARY_KEY[source], [row for batch in batches for row in batch]
    batch = normalize_bronze(_read(spark, source, batches), source, keep=["_file", "_row", "_batch"])
    index = warehouse.index(source)
    landed = only_files(warehouse.read_landing(spark, source), index.holders(spark, batch, part="_file"))
    # Written once: what is counted and what is landed are the same rows. All counts are one pass over what was written;
    # an Observation would do without it, but a session that has had one can no longer apply a fitted model.
    # A key stays with the first batch that has it, as if that batch were landed before the next is looked at.
    rows = insert_absent(landed, batch, key, ["_batch", "_file", "_row"]).withColumn("loaded_at_utc", F.current_timestamp())
    fresh, broken = cut_lineage(spark, rows, "fresh"), all_failures(landing_rules(source))
    strange = ~F.col(key).eqNullSafe(record_id(F.col("source_file"), F.col("source_row_number")))
    seen = fresh.agg(F.count("*").alias("inserted"), F.count_if(strange).alias("foreign"), F.count_if(F.col("_batch").isNull()).alias("unplaced"),
                     F.first(F.when(F.size(broken) > 0, broken), True).alias("broken")).first()
    if seen["broken"]:
        raise QualityError(f"Landing rules broken: {seen['broken']}")
    if seen["unplaced"]:
        raise QualityError("The reader and the listing name a file of this batch differently")
    assert_source_row_unique(landed, fresh, key, index.foreign(spark), seen["foreign"] > 0)
    _assert_unchanged(spark, bronze_root, source, pending)
    return _Fresh(fresh, seen["inserted"], seen["foreign"])


def _land(spark, warehouse, source, batches, fresh: _Fresh, generation) -> int:
    """Write what was judged, under a load per batch, and publish these in order."""
    index, loads = warehouse.index(source), warehouse.loads(source)
    claimed = [loads.claim(spark) for _ in batches]
    load = F.array(*[F.lit(name) for name in claimed])[F.col("_batch")]
    warehouse.append_landing(fresh.rows, source, load)
    _record(spark, warehouse, fresh.rows, batches, claimed)
    for number, name in enumerate(claimed, generation + 1):
        loads.publish(spark, number, name)
    # A run that dies before this is entered by the next one's first refresh.
    index.refresh(spark, rows=fresh.inserted, foreign=fresh.foreign > 0)
    return fresh.inserted


def _assert_unchanged(spark, bronze_root, source, pending):
    """Sizes and hashes of the batch's files are still those the run started with."""
    now = bronze_inventory(spark, bronze_root, source, [row["path"] for row in pending])
    before = {row["path"]: (row["file_size_bytes"], row["file_sha256"], row["row_count"]) for row in pending}
    same = {row["path"]: (row["file_size_bytes"], row["file_sha256"], row["row_count"]) for row in now.collect()}
    if same != before:
        raise QualityError("A file of this batch was rewritten while its rows were read")


def _record(spark, warehouse, fresh, batches, loads):
    # Both are bounded by the files of a batch, or of a group of small ones.
    inserted = dict(map(tuple, fresh.groupBy("_file").count().collect()))
    rows = [(*(row[name] for name in ("source_name", "relative_path", "file_size_bytes", "file_sha256", "row_count")),
             inserted.get(row["path"], 0), None, row["file_modified_at_utc"], load)
            for batch, load in zip(batches, loads, strict=True) for row in batch]
    ledger = spark.createDataFrame(rows, f"{ddl(LEDGER_COLUMNS)}, {LOAD} string").withColumn("completed_at_utc", F.current_timestamp())
    # Only the loads' own new folders are written, each in one step, and nothing that another run has under way is touched.
    writer = ledger.coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(LOAD).parquet(warehouse.ledger)
