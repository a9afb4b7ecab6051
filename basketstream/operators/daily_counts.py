"""The daily activity mart kept up to date from each load's rows alone, with exact distinct clients.

Distinct counts cannot be added up, sets of clients can. Every client gets a number
when it is first seen; per day and event type a load leaves bitmaps of the numbers it
met, 32,768 clients to a bitmap, and the mart is the bitwise or of all loads' bitmaps.
Numbers count on within the load and task that first met a client, so bitmaps are full
and their number follows the clients, not the events.

A load writes below its own name and nothing else: a load that is run again replaces
what it wrote, and no load reads what others wrote but for the client numbers.
``compact`` merges the bitmaps of all loads into one.
"""

import os
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from basketstream.operators.marts import source_day
from basketstream.sources.tables import read_or_empty

DAY = ["event_date_source", "event_type"]
_CLIENTS = "client_id bigint, number bigint, met_in string"
_PARTS = "event_date_source date, event_type string, numbered_in string, bitmap_number bigint, event_count bigint, clients binary, load string"


@dataclass
class DailyCounts:
    root: str

    def _part(self, kind, load):
        return os.path.join(self.root, kind, f"{'met_in' if kind == 'clients' else 'load'}={load}")

    def clients(self, spark) -> DataFrame:
        return read_or_empty(spark, os.path.join(self.root, "clients"), _CLIENTS)

    def parts(self, spark) -> DataFrame:
        return read_or_empty(spark, os.path.join(self.root, "parts"), _PARTS)

    def update(self, rows: DataFrame, load: str) -> None:
        """Add the staged rows of one load; ``load`` names it, and the same name replaces it."""
        spark = rows.sparkSession
        others = self.clients(spark).where(F.col("met_in") != load)
        met = rows.select("client_id").where("client_id IS NOT NULL").distinct()
        new = met.join(others, "client_id", "left_anti").select("client_id", F.monotonically_increasing_id().alias("number"))
        new.write.mode("overwrite").parquet(self._part("clients", load))
        # One row per day, type and client moves, whatever the number of events.
        seen = rows.groupBy(source_day().alias(DAY[0]), "event_type", "client_id").agg(F.count("*").alias("events"))
        known = self.clients(spark).where(F.col("client_id").isNotNull())
        numbered = seen.join(known, "client_id", "left")
        number = F.col("number")
        parts = numbered.groupBy(*DAY, F.col("met_in").alias("numbered_in"), F.bitmap_bucket_number(number).alias("bitmap_number")).agg(
            F.sum("events").alias("event_count"), F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias("clients"))
        parts.write.mode("overwrite").parquet(self._part("parts", load))

    def _merged(self, spark) -> DataFrame:
        return self.parts(spark).groupBy(*DAY, "numbered_in", "bitmap_number").agg(
            F.sum("event_count").alias("event_count"), F.bitmap_or_agg("clients").alias("clients"))

    def mart(self, spark) -> DataFrame:
        """Events and distinct clients per source day and event type, over all loads."""
        return self._merged(spark).groupBy(*DAY).agg(
            F.sum("event_count").alias("event_count"), F.sum(F.bitmap_count("clients")).alias("distinct_clients"))

    def compact(self, spark, into: "DailyCounts") -> None:
        """The same counts as one load of an empty folder; client numbers are copied."""
        self._merged(spark).write.parquet(into._part("parts", "compacted"))
        self.clients(spark).write.partitionBy("met_in").parquet(os.path.join(into.root, "clients"))
