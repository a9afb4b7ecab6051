"""The landing index: which files a batch opens, and that nothing is missed."""

import pytest
from pyspark.sql import functions as F

from basketstream.functions.ids import record_id
from basketstream.operators import landing
from basketstream.operators.membership import LandingIndex, Landed, only_files
from basketstream.operators.quality import QualityError
from basketstream.plans.incremental import Warehouse, incremental_load
from test_landing import bronze_rows, write_file

BUCKETS = 4


def rows_of(spark, ids, file="page_visit.parquet", own=True):
    """Landing rows of the source rows ``ids``; without ``own`` under ids that do not follow from them."""
    rows = landing.normalize_bronze(bronze_rows(spark, ids), "events").withColumn("source_file", F.lit(file))
    named = record_id(F.col("source_file"), F.col("source_row_number"))
    return rows.withColumn("event_id", named if own else F.col("event_id")).withColumn("loaded_at_utc", F.current_timestamp())


@pytest.fixture
def store(tmp_path):
    return Warehouse(str(tmp_path / "warehouse"), BUCKETS)


def land(spark, store, rows, **how):
    store.append_landing(rows, "events")
    return store.index("events").refresh(spark, **how)


def scanned_files(df):
    """Files and bytes that the scans of a plan have read."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    if "AdaptiveSparkPlan" in plan.nodeName():
        plan = plan.executedPlan()
    leaves, files, size = plan.collectLeaves(), 0, 0
    for i in range(leaves.size()):
        metrics = leaves.apply(i).metrics()
        if metrics.contains("numFiles"):
            files += metrics.apply("numFiles").value()
            size += metrics.apply("filesSize").value()
    return files, size


def test_new_source_rows_open_no_file(spark, store):
    for start in (0, 100, 200):
        land(spark, store, rows_of(spark, range(start, start + 50)))
    index, landed = store.index("events"), store.read_landing(spark, "events")
    assert index.holders(spark, rows_of(spark, range(300, 310))) == []
    # Inside the zone of a load and not landed: the Bloom filters decide.
    assert len(index.holders(spark, rows_of(spark, range(50, 60)))) == 0
    again = index.holders(spark, rows_of(spark, range(110, 120)))
    whole = landed.select("event_id", F.col("_metadata.file_path").alias("path"))
    truth = {r["path"] for r in whole.join(rows_of(spark, range(110, 120)), "event_id").collect()}
    assert truth <= set(again) and len(again) <= len(truth) + 1
    fresh = landing.insert_absent(only_files(landed, again), rows_of(spark, range(115, 165)), "event_id", ["kafka_offset"])
    assert fresh.count() == 15


def test_bytes_read_do_not_follow_the_landing(spark, store):
    read = []
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for size in range(3):
            land(spark, store, rows_of(spark, range(1000 * size, 1000 * size + 40)))
            batch = rows_of(spark, range(10, 20))
            paths = store.index("events").holders(spark, batch)
            landed = only_files(store.read_landing(spark, "events"), paths).select("event_id")
            read.append(scanned_files(landed))
            assert landed.count() >= 10
        assert read[0] == read[1] == read[2] and 0 < read[0][0] <= BUCKETS
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_files_of_a_run_that_died_are_entered_later(spark, store):
    store.append_landing(rows_of(spark, range(10)), "events")
    store.append_landing(rows_of(spark, range(20, 30)), "events")
    index = store.index("events")
    unknown = index.unknown_files(spark)
    assert len(unknown) > BUCKETS and index.refresh(spark) == len(unknown) and index.refresh(spark) == 0
    assert index.zones(spark).agg(F.sum("rows")).first()[0] == 20
    holders = index.holders(spark, rows_of(spark, [3, 25]))
    assert only_files(store.read_landing(spark, "events"), holders).where(F.col("source_row_number").isin(3, 25)).count() == 2


def test_foreign_ids_and_claims_are_found(spark, store):
    land(spark, store, rows_of(spark, range(5)))
    land(spark, store, rows_of(spark, [70], own=False))
    index, landed = store.index("events"), store.read_landing(spark, "events")

    def seen(batch):
        return {r["source_row_number"] for r in only_files(landed, index.holders(spark, batch)).collect()}

    assert index.foreign(spark).count() == 1
    # The source row of the foreign record under its own id; a landed id under another source row; both are looked up.
    assert 70 in seen(rows_of(spark, [70]))
    stolen = rows_of(spark, [900]).withColumn("event_id", record_id(F.lit("page_visit.parquet"), F.lit(2)))
    assert 2 in seen(stolen)
    assert 70 in seen(rows_of(spark, [901]).withColumn("event_id", F.lit("2167e60c-7417-5c99-aac2-000000000070")))
    claim = rows_of(spark, [3], own=False)
    assert 3 in seen(claim)
    with pytest.raises(QualityError, match="several ids"):
        landing.assert_source_row_unique(only_files(landed, index.holders(spark, claim)), claim, "event_id", index.foreign(spark))
    other = rows_of(spark, [3], file="add_to_cart.parquet")
    landing.assert_source_row_unique(only_files(landed, index.holders(spark, other)), other, "event_id", index.foreign(spark))


def test_a_proper_id_is_asked_of_files_around_its_source_row_only(spark, store, monkeypatch):
    """Full Bloom filters say yes to every id: only the zones are left to tell."""
    for start in (0, 1000):
        land(spark, store, rows_of(spark, range(start, start + 40)))
    index, batch = store.index("events"), rows_of(spark, [*range(5, 25), *range(2000, 2020)])
    monkeypatch.setattr("basketstream.operators.membership._bits", lambda value: F.lit(0).cast("bigint"))
    landed = store.read_landing(spark, "events").select("source_row_number", F.col("_metadata.file_path").alias("path"))
    first = {r["path"] for r in landed.where("source_row_number < 1000").collect()}
    assert set(index.holders(spark, batch)) <= first
    parts = batch.withColumn("part", F.col("source_row_number") < 1000)
    assert set(index.holders(spark, parts, part="part")) == set(index.holders(spark, batch))


def test_own_recent_files_are_left_out(spark, store):
    land(spark, store, rows_of(spark, range(5)), writer="me", batch=4)
    index, batch, hour = store.index("events"), rows_of(spark, [1, 2]), F.expr("INTERVAL 1 hour")
    assert index.holders(spark, batch, Landed("me", 5, F.current_timestamp() - hour)) == []
    for other in (Landed("you", 5, F.current_timestamp() - hour), Landed("me", 4, F.current_timestamp() - hour),
                  Landed("me", 5, F.current_timestamp() + hour)):
        assert index.holders(spark, batch, other)


def test_too_many_files_mean_the_whole_table(spark, store, monkeypatch):
    land(spark, store, rows_of(spark, range(40)))
    monkeypatch.setattr("basketstream.operators.membership.MAX_FILES", 1)
    assert store.index("events").holders(spark, rows_of(spark, range(40))) is None
    landed = store.read_landing(spark, "events")
    assert only_files(landed, None) is landed


def test_an_empty_landing_and_an_empty_batch(spark, store):
    index = store.index("events")
    assert index.refresh(spark) == 0 and index.holders(spark, rows_of(spark, [1])) == []
    land(spark, store, rows_of(spark, [1]))
    assert index.holders(spark, rows_of(spark, [1]).where("false")) == []


def test_loads_count_what_they_read(spark, tmp_path):
    root, store = str(tmp_path / "bronze"), Warehouse(str(tmp_path / "warehouse"), BUCKETS)
    for name, ids in (("a.parquet", [1, 2]), ("b.parquet", [2, 3, 4])):
        write_file(spark, root, name, ids)
    done = incremental_load(spark, root, store, "events", batch_files=1)
    assert (done.processed, done.inserted, done.present) == (5, 4, 1)
