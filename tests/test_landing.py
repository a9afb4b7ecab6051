import glob
import hashlib
import json
import os

import pytest
from pyspark.sql import functions as F

from basketstream.operators import landing, parse
from basketstream.operators.quality import QualityError
from basketstream.plans import incremental
from basketstream.plans.incremental import Warehouse, audit_recorded, incremental_load
from basketstream.plans.jobs import bronze_to_analytics
from basketstream.sources import bronze
from test_contract import EVENT, PRODUCT, changed
from test_parse import records


def event(i, **more):
    record = {**EVENT, "client_id": i, "event_id": f"2167e60c-7417-5c99-aac2-{i:012d}", **more}
    return str(i), changed(record, "source.row_number", i)


def bronze_rows(spark, ids):
    return parse.split_valid(parse.transform_events(records(spark, [event(i) for i in ids])))[0]


def write_file(spark, root, name, ids):
    """One bronze file with a chosen name."""
    folder = os.path.join(root, "events")
    os.makedirs(folder, exist_ok=True)
    staging = os.path.join(root, f"_{name}")
    bronze_rows(spark, ids).coalesce(1).write.parquet(staging)
    (part,) = glob.glob(os.path.join(staging, "part-*.parquet"))
    with open(part, "rb") as source, open(os.path.join(folder, name), "wb") as target:
        target.write(source.read())


@pytest.fixture
def root(tmp_path):
    return str(tmp_path / "bronze")


@pytest.fixture
def store(tmp_path):
    return Warehouse(str(tmp_path / "warehouse"))


def test_inventory(spark, root):
    write_file(spark, root, "b.parquet", [1, 2])
    write_file(spark, root, "a.parquet", [3])
    write_file(spark, root, "empty.parquet", [])
    hidden = os.path.join(root, "events", "_temporary")
    os.makedirs(hidden)
    with open(os.path.join(hidden, "x.parquet"), "wb") as f:
        f.write(b"unfinished")
    rows = bronze.bronze_inventory(spark, root, "events").orderBy("relative_path").collect()
    assert [(r["relative_path"], r["row_count"]) for r in rows] == [("a.parquet", 1), ("b.parquet", 2), ("empty.parquet", 0)]
    with open(os.path.join(root, "events", "a.parquet"), "rb") as f:
        content = f.read()
    assert rows[0]["file_sha256"] == hashlib.sha256(content).hexdigest()
    assert rows[0]["file_size_bytes"] == len(content)
    with pytest.raises(ValueError):
        bronze.bronze_inventory(spark, root, "orders")
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        bronze.bronze_inventory(spark, root, "products")


def test_load_in_path_order_then_skip(spark, root, store):
    for name, ids in (("c.parquet", [4]), ("a.parquet", [1, 2]), ("b.parquet", [2, 3])):
        write_file(spark, root, name, ids)
    first = incremental_load(spark, root, store, "events", max_new_files=1)
    assert (first.loaded, first.skipped, first.inserted) == (1, 0, 2)
    second = incremental_load(spark, root, store, "events")
    # Record 2 is in both files and is landed once.
    assert (second.loaded, second.skipped, second.inserted) == (2, 1, 2)
    third = incremental_load(spark, root, store, "events")
    assert (third.loaded, third.skipped, third.inserted) == (0, 3, 0)
    ledger = {r["relative_path"]: (r["row_count"], r["inserted_count"]) for r in store.read_ledger(spark).collect()}
    assert ledger == {"a.parquet": (2, 2), "b.parquet": (2, 1), "c.parquet": (1, 1)}
    assert store.read_landing(spark, "events").count() == 4
    assert landing.landing_violations(store.read_landing(spark, "events"), "events").count() == 0
    assert landing.ledger_violations(store.read_ledger(spark)).count() == 0


def test_changed_and_oversized_files_stop_the_run(spark, root, store):
    write_file(spark, root, "a.parquet", [1])
    write_file(spark, root, "b.parquet", [2, 3])
    write_file(spark, root, "c.parquet", [4])
    with pytest.raises(QualityError, match="b.parquet has too many rows"):
        incremental_load(spark, root, store, "events", max_file_rows=1)
    assert [r["relative_path"] for r in store.read_ledger(spark).collect()] == ["a.parquet"]
    incremental_load(spark, root, store, "events")
    write_file(spark, root, "b.parquet_new", [9])
    with open(os.path.join(root, "events", "b.parquet_new"), "rb") as new:
        content = new.read()
    with open(os.path.join(root, "events", "b.parquet"), "wb") as old:
        old.write(content)
    with pytest.raises(QualityError, match="b.parquet has changed"):
        incremental_load(spark, root, store, "events")
    with pytest.raises(ValueError):
        incremental_load(spark, root, store, "events", max_new_files=0)


def test_retry_after_rows_without_ledger(spark, root, store):
    """A run that died between rows and ledger is completed by the next run."""
    write_file(spark, root, "a.parquet", [1, 2])
    rows = landing.normalize_bronze(bronze_rows(spark, [1, 2]), "events")
    store.append_landing(rows.withColumn("loaded_at_utc", F.current_timestamp()), "events")
    again = incremental_load(spark, root, store, "events")
    assert (again.loaded, again.inserted) == (1, 0)
    assert store.read_landing(spark, "events").count() == 2
    assert store.read_ledger(spark).collect()[0]["inserted_count"] == 0


class Died(Exception):
    pass


def dies(*_):
    raise Died


@pytest.mark.parametrize("at", ["_record", "Loads.publish"])
def test_a_run_that_dies_shows_nothing(spark, root, store, monkeypatch, at):
    write_file(spark, root, "a.parquet", [1, 2])
    incremental_load(spark, root, store, "events")
    write_file(spark, root, "b.parquet", [2, 3])
    with monkeypatch.context() as patched:
        patched.setattr(f"basketstream.plans.incremental.{at}", dies)
        for _ in range(2):
            with pytest.raises(Died):
                incremental_load(spark, root, store, "events")
    assert len(store.loads("events").unpublished(spark)) == 2
    assert sorted(r["client_id"] for r in store.read_landing(spark, "events").collect()) == [1, 2]
    assert [r["relative_path"] for r in store.read_ledger(spark).collect()] == ["a.parquet"]
    assert store.index("events").unknown_files(spark) == []
    again = incremental_load(spark, root, store, "events")
    assert (again.loaded, again.skipped, again.inserted, again.present) == (1, 1, 1, 1)
    assert sorted(r["client_id"] for r in store.read_landing(spark, "events").collect()) == [1, 2, 3]
    assert store.read_ledger(spark).count() == 2 and store.loads("events").latest(spark) == 2


def test_a_run_that_dies_before_its_files_are_indexed_is_whole(spark, root, store, monkeypatch):
    write_file(spark, root, "a.parquet", [1, 2])
    with monkeypatch.context() as patched:
        patched.setattr("basketstream.operators.membership.LandingIndex._enter", dies)
        with pytest.raises(Died):
            incremental_load(spark, root, store, "events")
    assert store.read_landing(spark, "events").count() == 2 and store.read_ledger(spark).count() == 1
    write_file(spark, root, "b.parquet", [2, 3])
    again = incremental_load(spark, root, store, "events")
    assert (again.loaded, again.skipped, again.inserted) == (1, 1, 1)
    assert store.read_landing(spark, "events").count() == 3


def test_of_two_runs_at_once_one_fails(spark, root, store, monkeypatch):
    """The second run starts and ends between the first one's look at the landing and its rows."""
    for name, ids in (("a.parquet", [1, 2]), ("b.parquet", [3])):
        write_file(spark, root, name, ids)
    before, others = incremental._assert_unchanged, []

    def meanwhile(*given):
        before(*given)
        if not others:
            others.append(None)
            others[0] = incremental_load(spark, root, store, "events", batch_files=1)

    monkeypatch.setattr(incremental, "_assert_unchanged", meanwhile)
    with pytest.raises(QualityError, match="Another load has published generation 1"):
        incremental_load(spark, root, store, "events")
    assert (others[0].loaded, others[0].inserted) == (2, 3)
    assert sorted(r["client_id"] for r in store.read_landing(spark, "events").collect()) == [1, 2, 3]
    assert store.read_ledger(spark).count() == 2 and store.loads("events").latest(spark) == 2
    assert incremental_load(spark, root, store, "events").skipped == 2
    # Sources number their loads apart.
    assert store.loads("products").latest(spark) == 0


def test_second_id_for_a_source_row_is_an_error(spark, root, store):
    write_file(spark, root, "a.parquet", [1])
    incremental_load(spark, root, store, "events")
    clash = [("1", changed({**EVENT, "client_id": 1, "event_id": "ffffffff-7417-5c99-aac2-000000000001"}, "source.row_number", 1))]
    rows = parse.split_valid(parse.transform_events(records(spark, clash)))[0]
    rows.write.mode("append").parquet(os.path.join(root, "events"))
    with pytest.raises(QualityError, match="claimed by several ids"):
        incremental_load(spark, root, store, "events")
    assert store.read_landing(spark, "events").count() == 1


def test_normalisation(spark):
    rows = bronze_rows(spark, [1]).withColumns({
        "event_id": F.upper("event_id"), "published_at_utc": F.col("published_at_utc").cast("timestamp_ntz")})
    (row,) = landing.normalize_bronze(rows, "events").collect()
    assert row["event_id"] == "2167e60c-7417-5c99-aac2-000000000001"
    assert dict(landing.normalize_bronze(rows, "events").dtypes)["published_at_utc"] == "timestamp"
    with pytest.raises(TypeError, match="zone-free"):
        landing.normalize_bronze(rows.withColumn("event_time_local", F.col("event_time_local").cast("timestamp")), "events")
    with pytest.raises(TypeError, match="must be a timestamp"):
        landing.normalize_bronze(rows.withColumn("processed_at_utc", F.lit("x")), "events")
    with pytest.raises(Exception, match="is not a UUID"):
        landing.normalize_bronze(rows.withColumn("event_id", F.lit("x")), "events").collect()
    with pytest.raises(ValueError, match="Bronze files lack"):
        bronze.check_columns(rows.drop("sku"), "events")


def test_insert_absent_with_a_hot_key(spark):
    """A third of the batch are copies of one record."""
    rows = [("hot" if i % 3 == 0 else f"k{i}", i) for i in range(300)]
    batch = spark.createDataFrame(rows, "id string, position bigint").repartition(7)
    target = spark.createDataFrame([("k1",), ("k2",)], "id string")
    fresh = landing.insert_absent(target, batch, "id", ["position"])
    got = {row["id"]: row["position"] for row in fresh.collect()}
    assert got["hot"] == 0 and len(got) == 199 and "k1" not in got
    assert "row_number(), 1, Partial" in fresh._jdf.queryExecution().executedPlan().toString()
    (counts,) = landing.insert_counts(target, batch, "id").collect()
    assert tuple(counts) == (300, 199, 101)


def test_bucketed_target_is_not_shuffled(spark):
    rows = spark.range(2000).select(F.sha1(F.col("id").cast("string")).alias("id"))
    table = f"landing_{os.getpid()}"
    landing.save_bucketed(rows, table, "id", 8)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        batch = rows.withColumn("position", F.lit(1))
        fresh = landing.insert_absent(spark.table(table), batch, "id", ["position"])
        plan = fresh._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 1
        assert fresh.count() == 0
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql(f"DROP TABLE {table}")


def test_batches_of_one_give_the_marts_of_one_big_load(spark, root, tmp_path):
    for number in range(4):
        write_file(spark, root, f"{number}.parquet", [3 * number + i for i in range(3)])
    products = records(spark, [("88231", json.dumps(PRODUCT))])
    parse.split_valid(parse.transform_products(products))[0].coalesce(1).write.parquet(os.path.join(root, "products"))
    small, large = Warehouse(str(tmp_path / "small"), 8), Warehouse(str(tmp_path / "large"), 8)
    limited = incremental_load(spark, root, small, "events", max_new_files=1)
    assert (limited.loaded, limited.pending) == (1, 3)
    with pytest.raises(QualityError, match="2 files of events are not loaded"):
        bronze_to_analytics(spark, root, small, max_new_files=1)
    rest = incremental_load(spark, root, small, "events", batch_files=1)
    assert (rest.loaded, rest.skipped, rest.pending) == (2, 2, 0)
    marts = [bronze_to_analytics(spark, root, store)["marts"] for store in (small, large)]
    for name in ("daily_event_activity", "client_prior_day", "client_product_candidates", "feature_snapshot"):
        rows = [sorted(map(str, made[name].collect())) for made in marts]
        assert rows[0] == rows[1] and rows[0], name


def test_listing_reads_no_content_and_audit_finds_silent_changes(spark, root, store):
    write_file(spark, root, "a.parquet", [1])
    path = os.path.join(root, "events", "a.parquet")
    incremental_load(spark, root, store, "events")
    listed = bronze.list_bronze(spark, root, "events")
    assert "content" not in str(listed._jdf.queryExecution().optimizedPlan()).split("Relation")[0]
    times = os.stat(path)
    # Another writer's name of the same length in the footer: same size, same rows, other bytes.
    with open(path, "r+b") as file:
        content = file.read()
        assert content.count(b"parquet-mr") == 1
        file.seek(0)
        file.write(content.replace(b"parquet-mr", b"parquet-mx"))
    os.utime(path, ns=(times.st_atime_ns, times.st_mtime_ns))
    assert incremental_load(spark, root, store, "events").skipped == 1
    assert [r["relative_path"] for r in audit_recorded(spark, root, store, "events").collect()] == ["a.parquet"]


def test_landing_side_of_a_load_is_not_shuffled(spark, root, store):
    write_file(spark, root, "a.parquet", [1, 2])
    incremental_load(spark, root, store, "events")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        batch = landing.normalize_bronze(bronze_rows(spark, [2, 3]), "events").withColumn("_row", F.lit(1))
        fresh = landing.insert_absent(store.read_landing(spark, "events"), batch, "event_id", ["_row"])
        plan = fresh._jdf.queryExecution().executedPlan().toString()
        # The landing scan is the last leaf; every shuffle belongs to the batch above it.
        assert "SelectedBucketsCount: 64 out of 64" in plan[plan.rindex("FileScan"):]
        assert plan.rindex("Exchange") < plan.index("Scan ExistingRDD") and fresh.count() == 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_bronze_to_analytics(spark, root, store):
    write_file(spark, root, "a.parquet", [1, 2, 3])
    products = records(spark, [("88231", json.dumps(PRODUCT))])
    parse.split_valid(parse.transform_products(products))[0].write.parquet(os.path.join(root, "products"))
    done = bronze_to_analytics(spark, root, store)
    assert done["loads"]["events"].inserted == 3 and done["loads"]["products"].inserted == 1
    assert done["marts"]["feature_snapshot"].count() == 3
    assert done["checks"].where("offending_rows > 0").count() == 0


def replace_file(root, name, rows):
    """A bronze file of given rows under a chosen name."""
    staging = os.path.join(root, f"_rows_{name}")
    rows.coalesce(1).write.parquet(staging)
    (part,) = glob.glob(os.path.join(staging, "part-*.parquet"))
    os.makedirs(os.path.join(root, "events"), exist_ok=True)
    os.replace(part, os.path.join(root, "events", name))


def test_small_batches_share_their_jobs_and_stay_loads_of_their_own(spark, root, store, monkeypatch):
    """The jobs of a batch take as long for one file as for many: a load in small batches must not repeat them for each."""
    for name, ids in (("a.parquet", [1, 2]), ("b.parquet", [2, 3]), ("c.parquet", [3, 1, 4]), ("d.parquet", [5])):
        write_file(spark, root, name, ids)
    calls, insert = [], incremental.insert_absent
    monkeypatch.setattr(incremental, "insert_absent", lambda *given: calls.append(None) or insert(*given))
    done = incremental_load(spark, root, store, "events", batch_files=1)
    assert (done.loaded, done.inserted, done.processed, len(calls)) == (4, 5, 8, 1)
    # A record stays with the first file that has it, and every batch has its own generation, rows and ledger entry.
    ledger = {r["relative_path"]: r["inserted_count"] for r in store.read_ledger(spark).collect()}
    assert ledger == {"a.parquet": 2, "b.parquet": 1, "c.parquet": 1, "d.parquet": 1}
    assert store.loads("events").latest(spark) == 4 and store.loads("events").unpublished(spark) == []
    rows = spark.read.parquet(store.landing("events")).groupBy("load").agg(F.sort_array(F.collect_list("client_id")).alias("ids")).collect()
    assert sorted(r["ids"] for r in rows) == [[1, 2], [3], [4], [5]]
    assert spark.read.parquet(store.ledger).select("load").distinct().count() == 4
    assert store.index("events").unknown_files(spark) == []
    # A later load finds what they hold, and a limit cuts within a group.
    for name, ids in (("e.parquet", [5, 6]), ("f.parquet", [1, 7]), ("g.parquet", [8])):
        write_file(spark, root, name, ids)
    more = incremental_load(spark, root, store, "events", max_new_files=2, batch_files=1)
    assert (more.loaded, more.skipped, more.inserted, more.pending) == (2, 4, 2, 1)


def test_a_run_that_dies_between_the_loads_of_a_group_shows_whole_batches(spark, root, store, monkeypatch):
    for name, ids in (("a.parquet", [1, 2]), ("b.parquet", [2, 3]), ("c.parquet", [4])):
        write_file(spark, root, name, ids)
    publish = incremental.Loads.publish
    with monkeypatch.context() as patched:
        patched.setattr("basketstream.plans.incremental.Loads.publish",
                        lambda loads, spark, number, load: publish(loads, spark, number, load) if number < 2 else dies())
        with pytest.raises(Died):
            incremental_load(spark, root, store, "events", batch_files=1)
    assert sorted(r["client_id"] for r in store.read_landing(spark, "events").collect()) == [1, 2]
    assert [r["relative_path"] for r in store.read_ledger(spark).collect()] == ["a.parquet"]
    again = incremental_load(spark, root, store, "events", batch_files=1)
    assert (again.loaded, again.skipped, again.inserted) == (2, 1, 2)
    assert sorted(r["client_id"] for r in store.read_landing(spark, "events").collect()) == [1, 2, 3, 4]


@pytest.mark.parametrize("harm", ["rule", "file"])
def test_a_broken_batch_fails_alone(spark, root, store, harm):
    """Those before it are loaded, though they were read together with it."""
    for name, ids in (("a.parquet", [1, 2]), ("b.parquet", [3]), ("d.parquet", [4])):
        write_file(spark, root, name, ids)
    if harm == "rule":
        replace_file(root, "c.parquet", bronze_rows(spark, [9]).withColumn("client_id", -F.col("client_id")))
    else:
        with open(os.path.join(root, "events", "c.parquet"), "wb") as file:
            file.write(b"no parquet")
    with pytest.raises(Exception, match="client_id_negative" if harm == "rule" else "c.parquet"):
        incremental_load(spark, root, store, "events", batch_files=1)
    assert sorted(r["relative_path"] for r in store.read_ledger(spark).collect()) == ["a.parquet", "b.parquet"]
    assert sorted(r["client_id"] for r in store.read_landing(spark, "events").collect()) == [1, 2, 3]


def test_batches_of_other_schemas_are_read_by_their_own(spark, root, store):
    write_file(spark, root, "a.parquet", [1])
    replace_file(root, "b.parquet", bronze_rows(spark, [2]).withColumn("published_at_utc", F.col("published_at_utc").cast("timestamp_ntz")))
    replace_file(root, "c.parquet", bronze_rows(spark, [3]).drop("query_vector_raw"))
    with pytest.raises(ValueError, match="Bronze files lack"):
        incremental_load(spark, root, store, "events", batch_files=1)
    assert sorted(r["client_id"] for r in store.read_landing(spark, "events").collect()) == [1, 2]
    assert store.read_landing(spark, "events").select("published_at_utc").distinct().count() == 1


def test_index_entry_is_not_drawn_into_one_task(spark, tmp_path, monkeypatch):
    """A coalesced write would make the counts per landing file the work of a single task."""
    store = Warehouse(str(tmp_path / "store"), buckets=4)
    rows = landing.normalize_bronze(bronze_rows(spark, range(20)), "events").withColumn("loaded_at_utc", F.current_timestamp())
    store.append_landing(rows, "events")
    called = []
    monkeypatch.setattr(type(spark.range(1)), "coalesce", lambda df, n: called.append(n))
    assert store.index("events").refresh(spark) == 4
    assert not called
    assert store.index("events").zones(spark).agg(F.sum("rows")).first()[0] == 20


def test_a_batch_is_not_broadcast(spark, tmp_path):
    """Its ids and source rows would pass the driver with every load."""
    from basketstream.operators.quality import new_source_row_conflicts

    rows = landing.normalize_bronze(bronze_rows(spark, range(20)), "events")
    foreign = spark.createDataFrame([("a", "b", "c", 1, "d")], "event_id string, source_dataset string, source_file string, source_row_number bigint, path string")
    plan = new_source_row_conflicts(rows.limit(3), rows, "event_id", foreign)._jdf.queryExecution().executedPlan().toString()
    joins = [line for line in plan.splitlines() if "LeftSemi" in line]
    assert joins and not any("BroadcastHashJoin" in line for line in joins)
