from collections import Counter, defaultdict
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from basketstream import fixed_values as fixed
from basketstream.session import prepare
from basketstream.operators import features, marts, profile, quality
from basketstream.operators.quality import QualityError

EVENTS = "event_type string, client_id bigint, sku bigint, event_time timestamp_ntz"


def at(text):
    return datetime.fromisoformat(f"2022-{text}")


GOLDEN = [
    ("add_to_cart", 7, 70, at("04-10 08:00:00")), ("add_to_cart", 7, 71, at("04-10 09:30:00")),
    ("remove_from_cart", 7, 70, at("04-10 10:00:00")), ("product_buy", 7, 71, at("04-10 20:15:00")),
    ("add_to_cart", 8, 70, at("04-10 06:45:00")),
    ("page_visit", 7, None, at("04-10 21:00:00")), ("page_visit", 8, None, at("04-10 05:00:00")),
    ("page_visit", 8, None, at("04-10 05:30:00")), ("search_query", 8, None, at("04-10 07:15:00")),
    ("search_query", 9, None, at("04-10 12:00:00")),
]
OTHER_DAYS = [("add_to_cart", 7, 90, at("04-11 00:00:00")), ("product_buy", 8, 70, at("04-09 23:59:59"))]


def frame(spark, rows):
    return spark.createDataFrame(rows, EVENTS)


def test_snapshot_golden(spark):
    rows = features.offline_snapshot(frame(spark, GOLDEN)).orderBy("client_id", "sku").collect()
    day = date(2022, 4, 11)
    assert [tuple(row) for row in rows] == [
        (day, 7, 70, 5, 1, 0, 2, 1, 1, 2, 2, 1, 1, 0, 3.0, 14.0),
        (day, 7, 71, 5, 1, 0, 2, 1, 1, 2, 2, 1, 0, 1, 3.0, 3.75),
        (day, 8, 70, 4, 2, 1, 1, 0, 0, 1, 1, 1, 0, 0, 16.75, 17.25),
    ]
    assert rows[0].__fields__ == [*fixed.SNAPSHOT_KEYS, *fixed.COUNT_FEATURES, *fixed.RECENCY_FEATURES]


def test_all_days_equal_single_days(spark):
    together = features.offline_snapshot(frame(spark, GOLDEN + OTHER_DAYS))
    assert together.count() == 5
    day = together.where("feature_as_of_date_source = date'2022-04-11'")
    assert day.exceptAll(features.offline_snapshot(frame(spark, GOLDEN))).count() == 0
    # Browsing can come as its own table.
    events = frame(spark, GOLDEN)
    split = features.offline_snapshot(events.where("sku is not null"), events.where("sku is null"))
    assert split.exceptAll(features.offline_snapshot(events)).count() == 0


def test_unnamed_rows_are_skipped_and_counted(spark):
    extra = [("add_to_cart", None, 5, at("09-01 01:00:00")), ("product_buy", 4, None, at("09-01 01:00:00")),
             ("page_visit", None, None, at("09-01 01:00:00"))]
    events = frame(spark, GOLDEN + extra)
    assert features.offline_snapshot(events).count() == 3
    got = {row["measure"]: row["value"] for row in features.snapshot_summary(events).collect()}
    assert got == {"feature_rows": 3, "distinct_clients": 2, "sku_interactions": 5, "skipped_sku_rows": 2}


def test_empty_snapshot_keeps_its_schema(spark):
    empty = features.offline_snapshot(frame(spark, []))
    assert empty.count() == 0 and len(empty.columns) == 16


PAIRS = "feature_as_of_date_source date, client_id bigint, sku bigint"
PURCHASES = [
    (4, 41, "05-19 23:59:59"), (4, 41, "05-22 06:30:00"), (4, 41, "05-21 18:00:00"),
    (5, 52, "05-27 00:00:00"), (6, 63, "05-26 23:00:00"), (5, 41, "05-21 00:00:00"),
]


def label_input(spark, as_of=date(2022, 5, 20)):
    snapshot = spark.createDataFrame([(as_of, 4, 41), (as_of, 5, 52), (as_of, 6, 63)], PAIRS)
    bought = frame(spark, [("product_buy", client, sku, at(text)) for client, sku, text in PURCHASES])
    return snapshot, bought


@pytest.mark.parametrize("as_of", [None, date(2022, 5, 20)])
def test_labels_golden(spark, as_of):
    snapshot, bought = label_input(spark)
    rows = features.purchase_labels(snapshot, bought, as_of).orderBy("client_id").collect()
    end = datetime(2022, 5, 27)
    assert [tuple(row)[3:] for row in rows] == [
        (True, datetime(2022, 5, 21, 18), 42.0, end),
        (False, None, None, end),
        (True, datetime(2022, 5, 26, 23), 167.0, end),
    ]
    got = {row["measure"]: row["value"] for row in features.label_summary(snapshot, bought, as_of).collect()}
    assert got == {"label_rows": 3, "matching_purchase_rows": 3, "pairs_with_purchase": 2, "pairs_without_purchase": 1}


def raw_purchases(spark, bought, bad=()):
    stamped = bought.select("client_id", "sku", F.date_format("event_time", fixed.SOURCE_TIME_FORMAT).alias("timestamp"))
    return stamped.unionByName(spark.createDataFrame(list(bad), "client_id bigint, sku bigint, timestamp string"))


def test_label_guards(spark):
    snapshot, bought = label_input(spark)
    day = date(2022, 5, 20)
    assert features.build_labels(snapshot, raw_purchases(spark, bought), day).where("purchase_observed_within_7d").count() == 2
    # A bad time of a pair that is no candidate does not matter, of a candidate it always does.
    assert features.build_labels(snapshot, raw_purchases(spark, bought, [(9, 9, "bad")]), day).count() == 3
    for bad in ("bad", None, "2021-1-1 00:00:00"):
        with pytest.raises(QualityError, match="cannot be read"):
            features.build_labels(snapshot, raw_purchases(spark, bought, [(5, 52, bad)]), day)
    with pytest.raises(QualityError, match="no rows"):
        features.build_labels(snapshot.where("false"), raw_purchases(spark, bought), day)
    with pytest.raises(QualityError, match="repeats"):
        features.build_labels(snapshot.unionAll(snapshot), raw_purchases(spark, bought), day)
    other, _ = label_input(spark, date(2022, 5, 21))
    with pytest.raises(QualityError, match="exactly one"):
        features.build_labels(snapshot.unionAll(other), raw_purchases(spark, bought), day)
    assert features.build_labels(snapshot.unionAll(other), raw_purchases(spark, bought)).count() == 6
    # Labels of another date than the snapshot's are refused, by the guard and by the plan itself.
    with pytest.raises(QualityError, match="of another date"):
        features.build_labels(snapshot, raw_purchases(spark, bought), date(2022, 5, 21))
    with pytest.raises(Exception, match="Snapshot row of another date"):
        features.purchase_labels(snapshot, bought, date(2022, 5, 21)).collect()


def test_hot_client_is_split(spark):
    """One client holds most pairs: adaptive execution splits its partition of the snapshot join."""
    rows = spark.range(60000).select(
        F.lit("add_to_cart").alias("event_type"), F.when(F.col("id") < 55000, 1).otherwise(F.col("id")).alias("client_id"),
        F.col("id").alias("sku"), F.lit("2022-09-01 10:00:00").cast("timestamp_ntz").alias("event_time"))
    browsing = rows.where("sku % 10 = 0").withColumn("event_type", F.lit("page_visit")).withColumn("sku", F.lit(None).cast("bigint"))
    small = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
             "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
             "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    for key, value in small.items():
        spark.conf.set(key, value)
    try:
        snapshot = features.offline_snapshot(rows.unionByName(browsing).repartition(8))
        assert len(snapshot.collect()) == 60000
        assert "skew=true" in snapshot._jdf.queryExecution().executedPlan().toString()
    finally:
        for key in small:
            spark.conf.unset(key)
        prepare(spark)


def test_write_once(spark, tmp_path):
    snapshot = features.offline_snapshot(frame(spark, GOLDEN + OTHER_DAYS))
    path = str(tmp_path / "snapshot")
    features.write_once(snapshot, path, by_date=True)
    stored = spark.read.parquet(path)
    assert stored.select(snapshot.columns).exceptAll(snapshot).count() == 0
    day = stored.where("feature_as_of_date_source = date'2022-04-11'")
    assert "PartitionFilters: [isnotnull(feature_as_of_date_source" in day._jdf.queryExecution().executedPlan().toString()
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        features.write_once(snapshot, path)


def brute_force(rows):
    """Snapshot and labels by plain loops over the same events."""
    pairs, clients, skus, last_pair, last_client = Counter(), Counter(), defaultdict(set), {}, {}
    for kind, client, sku, when in rows:
        day = when.date() + timedelta(days=1)
        if sku is not None:
            pairs[day, client, sku] += 1
            skus[day, client].add(sku)
            last_pair[day, client, sku] = max(when, last_pair.get((day, client, sku), when))
        clients[day, client, kind] += 1
        last_client[day, client] = max(when, last_client.get((day, client), when))
    found = {}
    for (day, client, sku), n in pairs.items():
        start = datetime.combine(day, datetime.min.time())
        bought = [w for k, c, s, w in rows if (k, c, s) == ("product_buy", client, sku) and start <= w < start + timedelta(days=7)]
        total = sum(v for (d, c, _), v in clients.items() if (d, c) == (day, client))
        found[day, client, sku] = (n, total, len(skus[day, client]),
                                   (start - last_client[day, client]).total_seconds() / 3600, min(bought, default=None))
    return found


def test_hot_client_and_pair_against_brute_force(spark):
    """One client and one pair hold well over a third of all rows."""
    kinds = [*fixed.SKU_EVENT_TYPES, "page_visit"]
    rows = []
    for i in range(1500):
        kind = kinds[i % 4]
        client = 1 if i % 5 < 3 else i % 7
        sku = None if kind == "page_visit" else (10 if i % 5 < 2 else i % 11)
        rows.append((kind, client, sku, at("09-01 00:00:00") + timedelta(minutes=17 * i)))
    events = frame(spark, rows)
    snapshot = features.offline_snapshot(events)
    labels = features.purchase_labels(snapshot, events.where("event_type = 'product_buy'"))
    joined = snapshot.join(labels, fixed.SNAPSHOT_KEYS)
    got = {
        (r["feature_as_of_date_source"], r["client_id"], r["sku"]): (
            r["sku_interactions_previous_day"], r["events_previous_day"], r["distinct_skus_previous_day"],
            r["hours_since_last_client_event"], r["first_purchase_at_source"])
        for r in joined.collect()
    }
    assert got == brute_force(rows)


def test_labels_of_all_dates_repeat_no_purchase(spark):
    """Purchases and candidates meet as one row per pair and day, not once per date of a window."""
    rows = [("product_buy", 1, 10, at("09-01 08:00:00") + timedelta(hours=7 * i)) for i in range(60)]
    rows += [("add_to_cart", 1, 10, at("09-08 00:00:00")), ("product_buy", 1, None, at("09-02 08:00:00")), ("product_buy", 1, 10, None)]
    bought = frame(spark, rows).where("event_type = 'product_buy'")
    days = [date(2022, 8, 25) + timedelta(days=i) for i in range(30)]
    # Repeated rows stay repeated; null keys and pairs never bought have no purchases.
    keys = [(day, 1, 10) for day in days] + [(days[9], 1, 10), (days[9], 1, None), (days[9], None, None), (days[9], 2, 10), (None, 1, 10)]
    labelled = features.labelled_pairs(spark.createDataFrame(keys, PAIRS), bought)

    def expected(day, client, sku):
        start = day and datetime.combine(day, datetime.min.time())
        found = [w for kind, c, s, w in rows if day and w and (kind, c, s) == ("product_buy", client, sku) and start <= w < start + timedelta(days=7)]
        return day, client, sku, min(found, default=None), len(found) or None

    assert Counter(map(tuple, labelled.collect())) == Counter(expected(*key) for key in keys)
    plan = labelled._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and "Join" not in plan


LANDED = "event_id string, event_type string, client_id bigint, sku bigint, event_time_local timestamp_ntz"


@pytest.fixture
def staged(spark):
    return spark.createDataFrame([(str(i), *row) for i, row in enumerate(GOLDEN + OTHER_DAYS)], LANDED)


def test_marts(spark, staged):
    daily = {(r[0], r[1]): (r[2], r[3]) for r in marts.daily_event_activity(staged).collect()}
    assert daily[date(2022, 4, 10), "page_visit"] == (3, 2)
    assert daily[date(2022, 4, 10), "add_to_cart"] == (3, 2)
    snapshot = marts.feature_snapshot_all(staged)
    offline = features.offline_snapshot(staged.withColumnRenamed("event_time_local", "event_time"))
    shared = [*fixed.SNAPSHOT_KEYS, *fixed.COUNT_FEATURES]
    assert snapshot.select(shared).exceptAll(offline.select(shared)).count() == 0
    assert snapshot.count() == offline.count()


def test_checks(spark, staged):
    daily = marts.daily_event_activity(staged)
    assert quality.total_mismatch(staged, daily, "event_count").count() == 0
    (row,) = quality.total_mismatch(staged, daily.where("event_type <> 'page_visit'"), "event_count").collect()
    assert (row["staged_events"], row["summed_events"]) == (12, 9)
    pairs, snapshot = marts.client_product_candidates(staged), marts.feature_snapshot_all(staged)
    assert quality.snapshot_integrity(pairs, snapshot).count() == 0
    assert quality.snapshot_integrity(pairs, snapshot.where("sku <> 71")).count() == 1
    assert quality.snapshot_integrity(pairs.where("sku <> 71"), snapshot).count() == 1
    status = quality.status({"good": pairs.where("false"), "bad": pairs})
    with pytest.raises(QualityError, match="bad=5"):
        quality.require_zero(status)
    quality.require_zero(status.where("check_name = 'good'"))
    nulls = {r["column_name"]: r["null_rows"] for r in quality.null_counts(staged, ["sku", "client_id"]).collect()}
    assert nulls == {"sku": 5, "client_id": 0}


def test_schema_and_manifest(spark):
    df = spark.createDataFrame([(1, "a")], "client_id bigint, timestamp string")
    assert profile.schema_mismatches(df, {"client_id": "bigint", "timestamp": "string"}) == []
    assert profile.schema_mismatches(df, {"client_id": "int", "sku": "bigint"}) == ["client_id", "sku", "timestamp"]
    counts = spark.createDataFrame([("a", 1), ("b", 2)], "source_file string, row_count bigint")
    same = spark.createDataFrame([("a", 1), ("b", 2)], "source_file string, expected_rows bigint")
    assert profile.validate_source(counts, same).count() == 0
    other = spark.createDataFrame([("a", 1), ("c", 2)], "source_file string, expected_rows bigint")
    assert {r["source_file"] for r in profile.validate_source(counts, other).collect()} == {"b", "c"}


def test_rebuild_touches_the_affected_dates_only(spark, tmp_path):
    """Late rows of one day: the tables equal a full build, and the files of all other dates are the old ones."""
    import os

    rows = [(kind, client, sku, datetime(2022, 4, day, 8 + client)) for day in range(1, 21) for client in (1, 2) for sku in (5, 6)
            for kind in ("add_to_cart", "product_buy") if (day + client + sku) % 3]
    late = [("product_buy", 1, 5, datetime(2022, 4, 10, 23)), ("add_to_cart", 3, 6, datetime(2022, 4, 10, 1)), ("page_visit", 1, None, datetime(2022, 4, 10, 2))]
    paths = [str(tmp_path / name) for name in ("snapshot", "labels")]

    def build(events, out):
        features.write_once(features.offline_snapshot(events), out[0], by_date=True)
        bought = events.where("event_type = 'product_buy'")
        features.write_once(features.purchase_labels(spark.read.parquet(out[0]), bought), out[1], by_date=True)

    def files(path):
        return {(d, f) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}

    build(frame(spark, rows), paths)
    before = [files(path) for path in paths]
    changed = spark.createDataFrame([(date(2022, 4, 10),)], "day date")
    features.rebuild_affected(frame(spark, rows + late), changed, *paths)
    whole = [str(tmp_path / name) for name in ("all-snapshot", "all-labels")]
    build(frame(spark, rows + late), whole)
    for path, full, old, dates in zip(paths, whole, before, ({11}, {4, 5, 6, 7, 8, 9, 10, 11})):
        kept = spark.read.parquet(path)
        assert sorted(map(str, kept.collect())) == sorted(map(str, spark.read.parquet(full).select(*kept.columns).collect()))
        new = {d.rsplit("=", 1)[1] for d, _ in files(path) - old}
        assert new == {f"2022-04-{day:02d}" for day in dates}
    features.rebuild_affected(frame(spark, rows), changed.where("false"), *paths)
    assert [spark.read.parquet(p).count() for p in paths] == [spark.read.parquet(p).count() for p in whole]


def test_sources_are_held_against_manifest_and_schemas(spark):
    one, two = spark.createDataFrame([(1, "x")], "id bigint, at string"), spark.createDataFrame([], "id int, more double")
    manifest = spark.createDataFrame([("one", 1), ("three", 2)], "source_file string, expected_rows bigint")
    found = profile.validate_sources({"one": one, "two": two}, manifest, {"one": {"id": "bigint", "at": "string"}, "two": {"id": "bigint", "at": "date"}})
    assert {tuple(r) for r in found.collect()} == {
        ("three", "row_count", None, "2", None), ("two", "row_count", None, None, "0"), ("total", "row_count", None, "3", "1"),
        ("two", "column", "id", "bigint", "int"), ("two", "column", "at", "date", None), ("two", "column", "more", None, "double")}
    assert profile.validate_sources({"one": one}, manifest.where("expected_rows = 1"), {"one": dict(one.dtypes)}).count() == 0
