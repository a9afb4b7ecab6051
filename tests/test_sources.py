import pytest
from pyspark.sql import functions as F

from basketstream.functions.ids import record_id
from basketstream.operators.envelope import event_type_of
from basketstream.operators.landing import insert_absent
from basketstream.sources import raw

STAMPS = ["11:59:59", "12:00:00", "12:02:00", "12:05:00", "12:04:59"]


@pytest.fixture
def source(spark, tmp_path):
    rows = [(10 * (i + 1), f"2022-09-01 {stamp}", 100 + i) for i, stamp in enumerate(STAMPS)]
    path = str(tmp_path / "add_to_cart.parquet")
    spark.createDataFrame(rows, "client_id bigint, timestamp string, sku bigint").coalesce(1).write.parquet(path)
    return path


def numbers(df):
    return sorted(row["source_row_number"] for row in df.collect())


def test_numbered_scan_keeps_first_rows(spark, source):
    assert numbers(raw.scan_source(spark, source, "add_to_cart.parquet")) == [0, 1, 2, 3, 4]
    first = raw.scan_source(spark, source, "add_to_cart.parquet", limit=2)
    assert [(r["source_row_number"], r["client_id"]) for r in first.collect()] == [(0, 10), (1, 20)]


def test_window_keeps_row_numbers_and_counts_matches(spark, source):
    df = raw.scan_source(spark, source, "add_to_cart.parquet")
    window = ("2022-09-01 12:00:00", "2022-09-01 12:05:00")
    assert numbers(raw.scan_window(df, *window)) == [1, 2, 4]
    assert numbers(raw.scan_window(df, *window, max_selected=2)) == [1, 2]
    with pytest.raises(ValueError):
        raw.scan_window(df, *window, max_selected=0)


def test_window_request_guards():
    raw.check_window_request("page_visit.parquet", None, None)
    with pytest.raises(ValueError):
        raw.check_window_request("page_visit.parquet", "2022-09-01 12:00:00", None)
    with pytest.raises(ValueError):
        raw.check_window_request("product_properties.parquet", "a", "b")


def test_day_filter_reaches_the_scan(spark, source):
    day = raw.day_events(raw.scan_source(spark, source), "2022-09-01")
    plan = day._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(timestamp,2022-09-01 00:00:00)" in plan
    assert day.count() == 5


def test_unreadable_time_inside_the_day_fails(spark):
    rows = [(1, "2022-09-01T10:00:00", 5), (1, None, 5), (1, "2022-09-02 00:00:00", 5)]
    df = spark.createDataFrame(rows, "client_id bigint, timestamp string, sku bigint")
    with pytest.raises(Exception, match="Unreadable source timestamp"):
        raw.day_events(df, "2022-09-01").collect()
    assert raw.day_events(df, "2022-09-02").count() == 1


def test_union_of_typed_tables(spark):
    sku = spark.createDataFrame([(1, 5)], "client_id bigint, sku bigint")
    page = spark.createDataFrame([(2, 7)], "client_id bigint, url bigint")
    rows = raw.all_events({"product_buy": sku, "page_visit": page}).orderBy("client_id").collect()
    assert [(r["event_type"], r["sku"], r["url"]) for r in rows] == [("product_buy", 5, None), ("page_visit", None, 7)]
    with pytest.raises(ValueError):
        raw.all_events({"wishlist": sku})


def test_several_files_keep_rows_apart(spark, tmp_path):
    path = str(tmp_path / "add_to_cart.parquet")
    rows = spark.range(100).select(F.col("id").alias("client_id"), F.lit("2022-09-01 10:00:00").alias("timestamp"), F.lit(5).cast("bigint").alias("sku"))
    rows.repartition(4).write.parquet(path)
    scanned = raw.scan_source(spark, path)
    named = scanned.withColumn("event_id", record_id(F.col("source_file"), F.col("source_row_number")))
    assert named.select("event_id").distinct().count() == 100
    assert named.select(event_type_of(F.col("source_file")).alias("t")).distinct().collect() == [("add_to_cart",)]
    assert insert_absent(named.where("1 = 0").select("event_id"), named, "event_id", ["source_row_number"]).count() == 100
    assert raw.scan_source(spark, path, limit=7).count() == 7
    with pytest.raises(ValueError, match="several files"):
        raw.scan_source(spark, path, "add_to_cart.parquet")


def test_scan_request(spark, source):
    assert numbers(raw.scan_request(spark, source, "add_to_cart.parquet", limit=2)) == [0, 1]
    assert numbers(raw.scan_request(spark, source, "add_to_cart.parquet", "2022-09-01 12:00:00", "2022-09-01 12:05:00", 2)) == [1, 2]
    with pytest.raises(ValueError):
        raw.scan_request(spark, source, "product_properties.parquet", "a", "b")
