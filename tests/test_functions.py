import uuid
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from basketstream import fixed_values as fixed
from basketstream.functions import checks, ids, prefix, times


def one(spark, column):
    return spark.range(1).select(column.alias("x")).collect()[0]["x"]


def test_uuid5_equals_standard_library(spark):
    names = ["add_to_cart.parquet:0", "dlq:page_visit.parquet:17", "é:1", ""]
    rows = spark.createDataFrame([(name,) for name in names], "name string")
    made = rows.select("name", ids.uuid5(F.col("name")).alias("id")).collect()
    space = uuid.UUID(fixed.ID_NAMESPACE)
    assert {row["name"]: row["id"] for row in made} == {name: str(uuid.uuid5(space, name)) for name in names}


def test_record_id_golden_and_negative_row(spark):
    assert one(spark, ids.record_id(F.lit("add_to_cart.parquet"), F.lit(0))) == "2167e60c-7417-5c99-aac2-ad2db74dab4a"
    assert one(spark, ids.record_id(F.lit("add_to_cart.parquet"), F.lit(-1))) is None


def test_uuid_predicate_takes_any_case(spark):
    assert one(spark, ids.is_uuid(F.lit("5B0C3F52-8E1D-4F7A-B6A4-0D9E27C1F883")))
    assert not one(spark, ids.is_uuid(F.lit("123-abc")))


def test_utc_text_truncates_and_refuses_naive(spark):
    instant = datetime(2031, 3, 5, 6, 7, 8, 999999, tzinfo=timezone.utc)
    assert one(spark, times.utc_literal(instant)) == "2031-03-05T06:07:08Z"
    with pytest.raises(ValueError):
        times.utc_literal(datetime(2031, 3, 5))


def test_event_time_error(spark):
    """One good time, and that time with one part damaged at a time."""
    good = "2031-10-07 23:05:59"
    wrong_form = [good.replace(" ", "T"), good.replace("-0", "-"), good[:-3], good + "\n", " " + good, good + "Z", ""]
    wrong_date = [good.replace("-10-", "-13-"), good.replace("-10-07", "-11-31"), good.replace(" 23", " 24"), good.replace(":05:", ":60:"),
                  good.replace("-10-07", "-00-07")]
    want = {good: None, **dict.fromkeys(wrong_form, fixed.MSG_TIME_FORMAT), **dict.fromkeys(wrong_date, fixed.MSG_TIME_CALENDAR)}
    rows = spark.createDataFrame([(text,) for text in [*want, None]], "text string").select("text", checks.event_time_error(F.col("text")).alias("error")).collect()
    assert {r["text"]: r["error"] for r in rows} == {**want, None: "timestamp must be a string"}


@pytest.mark.parametrize("start,end", [
    ("2022-9-1 12:00:00", "2022-09-02 00:00:00"),
    ("2022-09-02 00:00:00", "2022-09-02 00:00:00"),
    ("2022-09-03 00:00:00", "2022-09-02 00:00:00"),
])
def test_window_guard(start, end):
    with pytest.raises(ValueError):
        times.check_window(start, end)


@pytest.mark.parametrize("buckets", [1, 2, 7, 50])
def test_running_totals_do_not_depend_on_buckets(spark, buckets):
    rows = [(float(i) / 97, i % 5) for i in range(300)]
    df = spark.createDataFrame(rows, "score double, n bigint")
    got = {row["score"]: row["n_through"] for row in prefix.running_totals_desc(df, "score", ["n"], buckets).collect()}
    total, want = 0, {}
    for score, n in sorted(rows, reverse=True):
        total += n
        want[score] = total
    assert got == want


def test_running_totals_of_nothing(spark):
    df = spark.createDataFrame([], "score double, n bigint")
    assert prefix.running_totals_desc(df, "score", ["n"]).count() == 0


def test_quick_times_are_the_strict_ones(spark):
    from basketstream import fixed_values as fixed
    from basketstream.functions.times import published_time, source_time

    texts = ["2024-02-29 23:59:59", "2023-02-29 00:00:00", "2024-13-01 00:00:00", "2024-01-01 24:00:00", "2024-01-01 00:00:60", "0000-01-01 00:00:00",
             "0001-01-01 00:00:00", "9999-12-31 23:59:59", "2024-1-1 00:00:00", "2024-01-01 00:00:00\n", " 2024-01-01 00:00:00", "2024-01-01T00:00:00", "1582-10-10 00:00:00",
             "+12024-01-01 00:00:00", "", None]
    texts += [t and t.replace(" ", "T") + zone for t in texts for zone in ("Z", "+08:00", "+08", "z", "")]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    strict = [F.try_to_timestamp("text", F.lit(form)) for form in (fixed.SOURCE_TIME_FORMAT, fixed.PUBLISHED_FORMAT)]
    for row in df.select("text", source_time(F.col("text")).cast("string").alias("a"), strict[0].cast("timestamp_ntz").cast("string").alias("b"),
                         published_time(F.col("text")).cast("string").alias("c"), strict[1].cast("string").alias("d")).collect():
        assert (row.a, row.c) == (row.b, row.d), row
