"""Daily counts kept by load, and windows of any length, against plain Python."""

import datetime as dt
import random

from pyspark.sql import functions as F

from basketstream.operators import features, marts
from basketstream.operators.daily_counts import DailyCounts

START = dt.datetime(2024, 1, 1)


def events(spark, rows):
    return spark.createDataFrame(rows, "client_id bigint, sku bigint, event_type string, event_time_local timestamp_ntz")


def test_every_load_gives_the_mart_of_a_full_rebuild(spark, tmp_path):
    draw = random.Random(1)
    # A third of all rows are one client's, ids are far apart, and some rows name no client.
    make = lambda: (draw.choice([7, draw.randrange(1 << 60), draw.randrange(40) << 40, None]), 1, draw.choice(["page_visit", "product_buy"]),
                    START + dt.timedelta(hours=draw.randrange(72)))
    counts, loads = DailyCounts(str(tmp_path / "counts")), {}
    for load in ("a", "b", "b", "c"):
        if load not in loads:
            loads[load] = [make() for _ in range(400)]
        counts.update(events(spark, loads[load]).repartition(5), load)
        whole = events(spark, [row for rows in loads.values() for row in rows])
        want = sorted(map(tuple, marts.daily_event_activity(whole).collect()))
        assert sorted(map(tuple, counts.mart(spark).collect())) == want
    small = DailyCounts(str(tmp_path / "compact"))
    counts.compact(spark, small)
    assert sorted(map(tuple, small.mart(spark).collect())) == want
    assert small.parts(spark).count() <= counts.parts(spark).count()


def test_no_rows(spark, tmp_path):
    counts = DailyCounts(str(tmp_path / "counts"))
    counts.update(events(spark, []), "a")
    assert counts.mart(spark).collect() == []


def test_windows_of_any_length(spark):
    draw = random.Random(2)
    at = lambda: START + dt.timedelta(minutes=draw.randrange(6000))
    bought = [(draw.choice([1, 2]), draw.choice([5, 6]), "product_buy", at()) for _ in range(60)]
    bought += [(9, 9, "product_buy", START + dt.timedelta(seconds=i)) for i in range(500)]  # a hot pair
    pairs = [(draw.choice([1, 2, 3]), draw.choice([5, 6]), draw.choice([bought[0][3], at()])) for _ in range(50)]
    pairs += [(9, 9, START), (9, 9, START + dt.timedelta(seconds=499)), (9, 9, START + dt.timedelta(seconds=500)), (None, 5, START), (1, 5, None), (1, 5, START), (1, 5, START)]
    purchases = events(spark, bought).withColumnRenamed("event_time_local", "event_time")
    given = spark.createDataFrame(pairs, "client_id bigint, sku bigint, begin timestamp_ntz")
    for length, delta in (("36 hours", dt.timedelta(hours=36)), ("90 minutes", dt.timedelta(minutes=90)), ("7 days", dt.timedelta(days=7))):
        found = features.window_outcomes(given, purchases, "begin", length)
        want = []
        for client, sku, begin in pairs:
            inside = [] if begin is None else [t for c, s, _, t in bought if (c, s) == (client, sku) and begin <= t < begin + delta]
            want.append((client, sku, begin, len(inside), min(inside, default=None)))
        assert sorted(map(tuple, found.collect()), key=str) == sorted(want, key=str)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan


def test_a_client_is_numbered_once(spark, tmp_path):
    counts = DailyCounts(str(tmp_path / "counts"))
    for load in "ab":
        counts.update(events(spark, [(c, 1, "page_visit", START) for c in range(100)]), load)
    assert counts.clients(spark).count() == 100
    assert counts.mart(spark).select(F.sum("event_count"), F.sum("distinct_clients")).first()[:] == (200, 100)
