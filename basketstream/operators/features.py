"""Offline client-product snapshots and seven-day purchase labels.

Both work for one day or for every day in one pass: the as-of date is a key.
"""

from datetime import timedelta

from pyspark.sql import DataFrame, Window as W, functions as F

from basketstream.fixed_values import (
    COUNT_FEATURES, LABEL_DAYS, RECENCY_FEATURES, SKU_EVENT_TYPES, SNAPSHOT_KEYS,
)
from basketstream.functions.times import as_date, hours_between, midnight, source_time
from basketstream.operators.marts import join_clients, of_type
from basketstream.operators.quality import QualityError
from basketstream.session import cut_lineage

AS_OF = "feature_as_of_date_source"


def sku_events(events: DataFrame) -> DataFrame:
    """Product events that name both a client and a product."""
    named = F.col("client_id").isNotNull() & F.col("sku").isNotNull()
    return events.where(F.col("event_type").isin(SKU_EVENT_TYPES) & named)


def _as_of():
    return F.date_add(F.to_date("event_time"), 1)


def candidate_pairs(events: DataFrame) -> DataFrame:
    """Per as-of date and pair: interactions by type and the last one's time."""
    return sku_events(events).groupBy(_as_of().alias(AS_OF), "client_id", "sku").agg(
        F.count("*").alias("sku_interactions_previous_day"),
        of_type("add_to_cart").alias("sku_cart_additions_previous_day"),
        of_type("remove_from_cart").alias("sku_cart_removals_previous_day"),
        of_type("product_buy").alias("sku_purchases_previous_day"),
        F.max("event_time").alias("_last_sku_event"),
    )


def _client_sku_totals(pairs: DataFrame) -> DataFrame:
    """Client totals out of the pair rows; one pair row is one distinct product."""
    return pairs.groupBy(AS_OF, "client_id").agg(
        F.sum("sku_interactions_previous_day").alias("_sku_events"),
        F.sum("sku_cart_additions_previous_day").alias("client_cart_additions_previous_day"),
        F.sum("sku_cart_removals_previous_day").alias("client_cart_removals_previous_day"),
        F.sum("sku_purchases_previous_day").alias("client_purchases_previous_day"),
        F.count("*").alias("distinct_skus_previous_day"),
        F.max("_last_sku_event").alias("_last_sku_side"),
    )


def _client_browsing(events: DataFrame) -> DataFrame:
    browsing = F.col("event_type").isin("page_visit", "search_query") & F.col("client_id").isNotNull()
    return events.where(browsing).groupBy(_as_of().alias(AS_OF), "client_id").agg(
        of_type("page_visit").alias("page_visits_previous_day"),
        of_type("search_query").alias("search_previous_day"),
        F.max("event_time").alias("_last_browsing"),
    )


def offline_snapshot(events: DataFrame, browsing: DataFrame | None = None) -> DataFrame:
    """Snapshot rows of every day in ``events``: keys, eleven counts, two recencies.

    ``events`` holds all events, or only product events when page visits and
    searches come separately as ``browsing`` (so each scan reads its own types).

    Product events are reduced to pair rows and browsing to client-day rows
    before anything is joined, so a hot client joins as its number of distinct
    products, not as its number of events, and ``join_clients`` lets adaptive
    execution split those. Client totals come from the pair rows,
    so the distinct-product count needs no separate distinct aggregation.
    """
    pairs = candidate_pairs(events)
    keys = [AS_OF, "client_id"]
    clients = _client_sku_totals(pairs).join(
        _client_browsing(events if browsing is None else browsing), keys, "left"
    )
    end = midnight(F.col(AS_OF))
    visits = F.coalesce("page_visits_previous_day", F.lit(0))
    searches = F.coalesce("search_previous_day", F.lit(0))
    return join_clients(pairs, clients, "inner").select(
        *SNAPSHOT_KEYS,
        (F.col("_sku_events") + visits + searches).alias("events_previous_day"),
        visits.alias("page_visits_previous_day"),
        searches.alias("search_previous_day"),
        *COUNT_FEATURES[3:],
        hours_between(F.greatest("_last_sku_side", "_last_browsing"), end).alias(RECENCY_FEATURES[0]),
        hours_between(F.col("_last_sku_event"), end).alias(RECENCY_FEATURES[1]),
    )


def skipped_sku_rows(events: DataFrame) -> DataFrame:
    unnamed = F.col("client_id").isNull() | F.col("sku").isNull()
    product = F.col("event_type").isin(SKU_EVENT_TYPES)
    return events.where(product).agg(F.count_if(unnamed).alias("value"))


def long_rows(measures: dict[str, DataFrame]) -> DataFrame:
    """One-row, one-column relations as rows (measure, value)."""
    result = None
    for name, df in measures.items():
        row = df.select(F.lit(name).alias("measure"), F.col(df.columns[0]).cast("bigint").alias("value"))
        result = row if result is None else result.unionAll(row)
    return result


def wide_to_long(one_row: DataFrame) -> DataFrame:
    return one_row.unpivot([], one_row.columns, "measure", "value")


def snapshot_summary(events: DataFrame) -> DataFrame:
    """Rows, clients, interactions and skipped product rows of a snapshot."""
    pairs = candidate_pairs(events)
    totals = pairs.agg(
        F.count("*").alias("feature_rows"),
        F.count_distinct("client_id").alias("distinct_clients"),
        F.coalesce(F.sum("sku_interactions_previous_day"), F.lit(0)).alias("sku_interactions"),
    )
    return wide_to_long(totals).unionAll(long_rows({"skipped_sku_rows": skipped_sku_rows(events)}))


# Labels


def _daily_first_purchases(purchases: DataFrame, as_of=None) -> DataFrame:
    """First purchase time and purchase count per pair and source day."""
    bought = purchases.where(F.col("client_id").isNotNull() & F.col("sku").isNotNull())
    stamp = F.col("event_time")
    if as_of is not None:
        start = F.lit(f"{as_date(as_of)} 00:00:00").cast("timestamp_ntz")
        bought = bought.where((stamp >= start) & (stamp < start + F.make_dt_interval(days=F.lit(LABEL_DAYS))))
    return bought.groupBy("client_id", "sku", F.to_date("event_time").alias("_day")).agg(
        F.min("event_time").alias("_first"), F.count("*").alias("_rows")
    )


def outcomes(purchases: DataFrame, as_of) -> DataFrame:
    """First purchase and purchase rows per pair in the window that follows one as-of date."""
    dated = _daily_first_purchases(purchases, as_of).withColumn(AS_OF, F.lit(str(as_date(as_of))).cast("date"))
    return dated.groupBy(*SNAPSHOT_KEYS).agg(
        F.min("_first").alias("first_purchase_at_source"),
        F.sum("_rows").alias("_matching_rows"),
    )


def outcomes_by_date(candidates: DataFrame, purchases: DataFrame) -> DataFrame:
    """Candidate keys of any dates with first purchase and purchase rows in the window that follows their date.

    A window is exactly seven whole source days. Purchases are reduced to one row per
    pair and day, and dealt by pair together with the candidates; in the order of days,
    a candidate looks at its own day and the six after it. Nothing is repeated per date,
    and a pair with very many purchases has no more rows than days. A candidate whose
    client, product or date is null has no purchases.
    """
    daily = _daily_first_purchases(purchases).where("_day IS NOT NULL").withColumnRenamed("_day", AS_OF)
    absent = [F.lit(None).cast(daily.schema[name].dataType).alias(name) for name in ("_first", "_rows")]
    rows = candidates.select(*SNAPSHOT_KEYS, *absent).unionByName(daily)
    ahead = W.partitionBy("client_id", "sku").orderBy(F.unix_date(AS_OF)).rangeBetween(0, LABEL_DAYS - 1)
    looked = rows.select(
        *SNAPSHOT_KEYS, "_rows",
        F.min("_first").over(ahead).alias("first_purchase_at_source"),
        F.sum("_rows").over(ahead).alias("_matching_rows"),
    )
    return looked.where("_rows IS NULL").drop("_rows")


def window_outcomes(pairs: DataFrame, purchases: DataFrame, start: str, length: str) -> DataFrame:
    """``pairs`` with purchases_in_window and first_purchase_at_source in [start, start + length).

    For windows of any length from any time of day. Time is cut into bins as long as
    the window, so a window begins in one bin and ends in the next. Purchases, window
    beginnings and window ends are rows of one union, dealt by pair and bin; in the
    order of time, a beginning sees the purchases that follow in its bin, an end those
    that came before in its own. No range join, and a pair with very many purchases is
    spread over its bins. Rows of ``pairs`` are told apart by their position; a null
    client, product or start has no purchases.
    """
    marked = cut_lineage(pairs.sparkSession, pairs.withColumn("_pair", F.monotonically_increasing_id()), "window-pairs")
    seconds = lambda stamp: F.unix_micros(stamp.cast("timestamp"))  # noqa: E731  zone-free values count as UTC, the session zone
    size = F.lit(pairs.sparkSession.range(1).select(F.expr(f"unix_micros(TIMESTAMP'1970-01-01 00:00:00' + INTERVAL {length})")).first()[0])
    keys = ["client_id", "sku"]
    bought = purchases.where("event_type = 'product_buy'").select(
        *keys, seconds(F.col("event_time")).alias("at"), F.col("event_time").alias("bought_at"), F.lit(None).cast("bigint").alias("pair"), F.lit(1).alias("kind"), F.lit(False).alias("is_end"))
    usable = marked.where(F.col(start).isNotNull() & F.col("client_id").isNotNull() & F.col("sku").isNotNull())
    edge = lambda at, is_end: usable.select(
        *keys, at.alias("at"), F.lit(None).cast("timestamp_ntz").alias("bought_at"), F.col("_pair").alias("pair"),
        F.lit(0).alias("kind"), F.lit(is_end).alias("is_end"))
    begin = seconds(F.col(start))
    rows = bought.unionByName(edge(begin, False)).unionByName(edge(begin + size, True)).withColumn("bin", F.floor(F.col("at") / size))
    # Beginnings and ends come before purchases of the same moment: the window holds its first moment, not its end.
    order = W.partitionBy(*keys, "bin").orderBy("at", "kind")
    after, before = order.rowsBetween(1, W.unboundedFollowing), order.rowsBetween(W.unboundedPreceding, -1)
    looked = rows.select("pair", "is_end", F.count("bought_at").over(after).alias("n_after"), F.min("bought_at").over(after).alias("first_after"),
                         F.count("bought_at").over(before).alias("n_before"), F.min("bought_at").over(before).alias("first_before"))
    found = looked.where("pair IS NOT NULL").groupBy("pair").agg(
        F.sum(F.when(F.col("is_end"), F.col("n_before")).otherwise(F.col("n_after"))).alias("purchases_in_window"),
        F.min(F.when(F.col("is_end"), F.col("first_before")).otherwise(F.col("first_after"))).alias("first_purchase_at_source"))
    return marked.join(found.withColumnRenamed("pair", "_pair"), "_pair", "left").drop("_pair").withColumn(
        "purchases_in_window", F.coalesce("purchases_in_window", F.lit(0)))


def labelled_pairs(snapshot: DataFrame, purchases: DataFrame, as_of=None) -> DataFrame:
    """Snapshot keys with outcome columns, including the matching purchase rows.

    With ``as_of``, a snapshot row of another date fails the job: its window would
    not have been looked at.
    """
    keys = snapshot.select(*SNAPSHOT_KEYS)
    if as_of is not None:
        wanted = F.lit(str(as_date(as_of))).cast("date")
        wrong = F.raise_error(F.concat(F.lit("Snapshot row of another date: "), F.col(AS_OF).cast("string")))
        keys = keys.withColumn(AS_OF, F.when(F.col(AS_OF) == wanted, F.col(AS_OF)).otherwise(wrong))
        return keys.join(outcomes(purchases, as_of), SNAPSHOT_KEYS, "left")
    return outcomes_by_date(keys, purchases)


def purchase_labels(snapshot: DataFrame, purchases: DataFrame, as_of=None) -> DataFrame:
    """One label row per snapshot row. Earlier purchases do not rule a pair out.

    ``as_of`` narrows the purchases to one window when the snapshot has one date.
    """
    start = midnight(F.col(AS_OF))
    first = F.col("first_purchase_at_source")
    return labelled_pairs(snapshot, purchases, as_of).select(
        *SNAPSHOT_KEYS,
        first.isNotNull().alias("purchase_observed_within_7d"),
        first.alias("first_purchase_at_source"),
        hours_between(start, first).alias("hours_to_first_purchase"),
        (start + F.make_dt_interval(days=F.lit(LABEL_DAYS))).alias("observation_window_end_source"),
    )


def label_summary(snapshot: DataFrame, purchases: DataFrame, as_of=None) -> DataFrame:
    found = F.col("first_purchase_at_source").isNotNull()
    totals = labelled_pairs(snapshot, purchases, as_of).agg(
        F.count("*").alias("label_rows"),
        F.coalesce(F.sum("_matching_rows"), F.lit(0)).alias("matching_purchase_rows"),
        F.count_if(found).alias("pairs_with_purchase"),
        F.count_if(~found).alias("pairs_without_purchase"),
    )
    return wide_to_long(totals)


def invalid_candidate_purchases(snapshot: DataFrame, raw_purchases: DataFrame) -> DataFrame:
    """Count of unreadable purchase times over the candidates' whole history."""
    unreadable = raw_purchases.where(source_time(F.col("timestamp")).isNull())
    per_pair = unreadable.groupBy("client_id", "sku").agg(F.count("*").alias("_rows"))
    pairs = snapshot.select("client_id", "sku")
    hit = per_pair.join(pairs, ["client_id", "sku"], "left_semi")
    return hit.agg(F.coalesce(F.sum("_rows"), F.lit(0)).alias("value"))


def label_guard_counts(snapshot: DataFrame, raw_purchases: DataFrame, as_of=None) -> DataFrame:
    """What the label guards look at: rows, as-of dates, repeated pairs, rows of a date not asked for, bad times."""
    other = F.lit(False) if as_of is None else ~F.col(AS_OF).eqNullSafe(F.lit(str(as_date(as_of))).cast("date"))
    per_pair = snapshot.groupBy(*SNAPSHOT_KEYS).agg(F.count("*").alias("_rows"))
    shape = per_pair.agg(
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("feature_rows"),
        F.count_distinct(AS_OF).alias("as_of_dates"),
        F.count_if(F.col("_rows") > 1).alias("duplicate_pairs"),
        F.coalesce(F.sum(F.when(other, F.col("_rows"))), F.lit(0)).alias("rows_of_other_dates"),
    )
    bad = invalid_candidate_purchases(snapshot, raw_purchases)
    return wide_to_long(shape).unionAll(long_rows({"invalid_candidate_timestamps": bad}))


def check_label_guards(counts: DataFrame, one_date: bool = True) -> None:
    """Raise on the first guard that fails; ``counts`` has five rows."""
    seen = {row["measure"]: row["value"] for row in counts.collect()}
    if not seen["feature_rows"]:
        raise QualityError("Snapshot contains no rows")
    if one_date and seen["as_of_dates"] != 1:
        raise QualityError("Snapshot must hold exactly one as-of date")
    if seen["rows_of_other_dates"]:
        raise QualityError(f"{seen['rows_of_other_dates']} snapshot rows are of another date than the labels")
    if seen["duplicate_pairs"]:
        raise QualityError("Snapshot repeats client-product pairs")
    if seen["invalid_candidate_timestamps"]:
        raise QualityError(f"{seen['invalid_candidate_timestamps']} purchase times cannot be read")


def build_labels(snapshot: DataFrame, raw_purchases: DataFrame, as_of=None) -> DataFrame:
    """Guarded label build over raw purchase rows (time as text)."""
    check_label_guards(label_guard_counts(snapshot, raw_purchases, as_of), one_date=as_of is not None)
    parsed = raw_purchases.withColumn("event_time", source_time(F.col("timestamp")))
    return purchase_labels(snapshot, parsed, as_of)


def affected_dates(days) -> tuple[list, list]:
    """(as-of dates whose snapshot changes, as-of dates whose labels change) when rows of these source days arrive.

    A day is in the snapshot of the date after it, and in the label window of itself
    and the dates up to ``LABEL_DAYS`` - 1 before it. New pairs of a date get labels too.
    """
    after = {day + timedelta(days=1) for day in days}
    windows = {day - timedelta(days=back) for day in days for back in range(LABEL_DAYS)}
    return sorted(after), sorted(windows | after)


def rebuild_affected(events: DataFrame, changed: DataFrame, snapshot_path: str, label_path: str) -> None:
    """Bring written snapshot and label tables up to date with ``events``, of which the days ``changed`` are new or have new rows.

    Only the affected dates are computed, from the events of the days that they need,
    and only their folders are replaced. Both tables are partitioned by as-of date, as
    ``write_once`` does it. A run that died is completed by running it again.
    """
    spark = events.sparkSession
    # One row per day, of which a history has few thousands; days are read once, and the plan prunes by literals.
    days = sorted(row["day"] for row in changed.where("day IS NOT NULL").select("day").distinct().collect())
    if not days:
        return
    label_dates = affected_dates(days)[1]
    day = F.to_date("event_time")
    fresh = offline_snapshot(events.where(day.isin(days)))
    replace_dates(fresh, snapshot_path)
    pairs = spark.read.parquet(snapshot_path).select(*SNAPSHOT_KEYS).where(F.col(AS_OF).isin(label_dates))
    last = label_dates[-1] + timedelta(days=LABEL_DAYS - 1)
    bought = events.where((F.col("event_type") == "product_buy") & day.between(label_dates[0], last))
    replace_dates(purchase_labels(pairs, bought), label_path)


def replace_dates(df: DataFrame, path: str) -> None:
    """Write ``df`` in place of the folders of its as-of dates; other dates stay as they are."""
    spread = df.hint("rebalance", AS_OF).sortWithinPartitions(*SNAPSHOT_KEYS)
    spread.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(AS_OF).parquet(path)


def write_once(df: DataFrame, path: str, by_date: bool = False) -> None:
    """Write a table that must not exist yet, sorted by key within its files."""
    writer = df.sortWithinPartitions(*SNAPSHOT_KEYS).write.mode("errorifexists")
    if by_date:
        # Each date goes to as many tasks as its size asks for; a date never shares a file.
        spread = df.hint("rebalance", AS_OF)
        writer = spread.sortWithinPartitions(*SNAPSHOT_KEYS).write.mode("errorifexists").partitionBy(AS_OF)
    writer.option("compression", "snappy").parquet(path)
