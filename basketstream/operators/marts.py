"""Staging, daily marts and mart features over the landing tables."""

from pyspark.sql import DataFrame, functions as F

from basketstream.fixed_values import SKU_EVENT_TYPES
from basketstream.schemas import LANDING_COLUMNS, names

# Landing columns that staging leaves behind: wide text and broker timestamps.
_NOT_STAGED = {"raw_json", "kafka_timestamp", "kafka_timestamp_type", "published_at_raw"}
_KEY_FIRST = {"events": "event_id", "products": "record_id"}


def _staged_columns(source: str) -> list[str]:
    key = _KEY_FIRST[source]
    rest = [name for name in names(LANDING_COLUMNS[source]) if name not in _NOT_STAGED]
    return [key, *[name for name in rest if name != key]]


def stg_events(landing: DataFrame) -> DataFrame:
    return landing.select(*_staged_columns("events"))


def stg_products(landing: DataFrame) -> DataFrame:
    return landing.select(*_staged_columns("products"))


def source_day(stamp="event_time_local"):
    return F.to_date(F.col(stamp))


def of_type(kind: str):
    return F.count_if(F.col("event_type") == kind)


def daily_event_activity(stg: DataFrame) -> DataFrame:
    """Events and distinct clients per source day and event type.

    The distinct count first groups by client on the map side, so a hot day is
    spread over its clients before it reaches its own group.
    """
    return stg.groupBy(source_day().alias("event_date_source"), "event_type").agg(
        F.count("*").alias("event_count"),
        F.count_distinct("client_id").alias("distinct_clients"),
    )


def client_prior_day(stg: DataFrame) -> DataFrame:
    """What every client did on a day, stamped with the following day."""
    as_of = F.date_add(source_day(), 1)
    return stg.groupBy("client_id", as_of.alias("feature_as_of_date_source")).agg(
        F.count("*").alias("events_previous_day"),
        of_type("page_visit").alias("page_visits_previous_day"),
        of_type("search_query").alias("search_previous_day"),
        of_type("add_to_cart").alias("cart_additions_previous_day"),
        of_type("remove_from_cart").alias("cart_removals_previous_day"),
        of_type("product_buy").alias("purchases_previous_day"),
        F.count_distinct("sku").alias("distinct_skus_previous_day"),
    )


def client_product_candidates(stg: DataFrame) -> DataFrame:
    """Client-product pairs that interacted on a day, stamped with the following day."""
    touched = stg.where(F.col("event_type").isin(SKU_EVENT_TYPES) & F.col("sku").isNotNull())
    as_of = F.date_add(source_day(), 1)
    return touched.groupBy("client_id", "sku", as_of.alias("feature_as_of_date_source")).agg(
        F.count("*").alias("sku_interactions_previous_day"),
        of_type("add_to_cart").alias("cart_additions_previous_day"),
        of_type("remove_from_cart").alias("cart_removals_previous_day"),
        of_type("product_buy").alias("purchases_previous_day"),
        F.max("event_time_local").alias("last_sku_interaction_at_source"),
    )


def feature_snapshot(candidates: DataFrame, activity: DataFrame) -> DataFrame:
    """Candidates with their client's activity; a candidate never disappears."""
    per_sku = {
        "cart_additions_previous_day": "sku_cart_additions_previous_day",
        "cart_removals_previous_day": "sku_cart_removals_previous_day",
        "purchases_previous_day": "sku_purchases_previous_day",
    }
    per_client = {
        "cart_additions_previous_day": "client_cart_additions_previous_day",
        "cart_removals_previous_day": "client_cart_removals_previous_day",
        "purchases_previous_day": "client_purchases_previous_day",
    }
    pairs = candidates.withColumnsRenamed(per_sku)
    clients = activity.withColumnsRenamed(per_client)
    return join_clients(pairs, clients, "left").select(
        "feature_as_of_date_source",
        "client_id",
        "sku",
        "events_previous_day",
        "page_visits_previous_day",
        "search_previous_day",
        "distinct_skus_previous_day",
        *per_client.values(),
        "sku_interactions_previous_day",
        *per_sku.values(),
    )


def join_clients(pairs: DataFrame, clients: DataFrame, how: str) -> DataFrame:
    """Pair rows with the one row of their client and date.

    A client with very many products is one key on the left. Adaptive execution
    splits such a partition only if both inputs are shuffled for this join, while
    the client side usually comes from an aggregate that is already dealt out by
    the same two columns. A third join key that follows from them, the client's
    hash, asks for a new shuffle of both.
    """
    keys, hashed = ["feature_as_of_date_source", "client_id"], F.hash("client_id")
    joined = pairs.withColumn("_client_hash", hashed).join(clients.withColumn("_client_hash", hashed), [*keys, "_client_hash"], how)
    return joined.drop("_client_hash")


def feature_snapshot_all(stg: DataFrame) -> DataFrame:
    return feature_snapshot(client_product_candidates(stg), client_prior_day(stg))


def run_event_counts(stg: DataFrame, run_ids: list[str]) -> DataFrame:
    chosen = stg.where(F.col("replay_run_id").isin(run_ids))
    return chosen.groupBy("event_type").agg(F.count("*").alias("event_count"))


def reconcile(landing_events: DataFrame, landing_products: DataFrame) -> DataFrame:
    """Row counts of every layer, one row each, to be compared by eye or by a check."""
    staged = stg_events(landing_events)
    mart = daily_event_activity(staged)

    def counted(layer, df, total):
        return df.agg(total.cast("bigint").alias("row_count")).select(
            F.lit(layer).alias("layer"), "row_count"
        )

    layers = [
        counted("landing_events", landing_events, F.count("*")),
        counted("landing_products", landing_products, F.count("*")),
        counted("stg_events", staged, F.count("*")),
        counted("daily_event_activity", mart, F.coalesce(F.sum("event_count"), F.lit(0))),
    ]
    result = layers[0]
    for layer in layers[1:]:
        result = result.unionAll(layer)
    return result


def ledger_summary(ledger: DataFrame) -> DataFrame:
    return ledger.groupBy("source_name").agg(
        F.count("*").alias("files"),
        F.sum("row_count").alias("total_rows"),
        F.sum("inserted_count").alias("inserted_rows"),
    )
