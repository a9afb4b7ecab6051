"""DuckDB SQL for the registered queries, written from the rules, not from the Spark code."""

from basketstream import fixed_values as fixed
from basketstream.plans.queries import AS_OF, HALF, REGISTRY, WINDOW
from basketstream.sources.driver_tables import PUBLISHED_AT, RUN_ID

SKU_TYPES = "('add_to_cart','product_buy','remove_from_cart')"
NAMESPACE = fixed.ID_NAMESPACE.replace("-", "")
DAY_START, DAY_END = "TIMESTAMP '2024-01-10 00:00:00'", "TIMESTAMP '2024-01-11 00:00:00'"


def uuid5(name):
    digest = f"sha1(unhex('{NAMESPACE}') || encode({name}))"
    nibble = f"translate(substr({digest},17,1),'0123456789abcdef','89ab89ab89ab89ab')"
    return (f"substr({digest},1,8)||'-'||substr({digest},9,4)||'-5'||substr({digest},14,3)||'-'||"
            f"{nibble}||substr({digest},18,3)||'-'||substr({digest},21,12)")


EVENTS = """
t AS (
  SELECT CASE event_type WHEN 'view' THEN 'page_visit' WHEN 'click' THEN 'add_to_cart'
         WHEN 'purchase' THEN 'product_buy' WHEN 'error' THEN 'remove_from_cart'
         WHEN 'signup' THEN 'search_query' END AS event_type,
    event_id AS source_row_number, user_id AS client_id,
    CAST(date_trunc('second', ts) AS TIMESTAMP) AS event_time,
    CAST(regexp_extract(props, '[0-9]+') AS BIGINT) AS k
  FROM events),
e AS (
  SELECT *, event_type || '.parquet' AS source_file,
    CASE WHEN event_type IN ('add_to_cart','product_buy','remove_from_cart') THEN k END AS sku,
    CASE WHEN event_type = 'page_visit' THEN k END AS url,
    CASE WHEN event_type = 'search_query' THEN '[' || k || ' ' || (k + 1) || ']' END AS query,
    strftime(event_time, '%Y-%m-%d %H:%M:%S') AS stamp
  FROM t)"""

PRODUCTS = """
p AS (
  SELECT p_partkey AS source_row_number, p_partkey AS sku,
    CAST(regexp_extract(p_brand, '[0-9]+') AS BIGINT) AS category, CAST(p_size AS INTEGER) AS price,
    '[' || length(p_name) || ']' AS name
  FROM part)"""

PAYLOAD = """CASE WHEN event_type = 'page_visit' THEN '{"url_id":' || url || '}'
  WHEN event_type = 'search_query' THEN '{"query_vector_raw":"' || query || '"}'
  ELSE '{"sku":' || sku || '}' END"""
EVENT_ID = uuid5("source_file || ':' || source_row_number")
PRODUCT_ID = uuid5(f"'{fixed.PRODUCT_FILE}:' || source_row_number")


def with_events(body, *more):
    return "WITH " + ",".join([EVENTS, *more]) + body


def with_products(body, *more):
    return "WITH " + ",".join([PRODUCTS, *more]) + body


# Outcome of every damaged row.
BUILD_ERROR = f"""CASE k WHEN 0 THEN 'client_id must be an integer' WHEN 1 THEN 'client_id must be non-negative'
  WHEN 2 THEN 'timestamp must be a string' WHEN 3 THEN '{fixed.MSG_TIME_FORMAT}' WHEN 4 THEN '{fixed.MSG_TIME_CALENDAR}'
  WHEN 5 THEN CASE event_type WHEN 'page_visit' THEN 'url must be an integer'
    WHEN 'search_query' THEN 'query must be a string' ELSE 'sku must be an integer' END
  WHEN 6 THEN CASE event_type WHEN 'page_visit' THEN 'url must be non-negative'
    WHEN 'search_query' THEN '{fixed.MSG_QUERY_VECTOR}' ELSE 'sku must be non-negative' END
  WHEN 7 THEN '{fixed.MSG_UNSUPPORTED_FILE}unknown.parquet' WHEN 9 THEN 'client_id must be an integer' END"""
DAMAGED_RAW = f"""
d AS (SELECT source_row_number, client_id, k, event_type,
  CASE WHEN k = 7 THEN 'unknown.parquet' ELSE source_file END AS source_file,
  {BUILD_ERROR} AS build_error,
  k = 8 AND event_type = 'search_query' AS refused,
  CASE WHEN k IN (0, 9) THEN NULL WHEN k = 1 THEN -1 - client_id ELSE client_id END AS raw_client_id,
  CASE WHEN k = 2 THEN NULL WHEN k IN (3, 9) THEN replace(stamp, ' ', 'T')
    WHEN k = 4 THEN substr(stamp, 1, 5) || '13' || substr(stamp, 8) ELSE stamp END AS raw_timestamp
  FROM e)"""
LETTERS = f"""
l AS (SELECT *, CASE WHEN build_error IS NULL THEN 'contract_validation' ELSE 'transformation' END AS error_stage,
  CASE WHEN build_error IS NULL THEN 'ContractViolation' ELSE 'ValueError' END AS error_type,
  coalesce(build_error, 'payload') AS error_message,
  {uuid5("'dlq:' || source_file || ':' || source_row_number")} AS dlq_id
  FROM d WHERE build_error IS NOT NULL OR refused)"""
PRODUCT_ERROR = f"""CASE price WHEN 1 THEN 'name must be a string' WHEN 2 THEN '{fixed.MSG_NAME_VECTOR}'
  WHEN 3 THEN 'price must be an integer' WHEN 4 THEN 'price must be non-negative'
  WHEN 5 THEN '{fixed.MSG_PRICE_RANGE}' WHEN 6 THEN 'sku must be an integer'
  WHEN 7 THEN 'category must be non-negative' END"""

STREAM_CODE = """CASE k WHEN 0 THEN 'malformed_json' WHEN 1 THEN 'invalid_schema_version' WHEN 2 THEN 'invalid_event_id'
  WHEN 3 THEN 'invalid_event_type' WHEN 4 THEN 'invalid_event_time' WHEN 5 THEN 'unexpected_event_time_timezone'
  WHEN 6 THEN 'invalid_client_id' WHEN 7 THEN 'invalid_message_key'
  WHEN 8 THEN CASE event_type WHEN 'page_visit' THEN 'missing_url_id' WHEN 'search_query' THEN 'missing_query_vector'
    ELSE 'missing_sku' END
  WHEN 9 THEN 'invalid_source_dataset' WHEN 10 THEN 'invalid_source_file' WHEN 11 THEN 'invalid_source_row_number'
  WHEN 12 THEN 'invalid_replay_run_id' WHEN 13 THEN 'invalid_published_at' WHEN 14 THEN 'invalid_schema_version'
  WHEN 15 THEN 'invalid_schema_version' WHEN 16 THEN 'invalid_event_time' WHEN 19 THEN 'invalid_published_at'
  WHEN 20 THEN 'malformed_json' WHEN 21 THEN 'malformed_json' END"""
PRODUCT_CODE = """CASE price WHEN 1 THEN 'malformed_json' WHEN 2 THEN 'invalid_schema_version' WHEN 3 THEN 'invalid_record_id'
  WHEN 4 THEN 'invalid_sku' WHEN 5 THEN 'invalid_message_key' WHEN 6 THEN 'invalid_category_id'
  WHEN 7 THEN 'invalid_price_bucket' WHEN 8 THEN 'invalid_name_vector' WHEN 9 THEN 'invalid_source_dataset'
  WHEN 10 THEN 'invalid_source_file' WHEN 11 THEN 'invalid_source_row_number' WHEN 12 THEN 'invalid_replay_run_id'
  WHEN 13 THEN 'invalid_published_at' WHEN 14 THEN 'malformed_json' WHEN 15 THEN 'invalid_schema_version' END"""
JUDGED = f"""
j AS (SELECT *, {EVENT_ID} AS event_id, {STREAM_CODE} AS validation_error,
  CAST(client_id % 6 AS INTEGER) AS kafka_partition, source_row_number AS kafka_offset FROM e)"""
JUDGED_PRODUCTS = f"""
j AS (SELECT *, {PRODUCT_ID} AS record_id, {PRODUCT_CODE} AS validation_error,
  CAST(sku % 3 AS INTEGER) AS kafka_partition, source_row_number AS kafka_offset FROM p)"""

def event_columns(damaged):
    sku = "CASE WHEN k = 18 AND sku IS NOT NULL THEN CAST(-118 AS BIGINT) ELSE sku END" if damaged else "sku"
    return (f"event_id, event_type, event_time AS event_time_local, client_id, {sku} AS sku, url AS url_id, "
            "query AS query_vector_raw, source_file, source_row_number, CAST(client_id AS VARCHAR) AS message_key, "
            "kafka_partition, kafka_offset")


PRODUCT_COLUMNS = ("record_id, sku, category AS category_id, price AS price_bucket, name AS name_vector_raw, "
                   "source_row_number, CAST(sku AS VARCHAR) AS message_key, kafka_partition, kafka_offset")
BRONZE = with_events(f" SELECT {event_columns(True)} FROM j WHERE validation_error IS NULL", JUDGED)

# Mart features.
ACTIVITY = """
activity AS (
  SELECT client_id, CAST(CAST(event_time AS DATE) + 1 AS DATE) AS feature_as_of_date_source,
    count(*) AS events_previous_day,
    count(*) FILTER (event_type = 'page_visit') AS page_visits_previous_day,
    count(*) FILTER (event_type = 'search_query') AS search_previous_day,
    count(*) FILTER (event_type = 'add_to_cart') AS cart_additions_previous_day,
    count(*) FILTER (event_type = 'remove_from_cart') AS cart_removals_previous_day,
    count(*) FILTER (event_type = 'product_buy') AS purchases_previous_day,
    count(DISTINCT sku) AS distinct_skus_previous_day, max(event_time) AS last_event
  FROM e GROUP BY ALL)"""
PAIRS = """
pairs AS (
  SELECT client_id, sku, CAST(CAST(event_time AS DATE) + 1 AS DATE) AS feature_as_of_date_source,
    count(*) AS sku_interactions_previous_day,
    count(*) FILTER (event_type = 'add_to_cart') AS cart_additions_previous_day,
    count(*) FILTER (event_type = 'remove_from_cart') AS cart_removals_previous_day,
    count(*) FILTER (event_type = 'product_buy') AS purchases_previous_day,
    max(event_time) AS last_sku_interaction_at_source
  FROM e WHERE sku IS NOT NULL GROUP BY ALL)"""
MART_SNAPSHOT = """
snap AS (
  SELECT c.feature_as_of_date_source, c.client_id, c.sku, a.events_previous_day, a.page_visits_previous_day,
    a.search_previous_day, a.distinct_skus_previous_day,
    a.cart_additions_previous_day AS client_cart_additions_previous_day,
    a.cart_removals_previous_day AS client_cart_removals_previous_day,
    a.purchases_previous_day AS client_purchases_previous_day, c.sku_interactions_previous_day,
    c.cart_additions_previous_day AS sku_cart_additions_previous_day,
    c.cart_removals_previous_day AS sku_cart_removals_previous_day,
    c.purchases_previous_day AS sku_purchases_previous_day,
    (epoch_us(CAST(c.feature_as_of_date_source AS TIMESTAMP)) - epoch_us(a.last_event)) / 3.6e9
      AS hours_since_last_client_event,
    (epoch_us(CAST(c.feature_as_of_date_source AS TIMESTAMP)) - epoch_us(c.last_sku_interaction_at_source)) / 3.6e9
      AS hours_since_last_sku_event
  FROM pairs c LEFT JOIN activity a USING (client_id, feature_as_of_date_source))"""
COUNTS = ", ".join(fixed.COUNT_FEATURES)
KEYS = ", ".join(fixed.SNAPSHOT_KEYS)
HOURS = ", ".join(f"round({name}, 6) AS {name}" for name in fixed.RECENCY_FEATURES)
LABELS = """
labels_all AS (
  SELECT s.feature_as_of_date_source, s.client_id, s.sku, min(b.event_time) AS first_at, count(b.event_time) AS matching
  FROM snap s LEFT JOIN (SELECT * FROM e WHERE event_type = 'product_buy') b
    ON b.client_id = s.client_id AND b.sku = s.sku
    AND b.event_time >= s.feature_as_of_date_source AND b.event_time < s.feature_as_of_date_source + INTERVAL 7 DAY
  GROUP BY ALL),
lab AS (
  SELECT feature_as_of_date_source, client_id, sku, first_at IS NOT NULL AS purchase_observed_within_7d,
    first_at AS first_purchase_at_source,
    (epoch_us(first_at) - epoch_us(CAST(feature_as_of_date_source AS TIMESTAMP))) / 3.6e9 AS hours_to_first_purchase,
    CAST(feature_as_of_date_source + INTERVAL 7 DAY AS TIMESTAMP) AS observation_window_end_source, matching
  FROM labels_all)"""
SNAP = (ACTIVITY, PAIRS, MART_SNAPSHOT)
LABELLED = (*SNAP, LABELS)
LABEL_COLUMNS = (f"{KEYS}, purchase_observed_within_7d, first_purchase_at_source, "
                 "round(hours_to_first_purchase, 6) AS hours_to_first_purchase, observation_window_end_source")
ON_DAY = f"feature_as_of_date_source = DATE '{AS_OF}'"

# The same over orders and line items.
ORDER_EVENTS = """WITH e AS (
  SELECT CASE l_returnflag WHEN 'A' THEN 'add_to_cart' WHEN 'N' THEN 'product_buy' WHEN 'R' THEN 'remove_from_cart' END
    AS event_type, o_custkey AS client_id, l_partkey AS sku, o_orderdate + to_hours(l_linenumber) AS event_time
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

LANDED = f"""
land AS (SELECT *, {EVENT_ID} AS event_id, CAST(client_id % 6 AS INTEGER) AS kafka_partition,
  source_row_number AS kafka_offset FROM e),
again AS (SELECT * FROM land UNION ALL
  SELECT * REPLACE (kafka_offset + 1000000000 AS kafka_offset) FROM land WHERE sku < 20)"""

FILES = """
inv AS (SELECT 'events' AS source_name, event_type AS kind, count(*) AS row_count,
  row_number() OVER (ORDER BY event_type) AS place FROM j WHERE validation_error IS NULL GROUP BY event_type)"""

# Scores from a rule, labels and ranks.
SCORED = """
scored AS (
  SELECT s.*, CAST(purchase_observed_within_7d AS INTEGER) AS label, hours_to_first_purchase AS hours,
    least(0.99, (sku_cart_additions_previous_day * 2 + sku_interactions_previous_day + events_previous_day) / 20.0::DOUBLE)
      AS score
  FROM snap s JOIN lab USING (feature_as_of_date_source, client_id, sku))"""
TIMED = """
timed AS (SELECT *, CASE WHEN hours < 24 THEN 0 WHEN hours < 72 THEN 1 ELSE 2 END AS bucket,
  events_previous_day + 1.0::DOUBLE AS w0, sku_interactions_previous_day + 1.5::DOUBLE AS w1,
  distinct_skus_previous_day + 0.75::DOUBLE AS w2
  FROM scored WHERE label = 1),
guessed AS (SELECT *, CASE WHEN w0 >= greatest(w1, w2) THEN 0 WHEN w1 >= w2 THEN 1 ELSE 2 END AS prediction,
  CASE bucket WHEN 0 THEN w0 WHEN 1 THEN w1 ELSE w2 END / (w0 + w1 + w2) AS p_true FROM timed)"""
BUCKETS = "(VALUES (0, 'under 24h'), (1, '24-72h'), (2, '72-168h'))"
PRIOR = f"""
prior AS (SELECT b.bucket, b.bucket_name, count(t.bucket) AS bucket_rows,
  count(t.bucket) / sum(count(t.bucket)) OVER () AS prior,
  row_number() OVER (ORDER BY count(t.bucket) DESC, b.bucket) = 1 AS is_majority
  FROM {BUCKETS} b(bucket, bucket_name)
  LEFT JOIN (SELECT * FROM timed WHERE feature_as_of_date_source < DATE '{HALF}') t ON t.bucket = b.bucket
  GROUP BY b.bucket, b.bucket_name)"""
PER_CLASS = f"""
cls AS (SELECT b.bucket, b.bucket_name,
  (SELECT count(*) FROM rated g WHERE g.bucket = b.bucket AND g.prediction = b.bucket) AS hits,
  (SELECT count(*) FROM rated g WHERE g.prediction = b.bucket) AS predicted,
  (SELECT count(*) FROM rated g WHERE g.bucket = b.bucket) AS support
  FROM {BUCKETS} b(bucket, bucket_name)),
prf AS (SELECT *, CASE WHEN predicted = 0 THEN 0.0::DOUBLE ELSE hits / predicted END AS precision,
  CASE WHEN support = 0 THEN 0.0::DOUBLE ELSE hits / support END AS recall,
  CASE WHEN predicted + support = 0 THEN 0.0::DOUBLE ELSE 2 * hits / (predicted + support) END AS f1 FROM cls)"""


def long(pairs, source, name="measure", value="value"):
    return " UNION ALL ".join(
        f"SELECT '{label}' AS {name}, CAST({sql} AS BIGINT) AS {value} FROM {source}" for label, sql in pairs)


def status(name, bad):
    return f"SELECT '{name}' AS check_name, count(*) AS offending_rows FROM ({bad})"


def _scans():
    columns = "source_file, source_row_number, client_id, stamp AS timestamp"
    inside = f"stamp >= '{WINDOW[0]}' AND stamp < '{WINDOW[1]}'"
    per_file = long([(f"{kind}.parquet", f"count(*) FILTER (event_type = '{kind}')") for kind in fixed.EVENT_TYPES]
                    + [("total", "count(*)")], f"(SELECT * FROM e WHERE {inside})", "source_file", "matching_events")
    return {
        "scan_numbered": "SELECT 'events.parquet' AS source_file, event_id AS source_row_number, event_id, user_id, "
                         "event_type FROM events",
        "scan_window": with_events(f" SELECT {columns} FROM e WHERE {inside}"),
        "replay_request": with_events(
            f" SELECT client_id, stamp AS timestamp, sku FROM e WHERE event_type = 'add_to_cart' AND {inside} "
            "ORDER BY source_row_number LIMIT 25"),
        "scan_window_first": with_events(
            f" SELECT {columns}, sku FROM e WHERE event_type = 'add_to_cart' AND {inside} "
            "ORDER BY source_row_number LIMIT 25"),
        "day_events": with_events(
            " SELECT event_type, source_row_number, client_id, sku, event_time FROM e "
            f"WHERE event_time >= {DAY_START} AND event_time < {DAY_END}"),
        "events_union": with_events(
            " SELECT event_type, source_file, source_row_number, client_id, stamp AS timestamp, sku, url, query FROM e"),
        "profile_window": with_events(" " + per_file),
    }


def _envelopes():
    letter_value = "'" + fixed.DLQ_TOPIC + "'"
    head = '\'{"schema_version":"1.0.0","event_id":"\''
    value = (f"{head} || {EVENT_ID} || '\",\"event_type\":\"' || event_type || '\",\"event_time\":\"' || stamp || "
             "'\",\"event_time_timezone\":null,\"client_id\":' || client_id || ',\"payload\":' || " + PAYLOAD +
             f" || ',\"source\":{{\"dataset\":\"{fixed.DATASET}\",\"file\":\"' || source_file || '\",\"row_number\":' || "
             f"source_row_number || '}},\"replay\":{{\"run_id\":\"{RUN_ID}\",\"published_at\":\"{PUBLISHED_AT}\"}}}}'")
    product = ('\'{"schema_version":"1.0.0","record_id":"\' || ' + PRODUCT_ID + " || '\",\"sku\":' || sku || "
               "',\"category_id\":' || category || ',\"price_bucket\":' || price || ',\"name_vector_raw\":\"' || name || "
               f"'\",\"source\":{{\"dataset\":\"{fixed.DATASET}\",\"file\":\"{fixed.PRODUCT_FILE}\",\"row_number\":' || "
               f"source_row_number || '}},\"replay\":{{\"run_id\":\"{RUN_ID}\",\"published_at\":\"{PUBLISHED_AT}\"}}}}'")
    return {
        "record_ids": with_events(f" SELECT source_file, source_row_number, {EVENT_ID} AS record_id FROM e"),
        "envelope_build": with_events(
            f" SELECT {EVENT_ID} AS event_id, event_type, stamp AS event_time, CAST(NULL AS VARCHAR) AS event_time_timezone, "
            f"client_id, {PAYLOAD} AS payload, source_file, source_row_number, '{RUN_ID}' AS run_id, "
            f"'{PUBLISHED_AT}' AS published_at FROM e"),
        "product_envelope": with_products(f" SELECT {product} AS value FROM p"),
        "transform_errors": with_events(
            " SELECT source_file, source_row_number, build_error FROM d WHERE build_error IS NOT NULL", DAMAGED_RAW),
        "product_transform_errors": with_products(
            f" SELECT * FROM (SELECT source_row_number, {PRODUCT_ERROR} AS build_error FROM p) WHERE build_error IS NOT NULL"),
        "dlq_records": with_events(
            f" SELECT source_file, source_row_number, {letter_value} AS topic, dlq_id AS key, error_stage, error_type, "
            f"error_message, '{fixed.EVENT_TOPIC}' AS original_topic, raw_client_id, raw_timestamp FROM l",
            DAMAGED_RAW, LETTERS),
        "replay_summary": with_events(
            " SELECT source_file, count(*) AS processed, count(*) FILTER (build_error IS NOT NULL OR refused) AS dead_lettered, "
            "count(*) FILTER (build_error IS NOT NULL) AS failed_transformation, "
            "count(*) FILTER (build_error IS NULL AND refused) AS failed_contract FROM d GROUP BY ALL", DAMAGED_RAW),
        "product_replay_summary": with_products(
            f" SELECT '{fixed.PRODUCT_FILE}' AS source_file, count(*) AS processed, "
            "count(*) FILTER (price <= 8) AS dead_lettered, count(*) FILTER (price <= 7) AS failed_transformation, "
            "count(*) FILTER (price = 8) AS failed_contract FROM p"),
        "publish_rows": with_events(
            f" SELECT '{fixed.EVENT_TOPIC}' AS topic, CAST(client_id AS VARCHAR) AS key, {value} AS value, "
            "'content-type=application/json' AS first_header, 2 AS header_count FROM e"),
        "dry_run_preview": with_events(
            f" SELECT d.source_file, d.source_row_number, CASE WHEN l.dlq_id IS NULL THEN '{fixed.EVENT_TOPIC}' "
            f"ELSE {letter_value} END AS topic, coalesce(l.dlq_id, CAST(d.client_id AS VARCHAR)) AS key "
            "FROM d LEFT JOIN l USING (source_row_number) ORDER BY d.source_file, d.source_row_number LIMIT 5",
            DAMAGED_RAW, LETTERS),
        "dlq_landed": with_events(
            f" SELECT dlq_id, '{fixed.EVENT_TOPIC}' AS original_topic, source_file, source_row_number, error_stage, error_type, "
            # A letter about an unknown file breaks the dead-letter contract by naming it.
            "error_message, CASE WHEN k = 7 THEN 1 ELSE 0 END AS broken_rules, raw_timestamp FROM l", DAMAGED_RAW, LETTERS),
        "contract_dlq": with_events(
            " SELECT source_row_number, concat_ws(',', CASE WHEN source_row_number % 5 = 0 THEN 'keys' END, "
            "CASE WHEN k = 7 THEN 'source_file' END) AS broken_rules FROM l",
            DAMAGED_RAW, LETTERS),
    }


def _contracts():
    events = """CASE WHEN k IN (0, 14, 15, 21) THEN 'not_an_object' WHEN k = 1 THEN 'schema_version' WHEN k = 2 THEN 'event_id'
      WHEN k = 3 THEN 'event_type' WHEN k = 5 THEN 'event_time_timezone' WHEN k IN (6, 20) THEN 'client_id'
      WHEN k = 8 OR (k = 18 AND sku IS NOT NULL) THEN 'payload' WHEN k = 9 THEN 'source_dataset' WHEN k = 10 THEN 'source_file'
      WHEN k = 11 THEN 'source_row_number' WHEN k = 12 THEN 'replay_run_id' WHEN k = 13 THEN 'replay_published_at'
      WHEN k = 17 THEN 'keys' ELSE '' END"""
    products = """CASE WHEN price IN (1, 14, 15) THEN 'not_an_object' WHEN price = 2 THEN 'schema_version'
      WHEN price = 3 THEN 'record_id' WHEN price = 4 THEN 'sku' WHEN price = 6 THEN 'category_id' WHEN price = 7 THEN 'price_bucket'
      WHEN price = 8 THEN 'name_vector_raw' WHEN price = 9 THEN 'source_dataset' WHEN price = 10 THEN 'source_file'
      WHEN price = 11 THEN 'source_row_number' WHEN price = 12 THEN 'replay_run_id' WHEN price = 13 THEN 'replay_published_at'
      WHEN price = 16 THEN 'keys' ELSE '' END"""
    wrong = """CASE sku WHEN 1 THEN 'events_previous_day_negative' WHEN 2 THEN 'search_previous_day_not_finite'
      WHEN 3 THEN 'hours_since_last_client_event_not_finite' WHEN 4 THEN 'hours_since_last_client_event_not_finite'
      WHEN 5 THEN 'hours_since_last_sku_event_negative' END"""
    verdict = "validation_error, validation_error IS NULL AS is_valid"
    return {
        "contract_events": with_events(f" SELECT source_row_number, {events} AS broken_rules FROM e"),
        "contract_products": with_products(f" SELECT source_row_number, {products} AS broken_rules FROM p"),
        "score_input_errors": with_events(f" SELECT {KEYS}, {wrong} AS broken_rules FROM snap WHERE sku BETWEEN 1 AND 5", *SNAP),
        "event_validation": with_events(f" SELECT kafka_partition, kafka_offset, {verdict} FROM j", JUDGED),
        "product_validation": with_products(f" SELECT kafka_partition, kafka_offset, {verdict} FROM j", JUDGED_PRODUCTS),
        "events_bronze": BRONZE,
        "stream_bronze": BRONZE,
        "incremental_load": BRONZE,
        "incremental_interrupted": BRONZE,
        "scan_multi_file": with_events(
            " SELECT event_type, count(*) AS total_rows, count(*) AS distinct_ids, count(*) AS landed_rows FROM e GROUP BY event_type"),
        "products_bronze": with_products(f" SELECT {PRODUCT_COLUMNS} FROM j WHERE validation_error IS NULL", JUDGED_PRODUCTS),
        "incremental_ledger": with_products(
            " SELECT count(*) AS total_rows, count(*) AS inserted_rows FROM j WHERE validation_error IS NULL", JUDGED_PRODUCTS),
        "validation_summary": with_events(
            " SELECT coalesce(validation_error, 'valid') AS outcome, count(*) AS records FROM j GROUP BY ALL", JUDGED),
        "products_latest": with_products(
            " SELECT record_id, sku, category AS category_id, CAST(CASE WHEN price <= 20 THEN price + 30 ELSE price END AS INTEGER) "
            "AS price_bucket, name AS name_vector_raw, source_row_number, CAST(sku AS VARCHAR) AS message_key, kafka_partition, "
            "CASE WHEN price <= 20 THEN kafka_offset + 1000000000 ELSE kafka_offset END AS kafka_offset FROM j", JUDGED_PRODUCTS),
        "stream_products": with_products(
            " SELECT coalesce(validation_error, 'valid') AS outcome, CASE WHEN validation_error IS NULL THEN record_id END AS record_id, "
            "CAST(sum(CASE WHEN low THEN 2 ELSE 1 END) AS BIGINT) AS records "
            "FROM (SELECT *, price <= 20 AND price NOT IN (1, 7, 14, 15) AS low FROM j) GROUP BY ALL", JUDGED_PRODUCTS),
        "stream_latest_products": with_products(
            " SELECT record_id, sku, category AS category_id, CAST(CASE WHEN price <= 20 THEN price + 30 ELSE price END AS INTEGER) "
            "AS price_bucket, name AS name_vector_raw, source_row_number, CAST(sku AS VARCHAR) AS message_key, kafka_partition, "
            "CASE WHEN price <= 20 THEN kafka_offset + 1000000000 ELSE kafka_offset END AS kafka_offset FROM j "
            "WHERE validation_error IS NULL", JUDGED_PRODUCTS),
        "stream_repeats": with_events(
            " SELECT event_type, count(*) AS landed_rows, count(*) AS distinct_ids FROM e GROUP BY event_type"),
        "bronze_topk": with_events(
            " SELECT kafka_partition, kafka_offset, event_id, event_type, client_id FROM j WHERE validation_error IS NULL "
            "ORDER BY kafka_partition, kafka_offset LIMIT 20", JUDGED),
        "roundtrip_events": with_events(
            " SELECT event_id, event_type, event_time AS event_time_local, client_id, sku, url AS url_id, query AS query_vector_raw, "
            "source_file, source_row_number, CAST(client_id AS VARCHAR) AS message_key, TRUE AS is_valid FROM j", JUDGED),
        "stream_quarantine": with_events(
            f" SELECT kafka_partition, kafka_offset, CASE k WHEN 6 THEN '-5' WHEN 7 THEN '999999999' WHEN 16 THEN '999999999' "
            "ELSE CAST(client_id AS VARCHAR) END AS message_key, validation_error FROM j WHERE validation_error IS NOT NULL", JUDGED),
        "stream_rerun": with_events(
            " SELECT CAST(run AS INTEGER) AS run, count(*) FILTER (validation_error IS NULL) AS bronze_rows, "
            "count(*) FILTER (validation_error IS NOT NULL) AS quarantine_rows FROM j, (VALUES (1), (2)) r(run) GROUP BY run", JUDGED),
        "stream_landing": with_events(f" SELECT {event_columns(False)} FROM j WHERE sku IS NULL OR sku <> 2", JUDGED),
        "stream_rejects": with_events(" SELECT event_id, 'kafka_offset_negative' AS violations FROM j WHERE sku = 2", JUDGED),
    }


def _landing():
    late = f"event_time >= TIMESTAMP '{HALF} 00:00:00'"
    damaged = """CASE sku WHEN 1 THEN 'schema_version_wrong' WHEN 2 THEN 'kafka_offset_negative'
      WHEN 3 THEN 'event_type_unknown' WHEN 4 THEN 'client_id_negative' WHEN 5 THEN 'event_id_missing,client_id_missing' END"""
    return {
        "landing_insert": with_events(
            f" SELECT event_id, source_file, source_row_number, kafka_offset FROM land WHERE {late}", LANDED),
        "landing_insert_counts": with_events(
            f" SELECT count(*) AS processed, count(DISTINCT event_id) FILTER ({late}) AS inserted, "
            f"count(*) - count(DISTINCT event_id) FILTER ({late}) AS already_present FROM again", LANDED),
        "landing_normalize": with_events(
            f" SELECT event_id, '{RUN_ID}' AS replay_run_id, event_time AS event_time_local, client_id, kafka_partition, "
            "TIMESTAMP '2031-03-05 06:07:08' AS published_at FROM land", LANDED),
        "landing_violations": with_events(
            f" SELECT source_file, source_row_number, {damaged} AS violations FROM e WHERE sku BETWEEN 1 AND 5"),
        "ledger_classify": with_events(
            " SELECT source_name, kind, row_count, CASE WHEN place > 3 THEN 'load' "
            "WHEN kind = 'page_visit' THEN 'changed' ELSE 'skip' END AS state FROM inv", JUDGED, FILES),
        "ledger_summary": with_events(
            " SELECT source_name, count(*) AS files, CAST(sum(row_count) AS BIGINT) AS total_rows, "
            "CAST(sum(row_count) AS BIGINT) AS inserted_rows FROM inv WHERE place <= 3 GROUP BY ALL", JUDGED, FILES),
        "ledger_violations": (
            "SELECT * FROM (VALUES ('page_visit', FALSE, 'source_name_unknown'), ('add_to_cart', FALSE, 'file_sha256_malformed'), "
            "('page_visit', TRUE, 'inserted_count_out_of_range'), ('add_to_cart', TRUE, 'file_size_not_positive')) v(kind, copied, violations) "
            "WHERE (SELECT count(DISTINCT event_type) FROM events) = 5"),
        "bronze_sample": with_events(
            " SELECT kafka_partition, kafka_offset, event_id, event_type, client_id, event_time AS event_time_local FROM j "
            "WHERE validation_error IS NULL ORDER BY kafka_partition, kafka_offset LIMIT 100", JUDGED),
        "file_inventory": with_events(
            " SELECT source_name, kind, CAST(ceil(row_count / 100000.0) AS BIGINT) AS files, row_count AS total_rows, "
            "CAST(ceil(row_count / 100000.0) AS BIGINT) AS distinct_hashes, CAST(0 AS BIGINT) AS malformed FROM inv", JUDGED, FILES),
        "incremental_steps": with_events(
            " SELECT step, count(*) AS files, CAST(sum(row_count) AS BIGINT) AS total_rows, CAST(sum(row_count) AS BIGINT) AS inserted_rows "
            "FROM inv JOIN (VALUES (1, 1), (2, 4), (3, 5)) s(step, upto) ON place <= upto GROUP BY step", JUDGED, FILES),
    }


def _marts():
    daily = "SELECT CAST(event_time AS DATE) AS event_date_source, event_type, count(*) AS event_count, " \
            "count(DISTINCT client_id) AS distinct_clients FROM e GROUP BY ALL"
    activity = ("SELECT client_id, feature_as_of_date_source, events_previous_day, page_visits_previous_day, search_previous_day, "
                "cart_additions_previous_day, cart_removals_previous_day, purchases_previous_day, distinct_skus_previous_day "
                "FROM activity")
    message = ("CAST({key} AS VARCHAR) AS message_key, '{topic}' AS kafka_topic, CAST({key} % {parts} AS INTEGER) AS kafka_partition, "
               "source_row_number AS kafka_offset, '1.0.0' AS schema_version")
    event_message = message.format(key="client_id", topic=fixed.EVENT_TOPIC, parts=6)
    product_message = message.format(key="sku", topic=fixed.PRODUCT_TOPIC, parts=3)
    lineage = f"'{fixed.DATASET}' AS source_dataset, source_row_number, '{RUN_ID}' AS replay_run_id"
    null_columns = ["event_id", "client_id", "sku", "url", "query"]
    names = {"url": "url_id", "query": "query_vector_raw"}
    nulls = long([(names.get(c, c), f"count(*) FILTER ({c} IS NULL)") for c in null_columns], "j", "column_name", "null_rows")
    zero = ["event_id_not_null", "event_id_unique", "client_id_not_null", "record_id_not_null", "record_id_unique",
            "product_sku_not_null"]
    no_row = " UNION ALL ".join(f"SELECT '{name}' AS check_name, CAST(0 AS BIGINT) AS offending_rows" for name in zero)
    buys = "count(*) FILTER (event_type = 'product_buy')"
    return {
        "stg_events": with_events(
            f" SELECT {EVENT_ID} AS event_id, {event_message}, event_type, stamp AS event_time_raw, event_time AS event_time_local, "
            f"CAST(NULL AS VARCHAR) AS event_time_timezone, client_id, sku, url AS url_id, query AS query_vector_raw, source_file, "
            f"{lineage} FROM e"),
        "stg_products": with_products(
            f" SELECT {PRODUCT_ID} AS record_id, {product_message}, sku, category AS category_id, price AS price_bucket, "
            f"name AS name_vector_raw, '{fixed.PRODUCT_FILE}' AS source_file, {lineage} FROM p"),
        "daily_event_activity": with_events(" " + daily),
        "daily_event_activity_incremental": with_events(" " + daily),
        "client_prior_day": with_events(" " + activity, ACTIVITY),
        "client_product_candidates": with_events(" SELECT * FROM pairs", PAIRS),
        "feature_snapshot": with_events(f" SELECT {KEYS}, {COUNTS} FROM snap", *SNAP),
        "run_event_counts": with_events(
            f" SELECT event_type, count(*) AS event_count FROM e WHERE event_time < TIMESTAMP '{HALF} 00:00:00' GROUP BY ALL"),
        "reconcile_counts": "SELECT * FROM (VALUES ('landing_events'), ('stg_events'), ('daily_event_activity')) v(layer), "
                            "(SELECT count(*) AS row_count FROM events) UNION ALL SELECT 'landing_products', count(*) FROM part",
        "dq_daily_grain": with_events(
            " " + status("daily_grain", "SELECT event_date_source FROM m GROUP BY event_date_source, event_type HAVING count(*) > 1"),
            f"m AS ({daily})"),
        "dq_daily_grain_broken": with_events(
            " SELECT event_date_source, event_type, CAST(2 AS BIGINT) AS row_count FROM m WHERE event_type = 'product_buy'",
            f"m AS ({daily})"),
        "dq_prior_day_grain": with_events(
            " " + status("prior_day_grain", "SELECT 1 FROM activity GROUP BY client_id, feature_as_of_date_source HAVING count(*) > 1"),
            ACTIVITY),
        "dq_prior_day_grain_broken": with_events(
            " SELECT client_id, feature_as_of_date_source, CAST(2 AS BIGINT) AS row_count FROM activity "
            "WHERE purchases_previous_day > 1", ACTIVITY),
        "dq_candidate_grain": with_events(
            " " + status("candidate_grain", "SELECT 1 FROM pairs GROUP BY client_id, sku, feature_as_of_date_source "
                         "HAVING count(*) > 1 OR client_id IS NULL OR sku IS NULL"), PAIRS),
        "dq_candidate_grain_broken": with_events(
            f" SELECT {KEYS}, count(*) AS row_count FROM (SELECT * FROM n UNION ALL SELECT * FROM n WHERE purchases_previous_day > 0) "
            "GROUP BY ALL HAVING count(*) > 1 OR client_id IS NULL", PAIRS,
            "n AS (SELECT * REPLACE (CASE WHEN sku <> 7 THEN client_id END AS client_id) FROM pairs)"),
        "dq_daily_totals": with_events(
            " " + status("daily_totals", "SELECT 1 WHERE (SELECT sum(event_count) FROM m) <> (SELECT count(*) FROM e)"),
            f"m AS ({daily})"),
        "dq_daily_totals_broken": with_events(
            f" SELECT count(*) AS staged_events, count(*) + {buys} AS summed_events FROM e"),
        "dq_prior_day_totals": with_events(
            " " + status("prior_day_totals", "SELECT 1 WHERE (SELECT sum(events_previous_day) FROM activity) <> (SELECT count(*) FROM e)"),
            ACTIVITY),
        "dq_prior_day_totals_broken": with_events(
            " SELECT (SELECT count(*) FROM e) AS staged_events, CAST(sum(events_previous_day) AS BIGINT) AS summed_events "
            "FROM activity WHERE purchases_previous_day = 0", ACTIVITY),
        "dq_snapshot_integrity": with_events(
            " " + status("snapshot_integrity", f"(SELECT {KEYS} FROM pairs EXCEPT ALL SELECT {KEYS} FROM snap) UNION ALL "
                         f"(SELECT {KEYS} FROM snap EXCEPT ALL SELECT {KEYS} FROM pairs)"), *SNAP),
        "dq_snapshot_integrity_broken": with_events(f" SELECT {KEYS} FROM pairs WHERE sku IN (3, 5, 9)", PAIRS),
        "dq_not_null_unique": with_events(
            f" {no_row} UNION ALL SELECT 'event_sku_not_null', count(*) FILTER (sku IS NULL) FROM e "
            "UNION ALL SELECT 'redelivered_event_id_unique', count(*) FILTER (sku < 20) FROM e"),
        "dq_null_counts": with_events(" " + nulls, JUDGED),
        "dq_source_row_unique": with_events(
            " SELECT source_file, source_row_number, CAST(2 AS BIGINT) AS row_count FROM e WHERE sku < 10"),
    }


def _features():
    summary = long([("feature_rows", "count(*)"), ("distinct_clients", "count(DISTINCT client_id)"),
                    ("sku_interactions", "sum(n)"), ("skipped_sku_rows", "max(skipped)")], "s")
    day_rows = f"event_time >= {DAY_START} AND event_time < {DAY_END}"
    day_summary = (f"s AS (SELECT client_id, sku, count(*) AS n, 0 AS skipped FROM e WHERE sku IS NOT NULL AND {day_rows} GROUP BY ALL)")
    unnamed = "(client_id = 3 OR sku = 4)"
    all_summary = (f"s AS (SELECT client_id, sku, CAST(event_time AS DATE) AS day, count(*) AS n, (SELECT count(*) FROM e "
                   f"WHERE sku IS NOT NULL AND {unnamed}) AS skipped FROM e WHERE sku IS NOT NULL AND NOT {unnamed} GROUP BY ALL)")
    label_rows = [("label_rows", "count(*)"), ("matching_purchase_rows", "sum(matching)"),
                  ("pairs_with_purchase", "count(*) FILTER (purchase_observed_within_7d)"),
                  ("pairs_without_purchase", "count(*) FILTER (NOT purchase_observed_within_7d)")]
    day_labels = f"(SELECT * FROM lab WHERE {ON_DAY})"
    bad_times = "SELECT count(*) AS n FROM e WHERE event_type = 'product_buy' AND sku = 6 AND EXISTS " \
                "(SELECT 1 FROM snap s WHERE s.client_id = e.client_id AND s.sku = 6{day})"
    bad = {where: "SELECT 'invalid_candidate_timestamps' AS measure, n AS value FROM (" + bad_times.format(day=text) + ")"
           for where, text in (("day", f" AND s.{ON_DAY}"), ("all", ""))}
    guards = long([("feature_rows", "count(*) + count(*) FILTER (sku = 5)"),
                   ("as_of_dates", "count(DISTINCT feature_as_of_date_source)"),
                   ("duplicate_pairs", "count(*) FILTER (sku = 5)")], "snap")
    by_type = long([(kind, f"count(*) FILTER (event_type = '{kind}')") for kind in fixed.SKU_EVENT_TYPES]
                   + [("total_sku_events", "count(*)"), ("rows_missing_ids", "count(*) FILTER (sku IS NULL)")],
                   f"(SELECT * FROM e WHERE sku IS NOT NULL AND {day_rows})")
    candidate = long([("candidate_pairs", "count(*)"), ("distinct_clients", "count(DISTINCT client_id)"), *label_rows[1:]], day_labels)
    snapshot = f" SELECT {KEYS}, {COUNTS}, {HOURS} FROM snap"
    labels = f" SELECT {LABEL_COLUMNS} FROM lab"
    prof = []
    for kind in fixed.EVENT_TYPES:
        own = {"page_visit": "url", "search_query": "query"}.get(kind, "sku")
        for column, sql in (("client_id", "client_id"), ("timestamp", "stamp"), (own, own)):
            low, high = (f"CAST({side}({sql}) AS VARCHAR)" if own != "query" or column != "query" else "CAST(NULL AS VARCHAR)"
                         for side in ("min", "max"))
            prof.append(f"SELECT '{kind}.parquet' AS source_file, '{column}' AS column_name, count(*) AS total_rows, "
                        f"count(*) FILTER ({sql} IS NULL) AS null_count, {low} AS min_value, {high} AS max_value "
                        f"FROM e WHERE event_type = '{kind}'")
    for column in ("sku", "category", "price", "name"):
        low, high = (f"CAST({side}({column}) AS VARCHAR)" if column != "name" else "CAST(NULL AS VARCHAR)" for side in ("min", "max"))
        prof.append(f"SELECT '{fixed.PRODUCT_FILE}', '{column}', count(*), count(*) FILTER ({column} IS NULL), {low}, {high} FROM p")
    return {
        "offline_snapshot": with_events(snapshot + f" WHERE {ON_DAY}", *SNAP),
        "snapshot_by_date": with_events(snapshot, *SNAP),
        "snapshot_rebuilt": with_events(snapshot, *SNAP),
        "labels_rebuilt": with_events(labels, *LABELLED),
        "snapshot_summary": with_events(" " + summary, day_summary),
        "snapshot_summary_unnamed": with_events(" " + summary, all_summary),
        "purchase_labels": with_events(labels + f" WHERE {ON_DAY}", *LABELLED),
        "labels_by_date": with_events(labels, *LABELLED),
        "labels_any_window": with_events(
            " SELECT c.client_id, c.sku, feature_as_of_date_source, window_start, count(e.event_time) AS purchases_in_window, "
            "min(e.event_time) AS first_purchase_at_source FROM (SELECT client_id, sku, CAST(event_time AS DATE) + 1 AS feature_as_of_date_source, "
            "max(event_time) + INTERVAL 1 SECOND AS window_start FROM e WHERE sku IS NOT NULL GROUP BY ALL) c "
            "LEFT JOIN e ON e.event_type = 'product_buy' AND e.client_id = c.client_id AND e.sku = c.sku AND e.event_time >= window_start "
            "AND e.event_time < window_start + INTERVAL 36 HOUR GROUP BY ALL"),
        "label_summary": with_events(" " + long(label_rows, day_labels), *LABELLED),
        "label_guard_counts": with_events(
            f" {guards} UNION ALL SELECT 'rows_of_other_dates', count(*) + count(*) FILTER (sku = 5) FROM snap WHERE NOT ({ON_DAY}) "
            f"UNION ALL {bad['all']}", *SNAP),
        "snapshot_from_orders": ",".join([ORDER_EVENTS, *SNAP]) + snapshot,
        "labels_from_orders": ",".join([ORDER_EVENTS, *LABELLED]) + labels,
        "profile_tables": "WITH " + EVENTS + "," + PRODUCTS + " " + " UNION ALL ".join(prof),
        "validate_sources": with_events(
            " SELECT CASE WHEN event_type IS NULL THEN 'total' ELSE event_type || '.parquet' END AS source_file, 'row_count' AS problem, "
            "CAST(NULL AS VARCHAR) AS item, CAST(count(*) + 1 AS VARCHAR) AS expected, CAST(count(*) AS VARCHAR) AS found "
            "FROM e GROUP BY GROUPING SETS ((event_type), ()) HAVING event_type IS NULL OR event_type = 'search_query' UNION ALL "
            "SELECT * FROM (VALUES ('search_query.parquet', 'column', 'timestamp', 'date', 'string'), "
            "('product_buy.parquet', 'column', 'price', 'int', NULL), ('page_visit.parquet', 'column', 'url', NULL, 'bigint'))"),
        "validate_source": with_events(
            " SELECT 'search_query.parquet' AS source_file, count(*) FILTER (event_type = 'search_query') + 1 AS expected_rows, "
            "count(*) FILTER (event_type = 'search_query') AS found_rows FROM e UNION ALL "
            f"SELECT '{fixed.PRODUCT_FILE}', count(*), NULL FROM part UNION ALL "
            "SELECT 'total', (SELECT count(*) FROM part) + count(*) + 1, count(*) FROM e"),
        "profile_candidates": with_events(f" {by_type} UNION ALL {candidate} UNION ALL {bad['day']}", *LABELLED),
        "audit_labels": with_events(f" {long(label_rows, day_labels)} UNION ALL {bad['day']}", *LABELLED),
        "audit_first_purchases": with_events(
            f" SELECT client_id, sku, first_purchase_at_source FROM lab WHERE {ON_DAY} AND purchase_observed_within_7d "
            "ORDER BY first_purchase_at_source, client_id, sku LIMIT 5", *LABELLED),
    }


def _models():
    base = (*LABELLED, SCORED)
    timed = (*base, TIMED)
    guard_names = ["no_feature_rows", "duplicate_feature_keys", "duplicate_label_keys", "keys_differ", "unexpected_as_of_date",
                   "missing_label", "non_finite_feature", "positive_without_hours", "negative_with_hours", "hours_outside_window"]
    positive = "coalesce(purchase_observed_within_7d, FALSE)"
    counted = {
        "no_feature_rows": "CAST(count(*) = 0 AS INTEGER)",
        "duplicate_feature_keys": "count(*) FILTER (sku = 10)",
        "duplicate_label_keys": "count(*) FILTER (sku = 13)",
        "keys_differ": "count(*) FILTER (sku = 11)",
        # 2024-01-02 .. 2024-01-22 are expected; product 10 counts twice, product 11 has no features.
        "unexpected_as_of_date": "coalesce(sum(CASE sku WHEN 10 THEN 2 WHEN 11 THEN 0 ELSE 1 END) FILTER "
                                 "(feature_as_of_date_source NOT BETWEEN DATE '2024-01-02' AND DATE '2024-01-22'), 0)",
        "missing_label": "count(*) FILTER (sku = 14)",
        "non_finite_feature": "count(*) FILTER (sku = 12)",
        "positive_without_hours": f"count(*) FILTER (sku = 15 AND NOT {positive})",
        "negative_with_hours": f"count(*) FILTER (sku IN (16, 17) AND NOT {positive})",
        "hours_outside_window": f"count(*) FILTER (sku = 17 AND {positive})",
    }
    guards = " UNION ALL ".join(
        f"SELECT {i} AS position, '{name}' AS guard, CAST({counted[name]} AS BIGINT) AS violations FROM lab"
        for i, name in enumerate(guard_names))
    ranks = """
r AS (SELECT score, label, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2.0::DOUBLE AS mid,
  count(*) OVER (ORDER BY score DESC) AS seen, sum(label) OVER (ORDER BY score DESC) AS hits FROM scored),
best AS (SELECT label FROM scored ORDER BY score DESC, feature_as_of_date_source, client_id, sku LIMIT 1000)"""
    figures = {
        "random_ranking_ap": "SELECT avg(label) FROM scored",
        "brier_score": "SELECT avg((label - score) ** 2) FROM scored",
        "average_precision": "SELECT avg(hits / seen) FROM r WHERE label = 1",
        "roc_auc": "SELECT (sum(mid) FILTER (label = 1) - sum(label) * (sum(label) + 1) / 2.0::DOUBLE) "
                   "/ (sum(label) * count(*) FILTER (label = 0)) FROM r",
        "precision_at_k": "SELECT avg(label) FROM best",
        "recall_at_k": "SELECT (SELECT sum(label) FROM best) / (SELECT sum(label) FROM scored)",
    }

    def table(figures):
        return " UNION ALL ".join(
            f"SELECT '{name}' AS metric, round(CAST(({sql}) AS DOUBLE), 6) AS value" for name, sql in figures.items())

    late = f"feature_as_of_date_source >= DATE '{HALF}'"
    early = f"feature_as_of_date_source < DATE '{HALF}'"
    prior_loss = "SELECT avg(-ln(least(greatest(prior, 2.220446049250313e-16), 1 - 2.220446049250313e-16))) " \
                 "FROM guessed JOIN prior USING (bucket) WHERE {half}"
    timing = {
        "training_prior_log_loss": prior_loss.format(half=early),
        "training_model_log_loss": f"SELECT avg(-ln(p_true)) FROM guessed WHERE {early}",
        "majority_bucket_accuracy": f"SELECT avg(CAST(is_majority AS INTEGER)) FROM guessed JOIN prior USING (bucket) WHERE {late}",
        "model_accuracy": f"SELECT avg(CAST(bucket = prediction AS INTEGER)) FROM guessed WHERE {late}",
        "prior_log_loss": prior_loss.format(half=late),
        "model_log_loss": f"SELECT avg(-ln(p_true)) FROM guessed WHERE {late}",
        "model_macro_f1": "SELECT avg(f1) FROM prf WHERE support + predicted > 0",
    }
    r6 = "round({0}, 6) AS {0}"
    three = ", ".join(r6.format(name) for name in ("precision", "recall", "f1"))
    macro = ", ".join(f"round(avg({name}), 6)" for name in ("precision", "recall", "f1"))
    weighted = ", ".join(f"round(sum({name} * support) / sum(support), 6)" for name in ("precision", "recall", "f1"))
    return {
        "training_rows": with_events(
            f" SELECT {KEYS}, {COUNTS}, {HOURS}, label, round(hours, 6) AS hours_to_first_purchase FROM scored", *base),
        "training_guard_counts": with_events(" " + guards, *LABELLED),
        "training_key_diff": with_events(
            f" SELECT {KEYS}, CASE sku WHEN 11 THEN 'labels' ELSE 'features' END AS only_in FROM snap WHERE sku IN (11, 12)", *SNAP),
        "ranking_metrics": with_events(" " + table(figures), *base, ranks),
        "model_split_summary": with_events(
            " SELECT CASE WHEN feature_as_of_date_source = DATE '2024-01-21' THEN 'evaluation' ELSE 'train' END AS role, "
            "count(*) AS row_count, CAST(sum(label) AS BIGINT) AS positives, count(*) FILTER (hours < 24) AS under_24h, "
            "count(*) FILTER (hours >= 24 AND hours < 72) AS hours_24_to_72, count(*) FILTER (hours >= 72) AS hours_72_to_168 FROM scored "
            "WHERE feature_as_of_date_source BETWEEN DATE '2024-01-02' AND DATE '2024-01-13' "
            "OR feature_as_of_date_source = DATE '2024-01-21' GROUP BY 1", *base),
        "model_optimum": with_events(
            ", fitted AS (SELECT label, CASE WHEN hours < 24 THEN 0 WHEN hours < 72 THEN 1 ELSE 2 END AS bucket FROM scored "
            "WHERE feature_as_of_date_source BETWEEN DATE '2024-01-02' AND DATE '2024-01-13'), "
            "classes AS (SELECT 'purchase' AS model, label AS class, count(*) AS class_rows FROM fitted GROUP BY label "
            "UNION ALL SELECT 'timing', bucket, count(*) FROM fitted WHERE label = 1 GROUP BY bucket) "
            "SELECT feature_set, model, CAST(class AS INTEGER) AS class, class_rows, CAST(class_rows AS DOUBLE) AS expected_rows, "
            "TRUE AS gradient_vanishes FROM classes, (VALUES ('counts'), ('counts+recency')) f(feature_set)", *base),
        "score_batch_summary": with_events(
            " SELECT feature_as_of_date_source, count(*) AS scored_rows, count(*) AS shares_add_up, count(*) AS probabilities_in_range "
            "FROM snap GROUP BY 1", *SNAP),
        "rank_at_k": with_events(
            f" SELECT {KEYS}, round(score, 6) AS score, label FROM scored ORDER BY score DESC, {KEYS} LIMIT 1000", *base),
        "timing_buckets": with_events(
            f" SELECT {KEYS}, round(hours, 6) AS hours_to_first_purchase, bucket FROM timed", *timed),
        "timing_prior": with_events(
            " SELECT bucket, bucket_name, bucket_rows, round(prior, 6) AS prior, is_majority FROM prior", *timed, PRIOR),
        "timing_metrics": with_events(
            " " + table(timing), *timed, PRIOR, f"rated AS (SELECT * FROM guessed WHERE {late})", PER_CLASS),
        "classification_report": with_events(
            f" SELECT bucket_name AS class_name, {three}, support FROM prf UNION ALL "
            f"SELECT 'macro avg', {macro}, CAST(sum(support) AS BIGINT) FROM prf UNION ALL "
            f"SELECT 'weighted avg', {weighted}, CAST(sum(support) AS BIGINT) FROM prf",
            *timed, "rated AS (SELECT * FROM guessed)", PER_CLASS),
    }


def _checks():
    """The fifteen mart checks, counted from the tables: all zero on the loaded rows, some not on damaged marts."""
    valid = "valid AS (SELECT * FROM j WHERE validation_error IS NULL)"
    daily = "SELECT CAST(event_time AS DATE) AS day, event_type, count(*) AS n FROM {rows} GROUP BY ALL"
    pairs = ("SELECT client_id, sku, CAST(event_time AS DATE) AS day, count(*) AS n FROM {rows} "
             "WHERE sku IS NOT NULL AND client_id IS NOT NULL GROUP BY ALL")

    def counts(rows, products, more, event_id="event_id"):
        d, p = daily.format(rows=rows), pairs.format(rows=rows)
        found = {
            "event_id_not_null": f"SELECT count(*) FROM {rows} WHERE {event_id} IS NULL",
            "event_id_unique": f"SELECT count(*) FROM (SELECT 1 FROM {rows} GROUP BY {event_id} HAVING count(*) > 1)",
            "client_id_not_null": f"SELECT count(*) FROM {rows} WHERE client_id IS NULL",
            "record_id_not_null": f"SELECT count(*) FROM {products} WHERE sku IS NULL",
            "record_id_unique": f"SELECT count(*) FROM (SELECT 1 FROM {products} GROUP BY sku HAVING count(*) > 1)",
            "product_sku_not_null": f"SELECT count(*) FROM {products} WHERE sku IS NULL",
            "event_date_not_null": f"SELECT count(*) FROM ({d}) WHERE day IS NULL",
            "event_type_not_null": f"SELECT count(*) FROM ({d}) WHERE event_type IS NULL",
            "event_count_not_null": f"SELECT count(*) FROM ({d}) WHERE n IS NULL",
            "daily_grain": f"SELECT count(*) FROM (SELECT 1 FROM ({d}) GROUP BY day, event_type HAVING count(*) > 1)",
            "prior_day_grain": f"SELECT count(*) FROM (SELECT 1 FROM (SELECT client_id, CAST(event_time AS DATE) AS day FROM {rows} "
                               "GROUP BY ALL) GROUP BY client_id, day HAVING count(*) > 1)",
            "candidate_grain": f"SELECT count(*) FROM (SELECT 1 FROM ({p}) GROUP BY client_id, sku, day HAVING count(*) > 1)",
            "daily_totals": f"SELECT CAST((SELECT sum(n) FROM ({d})) <> (SELECT count(*) FROM {rows}) AS BIGINT)",
            "prior_day_totals": f"SELECT count(*) FROM {rows} WHERE event_time IS NULL",
            "snapshot_integrity": f"SELECT count(*) FROM ({p}) WHERE n < 1",
            **more,
        }
        return " UNION ALL ".join(f"SELECT '{name}' AS check_name, CAST(({query}) AS BIGINT) AS offending_rows" for name, query in found.items())

    broken = {
        "client_id_not_null": "SELECT count(*) FROM e WHERE sku = 1",
        "daily_grain": "SELECT count(DISTINCT CAST(event_time AS DATE)) FROM e WHERE event_type = 'product_buy'",
        "daily_totals": "SELECT CAST(count(*) > 0 AS BIGINT) FROM e WHERE event_type = 'product_buy'",
        "snapshot_integrity": f"SELECT count(*) FROM ({pairs.format(rows='e')}) WHERE sku = 6",
    }
    return {
        "end_to_end_status": with_events(" " + counts("valid", "pv", {}), JUDGED, valid, *_valid_products()),
        "end_to_end_status_broken": with_events(" " + counts("e", "pv", broken, "(source_file || ':' || source_row_number)"), *_valid_products()),
    }


def _valid_products():
    return ["pv AS (SELECT p_partkey AS sku FROM part)"]


def oracle_sql() -> dict[str, str]:
    sql = {**_scans(), **_envelopes(), **_contracts(), **_landing(), **_marts(), **_features(), **_models(), **_checks()}
    unknown = set(sql) - set(REGISTRY)
    if unknown:
        raise KeyError(f"Oracles without a query: {sorted(unknown)}")
    return sql
