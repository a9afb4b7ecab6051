"""Fixed values.

These strings and numbers are part of the data contract: ids, topics, file
names, error texts and limits must be exactly these for results to agree with
records that already exist elsewhere. They are stated here once, in one place.
"""

# Identity and versions.
SCHEMA_VERSION = "1.0.0"
DATASET = "synerise_recsys_2025"
ID_NAMESPACE = "44e4330d-8108-5d1f-b93b-65eb8c58a82f"

# Topics.
EVENT_TOPIC = "ecommerce.events.v1"
PRODUCT_TOPIC = "ecommerce.products.v1"
DLQ_TOPIC = "ecommerce.events.dlq.v1"

# Message headers.
MESSAGE_HEADERS = {
    "content-type": "application/json",
    "schema-version": "1.0.0",
}

# Source file of every event type, and the product file.
EVENT_FILES = {
    "add_to_cart": "add_to_cart.parquet",
    "page_visit": "page_visit.parquet",
    "product_buy": "product_buy.parquet",
    "remove_from_cart": "remove_from_cart.parquet",
    "search_query": "search_query.parquet",
}
PRODUCT_FILE = "product_properties.parquet"

EVENT_TYPES = list(EVENT_FILES)
SKU_EVENT_TYPES = ["add_to_cart", "product_buy", "remove_from_cart"]

# Formats and patterns.
SOURCE_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
SOURCE_TIME_PATTERN = r"^[0-9]{4}-[0-9]{2}-[0-9]{2} [0-9]{2}:[0-9]{2}:[0-9]{2}$"
PUBLISHED_FORMAT = "yyyy-MM-dd'T'HH:mm:ssX"
UUID_PATTERN = (
    r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$"
)
VECTOR_PATTERN = r"^\[.*\]$"

# Error type and texts of records that cannot be built.
BUILD_ERROR_TYPE = "ValueError"
MSG_UNSUPPORTED_FILE = "Unsupported behavioral source file: "
MSG_NOT_INTEGER = " must be an integer"
MSG_NEGATIVE = " must be non-negative"
MSG_NOT_STRING = " must be a string"
MSG_TIME_FORMAT = "timestamp must use YYYY-MM-DD HH:MM:SS format"
MSG_TIME_CALENDAR = "timestamp is not a valid calendar timestamp"
MSG_QUERY_VECTOR = "query must be a bracketed serialized vector"
MSG_NAME_VECTOR = "name must be a bracketed serialized vector"
MSG_PRICE_RANGE = "price must be between 0 and 99"

# Processing stages a dead letter can come from.
STAGE_TRANSFORMATION = "transformation"
STAGE_CONTRACT = "contract_validation"

# Highest price bucket, label window, model settings.
MAX_PRICE_BUCKET = 99
LABEL_DAYS = 7
TOP_K = 1000
MAX_ITERATIONS = 2000
PURCHASE_C = 1.0
TIMING_C = 0.01
TIMING_EDGES_HOURS = (24.0, 72.0)
TIMING_BUCKET_NAMES = ["under 24h", "24-72h", "72-168h"]

# Model inputs, in the order the models expect them.
COUNT_FEATURES = [
    "events_previous_day",
    "page_visits_previous_day",
    "search_previous_day",
    "client_cart_additions_previous_day",
    "client_cart_removals_previous_day",
    "client_purchases_previous_day",
    "distinct_skus_previous_day",
    "sku_interactions_previous_day",
    "sku_cart_additions_previous_day",
    "sku_cart_removals_previous_day",
    "sku_purchases_previous_day",
]
RECENCY_FEATURES = [
    "hours_since_last_client_event",
    "hours_since_last_sku_event",
]
SNAPSHOT_KEYS = ["feature_as_of_date_source", "client_id", "sku"]
