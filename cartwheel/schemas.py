"""Fixed schemas of every layer.

Fixed values: the column names, order, types and declared nullability below must
equal those of the upstream records so that parsing and layer contracts match.
Spark does not enforce ``nullable=False`` on CSV or JSON input; the Silver rules do.
"""

from __future__ import annotations

from pyspark.sql.types import (
    BinaryType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

# --- fixed values: event vocabularies -------------------------------------------------
EVENT_TYPES = ("product_view", "add_to_cart", "remove_from_cart", "purchase")
PRODUCT_ACTIONS = ("detail", "add", "remove", "purchase")
# raw product_action -> standard event_type, in the order above
ACTION_TO_EVENT_TYPE = (
    ("detail", "product_view"),
    ("add", "add_to_cart"),
    ("remove", "remove_from_cart"),
    ("purchase", "purchase"),
)
RETAIL_CATEGORIES = ("fragrance", "skincare", "handbag", "jewellery", "accessory")
DEVICES = ("mobile", "desktop", "tablet")
CLICK_SOURCE = "coveo_sigir_2021"  # source tag of the public clickstream dataset
# ---------------------------------------------------------------------------------------

# Default topic names (configuration; every job takes --topic).
RETAIL_TOPIC = "retail-events"
CLICK_TOPIC = "clickstream-events"

# Retail (R) event as published by the producer.
EVENT_SCHEMA = StructType(
    [
        StructField("event_id", StringType(), False),
        StructField("event_type", StringType(), False),
        StructField("event_timestamp", TimestampType(), False),
        StructField("customer_id", StringType(), False),
        StructField("session_id", StringType(), False),
        StructField("product_id", StringType(), False),
        StructField("product_name", StringType(), False),
        StructField("category", StringType(), False),
        StructField("unit_price", DoubleType(), False),
        StructField("quantity", IntegerType(), False),
        StructField("country", StringType(), False),
        StructField("device", StringType(), False),
    ]
)

# Raw Kafka record kept unchanged, plus lineage (both families).
BRONZE_SCHEMA = StructType(
    [
        StructField("kafka_key", StringType(), True),
        StructField("raw_json", StringType(), True),
        StructField("kafka_topic", StringType(), True),
        StructField("kafka_partition", IntegerType(), True),
        StructField("kafka_offset", LongType(), True),
        StructField("kafka_timestamp", TimestampType(), True),
        StructField("ingested_at", TimestampType(), False),
        StructField("ingestion_date", DateType(), True),
    ]
)

# Clickstream (C) event as replayed from the prepared table.
CLICK_EVENT_SCHEMA = StructType(
    [
        StructField("source", StringType(), False),
        StructField("source_event_id", StringType(), False),
        StructField("session_id", StringType(), False),
        StructField("event_type", StringType(), False),
        StructField("event_timestamp", TimestampType(), False),
        StructField("product_id", StringType(), False),
        StructField("category_hash", StringType(), True),
        StructField("price_bucket", IntegerType(), True),
        StructField("hashed_url", StringType(), True),
        StructField("source_product_action", StringType(), True),
    ]
)

# Raw browsing log (CSV with header).
BROWSING_SCHEMA = StructType(
    [
        StructField("session_id_hash", StringType(), False),
        StructField("event_type", StringType(), True),
        StructField("product_action", StringType(), True),
        StructField("product_sku_hash", StringType(), True),
        StructField("server_timestamp_epoch_ms", LongType(), False),
        StructField("hashed_url", StringType(), True),
    ]
)

# Raw product catalogue (CSV with header).
CATALOG_SCHEMA = StructType(
    [
        StructField("product_sku_hash", StringType(), False),
        StructField("description_vector", StringType(), True),
        StructField("category_hash", StringType(), True),
        StructField("image_vector", StringType(), True),
        StructField("price_bucket", DoubleType(), True),
    ]
)

# Kafka record shape, used for the log table that stands in for a topic.
LOG_SCHEMA = StructType(
    [
        StructField("key", BinaryType(), True),
        StructField("value", BinaryType(), True),
        StructField("topic", StringType(), True),
        StructField("partition", IntegerType(), True),
        StructField("offset", LongType(), True),
        StructField("timestamp", TimestampType(), True),
        StructField("timestampType", IntegerType(), True),
    ]
)

# Columns of the prepared clickstream table, in order (event_date is the partition).
PREPARED_COLUMNS = (
    "source",
    "source_event_id",
    "session_id",
    "event_type",
    "event_timestamp",
    "product_id",
    "category_hash",
    "price_bucket",
    "hashed_url",
    "source_product_action",
    "event_date",
)

# The replayed JSON payload: the prepared columns without the partition column.
CLICK_PAYLOAD_COLUMNS = PREPARED_COLUMNS[:-1]

BRONZE_LINEAGE_R = ("kafka_key", "kafka_partition", "kafka_offset", "kafka_timestamp", "ingested_at")
BRONZE_LINEAGE_C = (
    "kafka_key",
    "kafka_topic",
    "kafka_partition",
    "kafka_offset",
    "kafka_timestamp",
    "ingested_at",
)
