"""Preview of the retail topic: parsed records to a console (or any) sink."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwheel.schemas import EVENT_SCHEMA
from cartwheel.streaming.runner import start_stream

PREVIEW_FIELDS = (
    "event_timestamp",
    "event_type",
    "session_id",
    "product_id",
    "category",
    "unit_price",
    "country",
)


def preview_records(records: DataFrame) -> DataFrame:
    """B1 + B3 + C1 + B4: key/value as text, parse, keep non-null structs, 7 fields.

    Malformed values parse to a struct of nulls and therefore show as rows of nulls.
    """
    parsed = records.select(
        F.col("key").cast("string").alias("kafka_key"),
        F.col("partition"),
        F.col("offset"),
        F.col("timestamp").alias("kafka_timestamp"),
        F.from_json(F.col("value").cast("string"), EVENT_SCHEMA).alias("event"),
    ).filter(F.col("event").isNotNull())
    return parsed.select("partition", "offset", "kafka_key", *[F.col(f"event.{f}").alias(f) for f in PREVIEW_FIELDS])


def start_console_preview(records: DataFrame, checkpoint: str):
    """A5: console sink, no truncation, default trigger."""
    return start_stream(
        preview_records(records), None, checkpoint, fmt="console", processing_time=None, options={"truncate": "false"}
    )
