"""Bronze: every log record kept unchanged, with its log position."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwheel.streaming.runner import run_to_completion, start_stream


def to_bronze(records: DataFrame) -> DataFrame:
    """B2: log record -> Bronze row. Works on streaming and batch frames alike.

    ``ingested_at`` is the micro-batch clock (one value per batch).
    """
    return records.select(
        F.col("key").cast("string").alias("kafka_key"),
        F.col("value").cast("string").alias("raw_json"),
        F.col("topic").alias("kafka_topic"),
        F.col("partition").alias("kafka_partition"),
        F.col("offset").alias("kafka_offset"),
        F.col("timestamp").alias("kafka_timestamp"),
        F.current_timestamp().alias("ingested_at"),
    ).withColumn("ingestion_date", F.to_date("ingested_at"))


def start_bronze(records: DataFrame, path: str, checkpoint: str, processing_time: str = "5 seconds"):
    """Production Bronze writer: 5 s micro-batches, partitioned by ingestion date."""
    return start_stream(
        to_bronze(records), path, checkpoint, partition_by=["ingestion_date"], processing_time=processing_time
    )


def run_bronze(records: DataFrame, path: str, checkpoint: str) -> None:
    """Bounded Bronze run (availableNow): drain the log, then stop."""
    run_to_completion(to_bronze(records), path, checkpoint, partition_by=["ingestion_date"])
