"""Event log access: a Kafka topic, or (reading only) a *log table* with Kafka's record
shape (key, value, topic, partition, offset, timestamp, timestampType) stored as Parquet.

Both formats return the same columns, so Bronze code does not care which it reads.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel.schemas import LOG_SCHEMA

LOG_COLUMNS = [f.name for f in LOG_SCHEMA.fields]


def read_log_stream(
    spark: SparkSession,
    fmt: str = "parquet",
    path: str | None = None,
    bootstrap_servers: str | None = None,
    topic: str | None = None,
    starting_offsets: str = "earliest",
    max_files_per_trigger: int | None = None,
    max_offsets_per_trigger: int | None = None,
    extra_options: dict[str, str] | None = None,
) -> DataFrame:
    """A1 / A2: streaming read of the log.

    ``max_offsets_per_trigger`` (Kafka) and ``max_files_per_trigger`` (log table) bound a
    micro-batch; without them the first one takes all that there is.
    """
    if fmt == "kafka":
        reader = (
            spark.readStream.format("kafka")
            .option("kafka.bootstrap.servers", bootstrap_servers)
            .option("subscribe", topic)
            .option("startingOffsets", starting_offsets)
        )
        if max_offsets_per_trigger:
            reader = reader.option("maxOffsetsPerTrigger", str(max_offsets_per_trigger))
    elif fmt == "parquet":
        reader = spark.readStream.schema(LOG_SCHEMA).format("parquet").option("path", path)
        if max_files_per_trigger:
            reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    else:
        raise ValueError(f"unknown log format {fmt!r}")
    for k, v in (extra_options or {}).items():
        reader = reader.option(k, v)
    return reader.load()


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """Batch read of a log table."""
    return spark.read.schema(LOG_SCHEMA).parquet(path)


def publish(
    records: DataFrame,
    bootstrap_servers: str,
    topic: str,
    idempotent: bool = True,
) -> None:
    """Write keyed records (``key``, ``value``) to a Kafka topic.

    The broker assigns partitions (by key) and offsets; ``acks=all`` and the idempotent
    producer avoid duplicates on retries.
    """
    writer = (
        records.select(F.col("key").cast("string"), F.col("value").cast("string"))
        .write.format("kafka")
        .option("kafka.bootstrap.servers", bootstrap_servers)
        .option("topic", topic)
    )
    if idempotent:
        writer = writer.option("kafka.acks", "all").option("kafka.enable.idempotence", "true")
    writer.save()
