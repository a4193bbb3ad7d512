"""Test stand-in for a broker: log tables with Kafka's record shape.

There is no broker in tests and the bench, so their log tables need the offsets that a
broker would have assigned. Nothing here is an operator of the library, and no job
writes through it.

Dense positions per log partition come without a one-task window: rows are range
partitioned on (partition, order) into slices, numbered inside each slice, written once
(so the numbers cannot change), and shifted by the rows of the same partition in
earlier slices, a table of at most slices + partitions rows that every task gets whole.
Payloads are made of the numbered rows, so that they are neither sorted nor shuffled.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cartwheel.session import scratch_path
from cartwheel.sources.log import LOG_COLUMNS, read_log


def assign_sequence(
    df: DataFrame,
    key: str,
    order: list[str],
    out: str = "offset",
    slices: int | None = None,
    start: int | DataFrame = 0,
) -> DataFrame:
    """Add ``out`` = 0-based position of each row among rows with the same ``key``
    ordered by ``order`` (ties broken arbitrarily), plus ``start``. Null is a key, and there
    are few keys: log partitions.

    ``start`` may be a DataFrame (key, next_offset) to continue an existing log.
    """
    spark = df.sparkSession
    if slices is None:
        slices = int(spark.conf.get("spark.sql.shuffle.partitions"))
    numbered = df.repartitionByRange(slices, key, *order).sortWithinPartitions(key, *order).select(
        "*", F.spark_partition_id().alias("_slice"), F.monotonically_increasing_id().alias("_pos"))
    path = scratch_path(spark, "sequence")
    numbered.write.option("compression", "zstd").parquet(path)
    numbered = spark.read.schema(numbered.schema).parquet(path)

    earlier = Window.partitionBy(key).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    shifts = numbered.groupBy("_slice", key).agg(F.count(F.lit(1)).alias("_n"), F.min("_pos").alias("_first")).select(
        F.col("_slice").alias("_s"), F.col(key).alias("_k"),
        (F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_first")).alias("_shift"))
    if isinstance(start, DataFrame):
        first = start.select(F.col(start.columns[0]).alias("_k0"), F.col(start.columns[1]).alias("_start"))
        shifts = shifts.join(first, F.col("_k").eqNullSafe(F.col("_k0")), "left").select(
            "_s", "_k", (F.col("_shift") + F.coalesce("_start", F.lit(0))).alias("_shift"))
    else:
        shifts = shifts.withColumn("_shift", F.col("_shift") + F.lit(int(start)))
    joined = numbered.join(F.broadcast(shifts), (F.col("_slice") == F.col("_s")) & F.col(key).eqNullSafe(F.col("_k")))
    return joined.select(*df.columns, (F.col("_pos") + F.col("_shift")).cast("long").alias(out))


def default_partition(key: str | Column, partitions: int) -> Column:
    """Stable partition of a key, never negative (keyed records keep their order)."""
    key_col = F.col(key) if isinstance(key, str) else key
    return F.pmod(F.xxhash64(key_col), F.lit(partitions)).cast("int")


def next_offsets(spark: SparkSession, path: str) -> DataFrame | None:
    """(partition, next offset) of an existing log table, or None when there is none.

    A small aggregate (one row per log partition), used to continue the numbering.
    """
    try:
        log = read_log(spark, path)
        log.schema  # noqa: B018 - resolves the path
    except AnalysisException as exc:
        if exc.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    return log.groupBy("partition").agg((F.max("offset") + 1).alias("next_offset"))


def to_log_records(
    records: DataFrame,
    topic: str,
    partition: Column,
    order: list[str],
    timestamp: Column | None = None,
    start: DataFrame | None = None,
    keyed: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Give ``records`` (columns ``key``, ``value`` as string or binary) the log shape.

    Offsets are dense per partition, in ``order`` (columns of ``records``), as a
    broker would assign them when the rows are sent in that order; ``start``
    (partition, next_offset) continues an existing log. ``keyed`` adds ``key`` and
    ``value`` to rows of ``records`` without them, after these have been numbered.
    """
    ordered = assign_sequence(
        records.withColumn("_log_partition", partition.cast("int")),
        "_log_partition",
        order,
        out="_log_offset",
        start=start if start is not None else 0,
    )
    if keyed is not None:
        ordered = keyed(ordered)
    return ordered.select(
        F.col("key").cast("binary").alias("key"),
        F.col("value").cast("binary").alias("value"),
        F.lit(topic).alias("topic"),
        F.col("_log_partition").alias("partition"),
        F.col("_log_offset").alias("offset"),
        (timestamp if timestamp is not None else F.current_timestamp()).alias("timestamp"),
        F.lit(0).alias("timestampType"),
    ).select(*LOG_COLUMNS)


def append_to_log_table(records: DataFrame, path: str, topic: str, partitions: int, order: list[str],
                        timestamp: Column | None = None) -> None:
    """Append keyed records as a broker would: partition by a stable hash of the key,
    offsets dense in ``order`` after those that are there."""
    to_log_records(records, topic, default_partition("key", partitions), order, timestamp,
                   start=next_offsets(records.sparkSession, path)).write.mode("append").parquet(path)
