"""Inspection of the prepared, Bronze and Silver layers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwheel.functions.metrics import null_count
from cartwheel.operators.profiling import value_counts

SAMPLE_COLUMNS = (
    "source_event_id",
    "session_id",
    "event_type",
    "event_timestamp",
    "product_id",
    "category_hash",
    "price_bucket",
)


def prepared_quality(events: DataFrame, rsd: float = 0.05) -> DataFrame:
    """I1."""
    return events.agg(
        F.count(F.lit(1)).alias("total_events"),
        F.approx_count_distinct("source_event_id", rsd).alias("approximate_unique_events"),
        F.approx_count_distinct("session_id", rsd).alias("approximate_sessions"),
        F.min("event_timestamp").alias("first_event"),
        F.max("event_timestamp").alias("last_event"),
        null_count("category_hash").alias("events_without_category"),
        null_count("price_bucket").alias("events_without_price_bucket"),
    )


def prepared_type_counts(events: DataFrame) -> DataFrame:
    """I2."""
    return value_counts(events, "event_type")


def prepared_sample(events: DataFrame, n: int = 5) -> DataFrame:
    """A repeatable sample of ``n`` rows (lowest ids), 7 columns.

    ``orderBy().limit(n)`` plans as a top-k (TakeOrderedAndProject): each task keeps
    n rows, so nothing large reaches one task or the driver.
    """
    return events.select(*SAMPLE_COLUMNS).orderBy("source_event_id", "session_id", "event_timestamp").limit(n)


def bronze_metrics(bronze: DataFrame) -> DataFrame:
    """I4: records and distinct keys (sessions)."""
    return bronze.agg(
        F.count(F.lit(1)).alias("total_events"),
        F.count_distinct("kafka_key").alias("unique_sessions"),
    )


def partition_offsets(df: DataFrame) -> DataFrame:
    """Records and offset range per log partition, by partition."""
    return (
        df.groupBy("kafka_partition")
        .agg(
            F.count(F.lit(1)).alias("event_count"),
            F.min("kafka_offset").alias("first_offset"),
            F.max("kafka_offset").alias("last_offset"),
        )
        .orderBy("kafka_partition")
    )


def offset_gaps(df: DataFrame) -> DataFrame:
    """Offsets missing per partition = last - first + 1 - distinct offsets.

    Zero everywhere means the offsets are continuous (no record lost between the log
    and the table); repeated offsets (a record written twice) show in ``duplicates``.
    Distinct offsets are counted in bitmaps of neighbouring offsets, which fill up before
    the shuffle: a few rows per partition and task travel, not one per record.
    """
    offset = F.col("kafka_offset")
    per_bucket = df.groupBy("kafka_partition", F.bitmap_bucket_number(offset).alias("_bucket")).agg(
        F.count(F.lit(1)).alias("event_count"),
        F.bitmap_count(F.bitmap_construct_agg(F.bitmap_bit_position(offset))).alias("distinct_offsets"),
        F.min(offset).alias("first_offset"),
        F.max(offset).alias("last_offset"),
    )
    return (
        per_bucket.groupBy("kafka_partition")
        .agg(
            F.sum("event_count").alias("event_count"),
            F.sum("distinct_offsets").alias("distinct_offsets"),
            F.min("first_offset").alias("first_offset"),
            F.max("last_offset").alias("last_offset"),
        )
        .select(
            "kafka_partition",
            "event_count",
            (F.col("last_offset") - F.col("first_offset") + 1 - F.col("distinct_offsets")).alias("missing_offsets"),
            (F.col("event_count") - F.col("distinct_offsets")).alias("duplicates"),
        )
        .orderBy("kafka_partition")
    )


def _events_and_sessions(silver: DataFrame, id_col: str, flags: dict[str, F.Column]) -> DataFrame:
    """Totals with distinct ids and sessions in two levels: one row per id and per
    session from a single GROUPING SETS aggregate (each row expanded twice, partial
    aggregation before the shuffle), then one global aggregate. Null ids / sessions
    are counted as events but not as distinct values, as ``count(DISTINCT)`` does."""
    levels = silver.select(id_col, "session_id", *[c.alias(n) for n, c in flags.items()]).groupingSets(
        [[id_col], ["session_id"]], id_col, "session_id"
    ).agg(
        F.count(F.lit(1)).alias("_n"),
        *[F.sum(n).alias(n) for n in flags],
        F.grouping("session_id").alias("_by_id"),
    )
    by_id = F.col("_by_id") == 1
    return levels.agg(
        F.coalesce(F.sum(F.when(by_id, F.col("_n"))), F.lit(0)).alias("total_events"),
        F.count(F.when(by_id & F.col(id_col).isNotNull(), F.lit(1))).alias("unique_events"),
        F.count(F.when(~by_id & F.col("session_id").isNotNull(), F.lit(1))).alias("unique_sessions"),
        *[F.sum(F.when(by_id, F.col(n))).alias(n) for n in flags],
    )


def silver_retail_metrics(silver: DataFrame) -> DataFrame:
    """total_events, unique_events, unique_sessions."""
    return _events_and_sessions(silver, "event_id", {})


def silver_type_counts_by_type(silver: DataFrame) -> DataFrame:
    """I7 (first part): rows per event type, ordered by type."""
    return silver.groupBy("event_type").agg(F.count(F.lit(1)).alias("count")).orderBy("event_type")


def silver_country_counts(silver: DataFrame) -> DataFrame:
    """I7 (second part): rows per country, count desc."""
    return value_counts(silver, "country")


def silver_click_metrics(silver: DataFrame) -> DataFrame:
    """I8: totals, distinct ids and sessions, missing categories and buckets."""
    return _events_and_sessions(
        silver,
        "source_event_id",
        {
            "missing_categories": F.when(F.col("category_hash").isNull(), 1).otherwise(0),
            "missing_price_buckets": F.when(F.col("price_bucket").isNull(), 1).otherwise(0),
        },
    )


def silver_click_type_counts(silver: DataFrame) -> DataFrame:
    """I9."""
    return value_counts(silver, "event_type")


def layer_reconciliation(log: DataFrame, bronze: DataFrame, silver: DataFrame, quarantine: DataFrame,
                         late: int = 0) -> DataFrame:
    """Records per layer in one row, the late ones and the duplicates Silver removed.

    Every log record must reach Bronze; every Bronze record ends in Silver, in the
    quarantine, is dropped as late (behind the watermark; ``late`` as the Silver run
    counted them) or is a removed duplicate: duplicates_removed = bronze - silver -
    quarantined - late. Each layer is one count (a partial aggregate); the counts are
    combined by a conditional sum over four one-row results.
    """
    layers = (
        log.agg(F.count(F.lit(1)).alias("n")).select(F.lit("log").alias("layer"), "n")
        .unionByName(bronze.agg(F.count(F.lit(1)).alias("n")).select(F.lit("bronze").alias("layer"), "n"))
        .unionByName(silver.agg(F.count(F.lit(1)).alias("n")).select(F.lit("silver").alias("layer"), "n"))
        .unionByName(quarantine.agg(F.count(F.lit(1)).alias("n")).select(F.lit("quarantine").alias("layer"), "n"))
    )

    def of(name: str):
        return F.sum(F.when(F.col("layer") == name, F.col("n")))

    return layers.agg(
        of("log").alias("log_records"),
        of("bronze").alias("bronze_records"),
        of("silver").alias("silver_records"),
        of("quarantine").alias("quarantined_records"),
        F.lit(late).cast("long").alias("late_records"),
        (of("bronze") - of("silver") - of("quarantine") - F.lit(late)).alias("duplicates_removed"),
    )


def batch_reconciliation(log: DataFrame, bronze: DataFrame, batches: DataFrame) -> DataFrame:
    """Records per layer in one row, from the numbers that the Silver writer kept of each
    batch (``Ledger.batches``): Silver and its side layers are not counted again.

    They outlive the query and hold for streams that never end. What a running Silver has
    not read yet is ``unread_records``.
    """
    def total(name: str):
        return F.coalesce(F.sum(name), F.lit(0))

    parts = [
        log.agg(F.count(F.lit(1)).alias("log_records")),
        bronze.agg(F.count(F.lit(1)).alias("bronze_records")),
        batches.agg(total("silver").alias("silver_records"), total("quarantine").alias("quarantined_records"),
                    total("late").alias("late_records"), total("duplicates").alias("duplicates_removed"), total("rows_in").alias("_read")),
    ]
    rows = parts[0].unionByName(parts[1], allowMissingColumns=True).unionByName(parts[2], allowMissingColumns=True)
    counts = rows.agg(*[F.max(c).alias(c) for c in rows.columns])
    return counts.select("*", (F.col("bronze_records") - F.col("_read")).alias("unread_records")).drop("_read")
