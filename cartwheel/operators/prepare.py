"""Prepare raw browsing events (X1): filter product actions, map them to standard
event types, enrich with the catalogue, derive ids and dates, and write a clustered,
date-partitioned table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwheel.functions.events import click_event_id, epoch_ms_to_ts, map_action, utc_date
from cartwheel.schemas import CLICK_SOURCE, PREPARED_COLUMNS, PRODUCT_ACTIONS


def dedup_catalog(catalog: DataFrame) -> DataFrame:
    """One row per product_sku_hash with category_hash and an integer price_bucket.

    The survivor is deterministic: smallest category_hash, then smallest bucket,
    nulls last in both. Buckets that are not numbers (NaN, +-inf, out of int range)
    become null instead of failing the job. The aggregate is partial (map-side), so
    a sku that appears in a third of all rows is collapsed before the shuffle.
    """
    bucket = F.col("price_bucket").try_cast("int")
    pick = F.struct(
        F.col("category_hash").isNull().alias("category_missing"),
        F.col("category_hash").alias("category_hash"),
        bucket.isNull().alias("bucket_missing"),
        bucket.alias("price_bucket"),
    )
    return (
        catalog.select("product_sku_hash", pick.alias("pick"))
        .groupBy("product_sku_hash")
        .agg(F.min("pick").alias("pick"))
        .select(
            "product_sku_hash",
            F.col("pick.category_hash").alias("category_hash"),
            F.col("pick.price_bucket").alias("price_bucket"),
        )
    )


def product_events(browsing: DataFrame) -> DataFrame:
    """C4: keep rows whose product_action is one of the four product actions."""
    return browsing.filter(F.col("product_action").isin(*PRODUCT_ACTIONS))


def prepare_events(browsing: DataFrame, catalog: DataFrame, source: str = CLICK_SOURCE) -> DataFrame:
    """Prepared clickstream events (11 columns, see ``PREPARED_COLUMNS``).

    Events with a null or unknown sku are kept with null category and bucket (left
    join). Adaptive execution broadcasts the deduplicated catalogue if its measured
    bytes are few and splits a hot sku otherwise. Events without a sku match nothing;
    they join under a text of their session that no sku equals, so that they do not all
    meet in one task.
    """
    products = dedup_catalog(catalog).withColumnRenamed("product_sku_hash", "_sku").where("_sku is not null")
    events = product_events(browsing).withColumn("_key", F.coalesce(
        F.col("product_sku_hash"), F.concat(F.lit("\u0000"), F.coalesce("session_id_hash", F.lit("")))))
    enriched = events.join(products, F.col("_key") == F.col("_sku"), "left")
    event_ts = epoch_ms_to_ts("server_timestamp_epoch_ms")
    return enriched.select(
        F.lit(source).alias("source"),
        click_event_id().alias("source_event_id"),
        F.col("session_id_hash").alias("session_id"),
        map_action("product_action").alias("event_type"),
        event_ts.alias("event_timestamp"),
        F.col("product_sku_hash").alias("product_id"),
        "category_hash",
        "price_bucket",
        "hashed_url",
        F.col("product_action").alias("source_product_action"),
        utc_date(event_ts).alias("event_date"),
    )


def cluster_for_write(prepared: DataFrame, partitions: int | None = None) -> DataFrame:
    """Rows of one (event_date, session_id) together, sorted inside each task.

    A rebalance on (date, session) reads the input once (range partitioning would first
    run the whole scan and join for its sample) and adaptive execution cuts partitions
    above its target size, so neither a large day nor a huge session fills a task. The
    partition column leads the sort so the writer's own sort does not undo it.
    """
    keys = ("event_date", "session_id")
    width = [partitions] if partitions else []
    clustered = prepared.hint("rebalance", *width, *[F.col(k) for k in keys])
    return clustered.sortWithinPartitions("event_date", "session_id", "event_timestamp")


def write_prepared(
    prepared: DataFrame,
    path: str,
    partitions: int | None = None,
    mode: str = "overwrite",
    max_records_per_file: int = 5_000_000,
) -> None:
    """Clustered, date-partitioned Parquet (files capped at ``max_records_per_file``)."""
    (
        cluster_for_write(prepared.select(*PREPARED_COLUMNS), partitions)
        .write.mode(mode)
        .option("maxRecordsPerFile", max_records_per_file)
        .partitionBy("event_date")
        .parquet(path)
    )
