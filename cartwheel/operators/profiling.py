"""Raw browsing profile (P1-P3) from one scan."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwheel.functions.metrics import null_or_blank_count


def sketch_size(rsd: float) -> int:
    """log2 of the buckets of a HyperLogLog sketch with relative standard deviation ``rsd``."""
    return min(21, max(4, math.ceil(2 * math.log2(1.04 / rsd))))


def profile_pass(browsing: DataFrame, rsd: float = 0.05) -> DataFrame:
    """One row per (event_type, product_action): all that P1, P2 and P3 are made of.

    One scan and one partial aggregate before the only shuffle; rows are not expanded.
    Distinct ids are kept as HyperLogLog sketches, which merge without loss, so the
    handful of rows gives the totals over any of its groups.
    """
    size = sketch_size(rsd)
    return browsing.groupBy("event_type", "product_action").agg(
        F.count(F.lit(1)).alias("count"),
        F.hll_sketch_agg("session_id_hash", F.lit(size)).alias("sessions"),
        F.hll_sketch_agg("product_sku_hash", F.lit(size)).alias("products"),
        F.min("server_timestamp_epoch_ms").alias("first_ms"),
        F.max("server_timestamp_epoch_ms").alias("last_ms"),
        null_or_blank_count("product_action").alias("no_action"),
        null_or_blank_count("product_sku_hash").alias("no_product"),
    )


def profile_tables(browsing: DataFrame, rsd: float = 0.05) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(P1, P2, P3) over one shared pass. The caller may ``persist()`` the pass
    (``profile_pass``) first when it shows all three, so the log is read once."""
    return split_profile(profile_pass(browsing, rsd))


def split_profile(pass_df: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """P1 (one row, also for an empty log: 0 events and estimates, null sums), P2 and P3."""
    def estimate(column: str):
        return F.coalesce(F.hll_sketch_estimate(F.hll_union_agg(column)), F.lit(0))

    metrics = pass_df.agg(
        F.coalesce(F.sum("count"), F.lit(0)).alias("total_events"),
        estimate("sessions").alias("approximate_sessions"),
        estimate("products").alias("approximate_products"),
        F.min("first_ms").alias("minimum_timestamp_ms"),
        F.max("last_ms").alias("maximum_timestamp_ms"),
        F.sum("no_action").alias("events_without_product_action"),
        F.sum("no_product").alias("events_without_product"),
    )

    def counts(name: str) -> DataFrame:
        return (pass_df.groupBy(name).agg(F.sum("count").alias("count"))
                .orderBy(F.desc("count"), F.asc_nulls_first(name)))

    return metrics, counts("event_type"), counts("product_action")


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """E12 + F1: rows per value (null is a value), count desc, value asc as tie-break."""
    return (
        df.groupBy(column)
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy(F.desc("count"), F.asc_nulls_first(column))
    )
