"""Daily sketches of sessions and ids, stored and merged.

One scan gives a row per (event_date, event_type) with its counts, ranges and theta sketches.
Theta sketches merge without loss and know set operations, so any range of dates answers: how
many sessions, how many with a cart, with a purchase, with a cart but no purchase. Refreshing a
day reads that day only.

A sketch of 2 ** size entries is exact up to half as many values (it keeps all their hashes);
beyond, its relative standard error is 1 / sqrt(2 ** size). Estimates come with bounds of two
standard errors; those of a difference are taken from the larger set that it is cut from.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwheel.functions.metrics import null_count
from cartwheel.operators.gold import between_dates

#: log2 of a sketch's entries: exact to 32,768 values, then 0.4 % of standard error, at most 1 MB.
SIZE = 16


def day_sketches(events: DataFrame, id_col: str = "source_event_id", size: int = SIZE) -> DataFrame:
    """Counts, ranges and sketches of each (event_date, event_type): one scan, one shuffle."""
    return events.groupBy("event_date", "event_type").agg(
        F.count(F.lit(1)).alias("events"),
        F.theta_sketch_agg(id_col, size).alias("ids"),
        F.theta_sketch_agg("session_id", size).alias("sessions"),
        F.min("event_timestamp").alias("first_event"),
        F.max("event_timestamp").alias("last_event"),
        null_count("category_hash").alias("without_category"),
        null_count("price_bucket").alias("without_price_bucket"),
    )


def refresh_sketches(events: DataFrame, path: str, dates: Sequence | None = None, **kwargs) -> None:
    """Write the sketches of ``dates`` (all if None) anew; other dates stay as they are."""
    if dates is not None:
        events = events.filter(F.col("event_date").isin([F.lit(d).cast("date") for d in dates]))
    rows = day_sketches(events, **kwargs).coalesce(8)  # a handful of rows a date
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("event_date").parquet(path)


def _estimate(sketch: Column) -> Column:
    return F.coalesce(F.theta_sketch_estimate(sketch), F.lit(0).cast("long"))


def _bounds(value: str, whole: str, size: int) -> list[Column]:
    """Two standard errors around an estimate, none where the larger set is held exactly."""
    exact = F.col(whole) <= 2 ** (size - 1)
    # a part of a set is as sure as the sampled share of that set
    error = F.ceil(F.sqrt(F.col(value) * F.col(whole)) * F.lit(2.0 / 2 ** (size / 2))).cast("long")
    spread = F.when(exact, F.lit(0).cast("long")).otherwise(error)
    return [F.greatest(F.col(value) - spread, F.lit(0).cast("long")).alias(f"{value}_low"), (F.col(value) + spread).alias(f"{value}_high")]


def session_estimates(sketches: DataFrame, date_from=None, date_to=None, size: int = SIZE) -> DataFrame:
    """One row: estimated sessions, with a cart, with a purchase, with a cart and no purchase,
    with a cart or a purchase; each with bounds. Sketches of other dates are not read."""
    def merged(event_type: str | None = None) -> Column:
        of = F.col("sessions") if event_type is None else F.when(F.col("event_type") == event_type, F.col("sessions"))
        return F.theta_union_agg(of, size)

    empty = between_dates(sketches, date_from, date_to).agg(
        merged().alias("all"), merged("add_to_cart").alias("cart"), merged("purchase").alias("bought"))
    values = empty.select(
        _estimate(F.col("all")).alias("sessions"),
        _estimate(F.col("cart")).alias("cart_sessions"),
        _estimate(F.col("bought")).alias("purchase_sessions"),
        _estimate(F.theta_difference("cart", "bought")).alias("abandoned_sessions"),
        _estimate(F.theta_union("cart", "bought", size)).alias("cart_or_purchase_sessions"),
    )
    whole = {"sessions": "sessions", "cart_sessions": "cart_sessions", "purchase_sessions": "purchase_sessions",
             "abandoned_sessions": "cart_sessions", "cart_or_purchase_sessions": "cart_or_purchase_sessions"}
    return values.select("*", *[b for value, of in whole.items() for b in _bounds(value, of, size)])


def prepared_estimates(sketches: DataFrame, size: int = SIZE) -> DataFrame:
    """I1 as numbers, from the stored sketches."""
    values = sketches.agg(
        F.coalesce(F.sum("events"), F.lit(0)).alias("total_events"),
        _estimate(F.theta_union_agg("ids", size)).alias("unique_events"),
        _estimate(F.theta_union_agg("sessions", size)).alias("sessions"),
        F.min("first_event").alias("first_event"),
        F.max("last_event").alias("last_event"),
        F.sum("without_category").alias("events_without_category"),
        F.sum("without_price_bucket").alias("events_without_price_bucket"),
    )
    return values.select("*", *_bounds("unique_events", "unique_events", size), *_bounds("sessions", "sessions", size))


def type_counts(sketches: DataFrame) -> DataFrame:
    """I2 from the stored rows."""
    return sketches.groupBy("event_type").agg(F.sum("events").alias("count")).orderBy(F.desc("count"), F.asc_nulls_first("event_type"))
