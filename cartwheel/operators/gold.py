"""Gold tables: funnel, category, price segment (clickstream) and funnel, product,
country (retail).

Each family has one first level: a single ``GROUPING SETS`` aggregate with a row per
group that any of its tables needs (per session, per product, per (category, session)
and so on), combined before its only shuffle, and small finishing aggregates over it.
A builder of one table asks for that table's sets only; the builder of all three writes
the first level once, as Parquet partitioned by set, so that each table reads its own
sets and columns.

Scale notes
-----------
* Distinct session / product counts are counts of first-level rows: a hot session or
  product collapses map-side. Spark's own rewrite of several ``count(DISTINCT ..)``
  would expand every input row once per distinct expression.
* Rates are derived from the final counts, never inside the aggregate.
* Sorts add the group key as a tie-break, so the order is total and repeatable.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwheel.functions.metrics import is_type, merged_revenue_parts, pct, revenue, revenue_parts
from cartwheel.session import scratch_path


def between_dates(events: DataFrame, date_from=None, date_to=None, column: str = "event_date") -> DataFrame:
    """Optional inclusive date range on the partition column of Silver, so the scan
    reads only the matching ``event_date=`` folders (partition pruning)."""
    if date_from is not None:
        events = events.filter(F.col(column) >= F.lit(date_from).cast("date"))
    if date_to is not None:
        events = events.filter(F.col(column) <= F.lit(date_to).cast("date"))
    return events


def _set_ids(dims: tuple[str, ...], sets: dict[str, tuple[str, ...]]) -> dict[str, int]:
    # grouping_id: one bit per dimension, most significant first, 1 = not grouped
    return {name: sum(1 << (len(dims) - 1 - i) for i, d in enumerate(dims) if d not in grouped)
            for name, grouped in sets.items()}


class _Levels:
    """First-level rows of the named grouping sets of ``events``."""

    def __init__(self, rows: DataFrame, ids: dict[str, int]):
        self.rows, self.ids = rows, ids

    @classmethod
    def from_events(cls, events: DataFrame, dims: tuple[str, ...], sets: dict[str, tuple[str, ...]], aggregates: list[Column]) -> _Levels:
        rows = events.groupingSets([list(g) for g in sets.values()], *dims).agg(
            *aggregates, F.grouping_id().cast("int").alias("set_id"))
        return cls(rows, _set_ids(dims, sets))

    def write(self) -> _Levels:
        """Written once, a folder per set, and read back."""
        spark, schema = self.rows.sparkSession, self.rows.schema
        path = scratch_path(spark, "gold_levels")
        self.rows.write.partitionBy("set_id").parquet(path)
        self.rows = spark.read.schema(schema).parquet(path)
        return self

    def of(self, *names: str) -> DataFrame:
        return self.rows.filter(F.col("set_id").isin(*[self.ids[n] for n in names]))

    def is_set(self, name: str) -> Column:
        return F.col("set_id") == self.ids[name]


def _flag(event_type: str) -> Column:
    return F.when(is_type(event_type), 1).otherwise(0)


def _counts() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("n_events"),
        F.sum(_flag("product_view")).alias("n_views"),
        F.sum(_flag("add_to_cart")).alias("n_adds"),
        F.sum(_flag("remove_from_cart")).alias("n_removes"),
        F.sum(_flag("purchase")).alias("n_purchases"),
    ]


# ---- clickstream ---------------------------------------------------------------------
_CLICK_SETS = {
    "session": ("session_id",),
    "product": ("product_id",),
    "category_session": ("category", "session_id"),
    "category_product": ("category", "product_id"),
    "bucket_session": ("price_bucket", "session_id"),
}


def _click_levels(events: DataFrame, *names: str) -> _Levels:
    sets = {n: _CLICK_SETS[n] for n in names}
    dims = tuple(d for d in ("category", "price_bucket", "session_id", "product_id") if any(d in g for g in sets.values()))
    columns = {
        "category": F.coalesce(F.col("category_hash"), F.lit("unknown")).alias("category"),
        "price_bucket": F.col("price_bucket"), "session_id": F.col("session_id"), "product_id": F.col("product_id"),
    }
    return _Levels.from_events(events.select(*[columns[d] for d in dims], "event_type"), dims, sets, _counts())


def _funnel(levels: _Levels) -> DataFrame:
    """G4 from the session and product sets. A null session (or product) is a row of its
    own: it counts as events, not as a distinct value."""
    session = levels.is_set("session")
    real = session & F.col("session_id").isNotNull()
    product = levels.is_set("product") & F.col("product_id").isNotNull()

    def of_sessions(c: str) -> Column:
        return F.sum(F.when(session, F.col(c)))

    return levels.of("session", "product").agg(
        F.coalesce(of_sessions("n_events"), F.lit(0)).alias("total_events"),
        F.count_if(real).alias("total_sessions"),
        F.count_if(product).alias("total_products"),
        F.count_if(real & (F.col("n_adds") > 0)).alias("cart_sessions"),
        F.count_if(real & (F.col("n_purchases") > 0)).alias("purchase_sessions"),
        of_sessions("n_views").alias("product_views"),
        of_sessions("n_adds").alias("cart_additions"),
        of_sessions("n_removes").alias("cart_removals"),
        of_sessions("n_purchases").alias("purchases"),
    ).select(
        "*",
        pct("cart_sessions", "total_sessions").alias("view_to_cart_rate"),
        pct("purchase_sessions", "total_sessions").alias("purchase_conversion_rate"),
        pct("purchase_sessions", "cart_sessions").alias("cart_to_purchase_rate"),
    )


def _categories(levels: _Levels) -> DataFrame:
    """G5 from the (category, session) and (category, product) sets."""
    session, product = levels.is_set("category_session"), levels.is_set("category_product")

    def of_sessions(c: str) -> Column:
        return F.sum(F.when(session, F.col(c)))

    return levels.of("category_session", "category_product").groupBy("category").agg(
        F.count_if(session & F.col("session_id").isNotNull()).alias("sessions"),
        F.count_if(product & F.col("product_id").isNotNull()).alias("products"),
        of_sessions("n_views").alias("product_views"),
        of_sessions("n_adds").alias("cart_additions"),
        of_sessions("n_purchases").alias("purchases"),
    ).select(
        "*", pct("purchases", "product_views").alias("purchase_per_view_rate")
    ).orderBy(F.desc("purchases"), F.asc("category"))


def _price_segments(levels: _Levels) -> DataFrame:
    """G6 from the (bucket, session) set; ordered as numbers before they become text."""
    return levels.of("bucket_session").groupBy("price_bucket").agg(
        F.sum("n_events").alias("events"),
        F.count("session_id").alias("sessions"),
        F.sum("n_views").alias("product_views"),
        F.sum("n_adds").alias("cart_additions"),
        F.sum("n_purchases").alias("purchases"),
    ).orderBy(F.asc_nulls_last("price_bucket")).select(
        F.coalesce(F.col("price_bucket").cast("string"), F.lit("unknown")).alias("price_segment"),
        "events", "sessions", "product_views", "cart_additions", "purchases")


def price_segment_order() -> list[Column]:
    """Order of segment texts: unknown last, the others by their number."""
    number = F.col("price_segment").try_cast("int")
    return [F.asc(F.col("price_segment") == "unknown"), F.asc(number), F.asc("price_segment")]


def build_funnel(events: DataFrame) -> DataFrame:
    """One-row clickstream funnel.

    Columns: total_events, total_sessions, total_products, cart_sessions,
    purchase_sessions, product_views, cart_additions, cart_removals, purchases,
    view_to_cart_rate, purchase_conversion_rate, cart_to_purchase_rate.

    view_to_cart_rate divides cart sessions by *all* sessions, and
    cart_to_purchase_rate divides purchase sessions by cart sessions even when a
    purchase had no cart (so it can exceed 100). The four event counts are null on an
    empty input, like a SUM; the rates are null when their denominator is 0.
    """
    return _funnel(_click_levels(events, "session", "product"))


def build_category_metrics(events: DataFrame) -> DataFrame:
    """Per category (null -> "unknown"), ordered by purchases desc, category asc."""
    return _categories(_click_levels(events, "category_session", "category_product"))


def build_price_bucket_metrics(events: DataFrame) -> DataFrame:
    """Per price segment (bucket as text, null -> "unknown"), numeric order."""
    return _price_segments(_click_levels(events, "bucket_session"))


def build_gold_tables(events: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """G4, G5 and G6 from one scan of Silver: (funnel, categories, price_buckets)."""
    levels = _click_levels(events, *_CLICK_SETS).write()
    return _funnel(levels), _categories(levels), _price_segments(levels)


# ---- retail --------------------------------------------------------------------------
_RETAIL_SETS = {
    "session": ("session_id",),
    "product": ("product_id", "product_name", "category"),
    "country_session": ("country", "session_id"),
}


def _retail_levels(events: DataFrame, *names: str) -> _Levels:
    sets = {n: _RETAIL_SETS[n] for n in names}
    dims = tuple(d for d in ("session_id", "product_id", "product_name", "category", "country")
                 if any(d in g for g in sets.values()))
    return _Levels.from_events(
        events.select(*dims, "event_type", "unit_price", "quantity"), dims, sets, [*_counts(), *revenue_parts()])


def _retail_funnel(levels: _Levels) -> DataFrame:
    real = F.col("session_id").isNotNull()
    return levels.of("session").agg(
        F.count_if(real).alias("total_sessions"),
        F.count_if(real & (F.col("n_adds") > 0)).alias("cart_sessions"),
        F.count_if(real & (F.col("n_purchases") > 0)).alias("purchase_sessions"),
        *merged_revenue_parts(),
    ).select(
        "total_sessions",
        "cart_sessions",
        "purchase_sessions",
        pct("cart_sessions", "total_sessions").alias("view_to_cart_rate"),
        pct("purchase_sessions", "total_sessions").alias("purchase_conversion_rate"),
        revenue().alias("total_revenue"),
    )


def _products(levels: _Levels) -> DataFrame:
    keys = list(_RETAIL_SETS["product"])
    return levels.of("product").select(
        *keys,
        F.col("n_views").alias("product_views"),
        F.col("n_adds").alias("cart_additions"),
        F.col("n_purchases").alias("purchases"),
        revenue().alias("revenue"),
    ).orderBy(F.desc("revenue"), *[F.asc(k) for k in keys])


def _countries(levels: _Levels) -> DataFrame:
    return levels.of("country_session").groupBy("country").agg(
        F.count("session_id").alias("sessions"),
        F.sum("n_purchases").alias("purchases"),
        *merged_revenue_parts(),
    ).select("country", "sessions", "purchases", revenue().alias("revenue")).orderBy(F.desc("revenue"), F.asc("country"))


def build_funnel_metrics(events: DataFrame) -> DataFrame:
    """G1: one-row retail funnel with revenue.

    Columns: total_sessions, cart_sessions, purchase_sessions, view_to_cart_rate,
    purchase_conversion_rate, total_revenue. Rates are null instead of failing when
    there are no sessions.
    """
    return _retail_funnel(_retail_levels(events, "session"))


def build_product_metrics(events: DataFrame) -> DataFrame:
    """Per (product_id, product_name, category), ordered by revenue desc."""
    return _products(_retail_levels(events, "product"))


def build_country_metrics(events: DataFrame) -> DataFrame:
    """Per country, ordered by revenue desc."""
    return _countries(_retail_levels(events, "country_session"))


def build_retail_gold_tables(events: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """G1, G2 and G3 from one scan of Silver R: (funnel, products, countries)."""
    levels = _retail_levels(events, *_RETAIL_SETS).write()
    return _retail_funnel(levels), _products(levels), _countries(levels)


# ---- by day --------------------------------------------------------------------------
# The first level is kept for each event_date, so that a day's Silver is read when that day
# is refreshed and never again. A session or product of several days has a row in each of
# them; the rows of a key are added up before the tables are finished.
DAY = "event_date"


def _family_levels(family: str) -> tuple[tuple[str, ...], dict[str, tuple[str, ...]], list[Column], list[Column]]:
    """(dimensions, sets, first-level aggregates, the same over first-level rows)."""
    sums = [F.sum(c).alias(c) for c in ("n_events", "n_views", "n_adds", "n_removes", "n_purchases")]
    if family == "click":
        return ("category", "price_bucket", "session_id", "product_id"), _CLICK_SETS, _counts(), sums
    if family == "retail":
        return (("session_id", "product_id", "product_name", "category", "country"), _RETAIL_SETS,
                [*_counts(), *revenue_parts()], [*sums, *merged_revenue_parts()])
    raise ValueError(f"unknown family {family!r}")


def day_levels(events: DataFrame, family: str, dates: Sequence | None = None) -> DataFrame:
    """First-level rows of each date (of ``dates``, all if None): one scan of those dates."""
    dims, sets, aggregates, _ = _family_levels(family)
    if dates is not None:
        events = events.filter(F.col(DAY).isin([F.lit(d).cast("date") for d in dates]))
    if family == "click":
        events = events.withColumn("category", F.coalesce("category_hash", F.lit("unknown")))
    # the date is in every set, so its bit of the grouping id is 0 and the ids are those without it
    by_day = {name: (DAY, *grouped) for name, grouped in sets.items()}
    return _Levels.from_events(events, (DAY, *dims), by_day, aggregates).rows


def refresh_days(events: DataFrame, path: str, family: str, dates: Sequence | None = None) -> None:
    """Write the first level of ``dates`` (all if None) anew; other dates stay as they are.

    Only the folders of dates that have rows are replaced (dynamic partition overwrite).
    """
    rows = day_levels(events, family, dates)
    rows.hint("rebalance", DAY).sortWithinPartitions(DAY, "set_id").write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic").partitionBy(DAY).parquet(path)


def daily_gold_tables(levels: DataFrame, family: str, date_from=None, date_to=None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The three Gold tables of a family from stored first-level rows, of a range of dates."""
    dims, sets, _, again = _family_levels(family)
    rows = between_dates(levels, date_from, date_to).groupBy("set_id", *dims).agg(*again)
    merged = _Levels(rows, _set_ids(dims, sets)).write()
    if family == "click":
        return _funnel(merged), _categories(merged), _price_segments(merged)
    return _retail_funnel(merged), _products(merged), _countries(merged)
