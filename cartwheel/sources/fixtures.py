"""Adapters that turn the driver's generic test tables into the reference's inputs.

The driver ships ``events`` (event_id, ts, user_id, event_type, value, props) and
``part``; the reference reads a browsing log, a product catalogue, retail events and
a Kafka topic. These adapters derive those inputs with Spark from the whole tables,
and inject the faults the reference must cope with (duplicates, nulls, wrong keys,
malformed JSON, bad prices, bad country codes). The same definitions are written in
DuckDB SQL in :mod:`cartwheel.plans.oracle`; the two must stay in step.

Fixed values of the adapters (our own test-data rules; every rule of the library has
rows that break it):
  * session id = user_id || '-' || yyyyMMdd(ts)
  * raw actions: view->detail, click->add, signup->remove, purchase->purchase, error->none,
    or one blank when event_id % 17 = 0
  * retail types: view->product_view, click->add_to_cart, signup->remove_from_cart,
    purchase->purchase, error->page_error (unknown to the library)
  * exact duplicates: event_id % 50 = 0; missing sku: event_id % 89 = 0, blank sku:
    event_id % 91 = 0; missing url: event_id % 13 = 0
  * catalogue: sku = p_partkey % 100 where that is below 90 (the other skus are unknown;
    many parts per sku, so deduplication matters), category = p_brand (null when
    p_partkey % 7 = 0), bucket = ceil(p_size / 5) (null when p_partkey % 11 = 0, 0 when
    p_partkey % 5 = 0, 11 when p_partkey % 8 = 0)
  * retail faults by event_id: price negated % 83, quantity 0 % 79, country 'FRA' % 73,
    id null % 109 or 'x'.. % 53, session null % 113 or empty % 43, product null % 127 or
    empty % 41, no time % 47, customer empty % 67, name empty % 71, category 'TOYS' % 59,
    device 'tv' % 61; another customer of the session % 31, country 'XX' % 29,
    device 'tablet' % 23
  * countries by user_id % 7: PT, NL, SE, PL, GR, FI, IE
  * devices by user_id % 3: mobile, desktop, tablet
  * micro-batches: event e is in batch 1 + event_id % 4, at 2024-01-01 + 2 hours * batch +
    event_id % 600 seconds; in batch 4 those with event_id % 11 = 0 have times of batch 1
    (late); batch 1 events come again in batch 2 (event_id % 7 = 0, same state) and, with
    times of batch 4, in batch 4 (event_id % 10 = 0, state of the watermark mode expired)
  * log: partition = user % 6; key 'wrong' when event_id % 97 = 0 (retail) or
    epoch-ms % 97 = 0 (clickstream); value '{bad' when event_id % 101 = 0 (retail)
    or epoch-ms % 101 = 0 (clickstream); clickstream source 'elsewhere' when
    epoch-ms % 103 = 0; clickstream offsets % 211 = 7 are missing, % 199 = 3 come twice
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel.operators.prepare import prepare_events
from cartwheel.operators.replay import keyed_json
from cartwheel.schemas import CLICK_PAYLOAD_COLUMNS, CLICK_SOURCE, CLICK_TOPIC, EVENT_SCHEMA, RETAIL_TOPIC
from cartwheel.sources.fixture_log import to_log_records

COUNTRIES = ("PT", "NL", "SE", "PL", "GR", "FI", "IE")
DEVICE_BY_USER = ("mobile", "desktop", "tablet")
LOG_PARTITIONS = 6
#: Files of a micro-batch at least, and rows of a file beyond that.
BATCHES, BATCH_FILES, BATCH_FILE_ROWS = 4, 2, 100_000
RAW_ACTION = (("view", "detail"), ("click", "add"), ("signup", "remove"), ("purchase", "purchase"))
RETAIL_TYPE = (
    ("view", "product_view"),
    ("click", "add_to_cart"),
    ("signup", "remove_from_cart"),
    ("purchase", "purchase"),
    ("error", "page_error"),
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _lookup(column: str, pairs) -> Column:
    out = None
    for raw, mapped in pairs:
        cond = F.col(column) == F.lit(raw)
        out = F.when(cond, F.lit(mapped)) if out is None else out.when(cond, F.lit(mapped))
    return out


def _pick(values, index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def _session_id() -> Column:
    return F.concat(F.col("user_id").cast("string"), F.lit("-"), F.date_format("ts", "yyyyMMdd"))


def _epoch_ms() -> Column:
    return F.unix_millis(F.col("ts").cast("timestamp"))


def _copies(every: int) -> Column:
    """One row, or two identical rows when event_id % every = 0."""
    return F.explode(
        F.when(F.col("event_id") % every == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    )


def browsing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw browsing log with BROWSING_SCHEMA columns (plus exact duplicates)."""
    events = table(spark, sf_dir, "events")
    sku = F.get_json_object("props", "$.k")
    return events.select(
        _session_id().alias("session_id_hash"),
        F.when(F.col("event_type") == "error", F.lit("pageview")).otherwise(F.lit("event_product")).alias("event_type"),
        F.when((F.col("event_type") == "error") & (F.col("event_id") % 17 == 0), F.lit(" "))
        .otherwise(_lookup("event_type", RAW_ACTION)).alias("product_action"),
        F.when((F.col("event_type") == "error") | (F.col("event_id") % 89 == 0), F.lit(None))
        .when(F.col("event_id") % 91 == 0, F.lit("  "))
        .otherwise(sku)
        .alias("product_sku_hash"),
        _epoch_ms().alias("server_timestamp_epoch_ms"),
        F.when(F.col("event_id") % 13 == 0, F.lit(None)).otherwise(F.sha2("props", 256)).alias("hashed_url"),
        _copies(50).alias("_copy"),
    ).drop("_copy")


def catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw catalogue with CATALOG_SCHEMA columns; several rows per sku."""
    part = table(spark, sf_dir, "part").where(F.col("p_partkey") % 100 < 90)
    return part.select(
        (F.col("p_partkey") % 100).cast("string").alias("product_sku_hash"),
        F.lit(None).cast("string").alias("description_vector"),
        F.when(F.col("p_partkey") % 7 == 0, F.lit(None)).otherwise(F.col("p_brand")).alias("category_hash"),
        F.lit(None).cast("string").alias("image_vector"),
        F.when(F.col("p_partkey") % 11 == 0, F.lit(None))
        .when(F.col("p_partkey") % 5 == 0, F.lit(0.0))
        .when(F.col("p_partkey") % 8 == 0, F.lit(11.0))
        .otherwise(F.ceil(F.col("p_size") / F.lit(5.0)).cast("double"))
        .alias("price_bucket"),
    )


def prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X1 over the adapted browsing log and catalogue."""
    return prepare_events(browsing(spark, sf_dir), catalog(spark, sf_dir))


def _retail_with_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Retail events plus the numeric event id and user, which the log needs."""
    events = table(spark, sf_dir, "events").withColumn("k", F.get_json_object("props", "$.k").cast("bigint"))
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type")
    joined = events.join(parts, events["k"] == parts["p_partkey"], "inner")

    def every(n: int) -> Column:
        return F.col("event_id") % n == 0

    none, time = F.lit(None), F.timestamp_millis(_epoch_ms())
    return joined.select(
        F.col("event_id").alias("_event_seq"),
        F.col("user_id").alias("_user"),
        time.alias("_time"),
        F.when(every(109), none).when(every(53), F.concat(F.lit("x"), F.col("event_id").cast("string")))
        .otherwise(F.col("event_id").cast("string")).alias("event_id"),
        _lookup("event_type", RETAIL_TYPE).alias("event_type"),
        F.when(every(47), none).otherwise(time).alias("event_timestamp"),
        F.when(every(67), F.lit("")).when(every(31), F.lit("0")).otherwise(F.col("user_id").cast("string")).alias("customer_id"),
        F.when(every(113), none).when(every(43), F.lit("")).otherwise(_session_id()).alias("session_id"),
        F.when(every(127), none).when(every(41), F.lit("")).otherwise(F.col("k").cast("string")).alias("product_id"),
        F.when(every(71), F.lit("")).otherwise(F.col("p_name")).alias("product_name"),
        F.when(every(59), F.lit("TOYS")).otherwise(F.col("p_type")).alias("category"),
        F.when(every(83), -F.col("value")).otherwise(F.col("value")).alias("unit_price"),
        F.when(every(79), F.lit(0)).otherwise(F.lit(1) + F.col("k") % 3).cast("int").alias("quantity"),
        F.when(every(73), F.lit("FRA")).when(every(29), F.lit("XX"))
        .otherwise(_pick(COUNTRIES, F.col("user_id") % 7)).alias("country"),
        F.when(every(61), F.lit("tv")).when(every(23), F.lit("tablet"))
        .otherwise(_pick(DEVICE_BY_USER, F.col("user_id") % 3)).alias("device"),
    )


def retail(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Retail (R) events with EVENT_SCHEMA columns, faults included."""
    return _retail_with_ids(spark, sf_dir).select(*EVENT_SCHEMA.fieldNames())


def retail_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log records for the retail topic: duplicates, wrong keys, malformed values."""
    events = _retail_with_ids(spark, sf_dir).select("*", _copies_of("_event_seq", 50).alias("_copy"))

    def keyed(rows: DataFrame) -> DataFrame:
        return keyed_json(rows, EVENT_SCHEMA.fieldNames()).withColumns({
            "key": F.when(F.col("_event_seq") % 97 == 0, F.lit("wrong")).otherwise(F.col("key")),
            "value": F.when(F.col("_event_seq") % 101 == 0, F.lit("{bad")).otherwise(F.col("value"))})

    return to_log_records(
        events,
        RETAIL_TOPIC,
        F.col("_user") % LOG_PARTITIONS,
        ["_event_seq", "_copy"],
        timestamp=F.col("_time"),
        keyed=keyed,
    )


def _copies_of(column: str, every: int) -> Column:
    return F.explode(
        F.when(F.col(column) % every == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    )


def click_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log records for the clickstream topic, from the prepared events."""
    ms = F.unix_millis("event_timestamp")
    events = prepared(spark, sf_dir).select(*CLICK_PAYLOAD_COLUMNS).withColumn(
        "source", F.when(ms % 103 == 0, F.lit("elsewhere")).otherwise(F.col("source")))

    def keyed(rows: DataFrame) -> DataFrame:
        return keyed_json(rows, list(CLICK_PAYLOAD_COLUMNS)).withColumns({
            "key": F.when(ms % 97 == 0, F.lit("wrong")).otherwise(F.col("key")),
            "value": F.when(ms % 101 == 0, F.lit("{bad")).otherwise(F.col("value"))})

    log = to_log_records(
        events,
        CLICK_TOPIC,
        F.substring_index("session_id", "-", 1).cast("bigint") % LOG_PARTITIONS,
        ["source_event_id"],
        timestamp=F.col("event_timestamp"),
        keyed=keyed,
    )
    times = F.when(F.col("offset") % 199 == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return log.where(F.col("offset") % 211 != 7).withColumn("_again", F.explode(times)).drop("_again")


def batch_files(rows: DataFrame) -> int:
    """Files that every micro-batch of ``rows`` (click_batches) is written to: more for more
    rows, so that a batch is not the work of two tasks, and so few that the smallest fills them."""
    batches = rows.where(F.col("batch").between(1, BATCHES)).groupBy("batch").agg(F.count(F.lit(1)).alias("n"))
    found = batches.agg(F.count(F.lit(1)).alias("batches"), F.min("n").alias("smallest")).first()
    return max(BATCH_FILES, found["smallest"] // BATCH_FILE_ROWS) if found["batches"] == BATCHES else BATCH_FILES


def click_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze rows of every event with the micro-batch (``batch``) that brings them."""
    events = table(spark, sf_dir, "events")
    e, first = F.col("event_id"), F.col("event_id") % BATCHES == 0
    base = 1 + e % BATCHES
    hours = F.when((base == 4) & (e % 11 == 0), F.lit(1)).otherwise(base)
    brought = F.array_compact(F.array(
        F.struct(base.alias("batch"), hours.alias("hour")),
        F.when(first & (e % 7 == 0), F.struct(F.lit(2).cast("long").alias("batch"), F.lit(2).cast("long").alias("hour"))),
        F.when(first & (e % 10 == 0), F.struct(F.lit(4).cast("long").alias("batch"), F.lit(4).cast("long").alias("hour")))))
    rows = events.select("event_id", "user_id", F.explode(brought).alias("b")).select(
        F.col("b.batch").alias("batch"),
        (F.col("user_id") % LOG_PARTITIONS).cast("int").alias("_partition"),
        F.timestamp_seconds(F.lit(1_704_067_200) + F.col("b.hour") * 7200 + F.col("event_id") % 600).alias("event_timestamp"),
        F.lit(CLICK_SOURCE).alias("source"),
        F.col("event_id").cast("string").alias("source_event_id"),
        F.col("user_id").cast("string").alias("session_id"),
        F.lit("product_view").alias("event_type"),
        F.lit("p").alias("product_id"),
        F.lit(None).cast("string").alias("category_hash"),
        F.lit(3).alias("price_bucket"),
        F.lit(None).cast("string").alias("hashed_url"),
        F.lit("detail").alias("source_product_action"),
    )
    rows = keyed_json(rows, list(CLICK_PAYLOAD_COLUMNS))
    return rows.select(
        "batch", F.col("key").alias("kafka_key"), F.col("value").alias("raw_json"), F.lit(CLICK_TOPIC).alias("kafka_topic"),
        F.col("_partition").alias("kafka_partition"), F.col("source_event_id").cast("long").alias("kafka_offset"),
        F.col("event_timestamp").alias("kafka_timestamp"), F.col("event_timestamp").alias("ingested_at"),
        F.to_date("event_timestamp").alias("ingestion_date"))
