"""Named queries: ``(spark, sf_dir) -> DataFrame`` over the driver's test tables.

Each one reads whole tables (or layers Spark derived from them) and returns a
DataFrame without collecting it. Timestamps are returned as ``timestamp_ntz`` (UTC
wall clock) so they compare equal across engines; the ingestion clock and the log
offset of a duplicate's survivor are left out where they are not deterministic.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel.functions.events import as_ntz
from cartwheel.operators import gold, inspection, profiling, quality, replay, report, sketches
from cartwheel.operators.prepare import dedup_catalog, write_prepared
from cartwheel.operators.prepare import prepare_events as prepare
from cartwheel.plans import tables
from cartwheel.schemas import CLICK_EVENT_SCHEMA, EVENT_SCHEMA
from cartwheel.session import scratch_path, use_utc
from cartwheel.sources import fixtures
from cartwheel.sources.files import read_browsing_csv, read_catalog_csv
from cartwheel.sources.log import read_log_stream
from cartwheel.streaming.preview import preview_records
from cartwheel.streaming.runner import run_to_completion

Query = Callable[[SparkSession, str], DataFrame]

# The contract parameters that fit the adapted test data: its categories are part
# types and its ids are decimal numbers (the defaults are the reference's enums and
# UUIDs, which every test row would fail).
FIXTURE_CATEGORIES = ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")
FIXTURE_ID_PATTERN = r"^[0-9]+$"


def _utc(fn: Query) -> Query:
    def wrapped(spark: SparkSession, sf_dir: str) -> DataFrame:
        use_utc(spark)
        return fn(spark, sf_dir)

    wrapped.__name__ = fn.__name__
    wrapped.__doc__ = fn.__doc__
    return wrapped


def _ntz(df: DataFrame, *cols: str) -> DataFrame:
    return df.select(*[as_ntz(c).alias(c) if c in cols else F.col(c) for c in df.columns])


# ---- Gold (clickstream) --------------------------------------------------------------
def gold_funnel(spark, sf_dir):
    """G4 over Silver C."""
    return gold.build_funnel(tables.silver_table(spark, sf_dir, "click"))


def gold_category(spark, sf_dir):
    """G5 over Silver C."""
    return gold.build_category_metrics(tables.silver_table(spark, sf_dir, "click"))


def gold_price_bucket(spark, sf_dir):
    """G6 over Silver C."""
    return gold.build_price_bucket_metrics(tables.silver_table(spark, sf_dir, "click"))


# ---- Gold (retail) -------------------------------------------------------------------
def retail_funnel(spark, sf_dir):
    """G1 over Silver R."""
    return gold.build_funnel_metrics(tables.silver_table(spark, sf_dir, "retail"))


def retail_product(spark, sf_dir):
    """G2 over Silver R, from the first level that the three retail tables share."""
    return gold.build_retail_gold_tables(tables.silver_table(spark, sf_dir, "retail"))[1]


def retail_country(spark, sf_dir):
    """G3 over Silver R, from the first level that the three retail tables share."""
    return gold.build_retail_gold_tables(tables.silver_table(spark, sf_dir, "retail"))[2]


# ---- Prepare -------------------------------------------------------------------------
def prepare_events(spark, sf_dir):
    """Every prepared event."""
    return _ntz(fixtures.prepared(spark, sf_dir), "event_timestamp")


def catalog_dedup(spark, sf_dir):
    """One deterministic catalogue row per sku."""
    return dedup_catalog(fixtures.catalog(spark, sf_dir))


def gold_on_prepared(spark, sf_dir):
    """G4 straight over the prepared events (batch), before Silver's rules."""
    return gold.build_funnel(fixtures.prepared(spark, sf_dir))


def prepared_written(spark, sf_dir):
    """X1 written clustered and partitioned by date (A8, F4, L1) and read back."""
    path = scratch_path(spark, "prepared")
    write_prepared(fixtures.prepared(spark, sf_dir), path)
    return _ntz(spark.read.parquet(path), "event_timestamp")


# ---- Profile -------------------------------------------------------------------------
def _within(estimate: str, exact: str, rsd: float = 0.05):
    """Whether an estimate is within 3 standard deviations (its value is no contract)."""
    return F.abs(F.col(estimate) - F.col(exact)) <= F.col(exact) * F.lit(3 * rsd)


def _beside(metrics: DataFrame, exact: DataFrame) -> DataFrame:
    """Two one-row aggregates side by side."""
    return metrics.unionByName(exact, allowMissingColumns=True).agg(
        *[F.max(c).alias(c) for c in metrics.columns + exact.columns])


def _profile(browsing: DataFrame) -> DataFrame:
    exact = browsing.agg(
        F.count_distinct("session_id_hash").alias("_s"),
        F.count_distinct("product_sku_hash").alias("_p"),
    )
    return _beside(profiling.profile_tables(browsing)[0], exact).select(
        "total_events",
        "minimum_timestamp_ms",
        "maximum_timestamp_ms",
        "events_without_product_action",
        "events_without_product",
        _within("approximate_sessions", "_s").alias("sessions_estimate_ok"),
        _within("approximate_products", "_p").alias("products_estimate_ok"),
    )


def profile_raw(spark, sf_dir):
    """P1; the estimates are compared with exact counts."""
    return _profile(fixtures.browsing(spark, sf_dir))


def _browsing_csv(spark, sf_dir) -> DataFrame:
    path = scratch_path(spark, "browsing_csv")
    fixtures.browsing(spark, sf_dir).write.options(
        header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(path)
    return read_browsing_csv(spark, path)


def profile_csv(spark, sf_dir):
    """P1 over the raw log as header CSV (A3)."""
    return _profile(_browsing_csv(spark, sf_dir))


def prepare_csv(spark, sf_dir):
    """X1 over the raw log and the catalogue as header CSV (A3)."""
    path = scratch_path(spark, "catalog_csv")
    fixtures.catalog(spark, sf_dir).write.option("header", True).csv(path)
    return _ntz(prepare(_browsing_csv(spark, sf_dir), read_catalog_csv(spark, path)), "event_timestamp")


def profile_event_types(spark, sf_dir):
    """P2 (from the one-pass profile)."""
    return profiling.profile_tables(fixtures.browsing(spark, sf_dir))[1]


def profile_actions(spark, sf_dir):
    """P3 (from the one-pass profile)."""
    return profiling.profile_tables(fixtures.browsing(spark, sf_dir))[2]


# ---- Inspect prepared ----------------------------------------------------------------
def inspect_prepared(spark, sf_dir):
    """I1; the estimates are compared with exact counts."""
    prepared = fixtures.prepared(spark, sf_dir)
    exact = prepared.agg(F.count_distinct("source_event_id").alias("_e"), F.count_distinct("session_id").alias("_s"))
    return _ntz(
        _beside(inspection.prepared_quality(prepared), exact).select(
            "total_events", "first_event", "last_event", "events_without_category", "events_without_price_bucket",
            _within("approximate_unique_events", "_e").alias("unique_events_estimate_ok"),
            _within("approximate_sessions", "_s").alias("sessions_estimate_ok")),
        "first_event",
        "last_event",
    )


def inspect_prepared_types(spark, sf_dir):
    """I2."""
    return inspection.prepared_type_counts(fixtures.prepared(spark, sf_dir))


def inspect_prepared_sample(spark, sf_dir):
    """Five rows, lowest ids first."""
    return _ntz(inspection.prepared_sample(fixtures.prepared(spark, sf_dir)), "event_timestamp")


# ---- Bronze and log ------------------------------------------------------------------
def bronze_metrics(spark, sf_dir):
    """I4 over Bronze R."""
    return inspection.bronze_metrics(tables.bronze_table(spark, sf_dir, "retail"))


def bronze_offsets(spark, sf_dir):
    """I5 over Bronze R."""
    return inspection.partition_offsets(tables.bronze_table(spark, sf_dir, "retail"))


def offset_gaps(spark, sf_dir):
    """I10 over Bronze C."""
    return inspection.offset_gaps(tables.bronze_table(spark, sf_dir, "click"))


def bronze_projection(spark, sf_dir):
    """B2 over Bronze C; the ingestion clock is left out."""
    bronze = tables.bronze_table(spark, sf_dir, "click")
    return _ntz(bronze.drop("ingested_at", "ingestion_date"), "kafka_timestamp")


def stream_preview(spark, sf_dir):
    """The preview stream over the retail log, run to the end
    into a Parquet sink (a console sink in the job)."""
    src = tables.log_path(spark, sf_dir, "retail")
    out = scratch_path(spark, "preview")
    run_to_completion(preview_records(read_log_stream(spark, "parquet", src)), out, scratch_path(spark, "ckpt", "preview"))
    return _ntz(spark.read.parquet(out), "event_timestamp")


# ---- Silver --------------------------------------------------------------------------
_R_COMPARED = ["kafka_key", "kafka_partition", "kafka_timestamp", *EVENT_SCHEMA.fieldNames(), "event_date"]
_C_COMPARED = [
    "kafka_key",
    "kafka_topic",
    "kafka_partition",
    "kafka_timestamp",
    *CLICK_EVENT_SCHEMA.fieldNames(),
    "event_date",
]


def silver_retail(spark, sf_dir):
    """C14 + H1/H3 (one micro-batch): validated, deduplicated retail rows."""
    s = tables.silver_table(spark, sf_dir, "retail")
    return _ntz(s.select(*_R_COMPARED), "kafka_timestamp", "event_timestamp")


def silver_retail_exact(spark, sf_dir):
    """C14 + H1/H2: the same with never-expiring dedup state."""
    s = tables.silver_table(spark, sf_dir, "retail", dedup="exact")
    return _ntz(s.select(*_R_COMPARED), "kafka_timestamp", "event_timestamp")


def silver_click(spark, sf_dir):
    """C15 + H1/H3: validated, deduplicated clickstream rows."""
    s = tables.silver_table(spark, sf_dir, "click")
    return _ntz(s.select(*_C_COMPARED), "kafka_timestamp", "event_timestamp")


def silver_metrics(spark, sf_dir):
    """I6."""
    return inspection.silver_retail_metrics(tables.silver_table(spark, sf_dir, "retail"))


def silver_types(spark, sf_dir):
    """I7 by type."""
    return inspection.silver_type_counts_by_type(tables.silver_table(spark, sf_dir, "retail"))


def silver_country(spark, sf_dir):
    """I7 by country."""
    return inspection.silver_country_counts(tables.silver_table(spark, sf_dir, "retail"))


def silver_click_metrics(spark, sf_dir):
    """I8."""
    return inspection.silver_click_metrics(tables.silver_table(spark, sf_dir, "click"))


def silver_click_types(spark, sf_dir):
    """I9."""
    return inspection.silver_click_type_counts(tables.silver_table(spark, sf_dir, "click"))


def silver_click_partitions(spark, sf_dir):
    """I5 over Silver C: rows per partition (offset range left out: survivors vary)."""
    s = tables.silver_table(spark, sf_dir, "click")
    return inspection.partition_offsets(s).select("kafka_partition", "event_count")


def _reconciled(spark, sf_dir, family):
    return inspection.batch_reconciliation(
        tables.log_table(spark, sf_dir, family), tables.bronze_table(spark, sf_dir, family),
        tables.one_pass(spark, sf_dir, family).batches()).drop("unread_records")


def layer_counts(spark, sf_dir):
    """I10 across layers (clickstream): log -> Bronze -> Silver + quarantine + late + duplicates."""
    return _reconciled(spark, sf_dir, "click")


def layer_counts_retail(spark, sf_dir):
    """I10 across layers (retail): log -> Bronze -> Silver + quarantine + late + duplicates."""
    return _reconciled(spark, sf_dir, "retail")


def quarantine_retail(spark, sf_dir):
    """Rejected retail rows with reasons, by log position."""
    from cartwheel.streaming.silver import quarantine_retail as q

    rows = q(tables.bronze_table(spark, sf_dir, "retail"))
    return rows.select(
        "kafka_partition", "kafka_offset", "kafka_key", "event_id", F.array_join("reasons", ",").alias("reasons")
    )


def quarantine_click(spark, sf_dir):
    """T15 for the clickstream family."""
    from cartwheel.streaming.silver import quarantine_click as q

    rows = q(tables.bronze_table(spark, sf_dir, "click"))
    return rows.select(
        "kafka_partition", "kafka_offset", "kafka_key", "source_event_id", F.array_join("reasons", ",").alias("reasons")
    )


def silver_batches_watermark(spark, sf_dir):
    """H1, H3, H4 over four micro-batches: late rows dropped, state expires."""
    s = spark.read.parquet(tables.silver_batches_path(spark, sf_dir, "watermark"))
    return _ntz(s.select("source_event_id", "session_id", "event_timestamp", "event_date"), "event_timestamp")


def silver_batches_exact(spark, sf_dir):
    """H1, H2, H4 over the same micro-batches: late rows dropped, state never expires."""
    s = spark.read.parquet(tables.silver_batches_path(spark, sf_dir, "exact"))
    return _ntz(s.select("source_event_id", "session_id", "event_timestamp", "event_date"), "event_timestamp")


def layer_counts_batches(spark, sf_dir):
    """I10 with late rows counted apart from duplicates (H4), from the batches' markers."""
    bronze = spark.read.parquet(tables.batches_path(spark, sf_dir))
    return inspection.batch_reconciliation(
        bronze, bronze, tables.one_pass_batches(spark, sf_dir, "watermark").batches()).drop("unread_records")


# ---- Silver, quarantine and late rows from one pass ------------------------------------
def _batch_columns(rows: DataFrame) -> DataFrame:
    return _ntz(rows.select("source_event_id", "session_id", "event_timestamp", "event_date"), "event_timestamp")


def one_pass_silver_click(spark, sf_dir):
    """Silver C as the one-pass writer leaves it."""
    return _ntz(tables.one_pass(spark, sf_dir, "click").silver().select(*_C_COMPARED), "kafka_timestamp", "event_timestamp")


def one_pass_silver_retail(spark, sf_dir):
    """C14, H1, H3: Silver R as the one-pass writer leaves it."""
    return _ntz(tables.one_pass(spark, sf_dir, "retail").silver().select(*_R_COMPARED), "kafka_timestamp", "event_timestamp")


def one_pass_quarantine_click(spark, sf_dir):
    """C15 from the same pass: rejected rows with reasons."""
    return tables.one_pass(spark, sf_dir, "click").quarantine().select(
        "kafka_partition", "kafka_offset", "kafka_key", "source_event_id", F.array_join("reasons", ",").alias("reasons"))


def one_pass_quarantine_retail(spark, sf_dir):
    """C14 from the same pass: rejected rows with reasons."""
    return tables.one_pass(spark, sf_dir, "retail").quarantine().select(
        "kafka_partition", "kafka_offset", "kafka_key", "event_id", F.array_join("reasons", ",").alias("reasons"))


def one_pass_batches_watermark(spark, sf_dir):
    """H1, H3 over four micro-batches: ids looked up in Silver while they have not expired."""
    return _batch_columns(tables.one_pass_batches(spark, sf_dir, "watermark").silver())


def one_pass_batches_exact(spark, sf_dir):
    """H1, H2 over four micro-batches: ids looked up in all of Silver, no state."""
    return _batch_columns(tables.one_pass_batches(spark, sf_dir, "exact").silver())


def late_rows(spark, sf_dir):
    """H4: the rows behind the watermark, kept."""
    return _batch_columns(tables.one_pass_batches(spark, sf_dir, "watermark").late())


def batch_progress(spark, sf_dir):
    """What each micro-batch read and what became of its rows, as a table."""
    rows = tables.one_pass_batches(spark, sf_dir, "watermark").batches()
    return _ntz(rows, "watermark", "last_event")


def compacted_silver(spark, sf_dir):
    """Silver after its batches were compacted and their own files removed."""
    return _batch_columns(tables.one_pass_batches(spark, sf_dir, "watermark", compacted=True).silver())


def compacted_late_rows(spark, sf_dir):
    """The late rows after the compaction."""
    return _batch_columns(tables.one_pass_batches(spark, sf_dir, "watermark", compacted=True).late())


# ---- Gold by day, sketches by day, journeys by part -----------------------------------
def _daily(spark, sf_dir, family):
    return gold.daily_gold_tables(tables.gold_levels(spark, sf_dir, family), family)


def daily_funnel(spark, sf_dir):
    """G4, E4 from the first level kept by day."""
    return _daily(spark, sf_dir, "click")[0]


def daily_category(spark, sf_dir):
    """G5, E4 from the first level kept by day."""
    return _daily(spark, sf_dir, "click")[1]


def daily_price_bucket(spark, sf_dir):
    """G6, E4 from the first level kept by day."""
    return _daily(spark, sf_dir, "click")[2]


def daily_retail_funnel(spark, sf_dir):
    """G1 from the first level kept by day."""
    return _daily(spark, sf_dir, "retail")[0]


def daily_retail_product(spark, sf_dir):
    """G2 from the first level kept by day."""
    return _daily(spark, sf_dir, "retail")[1]


def daily_retail_country(spark, sf_dir):
    """G3 from the first level kept by day."""
    return _daily(spark, sf_dir, "retail")[2]


def session_estimates(spark, sf_dir):
    """Sessions, those with a cart or purchase, and their set operations, as numbers from
    sketches by day (exact while a set has at most 32,768 members)."""
    return sketches.session_estimates(tables.sketch_table(spark, sf_dir))


def prepared_estimates(spark, sf_dir):
    """I1 as numbers from sketches by day."""
    return _ntz(sketches.prepared_estimates(tables.sketch_table(spark, sf_dir)), "first_event", "last_event")


def prepared_types_by_day(spark, sf_dir):
    """I2 from the same stored rows."""
    return sketches.type_counts(tables.sketch_table(spark, sf_dir))


def journeys_by_part(spark, sf_dir):
    """I11 from per-session rows that were added part by part."""
    return tables.journey_store(spark, sf_dir).violations()


# ---- Order as data -------------------------------------------------------------------
def _ranked(df: DataFrame) -> DataFrame:
    """A small ordered table with the place that each row came out at."""
    return df.coalesce(1).select("*", F.monotonically_increasing_id().alias("place"))


def ordered_categories(spark, sf_dir):
    """G5 in its order."""
    return _ranked(gold.build_category_metrics(tables.silver_table(spark, sf_dir, "click"))).select("category", "place")


def ordered_price_segments(spark, sf_dir):
    """G6 in its order (numbers, unknown last)."""
    return _ranked(gold.build_price_bucket_metrics(tables.silver_table(spark, sf_dir, "click"))).select(
        "price_segment", "place")


def ordered_actions(spark, sf_dir):
    """P3 in its order (null and blank included)."""
    return _ranked(profiling.profile_tables(fixtures.browsing(spark, sf_dir))[2]).select("product_action", "place")


def ordered_offsets(spark, sf_dir):
    """I5 in its order."""
    return _ranked(inspection.partition_offsets(tables.bronze_table(spark, sf_dir, "retail"))).select(
        "kafka_partition", "place")


# ---- Replay --------------------------------------------------------------------------
def _payload_back(records: DataFrame) -> DataFrame:
    parsed = records.select("key", F.from_json("value", CLICK_EVENT_SCHEMA).alias("e"))
    return _ntz(parsed.select("key", "e.*"), "event_timestamp")


def replay_all(spark, sf_dir):
    """X2 with modulus 1 (full history): key plus the payload parsed back (B6 round trip)."""
    return _payload_back(replay.replay_records(replay.sample_sessions(fixtures.prepared(spark, sf_dir), 1, 0)))


def replay_payload(spark, sf_dir):
    """B6 exactly: the (key, value) text of every replayed record, modulus 1."""
    records = replay.replay_records(replay.sample_sessions(fixtures.prepared(spark, sf_dir), 1, 0))
    return records.select("key", "value")


def replay_all_summary(spark, sf_dir):
    """X3 totals with modulus 1."""
    return replay.replay_totals(fixtures.prepared(spark, sf_dir))


def replay_sample(spark, sf_dir):
    """X2 with the reference's default sample (modulus 200, remainder 0)."""
    return _payload_back(replay.replay_records(replay.sample_sessions(fixtures.prepared(spark, sf_dir), 200, 0)))


def replay_summary(spark, sf_dir):
    """X3 per event type for the default sample."""
    return replay.replay_type_counts(replay.sample_sessions(fixtures.prepared(spark, sf_dir), 200, 0))


# ---- Quality -------------------------------------------------------------------------
def contract_violations(spark, sf_dir):
    """C11 over every retail event, with the fixture's categories and id form."""
    return quality.contract_violations(
        fixtures.retail(spark, sf_dir), categories=FIXTURE_CATEGORIES, id_pattern=FIXTURE_ID_PATTERN
    )


def journey_consistency(spark, sf_dir):
    """I11 over Silver R."""
    return quality.journey_consistency(tables.silver_table(spark, sf_dir, "retail"))


# ---- Report --------------------------------------------------------------------------
def _gold(spark, sf_dir):
    return report.load_gold_tables(spark, tables.gold_path(spark, sf_dir))


def report_top_categories(spark, sf_dir):
    """V1."""
    return report.top_categories(_gold(spark, sf_dir)[1])


def report_funnel_stages(spark, sf_dir):
    """V2."""
    return report.funnel_stages(_gold(spark, sf_dir)[0])


def report_kpis(spark, sf_dir):
    """V3."""
    return report.kpi_strip(_gold(spark, sf_dir)[0])


def report_price_segments(spark, sf_dir):
    """V4."""
    return report.purchases_by_segment(_gold(spark, sf_dir)[2])


_ALL: dict[str, Query] = {
    "gold_funnel": gold_funnel,
    "gold_category": gold_category,
    "gold_price_bucket": gold_price_bucket,
    "retail_funnel": retail_funnel,
    "retail_product": retail_product,
    "retail_country": retail_country,
    "prepare_events": prepare_events,
    "prepared_written": prepared_written,
    "prepare_csv": prepare_csv,
    "profile_csv": profile_csv,
    "silver_batches_watermark": silver_batches_watermark,
    "silver_batches_exact": silver_batches_exact,
    "layer_counts_batches": layer_counts_batches,
    "one_pass_silver_click": one_pass_silver_click,
    "one_pass_silver_retail": one_pass_silver_retail,
    "one_pass_quarantine_click": one_pass_quarantine_click,
    "one_pass_quarantine_retail": one_pass_quarantine_retail,
    "one_pass_batches_watermark": one_pass_batches_watermark,
    "one_pass_batches_exact": one_pass_batches_exact,
    "late_rows": late_rows,
    "batch_progress": batch_progress,
    "compacted_silver": compacted_silver,
    "compacted_late_rows": compacted_late_rows,
    "daily_funnel": daily_funnel,
    "daily_category": daily_category,
    "daily_price_bucket": daily_price_bucket,
    "daily_retail_funnel": daily_retail_funnel,
    "daily_retail_product": daily_retail_product,
    "daily_retail_country": daily_retail_country,
    "session_estimates": session_estimates,
    "prepared_estimates": prepared_estimates,
    "prepared_types_by_day": prepared_types_by_day,
    "journeys_by_part": journeys_by_part,
    "ordered_categories": ordered_categories,
    "ordered_price_segments": ordered_price_segments,
    "ordered_actions": ordered_actions,
    "ordered_offsets": ordered_offsets,
    "catalog_dedup": catalog_dedup,
    "gold_on_prepared": gold_on_prepared,
    "profile_raw": profile_raw,
    "profile_event_types": profile_event_types,
    "profile_actions": profile_actions,
    "inspect_prepared": inspect_prepared,
    "inspect_prepared_types": inspect_prepared_types,
    "inspect_prepared_sample": inspect_prepared_sample,
    "bronze_metrics": bronze_metrics,
    "bronze_offsets": bronze_offsets,
    "offset_gaps": offset_gaps,
    "bronze_projection": bronze_projection,
    "stream_preview": stream_preview,
    "silver_retail": silver_retail,
    "silver_retail_exact": silver_retail_exact,
    "silver_click": silver_click,
    "silver_metrics": silver_metrics,
    "silver_types": silver_types,
    "silver_country": silver_country,
    "silver_click_metrics": silver_click_metrics,
    "silver_click_types": silver_click_types,
    "silver_click_partitions": silver_click_partitions,
    "layer_counts": layer_counts,
    "layer_counts_retail": layer_counts_retail,
    "quarantine_retail": quarantine_retail,
    "quarantine_click": quarantine_click,
    "replay_all": replay_all,
    "replay_payload": replay_payload,
    "replay_all_summary": replay_all_summary,
    "replay_sample": replay_sample,
    "replay_summary": replay_summary,
    "contract_violations": contract_violations,
    "journey_consistency": journey_consistency,
    "report_top_categories": report_top_categories,
    "report_funnel_stages": report_funnel_stages,
    "report_kpis": report_kpis,
    "report_price_segments": report_price_segments,
}

QUERIES: dict[str, Query] = {name: _utc(fn) for name, fn in _ALL.items()}
