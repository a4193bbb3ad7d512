"""Edge fixtures: JSON edge rows, empty inputs, rounding ties against the oracle."""

import datetime as dt
import json

import duckdb
from pyspark.sql import functions as F

from cartwheel.functions.metrics import pct
from cartwheel.operators import gold, inspection, profiling, quality, report
from cartwheel.plans.oracle import pct as sql_pct
from cartwheel.schemas import BRONZE_SCHEMA, BROWSING_SCHEMA, CLICK_EVENT_SCHEMA, EVENT_SCHEMA
from cartwheel.streaming.silver import quarantine_click, silver_click

GOOD = {"source": "coveo_sigir_2021", "source_event_id": "x", "session_id": "s1", "event_type": "product_view",
        "event_timestamp": "2024-01-01T12:00:00.000Z", "product_id": "p"}


def bronze(spark, rows):
    t = dt.datetime(2024, 1, 1)
    return spark.createDataFrame(
        [(k, v, "t", 0, i, t, t, t.date()) for i, (k, v) in enumerate(rows)], BRONZE_SCHEMA)


def test_json_edge_rows(spark):
    rows = [
        ("s1", ""), ("s1", "[1]"), ("s1", "null"), ("s1", "{bad"),
        ("s1", json.dumps({**GOOD, "source_event_id": "missing_product", "product_id": None})),
        ("s1", json.dumps({**GOOD, "source_event_id": "wrong_type", "price_bucket": "abc"})),
        ("s1", json.dumps({**GOOD, "source_event_id": "extra", "extra": [1, 2]})),
        ("s1", json.dumps({**GOOD, "source_event_id": "offset", "event_timestamp": "2024-01-01T01:00:00.000+02:00"})),
    ]
    out = {r.source_event_id: r for r in silver_click(bronze(spark, rows), dedup="exact").collect()}
    # partial parse: a wrong-typed bucket becomes null (null buckets are allowed)
    assert set(out) == {"wrong_type", "extra", "offset"}
    assert out["wrong_type"].price_bucket is None
    # +02:00 is converted to UTC, which moves the event to the previous day
    assert out["offset"].event_date == dt.date(2023, 12, 31)
    why = {r.raw_json[:5]: r.reasons for r in quarantine_click(bronze(spark, rows)).collect()}
    assert why[""] == ["unparsable"]
    for text in ("[1]", "null", "{bad"):
        assert why[text][0] == "malformed_json" and "bad_source" in why[text]
    assert why['{"sou'] == ["missing_product_id"]  # explicit null is well-formed JSON



def empty(spark, schema):
    return spark.createDataFrame([], schema)


def test_every_builder_on_empty_input(spark):
    click = empty(spark, CLICK_EVENT_SCHEMA)
    retail = empty(spark, EVENT_SCHEMA)
    f = gold.build_funnel(click).collect()
    assert len(f) == 1 and f[0].total_events == 0 and f[0].purchases is None and f[0].view_to_cart_rate is None
    assert gold.build_category_metrics(click).count() == 0
    assert gold.build_price_bucket_metrics(click).count() == 0
    assert gold.build_product_metrics(retail).count() == 0
    assert gold.build_country_metrics(retail).count() == 0
    m, types, actions = profiling.profile_tables(empty(spark, BROWSING_SCHEMA))
    assert types.count() == 0 and actions.count() == 0
    direct = m.first().asDict()
    assert direct["total_events"] == 0 and direct["approximate_sessions"] == 0
    assert direct["events_without_product"] is None and direct["minimum_timestamp_ms"] is None
    q = inspection.prepared_quality(click).first()
    assert q.total_events == 0 and q.first_event is None and q.events_without_category is None
    b = empty(spark, BRONZE_SCHEMA)
    assert inspection.bronze_metrics(b).first().total_events == 0
    assert inspection.offset_gaps(b).count() == 0 and inspection.partition_offsets(b).count() == 0
    assert quality.journey_consistency(retail).count() == 0
    assert quality.contract_violations(retail).count() == 0
    kpi = report.kpi_strip(gold.build_funnel(click)).first()
    assert kpi.events == "0" and kpi.view_to_cart is None
    assert report.top_categories(gold.build_category_metrics(click)).count() == 0


def test_rounding_ties_match_the_oracle(spark):
    grid = spark.range(1, 121).select(F.col("id").alias("b"), F.explode(F.sequence(F.lit(0), F.lit(120))).alias("a"))
    ours = {(r.a, r.b): r.r for r in grid.select("a", "b", pct("a", "b").alias("r")).collect()}
    con = duckdb.connect()
    pairs = "SELECT b, unnest(range(0, 121)) AS a FROM range(1, 121) u(b)"
    sql = f"SELECT a, b, {sql_pct('a', 'b')} AS r FROM ({pairs}) g"
    theirs = {(a, b): r for a, b, r in con.execute(sql).fetchall()}
    assert ours == theirs
    # a half-way case rounds up, as Spark rounds the decimal text half-up
    assert ours[(1, 32)] == 3.13


def test_two_level_silver_metrics_equal_direct_form(spark):
    from cartwheel.plans import tables

    for fam, fn, idc in (("click", inspection.silver_click_metrics, "source_event_id"),
                         ("retail", inspection.silver_retail_metrics, "event_id")):
        s = tables.silver_table(spark, "/root/testdata/sf0.01", fam)
        s = s.unionByName(s.limit(50).withColumn(idc, F.lit(None)).withColumn("session_id", F.lit(None)))
        got = fn(s).first().asDict()
        want = s.agg(F.count("*").alias("total_events"), F.count_distinct(idc).alias("unique_events"),
                     F.count_distinct("session_id").alias("unique_sessions")).first().asDict()
        assert {k: got[k] for k in want} == want
    e = empty(spark, CLICK_EVENT_SCHEMA)
    row = inspection.silver_click_metrics(e).first()
    assert row.total_events == 0 and row.unique_events == 0 and row.missing_categories is None
