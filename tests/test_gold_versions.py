"""Gold as versions and by day; sketches by day; journeys by part; the replay's seams."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from cartwheel.operators import gold, replay, report, sketches
from cartwheel.operators.quality import JourneyStore, journey_consistency
from cartwheel.plans import tables
from tests.conftest import SF_CHECK, SF_SMALL


def rows(df):
    return sorted(map(str, df.collect()))


# ---- versions --------------------------------------------------------------------------
def three(spark, n):
    return {name: spark.createDataFrame([(name, n)], "name string, n int") for name in report.GOLD_TABLES}


def numbers(spark, path):
    return {name: df.first().n for name, df in report.load_version(spark, path).items()}


def test_a_failed_build_leaves_the_old_version(spark, tmp_dir):
    assert report.write_version(three(spark, 1), tmp_dir) == 1
    held = report.load_gold_tables(spark, tmp_dir)
    bad = three(spark, 2) | {"price_buckets": spark.range(1).select(F.raise_error(F.lit("no")).alias("n"))}
    with pytest.raises(Exception, match="no"):
        report.write_version(bad, tmp_dir)
    assert numbers(spark, tmp_dir) == dict.fromkeys(report.GOLD_TABLES, 1)
    assert report.write_version(three(spark, 3), tmp_dir) == 2
    assert numbers(spark, tmp_dir) == dict.fromkeys(report.GOLD_TABLES, 3)
    assert [df.first().n for df in held] == [1, 1, 1]  # who read before keeps that version
    assert report.clean_versions(spark, tmp_dir, keep=1) == 2  # the old one and the failed one
    assert len(os.listdir(f"{tmp_dir}/builds")) == 1 and numbers(spark, tmp_dir)["funnel"] == 3


def test_two_builds_cannot_take_one_number(spark, tmp_dir, monkeypatch):
    report.write_version(three(spark, 1), tmp_dir)
    old = report._newest(spark, tmp_dir)
    report.write_version(three(spark, 2), tmp_dir)
    monkeypatch.setattr(report, "_newest", lambda *a: old)  # a build that looked before the other's manifest
    with pytest.raises(Exception, match="(?i)exist"):
        report.write_version(three(spark, 3), tmp_dir)
    monkeypatch.undo()
    assert numbers(spark, tmp_dir)["funnel"] == 2


def test_a_version_without_a_table(spark, tmp_dir):
    report.write_version({"funnel": three(spark, 1)["funnel"]}, tmp_dir)
    with pytest.raises(report.GoldMissingError, match="categories"):
        report.load_gold_tables(spark, tmp_dir)


# ---- by day ----------------------------------------------------------------------------
@pytest.mark.parametrize("family", ["click", "retail"])
def test_daily_tables_equal_a_full_build(spark, tmp_dir, family):
    silver = tables.silver_table(spark, SF_SMALL, family)
    dates = sorted(r[0] for r in silver.select("event_date").distinct().collect())
    assert len(dates) > 3
    path = f"{tmp_dir}/levels"
    gold.refresh_days(silver.where("event_type <> 'purchase'"), path, family)  # an older state of the days
    for d in dates:
        gold.refresh_days(silver, path, family, [d])
    build = gold.build_gold_tables if family == "click" else gold.build_retail_gold_tables
    levels = spark.read.parquet(path)
    for daily, full in zip(gold.daily_gold_tables(levels, family), build(silver)):
        assert rows(daily) == rows(full)
    some = gold.between_dates(silver, dates[1], dates[2])
    for daily, full in zip(gold.daily_gold_tables(levels, family, dates[1], dates[2]), build(some)):
        assert rows(daily) == rows(full)


def test_refreshing_a_day_reads_that_day(spark, tmp_dir):
    silver = tables.silver_table(spark, SF_SMALL, "click")
    day = silver.agg(F.min("event_date")).first()[0]
    plan = gold.day_levels(silver, "click", [day])._jdf.queryExecution().executedPlan().toString()
    assert f"= {day})" in plan.split("PartitionFilters: ")[1][:120], plan
    path = f"{tmp_dir}/levels"
    gold.refresh_days(silver, path, "click")
    before = {f: os.path.getmtime(f"{tmp_dir}/levels/{f}") for f in os.listdir(path) if f.startswith("event_date=")}
    gold.refresh_days(silver, path, "click", [day])
    changed = [f for f, t in before.items() if os.path.getmtime(f"{path}/{f}") != t]
    assert changed == [f"event_date={day}"]


def test_unknown_family(spark):
    with pytest.raises(ValueError, match="unknown family"):
        gold.day_levels(spark.range(1), "other")


# ---- sketches --------------------------------------------------------------------------
def test_small_sketches_estimate_with_bounds(spark):
    """Beyond what a sketch holds, the truth lies within the bounds of the estimates."""
    n = 60_000
    events = spark.range(n * 2).select(
        F.concat(F.lit("s"), F.col("id") % n).alias("session_id"), F.concat(F.lit("e"), "id").alias("source_event_id"),
        F.when(F.col("id") >= n, F.when(F.col("id") % 3 == 0, F.lit("add_to_cart")).when(F.col("id") % 3 == 1, F.lit("purchase")))
        .otherwise(F.lit("product_view")).alias("event_type"),
        F.timestamp_seconds(F.col("id") * 60).alias("event_timestamp"), F.lit(None).cast("string").alias("category_hash"),
        F.lit(1).alias("price_bucket")).withColumn("event_date", F.to_date("event_timestamp"))
    day = sketches.day_sketches(events, size=10)
    r = sketches.session_estimates(day, size=10).first()
    for name, truth in (("sessions", n), ("cart_sessions", n / 3), ("purchase_sessions", n / 3), ("abandoned_sessions", n / 3),
                        ("cart_or_purchase_sessions", 2 * n / 3)):
        assert r[f"{name}_low"] <= truth <= r[f"{name}_high"], name
        assert r[f"{name}_low"] < r[name] < r[f"{name}_high"] and abs(r[name] - truth) < 0.15 * truth
    p = sketches.prepared_estimates(day, size=10).first()
    assert p.total_events == 2 * n and p.unique_events_low <= 2 * n <= p.unique_events_high
    assert p.events_without_category == 2 * n and p.events_without_price_bucket == 0


def test_no_events(spark):
    empty = spark.createDataFrame([], "session_id string, source_event_id string, event_type string, event_timestamp timestamp, "
                                      "category_hash string, price_bucket int, event_date date")
    r = sketches.session_estimates(sketches.day_sketches(empty)).first()
    assert (r.sessions, r.cart_sessions, r.abandoned_sessions, r.abandoned_sessions_high) == (0, 0, 0, 0)


def test_sketches_without_a_purchase(spark):
    rows_ = [("s1", "e1", "add_to_cart"), ("s2", "e2", "add_to_cart"), ("s2", "e3", "product_view")]
    df = spark.createDataFrame(rows_, "session_id string, source_event_id string, event_type string").select(
        "*", F.timestamp_seconds(F.lit(0)).alias("event_timestamp"), F.lit("c").alias("category_hash"), F.lit(1).alias("price_bucket"),
        F.to_date(F.lit("1970-01-01")).alias("event_date"))
    r = sketches.session_estimates(sketches.day_sketches(df)).first()
    assert (r.sessions, r.cart_sessions, r.purchase_sessions, r.abandoned_sessions) == (2, 2, 0, 2)


# ---- journeys --------------------------------------------------------------------------
def test_journeys_by_part(spark, tmp_dir):
    """Parts in any order, one of them twice, merged on the way: as the whole."""
    silver = tables.silver_table(spark, SF_SMALL, "retail")
    store = JourneyStore(spark, f"{tmp_dir}/j")
    part = F.pmod(F.xxhash64("event_id"), F.lit(4))
    for k in (2, 0, 0, 1):
        store.add(k, silver.where(part == k))
    store.merge(10)
    assert rows(store.violations()) == rows(journey_consistency(silver.where(part != 3)))  # parts and their merger: the same
    store.drop_merged(10)
    store.add(11, silver.where(part == 3))
    assert rows(store.violations()) == rows(journey_consistency(silver))
    assert sorted(os.listdir(f"{tmp_dir}/j")) == ["part=10", "part=11"]


# ---- replay ----------------------------------------------------------------------------
def test_only_sessions_larger_than_a_share_have_seams(spark):
    base = dt.datetime(2024, 1, 1)
    data = [("hot", base + dt.timedelta(seconds=i), f"h{i}") for i in range(3000)]
    data += [("warm", base + dt.timedelta(seconds=i), f"w{i}") for i in range(1100)]
    data += [(f"s{i % 97}", base + dt.timedelta(seconds=7 * i % 1000), f"o{i}") for i in range(4000)]
    df = spark.createDataFrame(data, "session_id string, event_timestamp timestamp, source_event_id string").repartition(5)
    tasks = 8
    share = -(-len(data) // tasks)
    dealt = replay.with_task(df, tasks)
    per = {r.session_id: (r.n, r.k) for r in dealt.groupBy("session_id").agg(
        F.count("*").alias("n"), F.count_distinct("_task").alias("k")).collect()}
    for session, (n, k) in per.items():
        assert k == (1 if n <= share else -(-n // share)), session
    # pieces of a cut session do not overlap in time and are about equal
    spans = sorted((r.lo, r.hi, r.n) for r in dealt.where("session_id = 'hot'").groupBy("_task").agg(
        F.min("event_timestamp").alias("lo"), F.max("event_timestamp").alias("hi"), F.count("*").alias("n")).collect())
    assert all(a[1] < b[0] for a, b in zip(spans, spans[1:])) and max(s[2] for s in spans) <= 1.2 * share
    full = df
    for c in ("source", "event_type", "product_id", "category_hash", "price_bucket", "hashed_url", "source_product_action"):
        full = full.withColumn(c, F.lit("x"))
    sent = replay.replay_records(full, tasks).select("key", "event_timestamp", F.spark_partition_id().alias("pid")).collect()
    assert len(sent) == len(data)
    order = {}
    for r in sent:
        order.setdefault((r.pid), []).append(r.event_timestamp)
    assert all(ts == sorted(ts) for ts in order.values())
    assert len({r.pid for r in sent if r.key == "s5"}) == 1


def test_replay_of_nothing(spark):
    empty = spark.createDataFrame([], "session_id string, event_timestamp timestamp, source_event_id string")
    assert replay.with_task(empty, 4).columns[-1] == "_task"


def test_sketch_table_is_merged_by_day(spark):
    """Refreshing a date replaces that date's rows only."""
    stored = tables.sketch_table(spark, SF_CHECK)
    assert stored.groupBy("event_date", "event_type").count().where("count > 1").isEmpty()
