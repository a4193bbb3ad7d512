"""Plan shape: pushdown, pruning, one JSON parse, partial aggregation, top-k."""

from cartwheel.operators import gold, inspection
from cartwheel.operators.validation import click_rules, parse_and_keep
from cartwheel.schemas import BRONZE_LINEAGE_C, BRONZE_SCHEMA, CLICK_EVENT_SCHEMA
from cartwheel.sources import fixtures
from tests.conftest import SF_SMALL


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_single_from_json_in_silver(spark, tmp_dir):
    empty = spark.createDataFrame([], BRONZE_SCHEMA)
    valid = parse_and_keep(empty, CLICK_EVENT_SCHEMA, BRONZE_LINEAGE_C, click_rules)
    assert optimized(valid).count("from_json") == 1


def test_gold_prunes_columns_and_aggregates_partially(spark, tmp_dir):
    fixtures.prepared(spark, SF_SMALL).write.parquet(f"{tmp_dir}/p")
    df = spark.read.parquet(f"{tmp_dir}/p")
    plan = physical(gold.build_funnel(df))
    assert "ReadSchema: struct<session_id:string,event_type:string,product_id:string>" in plan
    assert "partial_count" in plan or "partial_sum" in plan
    assert plan.count("Exchange") <= 2  # one keyed shuffle + the one-row final merge


def test_product_action_filter_reaches_the_scan(spark, tmp_dir):
    fixtures.browsing(spark, SF_SMALL).write.parquet(f"{tmp_dir}/b")
    from cartwheel.operators.prepare import product_events

    plan = physical(product_events(spark.read.parquet(f"{tmp_dir}/b")))
    assert "PushedFilters: [In(product_action" in plan


def test_sample_is_a_top_k(spark):
    plan = physical(inspection.prepared_sample(fixtures.prepared(spark, SF_SMALL)))
    assert "TakeOrderedAndProject" in plan


def test_gold_date_range_prunes_partitions(spark, tmp_dir):
    from cartwheel.operators.gold import between_dates

    fixtures.prepared(spark, SF_SMALL).write.partitionBy("event_date").parquet(f"{tmp_dir}/s")
    df = between_dates(spark.read.parquet(f"{tmp_dir}/s"), "2024-01-05", "2024-01-06")
    plan = physical(gold.build_funnel(df))
    assert "PartitionFilters: [isnotnull(event_date" in plan and "2024-01-05" in plan
    assert df.select("event_date").distinct().count() == 2
