import glob
import os

import pyarrow.parquet as pq

from cartwheel.functions.events import click_event_id, map_action
from cartwheel.operators import profiling
from cartwheel.operators.prepare import dedup_catalog, prepare_events, write_prepared
from cartwheel.schemas import BROWSING_SCHEMA, CATALOG_SCHEMA, PREPARED_COLUMNS
from cartwheel.sources.files import read_browsing_csv, read_catalog_csv

B = "session_id_hash string, event_type string, product_action string, product_sku_hash string, server_timestamp_epoch_ms bigint, hashed_url string"
C = "product_sku_hash string, description_vector string, category_hash string, image_vector string, price_bucket double"


def test_action_mapping(spark):
    df = spark.createDataFrame([(a,) for a in ["detail", "add", "remove", "purchase", "view", None]], "product_action string")
    out = [r[0] for r in df.select(map_action()).collect()]
    assert out == ["product_view", "add_to_cart", "remove_from_cart", "purchase", None, None]


def test_event_id_is_sha256_of_joined_fields_nulls_skipped(spark):
    import hashlib

    df = spark.createDataFrame([("s", "event_product", "add", None, 1700000000123, "u")], B)
    got = df.select(click_event_id()).first()[0]
    assert got == hashlib.sha256(b"s||event_product||add||1700000000123||u").hexdigest()


def test_catalog_dedup_is_deterministic_nulls_last(spark):
    rows = [
        ("a", None, None, None, 3.0), ("a", None, "cat_z", None, None), ("a", None, "cat_b", None, 9.0),
        ("a", None, "cat_b", None, 2.0), ("b", None, None, None, 4.0), ("b", None, None, None, None),
        ("c", None, "x", None, float("nan")),
    ]
    out = {r.product_sku_hash: (r.category_hash, r.price_bucket) for r in dedup_catalog(spark.createDataFrame(rows, C)).collect()}
    assert out == {"a": ("cat_b", 2), "b": (None, 4), "c": ("x", None)}


def test_prepare_keeps_unknown_and_null_skus_and_drops_page_views(spark):
    browsing = spark.createDataFrame([
        ("s1", "event_product", "detail", "known", 1704067200000, "u1"),
        ("s1", "event_product", "add", "unknown", 1704067201000, None),
        ("s2", "event_product", "purchase", None, 1704067202000, "u2"),
        ("s2", "pageview", None, None, 1704067203000, "u3"),
        ("s3", "event_product", "other", "known", 1704067204000, "u4"),
    ], B)
    catalog = spark.createDataFrame([("known", None, "cat", None, 7.0)], C)
    out = prepare_events(browsing, catalog)
    assert tuple(out.columns) == PREPARED_COLUMNS
    rows = {r.source_product_action: r for r in out.collect()}
    assert set(rows) == {"detail", "add", "purchase"}
    assert (rows["detail"].category_hash, rows["detail"].price_bucket) == ("cat", 7)
    assert rows["add"].category_hash is None and rows["add"].product_id == "unknown"
    assert rows["purchase"].product_id is None
    assert rows["detail"].event_type == "product_view" and rows["detail"].source == "coveo_sigir_2021"
    assert str(rows["detail"].event_date) == "2024-01-01"


def test_prepare_reads_the_log_once_and_lets_the_planner_choose_the_join(spark, tmp_dir):
    from cartwheel.operators.prepare import cluster_for_write

    spark.createDataFrame([("s1", "event_product", "detail", "k", 1, None)] * 5, B).write.parquet(f"{tmp_dir}/b")
    catalog = spark.createDataFrame([("k", None, "c", None, 1.0)], C)
    plan = cluster_for_write(prepare_events(spark.read.parquet(f"{tmp_dir}/b"), catalog))
    text = plan._jdf.queryExecution().executedPlan().toString()
    # a rebalance, not a range partitioning: that would run the scan and the join for its sample
    assert "REBALANCE_PARTITIONS_BY_COL" in text and "rangepartitioning" not in text
    assert text.count("FileScan parquet") == 1
    assert "BroadcastHashJoin" not in prepare_events(spark.read.parquet(f"{tmp_dir}/b"), catalog)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count() == 5


def test_events_without_sku_do_not_meet_in_one_task(spark):
    rows = [(f"s{i}", "event_product", "detail", None, i, None) for i in range(2000)]
    catalog = spark.createDataFrame([(None, None, "never", None, 1.0), ("k", None, "c", None, 1.0)], C)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        out = prepare_events(spark.createDataFrame(rows, B), catalog)
        from pyspark.sql import functions as F

        sizes = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(sizes) == 2000 and max(sizes) < 800
        assert out.where("category_hash is not null").count() == 0
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_clustered_write_sorted_inside_files(spark, tmp_dir):
    from cartwheel.sources import fixtures

    prepared = fixtures.prepared(spark, "/root/testdata/sf0.01")
    write_prepared(prepared, f"{tmp_dir}/p", partitions=8)
    back = spark.read.parquet(f"{tmp_dir}/p")
    assert back.count() == prepared.count()
    files = glob.glob(f"{tmp_dir}/p/event_date=*/*.parquet")
    assert files
    for f in files:
        t = pq.read_table(f, columns=["session_id", "event_timestamp"]).to_pylist()
        keys = [(r["session_id"], r["event_timestamp"]) for r in t]
        assert keys == sorted(keys), f


CSV_BROWSING = '''session_id_hash,event_type,product_action,product_sku_hash,server_timestamp_epoch_ms,hashed_url
s1,event_product,detail,sku1,1000,u
s1,pageview,,,1001,u
s2,event_product,"",  ,1002,
s2,event_product, ,sku2,not_a_number,u
s3,event_product,add
s3,event_product,add,sku3,1003,u,extra
'''


def test_csv_edge_rows_and_profile(spark, tmp_dir):
    path = os.path.join(tmp_dir, "browsing.csv")
    with open(path, "w") as fh:
        fh.write(CSV_BROWSING)
    df = read_browsing_csv(spark, path)
    assert df.schema.fieldNames() == BROWSING_SCHEMA.fieldNames()
    m0, _, actions = profiling.profile_tables(df)
    m = m0.first()
    assert m.total_events == 6
    # null: row 2 (empty), row 3 (quoted empty); blank: row 4 (" ")
    assert m.events_without_product_action == 3
    # null: rows 2, 5; blank: row 3 ("  ")
    assert m.events_without_product == 3
    assert m.minimum_timestamp_ms == 1000 and m.maximum_timestamp_ms == 1003
    types = {r.product_action: r["count"] for r in actions.collect()}
    assert types[None] == 2


def test_catalog_csv_reader(spark, tmp_dir):
    path = os.path.join(tmp_dir, "sku.csv")
    with open(path, "w") as fh:
        fh.write("product_sku_hash,description_vector,category_hash,image_vector,price_bucket\n")
        fh.write('k1,"[0.1, 0.2]",c1,"[1]",3.0\nk1,,c0,,\nk2,,,,abc\n')
    df = read_catalog_csv(spark, path)
    assert df.schema.fieldNames() == CATALOG_SCHEMA.fieldNames()
    out = {r.product_sku_hash: (r.category_hash, r.price_bucket) for r in dedup_catalog(df).collect()}
    assert out == {"k1": ("c0", None), "k2": (None, None)}


def test_one_pass_profile_equals_three_scans(spark):
    from pyspark.sql import functions as F

    from cartwheel.sources import fixtures

    b = fixtures.browsing(spark, "/root/testdata/sf0.01")
    m, types, actions = profiling.profile_tables(b)
    for table, name in ((types, "event_type"), (actions, "product_action")):
        counts = {r[name]: r["count"] for r in b.groupBy(name).count().collect()}
        assert [tuple(r) for r in table.collect()] == sorted(counts.items(), key=lambda x: (-x[1], x[0] is not None, x[0] or ""))
    m = m.first()
    exact = b.agg(F.count("*").alias("n"), F.count_distinct("session_id_hash").alias("s"),
                  F.count_distinct("product_sku_hash").alias("p")).first()
    assert m.total_events == exact.n
    assert abs(m.approximate_sessions - exact.s) <= 0.15 * exact.s
    assert abs(m.approximate_products - exact.p) <= 0.15 * exact.p
    plan = profiling.profile_pass(b)._jdf.queryExecution().executedPlan().toString()
    # the only generator is the adapter's own (repeated rows): the profile expands nothing
    assert plan.count("Exchange") == 1 and plan.count("Generate") == 1
