"""The command-line jobs: one in a process of its own, as a user would run it, the others
through the same argument parser in the tests' session."""

import json
import os
import subprocess
import sys

import pytest

from cartwheel import jobs
from cartwheel.operators.report import load_version
from cartwheel.streaming.one_pass import OnePassSilver, click_family, retail_family, silver_of

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture()
def job(spark, capsys):
    def run(*args):
        width = spark.conf.get("spark.sql.shuffle.partitions")
        try:
            jobs.run(spark, jobs.parse(list(args)))
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", width)
        return capsys.readouterr().out

    return run


def test_a_job_as_a_process(spark, tmp_dir):
    from cartwheel.sources import fixtures

    fixtures.browsing(spark, "/root/testdata/sf0.001").write.option("header", True).csv(f"{tmp_dir}/b")
    cmd = [sys.executable, "-m", "cartwheel.jobs", "--master", "local[2]", "--shuffle-partitions", "4"]
    done = subprocess.run([*cmd, "profile", "--browsing", f"{tmp_dir}/b"], cwd=ROOT, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-3000:]
    assert "total_events" in done.stdout and "1020" in done.stdout


def test_job_chain(spark, tmp_dir, job):
    from pyspark.sql import functions as F

    from cartwheel.operators import replay
    from cartwheel.sources import fixtures
    from cartwheel.sources.fixture_log import append_to_log_table

    raw_b, raw_c = f"{tmp_dir}/browsing_csv", f"{tmp_dir}/catalog_csv"
    fixtures.browsing(spark, "/root/testdata/sf0.001").write.option("header", True).csv(raw_b)
    fixtures.catalog(spark, "/root/testdata/sf0.001").write.option("header", True).csv(raw_c)

    out = job("profile", "--browsing", raw_b)
    assert "total_events" in out and "1020" in out
    job("prepare", "--browsing", raw_b, "--catalog", raw_c, "--out", f"{tmp_dir}/prepared")
    # no broker here: the records that the replay job would send go into a log table
    records = replay.replay_records(replay.sample_sessions(spark.read.parquet(f"{tmp_dir}/prepared"), 1, 0))
    append_to_log_table(records, f"{tmp_dir}/log", "t", 6, ["event_timestamp", "source_event_id"], F.col("event_timestamp"))
    job("bronze", "--log-format", "parquet", "--log-path", f"{tmp_dir}/log", "--out", f"{tmp_dir}/bronze",
        "--checkpoint", f"{tmp_dir}/ck/bronze", "--available-now", "--max-files-per-trigger", "3")
    out = job("inspect", "--layer", "bronze", "--path", f"{tmp_dir}/bronze")
    assert "missing_offsets" in out
    job("silver", "--family", "click", "--bronze", f"{tmp_dir}/bronze", "--out", f"{tmp_dir}/silver",
        "--checkpoint", f"{tmp_dir}/ck/silver", "--available-now", "--state-partitions", "4")
    assert "version 1" in job("compact", "--family", "click", "--silver", f"{tmp_dir}/silver", "--clean")
    out = job("gold", "--family", "click", "--silver", f"{tmp_dir}/silver", "--out", f"{tmp_dir}/gold")
    assert "view_to_cart_rate" in out
    out = job("inspect", "--layer", "prepared", "--path", f"{tmp_dir}/prepared")
    assert "unique_events_low" in out and "abandoned_sessions" in out and "source_event_id" in out
    out = job("inspect", "--layer", "silver-click", "--path", f"{tmp_dir}/silver", "--log", f"{tmp_dir}/log",
              "--bronze", f"{tmp_dir}/bronze")
    assert "missing_price_buckets" in out and "first_offset" in out and "unread_records" in out
    funnel = load_version(spark, f"{tmp_dir}/gold")["funnel"].first()
    out = job("gold", "--family", "click", "--silver", f"{tmp_dir}/silver", "--out", f"{tmp_dir}/gold", "--levels", f"{tmp_dir}/levels")
    assert "version 2" in out and load_version(spark, f"{tmp_dir}/gold")["funnel"].first() == funnel
    out = job("gold", "--family", "click", "--silver", f"{tmp_dir}/silver", "--out", f"{tmp_dir}/gold", "--levels", f"{tmp_dir}/levels",
              "--refresh", "2024-01-02,2024-01-03")
    assert "version 3" in out and load_version(spark, f"{tmp_dir}/gold")["funnel"].first() == funnel
    # no wrong keys or malformed values in this replay: every prepared event with a
    # product and a fitting bucket is valid, and the exact duplicates collapse
    prepared = spark.read.parquet(f"{tmp_dir}/prepared")
    good = F.col("product_id").isNotNull() & (F.col("price_bucket").isNull() | F.col("price_bucket").between(1, 10))
    assert funnel.total_events == prepared.filter(good).select("source_event_id").distinct().count()
    assert funnel.total_sessions == prepared.filter(good).select("session_id").distinct().count()

    rejected = OnePassSilver(spark, f"{tmp_dir}/silver", click_family()).quarantine()
    assert rejected.count() == prepared.filter(~good).count() > 0
    assert {r.reasons[0] for r in rejected.select("reasons").collect()} == {"missing_product_id", "bad_price_bucket"}

    with pytest.raises(ValueError):
        job("replay", "--prepared", f"{tmp_dir}/prepared", "--modulus", "0")


def test_replay_and_publish_jobs_send_keyed_records(spark, tmp_dir, monkeypatch):
    """What the jobs hand to the Kafka sink (no broker here)."""
    from types import SimpleNamespace

    from cartwheel.sources import fixtures, log

    sent = []
    monkeypatch.setattr(log, "publish", lambda records, servers, topic: sent.append((records, servers, topic)))
    fixtures.prepared(spark, "/root/testdata/sf0.001").write.parquet(f"{tmp_dir}/p")
    fixtures.retail(spark, "/root/testdata/sf0.001").write.parquet(f"{tmp_dir}/r")
    args = {"bootstrap_servers": "host:1", "topic": None}
    jobs.cmd_replay(spark, SimpleNamespace(prepared=f"{tmp_dir}/p", modulus=1, remainder=0, tasks=3, **args))
    jobs.cmd_publish(spark, SimpleNamespace(events=f"{tmp_dir}/r", **args))
    assert [(s, t) for _, s, t in sent] == [("host:1", jobs.CLICK_TOPIC), ("host:1", jobs.RETAIL_TOPIC)]
    for (records, _, _), source in zip(sent, ("p", "r")):
        rows = records.select("key", "value").collect()
        assert len(rows) == spark.read.parquet(f"{tmp_dir}/{source}").count()
        for r in rows[:50]:
            assert json.loads(r.value).get("session_id") == r.key
    with pytest.raises(ValueError, match="nothing to replay"):
        jobs.cmd_replay(spark, SimpleNamespace(prepared=f"{tmp_dir}/p", modulus=10**9, remainder=10**9 - 1, tasks=3, **args))


def test_retail_log_to_gold_jobs(spark, tmp_dir, job):
    from pyspark.sql import functions as F

    from cartwheel.sources import fixtures

    fixtures.retail_log(spark, "/root/testdata/sf0.001").write.parquet(f"{tmp_dir}/log")
    job("bronze", "--log-format", "parquet", "--log-path", f"{tmp_dir}/log", "--out", f"{tmp_dir}/bronze",
        "--checkpoint", f"{tmp_dir}/ck/bronze", "--available-now")
    job("silver", "--family", "retail", "--bronze", f"{tmp_dir}/bronze", "--out", f"{tmp_dir}/silver",
        "--checkpoint", f"{tmp_dir}/ck/silver", "--available-now", "--dedup", "exact")
    out = job("gold", "--family", "retail", "--silver", f"{tmp_dir}/silver", "--out", f"{tmp_dir}/gold")
    assert "total_revenue" in out
    silver = silver_of(spark, f"{tmp_dir}/silver", retail_family())
    assert silver.count() == silver.select("event_id").distinct().count() > 0
    assert silver.filter((F.col("unit_price") <= 0) | (F.length("country") != 2)).count() == 0
