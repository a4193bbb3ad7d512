import xxhash
from pyspark.sql import Window
from pyspark.sql import functions as F

from cartwheel.operators import replay
from cartwheel.sources.fixture_log import append_to_log_table, assign_sequence
from tests.conftest import SF_CHECK


def test_assign_sequence_equals_row_number_with_a_hot_key(spark):
    df = spark.range(0, 5000).select(
        F.when(F.col("id") % 2 == 0, F.lit(0)).otherwise((F.col("id") % 7).cast("int")).alias("p"),
        (F.col("id") * 7919 % 5003).alias("k"),
    )
    ours = assign_sequence(df, "p", ["k"], slices=13)
    w = Window.partitionBy("p").orderBy("k")
    ref = df.select("p", "k", (F.row_number().over(w) - 1).alias("offset"))
    assert ours.exceptAll(ref).count() == 0 and ref.exceptAll(ours).count() == 0


def test_assign_sequence_continues_from_start(spark):
    df = spark.range(0, 10).select((F.col("id") % 2).cast("int").alias("p"), F.col("id").alias("k"))
    start = spark.createDataFrame([(0, 100), (1, 7)], "p int, next long")
    out = {(r.p, r.k): r.offset for r in assign_sequence(df, "p", ["k"], slices=3, start=start).collect()}
    assert out[(0, 0)] == 100 and out[(0, 8)] == 104 and out[(1, 1)] == 7 and out[(1, 9)] == 11


def spark_bucket(session: str, modulus: int) -> int:
    h = xxhash.xxh64(session.encode(), seed=42).intdigest()
    if h >= 2**63:
        h -= 2**64
    return h % modulus  # Python % is a pmod for positive modulus


def test_sample_sessions_matches_brute_force_hash(spark):
    from cartwheel.sources import fixtures

    prepared = fixtures.prepared(spark, SF_CHECK)
    for modulus, remainder in ((200, 0), (7, 3)):
        kept = {r.session_id for r in replay.sample_sessions(prepared, modulus, remainder).select("session_id").distinct().collect()}
        every = {r.session_id for r in prepared.select("session_id").distinct().collect()}
        expected = {s for s in every if spark_bucket(s, modulus) == remainder}
        assert kept == expected and kept
        # whole sessions: every event of a kept session is in the sample
        n_sample = replay.sample_sessions(prepared, modulus, remainder).count()
        n_full = prepared.filter(F.col("session_id").isin(list(kept))).count()
        assert n_sample == n_full


def test_sample_argument_guards():
    import pytest

    for m, r in ((0, 0), (-1, 0), (5, 5), (5, -1)):
        with pytest.raises(ValueError):
            replay.check_sample_args(m, r)


def test_replay_records_round_trip_and_order(spark):
    from cartwheel.schemas import CLICK_EVENT_SCHEMA
    from cartwheel.sources import fixtures

    prepared = fixtures.prepared(spark, SF_CHECK)
    recs = replay.replay_records(prepared, partitions=6)
    back = recs.select("key", F.from_json("value", CLICK_EVENT_SCHEMA).alias("e")).select("key", "e.*")
    cols = [c for c in CLICK_EVENT_SCHEMA.fieldNames()]
    assert back.select(*cols).exceptAll(prepared.select(*cols)).count() == 0
    assert back.filter(F.col("key") != F.col("session_id")).count() == 0
    # inside each task rows are in event-time order; a session lives in one task but at a seam
    tagged = recs.select("key", "event_timestamp", F.spark_partition_id().alias("pid"))
    assert tagged.groupBy("key").agg(F.count_distinct("pid").alias("n")).filter("n > 1").count() <= 5
    rows = tagged.collect()
    by_pid = {}
    for r in rows:
        by_pid.setdefault(r.pid, []).append(r.event_timestamp)
    assert all(ts == sorted(ts) for ts in by_pid.values())


def test_replay_summary_one_pass(spark):
    from cartwheel.sources import fixtures

    sample = replay.sample_sessions(fixtures.prepared(spark, SF_CHECK), 200, 0)
    totals = replay.replay_totals(sample).first()
    types = replay.replay_type_counts(sample).collect()
    assert totals.events == sum(r["count"] for r in types)
    assert totals.sessions == sample.select("session_id").distinct().count()


def test_log_table_continues_offsets(spark, tmp_dir):
    from cartwheel.sources.log import read_log

    recs = spark.range(0, 300).select(
        (F.col("id") % 17).cast("string").alias("key"), F.col("id").cast("string").alias("value"), "id"
    )
    path = f"{tmp_dir}/log"
    append_to_log_table(recs, path, "t", 3, ["id"])
    append_to_log_table(recs, path, "t", 3, ["id"])
    log = read_log(spark, path)
    stats = log.groupBy("partition").agg(
        F.count("*").alias("n"), F.count_distinct("offset").alias("d"), F.min("offset").alias("lo"),
        F.max("offset").alias("hi"),
    ).collect()
    assert sum(r.n for r in stats) == 600
    for r in stats:
        assert r.n == r.d and r.lo == 0 and r.hi == r.n - 1
    # a key always lands in the same partition
    assert log.groupBy("key").agg(F.count_distinct("partition").alias("p")).filter("p > 1").count() == 0


def test_keyed_json_payload(spark):
    from cartwheel.operators.replay import keyed_json

    df = spark.createDataFrame([("s1", "a", None)], "session_id string, x string, y int")
    row = keyed_json(df, ["x", "y"]).first()
    assert row.key == "s1" and row.value == '{"x":"a"}'


def test_a_hot_session_is_sent_by_several_tasks_in_parts_that_do_not_overlap(spark):
    """The same rule for every size: no task gets much more than its share."""
    import datetime as dt

    base = dt.datetime(2024, 1, 1)
    rows = [("hot", base + dt.timedelta(seconds=i), str(i)) for i in range(4000)]
    rows += [(f"s{i % 50}", base + dt.timedelta(seconds=i), f"o{i}") for i in range(2000)]
    rows += [(None, base, "n")]
    df = spark.createDataFrame(rows, "session_id string, event_timestamp timestamp, source_event_id string")
    for c in ("source", "event_type", "product_id", "category_hash", "price_bucket", "hashed_url", "source_product_action"):
        df = df.withColumn(c, F.lit(None).cast("string"))
    sent = replay.replay_records(df, partitions=8).select("key", "event_timestamp", F.spark_partition_id().alias("pid")).collect()
    assert len(sent) == len(rows)
    assert max(sum(r.pid == p for r in sent) for p in range(8)) < 2000
    parts = {}
    for r in sent:  # in the order of each task
        if r.key == "hot":
            parts.setdefault(r.pid, []).append(r.event_timestamp)
    assert len(parts) >= 4 and all(p == sorted(p) for p in parts.values())
    spans = sorted((p[0], p[-1]) for p in parts.values())
    assert all(a[1] < b[0] for a, b in zip(spans, spans[1:]))
