"""Replay of complete sessions as keyed log records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwheel.functions.events import session_bucket
from cartwheel.schemas import CLICK_PAYLOAD_COLUMNS


def check_sample_args(modulus: int, remainder: int) -> None:
    """Modulus > 0 and 0 <= remainder < modulus."""
    if modulus <= 0:
        raise ValueError(f"modulus {modulus}: a sample needs at least one bucket")
    if not 0 <= remainder < modulus:
        raise ValueError(f"remainder {remainder}: buckets go from 0 to {modulus - 1}")


def sample_sessions(events: DataFrame, modulus: int = 200, remainder: int = 0) -> DataFrame:
    """Keep whole sessions whose stable hash bucket equals ``remainder``.

    The bucket depends on the session id only, so a session is kept or dropped as a
    whole, on every run and every cluster. ``modulus=1`` replays everything.
    """
    check_sample_args(modulus, remainder)
    if modulus == 1:
        return events
    return events.filter(session_bucket(modulus) == F.lit(remainder).cast("bigint"))


def replay_totals(sample: DataFrame) -> DataFrame:
    """X3 (totals) in one pass: events and complete sessions of the sample."""
    return sample.agg(
        F.count(F.lit(1)).alias("events"),
        F.count_distinct("session_id").alias("sessions"),
    )


def replay_type_counts(sample: DataFrame) -> DataFrame:
    """X3 (per type): rows per event type, count desc."""
    return (
        sample.groupBy("event_type")
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy(F.desc("count"), F.asc_nulls_first("event_type"))
    )


def keyed_json(events: DataFrame, payload: list[str], key: str = "session_id") -> DataFrame:
    """A10: (key, value = JSON of ``payload``) for any event DataFrame, extra columns kept.

    The key is the session, so a broker keeps one session's events in one partition.
    """
    return events.select(
        F.col(key).cast("string").alias("key"),
        F.to_json(F.struct(*[F.col(c) for c in payload])).alias("value"),
        *[c for c in events.columns if c not in ("key", "value")],
    )


def with_task(sample: DataFrame, tasks: int) -> DataFrame:
    """``sample`` with the number of the task that sends each row (``_task``).

    A session goes to one task, by its hash. Only a session with more rows than a task's share
    (total / tasks; there are fewer of them than tasks) is cut, into that many pieces of time
    of about equal size, which go to as many tasks: the only seams. Events of one instant
    stay together.
    """
    home = F.pmod(F.xxhash64("session_id"), F.lit(tasks).cast("long"))
    counts = sample.groupBy("session_id").agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n")).first()[0]
    if tasks == 1 or not total:
        return sample.withColumn("_task", home.cast("int"))
    share = -(-total // tasks)
    heavy = counts.where(F.col("n") > share).select(
        F.col("session_id").alias("_heavy"), F.ceil(F.col("n") / share).cast("int").alias("_pieces"))
    most = heavy.agg(F.max("_pieces")).first()[0]
    if most is None:
        return sample.withColumn("_task", home.cast("int"))
    same = F.col("session_id").eqNullSafe(F.col("_heavy"))
    # fewer than ``tasks`` rows with at most ``tasks`` times each
    borders = (sample.select("session_id", "event_timestamp").join(F.broadcast(heavy), same).groupBy("_heavy", "_pieces")
               .agg(F.percentile_approx("event_timestamp", [k / most for k in range(1, most)], 20 * most).alias("_times")))
    step = F.size(F.filter("_times", lambda t: t < F.col("event_timestamp")))
    piece = F.floor(F.coalesce(step, F.lit(0)) * F.col("_pieces") / most)
    placed = sample.join(F.broadcast(borders), same, "left")
    return placed.withColumn("_task", F.pmod(home + F.coalesce(piece, F.lit(0)), F.lit(tasks).cast("long")).cast("int")).drop(
        "_heavy", "_pieces", "_times")


def replay_records(sample: DataFrame, partitions: int | None = None, cluster: bool = True) -> DataFrame:
    """(key = session_id, value = JSON of the 10 payload columns).

    Rows are dealt by session (:func:`with_task`) and sent in time order inside each task, so
    a consumer's watermark advances with time rather than jumping to the newest event of the
    first session, and a session is sent by one task, in order. Only a session larger than a
    task's share is sent by several tasks: each sends a piece of its time in order, and the
    pieces, which do not overlap in time, may interleave in the log. Consumers order by event
    time. ``to_json`` omits null fields and writes timestamps to the millisecond.

    ``partitions`` is the number of sending tasks (not the topic's partition count; the
    broker maps keys to its partitions), the session's shuffle width by default. The sample
    is read for the sessions' sizes first: a job writes it once and reads that.
    ``cluster=False`` leaves the rows where they are.
    """
    if cluster:
        tasks = partitions or int(sample.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        dealt = with_task(sample, tasks).repartitionById(tasks, "_task").drop("_task")
        sample = dealt.sortWithinPartitions("event_timestamp", "session_id", "source_event_id")
    return keyed_json(sample, list(CLICK_PAYLOAD_COLUMNS)).select(
        "key", "value", "event_timestamp", "source_event_id"
    )
