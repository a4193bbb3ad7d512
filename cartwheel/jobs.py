"""Thin command-line jobs around the library (I/O and arguments only).

    python -m cartwheel.jobs profile  --browsing browsing.csv
    python -m cartwheel.jobs prepare  --browsing browsing.csv --catalog sku.csv --out prepared/
    python -m cartwheel.jobs replay   --prepared prepared/ --modulus 200 --remainder 0 \
                                      --bootstrap-servers host:9092 --topic t
    python -m cartwheel.jobs publish  --events retail/ --bootstrap-servers host:9092
    python -m cartwheel.jobs bronze   --log-format kafka --bootstrap-servers host:9092 --topic t \
                                      --out bronze/ --checkpoint ck/bronze
    python -m cartwheel.jobs silver   --family click --bronze bronze/ --out silver/ --checkpoint ck/silver
    python -m cartwheel.jobs compact  --family click --silver silver/ --clean
    python -m cartwheel.jobs gold     --family click --silver silver/ --out gold/
    python -m cartwheel.jobs inspect  --layer bronze --path bronze/
    python -m cartwheel.jobs preview  --log-format kafka --bootstrap-servers host:9092 --topic t

No master is set here: spark-submit (or the cluster defaults) decides it. Streaming
jobs run with a 5 s processing-time trigger unless ``--available-now`` is given.
"""

from __future__ import annotations

import argparse
import sys

from cartwheel.schemas import BRONZE_SCHEMA, CLICK_TOPIC, RETAIL_TOPIC
from cartwheel.session import build_session, scratch_path


def _topic_args(p: argparse.ArgumentParser) -> None:
    p.add_argument("--bootstrap-servers", default="localhost:9092")
    p.add_argument("--topic", default=None, help="default: the family's topic")


def _log_args(p: argparse.ArgumentParser) -> None:
    p.add_argument("--log-format", choices=["kafka", "parquet"], default="kafka")
    p.add_argument("--log-path", help="log table directory (parquet format)")
    p.add_argument("--starting-offsets", default="earliest", help="kafka: earliest, latest or a JSON text")
    p.add_argument("--max-offsets-per-trigger", type=int, default=None, help="kafka: most records of a micro-batch")
    p.add_argument("--max-files-per-trigger", type=int, default=None, help="parquet: most files of a micro-batch")
    _topic_args(p)


def _read_log(spark, a):
    from cartwheel.sources.log import read_log_stream

    return read_log_stream(
        spark, a.log_format, path=a.log_path, bootstrap_servers=a.bootstrap_servers, topic=a.topic or RETAIL_TOPIC,
        starting_offsets=a.starting_offsets, max_files_per_trigger=a.max_files_per_trigger,
        max_offsets_per_trigger=a.max_offsets_per_trigger)


def _stream_args(p: argparse.ArgumentParser) -> None:
    p.add_argument("--checkpoint", required=True)
    p.add_argument("--available-now", action="store_true", help="drain the input, then stop")


def _shuffle(spark, n: int | None) -> None:
    if n:
        spark.conf.set("spark.sql.shuffle.partitions", str(n))


def cmd_profile(spark, a) -> None:
    from cartwheel.operators import profiling
    from cartwheel.sources.files import read_browsing_csv

    browsing = read_browsing_csv(spark, a.browsing)
    browsing.printSchema()
    # one scan for all three tables; the pass is tiny (one row per type / action)
    one_pass = profiling.profile_pass(browsing).persist()
    try:
        for table in profiling.split_profile(one_pass):
            table.show(truncate=False)
    finally:
        one_pass.unpersist()


def cmd_prepare(spark, a) -> None:
    from cartwheel.operators.prepare import prepare_events, write_prepared
    from cartwheel.sources.files import read_browsing_csv, read_catalog_csv

    prepared = prepare_events(read_browsing_csv(spark, a.browsing), read_catalog_csv(spark, a.catalog))
    write_prepared(prepared, a.out, partitions=a.partitions)


def cmd_replay(spark, a) -> None:
    from cartwheel.operators import replay
    from cartwheel.sources.log import publish

    # the prepared table is read once; what is sent is read again from the sample
    path = scratch_path(spark, "replay_sample")
    replay.sample_sessions(spark.read.parquet(a.prepared), a.modulus, a.remainder).write.parquet(path)
    sample = spark.read.parquet(path)
    totals = replay.replay_totals(sample).first()
    if totals["events"] == 0:
        raise ValueError(f"no session is in bucket {a.remainder} of {a.modulus}: nothing to replay")
    print(f"replaying {totals['sessions']} whole sessions, {totals['events']} events")
    replay.replay_type_counts(sample).show()
    publish(replay.replay_records(sample, a.tasks), a.bootstrap_servers, a.topic or CLICK_TOPIC)


def cmd_publish(spark, a) -> None:
    """A10: publish retail events (EVENT_SCHEMA columns) keyed by session as JSON."""
    from cartwheel.operators.replay import keyed_json
    from cartwheel.schemas import EVENT_SCHEMA
    from cartwheel.sources.log import publish

    events = spark.read.parquet(a.events)
    publish(keyed_json(events, EVENT_SCHEMA.fieldNames()), a.bootstrap_servers, a.topic or RETAIL_TOPIC)


def cmd_bronze(spark, a) -> None:
    from cartwheel.streaming.bronze import run_bronze, start_bronze

    records = _read_log(spark, a)
    if a.available_now:
        run_bronze(records, a.out, a.checkpoint)
    else:
        start_bronze(records, a.out, a.checkpoint).awaitTermination()


def _family(a):
    from cartwheel.streaming.one_pass import click_family, retail_family

    make = click_family if a.family == "click" else retail_family
    return make(delay=a.watermark) if getattr(a, "watermark", None) else make()


def cmd_silver(spark, a) -> None:
    """Silver, quarantine and late rows by the one-pass writer; ``--writer stream`` is Spark's
    stateful operator, which keeps Silver only."""
    _shuffle(spark, a.state_partitions)
    reader = spark.readStream.schema(BRONZE_SCHEMA).format("parquet")
    if a.max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(a.max_files_per_trigger))
    bronze, family = reader.load(a.bronze), _family(a)
    if a.writer == "one-pass":
        from cartwheel.streaming.one_pass import OnePassSilver

        writer = OnePassSilver(spark, a.out, family, a.dedup, a.horizon_days)
        if a.available_now:
            writer.run(bronze, a.checkpoint)
            writer.batches().show(truncate=False)
        else:
            writer.start(bronze, a.checkpoint).awaitTermination()
        return
    from cartwheel.streaming.silver import run_silver, silver_click, silver_retail, start_silver

    build = silver_click if a.family == "click" else silver_retail
    silver = build(bronze, watermark=family.delay, dedup=a.dedup)
    if a.available_now:
        late = run_silver(silver, a.out, a.checkpoint)
        print(f"{late} rows came behind the watermark and were dropped")
    else:
        start_silver(silver, a.out, a.checkpoint).awaitTermination()


def cmd_compact(spark, a) -> None:
    """Copy the one-pass writer's batches into few files, and remove older copies' sources."""
    from cartwheel.streaming.one_pass import OnePassSilver

    ledger = OnePassSilver(spark, a.silver, _family(a)).ledger
    version = ledger.compact()
    removed = ledger.clean(a.keep_batches) if a.clean else []
    print(f"version {version}; {len(removed)} folders removed")


def cmd_gold(spark, a) -> None:
    """The family's Gold tables as a new version; with ``--levels`` from the first level kept
    there by day, of which ``--refresh`` dates (or all) are read from Silver anew."""
    from cartwheel.operators import gold
    from cartwheel.operators.report import GOLD_TABLES, clean_versions, load_version, write_version
    from cartwheel.streaming.one_pass import silver_of

    silver = silver_of(spark, a.silver, _family(a))
    names = GOLD_TABLES if a.family == "click" else ("funnel_metrics", "product_metrics", "country_metrics")
    if a.levels:
        gold.refresh_days(silver, a.levels, a.family, a.refresh.split(",") if a.refresh else None)
        built = gold.daily_gold_tables(spark.read.parquet(a.levels), a.family, a.date_from, a.date_to)
    else:
        build = gold.build_gold_tables if a.family == "click" else gold.build_retail_gold_tables
        built = build(gold.between_dates(silver, a.date_from, a.date_to))  # one scan of Silver
    version = write_version(dict(zip(names, built)), a.out)
    clean_versions(spark, a.out, a.keep_versions)
    print(f"version {version}")
    for name, table in load_version(spark, a.out).items():
        table.show(10 if name == "categories" else 20, truncate=False)


def cmd_inspect(spark, a) -> None:
    from cartwheel.operators import inspection, sketches
    from cartwheel.streaming.one_pass import OnePassSilver, click_family, retail_family, silver_of

    if a.layer.startswith("silver-"):
        family = click_family() if a.layer == "silver-click" else retail_family()
        df = silver_of(spark, a.path, family)
    else:
        df = spark.read.parquet(a.path)
    df.printSchema()
    if a.layer == "prepared":
        # one scan for the estimates and the counts; the sample is a top-k of its own
        pass_path = scratch_path(spark, "sketches")
        sketches.refresh_sketches(df, pass_path)
        stored = spark.read.parquet(pass_path)
        sketches.prepared_estimates(stored).show(truncate=False)
        sketches.session_estimates(stored).show(truncate=False)
        sketches.type_counts(stored).show(truncate=False)
        inspection.prepared_sample(df).show(5, truncate=20)
    elif a.layer == "bronze":
        inspection.bronze_metrics(df).show()
        inspection.partition_offsets(df).show()
        inspection.offset_gaps(df).show()
    elif a.layer == "silver-retail":
        inspection.silver_retail_metrics(df).show()
        inspection.silver_type_counts_by_type(df).show()
        inspection.silver_country_counts(df).show()
    else:
        inspection.silver_click_metrics(df).show()
        inspection.silver_click_type_counts(df).show()
        inspection.partition_offsets(df).show()
    if a.layer.startswith("silver-") and a.log and a.bronze:
        batches = OnePassSilver(spark, a.path, family).batches()
        inspection.batch_reconciliation(spark.read.parquet(a.log), spark.read.parquet(a.bronze), batches).show()


def cmd_preview(spark, a) -> None:
    from cartwheel.streaming.preview import start_console_preview

    _shuffle(spark, 3)
    start_console_preview(_read_log(spark, a), a.checkpoint).awaitTermination()


def parse(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="cartwheel")
    parser.add_argument("--master", default=None, help="only for local runs; spark-submit sets it otherwise")
    parser.add_argument("--shuffle-partitions", type=int, default=None)
    sub = parser.add_subparsers(dest="cmd", required=True)

    p = sub.add_parser("profile")
    p.add_argument("--browsing", required=True)

    p = sub.add_parser("prepare")
    p.add_argument("--browsing", required=True)
    p.add_argument("--catalog", required=True)
    p.add_argument("--out", required=True)
    p.add_argument("--partitions", type=int, default=None, help="write tasks (default: shuffle width)")

    p = sub.add_parser("replay")
    p.add_argument("--prepared", required=True)
    p.add_argument("--modulus", type=int, default=200)
    p.add_argument("--remainder", type=int, default=0)
    p.add_argument("--tasks", type=int, default=None, help="sending tasks (default: shuffle width)")
    _topic_args(p)

    p = sub.add_parser("publish")
    p.add_argument("--events", required=True, help="Parquet with the retail event columns")
    _topic_args(p)

    p = sub.add_parser("bronze")
    _log_args(p)
    _stream_args(p)
    p.add_argument("--out", required=True)

    p = sub.add_parser("silver")
    p.add_argument("--family", choices=["retail", "click"], required=True)
    p.add_argument("--bronze", required=True)
    p.add_argument("--out", required=True)
    p.add_argument("--dedup", choices=["watermark", "exact"], default="watermark")
    p.add_argument("--watermark", default=None, help="event-time delay (default 30 minutes C, 10 minutes R)")
    p.add_argument("--state-partitions", type=int, default=None, help="fixed at first start")
    p.add_argument("--max-files-per-trigger", type=int, default=None)
    p.add_argument("--writer", choices=["one-pass", "stream"], default="one-pass",
                   help="one-pass: Silver, quarantine and late rows; stream: Spark's stateful operator, Silver only")
    p.add_argument("--horizon-days", type=int, default=None, help="exact: days before the watermark in which a repeat is sought")
    _stream_args(p)

    p = sub.add_parser("compact")
    p.add_argument("--family", choices=["retail", "click"], required=True)
    p.add_argument("--silver", required=True, help="folder of the one-pass writer")
    p.add_argument("--clean", action="store_true", help="remove the folders of compacted batches")
    p.add_argument("--keep-batches", type=int, default=0, help="compacted batches whose folders stay")

    p = sub.add_parser("gold")
    p.add_argument("--date-from", default=None, help="first event_date (inclusive), prunes partitions")
    p.add_argument("--date-to", default=None, help="last event_date (inclusive)")
    p.add_argument("--family", choices=["retail", "click"], required=True)
    p.add_argument("--silver", required=True)
    p.add_argument("--out", required=True)
    p.add_argument("--levels", default=None, help="folder of the first level by day")
    p.add_argument("--refresh", default=None, help="dates, comma separated, whose Silver is read anew (default: all)")
    p.add_argument("--keep-versions", type=int, default=2, help="versions of the Gold tables that stay")

    p = sub.add_parser("inspect")
    p.add_argument("--layer", choices=["prepared", "bronze", "silver-retail", "silver-click"], required=True)
    p.add_argument("--path", required=True)
    p.add_argument("--log", help="silver: log table, to reconcile all layers")
    p.add_argument("--bronze", help="silver: Bronze, to reconcile all layers")

    p = sub.add_parser("preview")
    _log_args(p)
    p.add_argument("--checkpoint", required=True)

    a = parser.parse_args(argv)
    if a.cmd == "replay":
        from cartwheel.operators.replay import check_sample_args

        check_sample_args(a.modulus, a.remainder)
    return a


def run(spark, a: argparse.Namespace) -> None:
    """One job in a session that is there already."""
    globals()[f"cmd_{a.cmd}"](spark, a)


def main(argv: list[str] | None = None) -> None:
    a = parse(argv)
    spark = build_session(f"cartwheel-{a.cmd}", master=a.master, shuffle_partitions=a.shuffle_partitions)
    spark.sparkContext.setLogLevel("WARN")
    try:
        run(spark, a)
    finally:
        if a.cmd not in ("bronze", "silver", "preview") or a.__dict__.get("available_now"):
            spark.stop()


if __name__ == "__main__":
    main(sys.argv[1:])
