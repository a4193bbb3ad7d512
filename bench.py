"""Benchmark of the headline work at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``.

Each step is timed as it would run in production: tables are written and read
back, streams run with ``availableNow`` into fresh folders. Every step is repeated
``$BENCH_REPEAT`` times (default 3) in fresh folders; the median is reported.
Untimed setup: the raw CSV inputs, the retail events and the retail log table
(input generation that stands in for the reference's event simulator, which is not
rebuilt).
Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))

    from pyspark.sql import functions as F

    from cartwheel.operators import gold, inspection, profiling, quality, replay
    from cartwheel.operators.prepare import prepare_events, write_prepared
    from cartwheel.operators.report import write_gold_tables
    from cartwheel.plans.queries import FIXTURE_CATEGORIES, FIXTURE_ID_PATTERN
    from cartwheel.schemas import BRONZE_SCHEMA, CLICK_TOPIC
    from cartwheel.session import build_session, scratch_path
    from cartwheel.sources import fixtures
    from cartwheel.sources.files import read_browsing_csv, read_catalog_csv
    from cartwheel.sources.fixture_log import to_log_records
    from cartwheel.sources.log import read_log_stream
    from cartwheel.streaming.bronze import run_bronze
    from cartwheel.streaming.silver import run_silver, silver_click, silver_retail

    spark = build_session(
        "cartwheel-bench",
        master=f"local[{cpus}]",
        shuffle_partitions=int(cpus),
        # file splits: Spark's default sizing (min(128 MB, max(open cost, bytes per core)))
        extra={"spark.driver.memory": "16g"},
    )
    spark.sparkContext.setLogLevel("ERROR")

    def fresh(*parts):
        return scratch_path(spark, "bench", *parts)

    state: dict[str, str] = {}
    events_rows = spark.read.parquet(f"{sf_dir}/events.parquet").count()

    # Untimed setup: the raw inputs as the reference's jobs read them (header CSV).
    def write_raw(sf: str) -> tuple[str, str, int]:
        b, c = fresh("raw", "browsing"), fresh("raw", "catalog")
        fixtures.browsing(spark, sf).write.option("header", True).csv(b)
        fixtures.catalog(spark, sf).write.option("header", True).csv(c)
        return b, c, spark.read.option("header", True).csv(b).count()

    browsing_csv, catalog_csv, raw_rows = write_raw(sf_dir)
    state["log_retail"] = fresh("log-retail")
    fixtures.retail_log(spark, sf_dir).write.parquet(state["log_retail"])
    state["retail"] = fresh("retail-events")
    fixtures.retail(spark, sf_dir).repartition(int(cpus)).write.parquet(state["retail"])

    def shown(df, n: int = 20):
        # what the display jobs do: DataFrame.show(n) fetches n + 1 rows (a top-k)
        return df.limit(n + 1).collect()

    def profile_csv(path: str) -> None:
        # as the profile job: one persisted pass, three displayed tables
        one_pass = profiling.profile_pass(read_browsing_csv(spark, path)).persist()
        try:
            for table in profiling.split_profile(one_pass):
                shown(table)
        finally:
            one_pass.unpersist()

    def profile():
        profile_csv(browsing_csv)

    def prepare():
        path = fresh("prepared")
        prepared = prepare_events(read_browsing_csv(spark, browsing_csv), read_catalog_csv(spark, catalog_csv))
        write_prepared(prepared, path)
        state["prepared"] = path

    def inspect_prepared():
        # as the inspect job (prepared layer): three displayed tables
        p = spark.read.parquet(state["prepared"])
        shown(inspection.prepared_quality(p))
        shown(inspection.prepared_type_counts(p))
        shown(inspection.prepared_sample(p), 5)

    def click_log():
        p = spark.read.parquet(state["prepared"])
        ms = F.unix_millis("event_timestamp")
        records = replay.replay_records(replay.sample_sessions(p, 1, 0), cluster=False).select(
            F.when(ms % 97 == 0, F.lit("wrong")).otherwise(F.col("key")).alias("key"),
            F.when(ms % 101 == 0, F.lit("{bad")).otherwise(F.col("value")).alias("value"),
            (F.substring_index("key", "-", 1).cast("bigint") % 6).alias("_p"),
            "event_timestamp",
            "source_event_id",
        )
        path = fresh("log-click")
        to_log_records(records, CLICK_TOPIC, F.col("_p"), ["event_timestamp", "source_event_id"],
                       F.col("event_timestamp")).write.parquet(path)
        state["log_click"] = path

    def bronze(family):
        def run():
            out = fresh("bronze", family)
            run_bronze(read_log_stream(spark, "parquet", state[f"log_{family}"]), out, fresh("ckpt"))
            state[f"bronze_{family}"] = out
        return run

    def silver(family):
        def run():
            stream = spark.readStream.schema(BRONZE_SCHEMA).parquet(state[f"bronze_{family}"])
            s = silver_click(stream) if family == "click" else silver_retail(stream)
            out = fresh("silver", family)
            run_silver(s, out, fresh("ckpt"))
            state[f"silver_{family}"] = out
        return run

    def gold_click():
        # the Gold job's path: the three tables from one scan of Silver, written
        write_gold_tables(*gold.build_gold_tables(spark.read.parquet(state["silver_click"])), fresh("gold"))

    def gold_retail():
        out = fresh("gold")
        for i, table in enumerate(gold.build_retail_gold_tables(spark.read.parquet(state["silver_retail"]))):
            table.write.parquet(f"{out}/{i}")

    def replay_sample():
        # as the job: the sample is written once
        path = fresh("replay_sample")
        replay.sample_sessions(spark.read.parquet(state["prepared"]), 200, 0).write.parquet(path)
        sample = spark.read.parquet(path)
        replay.replay_totals(sample).collect()
        replay.replay_type_counts(sample).collect()
        replay.replay_records(sample).write.parquet(fresh("replay"))

    def quality_checks():
        quality.contract_violations(spark.read.parquet(state["retail"]), categories=FIXTURE_CATEGORIES,
                                    id_pattern=FIXTURE_ID_PATTERN).write.parquet(fresh("contract"))
        quality.journey_consistency(spark.read.parquet(state["silver_retail"])).write.parquet(fresh("journey"))

    steps = [
        ("profile", profile),
        ("prepare", prepare),
        ("inspect_prepared", inspect_prepared),
        ("log_click", click_log),
        ("bronze_click", bronze("click")),
        ("silver_click", silver("click")),
        ("gold_click", gold_click),
        ("bronze_retail", bronze("retail")),
        ("silver_retail", silver("retail")),
        ("gold_retail", gold_retail),
        ("replay_sample", replay_sample),
        ("quality", quality_checks),
    ]
    # warm-up run (JIT, file listing caches), not reported
    for _, fn in steps:
        fn()
    times: dict[str, list[float]] = {name: [] for name, _ in steps}
    for _ in range(repeat):
        for name, fn in steps:
            t0 = time.perf_counter()
            fn()
            times[name].append(time.perf_counter() - t0)
    queries = {name: round(statistics.median(ts), 3) for name, ts in times.items()}

    # The profile again on 20 copies of the raw log (2 million rows at sf0.1): at the
    # other size most of a step is the fixed cost of launching jobs.
    large_csv = fresh("raw", "browsing_large")
    copies = read_browsing_csv(spark, browsing_csv).crossJoin(F.broadcast(spark.range(20))).drop("id")
    copies.write.option("header", True).csv(large_csv)
    profile_csv(large_csv)
    large_t = []
    for _ in range(repeat):
        t0 = time.perf_counter()
        profile_csv(large_csv)
        large_t.append(time.perf_counter() - t0)
    large_sec = statistics.median(large_t)
    profile_large = {"rows": 20 * raw_rows, "sec": round(large_sec, 3), "rows_per_sec": round(20 * raw_rows / large_sec)}

    # rows read by each step (counted after the timing, not timed)
    def rows(path: str) -> int:
        return spark.read.parquet(path).count()

    prepared_rows = rows(state["prepared"])
    rows_in = {
        "profile": raw_rows,
        "prepare": raw_rows,
        "inspect_prepared": prepared_rows,
        "log_click": prepared_rows,
        "bronze_click": rows(state["log_click"]),
        "silver_click": rows(state["bronze_click"]),
        "gold_click": rows(state["silver_click"]),
        "bronze_retail": rows(state["log_retail"]),
        "silver_retail": rows(state["bronze_retail"]),
        "gold_retail": rows(state["silver_retail"]),
        "replay_sample": prepared_rows,
        "quality": rows(state["retail"]) + rows(state["silver_retail"]),
    }
    total = round(sum(queries.values()), 3)
    sf = os.path.basename(sf_dir).replace("sf", "")
    print(json.dumps({
        "metric": "end_to_end_seconds",
        "value": total,
        "unit": "sec",
        "queries": queries,
        "rows_in": rows_in,
        "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
        "events_rows": events_rows,
        "raw_browsing_rows": raw_rows,
        "profile_rows_per_sec": round(raw_rows / queries["profile"]) if queries["profile"] else None,
        "profile_large": profile_large,
        "cpus": int(cpus),
        "repeat": repeat,
        "spark": spark.version,
        "shuffle_partitions": int(spark.conf.get("spark.sql.shuffle.partitions")),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
