"""What makes the layers cost more than their share on large tables."""

import glob

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from cartwheel.plans import queries, tables
from cartwheel.sources import fixtures
from cartwheel.sources.fixture_log import to_log_records
from cartwheel.streaming import runner
from tests.conftest import SF_SMALL


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_log_records_are_numbered_without_a_second_shuffle(spark):
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for n in names:
        spark.conf.set(n, "-1")  # as if the tables were large
    try:
        for log in (fixtures.retail_log, fixtures.click_log):
            plan = _plan(log(spark, SF_SMALL))
            assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    finally:
        for n in names:
            spark.conf.unset(n)


def test_payloads_are_made_of_numbered_rows(spark, monkeypatch):
    from cartwheel.sources import fixture_log

    seen = []
    real = fixture_log.assign_sequence
    monkeypatch.setattr(fixture_log, "assign_sequence", lambda df, *a, **k: seen.append(df.columns) or real(df, *a, **k))
    rows = spark.createDataFrame([(i, i % 3, f"s{i % 5}") for i in range(100)], "n long, p int, s string")
    log = to_log_records(rows, "t", F.col("p"), ["n"], timestamp=F.timestamp_seconds("n"),
                         keyed=lambda r: r.withColumn("key", F.col("s")).withColumn("value", F.concat("s", F.col("n").cast("string"))))
    got = {(r.partition, r.offset): (bytes(r.key).decode(), bytes(r.value).decode()) for r in log.collect()}
    assert got == {(i % 3, i // 3): (f"s{i % 5}", f"s{i % 5}{i}") for i in range(100)}
    fixtures.click_log(spark, SF_SMALL), fixtures.retail_log(spark, SF_SMALL)
    assert len(seen) == 3 and not any(c in columns for columns in seen for c in ("key", "value"))


def test_bounded_runs_do_not_sort_rows_by_folder(spark, tmp_dir, monkeypatch):
    name = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(name)
    spark.conf.set(name, "0")  # a caller's session without this library's settings
    try:
        seen = []
        real = runner.start_stream
        monkeypatch.setattr(runner, "start_stream", lambda *a, **k: seen.append(int(spark.conf.get(name))) or real(*a, **k))
        rows = spark.range(0, 200).select("id", (F.col("id") % 40).cast("int").alias("day"))  # more folders than open files
        rows.coalesce(1).write.parquet(f"{tmp_dir}/in")
        stream = spark.readStream.schema(rows.schema).parquet(f"{tmp_dir}/in")
        runner.run_to_completion(stream, f"{tmp_dir}/out", f"{tmp_dir}/ckpt", partition_by=["day"])
        assert seen[0] > 0 and spark.conf.get(name) == "0"
        assert sorted(r.id for r in spark.read.parquet(f"{tmp_dir}/out").where("day = id % 40").collect()) == list(range(200))
        file = glob.glob(f"{tmp_dir}/out/*/*.parquet")[0]
        assert pq.ParquetFile(file).metadata.row_group(0).column(0).compression == "ZSTD"
    finally:
        spark.conf.set(name, before)


def _batches(spark, sizes):
    return spark.createDataFrame([(b,) for b, n in sizes.items() for _ in range(n)], "batch long")


def test_files_of_a_batch_grow_with_the_smallest_batch(spark, monkeypatch):
    monkeypatch.setattr(fixtures, "BATCH_FILE_ROWS", 10)
    assert fixtures.batch_files(_batches(spark, {1: 50, 2: 90, 3: 70, 4: 61})) == 5
    assert fixtures.batch_files(_batches(spark, {1: 50, 2: 90, 3: 7, 4: 61, 0: 3, 9: 2})) == 2
    assert fixtures.batch_files(_batches(spark, {1: 50, 2: 90, 4: 61})) == 2  # a batch without rows has one empty file
    assert fixtures.batch_files(_batches(spark, {None: 50})) == 2


def test_batches_of_more_files_are_the_same_batches(spark, monkeypatch):
    def results():
        return [sorted(map(tuple, queries.QUERIES[q](spark, SF_SMALL).collect()), key=str)
                for q in ("late_rows", "batch_progress", "one_pass_batches_exact", "silver_batches_watermark")]

    tables.forget(spark)
    few = results()
    monkeypatch.setattr(fixtures, "BATCH_FILE_ROWS", 40)
    tables.forget(spark)
    try:
        assert results() == few and len(few[1]) == fixtures.BATCHES
        files = spark.read.parquet(tables.batches_path(spark, SF_SMALL)).inputFiles()
        assert len(files) >= 5 * fixtures.BATCHES
    finally:
        tables.forget(spark)
