"""Derived tables written to the shared checkpoint folder, built once per session.

Streams cannot be returned as bounded results, so the layers are produced by
bounded (``availableNow``) runs into fresh directories under ``spark.checkpoint.dir``
and read back as batch tables. Writing them also cuts the lineage, so a lost
executor only recomputes from the last written layer.
"""

from __future__ import annotations

import threading

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from cartwheel.schemas import BRONZE_SCHEMA
from cartwheel.session import app_id, scratch_path, use_utc
from cartwheel.sources import fixtures
from cartwheel.sources.log import read_log, read_log_stream
from cartwheel.streaming.bronze import run_bronze
from cartwheel.streaming.one_pass import Family, OnePassSilver, click_family, retail_family
from cartwheel.streaming.silver import run_silver, silver_click, silver_retail

_BUILT: dict[tuple, str] = {}
_LOCK = threading.Lock()


def _key(spark: SparkSession, sf_dir: str, name: str) -> tuple:
    return (app_id(spark), sf_dir.rstrip("/"), name)


def _readable(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.parquet(path).schema  # noqa: B018 - lists the folder only
        return True
    except AnalysisException as exc:
        if exc.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return False  # removed since it was built


def _memo(spark: SparkSession, sf_dir: str, name: str, build, below: str = "") -> str:
    """The path that ``build`` made in this session; its folder ``below`` is Parquet."""
    key = _key(spark, sf_dir, name)
    with _LOCK:
        path = _BUILT.get(key)
    if path is not None and not _readable(spark, f"{path}/{below}"):
        path = None
    if path is None:
        path = build()
        with _LOCK:
            _BUILT[key] = path
    return path


def forget(spark: SparkSession | None = None) -> None:
    """Drop the memo (tests that want a rebuild)."""
    with _LOCK:
        if spark is None:
            _BUILT.clear()
        else:
            app = app_id(spark)
            for k in [k for k in _BUILT if k[0] == app]:
                del _BUILT[k]


def log_path(spark: SparkSession, sf_dir: str, family: str) -> str:
    """The log table of one family ('retail' or 'click'), derived from the test tables."""
    def build() -> str:
        use_utc(spark)
        path = scratch_path(spark, "log", family)
        records = fixtures.retail_log(spark, sf_dir) if family == "retail" else fixtures.click_log(spark, sf_dir)
        records.write.mode("overwrite").option("compression", "zstd").parquet(path)
        return path

    return _memo(spark, sf_dir, f"log/{family}", build)


def bronze_path(spark: SparkSession, sf_dir: str, family: str) -> str:
    def build() -> str:
        use_utc(spark)
        src = log_path(spark, sf_dir, family)
        out = scratch_path(spark, "bronze", family)
        run_bronze(read_log_stream(spark, "parquet", src), out, scratch_path(spark, "ckpt", "bronze", family))
        return out

    return _memo(spark, sf_dir, f"bronze/{family}", build)


def silver_path(spark: SparkSession, sf_dir: str, family: str, dedup: str = "watermark") -> str:
    def build() -> str:
        use_utc(spark)
        src = bronze_path(spark, sf_dir, family)
        stream = spark.readStream.schema(BRONZE_SCHEMA).format("parquet").load(src)
        silver = silver_retail(stream, dedup=dedup) if family == "retail" else silver_click(stream, dedup=dedup)
        out = scratch_path(spark, "silver", family, dedup)
        run_silver(silver, out, scratch_path(spark, "ckpt", "silver", family, dedup))
        return out

    return _memo(spark, sf_dir, f"silver/{family}/{dedup}", build)


def batches_path(spark: SparkSession, sf_dir: str) -> str:
    """Bronze in four micro-batches of as many files each (fixtures.click_batches)."""
    def build() -> str:
        use_utc(spark)
        path = scratch_path(spark, "bronze", "batches")
        rows = fixtures.click_batches(spark, sf_dir)
        files = fixtures.batch_files(rows)
        for n in range(1, fixtures.BATCHES + 1):
            # the stream takes files by age, so a batch's files are written before the next one's
            rows.where(f"batch = {n}").drop("batch").repartition(files).write.mode("append").parquet(path)
        return path

    return _memo(spark, sf_dir, "bronze/batches", build)


def _files_per_batch(spark: SparkSession, path: str) -> int:
    """Files of a micro-batch in a folder that ``batches_path`` has written."""
    return max(fixtures.BATCH_FILES, len(spark.read.parquet(path).inputFiles()) // fixtures.BATCHES)


def silver_batches_path(spark: SparkSession, sf_dir: str, dedup: str) -> str:
    def build() -> str:
        use_utc(spark)
        src = batches_path(spark, sf_dir)
        stream = (spark.readStream.schema(BRONZE_SCHEMA).format("parquet")
                  .option("maxFilesPerTrigger", str(_files_per_batch(spark, src))).load(src))
        out = scratch_path(spark, "silver", "batches", dedup)
        run_silver(silver_click(stream, dedup=dedup), out, scratch_path(spark, "ckpt", "batches", dedup))
        return out

    return _memo(spark, sf_dir, f"silver/batches/{dedup}", build)


def _ran_one_pass(spark: SparkSession, source: str, family: Family, name: str, dedup: str, files: int | None = None) -> str:
    """A new folder of the one-pass writer that has drained the Bronze folder ``source``."""
    use_utc(spark)
    reader = spark.readStream.schema(BRONZE_SCHEMA).format("parquet")
    if files:
        reader = reader.option("maxFilesPerTrigger", str(files))
    out = scratch_path(spark, "one_pass", name)
    OnePassSilver(spark, out, family, dedup).run(reader.load(source), scratch_path(spark, "ckpt", "one_pass", name))
    return out


def one_pass(spark: SparkSession, sf_dir: str, family: str) -> OnePassSilver:
    """The one-pass writer's layers of a family's Bronze (one micro-batch)."""
    which = retail_family() if family == "retail" else click_family()
    path = _memo(spark, sf_dir, f"one_pass/{family}", lambda: _ran_one_pass(
        spark, bronze_path(spark, sf_dir, family), which, family, "watermark"), below="staged")
    return OnePassSilver(spark, path, which)


def one_pass_batches(spark: SparkSession, sf_dir: str, dedup: str, compacted: bool = False) -> OnePassSilver:
    """The one-pass writer's layers of the four micro-batches; ``compacted`` to few
    files, with the batches' own files removed."""
    def build() -> str:
        src = batches_path(spark, sf_dir)
        path = _ran_one_pass(spark, src, click_family(), f"batches/{dedup}", dedup, _files_per_batch(spark, src))
        if compacted:
            ledger = OnePassSilver(spark, path, click_family(), dedup).ledger
            ledger.compact()
            ledger.clean()
        return path

    path = _memo(spark, sf_dir, f"one_pass/batches/{dedup}/{compacted}", build, below="versions" if compacted else "staged")
    return OnePassSilver(spark, path, click_family(), dedup)


def log_table(spark: SparkSession, sf_dir: str, family: str) -> DataFrame:
    return read_log(spark, log_path(spark, sf_dir, family))


def bronze_table(spark: SparkSession, sf_dir: str, family: str) -> DataFrame:
    return spark.read.parquet(bronze_path(spark, sf_dir, family))


def silver_table(spark: SparkSession, sf_dir: str, family: str, dedup: str = "watermark") -> DataFrame:
    return spark.read.parquet(silver_path(spark, sf_dir, family, dedup))


def gold_path(spark: SparkSession, sf_dir: str) -> str:
    """Clickstream Gold tables written from Silver (A7), for the report queries."""
    def build() -> str:
        from cartwheel.operators.gold import build_gold_tables
        from cartwheel.operators.report import write_gold_tables

        silver = silver_table(spark, sf_dir, "click")
        out = scratch_path(spark, "gold", "click")
        write_gold_tables(*build_gold_tables(silver), out)
        return out

    return _memo(spark, sf_dir, "gold/click", build, below="manifests")


def gold_levels(spark: SparkSession, sf_dir: str, family: str) -> DataFrame:
    """The first level of Gold by day, written in two refreshes of every other date."""
    def build() -> str:
        from cartwheel.operators.gold import refresh_days

        silver = silver_table(spark, sf_dir, family)
        dates = sorted(r[0] for r in silver.select("event_date").distinct().collect())
        out = scratch_path(spark, "gold_days", family)
        for some in (dates[::2], dates[1::2], dates[-1:]):  # the last date is refreshed again
            refresh_days(silver, out, family, some)
        return out

    return spark.read.parquet(_memo(spark, sf_dir, f"gold_days/{family}", build))


def sketch_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sketches by day of the prepared events, written in two refreshes of every other date."""
    def build() -> str:
        from cartwheel.operators.sketches import refresh_sketches

        prepared = fixtures.prepared(spark, sf_dir)
        dates = sorted(r[0] for r in prepared.select("event_date").distinct().collect())
        out = scratch_path(spark, "sketches")
        for some in (dates[::2], dates[1::2]):
            refresh_sketches(prepared, out, some)
        return out

    return spark.read.parquet(_memo(spark, sf_dir, "sketches", build))


def journey_store(spark: SparkSession, sf_dir: str):
    """Per-session rows of Silver R, added in four parts, the first two merged meanwhile and the
    last added twice."""
    from pyspark.sql import functions as F

    from cartwheel.operators.quality import JourneyStore

    def build() -> str:
        silver = silver_table(spark, sf_dir, "retail")
        store = JourneyStore(spark, scratch_path(spark, "journeys"))
        for part, partitions in ((0, [0, 3]), (1, [1]), (3, [2, 5]), (4, [4]), (4, [4])):
            store.add(part, silver.where(F.col("kafka_partition").isin(partitions)))
            if part == 1:
                store.merge(2)
                store.drop_merged(2)
        return store.path

    return JourneyStore(spark, _memo(spark, sf_dir, "journeys", build))
