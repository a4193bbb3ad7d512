"""Silver, quarantine and late rows from one pass over each micro-batch.

A ``foreachBatch`` writer. Each batch of Bronze is read and parsed once; every row goes to
one layer:

quarantine   it breaks a rule (with the reasons and its raw text);
late         it is valid but not after the watermark, the greatest event time of all earlier
             batches less the delay. The rows are kept, not dropped;
silver       the others, one row of each id: the first in the log.

Deduplication keeps no state in the engine. Inside a batch, copies collapse by a partial
aggregate before the shuffle, so that an id with a third of all rows makes no heavy task.
Against earlier batches, the ids of the batch are looked up among those that Silver has
stored: in mode "watermark" only those whose time plus the delay is after the watermark,
in mode "exact" all of them, or those of the last ``horizon_days`` days before the watermark.
Both are read by their ``event_date`` folders and their id column only.

A batch's layers are written by one job and become visible together by their marker
(:mod:`cartwheel.streaming.ledger`). A batch that comes again after its marker is passed over;
one that was killed before is written anew. What the next batch must know, the greatest event
time, is in the marker: the state of the writer has the same size for ever.

Numbers of rows are counted in what has been written (each row says how many rows of the log it
stands for), so they do not count a recomputed task twice.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartwheel.operators.validation import Field, click_rules, parse_with_reasons, retail_rules
from cartwheel.schemas import BRONZE_LINEAGE_C, BRONZE_LINEAGE_R, BRONZE_SCHEMA, CLICK_EVENT_SCHEMA, CLICK_SOURCE, EVENT_SCHEMA
from cartwheel.session import folders_in, unsorted_writes
from cartwheel.streaming.ledger import Ledger

STAGED_EXTRA = [
    T.StructField("raw_json", T.StringType()), T.StructField("reasons", T.ArrayType(T.StringType())),
    # rows of the log that a row stands for, and the greatest event time among them
    T.StructField("copies", T.LongType()), T.StructField("last_event", T.TimestampType()),
]


@dataclass(frozen=True)
class Family:
    """What tells the two families apart."""

    schema: T.StructType
    lineage: Sequence[str]
    rules: Callable[[Field, Column], list[tuple[str, Column]]]
    id: str
    delay: str

    @property
    def columns(self) -> list[str]:
        """Columns of Silver but event_date, in their order."""
        return [*self.lineage, *self.schema.fieldNames()]

    @property
    def layer_schema(self) -> T.StructType:
        lineage = [T.StructField(n, BRONZE_SCHEMA[n].dataType) for n in self.lineage]
        fields = [T.StructField(f.name, f.dataType) for f in self.schema.fields]
        return T.StructType([*lineage, *fields, *STAGED_EXTRA])


def click_family(source: str = CLICK_SOURCE, delay: str = "30 minutes") -> Family:
    return Family(CLICK_EVENT_SCHEMA, BRONZE_LINEAGE_C, lambda f, key: click_rules(f, key, source), "source_event_id", delay)


def retail_family(delay: str = "10 minutes") -> Family:
    return Family(EVENT_SCHEMA, BRONZE_LINEAGE_R, retail_rules, "event_id", delay)


def routed(bronze: DataFrame, family: Family, watermark: Column) -> DataFrame:
    """Every row of a batch with its ``layer``; one row for the copies of a Silver id.

    One scan, one parse and one shuffle: rows that are not deduplicated keep a number of
    their own as their key.
    """
    rows = parse_with_reasons(bronze, family.schema, family.lineage, family.rules)
    failed, at = F.size("reasons") > 0, F.col("event_timestamp")
    layer = F.when(failed, F.lit("quarantine")).when(at <= watermark, F.lit("late")).otherwise(F.lit("silver"))
    keyed = rows.select("*", layer.alias("layer"), F.monotonically_increasing_id().alias("_row")).select(
        *family.columns, F.when(failed, F.col("raw_json")).alias("raw_json"), "reasons", "layer",
        F.when(F.col("layer") == "silver", F.col(family.id)).alias("_id"), F.when(F.col("layer") != "silver", F.col("_row")).alias("_row"))
    kept = [c for c in keyed.columns if c not in ("_id", "_row")]
    first = F.min_by(F.struct(*kept), F.struct("kafka_partition", "kafka_offset"))
    one = keyed.groupBy("_id", "_row").agg(
        first.alias("row"), F.count(F.lit(1)).alias("copies"), F.max("event_timestamp").alias("last_event"))
    names = [f.name for f in family.layer_schema.fields if f.name not in ("copies", "last_event")]
    date = F.when(F.col("row.layer") != "quarantine", F.to_date("row.event_timestamp"))
    return one.select(*[f"row.{n}" for n in names], "copies", "last_event", "row.layer", date.alias("event_date"))


class OnePassSilver:
    """The writer of one family under ``root``."""

    def __init__(self, spark: SparkSession, root: str, family: Family, dedup: str = "watermark", horizon_days: int | None = None):
        if dedup not in ("watermark", "exact"):
            raise ValueError(f"unknown dedup mode {dedup!r}")
        self.family, self.dedup, self.horizon_days = family, dedup, horizon_days
        self.ledger = Ledger(spark, root, family.layer_schema)
        self.delay_us: int = spark.sql(f"SELECT unix_micros(timestamp_micros(0) + INTERVAL {family.delay})").first()[0]
        self._last: Row | None = None  # marker of the last batch, once it has been looked up

    # ---- reading ---------------------------------------------------------------------
    def silver(self) -> DataFrame:
        return self.ledger.read("silver").select(*self.family.columns, "event_date")

    def late(self) -> DataFrame:
        """Valid rows behind the watermark, copies included."""
        return self.ledger.read("late").select(*self.family.columns, "event_date")

    def quarantine(self) -> DataFrame:
        return self.ledger.read("quarantine").select(*self.family.columns, "raw_json", "reasons")

    def batches(self) -> DataFrame:
        return self.ledger.batches()

    # ---- writing ---------------------------------------------------------------------
    def _earlier_ids(self, ledger: Ledger, watermark_us: int) -> DataFrame:
        """Stored ids that a row of the batch may repeat."""
        stored, watermark = ledger.read("silver"), F.timestamp_micros(F.lit(watermark_us))
        if self.dedup == "watermark":
            oldest = F.timestamp_micros(F.lit(watermark_us - self.delay_us))
            stored = stored.where((F.col("event_date") >= F.to_date(oldest)) & (F.col("event_timestamp") > oldest))
        elif self.horizon_days is not None:
            stored = stored.where(F.col("event_date") >= F.date_sub(F.to_date(watermark), self.horizon_days))
        return stored.select(F.col(self.family.id).alias("_id"))

    def write(self, batch: DataFrame, batch_id: int) -> None:
        """Write one batch (the function for ``foreachBatch``)."""
        spark = batch.sparkSession
        ledger = Ledger(spark, self.ledger.root, self.family.layer_schema)
        stream = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
        last = self._last or ledger.last()
        if last is not None:
            if last["stream"] != stream:
                raise ValueError(f"{ledger.root} belongs to the stream {last['stream']}; a new checkpoint needs a new folder")
            if batch_id <= last["batch_id"]:
                return  # its marker is there: it came again because the query was killed later
        before = last["max_event_us"] if last is not None else None
        watermark_us = None if before is None else before - self.delay_us
        watermark = F.timestamp_micros(F.lit(watermark_us).cast("long"))

        staged = ledger.batch_path("staged", batch_id)
        routed(batch, self.family, watermark).write.mode("overwrite").partitionBy("layer", "event_date").parquet(staged)
        # counted in the files: layers, copies and last events are narrow columns
        rows = ledger.stored(f"{ledger.root}/staged", [staged]) if _any(spark, staged) else ledger.stored(ledger.root, [])
        counts = {r["layer"]: r for r in rows.groupBy("layer").agg(
            F.count(F.lit(1)).alias("n"), F.sum("copies").alias("copies"),
            F.unix_micros(F.max(F.when(F.col("layer") != "quarantine", F.col("last_event")))).alias("last")).collect()}

        folder, silver = "staged", counts["silver"]["n"] if "silver" in counts else 0
        if silver and watermark_us is not None:
            candidates = rows.where("layer = 'silver'")
            own = candidates.select(F.col(self.family.id).alias("_id"))
            repeats = self._earlier_ids(ledger, watermark_us).join(own, "_id", "left_semi")
            if not repeats.isEmpty():
                folder, path = "deduplicated", ledger.batch_path("deduplicated", batch_id)
                unseen = candidates.join(repeats, F.col(self.family.id) == F.col("_id"), "left_anti")
                unseen.write.mode("overwrite").partitionBy("layer", "event_date").parquet(path)
                silver = ledger.stored(f"{ledger.root}/{folder}", [path]).count() if _any(spark, path) else 0

        def number(layer: str, name: str) -> int:
            return counts[layer][name] if layer in counts else 0

        events = [r["last"] for r in counts.values() if r["last"] is not None] + ([before] if before is not None else [])
        self._last = ledger.commit(
            batch_id, stream=stream, silver_folder=folder, silver=silver, quarantine=number("quarantine", "n"), late=number("late", "n"),
            rows_in=sum(r["copies"] for r in counts.values()), duplicates=number("silver", "copies") - silver,
            watermark_us=watermark_us, max_event_us=max(events, default=None))

    def start(self, bronze: DataFrame, checkpoint: str, processing_time: str | None = "5 seconds", available_now: bool = False):
        """Run the writer on a stream of Bronze rows; returns the query at once."""
        writer = bronze.writeStream.foreachBatch(self.write).option("checkpointLocation", checkpoint)
        if available_now:
            writer = writer.trigger(availableNow=True)
        elif processing_time:
            writer = writer.trigger(processingTime=processing_time)
        with unsorted_writes(bronze.sparkSession):  # the stream keeps the settings it was started with
            return writer.start()

    def run(self, bronze: DataFrame, checkpoint: str) -> None:
        """Drain the stream, then stop; raises what the writer raised."""
        query = self.start(bronze, checkpoint, available_now=True)
        query.awaitTermination()


def _any(spark: SparkSession, path: str) -> bool:
    """Whether a folder holds a layer: a batch without rows leaves no partition."""
    return any(name.startswith("layer=") for name in folders_in(spark, path))


def silver_of(spark: SparkSession, path: str, family: Family) -> DataFrame:
    """The Silver rows under ``path``: a writer's folder, or a plain Parquet table."""
    writer = OnePassSilver(spark, path, family)
    return spark.read.parquet(path) if writer.ledger.last() is None else writer.silver()
