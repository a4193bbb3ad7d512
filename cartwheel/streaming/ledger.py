"""Layers that are written batch by batch and become visible by a marker.

A micro-batch may write several layers (Silver, quarantine, late rows). Its files lie in a
folder of its own; a marker, one small Parquet file that is renamed into place last, makes all
of them visible at once. A batch that was killed before its marker has written nothing that
a reader sees, and is written anew under the same number. Each marker holds the numbers of
rows of its batch, so progress is a table that outlives the query and the process.

    <root>/staged/batch_id=<n>/layer=<l>/event_date=<d>/       rows of a batch
    <root>/deduplicated/batch_id=<n>/layer=silver/event_date=<d>/  ... without repeats of earlier ids
    <root>/commits/batch_id=<n>/                               marker of a batch
    <root>/compacted/version=<v>/layer=<l>/event_date=<d>/     the rows of many batches in few files
    <root>/versions/version=<v>/                               markers of the batches in a version

Compaction copies the committed batches since the last version; its marker switches readers
over in one step. Whoever reads at that moment keeps the old files, which stay until
``clean`` removes them.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartwheel.session import delete_path

#: A marker: what a batch was and what became of its rows.
MARKER_FIELDS = [
    T.StructField("stream", T.StringType()), T.StructField("silver_folder", T.StringType()),
    T.StructField("rows_in", T.LongType()), T.StructField("silver", T.LongType()), T.StructField("quarantine", T.LongType()),
    T.StructField("late", T.LongType()), T.StructField("duplicates", T.LongType()),
    T.StructField("watermark_us", T.LongType()), T.StructField("max_event_us", T.LongType()),
]
MARKER_SCHEMA = T.StructType([*MARKER_FIELDS, T.StructField("batch_id", T.LongType())])
VERSION_SCHEMA = T.StructType([T.StructField("batch_id", T.LongType()), *MARKER_FIELDS, T.StructField("version", T.LongType())])
LAYERS = ("silver", "quarantine", "late")


def _missing(exc: AnalysisException) -> bool:
    return exc.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def read_if_any(spark: SparkSession, schema: T.StructType, path: str) -> DataFrame | None:
    """A Parquet folder with the given schema, None if it is not there."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as exc:
        if not _missing(exc):
            raise
        return None


class Ledger:
    """The batches of one writer under ``root``; ``layer_schema`` is that of all layers' files."""

    def __init__(self, spark: SparkSession, root: str, layer_schema: T.StructType):
        self.spark, self.root, self.layer_schema = spark, root.rstrip("/"), layer_schema

    # ---- markers ---------------------------------------------------------------------
    def versions(self) -> list[Row]:
        found = read_if_any(self.spark, VERSION_SCHEMA, f"{self.root}/versions")
        return [] if found is None else found.orderBy("batch_id").collect()

    def _tail(self, after: int) -> list[Row]:
        found = read_if_any(self.spark, MARKER_SCHEMA, f"{self.root}/commits")
        return [] if found is None else found.where(F.col("batch_id") > after).orderBy("batch_id").collect()

    def markers(self) -> list[Row]:
        """Markers of all committed batches in order (a row a batch, kept by compactions)."""
        old = self.versions()
        return [*old, *self._tail(old[-1]["batch_id"] if old else -1)]

    def last(self) -> Row | None:
        """The marker of the last batch."""
        found = read_if_any(self.spark, MARKER_SCHEMA, f"{self.root}/commits")
        row = None if found is None else found.orderBy(F.desc("batch_id")).first()
        if row is None:  # all markers were cleaned away after a compaction
            old = self.versions()
            row = old[-1] if old else None
        return row

    def batches(self) -> DataFrame:
        """batch_id and the numbers of rows of every committed batch, watermark and last event."""
        names = ["batch_id", *[f.name for f in MARKER_FIELDS]]
        schema = T.StructType([VERSION_SCHEMA[n] for n in names])
        rows = self.spark.createDataFrame([tuple(m[n] for n in names) for m in self.markers()], schema)
        return rows.select(
            "batch_id", "rows_in", "silver", "quarantine", "late", "duplicates",
            F.timestamp_micros("watermark_us").alias("watermark"), F.timestamp_micros("max_event_us").alias("last_event"))

    def commit(self, batch_id: int, **values) -> Row:
        """Write the marker of a batch, and return it: from now on its layers are visible."""
        row = tuple(values.get(f.name) for f in MARKER_FIELDS)
        marker = self.spark.createDataFrame([row], T.StructType(MARKER_FIELDS)).coalesce(1)
        marker.write.mode("overwrite").parquet(self.batch_path("commits", batch_id))
        return Row(*MARKER_SCHEMA.fieldNames())(*row, batch_id)

    # ---- layers ----------------------------------------------------------------------
    def batch_path(self, folder: str, batch_id: int) -> str:
        return f"{self.root}/{folder}/batch_id={batch_id}"

    def stored(self, base: str, paths: Iterable[str]) -> DataFrame:
        """Rows of folders below ``base``, with layer and event_date from their names."""
        schema = T.StructType([*self.layer_schema.fields, T.StructField("layer", T.StringType()), T.StructField("event_date", T.DateType())])
        paths = list(paths)
        if not paths:
            return self.spark.createDataFrame([], schema)
        rows = self.spark.read.schema(schema).option("basePath", base).parquet(*paths)
        return rows.select(*schema.names)

    def _of_batches(self, layer: str, markers: Iterable[Row]) -> list[DataFrame]:
        folders: dict[str, list[str]] = {}
        for m in markers:
            if m[layer]:
                folder = m["silver_folder"] if layer == "silver" else "staged"
                folders.setdefault(folder, []).append(f"{self.batch_path(folder, m['batch_id'])}/layer={layer}")
        # partition columns are looked for below the batch's own number
        return [self.stored(f"{self.root}/{folder}", paths) for folder, paths in folders.items()]

    def read(self, layer: str) -> DataFrame:
        """All committed rows of a layer, with event_date."""
        old = self.versions()
        parts = self._of_batches(layer, self._tail(old[-1]["batch_id"] if old else -1))
        whole = sorted({m["version"] for m in old if m[layer]})
        if whole:
            base = f"{self.root}/compacted"
            parts.append(self.stored(base, [f"{base}/version={v}/layer={layer}" for v in whole]))
        rows = parts[0] if parts else self.stored(self.root, [])
        for p in parts[1:]:
            rows = rows.unionByName(p)
        return rows.drop("layer")

    # ---- compaction ------------------------------------------------------------------
    def compact(self) -> int | None:
        """Copy the batches since the last version into few files a date; the number of the
        new version, or None if there is nothing to copy."""
        old = self.versions()
        tail = self._tail(old[-1]["batch_id"] if old else -1)
        if not tail:
            return None
        version = 1 + max((m["version"] for m in old), default=0)
        parts = [p for layer in LAYERS for p in self._of_batches(layer, tail)]
        if parts:
            rows = parts[0]
            for p in parts[1:]:
                rows = rows.unionByName(p)
            # adaptive execution joins small dates and splits large ones
            rows.hint("rebalance", "layer", "event_date").write.mode("overwrite").partitionBy("layer", "event_date").parquet(
                f"{self.root}/compacted/version={version}")
        names = ["batch_id", *[f.name for f in MARKER_FIELDS]]
        markers = self.spark.createDataFrame([tuple(m[n] for n in names) for m in tail], T.StructType([VERSION_SCHEMA[n] for n in names]))
        markers.coalesce(1).write.mode("overwrite").parquet(f"{self.root}/versions/version={version}")
        return version

    def clean(self, keep_batches: int = 0) -> list[str]:
        """Remove the folders of compacted batches but the last ``keep_batches`` of them; the
        removed paths. To be called when nobody reads them any more."""
        old = [m["batch_id"] for m in self.versions()]
        removed = []
        for n in old[:len(old) - keep_batches]:
            for folder in ("staged", "deduplicated", "commits"):
                if delete_path(self.spark, self.batch_path(folder, n)):
                    removed.append(self.batch_path(folder, n))
        return removed

