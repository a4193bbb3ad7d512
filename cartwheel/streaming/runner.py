"""Starting streams: production triggers, and bounded ``availableNow`` runs.

A bounded run processes everything available, then stops; its output is an ordinary
Parquet directory (with the file sink's ``_spark_metadata`` log) that a batch query
or the next stream reads. Nothing is collected to the driver.
"""

from __future__ import annotations

import time
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from cartwheel.session import unsorted_writes

#: Seconds between two looks at a bounded run's progress.
LOOK_S = 0.5


class Dropped:
    """Running total of the rows behind the watermark, batch by batch.

    Spark remembers the progress of the last batches only
    (``spark.sql.streaming.numRecentProgressUpdates``), so it is read while the query runs.
    Batch ids have no gaps: a forgotten batch is an error, never a lower number.
    """

    def __init__(self, remembered: int):
        self.remembered = remembered
        self.total = 0
        self.last: int | None = None  # batch id
        self.rows = 0  # of the last batch, which may be reported again

    def take(self, progress: Iterable) -> None:
        found: dict[int, int] = {}
        updates = list(progress)
        for p in updates:
            rows = sum(op.numRowsDroppedByWatermark for op in p.stateOperators)
            found[p.batchId] = max(rows, found.get(p.batchId, 0))
        if not found:
            return
        first = min(found)
        # Spark drops the oldest update when the list has come to the number remembered
        if first > self.last + 1 if self.last is not None else len(updates) >= self.remembered - 1 and first > 0:
            raise RuntimeError(f"the progress of batches before {first} was forgotten before it was read")
        for k in sorted(found):
            if self.last is None or k > self.last:
                self.total, self.last, self.rows = self.total + found[k], k, found[k]
            elif k == self.last and found[k] > self.rows:
                self.total, self.rows = self.total + found[k] - self.rows, found[k]


def start_stream(
    df: DataFrame,
    path: str | None,
    checkpoint: str,
    fmt: str = "parquet",
    partition_by: Sequence[str] = (),
    processing_time: str | None = "5 seconds",
    available_now: bool = False,
    query_name: str | None = None,
    options: dict[str, str] | None = None,
) -> StreamingQuery:
    """Append-mode stream with a checkpoint; returns at once."""
    writer = df.writeStream.format(fmt).outputMode("append").option("checkpointLocation", checkpoint)
    if fmt == "parquet":
        writer = writer.option("compression", "zstd")  # JSON texts and ids halve
    if path is not None:
        writer = writer.option("path", path)
    for k, v in (options or {}).items():
        writer = writer.option(k, v)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if query_name:
        writer = writer.queryName(query_name)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()


def run_to_completion(
    df: DataFrame,
    path: str,
    checkpoint: str,
    partition_by: Sequence[str] = (),
    fmt: str = "parquet",
    timeout_s: float | None = None,
) -> StreamingQuery:
    """Run ``df`` with ``availableNow`` until the input is drained; raise on failure."""
    with unsorted_writes(df.sparkSession):  # the file sink asks the session that the stream was made in
        query = start_stream(df, path, checkpoint, fmt=fmt, partition_by=partition_by, available_now=True)
        query.dropped = dropped = Dropped(_remembered(df))
        end = time.monotonic() + timeout_s if timeout_s else float("inf")
        while not query.awaitTermination(max(0.01, min(LOOK_S, end - time.monotonic()))):
            dropped.take(query.recentProgress)
            if time.monotonic() >= end:
                query.stop()
                raise TimeoutError(f"stream into {path} did not finish in {timeout_s} s")
    error = query.exception()
    if error is not None:
        raise RuntimeError(f"stream into {path} failed: {error}")
    dropped.take(query.recentProgress)
    return query


def _remembered(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.streaming.numRecentProgressUpdates"))


def late_rows(query: StreamingQuery) -> int:
    """Rows that ``query``, finished by ``run_to_completion``, dropped because they were behind the watermark."""
    return query.dropped.total
