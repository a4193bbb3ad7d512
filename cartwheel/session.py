"""Session helpers: UTC clock, adaptive execution, and a shared scratch area.

Library functions never create sessions; only jobs, tests and the bench do. Every
named query calls :func:`use_utc` on the session it is handed, because the caller's
session may have another time zone.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


#: Partition folders that a task writes side by side; it sorts its rows by folder beyond that.
OPEN_FOLDERS = 32


def build_session(
    app_name: str = "cartwheel",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session configured for this library.

    ``master`` is only set when given, so the same code runs under spark-submit on a
    cluster. AQE stays on: it coalesces small shuffle partitions, converts joins to
    broadcast when a side turns out small at run time, and splits skewed partitions.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        # RocksDB keeps streaming dedup state off the JVM heap at scale.
        "spark.sql.streaming.stateStore.providerClass": (
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
        ),
        # commit only the changes of each micro-batch instead of a full snapshot
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
        # a file for each of some partition folders instead of sorting whole rows by folder
        "spark.sql.maxConcurrentOutputFileWriters": str(OPEN_FOLDERS),
        # remove reliable-checkpoint files once their DataFrames are garbage-collected
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    use_utc(spark)
    return spark


def use_utc(spark: SparkSession) -> None:
    """All timestamps in this library are interpreted in UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")


@contextmanager
def unsorted_writes(spark: SparkSession, folders: int = OPEN_FOLDERS) -> Iterator[None]:
    """Writes into few partition folders, and streams started, meanwhile keep a file open for
    each instead of sorting whole rows by folder first, which spills. A caller's own value stays."""
    name = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(name)
    if before != "0":
        yield
        return
    spark.conf.set(name, str(folders))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def _context(spark: SparkSession):
    """The SparkContext, or None for a Spark Connect session (which has none)."""
    try:
        return spark.sparkContext
    except Exception:  # Connect sessions raise on sparkContext
        return None


def app_id(spark: SparkSession) -> str:
    sc = _context(spark)
    if sc is not None:
        return sc.applicationId
    return spark.conf.get("spark.app.id", None) or str(id(spark))


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for lineage cuts, stream checkpoints and derived tables.

    On a cluster this is ``spark.checkpoint.dir`` (a path every executor can reach);
    without it a cluster session fails loudly. Only a ``local[...]`` session without
    one (tests) gets a private temporary folder.
    """
    sc = _context(spark)
    current = sc.getCheckpointDir() if sc is not None else None
    if not current:
        current = spark.conf.get("spark.checkpoint.dir", None)
        if not current:
            if sc is None or not sc.master.startswith("local"):
                # never a machine-local folder on a cluster: executors could not see it
                raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
            current = tempfile.mkdtemp(prefix="cartwheel-ckpt-")
        if sc is not None:
            sc.setCheckpointDir(current)
            current = sc.getCheckpointDir()
    return current


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A fresh, unique location under the checkpoint root."""
    root = checkpoint_root(spark)
    return "/".join([root.rstrip("/"), "cartwheel", *parts, uuid.uuid4().hex])


def delete_path(spark: SparkSession, path: str) -> bool:
    """Delete a folder on whatever file system its path names; whether it was there."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def folders_in(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in a folder (none if it is not there)."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return sorted(s.getPath().getName() for s in files.listStatus(target) if s.isDirectory()) if files.exists(target) else []


def local_path(path: str) -> str:
    """Strip a ``file:`` scheme, for the few checks that look at local files in tests."""
    if path.startswith("file:"):
        path = path[len("file:") :]
        while path.startswith("//"):
            path = path[1:]
    return os.path.abspath(path)
