"""Session settings the jobs rely on, and the shared folder for intermediate tables."""

from __future__ import annotations

import atexit
import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from rawstrata.sources import storage

SHUFFLE_PARTITIONS = "spark.sql.shuffle.partitions"
BYTES_PER_SHUFFLE_PARTITION = 128 * 1024 * 1024


def use_utc(spark: SparkSession) -> SparkSession:
    """Timestamps are stored and compared in UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def scratch_root(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir``.

    A local session without that setting gets a temporary folder. On a cluster, one of several
    processes on one machine included, such a folder would be private to the driver, so there
    the setting is required; that the folder it names is shared is the cluster's word.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        if not re.fullmatch(r"local(\[.*\])?", context.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="rawstrata-"))
    return context.getCheckpointDir()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that nothing else uses.

    Results that are read lazily keep the tables they scan, and a job that fails leaves some;
    these go when the Python process ends with its session open.
    """
    path = storage.child(scratch_root(spark), "rawstrata", f"{label}-{uuid.uuid4()}")
    if not _given_out:
        atexit.register(_remove_given_out)
    _given_out.append((spark, path))
    return path


_given_out: list[tuple[SparkSession, str]] = []


def _remove_given_out() -> None:
    for spark, path in _given_out:
        if spark.sparkContext._jsc is None:  # stopped before: nothing can be reached
            continue
        try:
            storage.delete(spark, path)
        except Exception:  # the JVM is gone; nothing depends on this
            return


@contextmanager
def staged(df: DataFrame, label: str) -> Iterator[DataFrame]:
    """Write a frame once as a columnar table and hand out a scan of it.

    Later stages then read only the columns they need, a lost executor costs a re-read
    and not a re-computation, and every stage sees the same rows. It is packed with zstd, which
    halves the payload hashes. The table is removed at the end.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    try:
        df.write.mode("errorifexists").parquet(path, compression="zstd")
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        storage.delete(spark, path)


@contextmanager
def sized_shuffles(spark: SparkSession, input_bytes: int) -> Iterator[None]:
    """Raise the shuffle partition count to suit the input; adaptive execution merges
    what turns out small. The session's own setting is the minimum and comes back after."""
    configured = spark.conf.get(SHUFFLE_PARTITIONS)
    wanted = input_bytes // BYTES_PER_SHUFFLE_PARTITION + 1
    if wanted <= int(configured):
        yield
        return
    spark.conf.set(SHUFFLE_PARTITIONS, str(wanted))
    try:
        yield
    finally:
        spark.conf.set(SHUFFLE_PARTITIONS, configured)
