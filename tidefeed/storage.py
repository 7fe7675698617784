"""Shared-storage helpers: where intermediate tables go, and how they are cut from their lineage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from contextvars import ContextVar, copy_context

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

_local_roots: dict[str, str] = {}
_run: ContextVar[str | None] = ContextVar("run", default=None)


def shared_root(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a session on a local master may leave the setting out; it then gets a temporary folder,
    which on a cluster would be visible to one machine only.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    if context.applicationId not in _local_roots:
        _local_roots[context.applicationId] = tempfile.mkdtemp(prefix="tidefeed-")
    return _local_roots[context.applicationId]


def new_folder(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that no other run uses; within ``run_folder``, below that."""
    return f"{_run.get() or shared_root(spark)}/{label}-{uuid.uuid4().hex}"


@contextmanager
def run_folder(spark: SparkSession, label: str) -> Iterator[str]:
    """A folder for all intermediate tables of a run, removed with them at its end."""
    folder = new_folder(spark, label)
    token = _run.set(folder)
    try:
        yield folder
    finally:
        _run.reset(token)
        remove(spark, folder)


def _placed(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder on whatever storage it lies, if it is there."""
    place, files = _placed(spark, path)
    files.delete(place, True)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a file or folder, on whatever storage."""
    place, files = _placed(spark, path)
    return files.exists(place)


def materialize(
    df: DataFrame, label: str, *metrics: Column
) -> tuple[DataFrame, dict[str, int | float | None]]:
    """Write ``df`` as a Parquet table in the shared folder and read it back.

    The table survives the loss of executors, is computed once however often it is read, and keeps
    column pruning for the readers. ``metrics`` (aggregates, plus the row count ``rows``) are observed
    while the table is written, so they cost no pass of their own.
    """
    spark = df.sparkSession
    path = new_folder(spark, label)
    seen = Observation(f"{label}-{uuid.uuid4().hex}")
    df.observe(seen, F.count(F.lit(1)).alias("rows"), *metrics).write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), seen.get


def run_together(spark: SparkSession, *jobs: Callable[[], object]) -> list:
    """Run independent driver-side jobs at once, so that one job's tail does not idle the cluster."""
    with ThreadPoolExecutor(max_workers=max(1, min(4, len(jobs)))) as pool:
        running = [
            pool.submit(copy_context().run, inheritable_thread_target(spark)(job)) for job in jobs
        ]
        return [job.result() for job in running]
