"""Intermediate tables on storage that all executors share."""

from __future__ import annotations

import re
import tempfile
import threading
import uuid
import warnings
from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from contextvars import ContextVar, copy_context
from typing import Any

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"
_JOB: ContextVar[str | None] = ContextVar("job", default=None)
#: Deletes the shuffle files of an execution at its end; if the same execution is asked for again, its stages run again.
_DROPS = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_LOCK = threading.Lock()
#: How many wish shuffles dropped, and the setting before the first.
_DROPPING: list = [0, None]


def scratch_path(spark: SparkSession) -> str:
    """A new path below the folder the cluster names in ``spark.checkpoint.dir``, or below the job's own folder there."""
    return f"{_JOB.get() or _root(spark)}/{uuid.uuid4().hex}"


def _root(spark: SparkSession) -> str:
    base = spark.conf.get(_SETTING, None) or _own_folder(spark)
    one_machine = _one_machine(spark)
    if not one_machine and re.match(r"file:|/(?!/)", base):
        warnings.warn(f"{_SETTING} is {base}: on a cluster this must be a mount that all machines share", stacklevel=3)
    return f"{base.rstrip('/')}/tallystar"


def _one_machine(spark: SparkSession) -> bool:
    return re.fullmatch(r"local(\[[^]]*\])?", spark.sparkContext.master) is not None


def _own_folder(spark: SparkSession) -> str:
    """The folder set in the session, or a temporary one if all runs in one process."""
    context = spark.sparkContext
    if not context.getCheckpointDir():
        if not _one_machine(spark):
            raise ValueError(f"set {_SETTING} to a folder that all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="tallystar-"))
    return context.getCheckpointDir()


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """What runs meanwhile leaves no shuffle files, which else stay until the driver happens to collect its garbage.

    The session has one setting for all threads, so it holds until the last of them ends.
    """
    with _LOCK:
        if not _DROPPING[0]:
            _DROPPING[1] = spark.conf.get(_DROPS, None)
            spark.conf.set(_DROPS, "true")
        _DROPPING[0] += 1
    try:
        yield
    finally:
        with _LOCK:
            _DROPPING[0] -= 1
            if not _DROPPING[0] and _DROPPING[1] is None:
                spark.conf.unset(_DROPS)
            elif not _DROPPING[0]:
                spark.conf.set(_DROPS, _DROPPING[1])


@contextmanager
def scratch_of_job(spark: SparkSession) -> Iterator[str]:
    """A scratch folder for what is pinned meanwhile, deleted at the end, also of a job that fails; shuffles are dropped as they end.

    Frames that read it are of no use afterwards.
    """
    path = scratch_path(spark)
    token = _JOB.set(path)
    try:
        with shuffles_dropped(spark):
            yield path
    finally:
        _JOB.reset(token)
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def at_once(*jobs: Callable[[], Any]) -> list:
    """What the jobs return, in their order. They run beside each other, so that tasks of one use the cores another leaves idle.

    Ends when all have ended; then the first that failed raises. What they pin lies in the scratch of the job that called.
    """
    with ThreadPoolExecutor(len(jobs)) as pool:
        running = [pool.submit(copy_context().run, job) for job in jobs]
    return [job.result() for job in running]


def pin(df: DataFrame, codec: str | None = None) -> DataFrame:
    """Write ``df`` and read it back, so that every later use sees the same rows.

    The copy outlives lost executors, and unlike a checkpoint it is columnar:
    later steps read only the columns they need, and the planner knows its size. The shuffles it took are deleted.
    It is kept until the job's scratch ends (``scratch_of_job``), else until the checkpoint folder is cleaned.
    ``codec``, the session's if not given, is for large tables that should take less disk.
    """
    return _write(df, scratch_path(df.sparkSession), codec)


def _write(df: DataFrame, path: str, codec: str | None = None) -> DataFrame:
    spark = df.sparkSession
    with shuffles_dropped(spark):
        df.write.parquet(path, compression=codec)
    return spark.read.schema(df.schema).parquet(path)


def pin_in_turn(frames: Iterable[DataFrame], path: str, codec: str | None = None) -> DataFrame:
    """The rows of frames of one schema as one table at ``path``, a frame after the other, so that the shuffles of only one lie there at a time."""
    schema = None
    for df in frames:
        spark, schema = df.sparkSession, schema or df.schema
        with shuffles_dropped(spark):
            df.write.mode("append").parquet(path, compression=codec)
    return spark.read.schema(schema).parquet(path)


def kept(spark: SparkSession, make: Callable[[], DataFrame]) -> DataFrame:
    """``make()`` pinned, and all that it pinned on the way deleted."""
    path = scratch_path(spark)
    with scratch_of_job(spark):
        return _write(make(), path)
