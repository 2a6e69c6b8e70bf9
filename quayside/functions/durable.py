"""Cutting lineage and scratch space, on storage every executor can reach."""

from __future__ import annotations

import re
import uuid
from contextlib import contextmanager
from contextvars import ContextVar
from threading import Lock

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, or the context's checkpoint folder.

    On a cluster it must be set, to storage that all executors share. In local mode, where all is one
    process, it is set to the Java virtual machine's folder for temporary files if need be.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    folder = folder or context.getCheckpointDir()
    if folder is None:
        if not re.match(r"local(\[|$)", context.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = f"{context._jvm.java.lang.System.getProperty('java.io.tmpdir')}/quayside-{context.applicationId}"
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path under the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/quayside/{name}-{uuid.uuid4().hex}"


def settled(df: DataFrame, name: str = "settled", *folders: str) -> DataFrame:
    """``df`` written to the shared folder, in one folder for each value of ``folders`` if given, and read back.

    This cuts lineage: later steps all read the same rows, whatever executors are lost, and each
    reads only the columns it needs. The caller's job leaves the files; whoever owns the folder clears
    ``quayside/`` in it when no job runs.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.partitionBy(*folders).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def set_aside(df: DataFrame, name: str = "aside", steps_done: bool = False):
    """``df`` written to the shared folder and read back, for what runs inside only: what it shuffled is removed when it is
    written, and the steps made so far if they are done with (see :func:`in_steps`); its own files at the end."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    try:
        with shuffles_removed(spark):
            df.write.option("compression", "zstd").parquet(path)
        if steps_done:
            _remove_steps()
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        _remove(spark, path)


def _remove(spark: SparkSession, path: str) -> None:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


_steps: ContextVar[list[tuple[SparkSession, str]] | None] = ContextVar("steps", default=None)


@contextmanager
def in_steps(kept: bool = False):
    """Exports that are planned inside are worked off in steps: what they hand to :func:`step` is written at once, so the
    disk holds the shuffles of one step. The written steps are removed at the end, unless they are ``kept`` for a result
    that is run later. Outside, an export is only planned."""
    made: list[tuple[SparkSession, str]] = []
    token = _steps.set(made)
    try:
        yield
    finally:
        if not kept:
            _remove_steps()
        _steps.reset(token)


def _remove_steps() -> None:
    made = _steps.get() or []
    while made:
        _remove(*made.pop())


def step(df: DataFrame, name: str) -> DataFrame:
    """``df`` itself; inside :func:`in_steps`, ``df`` written and read back, without the shuffles it took."""
    made = _steps.get()
    if made is None:
        return df
    spark = df.sparkSession
    path = scratch_path(spark, name)
    made.append((spark, path))
    with shuffles_removed(spark):
        df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_lock = Lock()
_removing: dict[str, tuple[int, str | None]] = {}  # by session: how many callers are inside, and the setting before them


@contextmanager
def shuffles_removed(spark: SparkSession):
    """A query that runs inside leaves no shuffle files behind; Spark would keep them until Java collects its garbage.

    For jobs that write many tables, each by a query of its own. A DataFrame that is run twice would shuffle twice.
    Threads may be inside together; the session's setting is put back when the last one leaves.
    """
    name, session = "spark.sql.classic.shuffleDependency.fileCleanup.enabled", spark._jsparkSession.sessionUUID()
    with _lock:
        inside, before = _removing.get(session) or (0, spark.conf.get(name, None))
        spark.conf.set(name, "true")
        _removing[session] = inside + 1, before
    try:
        yield
    finally:
        with _lock:
            inside, before = _removing.pop(session)
            if inside > 1:
                _removing[session] = inside - 1, before
            elif before is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, before)
