"""Texts packed for a shuffle: half the bytes of the shuffle's own compression."""

from __future__ import annotations

import ctypes
from contextlib import contextmanager, suppress
from functools import wraps

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


#: Rows of a batch that goes to a task's Python; 10,000 long texts at a time would fill its memory.
BATCH_ROWS = 1000


@contextmanager
def small_batches(spark: SparkSession):
    """What is run inside hands at most ``BATCH_ROWS`` rows at a time to Python; the session is left as it was."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    if not 0 < int(before) <= BATCH_ROWS:
        spark.conf.set(name, str(BATCH_ROWS))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def release() -> None:
    """Give what a worker has freed back to the system, as it lives on between tasks."""
    pa.default_memory_pool().release_unused()
    with suppress(OSError, AttributeError):  # not every C library has it
        ctypes.CDLL(None).malloc_trim(0)


def released(run):
    """``run`` for ``mapInArrow``; what it has freed goes back to the system at its end."""

    @wraps(run)
    def outer(batches):
        yield from run(batches)
        release()

    return outer


def packed(docs: DataFrame, key, text: str) -> DataFrame:
    """(key, pack): each text as a compressed block; a null is an empty text."""

    def run(batches):
        tool = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            texts = batch.column(1).fill_null("").cast(pa.binary())
            packs = pa.array([tool.compress(t) for t in texts.to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), packs], ["key", "pack"])

    rows = docs.select(key.alias("key"), F.col(text).alias("text"))
    return rows.mapInArrow(released(run), f"key {rows.schema['key'].dataType.simpleString()}, pack binary")


def unpacked(packs: pa.Array) -> pa.Array:
    tool = zstandard.ZstdDecompressor()
    return pa.array([tool.decompress(p) for p in packs.to_pylist()], pa.large_binary())
