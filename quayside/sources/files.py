"""Files under a prefix: names, sizes, row counts, checksums. Any Hadoop path works."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def decoded(uri: Column) -> Column:
    """A file path as Spark's metadata spell it, a URI, as a name."""
    return F.url_decode(F.regexp_replace(uri, r"\+", "%2B"))  # url_decode takes a plus for a blank


def _relative(spark: SparkSession, root: str, path: str = "_metadata.file_path") -> Column:
    """The name of a file below ``root``, without scheme or authority."""
    tail = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root).toUri().getRawPath().rstrip("/")
    path = F.regexp_replace(path, r"^[A-Za-z][^:/]*:(//[^/]*)?", "")
    return decoded(F.substring(path, len(tail) + 2, 1 << 20))


@contextmanager
def listed_together(spark: SparkSession):
    """A path that is opened inside is listed by a few tasks for each core, many folders each.

    Spark would start a task for each folder, which takes many times as long as listing it.
    """
    name = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    before = spark.conf.get(name)
    spark.conf.set(name, str(min(int(before), 4 * spark.sparkContext.defaultParallelism)))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def list_files(spark: SparkSession, root: str, pattern: str = "*") -> DataFrame:
    """``file`` (relative to ``root``) and ``bytes`` of every file below it, in name order.

    The contents are not read.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern)
    with listed_together(spark):
        files = files.load(root)
    return files.select(_relative(spark, root).alias("file"), F.col("length").alias("bytes")).orderBy("file")


#: Files from this size on are read in blocks by a task's own reader; smaller ones are one row of Spark's.
STREAM_FROM = 256 * 1024 * 1024
_BLOCK = 8 * 1024 * 1024


def checksums(spark: SparkSession, root: str, pattern: str = "*.parquet") -> DataFrame:
    """``file``, ``bytes`` and ``checksum`` (``sha256:<hex>``) of every file below ``root``, whatever its size.

    Spark reads a file below ``STREAM_FROM`` as one row and hashes it. A larger one, which may not fit a row, is hashed by
    one task block by block; each such file is a task of its own. Large files are opened by pyarrow, which knows local
    paths, HDFS and the usual object stores.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern)
    with listed_together(spark):
        files = files.load(root)
    kind = "file string, bytes bigint, checksum string"
    small = files.filter(F.col("length") < STREAM_FROM).select(
        _relative(spark, root).alias("file"),
        F.col("length").alias("bytes"),
        F.concat(F.lit("sha256:"), F.sha2("content", 256)).alias("checksum"),
    )
    large = files.filter(F.col("length") >= STREAM_FROM).select(_relative(spark, root).alias("file"), F.col("length").alias("bytes"), "path")
    count = large.count()  # names and sizes only are looked at
    if not count:
        return small

    def digest(batches):
        import hashlib

        import pyarrow as pa

        for batch in batches:
            for file, size, path in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                total = hashlib.sha256()
                for block in _blocks_of(path):
                    total.update(block)
                yield pa.RecordBatch.from_pydict({"file": [file], "bytes": [size], "checksum": [f"sha256:{total.hexdigest()}"]})

    spread = large.repartition(min(count, 10_000), "path")
    return small.unionByName(spread.mapInArrow(digest, kind))


def _blocks_of(path: str):
    """The contents of one file, block by block."""
    from urllib.parse import unquote

    from pyarrow import fs

    local = path.removeprefix("file:")
    if local != path:  # a Hadoop path spells blanks and the like as a URI does
        system, name = fs.LocalFileSystem(), "/" + unquote(local).lstrip("/")
    else:
        system, name = fs.FileSystem.from_uri(path)
    with system.open_input_stream(name) as stream:
        while block := stream.read(_BLOCK):
            yield block


def copy_file(spark: SparkSession, source: str, target: str) -> None:
    """Copy one file by the driver's Hadoop client; folders of ``target`` are made."""
    context = spark.sparkContext
    paths = [context._jvm.org.apache.hadoop.fs.Path(p) for p in (source, target)]
    conf = context._jsc.hadoopConfiguration()
    systems = [p.getFileSystem(conf) for p in paths]
    context._jvm.org.apache.hadoop.fs.FileUtil.copy(systems[0], paths[0], systems[1], paths[1], False, True, conf)


def row_counts(spark: SparkSession, root: str) -> DataFrame:
    """``file`` and ``rows`` of every Parquet file below ``root``, whatever its columns.

    The files are read with a column none of them has, so only their footers are looked at. Every row brings its file's
    path; it is spelled as a name once for each file, not for each row.
    """
    files = spark.read.schema("_no_column int").option("recursiveFileLookup", True)
    with listed_together(spark):
        files = files.option("pathGlobFilter", "*.parquet").parquet(root)
    counted = files.select(F.col("_metadata.file_path").alias("path")).groupBy("path").agg(F.count("*").alias("rows"))
    return counted.select(_relative(spark, root, "path").alias("file"), "rows")
