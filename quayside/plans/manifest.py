"""The manifest of an export: building, writing, reading and checking it.

``manifest.json`` is one file with one JSON document at every size. It is written in lines: what comes before the list
of files, one line for each entry, and what comes after. Tasks write the entries as sorted parts, which the Hadoop
file system joins; they are never a row or a list anywhere. A document in these lines is read by lines too, in as many
tasks as it has blocks. Any other JSON document is read as one row, up to 2 GB.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside import __version__
from quayside.sources.files import checksums, row_counts

_FILE_FIELDS = "file string, rows bigint, bytes bigint, checksum string, duration_seconds double, collector string"


def file_facts(spark: SparkSession, root: str, seconds: dict[str, float] | None = None) -> DataFrame:
    """Rows, bytes, checksum and entity of every Parquet file below ``root``."""
    facts = checksums(spark, root).join(row_counts(spark, root), "file")
    entity = F.element_at(F.split("file", "/"), 1)
    took = F.lit(None)
    if seconds:
        took = F.element_at(F.create_map(*[F.lit(x) for pair in seconds.items() for x in pair]), entity)
    return facts.select(
        "file", "rows", "bytes", "checksum", took.cast("double").alias("duration_seconds"), entity.alias("collector")
    )


def manifest_facts(
    spark: SparkSession,
    *,
    company: str,
    company_id: int,
    source_version: str,
    run_uuid: str,
    started_at: datetime | None,
    finished_at: datetime,
    errors: list[str] = (),
    warnings: list[str] = (),
    capabilities: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame]:
    """What a manifest says before and after its list of files, a row each."""
    duration = round((finished_at - started_at).total_seconds(), 3) if started_at else 0.0

    def texts(items):
        return F.array(*[F.lit(i) for i in items]).cast("array<string>")

    described = capabilities.select(F.struct("*")).scalar() if capabilities is not None else F.lit(None)
    head = {
        "version": F.lit(__version__),
        "schema_version": F.lit(finished_at.strftime("%Y-%m-%d")),
        "timestamp": F.lit(finished_at.isoformat()),
        "started_at": F.lit(started_at.isoformat() if started_at else None),
        "finished_at": F.lit(finished_at.isoformat()),
        "company": F.lit(company),
        "company_id": F.lit(company_id),
        "odoo_version": F.lit(source_version),
        "export_mode": F.lit("full"),
    }
    tail = {
        "errors": texts(errors),
        "warnings": texts(warnings),
        "total_duration_seconds": F.lit(duration),
        "capabilities": described,
        "run_uuid": F.lit(run_uuid),
    }
    return tuple(spark.range(1).select(*[c.alias(n) for n, c in part.items()]) for part in (head, tail))


def _file_system(spark: SparkSession, path: str):
    context = spark.sparkContext
    at = context._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(context._jsc.hadoopConfiguration())


def replace_file(spark: SparkSession, made: str, target: str) -> None:
    """Rename ``made`` to ``target``; whoever reads ``target`` finds the old file or the new one."""
    context = spark.sparkContext
    files = context._jvm.org.apache.hadoop.fs
    source, _ = _file_system(spark, made)
    place, system = _file_system(spark, target)
    how = context._gateway.new_array(getattr(files, "Options$Rename"), 1)
    how[0] = getattr(files, "Options$Rename").OVERWRITE
    files.FileContext.getFileContext(system.getUri(), context._jsc.hadoopConfiguration()).rename(source, place, how)


def write_manifest(files: DataFrame, root: str, **facts) -> str:
    """Write the manifest with the given file entries to ``manifest.json`` below ``root``; returns its path.

    The parts are copied by the driver's Hadoop client, block by block.
    """
    spark = files.sparkSession
    target, parts = f"{root.rstrip('/')}/manifest.json", f"{root.rstrip('/')}/_manifest"
    head, tail = (part.select(F.to_json(F.struct("*"))).first()[0] for part in manifest_facts(spark, **facts))
    lines = files.orderBy("file").select(F.to_json(F.struct("*")).alias("value"))
    lines.write.mode("overwrite").option("lineSep", _BETWEEN).text(parts)
    found, system = _file_system(spark, f"{parts}/part-*")
    sizes = sorted((str(s.getPath()), s.getLen()) for s in system.globStatus(found) if s.getLen())
    joined, _ = _file_system(spark, f"{parts}/joined")
    out = system.create(joined)
    try:
        out.write(f"{head[:-1]},{_OPEN}\n".encode())
        for i, (path, size) in enumerate(sizes):
            if i + 1 == len(sizes):
                size -= len(_BETWEEN)  # nothing comes after the last entry
            part = system.open(_file_system(spark, path)[0])
            try:
                spark.sparkContext._jvm.org.apache.commons.io.IOUtils.copyLarge(part, out, 0, size)
            finally:
                part.close()
        out.write(f"{chr(10) if sizes else ''}],{tail[1:]}\n".encode())
    finally:
        out.close()
    replace_file(spark, f"{parts}/joined", target)
    system.delete(_file_system(spark, parts)[0], True)
    return target


# How a document in lines begins its list, and what stands between two entries.
_OPEN, _BETWEEN = '"files":[', ",\n"


@dataclass(frozen=True)
class Manifest:
    """``document``: one row with the parsed document in ``manifest`` (a variant); ``entries``: a row for each entry of its
    list of files, in ``e`` (a variant). The document of a manifest in lines has an empty list."""

    document: DataFrame
    entries: DataFrame


def parse_manifest(spark: SparkSession, root: str) -> Manifest | None:
    """The manifest below ``root``, or None if it is no JSON document."""
    path = f"{root.rstrip('/')}/manifest.json"
    lines = spark.read.text(path)
    first = lines.select(F.col("value").endswith(_OPEN)).first()
    if first is not None and first[0]:
        entry = F.col("value").rlike(r"^\{.*\},?$")
        rest = [r.value for r in lines.filter(~entry).limit(3).collect()]
        entries = lines.filter(entry).select(F.try_parse_json(F.regexp_replace("value", ",$", "")).alias("e"))
        if len(rest) == 2 and entries.filter("e IS NULL").isEmpty():
            document = spark.createDataFrame([("".join(rest),)], "value string")
            document = document.select(F.try_parse_json("value").alias("manifest")).dropna()
            if not document.isEmpty():
                return Manifest(document, entries)
    whole = spark.read.text(path, wholetext=True)
    document = whole.select(F.try_parse_json("value").alias("manifest")).dropna()
    if document.isEmpty():
        return None
    listed = F.explode(F.expr("try_variant_get(manifest, '$.files', 'array<variant>')"))
    return Manifest(document, document.select(listed.alias("e")))


def read_manifest(spark: SparkSession, root: str) -> Manifest:
    """The manifest below ``root``; anything but a JSON document is an error."""
    manifest = parse_manifest(spark, root)
    if manifest is None:
        raise ValueError(f"{root}: manifest.json is not a JSON document")
    return manifest


def manifest_files(manifest: Manifest) -> DataFrame:
    """The manifest's file entries as rows."""
    names = [f.split() for f in _FILE_FIELDS.split(", ")]
    return manifest.entries.select(*[F.try_variant_get("e", f"$.{n}", t).alias(n) for n, t in names])


def malformed_entries(manifest: Manifest) -> DataFrame:
    """Errors about a file list that is no list, and entries that are no objects or have no file name."""
    kinds = F.create_map(*[F.lit(x) for pair in _PYTHON_NAMES.items() for x in pair])
    listed = manifest.document.select(
        F.expr("try_variant_get(manifest, '$.files', 'array<variant>')").alias("entries"),
        F.expr("try_variant_get(manifest, '$.files', 'variant')").alias("files"),
    )
    no_list = listed.filter(F.col("entries").isNull() & F.col("files").isNotNull()).select(
        F.lit("manifest['files'] must be a list").alias("error")
    )
    entries = manifest.entries.withColumn("kind", F.schema_of_variant("e"))
    shape = F.regexp_extract("kind", r"^[A-Z]+", 0)
    no_object = entries.filter(shape != "OBJECT").select(
        F.concat(
            F.lit("Expected dict in manifest['files'], got "), F.coalesce(F.element_at(kinds, shape), shape)
        ).alias("error")
    )
    name = F.schema_of_variant(F.expr("try_variant_get(e, '$.file', 'variant')"))
    no_name = entries.filter((shape == "OBJECT") & (F.coalesce(name, F.lit("")) != "STRING")).select(
        F.lit("manifest['files'][].file must be a string").alias("error")
    )
    return no_list.unionByName(no_object).unionByName(no_name)


# How error texts name the JSON types.
_PYTHON_NAMES = {
    "STRING": "str",
    "BIGINT": "int",
    "DECIMAL": "float",
    "DOUBLE": "float",
    "BOOLEAN": "bool",
    "ARRAY": "list",
    "VOID": "NoneType",
}


MISSING = "Missing file: "


def validate_files(listed: DataFrame, found: DataFrame) -> DataFrame:
    """Errors about listed files that are missing or whose checksum differs."""
    actual = found.select("file", F.col("checksum").alias("actual"))
    both = listed.filter(F.col("file").isNotNull()).join(actual, "file", "left")
    expected = F.coalesce(F.concat(F.lit("'"), F.col("checksum"), F.lit("'")), F.lit("None"))
    error = F.when(F.col("actual").isNull(), F.concat(F.lit(MISSING), F.col("file"))).when(
        ~F.col("actual").eqNullSafe(F.col("checksum")),
        F.concat(
            F.lit("Checksum mismatch for "), F.col("file"), F.lit(": expected "), expected, F.lit(", got "), F.col("actual")
        ),
    )
    return both.select(error.alias("error")).dropna()


def validate_manifest(spark: SparkSession, root: str) -> DataFrame:
    """Every error of the manifest below ``root``; none means the files are as listed."""
    manifest = read_manifest(spark, root)
    wrong = validate_files(manifest_files(manifest), checksums(spark, root))
    return malformed_entries(manifest).unionByName(wrong)


def recount(listed: DataFrame, counted: DataFrame) -> DataFrame:
    """Listed files whose row count is not the one found: ``file``, ``rows``, ``found_rows``."""
    found = counted.select("file", F.col("rows").alias("found_rows"))
    both = listed.select("file", "rows").join(found, "file", "left")
    return both.filter(~F.col("rows").eqNullSafe(F.col("found_rows")))
