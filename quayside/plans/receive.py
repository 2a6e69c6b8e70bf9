"""Receiving a drop: decisions below a prefix, planned only if its manifest holds."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.plans.manifest import MISSING, malformed_entries, manifest_files, parse_manifest, validate_files
from quayside.plans.writeback import ORIGIN, Batch, plan_decisions
from quayside.sources.catalog import Erp, utc
from quayside.sources.decisions import conform_decisions
from quayside.sources.files import checksums

# Why nothing is planned.
NO_MANIFEST, NOT_JSON = "No manifest.json found", "manifest.json is not a JSON document"
INVALID, NO_DECISIONS = "Manifest validation failed", "No decisions.parquet found"


@dataclass
class Received:
    """``errors``: ``error`` and ``detail``, no rows if all is well; ``batch`` is None if there are any. ``missing``: the
    listed files that are not there, if that is all that is wrong."""

    errors: DataFrame
    batch: Batch | None
    missing: tuple[str, ...] = ()


def receive(
    spark: SparkSession, prefix: str, erp: Erp, company_id: int, origin: str = ORIGIN, cleanup: bool = True
) -> Received:
    """Plan the decisions that the manifest below ``prefix`` lists, or say why nothing is planned.

    ``decisions.parquet`` is a file or a folder; of a folder only listed files are read. The names in one
    drop's manifest reach the driver.
    """
    prefix = prefix.rstrip("/")

    def refused(error: str, details: tuple = (None,)) -> Received:
        errors = spark.createDataFrame([(error, d) for d in details], "error string, detail string")
        missing = tuple(d.removeprefix(MISSING) for d in details if d and d.startswith(MISSING))
        return Received(errors, None, missing if len(missing) == len(details) else ())

    context = utc(spark).sparkContext
    path = context._jvm.org.apache.hadoop.fs.Path(f"{prefix}/manifest.json")
    if not path.getFileSystem(context._jsc.hadoopConfiguration()).exists(path):
        return refused(NO_MANIFEST)
    manifest = parse_manifest(spark, prefix)
    if manifest is None:
        return refused(NOT_JSON)
    listed = manifest_files(manifest)
    wrong = malformed_entries(manifest).unionByName(validate_files(listed, checksums(spark, prefix, "*")))
    if details := tuple(sorted(r.error for r in wrong.collect())):
        return refused(INVALID, details)
    ours = (F.col("file") == "decisions.parquet") | F.col("file").rlike(r"^decisions\.parquet/.*\.parquet$")
    files = sorted(r.file for r in listed.filter(ours).select("file").distinct().collect())
    if not files:
        return refused(NO_DECISIONS)
    # a column that only some of the files have is one of the drop's
    rows = conform_decisions(spark.read.option("mergeSchema", True).parquet(*[f"{prefix}/{f}" for f in files]))
    return Received(
        spark.createDataFrame([], "error string, detail string"), plan_decisions(rows, erp, company_id, origin, cleanup)
    )
