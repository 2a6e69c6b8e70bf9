"""What became of every drop, kept from trigger to trigger, and the records that earlier drops planned.

The ledger is a table beside the planned ones: a folder for each batch, written last, so a batch that is run again
finds what it found the first time. The records are read from the planned tables themselves.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.sources.catalog import Erp

PLANNED, WAITING, REFUSED, REPEATED = "planned", "waiting", "refused", "repeated"
ENTRY = "checksum string, prefix string, state string, detail string, since long, number long"

#: Ids from here on name records that a drop planned and nobody has created yet: above all real ones, as a new record's is.
PLANNED_FROM = 1 << 62
_ROW_BITS = 40  # rows of a drop; the drops' numbers stand above them

# What a planned table becomes in the source, and the columns that a new record has there beside its own.
MADE = {
    "purchase_orders": ("purchase_order", {"state": "draft"}),
    "production_orders": ("mrp_production", {"state": "draft"}),
    "transfers": ("stock_picking", {"state": "draft"}),
    "orderpoint_creates": ("stock_warehouse_orderpoint", {}),
}


def _exists(spark: SparkSession, path: str) -> bool:
    context = spark.sparkContext
    at = context._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(context._jsc.hadoopConfiguration()).exists(at)


def ledger(spark: SparkSession, sink: str, before: int | None = None) -> DataFrame:
    """The last entry of every drop: ``checksum`` of its manifest, ``prefix``, ``state``, ``detail``, ``since`` (the batch that
    first saw it), ``number`` (its place among the planned drops) and ``batch``. ``before``: as it was before that batch."""
    path = f"{sink}/ledger"
    if not _exists(spark, path):
        return spark.createDataFrame([], f"{ENTRY}, batch long")
    rows = spark.read.schema(f"{ENTRY}, batch long").parquet(path)
    if before is not None:
        rows = rows.filter(F.col("batch") < before)
    last = F.max_by(F.struct("state", "detail", "since", "number", "batch"), "batch")
    return rows.groupBy("checksum", "prefix").agg(last.alias("last")).select("checksum", "prefix", "last.*")


def enter(spark: SparkSession, sink: str, batch_id: int, entries: list[tuple]) -> None:
    """Write the entries of a batch, as many as it had drops."""
    spark.createDataFrame(entries, ENTRY).coalesce(1).write.mode("overwrite").parquet(f"{sink}/ledger/batch={batch_id}")


def planned_id(number: int) -> Column:
    """The id of a record that the ``number``-th planned drop makes from its row ``_row``, in order of drop and row."""
    return F.lit(PLANNED_FROM + (number << _ROW_BITS)) + F.col("_row")


def planned_records(spark: SparkSession, sink: str, table: str, seen: Column) -> DataFrame | None:
    """Rows of a planned table that drops in ``seen`` (by ``batch`` and ``prefix``) made and none of them took back."""
    if not _exists(spark, f"{sink}/{table}"):
        return None
    made = spark.read.parquet(f"{sink}/{table}").filter(seen)
    gone = f"{sink}/delete_{MADE[table][0]}"
    if _exists(spark, gone):
        taken = spark.read.parquet(gone).filter(seen).select(F.col("id").alias("planned_id"))
        made = made.join(taken, "planned_id", "left_anti")
    return made


def with_planned(erp: Erp, spark: SparkSession, sink: str, company_id: int, seen: Column) -> Erp:
    """``erp`` as it will be once the records of earlier drops are created."""
    grown = {}
    for table, (relation, facts) in MADE.items():
        made = planned_records(spark, sink, table, seen)
        if made is None or relation not in erp.tables:
            continue
        known = erp[relation].withColumn("id", F.col("id").cast("bigint"))
        values = {c: F.col(c) for c in made.columns} | {c: F.lit(v) for c, v in facts.items()}
        values |= {"id": F.col("planned_id"), "company_id": F.lit(company_id)}
        columns = [
            (values[f.name] if f.name in values else F.lit(None)).cast(f.dataType).alias(f.name) for f in known.schema.fields
        ]
        grown[relation] = known.unionByName(made.select(*columns))
    return replace(erp, tables=erp.tables.replacing(**grown))
