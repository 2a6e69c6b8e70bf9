"""Planning decisions: reading, conforming and numbering them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.functions.numbering import number_rows
from quayside.schemas import decision_schema
from quayside.sources.catalog import utc


def conform_decisions(df: DataFrame) -> DataFrame:
    """The decision columns with their declared types; a column the file lacks is NULL."""
    present = set(df.columns)
    return df.select(
        *[
            (F.col(f.name) if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in decision_schema()
        ]
    )


def read_decisions(spark: SparkSession, prefix: str) -> DataFrame:
    """``decisions.parquet`` (a file or a folder) under ``prefix``; its columns are those of all its files."""
    return conform_decisions(utc(spark).read.option("mergeSchema", True).parquet(f"{prefix.rstrip('/')}/decisions.parquet"))


def ordered_decisions(decisions: DataFrame, folders: tuple[str, ...] = ()) -> DataFrame:
    """Decisions that have a type, with ``row_no``: their place among their type, by time and id.

    ``folders``: types that are read apart later, by ``numbering.of_group``.
    """
    order = ("decision_timestamp", "decision_id")
    return number_rows(conform_decisions(decisions), "decision_type", order, folders=folders)


def decision_types(decisions: DataFrame) -> DataFrame:
    """The distinct types in a batch."""
    return decisions.select("decision_type").dropna().distinct()
