"""Consecutive row numbers without putting a group on one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quayside.functions.durable import settled, shuffles_removed

PART_BITS = 33  # monotonically_increasing_id keeps the partition number above these bits


def number_rows(df: DataFrame, by: str, order: tuple[str, ...], name: str = "row_no", folders: tuple[str, ...] = ()) -> DataFrame:
    """Number the rows of each ``by`` group from 0 in ``order``. Rows without a group are dropped.

    The rows are range-partitioned on group and order, so a hot group covers many partitions. Only the first
    row of each (group, partition) and the counts are summed up in one place. The rows are written once, with their place
    in their partition; a number is that place less that of the group's first row there, plus what came before.

    With ``folders``, the values of the group that are read one by one, each of them is a folder of its own and all other
    groups share one, however many there are: a filter ``by = <value>`` on the result reads that folder alone.
    """
    sort = [by, *order]
    ranged = df.filter(F.col(by).isNotNull()).repartitionByRange(*sort).sortWithinPartitions(*sort)
    placed = ranged.withColumn("_at", F.monotonically_increasing_id())
    with shuffles_removed(df.sparkSession):
        if folders:
            # rows stay sorted by group, so a task has one folder open at a time
            shelf = F.when(F.col(by).isin(*folders), F.col(by)).otherwise(F.lit(_OTHERS))
            placed = settled(placed.withColumn(f"{by}_folder", shelf), "numbered", f"{by}_folder")
        else:
            placed = settled(placed, "numbered")
    placed = placed.withColumn("_part", F.shiftright("_at", PART_BITS))
    parts = placed.groupBy(by, "_part").agg(F.min("_at").alias("_first"), F.count("*").alias("_rows"))
    earlier = Window.partitionBy(by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(by, "_part", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"), "_first")
    parts = settled(parts, "parts")  # one row for each group and partition, and a known size
    numbered = placed.join(parts, [by, "_part"])
    number = F.col("_at") - F.col("_first") + F.col("_before")
    return numbered.withColumn(name, number).drop("_at", "_part", "_first", "_before")


_OTHERS = "__others__"


def of_group(numbered: DataFrame, by: str, value: str) -> DataFrame:
    """The rows of one group of :func:`number_rows`; of its folder alone, if the groups have folders."""
    rows = numbered
    if f"{by}_folder" in numbered.columns:
        rows = rows.filter(F.col(f"{by}_folder") == value).drop(f"{by}_folder")
    return rows.filter(F.col(by) == value)
