"""Lookups that pick one row: the lowest id per key, and the best tier below a quantity."""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quayside.functions.durable import set_aside, settled, shuffles_removed
from quayside.functions.numbering import PART_BITS

def lowest_id(df: DataFrame, *keys: str, name: str) -> DataFrame:
    """One row per key with its lowest id; rows without a full key are left out."""
    return df.dropna(subset=list(keys)).groupBy(*keys).agg(F.min("id").alias(name))


def last_by(value: str, order: str, where: Column | None = None) -> Column:
    """Value of the last row, by ``order``, among those where the condition holds."""
    return F.max_by(value, F.col(order) if where is None else F.when(where, F.col(order)))


def best_tier(
    asks: DataFrame, tiers: DataFrame, by: tuple[str, ...], ask: str, floor: str, take: tuple[str, ...]
) -> DataFrame:
    """``asks`` with the ``take`` columns of the tier that has the same ``by`` values and the highest
    ``floor`` not above ``ask``; the lowest id wins a tie. No such tier: NULLs.

    An as-of lookup over one sorted line: asks and tiers are range-partitioned together on key and amount,
    a tier before the asks it serves, and each ask takes the last tier before it, if that has its key. Amounts of a
    hot key spread over as many partitions as they fill, and equal asks by their hash. A partition then needs one thing
    of those before it, the last tier they hold: one row for each partition is carried on. Rows are
    never paired. Tiers whose key nobody asks for are left out before, and the rest are set aside; asks and the other tiers are shuffled twice, sorted the
    first time and dealt by partition the second.
    """
    order = [*by, "_at", "_kind", "_tie"]
    kinds = {c: asks.schema[c].dataType for c in by}
    keys = [F.col(c).cast(kinds[c]).alias(c) for c in by]
    known = asks.dropna(subset=[*by, ask]).select(*by).distinct()
    offered = tiers.dropna(subset=[*by, floor]).withColumns({c: F.col(c).cast(kinds[c]) for c in by})
    offered = offered.join(known, list(by), "left_semi")
    offered = offered.select(
        *keys, F.col(floor).cast("double").alias("_at"), F.lit(1).alias("_kind"), (-F.col("id").cast("bigint")).alias("_tie"),
        F.struct(*keys, *take).alias("_tier"), F.lit(None).cast(asks.schema).alias("_row"),
    )
    asked = asks.dropna(subset=[*by, ask]).select(
        *by, F.col(ask).cast("double").alias("_at"), F.lit(2).alias("_kind"), F.xxhash64(*asks.columns).alias("_tie"),
        F.lit(None).cast(offered.schema["_tier"].dataType).alias("_tier"), F.struct(*asks.columns).alias("_row"),
    )
    with set_aside(offered, "offered") as fitting, shuffles_removed(asks.sparkSession):
        line = fitting.unionByName(asked).repartitionByRange(*order).sortWithinPartitions(*order)
        line = settled(line.select("_tier", "_row", F.monotonically_increasing_id().alias("_no")), "line")
    line = line.withColumn("_part", F.shiftright("_no", PART_BITS))

    ends = line.groupBy("_part").agg(F.max_by("_tier", F.when(F.col("_tier").isNotNull(), F.col("_no"))).alias("_end"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # as many rows as partitions
    ends = ends.select("_part", F.last("_end", ignorenulls=True).over(before).alias("_carried"))
    here = Window.partitionBy("_part").orderBy("_no").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = line.withColumn("_last", F.last("_tier", ignorenulls=True).over(here)).filter("_row IS NOT NULL")
    found = found.join(ends, "_part").withColumn("_last", F.coalesce("_last", "_carried"))
    same = reduce(and_, [F.col(f"_last.{c}") == F.col(f"_row.{c}") for c in by])
    kept = [c for c in asks.columns if c not in take]
    priced = found.select(*[F.col(f"_row.{c}").alias(c) for c in kept], *[F.when(same, F.col(f"_last.{c}")).alias(c) for c in take])
    # Rows that cannot have a tier stay out of the line, where their missing keys would meet.
    open_ended = asks.filter(reduce(or_, [F.col(c).isNull() for c in (*by, ask)]))
    types = {f.name: f.dataType for f in tiers.schema.fields}
    nothing = [F.lit(None).cast(types[c]).alias(c) for c in take]
    return priced.unionByName(open_ended.select(*kept, *nothing))
