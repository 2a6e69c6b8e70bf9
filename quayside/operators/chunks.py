"""Key ranges: cutting an entity into chunks of bounded key span."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.schemas import CHUNKABLE, key_column
from quayside.sources.catalog import Erp

MAX_CHUNK_ROWS = 50_000

# Relations that chunkable entities are cut on, where the name differs.
_PRIMARY = {
    "partner": "res_partner",
    "product": "product_product",
    "mps_schedule": "mrp_production_schedule",
    "mps_forecast": "mrp_product_forecast",
}

_BLOCK = 4096  # ranges made from one row at a time


def primary_relation(entity: str) -> str:
    return _PRIMARY.get(entity, entity)


def id_span(relation: DataFrame, key: str = "id") -> DataFrame:
    """Row count and lowest and highest key, 0 for an empty relation."""
    return relation.agg(
        F.count("*").alias("rows"),
        F.coalesce(F.min(key), F.lit(0)).cast("bigint").alias("low"),
        F.coalesce(F.max(key), F.lit(0)).cast("bigint").alias("high"),
    )


def _ceil_div(a: str, b: str) -> Column:
    return F.expr(f"({a} + {b} - 1) div ({b})")


def chunk_plan(span: DataFrame, max_rows: int = MAX_CHUNK_ROWS) -> DataFrame:
    """Half-open ranges ``[key_from, key_to)`` that cover a span, or the one chunk (0, 0) if it is small."""
    cut = (
        span.withColumn("step", _cut_step(max_rows))
        .withColumn("chunks", F.when(F.col("step") > 0, _ceil_div("(high - low + 1)", "step")).otherwise(F.lit(1)))
        .select("low", "high", "step", "chunks")
    )
    blocks = cut.withColumn("_block", F.explode(F.sequence(F.lit(0), F.expr(f"(chunks - 1) div {_BLOCK}"))))
    last = F.least(F.col("chunks"), (F.col("_block") + 1) * _BLOCK) - 1
    numbers = blocks.withColumn("sequence", F.explode(F.sequence(F.col("_block") * _BLOCK, last)))
    start = F.col("low") + F.col("sequence") * F.col("step")
    ranged = F.col("step") > 0
    return numbers.select(
        "sequence",
        F.when(ranged, start).otherwise(F.lit(0)).alias("key_from"),
        F.when(ranged, F.least(start + F.col("step"), F.col("high") + 1)).otherwise(F.lit(0)).alias("key_to"),
    )


def _cut_step(max_rows: int) -> Column:
    """Keys per chunk; 0 means the span is not cut."""
    wanted = (F.col("rows") > max_rows) & (F.col("high") > F.col("low"))
    step = _ceil_div("(high - low + 1)", f"((rows + {max_rows} - 1) div {max_rows})")
    return F.when(wanted, step).otherwise(F.lit(0))


def entity_chunks(erp: Erp, entity: str, max_rows: int = MAX_CHUNK_ROWS) -> DataFrame:
    """The chunk plan of an entity; entities that are not chunkable are one chunk."""
    if entity not in CHUNKABLE:
        spark = erp[next(iter(erp.tables))].sparkSession
        return spark.range(1).selectExpr("0L AS sequence", "0L AS key_from", "0L AS key_to")
    return chunk_plan(id_span(erp[primary_relation(entity)]), max_rows)


def key_range(df: DataFrame, key: str, key_from: int = 0, key_to: int = 0) -> DataFrame:
    """Rows with ``key_from <= key < key_to``, in key order. A bound that is not positive is open."""
    if key_from > 0:
        df = df.filter(F.col(key) >= key_from)
    if key_to > 0:
        df = df.filter(F.col(key) < key_to)
    return df.orderBy(key) if key_from > 0 or key_to > 0 else df


@dataclass(frozen=True)
class Cut:
    """How an entity is cut: first key and keys per chunk; a step of 0 leaves it whole. ``rows`` of the relation it is cut on,
    0 if they were not counted."""

    low: int
    step: int
    rows: int = 0

    def chunk_of(self, key: str) -> Column:
        """First key of the chunk that a row belongs to."""
        if self.step == 0:
            return F.lit(0).cast("bigint")
        steps = F.expr(f"({key} - {self.low}L) div {self.step}L")
        return (F.lit(self.low) + steps * F.lit(self.step)).cast("bigint")


def entity_cut(erp: Erp, entity: str, max_rows: int = MAX_CHUNK_ROWS) -> Cut:
    """The cut of an entity. Three numbers come to the driver."""
    if entity not in CHUNKABLE:
        return Cut(0, 0)
    row = id_span(erp[primary_relation(entity)]).select("low", "rows", _cut_step(max_rows).alias("step")).first()
    return Cut(row.low, row.step, row.rows)


def in_chunks(df: DataFrame, entity: str, cut: Cut) -> DataFrame:
    """The entity's rows with ``key_from``, the chunk they go to."""
    return df.withColumn("key_from", cut.chunk_of(key_column(entity)))
