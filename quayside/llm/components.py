"""Connected components as joins: alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.functions.durable import settled


def _state(edges: DataFrame) -> tuple:
    """Count and order-free checksum of a set of edges."""
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("low", "high").cast("decimal(38,0)"))).first())


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, label) for every node of an edge: ``label`` is the smallest node of its component.

    Each step links the neighbours of a node to the smallest of them; after logarithmically many steps
    the edges are stars. Each step's edges, at most as many as nodes and edges before, are written to the
    shared folder, so a lost executor costs one step. Minima are aggregated before the shuffle, so a star's
    centre is no hot key there; adaptive execution splits it in the joins. No edges give no rows.
    """
    edges = edges.select(F.least(a, b).alias("low"), F.greatest(a, b).alias("high")).where("low < high").distinct()
    edges = settled(edges, "edges")
    before = _state(edges)
    while before[0]:
        both = edges.select(F.col("low").alias("x"), F.col("high").alias("y")).unionByName(
            edges.select(F.col("high").alias("x"), F.col("low").alias("y"))
        )
        least = both.groupBy("x").agg(F.least(F.min("y"), F.col("x")).alias("m"))
        large = both.where("y > x").join(least, "x").select(F.col("m").alias("low"), F.col("y").alias("high")).distinct()
        least = large.groupBy("high").agg(F.min("low").alias("m"))
        small = large.join(least, "high")
        edges = settled(
            small.select(F.explode(F.array(F.struct(F.col("m").alias("low"), F.col("high").alias("high")),
                                           F.struct(F.col("m").alias("low"), F.col("low").alias("high")))).alias("e"))
            .select("e.low", "e.high").where("low < high").distinct(),
            "edges",
        )
        after = _state(edges)
        if after == before:
            break
        before = after
    centres = edges.select(F.col("low").alias("node"), F.col("low").alias("label")).distinct()
    return edges.select(F.col("high").alias("node"), F.col("low").alias("label")).unionByName(centres)
