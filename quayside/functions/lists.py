"""Comma-separated lists per key, in ascending order of an id."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.functions.columns import skipped
from quayside.functions.durable import step

# Ids that share a slice are joined to text together; slices are then joined in order.
SLICE_WIDTH = 65536


def _glued(items: Column) -> Column:
    """Texts joined by ``,``; NULL if there is none."""
    texts = F.filter(items, lambda x: x.isNotNull())
    return F.when(F.size(texts) > 0, F.array_join(texts, ","))


def id_lists(links: DataFrame, key: str, order: str, **lists: str) -> DataFrame:
    """One row per ``key`` with each ``lists`` column joined by ``,`` in ``order``.

    NULL items are skipped and repeats are kept. The sort runs per (key, slice of ids), so one
    hot key is spread over many tasks; the last step only glues the sorted pieces together.
    """
    # plain columns travel, each of them once; they become texts where they are sorted
    own = {c: f"_c{i}" for i, c in enumerate(dict.fromkeys([order, *lists.values()]))}
    sliced = links.filter(F.col(key).isNotNull()).select(
        key, F.floor(F.col(order) / F.lit(SLICE_WIDTH)).alias("slice"), *[F.col(c).alias(n) for c, n in own.items()]
    )
    item = F.struct(F.col(own[order]).alias("at"), *[F.col(own[source]).cast("string").alias(n) for n, source in lists.items()])
    pieces = sliced.repartition(key, "slice").groupBy(key, "slice").agg(F.sort_array(F.collect_list(item)).alias("items"))
    pieces = pieces.select(key, "slice", *[_glued(F.col(f"items.{n}")).alias(n) for n in lists])
    piece = F.struct(F.col("slice").alias("at"), *lists)
    whole = pieces.repartition(key).groupBy(key).agg(F.sort_array(F.collect_list(piece)).alias("items"))
    return whole.select(key, *[_glued(F.col(f"items.{n}")).alias(n) for n in lists])


def attach_lists(rows: DataFrame, key: str, links: DataFrame, link_key: str, order: str, **lists: str) -> DataFrame:
    """Left-join :func:`id_lists` to ``rows.key``; rows without links get the empty list ``''``."""
    if skipped(()):
        return rows.withColumns({name: F.lit("") for name in lists})
    made = step(id_lists(links, link_key, order, **lists), "lists").withColumnRenamed(link_key, key)
    joined = rows.drop(*lists).join(made, key, "left")
    return joined.withColumns({name: F.coalesce(F.col(name), F.lit("")) for name in lists})
