"""Mixing sources to target weights, where a document may belong to several sources.

Method: min-cost flow. Documents are aggregated by membership pattern (the set of their sources). Words
flow from patterns to their sources' quotas; the n-th repetition of a pattern costs n, so repetition is
spread before it is deepened. Each pattern's flow is then filled with whole documents in a seeded order:
all of them as often as the flow allows, and once more those first in order.

Only pattern totals (at most ``MAX_PATTERNS``) reach the driver. The place where a pattern's last round
ends is found with two histograms of the seeded order (4096 x 4096 cells) and a running sum inside one
cell, so no source is ever sorted or summed as a whole.
"""

from __future__ import annotations

import heapq
import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quayside.functions.durable import settled

WEIGHTS, SHARE, MOST, SEED = (5, 2, 1), 1.5, 2, 20
MAX_PATTERNS = 20_000
WORD = r"[^\x20\x09-\x0D]+"


def targets(sizes: dict, weights: dict, total: float, most: float) -> dict:
    """Share ``total`` by weight; a target stops at ``most`` times its size and the excess is shared again."""
    out, open_, left = {}, list(sizes), float(total)
    while open_:
        whole = sum(weights[s] for s in open_)
        share = {s: left * weights[s] / whole for s in open_}
        above = [s for s in open_ if share[s] > most * sizes[s]]
        if not above:
            return out | share
        for s in above:
            out[s] = float(most * sizes[s])
            left -= out[s]
        open_ = [s for s in open_ if s not in above]
    return out


def route(supply: dict[tuple, int], quotas: dict, most: int) -> dict[tuple, dict]:
    """Words that each pattern gives to each of its sources: the cheapest of the largest flows.

    A pattern gives its size once at cost 0, again at cost 1, and so on, ``most`` times in all.
    """
    patterns, sources = list(supply), list(quotas)
    place = {s: 1 + len(patterns) + i for i, s in enumerate(sources)}
    end = 1 + len(patterns) + len(sources)
    arcs: list[list[int]] = []  # to, capacity, cost; the reverse arc follows
    out: list[list[int]] = [[] for _ in range(end + 1)]

    def arc(a: int, b: int, capacity: int, cost: int) -> int:
        out[a].append(len(arcs))
        arcs.append([b, capacity, cost])
        out[b].append(len(arcs))
        arcs.append([a, 0, -cost])
        return len(arcs) - 2

    uses = {}
    for i, p in enumerate(patterns):
        for n in range(most):
            arc(0, 1 + i, supply[p], n)
        for s in p:
            uses[p, s] = arc(1 + i, place[s], most * supply[p], 0)
    for s in sources:
        arc(place[s], end, quotas[s], 0)
    height = [0] * (end + 1)
    while True:
        far, came, queue = {0: 0}, {}, [(0, 0)]
        while queue:
            d, a = heapq.heappop(queue)
            if d > far[a]:
                continue
            for k in out[a]:
                b, capacity, cost = arcs[k]
                if capacity > 0 and (e := d + cost + height[a] - height[b]) < far.get(b, 1 << 60):
                    far[b], came[b] = e, k
                    heapq.heappush(queue, (e, b))
        if end not in far:
            return {p: {s: arcs[uses[p, s] ^ 1][1] for s in p} for p in patterns}
        for a in range(end + 1):
            height[a] += min(far.get(a, far[end]), far[end])
        path, at = [], end
        while at:
            path.append(came[at])
            at = arcs[came[at] ^ 1][0]
        least = min(arcs[k][1] for k in path)
        for k in path:
            arcs[k][1] -= least
            arcs[k ^ 1][1] += least


@dataclass(frozen=True)
class Mix:
    """``plan``: pattern, full rounds and the last one's end; ``routes``: words of (pattern, source); ``sources``."""

    plan: DataFrame
    routes: DataFrame
    sources: DataFrame
    sized: DataFrame


def with_order(docs: DataFrame, key: str, text: str, members: Column, seed: int) -> DataFrame:
    """``docs`` with ``__size``, ``__pattern`` (sorted sources as JSON) and ``__order``."""
    size = F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")
    pattern = F.to_json(F.array_sort(F.array_distinct(F.coalesce(members, F.array().cast("array<string>")))))
    return docs.withColumns({"__size": size, "__pattern": pattern}).withColumn(
        "__order", F.xxhash64(F.col(key), F.xxhash64(text), F.lit(seed))
    )


def mixture(
    docs: DataFrame, key: str = "doc_id", text: str = "text", members: Column | None = None, weights=None,
    share: float = SHARE, most: int = MOST, seed: int = SEED,
) -> Mix:
    """Decide the mix of ``docs``; ``members`` is an array of source names, else the column ``source``.

    Sizes are words. ``weights`` gives a source's weight; else sources in code point order, null last, weigh
    5, 2, 1, repeating. The mix has ``share`` times all sizes; no document is taken more than ``most`` times.
    A null text has size 0 and is never taken, like a document in no source; null is a source of its own.
    Equal rows have equal order and are taken alike. The last round of a pattern ends at the document whose
    end is nearest to the pattern's flow. Sources of size 0 have target 0. No rows give empty tables.
    """
    spark = docs.sparkSession
    members = F.array("source") if members is None else members
    sized = with_order(docs.select(F.col(key).alias("key"), F.col(text).alias("text"), members.alias("members")), "key", "text", F.col("members"), seed)
    sized = settled(sized.drop("text", "members"), "sizes")
    rows = sized.groupBy("__pattern").agg(F.sum("__size")).limit(MAX_PATTERNS + 1).collect()
    if len(rows) > MAX_PATTERNS:
        raise ValueError(f"more than {MAX_PATTERNS} membership patterns")
    spelled = {tuple(json.loads(p)): p for p, _ in rows}  # as Spark spells it; another JSON writer may differ
    supply = {tuple(json.loads(p)): n for p, n in sorted(rows)}
    names = sorted({s for p in supply for s in p}, key=lambda s: (s is None, s or ""))
    sizes = {s: sum(n for p, n in supply.items() if s in p) for s in names}
    weight = {s: (weights or {}).get(s, WEIGHTS[i % len(WEIGHTS)]) for i, s in enumerate(names)}
    target = targets(sizes, weight, share * sum(supply.values()), most)
    flow = route(supply, {s: round(target[s]) for s in names}, most)

    plan = []
    for p, n in supply.items():
        f = sum(flow[p].values())
        rounds = f // n if n else 0
        plan.append((spelled[p], int(rounds), int(f - rounds * n)))
    wanted = spark.createDataFrame(plan, "__pattern string, rounds long, rest long")
    left = sized.where("__size > 0").join(F.broadcast(wanted.where("rest > 0")), "__pattern")  # at most MAX_PATTERNS rows
    cell = F.shiftright("__order", 52)
    for _ in range(2):
        left = left.withColumn("cell", cell)
        sums = left.groupBy("__pattern", "cell").agg(F.sum("__size").alias("n"), F.first("rest").alias("r"))
        before = F.sum("n").over(Window.partitionBy("__pattern").orderBy("cell")) - F.col("n")
        edge = sums.withColumn("before", before).where((F.col("before") <= F.col("r")) & (F.col("before") + F.col("n") > F.col("r")))
        edge = edge.select("__pattern", "cell", (F.col("r") - F.col("before")).alias("rest"))
        left = left.drop("rest").join(edge, ["__pattern", "cell"]).drop("cell")
        cell = F.shiftright("__order", 40)
    ties = left.groupBy("__pattern", "__order").agg(F.sum("__size").alias("n"), F.first("rest").alias("rest"))
    end = F.sum("n").over(Window.partitionBy("__pattern").orderBy("__order"))
    # the nearest end; before the first document of the cell it is the cell's begin
    near = ties.withColumn("end", end).select(
        "__pattern", F.explode(F.array(
            F.struct((F.col("rest") - F.col("end") + F.col("n")).alias("off"), (F.col("__order") - 1).alias("last")),
            F.struct((F.col("end") - F.col("rest")).alias("off"), F.col("__order").alias("last")),
        )).alias("at"),
    ).where("at.off >= 0")
    near = near.groupBy("__pattern").agg(F.min("at").alias("at")).select("__pattern", F.col("at.last").alias("last"))
    routed = [(spelled[p], s, int(n)) for p, to in flow.items() for s, n in to.items()]
    return Mix(
        settled(wanted.join(near, "__pattern", "left"), "plan"),
        spark.createDataFrame(routed, "pattern string, source string, words long"),
        spark.createDataFrame([(s, sizes[s], float(target[s])) for s in names], "source string, source_size long, target double"),
        sized,
    )


def copies(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """``rows`` (as from ``with_order``) with ``__copies``, how often each is taken."""
    again = F.coalesce(F.col("__order") <= F.col("last"), F.lit(False)) & (F.col("rest") > 0)
    times = F.when(F.col("__size") > 0, F.col("rounds") + again.cast("long")).otherwise(0)
    return rows.join(F.broadcast(plan), "__pattern").withColumn("__copies", times).drop("rounds", "rest", "last")


def op5_source_mix(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source")
    mix = mixture(docs)
    sources = mix.sources.withColumn("__pattern", F.to_json(F.array("source"))).drop("source")
    found = copies(mix.sized, mix.plan).join(F.broadcast(sources), "__pattern")  # at most MAX_PATTERNS rows
    return found.select(
        F.col("key").alias("doc_id"), F.col("__size").alias("size"), "source_size", "target",
        (F.col("__size") * F.col("__copies")).alias("taken"),
    )


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: every document as often as it is taken."""
    mix = mixture(docs)
    rows = copies(with_order(docs, "doc_id", "text", F.array("source"), SEED), mix.plan)
    repeated = rows.withColumn("__nth", F.explode(F.array_repeat(F.lit(1), F.col("__copies").cast("int"))))
    return repeated.select(docs.columns)
