import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quayside.functions import lookup
from quayside.functions.lookup import best_tier, last_by, lowest_id
from quayside.functions.numbering import number_rows, of_group


def brute_force(asks, tiers):
    out = {}
    for ask_id, key, qty in asks:
        fits = [t for t in tiers if key is not None and t[1] == key and qty is not None and t[2] is not None and t[2] <= qty]
        out[ask_id] = min(fits, key=lambda t: (-t[2], t[0]))[0] if fits else None
    return out


def spark_tiers(spark, asks, tiers):
    left = spark.createDataFrame(asks, "ask_id long, k long, qty double")
    right = spark.createDataFrame(tiers, "id long, k long, min_qty double").withColumn("tier_id", F.col("id"))
    return {r.ask_id: r.tier_id for r in best_tier(left, right, ("k",), "qty", "min_qty", ("tier_id",)).collect()}


def test_best_tier_against_brute_force(spark):
    rng = random.Random(4)
    amounts = [-3.0, -0.5, 0.0, 1e-9, 0.5, 1.0, 2.0, 2.5, 10.0, 11.0, 1e6, 1e300, None]
    # Key 1 is hot: it holds over a third of the asks and of the tiers.
    keys = [1, 1, 1, 2, 3, 4, None]
    asks = [(i, rng.choice(keys), rng.choice(amounts) if i % 2 else rng.uniform(-5, 300)) for i in range(900)]
    tiers = [(i, rng.choice(keys[:-1]), rng.choice(amounts) if i % 2 else rng.uniform(-5, 300)) for i in range(300)]
    assert spark_tiers(spark, asks, tiers) == brute_force(asks, tiers)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    asks=st.lists(st.floats(-1e9, 1e9, width=32), min_size=1, max_size=12),
    tiers=st.lists(st.floats(-1e9, 1e9, width=32), max_size=12),
)
def test_best_tier_any_amounts(spark, asks, tiers):
    a = [(i, 1, x) for i, x in enumerate(asks)]
    t = [(i, 1, x) for i, x in enumerate(tiers)] or [(0, 2, 1.0)]
    assert spark_tiers(spark, a, t) == brute_force(a, t)


def test_one_key_fills_all_tasks(spark):
    """A pair with most of the amounts is spread over the partitions, and the plan has few exchanges."""
    asks = spark.range(200_000).select(F.col("id").alias("ask_id"), F.lit(1).alias("k"), (F.col("id") % 99_991).cast("double").alias("qty"))
    tiers = spark.range(50).select("id", F.lit(1).alias("k"), (F.col("id") * 2000).cast("double").alias("min_qty"))
    found = best_tier(asks, tiers.withColumn("tier_id", F.col("id")), ("k",), "qty", "min_qty", ("tier_id",))
    assert found.filter("NOT tier_id <=> CAST(floor(qty / 2000) AS BIGINT)").isEmpty() and found.count() == 200_000
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") <= 4 and "Python" not in plan
    (path,) = {f.rsplit("/", 1)[0] for f in found.inputFiles()}
    parts = spark.read.parquet(path).groupBy(F.shiftright("_no", 33)).count().collect()
    assert len(parts) >= 4 and max(r["count"] for r in parts) < 100_000


def test_lookup_keeps_rows_and_types(spark):
    """Equal rows, text keys beside number keys, a taken column of another type, and asks that can have no tier."""
    asks = spark.createDataFrame([("a", 1, 5.0), ("a", 1, 5.0), ("b", 1, 5.0), (None, 1, 5.0), ("a", 1, None)], "k string, m int, qty double")
    tiers = spark.createDataFrame([(7, "a", 1, 5.0, "x"), (3, "a", 1, 5.0, "y"), (1, "a", 1, 9.0, "z"), (2, "b", 1, None, "n")], "id int, k string, m long, floor double, name string")
    rows = sorted(map(str, best_tier(asks, tiers, ("k", "m"), "qty", "floor", ("name",)).collect()))
    assert rows == sorted([
        "Row(k='a', m=1, qty=5.0, name='y')", "Row(k='a', m=1, qty=5.0, name='y')", "Row(k='b', m=1, qty=5.0, name=None)",
        "Row(k=None, m=1, qty=5.0, name=None)", "Row(k='a', m=1, qty=None, name=None)",
    ])
    assert best_tier(asks.limit(0), tiers, ("k", "m"), "qty", "floor", ("name",)).count() == 0


def test_lowest_id_and_last_value(spark):
    df = spark.createDataFrame([(3, "a"), (2, "a"), (1, None), (9, "b")], "id long, code string")
    assert {r.code: r.first for r in lowest_id(df, "code", name="first").collect()} == {"a": 2, "b": 9}
    changes = spark.createDataFrame([(1, 5.0), (2, 6.0), (3, None)], "n long, v double")
    row = changes.agg(last_by("v", "n").alias("any"), last_by("v", "n", F.col("v").isNotNull()).alias("given")).first()
    assert (row["any"], row.given) == (None, 6.0)


@pytest.mark.parametrize("partitions", [1, 7])
def test_rows_are_numbered_per_group(spark, partitions):
    rng = random.Random(6)
    rows = [(i, rng.choice(["a", "a", "a", "b", "c", None]), rng.randint(0, 50)) for i in range(2000)]
    df = spark.createDataFrame(rows, "id long, kind string, at long").repartition(partitions)
    want = {}
    for kind in "abc":
        group = sorted((r for r in rows if r[1] == kind), key=lambda r: (r[2], r[0]))
        want |= {r[0]: n for n, r in enumerate(group)}
    assert {r.id: r.row_no for r in number_rows(df, "kind", ("at", "id")).collect()} == want


def test_groups_have_folders(spark):
    """A wanted group is read from its folder alone; any number of other groups share one."""
    rows = [(i, f"junk{i}" if i % 2 else "ab"[i % 4 // 2], i) for i in range(400)]
    numbered = number_rows(spark.createDataFrame(rows, "id long, kind string, at long"), "kind", ("at",), folders=("a", "b"))
    assert len({f.rsplit("/", 2)[1] for f in numbered.inputFiles() if "kind_folder" in f}) == 3
    only = of_group(numbered, "kind", "a")
    plan = only._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(kind_folder" in plan and "(kind_folder" in plan
    assert sorted((r.row_no, r.id) for r in only.collect()) == [(n, 4 * n) for n in range(100)]
    assert of_group(numbered, "kind", "junk1").count() == 0  # not a wanted group: it has no folder of its own


def test_tiers_that_nobody_asks_for_stay_out_of_the_line(spark, monkeypatch):
    """Tiers outnumber asks by far; only those of a key that is asked for are sorted and written."""
    held, settled = [], lookup.settled
    monkeypatch.setattr(lookup, "settled", lambda df, name: held.append(settled(df, name)) or held[-1])
    asks = spark.createDataFrame([(1, 5.0, 10), (1, 0.5, 11), (9, 5.0, 12)], "k long, q double, id long")
    tiers = spark.range(1000).selectExpr("id % 100 AS k", "1.0 + id div 100 AS floor", "id", "id AS price")
    got = {r.id: r.price for r in best_tier(asks, tiers, ("k",), "q", "floor", ("price",)).collect()}
    assert got == {10: 401, 11: None, 12: 409}
    assert held[0].filter("_tier IS NOT NULL").count() == 20
