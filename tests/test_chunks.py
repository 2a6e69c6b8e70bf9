from collections import Counter

import pytest

from checks.exports import erp
from quayside.operators import export
from quayside.operators.chunks import chunk_plan, entity_chunks, entity_cut, id_span, in_chunks, key_range
from quayside.schemas import key_column


def plan(spark, rows, low, high, max_rows=50_000):
    span = spark.createDataFrame([(rows, low, high)], "rows long, low long, high long")
    return [tuple(r) for r in chunk_plan(span, max_rows).orderBy("sequence").collect()]


def by_hand(rows, low, high, max_rows):
    if rows <= max_rows or high <= low:
        return [(0, 0, 0)]
    chunks = -(-rows // max_rows)
    step = -(-(high - low + 1) // chunks)
    starts = range(low, high + 1, step)
    return [(n, s, min(s + step, high + 1)) for n, s in enumerate(starts)]


@pytest.mark.parametrize(
    "rows, low, high",
    [(0, 0, 0), (50_000, 1, 50_000), (50_001, 1, 50_001), (120_000, 7, 900_000), (60_000, 5, 5), (99_999, 1, 3), (10**9, 1, 10**9)],
)
def test_plan(spark, rows, low, high):
    assert plan(spark, rows, low, high) == by_hand(rows, low, high, 50_000)


def test_long_plan_is_gapless(spark):
    got = plan(spark, 50_000, 1, 60_000, 5)
    assert got == by_hand(50_000, 1, 60_000, 5) and len(got) == 10_000


def test_span(spark):
    assert tuple(id_span(spark.range(0).selectExpr("id")).first()) == (0, 0, 0)
    assert tuple(id_span(spark.range(3, 9).selectExpr("id")).first()) == (6, 3, 8)


@pytest.mark.parametrize("entity", ["stock_quant", "sale_order_line", "quality_check", "mps_schedule"])
def test_chunks_add_up_to_the_whole(spark, sf_dir, entity):
    source = erp(spark, sf_dir)
    whole = export(entity, source).cache()
    size = whole.count() // 6
    chunks = entity_chunks(source, entity, size).orderBy("sequence").collect()
    assert len(chunks) > 3
    parts = Counter()
    for chunk in chunks:
        part = key_range(whole, key_column(entity), chunk.key_from, chunk.key_to).collect()
        assert [r[0] for r in part] == sorted(r[0] for r in part)
        parts += Counter(part)
    assert parts == Counter(whole.collect())
    starts = {r.key_from for r in in_chunks(whole, entity, entity_cut(source, entity, size)).select("key_from").collect()}
    assert starts <= {c.key_from for c in chunks}
    whole.unpersist()


def test_open_bounds(spark):
    df = spark.range(1, 11)
    ids = lambda *bounds: [r.id for r in key_range(df, "id", *bounds).collect()]
    assert ids(0, 4) == [1, 2, 3] and ids(8, 0) == [8, 9, 10] and ids(-5, -1) == list(range(1, 11)) and ids(3, 5) == [3, 4]


def test_entities_without_a_primary_relation_are_one_chunk(spark, sf_dir):
    source = erp(spark, sf_dir)
    assert [tuple(r) for r in entity_chunks(source, "pos_order_line", 1).collect()] == [(0, 0, 0)]
    assert entity_cut(source, "pos_order_line", 1).step == 0
