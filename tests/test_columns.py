import pytest
from pyspark.sql import functions as F

from quayside.functions.columns import attach, conform, fill, first_column, json_text, language_key, optional
from quayside.functions.lists import SLICE_WIDTH, attach_lists, id_lists


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_language_key_guard():
    assert language_key("en_US") == "en_US"
    for bad in (None, "", "en", "en_us", "EN_US", "en_US'", "en_US->>x", "eng_US"):
        assert language_key(bad) is None


def test_json_text(spark):
    df = spark.createDataFrame(
        [('{"en_US": "a b", "fr_FR": null}',), ('{"fr_FR": "c"}',), (None,), ('{"1": 12.50}',)], "j string"
    )
    assert [r[0] for r in df.select(json_text("j", "en_US")).collect()] == ["a b", None, None, None]
    assert [r[0] for r in df.select(json_text("j", "fr_FR")).collect()] == [None, "c", None, None]
    assert [r[0] for r in df.select(json_text("j", None)).collect()] == [None] * 4
    assert df.select(json_text("j", "1").cast("double")).collect()[3][0] == 12.5
    with pytest.raises(ValueError):
        json_text("j", "x' OR 1")


def test_fill_and_optional(spark):
    df = spark.createDataFrame([(1, None, None), (2, 3.0, "x")], "id long, a double, b string")
    got = optional(fill(df, a=0.0), b=None, c=False, d=None)
    assert rows(got) == [(1, 0.0, None, False, None), (2, 3.0, "x", False, None)]
    with pytest.raises(Exception):
        fill(df, missing=0)
    assert got.select(first_column(df, "zz", "a")).collect()[1][0] == 3.0
    assert df.select(first_column(df, "zz")).collect()[0][0] is None


def test_attach_keeps_or_drops_rows(spark):
    facts = spark.createDataFrame([(i, i % 3 or None) for i in range(1, 10)], "id long, dim_id long")
    dim = spark.createDataFrame([(1, "one")], "id long, name string")
    assert attach(facts, dim, "dim_id", "inner", label="name").count() == 3
    plain = attach(facts, dim, "dim_id", label="name").select("id", "dim_id", "label")
    assert rows(plain) == rows(facts.selectExpr("id", "dim_id", "IF(dim_id = 1, 'one', NULL)"))
    assert plain.filter("dim_id IS NULL").count() == 3 and plain.filter("label = 'one'").count() == 3


def test_null_keys_are_spread_over_shuffle_partitions(spark):
    facts = spark.range(1, 4001).select("id", F.lit(None).cast("long").alias("dim_id"))
    dim = spark.createDataFrame([(1, "one")], "id long, name string").hint("shuffle_merge")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = attach(facts, dim, "dim_id", label="name")
        sizes = joined.groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(sizes) == 4 and max(s["count"] for s in sizes) < 2000


def test_conform_refuses_unknown_columns(spark):
    df = spark.createDataFrame([(1, "n", "c")], "id long, name string, code string")
    assert conform(df, "country", _odoo_country_id="id").columns == ["_odoo_country_id", "name", "code"]
    with pytest.raises(KeyError):
        conform(df, "country")
    with pytest.raises(KeyError):
        conform(df, "country", _odoo_country_id="id", nonsense="id")


def test_lists_sort_by_number_skip_nulls_keep_repeats(spark):
    links = spark.createDataFrame(
        [(1, 10, "x"), (1, 9, None), (1, 100, "z"), (1, 9, None), (2, 5, None), (None, 4, "q")],
        "k long, v long, name string",
    )
    got = {r.k: (r.ids, r.names) for r in id_lists(links, "k", "v", ids="v", names="name").collect()}
    assert got == {1: ("9,9,10,100", "x,z"), 2: ("5", None)}
    base = spark.createDataFrame([(1,), (2,), (3,)], "id long")
    full = {r.id: (r.ids, r.names) for r in attach_lists(base, "id", links, "k", "v", ids="v", names="name").collect()}
    assert full == {1: ("9,9,10,100", "x,z"), 2: ("5", ""), 3: ("", "")}


def test_list_of_a_hot_key_spans_slices_in_order(spark):
    step = SLICE_WIDTH // 4
    ids = [i * step + 7 for i in range(40)]
    links = spark.createDataFrame([(1, i) for i in reversed(ids)] + [(2, ids[3])], "k long, v long")
    got = {r.k: r.ids for r in id_lists(links, "k", "v", ids="v").collect()}
    assert got == {1: ",".join(map(str, ids)), 2: str(ids[3])}


def test_empty_texts_count_and_missing_slices_do_not(spark):
    links = spark.createDataFrame(
        [(1, 1, ""), (1, 2, "b"), (1, SLICE_WIDTH + 1, None), (1, 2 * SLICE_WIDTH + 1, "d")],
        "k long, v long, name string",
    )
    assert id_lists(links, "k", "v", names="name").first().names == ",b,d"
