"""Rows and columns that joins and filters once lost: keys of 0 and below, missing states, same-named columns."""

import pytest
from pyspark.sql import functions as F

from checks.exports import erp
from quayside.functions.columns import attach
from quayside.functions.durable import shared_folder
from quayside.operators import export, runlog
from quayside.operators.integrity import LINKS, integrity_report
from quayside.sources.catalog import Erp


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("how", ["left", "inner"])
def test_keys_of_zero_and_below_find_their_rows(spark, how):
    lines = spark.createDataFrame([(1, 0), (2, -3), (3, None), (4, 7)], "id long, who long")
    people = spark.createDataFrame([(0, "zero"), (-3, "below"), (None, "nobody"), (8, "x")], "id long, name string")
    got = attach(lines, people, "who", how, who_name="name").select("id", "who", "who_name")
    found = [(1, 0, "zero"), (2, -3, "below")]
    assert rows(got) == sorted(found + ([(3, None, None), (4, 7, None)] if how == "left" else []), key=str)


def test_missing_keys_do_not_meet_in_one_task(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        lines = spark.range(1000).withColumn("who", F.when(F.col("id") % 7 == 0, F.col("id") % 5))
        people = spark.range(5).withColumn("name", F.col("id").cast("string"))
        plan = attach(lines, people, "who", name="name")
        assert "hashpartitioning(_join" in (text := plan._jdf.queryExecution().executedPlan().toString())
        assert "_salt" in text.split("hashpartitioning(")[1].split(")")[0]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_runs_and_chunks_without_a_state_stay(spark):
    runs = spark.createDataFrame([(1, "done"), (2, None), (3, "done"), (4, "pending")], "id long, state string")
    assert [r.id for r in runlog.keep_newest(runs, 1).orderBy("id").collect()] == [2, 3, 4]
    chunks = spark.createDataFrame([(4, 1, None), (4, 2, "pending"), (4, 3, "done"), (1, 4, "pending")], "run_id long, sequence long, state string")
    _, left = runlog.cancel_runs(runs, chunks)
    assert [r.sequence for r in left.orderBy("sequence").collect()] == [1, 3, 4]


class Context:
    master = "spark://host:7077"

    def getConf(self):
        return {}

    def getCheckpointDir(self):
        return None


class Session:
    sparkContext, conf = Context(), {}


def test_a_cluster_needs_a_shared_folder():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(Session())


#: Entity, and the relations whose columns may all be in one another.
WIDE = {
    "product": ("product_product", "product_template", "uom_uom", "product_category"),
    "currency": ("res_currency", "res_currency_rate"),
    "stock_quant": ("stock_quant", "stock_location", "stock_warehouse", "product_product", "product_template"),
    "sale_order_line": ("sale_order_line", "sale_order", "stock_warehouse", "res_partner"),
    "purchase_order_line": ("purchase_order_line", "purchase_order", "stock_picking_type", "res_partner"),
    "stock_move": ("stock_move", "stock_picking", "product_product"),
    "partner": ("res_partner",),
}


@pytest.mark.parametrize("entity", WIDE)
def test_columns_named_alike_on_joined_tables(spark, sf_dir, entity):
    """Every table gets, as NULLs, the columns that the entity reads from the tables it joins."""
    source = erp(spark, sf_dir)
    types = {f.name: f.dataType for name in WIDE[entity] for f in source[name].schema}
    extra = set(types) | {"rate", "warehouse_id", "partner_name", "product_name", "uom_name", "category_name", "route_ids", "move_orig_ids"}
    optional = {"is_storable", "expiration_time", "sale_delay", "purchase_method", "use_expiration_date"}
    wide = {
        name: source[name].withColumns(
            {c: F.lit(None).cast(types.get(c, "string")) for c in extra - optional if c not in source[name].columns}
        )
        for name in WIDE[entity]
    }
    widened = export(entity, Erp(source.tables.replacing(**wide), "19", source.languages))
    assert widened.exceptAll(export(entity, source)).count() == 0


def test_integrity_scans_each_entity_once(spark, sf_dir):
    links = [k for k in LINKS if k[0] in ("pricelist_item", "pos_order")]
    report = integrity_report(erp(spark, sf_dir), links)
    plan = report._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftAnti" not in plan and report.count() == len(links)
