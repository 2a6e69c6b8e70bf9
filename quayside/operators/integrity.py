"""Key integrity between exported entities."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.functions.columns import ids_only
from quayside.operators.registry import export
from quayside.schemas import key_column
from quayside.sources.catalog import Erp

# Child entity, its key column, parent entity; one per declared dependency.
LINKS = (
    ("product", "_odoo_uom_id", "uom"),
    ("calendar_leaves", "_odoo_calendar_id", "calendar"),
    ("stock_warehouse", "_odoo_lot_stock_id", "stock_location"),
    ("stock_package", "_odoo_package_type_id", "stock_package_type"),
    ("stock_picking_type", "_odoo_default_location_src_id", "stock_location"),
    ("stock_picking", "_odoo_location_id", "stock_location"),
    ("stock_picking", "_odoo_partner_id", "partner"),
    ("stock_route", "_odoo_location_src_id", "stock_location"),
    ("stock_lot", "_odoo_product_id", "product"),
    ("stock_putaway_rule", "_odoo_location_in_id", "stock_location"),
    ("stock_putaway_rule", "_odoo_product_id", "product"),
    ("orderpoint", "_odoo_product_id", "product"),
    ("orderpoint", "_odoo_location_id", "stock_location"),
    ("sale_order", "_odoo_partner_id", "partner"),
    ("sale_order_line", "_odoo_product_id", "product"),
    ("sale_order_line", "_odoo_partner_id", "partner"),
    ("pricelist_item", "_odoo_pricelist_id", "pricelist"),
    ("pricelist_item", "_odoo_product_id", "product"),
    ("purchase_order", "_odoo_partner_id", "partner"),
    ("purchase_order_line", "_odoo_product_id", "product"),
    ("purchase_order_line", "_odoo_partner_id", "partner"),
    ("product_supplierinfo", "_odoo_product_id", "product"),
    ("purchase_requisition", "_odoo_vendor_id", "partner"),
    ("pos_order", "_odoo_partner_id", "partner"),
    ("pos_order_line", "_odoo_pos_order_id", "pos_order"),
    ("pos_order_line", "_odoo_product_id", "product"),
    ("workcenter_capacity", "_odoo_workcenter_id", "workcenter"),
    ("workcenter_capacity", "_odoo_product_id", "product"),
    ("bom", "_odoo_product_id", "product"),
    ("bom_lines", "_odoo_bom_id", "bom"),
    ("bom_operations", "_odoo_bom_id", "bom"),
    ("bom_operations", "_odoo_workcenter_id", "workcenter"),
    ("bom_byproduct", "_odoo_bom_id", "bom"),
    ("bom_byproduct", "_odoo_product_id", "product"),
    ("mrp_production", "_odoo_product_id", "product"),
    ("mrp_workorder", "_odoo_mo_id", "mrp_production"),
    ("mrp_workorder", "_odoo_workcenter_id", "workcenter"),
    ("mps_forecast", "_odoo_schedule_id", "mps_schedule"),
    ("quality_check", "_odoo_point_id", "quality_point"),
)


def orphans(child: DataFrame, column: str, parent: DataFrame, key: str) -> DataFrame:
    """Key values of ``child`` that ``parent`` lacks, with the rows that hold them.

    Rows are counted per key before the join, so a hot key is one row when it is shuffled.
    """
    held = child.groupBy(F.col(column).alias(key)).agg(F.count("*").alias("rows")).dropna(subset=[key])
    return held.join(parent.select(key), key, "left_anti").withColumnRenamed(key, "missing_id")


def integrity_report(erp: Erp, links=LINKS) -> DataFrame:
    """Per dependency: how many rows of the child point to no parent, and by how many keys.

    Each entity is exported once, for its ids alone: no names are looked up. A row hands out one (parent, id) pair for each of its keys, and one
    for itself if it is a parent. Pairs are counted before they meet, in one grouping on (parent, id).
    """
    parts = []
    parents = {parent for _, _, parent in links}
    for entity in dict.fromkeys(x for child, _, parent in links for x in (child, parent)):
        pairs = [(F.lit(column), F.lit(parent), F.col(column)) for child, column, parent in links if child == entity]
        if entity in parents:
            pairs.append((F.lit(None).cast("string"), F.lit(entity), F.col(key_column(entity))))
        pairs = [F.struct(c.alias("key_column"), p.alias("parent"), i.alias("id")) for c, p, i in pairs]
        with ids_only():
            rows = export(entity, erp)
        rows = rows.select(F.explode(F.array(*pairs)).alias("held")).filter("held.id IS NOT NULL")
        parts.append(rows.groupBy(F.lit(entity).alias("child"), "held").agg(F.count("*").alias("rows")))

    counted = reduce(DataFrame.unionByName, parts).select("child", "held.*", "rows")
    held = F.struct("child", "key_column", "rows")
    met = counted.groupBy("parent", "id").agg(
        F.collect_list(F.when(F.col("key_column").isNotNull(), held)).alias("held"),  # one for each dependency at most
        F.bool_or(F.col("key_column").isNull()).alias("known"),
    )
    lost = met.filter(~F.col("known")).select("parent", F.explode("held").alias("held")).select("parent", "held.*")
    every = erp["uom_uom"].sparkSession.createDataFrame(list(links), "child string, key_column string, parent string")
    sums = lost.groupBy("child", "key_column", "parent").agg(
        F.count("*").alias("missing_keys"), F.sum("rows").alias("orphan_rows")
    )
    return every.join(sums, ["child", "key_column", "parent"], "left").fillna(0, ["missing_keys", "orphan_rows"])
