"""Sales exports: orders, order lines, price lists."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.functions.columns import attach, conform, fill
from quayside.operators.names import product_names, translated, uom_names
from quayside.operators.registry import exports
from quayside.sources.catalog import Erp


@exports("sale_order")
def sale_order(erp: Erp) -> DataFrame:
    orders = fill(erp["sale_order"], amount_untaxed=0.0, amount_total=0.0)
    rows = attach(orders, erp["stock_warehouse"], "warehouse_id", warehouse_code="code")
    return conform(rows, "sale_order", _odoo_so_id="id")


@exports("sale_order_line")
def sale_order_line(erp: Erp) -> DataFrame:
    """Product lines of sales orders.

    Partner and warehouse join the orders, the smaller side, before the lines do: the lines then
    shuffle for the product key and the order key only. The orders bring the most columns and join last: none of
    those shuffle for the product, and lines of one order come out side by side, which a later shuffle packs well.
    """
    lines = fill(
        erp["sale_order_line"].filter(F.col("product_id").isNotNull()),
        qty_invoiced=0.0,
        price_unit=0.0,
        discount=0.0,
        price_subtotal=0.0,
        customer_lead=0.0,
    ).withColumnRenamed("state", "sol_state")
    lines = lines.withColumn("uom_id", F.col("product_uom" if erp.variant == "18" else "product_uom_id"))

    orders = attach(
        erp["sale_order"], erp["res_partner"], "partner_id", partner_name="name", is_company="is_company"
    )
    orders = attach(orders, erp["stock_warehouse"], "warehouse_id", warehouse_code="code")
    same = ("partner_id", "partner_name", "is_company", "commitment_date", "date_order", "warehouse_id",
            "warehouse_code", "picking_policy")
    rows = attach(lines, product_names(erp), "product_id", "inner", product_name="product_name")
    rows = attach(rows, uom_names(erp), "uom_id", uom_name="uom_name")
    rows = attach(rows, orders, "order_id", "inner", so_name="name", so_state="state", **{c: c for c in same})
    return conform(rows, "sale_order_line", _odoo_sol_id="id", _odoo_so_id="order_id")


@exports("pricelist")
def pricelist(erp: Erp) -> DataFrame:
    return conform(
        erp["product_pricelist"], "pricelist", _odoo_pricelist_id="id", name=translated(erp, "name")
    )


@exports("pricelist_item")
def pricelist_item(erp: Erp) -> DataFrame:
    amounts = ("fixed_price", "percent_price", "price_discount", "price_surcharge", "price_round",
               "price_min_margin", "price_max_margin", "min_quantity")
    items = fill(erp["product_pricelist_item"], **dict.fromkeys(amounts, 0.0))
    return conform(items, "pricelist_item", _odoo_pricelist_item_id="id")
