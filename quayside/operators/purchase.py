"""Purchasing exports: orders, order lines, vendor prices, agreements."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.functions.columns import attach, conform, fill, optional
from quayside.operators.names import product_names, uom_names
from quayside.operators.registry import exports
from quayside.sources.catalog import Erp


def _with_warehouse(erp: Erp) -> DataFrame:
    return attach(erp["purchase_order"], erp["stock_picking_type"], "picking_type_id", warehouse_id="warehouse_id")


@exports("purchase_order")
def purchase_order(erp: Erp) -> DataFrame:
    rows = fill(_with_warehouse(erp), amount_untaxed=0.0, amount_total=0.0)
    return conform(rows, "purchase_order", _odoo_po_id="id")


@exports("purchase_order_line")
def purchase_order_line(erp: Erp) -> DataFrame:
    """Product lines of purchase orders; vendor and warehouse join the orders first."""
    lines = erp["purchase_order_line"].filter(F.col("product_id").isNotNull())
    lines = lines.withColumn("uom_id", F.col("product_uom" if erp.variant == "18" else "product_uom_id"))
    orders = attach(_with_warehouse(erp), erp["res_partner"], "partner_id", partner_name="name")
    same = ("receipt_status", "currency_id", "date_order", "partner_id", "partner_name", "warehouse_id", "origin",
            "company_id")
    rows = attach(lines, orders, "order_id", "inner", po_name="name", po_state="state", **{c: c for c in same})
    rows = attach(rows, product_names(erp), "product_id", "inner", product_name="product_name")
    rows = attach(rows, uom_names(erp), "uom_id", uom_name="uom_name")
    return conform(rows, "purchase_order_line", _odoo_pol_id="id", _odoo_po_id="order_id")


@exports("product_supplierinfo")
def product_supplierinfo(erp: Erp) -> DataFrame:
    """Vendor price tiers of known vendors."""
    tiers = optional(erp["product_supplierinfo"], batching_window=0, is_subcontractor=False)
    rows = attach(tiers, erp["res_partner"], "partner_id", "inner", partner_name="name")
    rows = attach(rows, erp["res_currency"], "currency_id", currency_name="name")
    return conform(rows, "product_supplierinfo", _odoo_supplierinfo_id="id", _odoo_template_id="product_tmpl_id")


@exports("purchase_requisition")
def purchase_requisition(erp: Erp) -> DataFrame:
    rows = attach(erp["purchase_requisition"], erp["res_partner"], "vendor_id", vendor_name="name")
    return conform(rows, "purchase_requisition", _odoo_requisition_id="id")
