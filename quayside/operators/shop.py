"""Point-of-sale exports: sessions, orders, order lines."""

from __future__ import annotations

from pyspark.sql import DataFrame

from quayside.functions.columns import conform, fill, optional
from quayside.operators.registry import exports
from quayside.sources.catalog import Erp


@exports("pos_session")
def pos_session(erp: Erp) -> DataFrame:
    return conform(erp["pos_session"], "pos_session", _odoo_session_id="id")


@exports("pos_order")
def pos_order(erp: Erp) -> DataFrame:
    """Shop orders. Version 18 may not mark refunds: then none is one."""
    orders = erp["pos_order"]
    if erp.variant == "18":
        orders = optional(orders, is_refund=False)
    return conform(orders, "pos_order", _odoo_pos_order_id="id")


@exports("pos_order_line")
def pos_order_line(erp: Erp) -> DataFrame:
    lines = fill(erp["pos_order_line"], price_unit=0.0, price_subtotal=0.0, price_subtotal_incl=0.0, discount=0.0)
    return conform(lines, "pos_order_line", _odoo_pos_line_id="id", _odoo_pos_order_id="order_id")
