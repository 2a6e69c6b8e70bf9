"""The entity exports by name. Users add their own with the same decorator."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame

from quayside.sources.catalog import Erp

EXPORTS: dict[str, Callable[[Erp], DataFrame]] = {}

# What an entity needs, modules first and then relations. An entity not named here is always tried.
_STOCK, _SALE, _PURCHASE, _POS, _MRP, _MPS, _QUALITY = (
    (m,) for m in ("stock", "sale", "purchase", "point_of_sale", "mrp", "mrp_mps", "quality")
)
REQUIRED: dict[str, tuple[tuple[str, ...], tuple[str, ...]]] = {
    "product_category": ((), ("product_category",)),
    "calendar": ((), ("resource_calendar", "resource_calendar_attendance")),
    "calendar_leaves": ((), ("resource_calendar_leaves",)),
    "country": ((), ("res_country",)),
    "stock_location": (_STOCK, ("stock_location",)),
    "stock_warehouse": (_STOCK, ("stock_warehouse",)),
    "stock_storage_category": (_STOCK, ("stock_storage_category",)),
    "stock_package_type": (_STOCK, ("stock_package_type",)),
    "stock_package": (_STOCK, ()),
    "stock_picking_type": (_STOCK, ("stock_picking_type",)),
    "stock_quant": (_STOCK, ("stock_quant",)),
    "stock_move": (_STOCK, ("stock_move",)),
    "stock_move_line": (_STOCK, ("stock_move_line",)),
    "stock_picking": (_STOCK, ("stock_picking", "stock_picking_type")),
    "stock_route": (_STOCK, ("stock_route", "stock_rule")),
    "stock_lot": (_STOCK, ("stock_lot",)),
    "stock_putaway_rule": (_STOCK, ("stock_putaway_rule",)),
    "product_removal": (_STOCK, ("product_removal",)),
    "orderpoint": (_STOCK, ("stock_warehouse_orderpoint",)),
    "sale_order": (_SALE, ("sale_order",)),
    "sale_order_line": (_SALE, ("sale_order", "sale_order_line")),
    "pricelist": (_SALE, ("product_pricelist",)),
    "pricelist_item": (_SALE, ("product_pricelist_item",)),
    "purchase_order": (_PURCHASE, ("purchase_order",)),
    "purchase_order_line": (_PURCHASE, ("purchase_order", "purchase_order_line")),
    "product_supplierinfo": (_PURCHASE, ("product_supplierinfo",)),
    "purchase_requisition": ((*_PURCHASE, "purchase_requisition"), ("purchase_requisition",)),
    "pos_session": (_POS, ("pos_session",)),
    "pos_order": (_POS, ("pos_order", "pos_session")),
    "pos_order_line": (_POS, ("pos_order_line",)),
    "workcenter": (_MRP, ("mrp_workcenter",)),
    "workcenter_capacity": (_MRP, ("mrp_workcenter_capacity",)),
    "bom": (_MRP, ("mrp_bom",)),
    "bom_lines": (_MRP, ("mrp_bom_line",)),
    "bom_operations": (_MRP, ("mrp_routing_workcenter",)),
    "bom_byproduct": (_MRP, ("mrp_bom_byproduct",)),
    "mrp_production": (_MRP, ("mrp_production",)),
    "mrp_workorder": (_MRP, ("mrp_workorder", "mrp_workcenter")),
    "mps_schedule": (_MPS, ("mrp_production_schedule",)),
    "mps_forecast": (_MPS, ("mrp_product_forecast",)),
    "quality_point": (_QUALITY, ("quality_point",)),
    "quality_check": (_QUALITY, ("quality_check",)),
}


def exports(entity: str):
    """Register a function ``Erp -> DataFrame`` as the export of ``entity``."""

    def register(make: Callable[[Erp], DataFrame]):
        EXPORTS[entity] = make
        return make

    return register


def export(entity: str, erp: Erp) -> DataFrame:
    """The denormalised table of ``entity``, with the declared schema."""
    return EXPORTS[entity](erp)


def left_out(erp: Erp) -> dict[str, str]:
    """Entities whose declared modules or relations the source lacks, and what is absent.

    Modules are looked at if ``erp`` names the installed ones. A missing column is no reason.
    """
    found = {}
    for entity in EXPORTS:
        modules, relations = REQUIRED.get(entity, ((), ()))
        absent = [f"module {m}" for m in modules if erp.modules is not None and m not in erp.modules]
        absent += [f"relation {r}" for r in relations if r not in erp.tables]
        if absent:
            found[entity] = ", ".join(absent)
    return found


def compatible(erp: Erp) -> list[str]:
    """Entities that the source has all relations and columns for, in order of registration.

    An export is planned, not run: one that asks for what the source lacks can't be. Any other error counts.
    This only tells what would succeed; a full export goes by :func:`left_out`, so that no failure is hidden.
    """
    found = []
    for entity in EXPORTS:
        try:
            export(entity, erp).schema  # noqa: B018
        except KeyError:
            continue
        except AnalysisException as error:
            if error.getCondition() and error.getCondition().startswith("UNRESOLVED_COLUMN"):
                continue
            raise
        found.append(entity)
    return found
