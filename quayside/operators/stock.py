"""Stock exports: locations, warehouses, quants, moves, pickings, routes, reorder rules."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.functions.columns import attach, conform, fill, optional
from quayside.functions.durable import step
from quayside.functions.lists import attach_lists
from quayside.operators.names import product_names, translated
from quayside.operators.registry import exports
from quayside.sources.catalog import Erp


def packages(erp: Erp) -> DataFrame:
    """The package table; older sources name it ``stock_quant_package``."""
    return erp.tables.first_of("stock_package", "stock_quant_package")


@exports("stock_location")
def stock_location(erp: Erp) -> DataFrame:
    """Locations; the storage category joins only if the source has it."""
    rows = attach(erp["stock_location"], erp["stock_warehouse"], "warehouse_id", warehouse_code="code")
    rows = attach(
        rows, erp["product_removal"], "removal_strategy_id", removal_strategy=translated(erp, "method")
    )
    if "storage_category_id" in rows.columns:
        rows = attach(rows, erp["stock_storage_category"], "storage_category_id", storage_category_name="name")
    else:
        rows = rows.withColumns({c: F.lit(None) for c in ("storage_category_id", "storage_category_name")})
    return conform(rows, "stock_location", _odoo_location_id="id", _odoo_parent_id="location_id")


@exports("stock_warehouse")
def stock_warehouse(erp: Erp) -> DataFrame:
    return conform(erp["stock_warehouse"], "stock_warehouse", _odoo_warehouse_id="id")


@exports("stock_storage_category")
def stock_storage_category(erp: Erp) -> DataFrame:
    return conform(erp["stock_storage_category"], "stock_storage_category", _odoo_storage_category_id="id")


@exports("stock_package_type")
def stock_package_type(erp: Erp) -> DataFrame:
    kinds = fill(
        erp["stock_package_type"], height=0.0, width=0.0, packaging_length=0.0, max_weight=0.0, base_weight=0.0
    )
    return conform(kinds, "stock_package_type", _odoo_package_type_id="id")


@exports("stock_package")
def stock_package(erp: Erp) -> DataFrame:
    """Packages. The type table would add no column and no row, so it is not joined."""
    rows = packages(erp)
    if "stock_package_type" not in erp.tables:
        rows = rows.drop("package_type_id")
    rows = optional(rows, pack_date=None, location_id=None, package_type_id=None, shipping_weight=0.0)
    return conform(rows, "stock_package", _odoo_package_id="id")


@exports("stock_picking_type")
def stock_picking_type(erp: Erp) -> DataFrame:
    return conform(
        erp["stock_picking_type"], "stock_picking_type", _odoo_picking_type_id="id", name=translated(erp, "name")
    )


@exports("stock_quant")
def stock_quant(erp: Erp) -> DataFrame:
    """Quantities on hand or reserved, with product, place, lot, package and owner."""
    quants = erp["stock_quant"].filter((F.col("quantity") != 0) | (F.col("reserved_quantity") != 0))
    places = attach(erp["stock_location"], erp["stock_warehouse"], "warehouse_id", warehouse_code="code")
    lots = erp["stock_lot"]
    if erp.variant == "18":
        lots = optional(lots, expiration_date=None)
    rows = attach(
        quants,
        places,
        "location_id",
        "inner",
        location_name="complete_name",
        location_usage="usage",
        warehouse_id="warehouse_id",
        warehouse_code="warehouse_code",
    )
    rows = attach(
        rows, product_names(erp), "product_id", "inner", product_name="product_name", product_code="product_code"
    )
    rows = attach(rows, lots, "lot_id", lot_name="name", expiry_date="expiration_date")
    rows = attach(rows, packages(erp), "package_id", package_name="name")
    rows = attach(rows, erp["res_partner"], "owner_id", owner_name="name")
    return conform(rows, "stock_quant", _odoo_quant_id="id")


@exports("stock_move")
def stock_move(erp: Erp) -> DataFrame:
    """Moves with product and picking names and their linked moves.

    ``move_orig_ids`` lists the moves that follow this one and ``move_dest_ids`` those it follows:
    the two labels are swapped against the link table's own, and consumers rely on it.
    """
    moves = optional(
        erp["stock_move"], production_id=None, sale_line_id=None, purchase_line_id=None, is_subcontract=False
    )
    rows = attach(moves, product_names(erp), "product_id", "inner", product_name="product_name")
    rows = step(attach(rows, erp["stock_picking"], "picking_id", picking_name="name"), "moves")
    links = erp["stock_move_move_rel"]
    rows = attach_lists(rows, "id", links, "move_orig_id", "move_dest_id", move_orig_ids="move_dest_id")
    rows = attach_lists(rows, "id", links, "move_dest_id", "move_orig_id", move_dest_ids="move_orig_id")
    return conform(rows, "stock_move", _odoo_move_id="id", _odoo_uom_id="product_uom")


@exports("stock_move_line")
def stock_move_line(erp: Erp) -> DataFrame:
    lines = erp["stock_move_line"]
    if erp.variant == "18":
        lines = optional(lines, expiration_date=None)
    return conform(lines, "stock_move_line", _odoo_move_line_id="id")


@exports("stock_picking")
def stock_picking(erp: Erp) -> DataFrame:
    rows = attach(
        erp["stock_picking"], erp["stock_picking_type"], "picking_type_id", "inner", picking_type_code="code"
    )
    return conform(rows, "stock_picking", _odoo_picking_id="id")


@exports("stock_route")
def stock_route(erp: Erp) -> DataFrame:
    """One row per rule of a route; a route without rules has none."""
    routes = erp["stock_route"].select(
        "id", translated(erp, "name").alias("route_name"), F.col("active").alias("route_active")
    )
    routes = attach_lists(
        routes, "id", erp["stock_route_warehouse"], "route_id", "warehouse_id", route_warehouse_ids="warehouse_id"
    )
    rows = attach(
        erp["stock_rule"],
        routes,
        "route_id",
        "inner",
        route_name="route_name",
        route_active="route_active",
        route_warehouse_ids="route_warehouse_ids",
    )
    rows = attach(rows, erp["stock_picking_type"], "picking_type_id", picking_type_code="code")
    return conform(rows, "stock_route", _odoo_rule_id="id", rule_name=translated(erp, "name"))


@exports("stock_lot")
def stock_lot(erp: Erp) -> DataFrame:
    lots = optional(erp["stock_lot"], expiration_date=None, use_date=None, removal_date=None, alert_date=None)
    return conform(lots, "stock_lot", _odoo_lot_id="id")


@exports("stock_putaway_rule")
def stock_putaway_rule(erp: Erp) -> DataFrame:
    return conform(erp["stock_putaway_rule"], "stock_putaway_rule", _odoo_putaway_rule_id="id")


@exports("product_removal")
def product_removal(erp: Erp) -> DataFrame:
    return conform(
        erp["product_removal"],
        "product_removal",
        _odoo_removal_id="id",
        name=translated(erp, "name"),
        method=translated(erp, "method"),
    )


@exports("orderpoint")
def orderpoint(erp: Erp) -> DataFrame:
    """Reorder rules with product, warehouse, location and route names."""
    points = optional(
        erp["stock_warehouse_orderpoint"],
        replenishment_uom_id=None,
        qty_to_order_computed=None,
        qty_to_order_manual=None,
        supplier_id=None,
    )
    if erp.variant == "18":
        points = optional(points, deadline_date=None)
    rows = attach(points, product_names(erp), "product_id", "inner", product_name="product_name")
    rows = attach(rows, erp["stock_warehouse"], "warehouse_id", warehouse_code="code")
    rows = attach(rows, erp["stock_location"], "location_id", location_name="complete_name")
    rows = attach(rows, erp["stock_route"], "route_id", route_name=translated(erp, "name"))
    return conform(rows, "orderpoint", _odoo_orderpoint_id="id")
