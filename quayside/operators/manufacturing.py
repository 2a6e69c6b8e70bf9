"""Manufacturing, master-schedule and quality exports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.functions.columns import attach, conform, fill, first_column, optional
from quayside.functions.lists import attach_lists
from quayside.operators.names import product_names, template_names, uom_names
from quayside.operators.registry import exports
from quayside.sources.catalog import Erp


@exports("workcenter")
def workcenter(erp: Erp) -> DataFrame:
    """Work centres with calendar and, where the source knows owners, the owning work centre."""
    centers = erp["mrp_workcenter"]
    owned = "owner" in centers.columns
    centers = optional(
        centers,
        default_capacity=1.0,
        tool=False,
        constrained=True,
        owner=None,
        post_operation_time=0.0,
        employee_costs_hour=0.0,
    )
    if owned:
        rows = attach(centers, erp["mrp_workcenter"], "owner", owner_name="name")
    else:
        rows = centers.withColumn("owner_name", F.lit(None))
    rows = attach(rows, erp["resource_calendar"], "resource_calendar_id", calendar_name="name")
    return conform(
        rows,
        "workcenter",
        _odoo_workcenter_id="id",
        is_tool="tool",
        is_constrained="constrained",
        _odoo_owner_id="owner",
        _odoo_calendar_id="resource_calendar_id",
    )


@exports("workcenter_capacity")
def workcenter_capacity(erp: Erp) -> DataFrame:
    rows = fill(erp["mrp_workcenter_capacity"], capacity=1.0, time_start=0.0, time_stop=0.0)
    return conform(rows, "workcenter_capacity", _odoo_capacity_id="id")


@exports("bom")
def bom(erp: Erp) -> DataFrame:
    bills = optional(fill(erp["mrp_bom"], produce_delay=0.0), product_qty_multiple=0.0, days_to_prepare_mo=0.0)
    rows = attach(bills, template_names(erp), "product_tmpl_id", "inner", product_name="product_name")
    rows = attach(rows, uom_names(erp), "product_uom_id", uom_name="uom_name")
    return conform(rows, "bom", _odoo_bom_id="id", bom_type="type", _odoo_uom_id="product_uom_id")


@exports("bom_lines")
def bom_lines(erp: Erp) -> DataFrame:
    rows = attach(erp["mrp_bom_line"], product_names(erp), "product_id", "inner", product_name="product_name")
    rows = attach(rows, uom_names(erp), "product_uom_id", uom_name="uom_name")
    rows = attach(rows, erp["mrp_routing_workcenter"], "operation_id", operation_name="name")
    value, links = "product_template_attribute_value_id", erp["mrp_bom_line_product_template_attribute_value_rel"]
    rows = attach_lists(rows, "id", links, "mrp_bom_line_id", value, bom_product_template_attribute_value_ids=value)
    return conform(rows, "bom_lines", _odoo_bom_line_id="id", _odoo_uom_id="product_uom_id")


@exports("bom_operations")
def bom_operations(erp: Erp) -> DataFrame:
    """Routing steps; the cycle time is the computed one if stored, else the manual one."""
    steps = erp["mrp_routing_workcenter"]
    skilled = "skill" in steps.columns and "mrp_skill" in erp.tables
    steps = steps.withColumn("time_cycle", first_column(steps, "time_cycle", "time_cycle_manual"))
    steps = optional(steps, workcenter_quantity=1, skill=None, post_operation_time=0.0, search_mode=None)
    rows = attach(steps, erp["mrp_workcenter"], "workcenter_id", "inner", workcenter_name="name")
    if skilled:
        rows = attach(rows, erp["mrp_skill"], "skill", skill_name="name")
    else:
        rows = rows.withColumn("skill_name", F.lit(None))
    return conform(rows, "bom_operations", _odoo_operation_id="id", _odoo_skill_id="skill")


@exports("bom_byproduct")
def bom_byproduct(erp: Erp) -> DataFrame:
    rows = fill(erp["mrp_bom_byproduct"], product_qty=0.0, cost_share=0.0)
    return conform(rows, "bom_byproduct", _odoo_byproduct_id="id")


@exports("mrp_production")
def mrp_production(erp: Erp) -> DataFrame:
    rows = attach(erp["mrp_production"], product_names(erp), "product_id", "inner", product_name="product_name")
    return conform(rows, "mrp_production", _odoo_mo_id="id", _odoo_uom_id="product_uom_id")


@exports("mrp_workorder")
def mrp_workorder(erp: Erp) -> DataFrame:
    """Work orders; the display name is not stored, the plain name stands in for it."""
    orders = optional(erp["mrp_workorder"], is_user_working=False, employee_costs_hour=0.0)
    rows = attach(orders, erp["mrp_workcenter"], "workcenter_id", "inner", workcenter_name="name")
    return conform(rows, "mrp_workorder", _odoo_wo_id="id", _odoo_mo_id="production_id", display_name="name")


@exports("mps_schedule")
def mps_schedule(erp: Erp) -> DataFrame:
    rows = fill(
        erp["mrp_production_schedule"],
        forecast_target_qty=0.0,
        min_to_replenish_qty=0.0,
        is_indirect=False,
        mps_sequence=10,
    )
    return conform(rows, "mps_schedule", _odoo_schedule_id="id")


@exports("mps_forecast")
def mps_forecast(erp: Erp) -> DataFrame:
    rows = fill(
        erp["mrp_product_forecast"],
        forecast_qty=0.0,
        replenish_qty=0.0,
        replenish_qty_updated=False,
        procurement_launched=False,
    )
    return conform(rows, "mps_forecast", _odoo_forecast_id="id", _odoo_schedule_id="production_schedule_id")


@exports("quality_point")
def quality_point(erp: Erp) -> DataFrame:
    """Control points with the ids of their products and picking types."""
    points = optional(
        fill(erp["quality_point"], sequence=0, active=True),
        measure_on=None,
        measure_frequency_type=None,
        norm=0.0,
        tolerance_min=0.0,
        tolerance_max=0.0,
        norm_unit=None,
    )
    rows = attach(points, erp["quality_point_test_type"], "test_type_id", test_type="technical_name")
    if erp.variant == "19" or "quality_point_product_product_rel" in erp.tables:
        links = erp["quality_point_product_product_rel"]
        item = "product_product_id"
        rows = attach_lists(rows, "id", links, "quality_point_id", item, product_ids=item)
    else:
        rows = rows.withColumn("product_ids", F.lit(""))
    item = "stock_picking_type_id"
    links = erp["quality_point_stock_picking_type_rel"]
    rows = attach_lists(rows, "id", links, "quality_point_id", item, picking_type_ids=item)
    return conform(rows, "quality_point", _odoo_point_id="id")


@exports("quality_check")
def quality_check(erp: Erp) -> DataFrame:
    checks = optional(
        erp["quality_check"], measure=0.0, measure_success=None, qty_tested=0.0, qty_passed=0.0, qty_failed=0.0
    )
    return conform(checks, "quality_check", _odoo_check_id="id")
