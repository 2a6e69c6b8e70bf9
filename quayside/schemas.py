"""Declared schemas: the 47 exported entities and the planning-decision table.

The column lists are the file contract. Types are left to a rule where one holds: a column
that starts with ``_odoo_`` is a bigint surrogate key, a column without a type is a string.
"""

from __future__ import annotations

from functools import cache

from pyspark.sql import types as T

# Entity names, their suites, and the column names and types of the exported
# files, in file order.
SUITES = {
    "core": "uom partner product product_category calendar calendar_leaves company country currency",
    "stock": "stock_location stock_warehouse stock_storage_category stock_package_type stock_package "
    "stock_picking_type stock_quant stock_move stock_move_line stock_picking stock_route stock_lot "
    "stock_putaway_rule product_removal orderpoint",
    "sale": "sale_order sale_order_line pricelist pricelist_item",
    "purchase": "purchase_order purchase_order_line product_supplierinfo purchase_requisition",
    "pos": "pos_session pos_order pos_order_line",
    "mrp": "mrp_production mrp_workorder bom bom_lines bom_operations bom_byproduct workcenter workcenter_capacity",
    "mps": "mps_schedule mps_forecast",
    "quality": "quality_point quality_check",
}
ENTITIES = tuple(name for names in SUITES.values() for name in names.split())

_COLUMNS = {
    "product": """_odoo_product_id, _odoo_template_id, name, name_lang2, name_lang3, default_code, barcode,
        display_name, _odoo_uom_id, uom_name, uom_factor double, list_price double, standard_price double,
        weight double, volume double, _odoo_categ_id, category_name, purchase_ok boolean, sale_ok boolean,
        is_storable boolean, active boolean, product_type, description_sale, invoice_policy, purchase_method,
        use_expiration_date boolean, service_tracking, sale_delay double, route_ids, route_names,
        expiration_time double, tracking, _odoo_company_id""",
    "product_supplierinfo": """_odoo_supplierinfo_id, _odoo_template_id, _odoo_product_id, _odoo_partner_id,
        partner_name, delay bigint, min_qty double, price double, _odoo_currency_id, currency_name,
        sequence bigint, date_start timestamp, date_end timestamp, batching_window bigint,
        is_subcontractor boolean""",
    "stock_quant": """_odoo_quant_id, _odoo_product_id, product_name, product_code, _odoo_location_id,
        location_name, location_usage, _odoo_warehouse_id, warehouse_code, quantity double,
        reserved_quantity double, _odoo_lot_id, lot_name, expiry_date timestamp, _odoo_package_id,
        package_name, _odoo_owner_id, owner_name, in_date timestamp, _odoo_company_id""",
    "stock_move": """_odoo_move_id, _odoo_product_id, product_name, product_uom_qty double, quantity double,
        _odoo_uom_id, state, priority, _odoo_picking_id, picking_name, _odoo_location_id,
        _odoo_location_dest_id, _odoo_warehouse_id, _odoo_production_id, _odoo_sale_line_id,
        _odoo_purchase_line_id, origin, date timestamp, date_deadline timestamp, delay_alert_date timestamp,
        procure_method, move_orig_ids, move_dest_ids, is_subcontract boolean""",
    "stock_location": """_odoo_location_id, name, complete_name, usage, _odoo_parent_id, _odoo_warehouse_id,
        warehouse_code, removal_strategy, _odoo_storage_category_id, storage_category_name, active boolean,
        _odoo_company_id""",
    "sale_order_line": """_odoo_sol_id, _odoo_so_id, so_name, _odoo_product_id, product_name,
        product_uom_qty double, qty_delivered double, qty_invoiced double, _odoo_uom_id, uom_name,
        price_unit double, discount double, price_subtotal double, customer_lead double, _odoo_partner_id,
        partner_name, is_company boolean, commitment_date timestamp, date_order timestamp, so_state,
        sol_state, _odoo_warehouse_id, warehouse_code, picking_policy""",
    "purchase_order_line": """_odoo_pol_id, _odoo_po_id, po_name, po_state, receipt_status, _odoo_product_id,
        product_name, product_qty double, qty_received double, _odoo_uom_id, uom_name, price_unit double,
        _odoo_currency_id, date_order timestamp, date_planned timestamp, _odoo_partner_id, partner_name,
        _odoo_warehouse_id, origin, _odoo_sale_line_id, _odoo_orderpoint_id, _odoo_company_id""",
    "mrp_production": """_odoo_mo_id, name, _odoo_product_id, product_name, _odoo_bom_id, product_qty double,
        qty_producing double, _odoo_uom_id, state, priority, reservation_state, date_start timestamp,
        date_finished timestamp, date_deadline timestamp, _odoo_location_src_id, _odoo_location_dest_id,
        _odoo_picking_type_id, origin, _odoo_company_id""",
    "mrp_workorder": """_odoo_wo_id, _odoo_mo_id, display_name, _odoo_workcenter_id, workcenter_name,
        _odoo_operation_id, state, date_start timestamp, date_finished timestamp, duration_expected double,
        duration_unit double, is_user_working boolean, employee_costs_hour double""",
    "bom": """_odoo_bom_id, _odoo_product_tmpl_id, _odoo_product_id, product_name, bom_type,
        product_qty double, _odoo_uom_id, uom_name, product_qty_multiple double, produce_delay double,
        days_to_prepare_mo double, sequence bigint, code, _odoo_company_id""",
    "bom_lines": """_odoo_bom_line_id, _odoo_bom_id, _odoo_product_id, product_name, product_qty double,
        _odoo_uom_id, uom_name, _odoo_operation_id, operation_name, bom_product_template_attribute_value_ids""",
    "bom_operations": """_odoo_operation_id, _odoo_bom_id, name, sequence bigint, _odoo_workcenter_id,
        workcenter_name, time_cycle double, workcenter_quantity bigint, search_mode, _odoo_skill_id,
        skill_name, post_operation_time double""",
    "bom_byproduct": """_odoo_byproduct_id, _odoo_bom_id, _odoo_product_id, product_qty double,
        _odoo_product_uom_id, cost_share double, _odoo_company_id""",
    "workcenter": """_odoo_workcenter_id, name, _odoo_resource_id, default_capacity double,
        time_efficiency double, is_tool boolean, is_constrained boolean, _odoo_owner_id, owner_name,
        _odoo_calendar_id, calendar_name, post_operation_time double, employee_costs_hour double,
        _odoo_company_id""",
    "workcenter_capacity": """_odoo_capacity_id, _odoo_workcenter_id, _odoo_product_id, capacity double,
        time_start double, time_stop double""",
    "calendar": """_odoo_calendar_id, calendar_name, timezone, _odoo_attendance_id, is_working boolean,
        day_of_week bigint, hour_from double, hour_to double, duration_days double, duration_hours double,
        week_type, day_period""",
    "calendar_leaves": """_odoo_leave_id, name, date_from timestamp, date_to timestamp, _odoo_resource_id,
        _odoo_calendar_id, time_type, _odoo_company_id""",
    "orderpoint": """_odoo_orderpoint_id, _odoo_product_id, product_name, _odoo_warehouse_id, warehouse_code,
        _odoo_location_id, location_name, product_min_qty double, product_max_qty double, trigger,
        active boolean, snoozed_until timestamp, _odoo_route_id, route_name, deadline_date timestamp,
        _odoo_replenishment_uom_id, qty_to_order_computed double, qty_to_order_manual double,
        _odoo_supplier_id, _odoo_company_id""",
    "uom": """_odoo_uom_id, name, _odoo_relative_uom_id, parent_path, factor double, relative_factor double,
        active boolean""",
    "partner": """_odoo_partner_id, name, ref, is_company boolean, _odoo_parent_id, parent_name,
        _odoo_country_id, customer_rank bigint, supplier_rank bigint, active boolean, _odoo_company_id""",
    "company": """_odoo_company_id, name, _odoo_currency_id, _odoo_parent_id, security_lead double,
        active boolean, _odoo_country_id""",
    "currency": """_odoo_currency_id, name, symbol, decimal_places bigint, rounding double, active boolean,
        _odoo_rate_id, rate double, rate_date timestamp, _odoo_rate_company_id""",
    "stock_warehouse": """_odoo_warehouse_id, name, code, _odoo_lot_stock_id, _odoo_wh_input_stock_loc_id,
        _odoo_wh_output_stock_loc_id, reception_steps, delivery_steps, active boolean, _odoo_company_id""",
    "stock_picking": """_odoo_picking_id, name, state, picking_type_code, _odoo_location_id,
        _odoo_location_dest_id, scheduled_date timestamp, date_deadline timestamp, date_done timestamp, origin,
        _odoo_partner_id, _odoo_backorder_id, _odoo_sale_id, priority, move_type, _odoo_company_id""",
    "stock_picking_type": """_odoo_picking_type_id, name, code, sequence_code, _odoo_default_location_src_id,
        _odoo_default_location_dest_id, _odoo_warehouse_id, active boolean, _odoo_company_id""",
    "stock_route": """_odoo_route_id, route_name, route_active boolean, _odoo_rule_id, rule_name, action,
        procure_method, _odoo_picking_type_id, picking_type_code, _odoo_location_src_id,
        _odoo_location_dest_id, delay bigint, sequence bigint, _odoo_warehouse_id, _odoo_company_id,
        route_warehouse_ids""",
    "stock_storage_category": """_odoo_storage_category_id, name, max_weight double, allow_new_product,
        _odoo_company_id""",
    "stock_package_type": """_odoo_package_type_id, name, barcode, height double, width double,
        packaging_length double, max_weight double, base_weight double, _odoo_company_id""",
    "stock_package": """_odoo_package_id, name, pack_date timestamp, _odoo_location_id,
        _odoo_package_type_id, shipping_weight double, _odoo_company_id""",
    "stock_putaway_rule": """_odoo_putaway_rule_id, _odoo_product_id, _odoo_category_id,
        _odoo_location_in_id, _odoo_location_out_id, _odoo_storage_category_id, sequence bigint, sublocation,
        active boolean""",
    "product_removal": "_odoo_removal_id, name, method",
    "stock_lot": """_odoo_lot_id, name, ref, _odoo_product_id, _odoo_company_id, expiration_date timestamp,
        use_date timestamp, removal_date timestamp, alert_date timestamp""",
    "sale_order": """_odoo_so_id, name, state, _odoo_partner_id, date_order timestamp,
        commitment_date timestamp, _odoo_warehouse_id, warehouse_code, picking_policy, amount_untaxed double,
        amount_total double, _odoo_currency_id, invoice_status, delivery_status, _odoo_company_id""",
    "purchase_order": """_odoo_po_id, name, state, _odoo_partner_id, date_order timestamp,
        date_approve timestamp, date_planned timestamp, receipt_status, invoice_status, amount_untaxed double,
        amount_total double, _odoo_currency_id, _odoo_picking_type_id, _odoo_warehouse_id, origin, priority,
        _odoo_company_id""",
    "purchase_requisition": """_odoo_requisition_id, name, state, requisition_type, _odoo_vendor_id,
        vendor_name, _odoo_currency_id, date_start timestamp, date_end timestamp, _odoo_warehouse_id,
        active boolean, _odoo_company_id""",
    "pos_order": """_odoo_pos_order_id, name, state, date_order timestamp, _odoo_partner_id,
        _odoo_session_id, _odoo_config_id, amount_total double, amount_tax double, amount_paid double,
        is_refund boolean, _odoo_company_id""",
    "pos_order_line": """_odoo_pos_line_id, _odoo_pos_order_id, _odoo_product_id, full_product_name,
        qty double, price_unit double, price_subtotal double, price_subtotal_incl double, discount double,
        _odoo_company_id""",
    "pos_session": """_odoo_session_id, name, state, _odoo_config_id, _odoo_user_id, start_at timestamp,
        stop_at timestamp, cash_register_balance_start double, cash_register_balance_end_real double,
        cash_real_transaction double""",
    "product_category": """_odoo_categ_id, name, complete_name, _odoo_parent_id, parent_path,
        _odoo_removal_strategy_id, removal_strategy_name, valuation, cost_method""",
    "stock_move_line": """_odoo_move_line_id, _odoo_move_id, _odoo_picking_id, _odoo_product_id,
        _odoo_product_uom_id, quantity double, _odoo_lot_id, lot_name, _odoo_package_id,
        _odoo_result_package_id, _odoo_owner_id, _odoo_location_id, _odoo_location_dest_id, state,
        date timestamp, expiration_date timestamp, _odoo_company_id""",
    "country": "_odoo_country_id, name, code",
    "pricelist": "_odoo_pricelist_id, name, _odoo_currency_id, _odoo_company_id, active boolean",
    "pricelist_item": """_odoo_pricelist_item_id, _odoo_pricelist_id, applied_on, compute_price, base,
        fixed_price double, percent_price double, price_discount double, price_surcharge double,
        price_round double, price_min_margin double, price_max_margin double, min_quantity double,
        date_start timestamp, date_end timestamp, _odoo_product_tmpl_id, _odoo_product_id, _odoo_categ_id,
        _odoo_base_pricelist_id, _odoo_company_id""",
    "mps_schedule": """_odoo_schedule_id, _odoo_product_id, _odoo_warehouse_id, _odoo_bom_id,
        forecast_target_qty double, min_to_replenish_qty double, replenish_trigger, _odoo_route_id,
        _odoo_supplier_id, is_indirect boolean, mps_sequence bigint, _odoo_company_id""",
    "mps_forecast": """_odoo_forecast_id, _odoo_schedule_id, date timestamp, forecast_qty double,
        replenish_qty double, replenish_qty_updated boolean, procurement_launched boolean""",
    "quality_point": """_odoo_point_id, name, title, sequence bigint, _odoo_test_type_id, test_type,
        _odoo_team_id, _odoo_company_id, _odoo_user_id, active boolean, measure_on, measure_frequency_type,
        norm double, tolerance_min double, tolerance_max double, norm_unit, product_ids, picking_type_ids""",
    "quality_check": """_odoo_check_id, _odoo_point_id, quality_state, _odoo_product_id, _odoo_picking_id,
        control_date timestamp, _odoo_user_id, _odoo_team_id, _odoo_company_id, measure double,
        measure_success, qty_tested double, qty_passed double, qty_failed double""",
}

_DECISION_COLUMNS = """decision_id, run_uuid, decision_timestamp timestamp, decision_type, status, item_name,
    _odoo_product_id, _odoo_uom_id, location_name, _odoo_location_id, quantity double, start_date timestamp,
    end_date timestamp, supplier_name, _odoo_supplier_id, _odoo_bom_id, origin_location, destination_location,
    parent_reference, workcenter_name, _odoo_workcenter_id, batch, remark, min_quantity double,
    max_quantity double, delay bigint"""

_TYPES = {
    "string": T.StringType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "timestamp": T.TimestampType(),
}


def _struct(columns: str) -> T.StructType:
    schema = T.StructType()
    for entry in columns.split(","):
        name, *kind = entry.split()
        default = "bigint" if name.startswith("_odoo_") else "string"
        schema.add(name, _TYPES[kind[0] if kind else default])
    return schema


@cache
def outbound_schema(entity: str) -> T.StructType:
    """Schema of the files written for ``entity``."""
    return _struct(_COLUMNS[entity])


@cache
def decision_schema() -> T.StructType:
    """Schema of the planning decisions read back in."""
    return _struct(_DECISION_COLUMNS)


def key_column(entity: str) -> str:
    """Key that chunk ranges of ``entity`` are cut on: its first column."""
    return outbound_schema(entity).names[0]


# Entities large enough to be exported in key ranges.
CHUNKABLE = (
    "partner", "product", "stock_quant", "stock_move", "stock_move_line", "stock_picking",
    "sale_order", "sale_order_line", "purchase_order", "purchase_order_line",
    "product_supplierinfo", "mps_schedule", "mps_forecast", "quality_point", "quality_check",
)
