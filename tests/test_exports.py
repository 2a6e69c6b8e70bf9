from datetime import datetime

import pytest

from quayside.operators import EXPORTS, export, exports

PRODUCTS = dict(
    product_template=("id long, name string, categ_id long, company_id long, description_sale string, list_price double, "
                      "invoice_policy string, purchase_ok boolean, sale_ok boolean, service_tracking string, tracking string, "
                      "type string, uom_id long",
                      [(1, '{"en_US": "Desk", "fr_FR": "Bureau", "de_DE": "Tisch"}', 5, 1, None, None, "order", True, True, "no", "none", "consu", 1),
                       (2, '{"fr_FR": "Lampe"}', None, None, None, 9.5, "order", True, True, "no", "none", "consu", 1),
                       (3, '{"en_US": "No unit"}', None, None, None, 1.0, "order", True, True, "no", "none", "consu", 99)]),
    product_product=("id long, product_tmpl_id long, active boolean, barcode string, default_code string, standard_price string, volume double, weight double",
                     [(11, 1, True, None, "D1", '{"1": 4.25, "en_US": 2}', None, 3.0), (12, 2, False, "b", None, '{"1": 7}', 1.0, None),
                      (13, 3, True, None, "N", None, None, None), (14, 77, True, None, "orphan", None, None, None)]),
    uom_uom=("id long, name string, factor double, active boolean", [(1, '{"en_US": "Unit"}', 1.0, True)]),
    product_category=("id long, complete_name string", [(5, "All / Office")]),
)
ROUTES = dict(
    stock_route=("id long, name string", [(100, '{"en_US": "Buy"}'), (9, '{"en_US": "Make"}'), (20, '{"fr_FR": "Seul"}')]),
    stock_route_product=("product_id long, route_id long", [(11, 100), (11, 9), (11, 20), (11, 777), (1, 9)]),
)


def by_key(df):
    return {r[0]: r for r in df.collect()}


def test_product(source):
    erp = source(languages=("en_US", "fr_FR", "de_DE"), **PRODUCTS, **ROUTES)
    got = by_key(export("product", erp))
    assert set(got) == {11, 12}  # no unit, no template: not exported
    desk, lamp = got[11], got[12]
    assert (desk.name, desk.name_lang2, desk.name_lang3) == ("Desk", "Bureau", "Tisch")
    assert desk.display_name == "D1 Desk" and lamp.display_name == " "
    assert lamp.name is None and lamp.name_lang2 == "Lampe"
    assert (desk.list_price, lamp.list_price) == (0.0, 9.5)
    # The cost is looked up by language unless a company is named.
    assert (desk.standard_price, lamp.standard_price) == (2.0, 0.0)
    # Routes hang on the variant id; a route without the language is in the ids but not in the names.
    assert desk.route_ids == "9,20,100" and desk.route_names == "Make,Buy"
    assert lamp.route_ids == "" and lamp.route_names == ""
    assert desk.is_storable is False and desk.expiration_time == 0.0 and desk.purchase_method is None
    assert (desk.category_name, lamp.category_name) == ("All / Office", None)


def test_product_by_company_cost_and_without_stock(source):
    got = by_key(export("product", source("18", price_key="1", **PRODUCTS)))
    assert (got[11].standard_price, got[12].standard_price) == (4.25, 7.0)
    assert got[11].route_ids == "" and got[11].name_lang2 is None


def test_first_language_falls_back_and_bad_codes_give_null(source):
    assert by_key(export("product", source(languages=(), **PRODUCTS)))[11].name == "Desk"
    assert by_key(export("product", source(languages=("en_US'--",), **PRODUCTS)))[11].name is None


def test_quant_keeps_rows_with_either_quantity(source):
    erp = source(
        **PRODUCTS,
        stock_quant=("id long, product_id long, location_id long, quantity double, reserved_quantity double, lot_id long, package_id long, "
                     "owner_id long, in_date timestamp, company_id long",
                     [(1, 11, 1, 0.0, 0.0, None, None, None, None, 1), (2, 11, 1, 0.0, 2.0, 8, 3, 4, None, 1), (3, 11, 1, -1.0, 0.0, None, None, None, None, 1),
                      (4, 11, 9, 5.0, 0.0, None, None, None, None, 1), (5, 99, 1, 5.0, 0.0, None, None, None, None, 1), (6, 11, 1, None, 0.0, None, None, None, None, 1),
                      (7, 11, 1, None, 1.0, None, None, None, None, 1)]),
        stock_location=("id long, complete_name string, usage string, warehouse_id long", [(1, "WH/Stock", "internal", 2)]),
        stock_warehouse=("id long, code string", [(2, "WH")]),
        stock_lot=("id long, name string, expiration_date timestamp", [(8, "L8", datetime(2020, 1, 1))]),
        stock_quant_package=("id long, name string", [(3, "box")]),
        res_partner=("id long, name string", [(4, "owner")]),
    )
    got = by_key(export("stock_quant", erp))
    assert set(got) == {2, 3, 7}
    assert (got[2].lot_name, got[2].package_name, got[2].owner_name, got[2].warehouse_code) == ("L8", "box", "owner", "WH")


def test_move_lists_are_swapped_against_the_links(source):
    fields = ("date timestamp, date_deadline timestamp, delay_alert_date timestamp, location_dest_id long, location_id long, origin string, picking_id long, "
              "priority string, procure_method string, product_id long, product_uom long, product_uom_qty double, quantity double, state string, warehouse_id long")  # fmt: skip
    row = (None, None, None, 1, 2, None, None, "0", "x", 11, 1, 1.0, 1.0, "done", None)
    erp = source(
        **PRODUCTS,
        stock_move=(f"id long, {fields}", [(i, *row) for i in (1, 2, 3)]),
        stock_picking=("id long, name string", [(5, "P")]),
        stock_move_move_rel=("move_orig_id long, move_dest_id long", [(1, 2), (1, 3), (2, 3)]),
    )
    got = by_key(export("stock_move", erp))
    assert [(got[i].move_orig_ids, got[i].move_dest_ids) for i in (1, 2, 3)] == [("2,3", ""), ("3", "1"), ("", "1,2")]
    assert got[1]._odoo_production_id is None and got[1].is_subcontract is False


def test_currency_has_a_row_per_rate_and_one_without(source):
    erp = source(
        res_currency=("id long, name string, symbol string, decimal_places long, rounding double, active boolean",
                      [(1, "EUR", "e", 2, 0.01, True), (2, "USD", "$", 2, 0.01, True)]),
        res_currency_rate=("id long, currency_id long, rate double, name date, company_id long",
                           [(7, 1, 1.5, datetime(2020, 1, 2).date(), None), (8, 1, 1.6, datetime(2020, 1, 3).date(), 1)]),
    )
    got = sorted((r._odoo_currency_id, r.rate, r.rate_date) for r in export("currency", erp).collect())
    assert got[:2] == [(1, 1.5, datetime(2020, 1, 2)), (1, 1.6, datetime(2020, 1, 3))]
    assert got[2][0] == 2 and got[2][1] is None and len(got) == 3


ATTENDANCE = "id long, calendar_id long, day_period string, dayofweek string, display_type string, duration_days double, hour_from double, hour_to double, week_type string"


def test_calendar(source):
    lines = [(i, 1, p, "3", d, None, 8.0, 12.0, None) for i, (p, d) in enumerate(
        [("morning", None), ("lunch", ""), ("afternoon", "false"), ("morning", "line_section"), (None, None)])]
    calendars = ("id long, name string, tz string", [(1, "Std", "UTC")])
    erp = source(resource_calendar_attendance=(ATTENDANCE, lines), resource_calendar=calendars)
    got = {r._odoo_attendance_id: r for r in export("calendar", erp).collect()}
    assert {k: v.is_working for k, v in got.items()} == {0: True, 1: False, 2: True, 4: False}
    assert got[0].duration_hours == 4.0 and got[0].day_of_week == 3 and got[0].calendar_name == "Std 1"
    with pytest.raises(Exception):
        bad = source(resource_calendar_attendance=(ATTENDANCE, [(1, 1, "x", "Mon", None, None, 8.0, 9.0, None)]),
                     resource_calendar=calendars)
        export("calendar", bad).collect()


def test_routing_takes_the_first_cycle_time_the_source_has(source):
    centers = ("id long, name string", [(1, "WC")])
    base = "id long, bom_id long, name string, sequence long, workcenter_id long"
    steps = [(1, 1, "op", 1, 1, 5.0, 7.0), (2, 1, "op", 1, 1, None, 7.0)]
    both = source(mrp_workcenter=centers, mrp_routing_workcenter=(f"{base}, time_cycle double, time_cycle_manual double", steps))
    manual = source(mrp_workcenter=centers, mrp_routing_workcenter=(f"{base}, time_cycle_manual double", [s[:5] + s[6:] for s in steps]))
    neither = source(mrp_workcenter=centers, mrp_routing_workcenter=(base, [s[:5] for s in steps]))
    cycle = lambda erp: [r.time_cycle for r in export("bom_operations", erp).orderBy("_odoo_operation_id").collect()]
    assert (cycle(both), cycle(manual), cycle(neither)) == ([5.0, None], [7.0, 7.0], [None, None])


def test_users_can_add_an_export(source):
    @exports("country_codes")
    def country_codes(erp):
        return erp["res_country"].select("code")

    try:
        erp = source(res_country=("id long, code string, name string", [(1, "RO", None)]))
        assert [r.code for r in export("country_codes", erp).collect()] == ["RO"]
    finally:
        del EXPORTS["country_codes"]
