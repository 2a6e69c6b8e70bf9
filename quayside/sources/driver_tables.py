"""ERP relations derived from the TPC-H-like test tables.

The test data has no ERP tables, so each relation is a query over the given tables that grows
with them. The text is plain SQL that other engines read the same way: the checks use it as the
``WITH`` part of their own queries. All keys are shifted by one so that none is 0. Every nullable
column is NULL on some modulo rule.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from quayside.sources.catalog import Catalog, utc

BASE_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


def _null(every: int, key: str, value: str) -> str:
    return f"CASE WHEN {key} % {every} = 0 THEN NULL ELSE {value} END"


def _text(key: str) -> str:
    return f"CAST({key} AS STRING)"


def _names(key: str, value: str) -> str:
    """A translated field: an object with one text per language, one of them missing at times."""
    english = "'{\"en_US\": \"' || " + value + " || '\"'"
    french = "', \"fr_FR\": \"' || " + value + " || ' FR\"'"
    return f"CASE WHEN {key} % 7 = 0 THEN {english} || '}}' ELSE {english} || {french} || '}}' END"


def _big(column: str) -> str:
    return f"CAST({column} AS BIGINT)"


NATION, REGION = f"({_big('n_nationkey')} + 1)", f"({_big('n_regionkey')} + 1)"
REGION_ID = f"({_big('r_regionkey')} + 1)"
CUSTOMER, SUPPLIER = "(2 * (c_custkey + 1))", "(2 * (s_suppkey + 1) + 1)"
PART, ORDER = "(p_partkey + 1)", "(o_orderkey + 1)"

RELATIONS = {
    # One row per order line: the line key repeats in the data, so it is grouped first.
    "li": """SELECT l_orderkey + 1 AS order_id, (l_orderkey + 1) * 10 + l_linenumber AS id,
        CAST(l_linenumber AS BIGINT) AS line_no, min(l_partkey) + 1 AS part_id, min(l_suppkey) + 1 AS supp_id,
        sum(l_quantity) AS qty, min(l_shipdate) AS shipdate,
        CASE min(CASE l_returnflag WHEN 'A' THEN 1 WHEN 'N' THEN 2 ELSE 3 END) WHEN 1 THEN 'A' WHEN 2 THEN 'N' ELSE 'R' END AS flag,
        min(l_extendedprice) AS price, min(l_discount) AS disc
        FROM lineitem GROUP BY l_orderkey, l_linenumber""",
    "ptype": "SELECT p_type, min(p_partkey) + 1 AS id FROM part GROUP BY p_type",
    "pbrand": "SELECT p_brand, min(p_partkey) + 1 AS id FROM part GROUP BY p_brand",
    "res_country": f"SELECT {NATION} AS id, 'C' || {_text(NATION)} AS code, {_names(NATION, 'n_name')} AS name FROM nation",
    "res_currency": f"""SELECT {NATION} AS id, 'CU' || {_text(NATION)} AS name, {_null(4, NATION, "'$'")} AS symbol,
        CAST(2 AS BIGINT) AS decimal_places, 0.01e0 AS rounding, n_nationkey % 3 <> 0 AS active FROM nation""",
    "res_currency_rate": f"""SELECT nation_id * 1000000 + month_no AS id, nation_id AS currency_id,
        {_null(5, "month_no", "nation_id % 5 + 1")} AS company_id, 1.0e0 + month_no / 1024.0e0 AS rate,
        day AS name FROM (
        SELECT DISTINCT {_big("c_nationkey")} + 1 AS nation_id, CAST(date_trunc('month', o_orderdate) AS DATE) AS day,
        CAST(year(o_orderdate) * 12 + month(o_orderdate) AS BIGINT) AS month_no
        FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_nationkey % 6 <> 0) rates""",
    "res_company": f"""SELECT {REGION_ID} AS id, r_name AS name, {REGION_ID} AS currency_id,
        {_null(2, REGION_ID, _big("1"))} AS parent_id, {_null(3, REGION_ID, "2 * " + REGION_ID)} AS partner_id,
        {_null(4, REGION_ID, "1.5e0")} AS security_lead, r_regionkey <> 4 AS active FROM region""",
    "res_partner": f"""SELECT {CUSTOMER} AS id, c_name AS name, {_null(6, "c_custkey", "'C' || " + _text("c_custkey"))} AS ref,
        c_custkey % 3 = 0 AS is_company, {_null(5, "c_custkey", "2 * (c_custkey - c_custkey % 10 + 1)")} AS parent_id,
        {_null(9, "c_custkey", _big("c_nationkey") + " + 1")} AS country_id,
        {_null(4, "c_custkey", "c_custkey % 4")} AS customer_rank, CAST(NULL AS BIGINT) AS supplier_rank,
        c_custkey % 10 <> 3 AS active, {_null(6, "c_custkey", "c_custkey % 5 + 1")} AS company_id FROM customer
        UNION ALL SELECT {SUPPLIER} AS id, s_name AS name, 'S' || {_text("s_suppkey")} AS ref, TRUE AS is_company,
        CAST(NULL AS BIGINT) AS parent_id, {_big("s_nationkey")} + 1 AS country_id, CAST(NULL AS BIGINT) AS customer_rank,
        {_null(5, "s_suppkey", "s_suppkey % 3 + 1")} AS supplier_rank, TRUE AS active,
        CAST(NULL AS BIGINT) AS company_id FROM supplier""",
    "product_removal": f"""SELECT id, {_names("id", "p_type")} AS name, {_names("id", "lower(p_type)")} AS method FROM ptype""",
    "product_category": f"""SELECT id, p_type AS name, 'All / ' || p_type AS complete_name, {_null(2, "id", _big("1"))} AS parent_id,
        '1/' || {_text("id")} || '/' AS parent_path, {_null(3, "id", "id")} AS removal_strategy_id,
        {_names("id", "'val ' || p_type")} AS property_valuation, {_null(4, "id", _names("id", "'cost ' || p_type"))} AS property_cost_method
        FROM ptype""",
    "stock_storage_category": f"""SELECT id, p_type AS name, id * 10.0e0 AS max_weight, 'mixed' AS allow_new_product,
        {_null(2, "id", "id % 5 + 1")} AS company_id FROM ptype""",
    "uom_uom": f"""SELECT id, {_names("id", "'UoM ' || " + _text("id"))} AS name, id / 2.0e0 AS factor, id % 9 <> 0 AS active,
        {_null(4, "id", _big("1"))} AS relative_uom_id, '1/' || {_text("id")} || '/' AS parent_path,
        {_null(5, "id", "id / 4.0e0")} AS relative_factor
        FROM (SELECT DISTINCT {_big("p_size")} AS id FROM part) sizes""",
    "product_template": f"""SELECT {PART} AS id, {_names(PART, "p_name || ' ' || " + _text(PART))} AS name,
        {_null(10, "p_partkey", "ptype.id")} AS categ_id, {_null(8, "p_partkey", "p_partkey % 5 + 1")} AS company_id,
        {_null(3, "p_partkey", _names("p_partkey", "'About ' || p_name"))} AS description_sale,
        {_null(4, "p_partkey", "p_size * 1.0e0")} AS expiration_time, 'order' AS invoice_policy,
        {_null(5, "p_partkey", "p_partkey % 2 = 0")} AS is_storable, {_null(6, "p_partkey", "p_retailprice")} AS list_price,
        {_null(7, "p_partkey", "'receive'")} AS purchase_method, p_partkey % 3 <> 0 AS purchase_ok,
        {_null(9, "p_partkey", "p_size / 2.0e0")} AS sale_delay, p_partkey % 4 <> 0 AS sale_ok, 'no' AS service_tracking,
        CASE WHEN p_partkey % 2 = 0 THEN 'lot' ELSE 'none' END AS tracking, 'consu' AS type, {_big("p_size")} AS uom_id,
        {_null(6, "p_partkey", "p_partkey % 2 = 1")} AS use_expiration_date
        FROM part JOIN ptype ON part.p_type = ptype.p_type""",
    # Every tenth template has a second variant, with an odd id.
    "product_product": f"""SELECT 2 * {PART} AS id, {PART} AS product_tmpl_id, p_partkey % 8 <> 0 AS active,
        {_null(5, "p_partkey", "'BC' || " + _text(PART))} AS barcode, {_null(4, "p_partkey", "'P' || " + _text(PART))} AS default_code,
        CASE WHEN p_partkey % 3 = 0 THEN NULL WHEN p_partkey % 3 = 1 THEN '{{"1": ' || {_text("p_size")} || '}}'
        ELSE '{{"en_US": ' || {_text("p_size")} || '.5, "1": 3}}' END AS standard_price,
        {_null(6, "p_partkey", "p_size / 8.0e0")} AS volume, {_null(7, "p_partkey", "p_size / 4.0e0")} AS weight FROM part
        UNION ALL SELECT 2 * {PART} + 1 AS id, {PART} AS product_tmpl_id, TRUE AS active, CAST(NULL AS STRING) AS barcode,
        'V' || {_text(PART)} AS default_code, CAST(NULL AS STRING) AS standard_price, 1.0e0 AS volume, 1.0e0 AS weight
        FROM part WHERE p_partkey % 10 = 0""",
    "stock_lot": f"""SELECT {PART} AS id, 'LOT' || {_text(PART)} AS name, {_null(3, "p_partkey", "'R' || " + _text(PART))} AS ref,
        2 * {PART} AS product_id, {_null(5, "p_partkey", "p_partkey % 5 + 1")} AS company_id,
        {_null(2, "p_partkey", "CAST('2001-01-01 00:00:00' AS TIMESTAMP)")} AS expiration_date,
        {_null(3, "p_partkey", "CAST('2001-02-01 06:00:00' AS TIMESTAMP)")} AS use_date,
        {_null(4, "p_partkey", "CAST('2001-03-01 12:30:00' AS TIMESTAMP)")} AS removal_date,
        {_null(5, "p_partkey", "CAST('2001-04-01 00:00:00' AS TIMESTAMP)")} AS alert_date FROM part""",
    "product_supplierinfo": " UNION ALL ".join(
        f"""SELECT (part_id * 1000000 + supp_id) * 4 + {n} AS id, part_id AS product_tmpl_id,
        {_null(3, "part_id", "2 * part_id")} AS product_id, 2 * supp_id + 1 AS partner_id, part_id % 20 + {n} AS delay,
        {qty}.0e0 AS min_qty, 100.0e0 - part_id % 50 - {n} AS price, {_null(4, "supp_id", f"(supp_id + {n}) % 25 + 1")} AS currency_id,
        CAST({n} AS BIGINT) AS sequence, {_null(2, "part_id", "CAST('1998-01-01 00:00:00' AS TIMESTAMP)")} AS date_start,
        {_null(3, "supp_id", "CAST('2002-12-31 00:00:00' AS TIMESTAMP)")} AS date_end, {_null(5, "part_id", "part_id % 7")} AS batching_window,
        {_null(6, "part_id", "supp_id % 2 = 0")} AS is_subcontractor
        FROM (SELECT DISTINCT l_partkey + 1 AS part_id, l_suppkey + 1 AS supp_id FROM lineitem) pairs"""
        for n, qty in ((1, 1), (2, 10), (3, 25))
    ),
    "stock_route": f"""SELECT id, {_null(11, "id", _names("id", "'Route ' || p_brand"))} AS name, id % 5 <> 0 AS active FROM pbrand""",
    "stock_rule": f"""SELECT pbrand.id * 10 + r_regionkey AS id, pbrand.id AS route_id, 'pull' AS action,
        {_null(3, "pbrand.id", REGION_ID)} AS company_id, {_big("r_regionkey")} AS delay, {_big("r_regionkey")} + 2 AS location_dest_id,
        {_null(4, "pbrand.id", _big("r_regionkey") + " + 1")} AS location_src_id, {_names("pbrand.id", "'Rule ' || r_name")} AS name,
        {_null(5, "pbrand.id", "r_regionkey * 3 + 1 + pbrand.id % 3")} AS picking_type_id, 'make_to_stock' AS procure_method,
        pbrand.id % 20 AS sequence, {_null(6, "pbrand.id", REGION_ID)} AS warehouse_id
        FROM pbrand JOIN region ON pbrand.id % 5 <> r_regionkey WHERE pbrand.id % 4 <> 0""",
    "stock_route_product": f"""SELECT 2 * {PART} AS product_id, pbrand.id AS route_id FROM part JOIN pbrand ON part.p_brand = pbrand.p_brand
        WHERE p_partkey % 3 <> 0 UNION ALL SELECT 2 * {PART} AS product_id, p_partkey % 30 + 1 AS route_id FROM part WHERE p_partkey % 2 = 0""",
    "stock_route_warehouse": f"""SELECT pbrand.id AS route_id, {REGION_ID} AS warehouse_id FROM pbrand
        JOIN region ON (pbrand.id + r_regionkey) % 3 = 0""",
    "stock_warehouse": f"""SELECT {REGION_ID} AS id, 'WH' || {_text(REGION_ID)} AS code, r_name AS name, r_regionkey <> 2 AS active,
        {REGION_ID} AS company_id, 'ship_only' AS delivery_steps, {REGION_ID} AS lot_stock_id, 'one_step' AS reception_steps,
        {_null(2, REGION_ID, REGION_ID + " + 5")} AS wh_input_stock_loc_id, {_null(3, REGION_ID, REGION_ID + " + 10")} AS wh_output_stock_loc_id
        FROM region""",
    "stock_location": f"""SELECT {NATION} AS id, n_nationkey % 8 <> 0 AS active, {_null(5, NATION, REGION)} AS company_id,
        'WH/' || n_name AS complete_name, {_null(3, NATION, _big("1"))} AS location_id,
        CASE WHEN n_regionkey = 3 THEN 'Shelf ' ELSE 'Stock ' END || n_name AS name,
        {_null(2, NATION, "ptype.id")} AS removal_strategy_id, {_null(3, NATION, "ptype.id")} AS storage_category_id,
        CASE WHEN n_nationkey % 4 = 3 THEN 'customer' ELSE 'internal' END AS usage, {_null(6, NATION, REGION)} AS warehouse_id
        FROM nation LEFT JOIN ptype ON ptype.id = n_nationkey % 12 + 1""",
    "sale_order": f"""SELECT {ORDER} AS id, 'SO' || {_text(ORDER)} AS name, CASE o_orderstatus WHEN 'F' THEN 'done' WHEN 'O' THEN 'sale' ELSE 'draft' END AS state,
        2 * (o_custkey + 1) AS partner_id, o_orderdate AS date_order, {_null(3, "o_orderkey", "o_orderdate + INTERVAL 14 DAY")} AS commitment_date,
        {_null(4, "o_orderkey", "o_custkey % 6 + 1")} AS warehouse_id, 'direct' AS picking_policy, {_null(10, "o_orderkey", "o_totalprice")} AS amount_untaxed,
        {_null(12, "o_orderkey", "o_totalprice * 1.25e0")} AS amount_total, o_custkey % 25 + 1 AS currency_id, 'invoiced' AS invoice_status,
        {_null(5, "o_orderkey", "'full'")} AS delivery_status, o_custkey % 5 + 1 AS company_id FROM orders""",
    "sale_order_line": f"""SELECT id, order_id, {_null(11, "id", "CASE WHEN id % 13 = 0 THEN 2 * part_id + 1 ELSE 2 * part_id END")} AS product_id,
        {_null(9, "id", "part_id % 50 + 1")} AS product_uom, {_null(9, "id", "part_id % 50 + 1")} AS product_uom_id, qty AS product_uom_qty,
        CASE WHEN flag = 'A' THEN qty ELSE 0.0e0 END AS qty_delivered, {_null(4, "id", "qty")} AS qty_invoiced, {_null(8, "id", "price")} AS price_unit,
        {_null(3, "id", "disc")} AS discount, {_null(14, "id", "price")} AS price_subtotal, {_null(6, "id", "line_no * 1.0e0")} AS customer_lead,
        CASE WHEN flag = 'R' THEN 'cancel' ELSE 'sale' END AS state FROM li""",
    "product_pricelist": f"""SELECT {REGION_ID} AS id, r_regionkey <> 1 AS active, {_null(2, REGION_ID, REGION_ID)} AS company_id, {REGION_ID} AS currency_id,
        {_names(REGION_ID, "'List ' || r_name")} AS name FROM region""",
    "product_pricelist_item": f"""SELECT {PART} AS id, p_partkey % 5 + 1 AS pricelist_id, '1_product' AS applied_on, 'list_price' AS base,
        {_null(4, "p_partkey", "p_partkey % 5 + 1")} AS base_pricelist_id, {_null(5, "p_partkey", "p_partkey % 6 + 1")} AS categ_id,
        {_null(6, "p_partkey", "p_partkey % 5 + 1")} AS company_id, 'fixed' AS compute_price,
        {_null(2, "p_partkey", "CAST('1999-12-31 23:59:59' AS TIMESTAMP)")} AS date_end, {_null(3, "p_partkey", "CAST('1999-01-01 00:00:00' AS TIMESTAMP)")} AS date_start,
        {_null(2, "p_partkey", "p_retailprice")} AS fixed_price, {_null(3, "p_partkey", "p_size * 1.0e0")} AS min_quantity, {_null(4, "p_partkey", "5.0e0")} AS percent_price,
        {_null(5, "p_partkey", "p_size / 2.0e0")} AS price_discount, {_null(6, "p_partkey", "9.0e0")} AS price_max_margin, {_null(7, "p_partkey", "1.0e0")} AS price_min_margin,
        {_null(8, "p_partkey", "0.5e0")} AS price_round, {_null(9, "p_partkey", "2.0e0")} AS price_surcharge, {_null(3, "p_partkey", "2 * " + PART)} AS product_id,
        {PART} AS product_tmpl_id FROM part""",
    "purchase_order": f"""SELECT (supp_id * 100000 + month_no) AS id, 'PO' || {_text("supp_id * 100000 + month_no")} AS name, 2 * supp_id + 1 AS partner_id,
        CASE WHEN month_no % 3 = 0 THEN 'draft' ELSE 'purchase' END AS state, {_null(4, "month_no", "day")} AS date_approve, day AS date_order,
        {_null(5, "month_no", "day + INTERVAL 7 DAY")} AS date_planned, {_null(3, "month_no", "'pending'")} AS receipt_status, 'no' AS invoice_status,
        {_null(6, "month_no", "amount")} AS amount_untaxed, {_null(7, "month_no", "amount * 1.25e0")} AS amount_total, supp_id % 25 + 1 AS currency_id,
        {_null(5, "supp_id", "supp_id % 16 + 1")} AS picking_type_id,
        CASE WHEN month_no % 4 = 0 THEN NULL WHEN month_no % 4 = 1 THEN 'Planner ' || {_text("month_no")} ELSE 'OP' || {_text("month_no")} END AS origin,
        '0' AS priority, supp_id % 5 + 1 AS company_id
        FROM (SELECT supp_id, date_trunc('month', shipdate) AS day, CAST(year(shipdate) * 12 + month(shipdate) AS BIGINT) AS month_no, sum(qty) AS amount
              FROM li GROUP BY supp_id, date_trunc('month', shipdate), year(shipdate) * 12 + month(shipdate)) months""",
    "purchase_order_line": f"""SELECT id, supp_id * 100000 + year(shipdate) * 12 + month(shipdate) AS order_id, {_null(11, "id", "2 * part_id")} AS product_id,
        shipdate AS date_planned, {_null(3, "id", "part_id")} AS orderpoint_id, price AS price_unit, qty AS product_qty, {_null(7, "id", "part_id % 50 + 1")} AS product_uom,
        {_null(7, "id", "part_id % 50 + 1")} AS product_uom_id, CASE WHEN id % 2 = 0 THEN qty ELSE 0.0e0 END AS qty_received, {_null(4, "id", "id")} AS sale_line_id
        FROM li WHERE flag = 'R'""",
    "purchase_requisition": f"""SELECT s_suppkey + 1 AS id, s_suppkey % 7 <> 0 AS active, s_suppkey % 5 + 1 AS company_id, {_big("s_nationkey")} + 1 AS currency_id,
        {_null(2, "s_suppkey", "CAST('1999-06-30 00:00:00' AS TIMESTAMP)")} AS date_end, CAST('1999-01-01 00:00:00' AS TIMESTAMP) AS date_start, s_name AS name,
        'blanket_order' AS requisition_type, 'confirmed' AS state, {_null(6, "s_suppkey", SUPPLIER)} AS vendor_id, s_suppkey % 5 + 1 AS warehouse_id FROM supplier""",
    # One row per region and kind of transfer; a fallback kind without a warehouse is id 16.
    "stock_picking_type": " UNION ALL ".join(
        f"""SELECT {_big("r_regionkey")} * 3 + {n} AS id, r_regionkey <> 3 AS active, '{code}' AS code, {REGION_ID} AS company_id,
        {_null(4, REGION_ID, REGION_ID + " + 20")} AS default_location_dest_id, {_null(5, REGION_ID, REGION_ID)} AS default_location_src_id,
        {_names(REGION_ID, f"'{code} ' || r_name")} AS name, '{code[:2]}' AS sequence_code, {_null(3, REGION_ID, REGION_ID)} AS warehouse_id FROM region"""
        for n, code in ((1, "incoming"), (2, "internal"), (3, "outgoing"))
    ),
    "stock_picking": f"""SELECT {ORDER} AS id, 'PICK' || {_text(ORDER)} AS name, CASE WHEN o_orderkey % 3 = 0 THEN 'draft' ELSE 'done' END AS state,
        o_orderkey % 16 + 1 AS picking_type_id, o_custkey % 25 + 1 AS location_id, o_orderkey % 25 + 1 AS location_dest_id, o_orderdate AS scheduled_date,
        {_null(3, "o_orderkey", "o_orderdate + INTERVAL 2 DAY")} AS date_deadline, {_null(4, "o_orderkey", "o_orderdate + INTERVAL 3 DAY")} AS date_done,
        CASE WHEN o_orderkey % 5 = 0 THEN 'Planner' WHEN o_orderkey % 5 = 1 THEN NULL ELSE 'SO' || {_text(ORDER)} END AS origin,
        {_null(6, "o_orderkey", "2 * (o_custkey + 1)")} AS partner_id, {_null(2, "o_orderkey", "o_orderkey")} AS backorder_id, {_null(7, "o_orderkey", ORDER)} AS sale_id,
        '0' AS priority, 'direct' AS move_type, o_custkey % 5 + 1 AS company_id FROM orders WHERE o_orderstatus = 'F'""",
    "stock_move": f"""SELECT id, CASE WHEN id % 13 = 0 THEN 2 * part_id + 1 ELSE 2 * part_id END AS product_id, qty AS product_uom_qty,
        CASE WHEN flag = 'A' THEN qty ELSE 0.0e0 END AS quantity, part_id % 50 + 1 AS product_uom,
        CASE flag WHEN 'A' THEN 'done' WHEN 'R' THEN 'cancel' ELSE 'assigned' END AS state, {_null(3, "id", "'0'")} AS priority,
        {_null(4, "id", "order_id")} AS picking_id, supp_id % 25 + 1 AS location_id, part_id % 25 + 1 AS location_dest_id,
        {_null(5, "id", "supp_id % 5 + 1")} AS warehouse_id, {_null(3, "id", "order_id")} AS production_id, {_null(6, "id", "id")} AS sale_line_id,
        {_null(7, "id", "id")} AS purchase_line_id, {_null(8, "id", "'SO' || " + _text("order_id"))} AS origin, shipdate AS date,
        {_null(2, "id", "shipdate + INTERVAL 1 DAY")} AS date_deadline, {_null(9, "id", "shipdate + INTERVAL 2 DAY")} AS delay_alert_date,
        'make_to_stock' AS procure_method, {_null(4, "id", "id % 2 = 0")} AS is_subcontract FROM li""",
    "stock_move_line": f"""SELECT id, id AS move_id, {_null(4, "id", "order_id")} AS picking_id, 2 * part_id AS product_id, part_id % 50 + 1 AS product_uom_id,
        qty AS quantity, {_null(3, "id", "part_id")} AS lot_id, {_null(3, "id", "'LOT' || " + _text("part_id"))} AS lot_name,
        {_null(5, "id", "supp_id % 5 + 1")} AS package_id, {_null(6, "id", "part_id % 5 + 1")} AS result_package_id, {_null(7, "id", "2 * supp_id + 1")} AS owner_id,
        supp_id % 25 + 1 AS location_id, part_id % 25 + 1 AS location_dest_id, CASE WHEN flag = 'A' THEN 'done' ELSE 'assigned' END AS state,
        shipdate AS date, {_null(2, "id", "shipdate + INTERVAL 365 DAY")} AS expiration_date, supp_id % 5 + 1 AS company_id FROM li""",
    # A move feeds the next two lines of its order; one move of every order feeds line 7 again.
    "stock_move_move_rel": """SELECT id AS move_orig_id, id + 1 AS move_dest_id FROM li WHERE line_no < 7
        UNION ALL SELECT id AS move_orig_id, id + 2 AS move_dest_id FROM li WHERE line_no < 6
        UNION ALL SELECT id AS move_orig_id, order_id * 10 + 7 AS move_dest_id FROM li""",
    "stock_quant": f"""SELECT part_id * 100 + place AS id, 2 * part_id AS product_id, place AS location_id, total AS quantity_seen,
        CASE WHEN (part_id + place) % 4 = 0 THEN 0.0e0 ELSE total END AS quantity, CASE WHEN part_id % 3 = 0 THEN 1.0e0 ELSE 0.0e0 END AS reserved_quantity,
        {_null(3, "part_id", "part_id")} AS lot_id, {_null(3, "place", "part_id % 6 + 1")} AS package_id, {_null(5, "place", "2 * (part_id % 40) + 1")} AS owner_id,
        last_in AS in_date, {_null(7, "place", "place % 5 + 1")} AS company_id
        FROM (SELECT part_id, supp_id % 26 + 1 AS place, sum(qty) AS total, max(shipdate) AS last_in FROM li GROUP BY part_id, supp_id % 26 + 1) places""",
    "stock_package_type": f"""SELECT {REGION_ID} AS id, r_name AS name, {_null(2, REGION_ID, "'PT' || " + _text(REGION_ID))} AS barcode, {_null(3, REGION_ID, "2.0e0")} AS height,
        {_null(4, REGION_ID, "3.0e0")} AS width, {_null(5, REGION_ID, "4.0e0")} AS packaging_length, {_null(2, REGION_ID, "50.0e0")} AS max_weight,
        {_null(3, REGION_ID, "0.5e0")} AS base_weight, {_null(4, REGION_ID, REGION_ID)} AS company_id FROM region""",
    "stock_package": f"""SELECT {REGION_ID} AS id, 'PACK' || {_text(REGION_ID)} AS name, {_null(2, REGION_ID, "CAST('2000-05-05' AS DATE)")} AS pack_date,
        {_null(3, REGION_ID, REGION_ID)} AS location_id, {_null(4, REGION_ID, REGION_ID)} AS package_type_id, {_null(5, REGION_ID, "7.5e0")} AS shipping_weight,
        {REGION_ID} AS company_id FROM region""",
    "stock_warehouse_orderpoint": f"""SELECT {PART} AS id, 2 * {PART} AS product_id,
        CASE WHEN p_partkey % 9 = 0 THEN 'Planner-' || {_text("2 * " + PART)} ELSE 'OP/' || {_text(PART)} END AS name,
        {_null(6, "p_partkey", "p_partkey % 5 + 1")} AS warehouse_id, p_partkey % 25 + 1 AS location_id, p_size * 1.0e0 AS product_min_qty, p_size * 3.0e0 AS product_max_qty,
        'auto' AS trigger, p_partkey % 10 <> 0 AS active, {_null(2, "p_partkey", "CAST('1999-09-09' AS DATE)")} AS snoozed_until,
        {_null(3, "p_partkey", "p_partkey % 30 + 1")} AS route_id, {_null(4, "p_partkey", "CAST('1999-10-10' AS DATE)")} AS deadline_date,
        {_null(5, "p_partkey", _big("p_size"))} AS replenishment_uom_id, {_null(6, "p_partkey", "p_size / 2.0e0")} AS qty_to_order_computed,
        {_null(7, "p_partkey", "p_size / 4.0e0")} AS qty_to_order_manual, {_null(8, "p_partkey", "p_partkey % 100 + 1")} AS supplier_id, p_partkey % 5 + 1 AS company_id
        FROM part WHERE p_partkey % 4 <> 1""",
    "stock_putaway_rule": f"""SELECT {PART} AS id, p_partkey % 2 = 0 AS active, {_null(2, "p_partkey", "p_partkey % 6 + 1")} AS category_id, p_partkey % 25 + 1 AS location_in_id,
        p_partkey % 24 + 2 AS location_out_id, {_null(3, "p_partkey", "2 * " + PART)} AS product_id, {_big("p_size")} AS sequence,
        {_null(4, "p_partkey", "p_partkey % 6 + 1")} AS storage_category_id, 'no' AS sublocation FROM part""",
    "mrp_bom": f"""SELECT {PART} AS id, {_null(4, "p_partkey", "'BOM' || " + _text(PART))} AS code, p_partkey % 5 + 1 AS company_id, {_null(5, "p_partkey", "p_size / 2.0e0")} AS days_to_prepare_mo,
        {_null(6, "p_partkey", "p_size * 1.0e0")} AS produce_delay, {_null(2, "p_partkey", "2 * " + PART)} AS product_id, 1.0e0 AS product_qty,
        {_null(7, "p_partkey", "p_size / 8.0e0")} AS product_qty_multiple, {PART} AS product_tmpl_id, {_null(8, "p_partkey", _big("p_size"))} AS product_uom_id,
        {_big("p_size")} AS sequence, 'normal' AS type FROM part WHERE p_size > 25""",
    "mrp_bom_line": f"""SELECT id, part_id AS bom_id, {_null(3, "id", "part_id * 50 + supp_id % 25 + 1")} AS operation_id,
        CASE WHEN id % 13 = 0 THEN 2 * part_id + 1 ELSE 2 * (part_id % 100 + 1) END AS product_id, qty AS product_qty, {_null(4, "id", "part_id % 60 + 1")} AS product_uom_id
        FROM li JOIN part ON part_id = p_partkey + 1 WHERE p_size > 25""",
    "mrp_bom_line_product_template_attribute_value_rel": """SELECT id AS mrp_bom_line_id, 100000 - part_id AS product_template_attribute_value_id FROM li WHERE id % 3 = 0
        UNION ALL SELECT id AS mrp_bom_line_id, supp_id AS product_template_attribute_value_id FROM li WHERE id % 2 = 0""",
    "mrp_bom_byproduct": f"""SELECT {PART} AS id, {PART} AS bom_id, {_null(3, "p_partkey", "p_partkey % 5 + 1")} AS company_id, {_null(4, "p_partkey", "0.25e0")} AS cost_share,
        2 * {PART} AS product_id, {_null(5, "p_partkey", "p_size * 1.0e0")} AS product_qty, {_big("p_size")} AS product_uom_id FROM part WHERE p_size > 25""",
    "mrp_skill": f"SELECT {REGION_ID} AS id, 'Skill ' || r_name AS name FROM region",
    "mrp_workcenter": f"""SELECT {NATION} AS id, {REGION} AS company_id, {_null(3, NATION, "n_nationkey % 2 = 0")} AS constrained, {_null(4, NATION, "2.0e0")} AS default_capacity,
        {_null(5, NATION, "35.5e0")} AS employee_costs_hour, 'WC ' || n_name AS name, {_null(2, NATION, REGION)} AS owner, {_null(6, NATION, "10.0e0")} AS post_operation_time,
        {_null(7, NATION, REGION)} AS resource_calendar_id, {NATION} AS resource_id, 100.0e0 AS time_efficiency, {_null(8, NATION, "n_nationkey % 3 = 0")} AS tool FROM nation""",
    "mrp_workcenter_capacity": f"""SELECT {PART} AS id, {_null(3, "p_partkey", "p_size * 1.0e0")} AS capacity, 2 * {PART} AS product_id, {_null(4, "p_partkey", "5.0e0")} AS time_start,
        {_null(5, "p_partkey", "6.0e0")} AS time_stop, p_partkey % 25 + 1 AS workcenter_id FROM part""",
    "mrp_routing_workcenter": f"""SELECT {PART} * 50 + {NATION} AS id, {PART} AS bom_id, 'Op ' || n_name AS name, {_null(3, "p_partkey", "2.0e0")} AS post_operation_time,
        {_null(4, "p_partkey", "'best'")} AS search_mode, {_big("p_size")} AS sequence, {_null(5, "p_partkey", REGION)} AS skill, {_null(2, "p_partkey", "p_size / 2.0e0")} AS time_cycle,
        p_size * 1.0e0 AS time_cycle_manual, CASE WHEN p_partkey % 9 = 0 THEN {NATION} + 30 ELSE {NATION} END AS workcenter_id, {_null(6, "p_partkey", "p_partkey % 3 + 1")} AS workcenter_quantity
        FROM part JOIN nation ON p_partkey % 25 = n_nationkey WHERE p_size > 25""",
    "mrp_production": f"""SELECT {ORDER} AS id, {_null(3, "o_orderkey", "o_custkey + 1")} AS bom_id, o_custkey % 5 + 1 AS company_id, {_null(4, "o_orderkey", "o_orderdate + INTERVAL 30 DAY")} AS date_deadline,
        o_orderdate + INTERVAL 20 DAY AS date_finished, o_orderdate AS date_start, o_custkey % 25 + 1 AS location_dest_id, o_orderkey % 25 + 1 AS location_src_id,
        'MO' || {_text("o_orderkey - o_orderkey % 2")} AS name, CASE WHEN o_orderkey % 4 = 0 THEN 'Planner' WHEN o_orderkey % 4 = 1 THEN NULL ELSE 'SO' || {_text(ORDER)} END AS origin,
        o_orderkey % 15 + 1 AS picking_type_id, '0' AS priority, 2 * (o_custkey + 1) AS product_id, 1.0e0 AS product_qty, o_custkey % 50 + 1 AS product_uom_id, 0.0e0 AS qty_producing,
        {_null(5, "o_orderkey", "'assigned'")} AS reservation_state, CASE o_orderkey % 5 WHEN 0 THEN 'draft' WHEN 1 THEN 'cancel' WHEN 2 THEN 'done' ELSE 'confirmed' END AS state
        FROM orders WHERE o_orderstatus = 'P'""",
    "mrp_workorder": f"""SELECT li.id AS id, li.order_id AS production_id, 'WO' || {_text("li.id")} AS name, li.supp_id % 27 + 1 AS workcenter_id, {_null(3, "li.id", "li.part_id")} AS operation_id,
        CASE li.id % 4 WHEN 0 THEN 'pending' WHEN 1 THEN 'ready' WHEN 2 THEN 'done' ELSE 'progress' END AS state, {_null(2, "li.id", "li.shipdate")} AS date_start,
        {_null(4, "li.id", "li.shipdate + INTERVAL 2 DAY")} AS date_finished, li.qty AS duration_expected, {_null(5, "li.id", "li.qty / 2.0e0")} AS duration_unit,
        {_null(3, "li.id", "li.id % 2 = 0")} AS is_user_working, {_null(6, "li.id", "12.5e0")} AS employee_costs_hour
        FROM li JOIN orders ON li.order_id = o_orderkey + 1 WHERE o_orderstatus = 'P' AND li.line_no < 3""",
    "resource_calendar": f"SELECT {REGION_ID} AS id, {_null(4, REGION_ID, 'r_name')} AS name, 'UTC' AS tz FROM region",
    "resource_calendar_attendance": " UNION ALL ".join(
        f"""SELECT {NATION} * 10 + {n} AS id, {_null(9, NATION, REGION)} AS calendar_id, '{period}' AS day_period, CAST(n_nationkey % 7 AS STRING) AS dayofweek,
        CASE n_nationkey % 4 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN 'false' ELSE 'line_section' END AS display_type, {_null(3, NATION, "0.5e0")} AS duration_days,
        {_null(2, NATION, f"{n}.5e0")} AS duration_hours, {n}.0e0 AS hour_from, {_null(5, NATION, f"{n}.0e0 + 4.0e0")} AS hour_to, {_null(4, NATION, "'0'")} AS week_type FROM nation"""
        for n, period in ((8, "morning"), (7, "lunch"), (9, "afternoon"))
    ),
    "resource_calendar_leaves": f"""SELECT {NATION} AS id, {_null(5, NATION, REGION)} AS calendar_id, {REGION} AS company_id, CAST('1999-12-24 08:00:00' AS TIMESTAMP) AS date_from,
        CAST('1999-12-26 18:00:00' AS TIMESTAMP) AS date_to, 'Leave ' || n_name AS name, {_null(3, NATION, NATION)} AS resource_id, 'leave' AS time_type FROM nation""",
    "pos_session": f"""SELECT user_id * 100 + day(ts) AS id, 'POS/' || {_text("user_id")} AS name, 'closed' AS state, user_id % 3 + 1 AS config_id, user_id + 1 AS user_id,
        min(ts) AS start_at, {_null(4, "user_id", "max(ts)")} AS stop_at, 100.0e0 AS cash_register_balance_start, min(value) AS cash_register_balance_end_real,
        {_null(3, "user_id", "max(value)")} AS cash_real_transaction FROM events GROUP BY user_id, day(ts)""",
    "pos_order": f"""SELECT event_id + 1 AS id, 'Shop/' || {_text("event_id")} AS name, 'paid' AS state, ts AS date_order, {_null(3, "event_id", "2 * (user_id + 1)")} AS partner_id,
        user_id * 100 + day(ts) AS session_id, user_id % 3 + 1 AS config_id, value AS amount_total, value / 8.0e0 AS amount_tax, value AS amount_paid,
        {_null(5, "event_id", "event_id % 4 = 0")} AS is_refund, user_id % 5 + 1 AS company_id FROM events WHERE event_type = 'purchase'""",
    "pos_order_line": f"""SELECT event_id + 1 AS id, event_id + 1 AS order_id, 2 * (user_id + 1) AS product_id, 'Item ' || {_text("user_id")} AS full_product_name, 1.0e0 AS qty,
        {_null(3, "event_id", "value")} AS price_unit, {_null(4, "event_id", "value")} AS price_subtotal, {_null(5, "event_id", "value")} AS price_subtotal_incl,
        {_null(2, "event_id", "10.0e0")} AS discount, user_id % 5 + 1 AS company_id FROM events WHERE event_type = 'purchase'""",
    "mrp_production_schedule": f"""SELECT {PART} AS id, {_null(3, "p_partkey", PART)} AS bom_id, p_partkey % 5 + 1 AS company_id, {_null(4, "p_partkey", "p_size * 1.0e0")} AS forecast_target_qty,
        {_null(5, "p_partkey", "p_partkey % 2 = 0")} AS is_indirect, {_null(6, "p_partkey", "p_size / 2.0e0")} AS min_to_replenish_qty, {_null(7, "p_partkey", _big("p_size"))} AS mps_sequence,
        2 * {PART} AS product_id, 'manual' AS replenish_trigger, {_null(2, "p_partkey", "p_partkey % 30 + 1")} AS route_id, {_null(3, "p_partkey", "p_partkey % 100 + 1")} AS supplier_id,
        p_partkey % 5 + 1 AS warehouse_id FROM part WHERE p_partkey % 3 <> 1""",
    "mrp_product_forecast": f"""SELECT part_id * 100000 + month_no AS id, month_start AS date, {_null(4, "month_no", "total")} AS forecast_qty, {_null(3, "month_no", "month_no % 2 = 0")} AS procurement_launched,
        part_id AS production_schedule_id, {_null(5, "month_no", "total / 2.0e0")} AS replenish_qty, {_null(6, "month_no", "month_no % 3 = 0")} AS replenish_qty_updated
        FROM (SELECT part_id, CAST(date_trunc('month', shipdate) AS DATE) AS month_start, CAST(year(shipdate) * 12 + month(shipdate) AS BIGINT) AS month_no, sum(qty) AS total
              FROM li WHERE part_id % 3 <> 2 GROUP BY part_id, CAST(date_trunc('month', shipdate) AS DATE), year(shipdate) * 12 + month(shipdate)) months""",
    "quality_point": f"""SELECT id, {_null(5, "id", "id % 2 = 0")} AS active, id % 5 + 1 AS company_id, {_null(3, "id", "'all'")} AS measure_frequency_type, {_null(4, "id", "'product'")} AS measure_on,
        'QP' || {_text("id")} AS name, {_null(6, "id", "id / 2.0e0")} AS norm, {_null(2, "id", "'mm'")} AS norm_unit, {_null(3, "id", "id % 10")} AS sequence, id % 4 + 1 AS team_id,
        {_null(4, "id", "id % 7 + 1")} AS test_type_id, p_brand AS title, {_null(5, "id", "id * 1.0e0")} AS tolerance_max, {_null(7, "id", "id / 4.0e0")} AS tolerance_min,
        {_null(8, "id", "id % 3 + 1")} AS user_id FROM pbrand""",
    "quality_point_test_type": f"SELECT {REGION_ID} AS id, 'type_' || lower(r_name) AS technical_name FROM region",
    "quality_point_product_product_rel": f"""SELECT pbrand.id AS quality_point_id, 2 * {PART} AS product_product_id FROM part JOIN pbrand ON part.p_brand = pbrand.p_brand""",
    "quality_point_stock_picking_type_rel": f"""SELECT pbrand.id AS quality_point_id, {_big("r_regionkey")} * 3 + 2 AS stock_picking_type_id FROM pbrand
        JOIN region ON (pbrand.id + r_regionkey) % 2 = 0 WHERE pbrand.id % 3 <> 0""",
    "quality_check": f"""SELECT id, part_id % 30 + 1 AS point_id, supp_id % 5 + 1 AS company_id, {_null(3, "id", "shipdate")} AS control_date, {_null(4, "id", "price")} AS measure,
        {_null(2, "part_id", "'pass'")} AS measure_success, {_null(3, "id", "order_id")} AS picking_id, 2 * part_id AS product_id, {_null(5, "id", "0.0e0")} AS qty_failed, {_null(6, "id", "qty")} AS qty_passed,
        {_null(7, "id", "qty")} AS qty_tested, 'pass' AS quality_state, supp_id % 4 + 1 AS team_id, {_null(8, "id", "supp_id % 3 + 1")} AS user_id FROM li""",
    "ir_module_module": """SELECT DISTINCT module AS name, state, '19.0.1.' || CAST(version AS STRING) AS latest_version FROM (
        SELECT CASE r_regionkey WHEN 0 THEN 'base' WHEN 1 THEN 'stock' WHEN 2 THEN 'sale' WHEN 3 THEN 'purchase' ELSE 'mrp' END AS module,
        CASE WHEN r_regionkey = 4 THEN 'uninstalled' ELSE 'installed' END AS state, r_regionkey AS version FROM region) modules""",
    "res_lang": """SELECT CASE n_nationkey WHEN 0 THEN 'fr_FR' WHEN 1 THEN 'en_US' WHEN 2 THEN 'de_DE' ELSE 'x' || CAST(n_nationkey AS STRING) END AS code,
        n_nationkey < 3 AS active FROM nation""",
    # The planning inbox: one decision per order line, over the six kinds, an unknown kind and none.
    "decisions": f"""SELECT 'D' || {_text("id")} AS decision_id, 'run-1' AS run_uuid, shipdate AS decision_timestamp,
        CASE id % 8 WHEN 0 THEN 'PO' WHEN 1 THEN 'MO' WHEN 2 THEN 'DO' WHEN 3 THEN 'RESCHEDULE' WHEN 4 THEN 'ORDERPOINT' WHEN 5 THEN 'LEAD_TIME' WHEN 6 THEN 'FORECAST' END AS decision_type,
        'proposed' AS status, 'item ' || {_text("part_id")} AS item_name, CASE WHEN id % 17 = 0 THEN NULL WHEN id % 19 = 0 THEN 0 WHEN id % 23 = 0 THEN 2 * part_id + 1 ELSE 2 * part_id END AS _odoo_product_id,
        part_id % 50 + 1 AS _odoo_uom_id, CAST(NULL AS STRING) AS location_name, CASE WHEN id % 5 = 0 THEN NULL WHEN id % 7 = 0 THEN 0 WHEN id % 3 = 0 THEN (part_id - 1) % 25 + 1 ELSE part_id % 27 + 1 END AS _odoo_location_id,
        {_null(29, "id", "qty")} AS quantity, {_null(3, "id", "shipdate + INTERVAL 1 DAY")} AS start_date, {_null(6, "id", "shipdate + INTERVAL 9 DAY")} AS end_date,
        CAST(NULL AS STRING) AS supplier_name, CASE WHEN id % 13 = 0 THEN NULL WHEN id % 11 = 0 THEN 0 ELSE 2 * supp_id + 1 END AS _odoo_supplier_id,
        {_null(4, "id", "part_id")} AS _odoo_bom_id, {_null(9, "id", "'WH' || " + _text("supp_id % 6 + 1"))} AS origin_location, 'WH' || {_text("part_id % 6 + 1")} AS destination_location,
        'MO' || {_text("order_id - order_id % 2")} AS parent_reference, CAST(NULL AS STRING) AS workcenter_name, CAST(NULL AS BIGINT) AS _odoo_workcenter_id, CAST(NULL AS STRING) AS batch,
        CAST(NULL AS STRING) AS remark, {_null(10, "id", "qty")} AS min_quantity, {_null(14, "id", "qty * 2.0e0")} AS max_quantity, {_null(15, "id", "part_id % 30")} AS delay FROM li""",
    # Run and chunk log: one run per customer order, one chunk per line.
    "export_run": f"""SELECT {ORDER} AS id, 'u' || {_text(ORDER)} AS run_uuid, CASE o_orderstatus WHEN 'F' THEN 'done' WHEN 'P' THEN 'collecting' ELSE
        CASE o_orderkey % 3 WHEN 0 THEN 'error' WHEN 1 THEN 'pending' ELSE 'uploading' END END AS state, o_custkey % 5 + 1 AS company_id, o_orderdate AS started_at,
        CASE WHEN o_orderstatus = 'F' THEN o_orderdate + INTERVAL 1 HOUR END AS finished_at FROM orders""",
    "export_chunk": f"""SELECT id, order_id AS run_id, 'sale_order_line' AS collector, line_no AS sequence, CASE WHEN id % 5 = 0 THEN 'error' WHEN flag = 'A' THEN 'uploaded' WHEN flag = 'R' THEN 'created' ELSE 'pending' END AS state,
        CASE WHEN line_no = 1 THEN 0 ELSE id END AS key_from, id + 10 AS key_to, {_big("qty")} AS row_count, {_null(5, "id", "'boom'")} AS error_message FROM li""",
}

# Relations and columns that a version-18 source (or one with few add-ons) lacks.
ABSENT_RELATIONS_18 = ("mrp_skill", "quality_point_product_product_rel", "stock_route_product", "stock_package_type")
ABSENT_COLUMNS_18 = {
    "product_template": ("expiration_time", "is_storable", "sale_delay", "purchase_method", "use_expiration_date"),
    "resource_calendar_attendance": ("duration_hours",),
    "uom_uom": ("relative_uom_id", "parent_path", "relative_factor"),
    "stock_location": ("storage_category_id",),
    "stock_quant_package": ("pack_date", "location_id", "package_type_id", "shipping_weight"),
    "stock_lot": ("expiration_date", "use_date", "removal_date", "alert_date"),
    "stock_move": ("production_id", "sale_line_id", "purchase_line_id", "is_subcontract"),
    "stock_move_line": ("expiration_date",),
    "stock_warehouse_orderpoint": ("replenishment_uom_id", "qty_to_order_computed", "qty_to_order_manual", "supplier_id", "deadline_date"),
    "sale_order_line": ("product_uom_id",),
    "purchase_order_line": ("product_uom_id",),
    "product_supplierinfo": ("batching_window", "is_subcontractor"),
    "pos_order": ("is_refund",),
    "mrp_workcenter": ("default_capacity", "tool", "constrained", "owner", "post_operation_time", "employee_costs_hour"),
    "mrp_bom": ("product_qty_multiple", "days_to_prepare_mo"),
    "mrp_routing_workcenter": ("workcenter_quantity", "skill", "post_operation_time", "search_mode", "time_cycle"),
    "mrp_workorder": ("is_user_working", "employee_costs_hour"),
    "quality_point": ("measure_on", "measure_frequency_type", "norm", "tolerance_min", "tolerance_max", "norm_unit"),
    "quality_check": ("measure", "measure_success", "qty_tested", "qty_passed", "qty_failed"),
}


def needed(text: str) -> list[str]:
    """Relations that ``text`` reads, directly or through others, in an order to define them."""
    words = set(re.findall(r"\w+", text))
    seen: dict[str, None] = {}
    for name, query in RELATIONS.items():
        if name in words:
            for inner in needed(query):
                seen[inner] = None
            seen[name] = None
    return list(seen)


def with_relations(query: str, **steps: str) -> str:
    """``query`` preceded by the relations it reads and by the named ``steps``, in that order."""
    text = " ".join([*steps.values(), query])
    parts = [f"{name} AS ({RELATIONS[name]})" for name in needed(text)]
    parts += [f"{name} AS ({step})" for name, step in steps.items()]
    return f"WITH {', '.join(parts)} {query}" if parts else query


def derived_catalog(spark: SparkSession, sf_dir: str, variant: str = "19") -> Catalog:
    """The ERP relations over the test tables in ``sf_dir``; variant 18 lacks what old sources lack."""
    utc(spark)
    opened: dict[str, DataFrame] = {}

    def load(name: str) -> DataFrame:
        query = with_relations(f"SELECT * FROM {name}")
        for table in BASE_TABLES:
            if re.search(rf"\b{table}\b", query):
                if table not in opened:
                    opened[table] = spark.read.parquet(f"{sf_dir}/{table}.parquet")
                opened[table].createOrReplaceTempView(table)
        return spark.sql(query)

    return as_variant(Catalog({name: (lambda name=name: load(name)) for name in RELATIONS}), variant)


def as_variant(catalog: Catalog, variant: str) -> Catalog:
    """The catalog as a source of version 18 would have it."""
    if variant == "19":
        return catalog
    old = catalog.replacing(stock_quant_package=catalog["stock_package"]).without(("stock_package",))
    return old.without(ABSENT_RELATIONS_18, ABSENT_COLUMNS_18)
