"""Decision plans with their SQL twins."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.exports import erp
from quayside.functions.lookup import best_tier
from quayside.plans.writeback import earlier_output, plan_decisions, stock_places, transfer_types
from quayside.sources.decisions import conform_decisions, decision_types, ordered_decisions
from quayside.sources.driver_tables import with_relations

COMPANY = 1

NUMBERED = """SELECT *, row_number() OVER (PARTITION BY decision_type ORDER BY decision_timestamp, decision_id) - 1 AS row_no
    FROM decisions WHERE decision_type IS NOT NULL"""

# For every purchase decision the best tier, found by ranking all tiers at or below the quantity.
PRICED = """SELECT d.*, t.id AS supplierinfo_id, t.price AS price_unit, t.currency_id AS tier_currency_id FROM numbered AS d
    LEFT JOIN product_product AS p ON p.id = d._odoo_product_id
    LEFT JOIN product_supplierinfo AS t ON t.partner_id = d._odoo_supplier_id AND t.product_tmpl_id = p.product_tmpl_id AND t.min_qty <= d.quantity
    WHERE d.decision_type = 'PO' AND ifnull(d._odoo_supplier_id, 0) <> 0 QUALIFY row_number() OVER (PARTITION BY d.decision_id ORDER BY t.min_qty DESC NULLS LAST, t.id) = 1"""

PLACES = """SELECT code, (SELECT min(l.id) FROM stock_location AS l WHERE l.warehouse_id = w.first_id AND l.usage = 'internal' AND l.name LIKE '%Stock%') AS location_id
    FROM (SELECT code, min(id) AS first_id FROM stock_warehouse GROUP BY code) AS w"""

USABLE = """SELECT d.*, a.location_id, b.location_id AS location_dest_id FROM numbered AS d JOIN places AS a ON a.code = d.origin_location
    JOIN places AS b ON b.code = d.destination_location WHERE d.decision_type = 'DO' AND a.location_id IS NOT NULL AND b.location_id IS NOT NULL"""

FOUND = """SELECT d.*, mo.production_id, EXISTS (SELECT 1 FROM mrp_workorder AS w WHERE w.production_id = mo.production_id AND w.state = 'progress') AS busy
    FROM numbered AS d LEFT JOIN (SELECT name, min(id) AS production_id FROM mrp_production GROUP BY name) AS mo ON mo.name = d.parent_reference
    WHERE d.decision_type = 'RESCHEDULE'"""

KEPT = f"SELECT * FROM stock_warehouse_orderpoint WHERE NOT (name LIKE 'Planner%' AND company_id = {COMPANY})"

ASKED = """SELECT row_no, _odoo_product_id AS product_id, nullif(_odoo_location_id, 0) AS location_id, nullif(_odoo_supplier_id, 0) AS supplier_id,
    min_quantity, max_quantity FROM numbered WHERE decision_type = 'ORDERPOINT' AND ifnull(_odoo_product_id, 0) <> 0
    AND min_quantity IS NOT NULL AND max_quantity IS NOT NULL"""

TARGETS = """SELECT a.*, CASE WHEN a.location_id IS NULL THEN (SELECT min(k.id) FROM kept AS k WHERE k.product_id = a.product_id)
    ELSE (SELECT min(k.id) FROM kept AS k WHERE k.product_id = a.product_id AND k.location_id = a.location_id) END AS rule_id,
    first_value(a.location_id) OVER (PARTITION BY a.product_id ORDER BY a.row_no) AS first_location FROM asked AS a"""

MERGED = """SELECT DISTINCT rule_id, product_id, new_location, last_value(min_quantity) OVER w AS product_min_qty, last_value(max_quantity) OVER w AS product_max_qty,
    last_value(supplier_id IGNORE NULLS) OVER w AS supplier_id, count(*) OVER w AS row_count
    FROM (SELECT *, CASE WHEN rule_id IS NULL THEN ifnull(location_id, first_location) END AS new_location FROM targets) AS t
    WINDOW w AS (PARTITION BY rule_id, CASE WHEN rule_id IS NULL THEN product_id END, new_location ORDER BY row_no ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)"""

LEADS = """SELECT d.*, (SELECT min(t.id) FROM product_supplierinfo AS t JOIN product_product AS p ON p.product_tmpl_id = t.product_tmpl_id
    WHERE p.id = d._odoo_product_id AND t.partner_id = d._odoo_supplier_id AND d._odoo_supplier_id <> 0 AND d._odoo_product_id <> 0 AND d.delay IS NOT NULL) AS supplierinfo_id
    FROM numbered AS d WHERE d.decision_type = 'LEAD_TIME'"""

STEPS = {
    "numbered": NUMBERED, "priced": PRICED, "places": PLACES, "usable": USABLE, "found": FOUND, "kept": KEPT,
    "asked": ASKED, "targets": TARGETS, "merged": MERGED, "leads": LEADS,
}


def _sql(query: str, *steps: str) -> str:
    return with_relations(query, **{name: STEPS[name] for name in steps})


def rules_kept() -> str:
    """The rules that the decisions make while all existing ones are kept."""
    steps = {name: STEPS[name] for name in ("numbered", "asked", "targets", "merged")} | {"kept": "SELECT * FROM stock_warehouse_orderpoint"}
    order = ("numbered", "kept", "asked", "targets", "merged")
    query = "SELECT product_id, new_location AS location_id, product_min_qty, product_max_qty, supplier_id FROM merged WHERE rule_id IS NULL"
    return with_relations(query, **{name: steps[name] for name in order})


def _batch(spark, sf_dir, variant="19"):
    source = erp(spark, sf_dir, variant)
    return plan_decisions(source["decisions"], source, COMPANY)


def _write(name, variant="19"):
    return lambda spark, sf_dir: _batch(spark, sf_dir, variant).writes[name]


def _stale(relation):
    return lambda spark, sf_dir: earlier_output(erp(spark, sf_dir), COMPANY)[relation].select("id")


def _kept(spark, sf_dir):
    source = erp(spark, sf_dir)
    gone = earlier_output(source, COMPANY)["purchase_order"]
    return source["purchase_order"].join(gone, "id", "left_anti").select("id", "name", "state", "origin")


def _tier_lookup(spark, sf_dir):
    """Best tier for the quantity of every sales order line, by the main vendor of its product."""
    source = erp(spark, sf_dir)
    asks = source["li"].select("id", "part_id", F.col("supp_id").alias("vendor"), "qty")
    tiers = source["product_supplierinfo"].withColumns(
        {"part_id": F.col("product_tmpl_id"), "vendor": F.expr("(partner_id - 1) div 2"), "tier_id": F.col("id")}
    )
    return best_tier(asks, tiers, ("part_id", "vendor"), "qty", "min_qty", ("tier_id", "price"))


def _picking_type_lookup(spark, sf_dir):
    source = erp(spark, sf_dir)
    by_place, fallback = transfer_types(source)
    moves = source["stock_move"].select("id", F.col("location_id").alias("default_location_src_id"))
    found = moves.join(by_place, "default_location_src_id", "left")
    return found.select("id", F.coalesce("type_id", fallback).alias("picking_type_id"))


def _numbered(spark, sf_dir):
    rows = ordered_decisions(erp(spark, sf_dir)["decisions"])
    return rows.select("decision_id", "decision_type", "row_no")


DECISION_COLUMNS = """decision_id, run_uuid, decision_timestamp, decision_type, status, item_name, _odoo_product_id, _odoo_uom_id, location_name, _odoo_location_id,
    quantity, start_date, end_date, supplier_name, _odoo_supplier_id, _odoo_bom_id, origin_location, destination_location, parent_reference, workcenter_name,
    _odoo_workcenter_id, batch, remark, min_quantity, max_quantity, delay"""

LINES = """SELECT decision_id, row_no, _odoo_supplier_id AS partner_id, _odoo_product_id AS product_id, quantity AS product_qty, _odoo_uom_id AS {unit},
    end_date AS date_planned, supplierinfo_id, price_unit, tier_currency_id FROM priced"""


def queries():
    return {
        "decisions_conformed": lambda s, d: conform_decisions(erp(s, d)["decisions"]),
        "decisions_numbered": _numbered,
        "decision_types": lambda s, d: decision_types(erp(s, d)["decisions"]),
        "decision_outcome": lambda s, d: _batch(s, d).outcome,
        "decision_messages": lambda s, d: _batch(s, d).messages,
        "plan_purchase_orders": _write("purchase_orders"),
        "plan_purchase_order_lines_19": _write("purchase_order_lines"),
        "plan_purchase_order_lines_18": _write("purchase_order_lines", "18"),
        "plan_production_orders": _write("production_orders"),
        "plan_transfers": _write("transfers"),
        "plan_transfer_moves": _write("transfer_moves"),
        "plan_production_dates": _write("production_dates"),
        "plan_orderpoint_updates": _write("orderpoint_updates"),
        "plan_orderpoint_creates": _write("orderpoint_creates"),
        "plan_lead_times": _write("lead_times"),
        "cleanup_purchase_orders": _stale("purchase_order"),
        "cleanup_production_orders": _stale("mrp_production"),
        "cleanup_transfers": _stale("stock_picking"),
        "cleanup_orderpoints": _stale("stock_warehouse_orderpoint"),
        "cleanup_kept_purchase_orders": _kept,
        "lookup_best_tier": _tier_lookup,
        "lookup_stock_places": lambda s, d: stock_places(erp(s, d)),
        "lookup_picking_type": _picking_type_lookup,
    }


def oracle_sql():
    ours = "origin LIKE 'Planner%'"
    return {
        "decisions_conformed": _sql(f"SELECT {DECISION_COLUMNS} FROM decisions"),
        "decisions_numbered": _sql("SELECT decision_id, decision_type, row_no FROM numbered", "numbered"),
        "decision_types": _sql("SELECT DISTINCT decision_type FROM decisions WHERE decision_type IS NOT NULL"),
        "decision_outcome": _sql(
            """SELECT decision_type, count(*) AS created, 0 AS updated, 0 AS errors FROM numbered WHERE decision_type = 'MO' GROUP BY decision_type
            UNION ALL SELECT 'PO', count(*) FILTER (WHERE ifnull(_odoo_supplier_id, 0) <> 0), 0, count(*) FILTER (WHERE ifnull(_odoo_supplier_id, 0) = 0)
                FROM numbered WHERE decision_type = 'PO'
            UNION ALL SELECT 'DO', count(*), 0, 0 FROM usable
            UNION ALL SELECT 'RESCHEDULE', 0, count(production_id), count(*) - count(production_id) FROM found
            UNION ALL SELECT 'ORDERPOINT', (SELECT count(*) FROM merged WHERE rule_id IS NULL), (SELECT count(*) FROM asked) - (SELECT count(*) FROM merged WHERE rule_id IS NULL),
                (SELECT count(*) FROM numbered WHERE decision_type = 'ORDERPOINT') - (SELECT count(*) FROM asked)
            UNION ALL SELECT 'LEAD_TIME', 0, count(supplierinfo_id), count(*) - count(supplierinfo_id) FROM leads
            UNION ALL SELECT DISTINCT decision_type, 0, 0, 1 FROM numbered WHERE decision_type = 'FORECAST'""",
            "numbered", "places", "usable", "found", "kept", "asked", "targets", "merged", "leads",
        ),
        "decision_messages": _sql(
            """SELECT decision_type, row_no, 'Row ' || row_no || ': missing product_id, min_quantity, or max_quantity' AS message FROM numbered
            WHERE decision_type = 'ORDERPOINT' AND row_no NOT IN (SELECT row_no FROM asked)
            UNION ALL SELECT decision_type, row_no, 'Row ' || row_no || ': missing supplier_id' FROM numbered
            WHERE decision_type = 'PO' AND ifnull(_odoo_supplier_id, 0) = 0
            UNION ALL SELECT DISTINCT decision_type, CAST(NULL AS BIGINT), 'Unknown decision type: ' || decision_type FROM numbered WHERE decision_type = 'FORECAST'""",
            "numbered", "asked",
        ),
        "plan_purchase_orders": _sql(
            """SELECT _odoo_supplier_id AS partner_id, 'Planner' AS origin, arg_max(tier_currency_id, row_no) FILTER (WHERE tier_currency_id IS NOT NULL) AS currency_id,
            count(*) AS line_count FROM priced GROUP BY _odoo_supplier_id""",
            "numbered", "priced",
        ),
        "plan_purchase_order_lines_19": _sql(LINES.format(unit="product_uom_id"), "numbered", "priced"),
        "plan_purchase_order_lines_18": _sql(LINES.format(unit="product_uom"), "numbered", "priced"),
        "plan_production_orders": _sql(
            """SELECT decision_id, row_no, _odoo_product_id AS product_id, quantity AS product_qty, _odoo_uom_id AS product_uom_id, _odoo_bom_id AS bom_id,
            start_date AS date_start, end_date AS date_finished, 0.0e0 AS qty_producing, 'Planner' AS origin FROM numbered WHERE decision_type = 'MO'""",
            "numbered",
        ),
        "plan_transfers": _sql(
            """SELECT origin_location, destination_location, ifnull((SELECT min(k.id) FROM stock_picking_type AS k WHERE k.code = 'internal' AND k.default_location_src_id = t.location_id),
            (SELECT min(k.id) FROM stock_picking_type AS k WHERE k.code = 'internal')) AS picking_type_id, location_id, location_dest_id, start_date AS scheduled_date,
            move_count, 'Planner' AS origin FROM (SELECT *, count(*) OVER (PARTITION BY origin_location, destination_location) AS move_count FROM usable
            QUALIFY row_number() OVER (PARTITION BY origin_location, destination_location ORDER BY row_no) = 1) AS t""",
            "numbered", "places", "usable",
        ),
        "plan_transfer_moves": _sql(
            """SELECT decision_id, row_no, origin_location, destination_location, _odoo_product_id AS product_id, quantity AS product_uom_qty, _odoo_uom_id AS product_uom,
            location_id, location_dest_id, 'Planner DO ' || row_no AS name, start_date AS date, 'Planner' AS origin FROM usable""",
            "numbered", "places", "usable",
        ),
        "plan_production_dates": _sql(
            """SELECT production_id, busy AS in_progress, CASE WHEN NOT busy THEN arg_max(start_date, row_no) END AS date_start, arg_max(end_date, row_no) AS date_finished
            FROM found WHERE production_id IS NOT NULL GROUP BY production_id, busy""",
            "numbered", "found",
        ),
        "plan_orderpoint_updates": _sql(
            "SELECT rule_id AS orderpoint_id, product_min_qty, product_max_qty, supplier_id FROM merged WHERE rule_id IS NOT NULL",
            "numbered", "kept", "asked", "targets", "merged",
        ),
        "plan_orderpoint_creates": _sql(
            """SELECT product_id, new_location AS location_id, product_min_qty, product_max_qty, supplier_id, 'Planner-' || product_id AS name FROM merged WHERE rule_id IS NULL""",
            "numbered", "kept", "asked", "targets", "merged",
        ),
        "plan_lead_times": _sql(
            "SELECT supplierinfo_id, arg_max(delay, row_no) AS delay FROM leads WHERE supplierinfo_id IS NOT NULL GROUP BY supplierinfo_id", "numbered", "leads"
        ),
        "cleanup_purchase_orders": _sql(f"SELECT id FROM purchase_order WHERE state = 'draft' AND {ours} AND company_id = {COMPANY}"),
        "cleanup_production_orders": _sql(f"SELECT id FROM mrp_production WHERE (state = 'draft' OR state = 'cancel') AND {ours} AND company_id = {COMPANY}"),
        "cleanup_transfers": _sql(f"SELECT id FROM stock_picking WHERE state = 'draft' AND {ours}"),
        "cleanup_orderpoints": _sql(f"SELECT id FROM stock_warehouse_orderpoint WHERE name LIKE 'Planner%' AND company_id = {COMPANY}"),
        "cleanup_kept_purchase_orders": _sql(
            f"SELECT id, name, state, origin FROM purchase_order WHERE NOT ifnull(state = 'draft' AND {ours} AND company_id = {COMPANY}, FALSE)"
        ),
        "lookup_best_tier": _sql(
            """SELECT li.id, li.part_id, li.supp_id AS vendor, li.qty, t.id AS tier_id, t.price FROM li LEFT JOIN product_supplierinfo AS t
            ON t.product_tmpl_id = li.part_id AND t.partner_id = 2 * li.supp_id + 1 AND t.min_qty <= li.qty
            QUALIFY row_number() OVER (PARTITION BY li.id ORDER BY t.min_qty DESC NULLS LAST, t.id) = 1"""
        ),
        "lookup_stock_places": _sql(
            """SELECT places.code, (SELECT min(w.id) FROM stock_warehouse AS w WHERE w.code = places.code) AS warehouse_id, location_id FROM places
            WHERE location_id IS NOT NULL""",
            "places",
        ),
        "lookup_picking_type": _sql(
            """SELECT m.id, ifnull((SELECT min(k.id) FROM stock_picking_type AS k WHERE k.code = 'internal' AND k.default_location_src_id = m.location_id),
            (SELECT min(k.id) FROM stock_picking_type AS k WHERE k.code = 'internal')) AS picking_type_id FROM stock_move AS m"""
        ),
    }
