"""Decision plans against a plain loop over the rows, record by record."""

import random
from datetime import datetime, timedelta

import pytest

from quayside.plans.writeback import PLANNERS, earlier_output, plan_decisions
from quayside.schemas import decision_schema
from quayside.sources.decisions import conform_decisions

COMPANY = 1
NAMES = decision_schema().names
DAY = datetime(2024, 1, 1)


def decision(n, kind, **fields):
    row = dict.fromkeys(NAMES) | {"decision_id": f"D{n:05d}", "decision_type": kind, "decision_timestamp": DAY + timedelta(minutes=n // 3)}
    return tuple((row | fields)[c] for c in NAMES)


RELATIONS = dict(
    product_product=("id long, product_tmpl_id long", [(10 + i, 100 + i // 2) for i in range(8)]),
    product_supplierinfo=("id long, partner_id long, product_tmpl_id long, min_qty double, price double, currency_id long",
                          [(i, 1 + i % 3, 100 + i % 4, float(i % 5 * 10), 1.0 * i, [None, 1, 2][i % 3]) for i in range(1, 40)]),
    stock_warehouse=("id long, code string", [(1, "A"), (2, "B"), (3, "C"), (4, "A"), (5, None)]),
    stock_location=("id long, warehouse_id long, usage string, name string",
                    [(1, 1, "internal", "Old Stock"), (2, 1, "internal", "Stock"), (3, 2, "internal", "Shelf"), (4, 2, "customer", "Stock"),
                     (5, 3, "internal", "stock"), (6, 3, "internal", "Stock 2"), (7, 5, "internal", "Stock")]),
    stock_picking_type=("id long, code string, default_location_src_id long", [(9, "internal", 1), (8, "internal", 1), (4, "outgoing", 6), (5, "internal", None)]),
    mrp_production=("id long, name string, state string, origin string, company_id long",
                    [(1, "MO1", "draft", "Planner x", 1), (2, "MO2", "cancel", "Planner", 1), (3, "MO2", "draft", None, 1), (4, "MO3", "done", "Planner", 1), (5, "MO4", "draft", "Planner", 2)]),
    mrp_workorder=("id long, production_id long, state string", [(1, 2, "progress"), (2, 2, "done"), (3, 4, "ready"), (4, 3, "progress")]),
    purchase_order=("id long, state string, origin string, company_id long",
                    [(1, "draft", "Planner 7", 1), (2, "done", "Planner", 1), (3, "draft", "aPlanner", 1), (4, "draft", "planner", 1), (5, "draft", None, 1), (6, "draft", "Planner", 2)]),
    stock_picking=("id long, state string, origin string, company_id long", [(1, "draft", "Planner", 2), (2, "done", "Planner", 1), (3, "draft", "SO1", 1)]),
    stock_warehouse_orderpoint=("id long, name string, product_id long, location_id long, company_id long",
                                [(1, "OP", 10, 1, 1), (2, "OP", 10, 2, 1), (3, "Planner-11", 11, 1, 1), (4, "Planner-12", 12, 1, 2), (5, None, 13, None, 1)]),
)


def random_decisions(seed, n=500):
    rng = random.Random(seed)
    pick = rng.choice
    out = []
    for i in range(n):
        out.append(decision(
            i, pick([*PLANNERS, *PLANNERS, "FORECAST", "X", None]), _odoo_product_id=pick([None, 0, 99, *range(10, 18)]), _odoo_uom_id=pick([1, 2]),
            _odoo_location_id=pick([None, 0, 1, 2, 3]), quantity=pick([None, 0.0, 5.0, 10.0, 25.0, 40.5]), start_date=pick([None, DAY + timedelta(days=i)]),
            end_date=pick([None, DAY + timedelta(days=i + 1)]), _odoo_supplier_id=pick([None, 0, 1, 2, 3, 9]), _odoo_bom_id=pick([None, 4]),
            origin_location=pick(["A", "A", "B", "C", "Z", None]), destination_location=pick(["A", "C", "C", "Z"]), parent_reference=pick(["MO1", "MO2", "MO3", "MO4", "no", None]),
            min_quantity=pick([None, 1.0, 2.0, float(i)]), max_quantity=pick([None, 9.0, float(i), float(i)]), delay=pick([None, 0, 3, i]),
        ))
    return out


def table(name):
    ddl, rows = RELATIONS[name]
    columns = [c.split()[0] for c in ddl.split(",")]
    return [dict(zip(columns, r, strict=True)) for r in rows]


def first(rows):
    return min(rows, key=lambda r: r["id"], default=None)


def loop(decisions, cleanup=True):
    """What applying the rows one after the other leads to."""
    rows = [dict(zip(NAMES, d, strict=True)) for d in decisions]
    by_kind = {}
    for r in sorted(rows, key=lambda r: (r["decision_timestamp"], r["decision_id"])):
        if r["decision_type"] is not None:
            by_kind.setdefault(r["decision_type"], []).append(r)
    template = {p["id"]: p["product_tmpl_id"] for p in table("product_product")}
    tiers = table("product_supplierinfo")
    out, outcome, messages = {}, {}, []
    for kind in by_kind.keys() - PLANNERS.keys():
        outcome[kind] = (0, 0, 1)
        messages.append((kind, None, f"Unknown decision type: {kind}"))

    headers, lines, nobody = {}, [], 0
    for i, r in enumerate(by_kind.get("PO", [])):
        if not r["_odoo_supplier_id"]:
            nobody += 1
            messages.append(("PO", i, f"Row {i}: missing supplier_id"))
            continue
        head = headers.setdefault(r["_odoo_supplier_id"], [None, 0])
        fits = [t for t in tiers if t["partner_id"] == r["_odoo_supplier_id"] and t["product_tmpl_id"] == template.get(r["_odoo_product_id"], -1)
                and r["quantity"] is not None and t["min_qty"] <= r["quantity"]]
        tier = min(fits, key=lambda t: (-t["min_qty"], t["id"]), default={"id": None, "price": None, "currency_id": None})
        head[0], head[1] = tier["currency_id"] or head[0], head[1] + 1
        lines.append((r["decision_id"], i, r["_odoo_supplier_id"], tier["id"], tier["price"], tier["currency_id"], r["end_date"]))
    out["orders"] = {k: tuple(v) for k, v in headers.items()}
    out["lines"] = sorted(lines)
    outcome["PO"], outcome["MO"] = (len(lines), 0, nobody), (len(by_kind.get("MO", [])), 0, 0)

    transfers, moves = {}, []
    for i, r in enumerate(by_kind.get("DO", [])):
        spots = []
        for code in (r["origin_location"], r["destination_location"]):
            house = first([w for w in table("stock_warehouse") if code is not None and w["code"] == code])
            spots.append(house and first([x for x in table("stock_location") if x["warehouse_id"] == house["id"] and x["usage"] == "internal" and "Stock" in x["name"]]))
        if not all(spots):
            continue
        kinds = [t for t in table("stock_picking_type") if t["code"] == "internal"]
        kind = first([t for t in kinds if t["default_location_src_id"] == spots[0]["id"]]) or first(kinds)
        key = (r["origin_location"], r["destination_location"])
        transfers.setdefault(key, [kind["id"], spots[0]["id"], spots[1]["id"], r["start_date"], 0])[4] += 1
        moves.append((r["decision_id"], f"Planner DO {i}", spots[0]["id"], spots[1]["id"]))
    out["transfers"], out["moves"] = {k: tuple(v) for k, v in transfers.items()}, sorted(moves)
    outcome["DO"] = (len(moves), 0, 0)

    dates, updated, errors = {}, 0, 0
    for r in by_kind.get("RESCHEDULE", []):
        mo = first([m for m in table("mrp_production") if r["parent_reference"] is not None and m["name"] == r["parent_reference"]])
        if mo is None:
            errors += 1
            continue
        busy = any(w["production_id"] == mo["id"] and w["state"] == "progress" for w in table("mrp_workorder"))
        seen = dates.setdefault(mo["id"], [None, None])
        if r["start_date"] and not busy:
            seen[0] = r["start_date"]
        seen[1] = r["end_date"] or seen[1]
        updated += 1
    out["dates"], outcome["RESCHEDULE"] = {k: tuple(v) for k, v in dates.items()}, (0, updated, errors)

    records = [p | {"new": False} for p in table("stock_warehouse_orderpoint")]
    if cleanup:
        records = [p for p in records if not ((p["name"] or "").startswith("Planner") and p["company_id"] == COMPANY)]
    created = updated = errors = 0
    for i, r in enumerate(by_kind.get("ORDERPOINT", [])):
        product, place = r["_odoo_product_id"], r["_odoo_location_id"]
        if not product or r["min_quantity"] is None or r["max_quantity"] is None:
            errors += 1
            messages.append(("ORDERPOINT", i, f"Row {i}: missing product_id, min_quantity, or max_quantity"))
            continue
        rule = first([p for p in records if p["product_id"] == product and (not place or p["location_id"] == place)])
        if rule is None:
            rule = {"id": 1000 + created, "product_id": product, "location_id": place or None, "new": True}
            records.append(rule)
            created += 1
        else:
            updated += 1
        rule |= {"min": r["min_quantity"], "max": r["max_quantity"]}
        rule["supplier"] = r["_odoo_supplier_id"] or rule.get("supplier")
    touched = [p for p in records if "min" in p]
    out["rule_updates"] = sorted((p["id"], p["min"], p["max"], p["supplier"]) for p in touched if not p["new"])
    out["rule_creates"] = sorted(((p["product_id"], p["location_id"], p["min"], p["max"], p["supplier"]) for p in touched if p["new"]), key=str)
    outcome["ORDERPOINT"] = (created, updated, errors)

    delays, updated, errors = {}, 0, 0
    for r in by_kind.get("LEAD_TIME", []):
        supplier, product = r["_odoo_supplier_id"], r["_odoo_product_id"]
        link = None
        if supplier and product and r["delay"] is not None and product in template:
            link = first([t for t in tiers if t["partner_id"] == supplier and t["product_tmpl_id"] == template[product]])
        if link is None:
            errors += 1
        else:
            delays[link["id"]] = r["delay"]
            updated += 1
    out["delays"], outcome["LEAD_TIME"] = delays, (0, updated, errors)
    return out, outcome, sorted(messages, key=str)


def collected(plan):
    w = {k: v.collect() for k, v in plan.writes.items()}
    return {
        "orders": {r.partner_id: (r.currency_id, r.line_count) for r in w["purchase_orders"]},
        "lines": sorted((r.decision_id, r.row_no, r.partner_id, r.supplierinfo_id, r.price_unit, r.tier_currency_id, r.date_planned) for r in w["purchase_order_lines"]),
        "transfers": {(r.origin_location, r.destination_location): (r.picking_type_id, r.location_id, r.location_dest_id, r.scheduled_date, r.move_count) for r in w["transfers"]},
        "moves": sorted((r.decision_id, r["name"], r.location_id, r.location_dest_id) for r in w["transfer_moves"]),
        "dates": {r.production_id: (r.date_start, r.date_finished) for r in w["production_dates"]},
        "rule_updates": sorted((r.orderpoint_id, r.product_min_qty, r.product_max_qty, r.supplier_id) for r in w["orderpoint_updates"]),
        "rule_creates": sorted(((r.product_id, r.location_id, r.product_min_qty, r.product_max_qty, r.supplier_id) for r in w["orderpoint_creates"]), key=str),
        "delays": {r.supplierinfo_id: r.delay for r in w["lead_times"]},
    }


@pytest.mark.parametrize("seed, cleanup", [(1, True), (2, False)])
def test_plans_against_a_loop(spark, source, seed, cleanup):
    rows = random_decisions(seed)
    plan = plan_decisions(spark.createDataFrame(rows, decision_schema()), source(**RELATIONS), COMPANY, cleanup=cleanup)
    want, outcome, messages = loop(rows, cleanup)
    got = collected(plan)
    for name, expected in want.items():
        assert got[name] == expected, name
    assert {r.decision_type: (r.created, r.updated, r.errors) for r in plan.outcome.collect()} == outcome
    assert sorted(map(tuple, plan.messages.collect()), key=str) == messages
    assert bool(plan.deletes) == cleanup


def test_unit_column_follows_the_variant(spark, source):
    rows = spark.createDataFrame([decision(1, "PO", _odoo_supplier_id=1, _odoo_uom_id=7)], decision_schema())
    for variant, column in (("18", "product_uom"), ("19", "product_uom_id")):
        line = plan_decisions(rows, source(variant, **RELATIONS), COMPANY).writes["purchase_order_lines"].first()
        assert line[column] == 7


def test_clean_up_lists_only_our_drafts(spark, source):
    stale = earlier_output(source(**RELATIONS), COMPANY)
    ids = {k: sorted(r.id for r in v.collect()) for k, v in stale.items()}
    assert ids == {
        "purchase_order": [1], "mrp_production": [1, 2], "stock_picking": [1], "stock_warehouse_orderpoint": [3],
    }
    only_po = spark.createDataFrame([decision(1, "PO"), decision(2, "LEAD_TIME")], decision_schema())
    assert set(plan_decisions(only_po, source(**RELATIONS), COMPANY).deletes) == {"purchase_order"}


def test_files_may_lack_columns(spark):
    df = spark.createDataFrame([("D1", "PO", 3)], "decision_id string, decision_type string, delay int")
    got = conform_decisions(df)
    assert got.schema.simpleString() == decision_schema().simpleString() and got.first().delay == 3


def test_empty_batch(spark, source):
    plan = plan_decisions(spark.createDataFrame([], decision_schema()), source(**RELATIONS), COMPANY)
    assert plan.outcome.count() == plan.messages.count() == 0 and plan.deletes == {}
    assert all(w.count() == 0 for w in plan.writes.values())
