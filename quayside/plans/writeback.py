"""Planning decisions turned into the record writes a loader applies.

Each planner takes the numbered decisions of its type and returns named tables of writes and the
counts of created, updated and failed rows. Where rows of one batch meet on a record, the last row
wins, field by field. "First match" lookups take the lowest id.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, replace
from functools import cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.functions.columns import attach
from quayside.functions.lookup import best_tier, last_by, lowest_id
from quayside.functions.numbering import of_group
from quayside.sources.catalog import Catalog, Erp
from quayside.sources.decisions import decision_types, ordered_decisions

ORIGIN = "Planner"


@dataclass
class Plan:
    """Writes by name, counts per kind, and messages about rows that could not be used.

    In a table of new records, ``_row`` is the first row that asked for the record.
    """

    writes: Mapping[str, DataFrame]
    counts: DataFrame
    messages: DataFrame | None = None


@dataclass
class Batch:
    """Everything a batch of decisions leads to.

    ``deletes`` holds the records of earlier batches to remove before the writes are applied. ``placed`` are the writes
    with ``_row`` wherever they are new records: the first row that asked for the record. A table is planned when it is
    first asked for, so counts alone run no lookup.
    """

    placed: Mapping[str, DataFrame]
    deletes: dict[str, DataFrame]
    outcome: DataFrame
    messages: DataFrame

    @property
    def writes(self) -> Mapping[str, DataFrame]:
        return Catalog({name: lambda name=name: self.placed[name].drop("_row") for name in self.placed})


def _given(column: str) -> Column:
    """A key that is neither missing nor 0."""
    return F.coalesce(F.col(column) != 0, F.lit(False))


def _counts(rows: DataFrame, kind: str, **counted: Column) -> DataFrame:
    """One row with the sums of ``counted``, or none for no rows."""
    sums = {name: counted.get(name, F.lit(0)) for name in ("created", "updated", "errors")}
    return rows.groupBy(F.lit(kind).alias("decision_type")).agg(
        *[F.sum(value.cast("bigint")).alias(name) for name, value in sums.items()]
    )


def plan_purchases(rows: DataFrame, erp: Erp, origin: str = ORIGIN) -> Plan:
    """One order per supplier, one line per decision, priced by the vendor's best tier.

    The order takes the currency of the last line whose tier has one. The line's price is that of
    its tier; without a tier it is left to the loader. A row without a supplier is an error: no order can be made for it.
    """
    ordered = _given("_odoo_supplier_id")
    messages = rows.filter(~ordered).select(
        "decision_type", "row_no", F.concat(F.lit("Row "), F.col("row_no").cast("string"), F.lit(": missing supplier_id")).alias("message")
    )
    wanted = rows.filter(ordered).select(
        "decision_id", "row_no", "_odoo_supplier_id", "_odoo_product_id", "quantity", "_odoo_uom_id", "end_date"
    )  # the lookup carries whole rows
    asked = attach(wanted, erp["product_product"], "_odoo_product_id", row_id="decision_id", product_tmpl_id="product_tmpl_id")
    tiers = erp["product_supplierinfo"].select(
        F.col("partner_id").alias("_odoo_supplier_id"),
        "product_tmpl_id",
        "min_qty",
        "id",
        F.col("id").alias("supplierinfo_id"),
        F.col("price").alias("price_unit"),
        F.col("currency_id").alias("tier_currency_id"),
    )
    unit = "product_uom" if erp.variant == "18" else "product_uom_id"

    @cache
    def lines() -> DataFrame:
        priced = best_tier(
            asked,
            tiers,
            ("_odoo_supplier_id", "product_tmpl_id"),
            "quantity",
            "min_qty",
            ("supplierinfo_id", "price_unit", "tier_currency_id"),
        )
        return priced.select(
            "decision_id",
            "row_no",
            F.col("_odoo_supplier_id").alias("partner_id"),
            F.col("_odoo_product_id").alias("product_id"),
            F.col("quantity").alias("product_qty"),
            F.col("_odoo_uom_id").alias(unit),
            F.col("end_date").alias("date_planned"),
            "supplierinfo_id",
            "price_unit",
            "tier_currency_id",
        )

    def orders() -> DataFrame:
        return lines().groupBy("partner_id").agg(
            F.lit(origin).alias("origin"),
            last_by("tier_currency_id", "row_no", F.col("tier_currency_id").isNotNull()).alias("currency_id"),
            F.count("*").alias("line_count"),
            F.min("row_no").alias("_row"),
        )

    writes = Catalog({"purchase_orders": orders, "purchase_order_lines": lines})
    return Plan(writes, _counts(rows, "PO", created=ordered, errors=~ordered), messages)


def plan_productions(rows: DataFrame, erp: Erp, origin: str = ORIGIN) -> Plan:
    """One production order per decision."""
    orders = rows.select(
        "decision_id",
        "row_no",
        F.col("_odoo_product_id").alias("product_id"),
        F.col("quantity").alias("product_qty"),
        F.col("_odoo_uom_id").alias("product_uom_id"),
        F.col("_odoo_bom_id").alias("bom_id"),
        F.col("start_date").alias("date_start"),
        F.col("end_date").alias("date_finished"),
        F.lit(0.0).alias("qty_producing"),
        F.lit(origin).alias("origin"),
        F.col("row_no").alias("_row"),
    )
    return Plan({"production_orders": orders}, _counts(rows, "MO", created=F.lit(1)))


def stock_places(erp: Erp) -> DataFrame:
    """Warehouse code with the internal stock location of its first warehouse."""
    internal = erp["stock_location"].filter((F.col("usage") == "internal") & F.col("name").contains("Stock"))
    places = lowest_id(internal, "warehouse_id", name="location_id")
    return lowest_id(erp["stock_warehouse"], "code", name="warehouse_id").join(places, "warehouse_id")


def transfer_types(erp: Erp) -> tuple[DataFrame, Column]:
    """Internal picking type by source location, and the one to use where a location has none."""
    internal = erp["stock_picking_type"].filter(F.col("code") == "internal")
    by_place = lowest_id(internal, "default_location_src_id", name="type_id")
    return by_place, internal.agg(F.min("id")).scalar()


def plan_transfers(rows: DataFrame, erp: Erp, origin: str = ORIGIN) -> Plan:
    """One transfer per pair of warehouses, one move per decision.

    Decisions whose warehouses or stock locations are unknown are skipped and count as nothing.
    """
    places = stock_places(erp)
    by_place, fallback = transfer_types(erp)

    def place(code: str, location: str) -> DataFrame:
        return places.select(F.col("code").alias(code), F.col("location_id").alias(location))

    usable = rows.join(place("origin_location", "location_id"), "origin_location")
    usable = usable.join(place("destination_location", "location_dest_id"), "destination_location")
    transfers = usable.groupBy("origin_location", "destination_location", "location_id", "location_dest_id").agg(
        F.min_by("start_date", "row_no").alias("scheduled_date"), F.count("*").alias("move_count"), F.min("row_no").alias("_row")
    )
    typed = transfers.join(by_place.withColumnRenamed("default_location_src_id", "location_id"), "location_id", "left")
    typed = typed.select(
        "origin_location",
        "destination_location",
        F.coalesce("type_id", fallback).alias("picking_type_id"),
        "location_id",
        "location_dest_id",
        "scheduled_date",
        "move_count",
        F.lit(origin).alias("origin"),
        "_row",
    )
    moves = usable.select(
        "decision_id",
        "row_no",
        "origin_location",
        "destination_location",
        F.col("_odoo_product_id").alias("product_id"),
        F.col("quantity").alias("product_uom_qty"),
        F.col("_odoo_uom_id").alias("product_uom"),
        "location_id",
        "location_dest_id",
        F.concat(F.lit(f"{origin} DO "), F.col("row_no").cast("string")).alias("name"),
        F.col("start_date").alias("date"),
        F.lit(origin).alias("origin"),
    )
    # Skipped rows still make the kind show up, with nothing counted.
    seen = _counts(rows, "DO").unionByName(_counts(usable, "DO", created=F.lit(1)))
    return Plan({"transfers": typed, "transfer_moves": moves}, seen)


def plan_reschedules(rows: DataFrame, erp: Erp, origin: str = ORIGIN) -> Plan:
    """New dates of production orders, found by name.

    A missing date is not written. Once any work order is in progress, only the end date is.
    """
    named = lowest_id(erp["mrp_production"], "name", name="production_id").withColumnRenamed("name", "parent_reference")
    busy = (
        erp["mrp_workorder"]
        .filter(F.col("state") == "progress")
        .select("production_id", F.lit(True).alias("busy"))
        .dropna()
        .distinct()
    )
    known = named.join(busy, "production_id", "left").withColumn("busy", F.coalesce("busy", F.lit(False)))
    found = rows.dropna(subset=["parent_reference"]).join(known, "parent_reference", "left")
    hit = F.col("production_id").isNotNull()
    updates = (
        found.filter(hit)
        .groupBy("production_id", "busy")
        .agg(
            last_by("start_date", "row_no", F.col("start_date").isNotNull() & ~F.col("busy")).alias("date_start"),
            last_by("end_date", "row_no", F.col("end_date").isNotNull()).alias("date_finished"),
        )
        .withColumnRenamed("busy", "in_progress")
    )
    counts = _counts(found, "RESCHEDULE", updated=hit, errors=~hit)
    counts = counts.unionByName(_counts(rows.filter("parent_reference IS NULL"), "RESCHEDULE", errors=F.lit(1)))
    return Plan({"production_dates": updates}, counts)


def plan_orderpoints(rows: DataFrame, erp: Erp, origin: str = ORIGIN) -> Plan:
    """Reorder rules to update or create.

    A row with a location means the rule of that product and place. A row without one means the
    product's first rule; if there is none yet, the rule that the batch's first row for the product
    creates.
    """
    usable = _given("_odoo_product_id") & F.col("min_quantity").isNotNull() & F.col("max_quantity").isNotNull()
    messages = rows.filter(~usable).select(
        "decision_type",
        "row_no",
        F.concat(
            F.lit("Row "), F.col("row_no").cast("string"), F.lit(": missing product_id, min_quantity, or max_quantity")
        ).alias("message"),
    )
    asked = rows.filter(usable).select(
        "row_no",
        F.col("_odoo_product_id").alias("product_id"),
        F.when(_given("_odoo_location_id"), F.col("_odoo_location_id")).alias("location_id"),
        F.when(_given("_odoo_supplier_id"), F.col("_odoo_supplier_id")).alias("supplier_id"),
        "min_quantity",
        "max_quantity",
    )
    points = erp["stock_warehouse_orderpoint"]
    at_place = lowest_id(points, "product_id", "location_id", name="place_rule")
    of_product = lowest_id(points, "product_id", name="product_rule")
    first = asked.groupBy("product_id").agg(F.min_by("location_id", "row_no").alias("first_location"))
    per_product = first.join(of_product, "product_id", "left")

    placed = F.col("location_id").isNotNull()
    targets = (
        asked.join(per_product, "product_id")
        .join(at_place, ["product_id", "location_id"], "left")
        .withColumn("orderpoint_id", F.when(placed, F.col("place_rule")).otherwise(F.col("product_rule")))
        .withColumn(
            "new_location", F.when(F.col("orderpoint_id").isNull(), F.coalesce("location_id", "first_location"))
        )
    )
    merged = targets.groupBy("orderpoint_id", "product_id", "new_location").agg(
        last_by("min_quantity", "row_no").alias("product_min_qty"),
        last_by("max_quantity", "row_no").alias("product_max_qty"),
        last_by("supplier_id", "row_no", F.col("supplier_id").isNotNull()).alias("supplier_id"),
        F.count("*").alias("row_count"),
        F.min("row_no").alias("_row"),
    )
    new = F.col("orderpoint_id").isNull()
    updates = merged.filter(~new).select("orderpoint_id", "product_min_qty", "product_max_qty", "supplier_id")
    creates = merged.filter(new).select(
        "product_id",
        F.col("new_location").alias("location_id"),
        "product_min_qty",
        "product_max_qty",
        "supplier_id",
        F.concat(F.lit(f"{origin}-"), F.col("product_id").cast("string")).alias("name"),
        "_row",
    )
    made = F.when(new, 1).otherwise(0)
    counts = _counts(merged, "ORDERPOINT", created=made, updated=F.col("row_count") - made)
    counts = counts.unionByName(_counts(messages, "ORDERPOINT", errors=F.lit(1)))
    return Plan({"orderpoint_updates": updates, "orderpoint_creates": creates}, counts, messages)


def plan_lead_times(rows: DataFrame, erp: Erp, origin: str = ORIGIN) -> Plan:
    """New delivery delays of existing vendor links; nothing is created."""
    usable = _given("_odoo_supplier_id") & _given("_odoo_product_id") & F.col("delay").isNotNull()
    links = lowest_id(erp["product_supplierinfo"], "partner_id", "product_tmpl_id", name="supplierinfo_id")
    links = links.withColumnRenamed("partner_id", "_odoo_supplier_id")
    asked = attach(
        rows.filter(usable), erp["product_product"], "_odoo_product_id", "inner", product_tmpl_id="product_tmpl_id"
    )
    found = asked.join(links, ["_odoo_supplier_id", "product_tmpl_id"])
    updates = found.groupBy("supplierinfo_id").agg(last_by("delay", "row_no").alias("delay"))
    # Every row that finds no link is an error: all rows count as one, the found ones take it back.
    counts = _counts(rows, "LEAD_TIME", errors=F.lit(1))
    counts = counts.unionByName(_counts(found, "LEAD_TIME", updated=F.lit(1), errors=F.lit(-1)))
    return Plan({"lead_times": updates}, counts)


# The decision kinds.
PLANNERS: dict[str, Callable[..., Plan]] = {
    "PO": plan_purchases,
    "MO": plan_productions,
    "DO": plan_transfers,
    "RESCHEDULE": plan_reschedules,
    "ORDERPOINT": plan_orderpoints,
    "LEAD_TIME": plan_lead_times,
}


def earlier_output(erp: Erp, company_id: int, origin: str = ORIGIN) -> dict[str, DataFrame]:
    """Records that an earlier batch left as drafts, by relation. Lead times and new dates are kept."""
    ours, company = F.col("origin").startswith(origin), F.col("company_id") == company_id
    draft = F.col("state") == "draft"
    return {
        "purchase_order": erp["purchase_order"].filter(draft & ours & company),
        "mrp_production": erp["mrp_production"].filter(F.col("state").isin("draft", "cancel") & ours & company),
        "stock_picking": erp["stock_picking"].filter(draft & ours),
        "stock_warehouse_orderpoint": erp["stock_warehouse_orderpoint"].filter(
            F.col("name").startswith(origin) & company
        ),
    }


# Which relation each kind cleans before it runs.
CLEANED = {
    "PO": "purchase_order",
    "MO": "mrp_production",
    "DO": "stock_picking",
    "ORDERPOINT": "stock_warehouse_orderpoint",
}


def unknown_types(decisions: DataFrame) -> DataFrame:
    """Types in the batch that no planner handles."""
    return decision_types(decisions).filter(~F.col("decision_type").isin(*PLANNERS))


def plan_decisions(
    decisions: DataFrame, erp: Erp, company_id: int, origin: str = ORIGIN, cleanup: bool = True
) -> Batch:
    """Route a batch of decisions to their planners.

    With ``cleanup`` the drafts of earlier batches are listed for deletion, and reorder rules among
    them no longer count as existing.
    """
    numbered = ordered_decisions(decisions, tuple(PLANNERS))
    deletes = {}
    if cleanup:
        stale = earlier_output(erp, company_id, origin)
        present = {kind for (kind,) in decision_types(numbered).filter(F.col("decision_type").isin(*CLEANED)).collect()}
        deletes = {relation: stale[relation].select("id") for kind, relation in CLEANED.items() if kind in present}
        relation = CLEANED["ORDERPOINT"]
        if relation in deletes:
            kept = erp[relation].join(deletes[relation], "id", "left_anti")
            erp = replace(erp, tables=erp.tables.replacing(**{relation: kept}))

    strays = unknown_types(numbered)
    counts = strays.select(
        "decision_type", *[F.lit(n).cast("bigint").alias(c) for c, n in (("created", 0), ("updated", 0), ("errors", 1))]
    )
    messages = strays.select(
        "decision_type",
        F.lit(None).cast("bigint").alias("row_no"),
        F.concat(F.lit("Unknown decision type: "), F.col("decision_type")).alias("message"),
    )
    writes: dict[str, Callable[[], DataFrame]] = {}
    for kind, planner in PLANNERS.items():
        plan = planner(of_group(numbered, "decision_type", kind), erp, origin)
        writes |= {name: lambda plan=plan, name=name: plan.writes[name] for name in plan.writes}
        counts = counts.unionByName(plan.counts)
        if plan.messages is not None:
            messages = messages.unionByName(plan.messages)
    outcome = counts.groupBy("decision_type").agg(*[F.sum(c).alias(c) for c in ("created", "updated", "errors")])
    return Batch(Catalog(writes), deletes, outcome, messages)
