"""Exports every source has: units, partners, products, calendars, companies, currencies."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.functions.columns import attach, conform, fill, json_text, language_key, optional
from quayside.functions.lists import attach_lists
from quayside.operators.names import translated
from quayside.operators.registry import exports
from quayside.sources.catalog import Erp


@exports("uom")
def uom(erp: Erp) -> DataFrame:
    """Units of measure. Version 18 has no unit hierarchy: those columns are NULL."""
    units = erp["uom_uom"]
    if erp.variant == "18":
        gone = ("relative_uom_id", "parent_path", "relative_factor")
        units = units.withColumns({c: F.lit(None) for c in gone})
    return conform(units, "uom", _odoo_uom_id="id", name=translated(erp, "name"))


@exports("partner")
def partner(erp: Erp) -> DataFrame:
    people = fill(erp["res_partner"], customer_rank=0, supplier_rank=0)
    named = attach(people, erp["res_partner"], "parent_id", parent_name="name")
    return conform(named, "partner", _odoo_partner_id="id")


@exports("product")
def product(erp: Erp) -> DataFrame:
    """Product variants with template, unit, category and route lists.

    The cost is stored per company but, as in the reference data, looked up by language; set
    ``Erp.price_key`` to a company id to read a real company's cost.
    """
    first = language_key(erp.lang(1))
    template = optional(
        fill(erp["product_template"], list_price=0.0),
        expiration_time=0.0,
        is_storable=False,
        sale_delay=0.0,
        purchase_method=None,
        use_expiration_date=False,
    ).withColumns(
        {
            "name": json_text("name", first),
            "name_lang2": json_text("name", language_key(erp.lang(2))),
            "name_lang3": json_text("name", language_key(erp.lang(3))),
            "description_sale": json_text("description_sale", first),
            "product_type": F.col("type"),
        }
    )
    units = attach(
        template, erp["uom_uom"], "uom_id", "inner", uom_name=translated(erp, "name"), uom_factor="factor"
    )
    described = attach(units, erp["product_category"], "categ_id", category_name="complete_name")
    described = described.drop("product_tmpl_id", "template_active")
    described = described.withColumnsRenamed({"id": "product_tmpl_id", "active": "template_active"})

    variant = erp["product_product"]
    cost = json_text("standard_price", erp.price_key or first).cast("double")
    variant = variant.withColumn("standard_price", cost)
    variant = fill(variant.withColumns({c: F.col(c).cast("double") for c in ("weight", "volume")}),
                   standard_price=0.0, weight=0.0, volume=0.0)
    own = [c for c in ("id", "active", "barcode", "default_code", "standard_price", "weight", "volume") if c in variant.columns]
    rows = variant.select("product_tmpl_id", *own).join(described.drop(*own), "product_tmpl_id")
    if "stock_route_product" in erp.tables and "stock_route" in erp.tables:
        links = attach(
            erp["stock_route_product"], erp["stock_route"], "route_id", "inner", route_name=translated(erp, "name")
        )
        rows = attach_lists(
            rows, "id", links, "product_id", "route_id", route_ids="route_id", route_names="route_name"
        )
    else:
        rows = rows.withColumns({"route_ids": F.lit(""), "route_names": F.lit("")})
    label = F.concat(F.coalesce("default_code", F.lit("")), F.lit(" "), F.coalesce("name", F.lit("")))
    return conform(rows, "product", _odoo_product_id="id", _odoo_template_id="product_tmpl_id", display_name=label)


@exports("product_category")
def product_category(erp: Erp) -> DataFrame:
    """Categories; the removal strategy's name is read in the first language."""
    removal = erp["product_removal"]
    rows = attach(
        erp["product_category"],
        removal,
        "removal_strategy_id",
        removal_strategy_name=translated(erp, "name"),
    )
    return conform(
        rows,
        "product_category",
        _odoo_categ_id="id",
        valuation=translated(erp, "property_valuation"),
        cost_method=translated(erp, "property_cost_method"),
    )


@exports("calendar")
def calendar(erp: Erp) -> DataFrame:
    """Working-hour lines of each calendar; section and note lines are left out."""
    lines = erp["resource_calendar_attendance"]
    kind = F.col("display_type")
    lines = lines.filter(kind.isNull() | kind.isin("", "false"))
    span = F.col("duration_hours") if "duration_hours" in lines.columns else F.col("hour_to") - F.col("hour_from")
    lines = fill(lines.withColumn("duration_hours", span), duration_days=0.0, duration_hours=0.0)
    rows = attach(lines, erp["resource_calendar"], "calendar_id", "inner", title="name", timezone="tz")
    return conform(
        rows,
        "calendar",
        calendar_name=F.concat("title", F.lit(" "), F.col("calendar_id").cast("string")),
        _odoo_attendance_id="id",
        is_working=F.coalesce(F.col("day_period").isin("morning", "afternoon"), F.lit(False)),
        day_of_week=F.col("dayofweek").cast("int"),
    )


@exports("calendar_leaves")
def calendar_leaves(erp: Erp) -> DataFrame:
    return conform(erp["resource_calendar_leaves"], "calendar_leaves", _odoo_leave_id="id")


@exports("company")
def company(erp: Erp) -> DataFrame:
    rows = attach(fill(erp["res_company"], security_lead=0.0), erp["res_partner"], "partner_id", country_id="country_id")
    return conform(rows, "company", _odoo_company_id="id")


@exports("country")
def country(erp: Erp) -> DataFrame:
    return conform(erp["res_country"], "country", _odoo_country_id="id", name=translated(erp, "name"))


@exports("currency")
def currency(erp: Erp) -> DataFrame:
    """One row per exchange rate; a currency without rates keeps one row with NULL rate columns."""
    rates = erp["res_currency_rate"].select(
        F.col("currency_id"),
        F.col("id").alias("rate_id"),
        "rate",
        F.col("name").alias("rate_date"),
        F.col("company_id").alias("rate_company_id"),
    )
    known = erp["res_currency"].drop(*rates.columns).withColumnRenamed("id", "currency_id")
    return conform(known.join(rates, "currency_id", "left"), "currency")
