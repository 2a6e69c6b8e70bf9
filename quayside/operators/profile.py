"""What a source holds: installed modules, data flags, counts, languages, mode."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.sources.catalog import Erp

# Flags by the module that must be installed.
MODULES = {
    "has_stock": "stock",
    "has_sale": "sale",
    "has_purchase": "purchase",
    "has_mrp": "mrp",
    "has_mrp_subcontracting": "mrp_subcontracting",
    "has_product_expiry": "product_expiry",
    "has_purchase_requisition": "purchase_requisition",
    "has_pos": "point_of_sale",
    "has_quality": "quality",
    "has_mrp_mps": "mrp_mps",
}


def _data_flags() -> dict[str, tuple[str, Column | None]]:
    """Flags by the relation that must hold a row, and the condition on it."""
    return {
        "has_inventory_data": ("stock_quant", (F.col("quantity") != 0) | (F.col("reserved_quantity") != 0)),
        "has_open_moves": ("stock_move", ~F.col("state").isin("done", "cancel")),
        "has_manufacturing_data": ("mrp_production", None),
        "has_orderpoint_data": ("stock_warehouse_orderpoint", None),
        "has_sale_data": ("sale_order_line", None),
        "has_purchase_data": ("purchase_order_line", None),
        "has_supplier_info": ("product_supplierinfo", None),
    }


def has_rows(erp: Erp, relation: str, where: Column | None = None) -> Column:
    """Whether a relation has a row that fits; a relation the source lacks has none.

    The limit lets each task stop at its first fitting row.
    """
    if relation not in erp.tables:
        return F.lit(False)
    rows = erp[relation] if where is None else erp[relation].filter(where)
    return rows.limit(1).agg(F.count("*") > 0).scalar()


def row_count(erp: Erp, relation: str) -> Column:
    """Rows of a relation as a scalar, 0 if the source lacks it."""
    return erp[relation].agg(F.count("*")).scalar() if relation in erp.tables else F.lit(0).cast("bigint")


def active_languages(erp: Erp) -> Column:
    """Codes of the active languages in code order; ``en_US`` if there is none."""
    codes = F.array_sort(F.collect_list("code"))
    found = erp["res_lang"].filter("active").agg(F.when(F.count("*") > 0, codes))
    return F.coalesce(found.scalar(), F.array(F.lit("en_US")))


def mode_of() -> Column:
    """The source's mode from its flags."""
    return (
        F.when(F.col("has_mrp") & F.col("has_manufacturing_data"), "manufacturing")
        .when(F.col("has_mrp"), "manufacturing_idle")
        .when(F.col("has_stock") & (F.col("has_sale_data") | F.col("has_purchase_data")), "inventory")
        .otherwise("minimal")
    )


def profile(erp: Erp) -> DataFrame:
    """One row that describes the source."""
    installed = erp["ir_module_module"].filter(F.col("state") == "installed")
    names = installed.agg(F.collect_set(F.when(F.col("name").isin(*MODULES.values()), F.col("name")))).scalar()
    facts = {flag: F.array_contains(names, name) for flag, name in MODULES.items()}
    facts |= {flag: has_rows(erp, relation, where) for flag, (relation, where) in _data_flags().items()}
    base = installed.filter(F.col("name") == "base").agg(F.min("latest_version"))
    facts |= {
        "source_version": F.coalesce(base.scalar(), F.lit("")),
        "company_count": row_count(erp, "res_company"),
        "warehouse_count": row_count(erp, "stock_warehouse"),
        "active_languages": active_languages(erp),
    }
    one = installed.sparkSession.range(1)
    return one.select(*[c.alias(n) for n, c in facts.items()]).withColumn("mode", mode_of())


# How the manifest names the flags.
_CAPABILITIES = {
    "modules": {
        "stock": "has_stock", "sale": "has_sale", "purchase": "has_purchase", "mrp": "has_mrp", "mrp_subcontracting": "has_mrp_subcontracting",
        "mrp_mps": "has_mrp_mps", "product_expiry": "has_product_expiry", "pos": "has_pos", "quality": "has_quality",
    },
    "data": {
        "inventory": "has_inventory_data", "open_moves": "has_open_moves", "manufacturing": "has_manufacturing_data",
        "orderpoints": "has_orderpoint_data", "sales": "has_sale_data", "purchases": "has_purchase_data", "supplier_info": "has_supplier_info",
    },
}


def capabilities(erp: Erp, database: str = "") -> DataFrame:
    """The profile as a manifest shows it: one row with the groups ``modules``, ``data`` and ``languages``.

    The second and third language are NULL if the source has fewer; the first falls back to ``en_US``.
    """
    groups = [F.struct(*[F.col(flag).alias(n) for n, flag in names.items()]).alias(group) for group, names in _CAPABILITIES.items()]
    codes = F.col("active_languages")
    first = F.coalesce(F.get(codes, F.lit(0)), F.lit("en_US")).alias("lang1")
    rest = [F.get(codes, F.lit(i)).alias(f"lang{i + 1}") for i in (1, 2)]
    return profile(erp).select(
        "mode",
        F.col("source_version").alias("odoo_version"),
        F.lit(database).alias("database"),
        *groups,
        F.col("warehouse_count").alias("warehouses"),
        F.col("company_count").alias("companies"),
        F.struct(codes.alias("active"), first, *rest).alias("languages"),
    )


def languages(erp: Erp) -> tuple[str, ...]:
    """The active languages for an :class:`Erp`; a handful of codes."""
    spark = erp["res_lang"].sparkSession
    return tuple(spark.range(1).select(active_languages(erp).alias("codes")).first().codes)


def modules(erp: Erp) -> tuple[str, ...]:
    """The installed modules for an :class:`Erp`; some hundreds of names."""
    installed = erp["ir_module_module"].filter(F.col("state") == "installed")
    return tuple(sorted(r.name for r in installed.select("name").dropna().distinct().collect()))
