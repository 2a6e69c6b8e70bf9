"""Small shared dimensions: translated names by id.

Each is one row per id with only the columns facts need, so that a fact joins once per key
instead of walking a chain of tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.functions.columns import json_text, language_key
from quayside.sources.catalog import Erp


def translated(erp: Erp, field: str):
    """Text of a translated field in the first language."""
    return json_text(field, language_key(erp.lang(1)))


def product_names(erp: Erp) -> DataFrame:
    """Variant id with its template, name and code; variants without a template drop out."""
    template = erp["product_template"].select(
        F.col("id").alias("product_tmpl_id"), translated(erp, "name").alias("product_name")
    )
    variant = erp["product_product"].select("id", "product_tmpl_id", F.col("default_code").alias("product_code"))
    return variant.join(template, "product_tmpl_id")


def template_names(erp: Erp) -> DataFrame:
    return erp["product_template"].select("id", translated(erp, "name").alias("product_name"))


def uom_names(erp: Erp) -> DataFrame:
    return erp["uom_uom"].select("id", translated(erp, "name").alias("uom_name"))
