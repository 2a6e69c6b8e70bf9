import pytest
from pyspark.sql import types as T

from checks.exports import erp
from quayside.operators import EXPORTS, export
from quayside.schemas import CHUNKABLE, ENTITIES, SUITES, decision_schema, key_column, outbound_schema
from quayside.sources.catalog import Erp


def test_counts():
    assert len(ENTITIES) == len(set(ENTITIES)) == 47
    assert sum(len(outbound_schema(e)) for e in ENTITIES) == 594
    assert len(decision_schema()) == 26
    assert set(EXPORTS) == set(ENTITIES)
    assert len(SUITES) == 8 and len(CHUNKABLE) == 15


@pytest.mark.parametrize("entity", ENTITIES)
def test_empty_table_and_rules(spark, entity):
    schema = outbound_schema(entity)
    assert spark.createDataFrame([], schema).count() == 0
    for field in schema:
        if field.name.startswith("_odoo_"):
            assert field.dataType == T.LongType()
        assert field.dataType in (
            T.LongType(), T.DoubleType(), T.StringType(), T.BooleanType(), T.TimestampType(),
        )
    assert key_column(entity).startswith("_odoo_")


@pytest.mark.parametrize("variant", ["18", "19"])
def test_both_variants_give_the_declared_schema(spark, sf_dir, variant):
    source = erp(spark, sf_dir, variant)
    old = {"stock_package_type"} if variant == "18" else set()
    for entity in set(ENTITIES) - old:
        got = export(entity, source).schema
        assert [(f.name, f.dataType) for f in got] == [(f.name, f.dataType) for f in outbound_schema(entity)]


def test_unknown_variant_is_refused(spark, sf_dir):
    with pytest.raises(ValueError):
        Erp(erp(spark, sf_dir).tables, "17")
