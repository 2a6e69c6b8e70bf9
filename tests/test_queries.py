"""The registered queries against their SQL twins, on the smallest test tables."""

import hashlib
from pathlib import Path

import pytest

import __spark_entry__ as entry
from checks import exports, platform, writeback
from checks.compare import connect, differences
from quayside.operators import export
from quayside.schemas import outbound_schema

PARTS = (exports, platform, writeback)
QUERIES = {name: query for part in PARTS for name, query in part.queries().items()}
ORACLES = {name: text for part in PARTS for name, text in part.oracle_sql().items()}


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


def test_every_query_is_known():
    assert set(ORACLES) <= set(QUERIES) <= set(entry.queries())
    assert set(QUERIES) - set(ORACLES) == {"file_checksums_all"}  # SQL does not know the files; see below


@pytest.mark.parametrize("name", ORACLES)
def test_query(spark, sf_dir, duck, name):
    assert differences(QUERIES[name](spark, sf_dir), duck, ORACLES[name]) == []


def test_checksums_of_all_given_files(spark, sf_dir):
    got = {r.file: (r.bytes, r.checksum) for r in QUERIES["file_checksums_all"](spark, sf_dir).collect()}
    files = {p.name: p.read_bytes() for p in Path(sf_dir).glob("*.parquet")}
    assert got == {n: (len(b), f"sha256:{hashlib.sha256(b).hexdigest()}") for n, b in files.items()}


@pytest.mark.parametrize("name", ["sale_order_line", "stock_quant", "stock_move", "product", "orderpoint", "bom_lines"])
def test_shuffled_joins_give_the_same(spark, sf_dir, duck, name):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert differences(QUERIES[f"export_{name}_19"](spark, sf_dir), duck, ORACLES[f"export_{name}_19"]) == []
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_flagship(spark):
    df = entry.entry(spark)
    assert df.schema.names == outbound_schema("sale_order_line").names and df.count() > 0


def test_key_filter_reaches_the_scan(spark, sf_dir, tmp_path):
    from checks.exports import erp
    from quayside.operators.chunks import key_range
    from quayside.sources.catalog import Erp, parquet_catalog

    names = ("stock_move_line", "uom_uom")
    source = erp(spark, sf_dir)
    for name in names:
        source[name].write.parquet(f"{tmp_path}/{name}")
    stored = Erp(parquet_catalog(spark, str(tmp_path), names))
    plan = key_range(export("stock_move_line", stored), "_odoo_move_line_id", 10, 99)._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(id,10)" in plan and "LessThan(id,99)" in plan
    narrow = export("uom", stored).select("factor")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<factor:double>" in narrow
