"""Drops with memory: seen before, late, damaged, and the records that earlier ones planned."""

import shutil

import pytest
from pyspark.sql import functions as F

from quayside.schemas import decision_schema
from quayside.streaming.inbox import plan_stream
from quayside.streaming.ledger import PLANNED_FROM, ledger
from tests.test_profile_runlog_stream import counts, dropped, spoil
from tests.test_writeback import COMPANY, RELATIONS


@pytest.fixture
def run(spark, source, tmp_path):
    erp = source(**RELATIONS)

    def go(**options):
        paths = [str(tmp_path / "in"), lambda: erp, COMPANY, str(tmp_path / "out"), str(tmp_path / "state")]
        plan_stream(spark, *paths, manifests=True, **options).awaitTermination()
        return states()

    def states():
        return {r.prefix.rsplit("/", 1)[-1]: r.state for r in ledger(spark, str(tmp_path / "out")).collect()}

    return go


def table(spark, tmp_path, name):
    return spark.read.parquet(str(tmp_path / "out" / name)).withColumn("drop", F.element_at(F.split("prefix", "/"), -1))


def test_a_drop_seen_before_is_refused(spark, tmp_path, run):
    expected = dropped(spark, tmp_path / "in" / "a", 31)
    assert run() == {"a": "planned"}
    shutil.copytree(tmp_path / "in" / "a", tmp_path / "in" / "b")
    shutil.copytree(tmp_path / "in" / "a", tmp_path / "in" / "c")  # two at a time
    assert run() == {"a": "planned", "b": "repeated", "c": "repeated"}
    rows = table(spark, tmp_path, "outcome").collect()
    assert {r["drop"] for r in rows} == {"a"} and counts(rows) == expected
    refused = table(spark, tmp_path, "refused").collect()
    assert sorted((r["drop"], r.error, r.detail.rsplit("/", 1)[-1]) for r in refused) == [(d, "Drop was planned before", "a") for d in "bc"]


def test_equal_drops_of_one_trigger(spark, tmp_path, run):
    dropped(spark, tmp_path / "in" / "a", 32)
    shutil.copytree(tmp_path / "in" / "a", tmp_path / "in" / "b")
    assert sorted(run().values()) == ["planned", "repeated"]


def test_a_late_drop_waits(spark, tmp_path, run):
    expected = dropped(spark, tmp_path / "aside", 33)
    (tmp_path / "in" / "a").mkdir(parents=True)
    shutil.copy(tmp_path / "aside" / "manifest.json", tmp_path / "in" / "a")
    assert run() == {"a": "waiting"} and not (tmp_path / "out" / "outcome").exists()
    other = dropped(spark, tmp_path / "in" / "b", 34)
    assert run() == {"a": "waiting", "b": "planned"}
    shutil.copytree(tmp_path / "aside" / "decisions.parquet", tmp_path / "in" / "a" / "decisions.parquet")
    assert run() == {"a": "planned", "b": "planned"}
    rows = table(spark, tmp_path, "outcome")
    for drop, want in (("a", expected), ("b", other)):
        kinds = {r.decision_type for r in rows.filter(F.col("drop") == drop).collect()}
        assert kinds == set(want)


def test_patience_ends(spark, tmp_path, run):
    dropped(spark, tmp_path / "aside", 35)
    (tmp_path / "in" / "a").mkdir(parents=True)
    shutil.copy(tmp_path / "aside" / "manifest.json", tmp_path / "in" / "a")
    assert run(patience=1) == {"a": "waiting"}
    (tmp_path / "in" / "any.txt").write_text("wakes the stream")
    assert run(patience=1) == {"a": "refused"}
    (row,) = table(spark, tmp_path, "refused").collect()
    assert row.error == "Manifest validation failed" and row.detail.startswith("Missing file: ")


def test_a_damaged_drop_does_not_wait(spark, tmp_path, run):
    dropped(spark, tmp_path / "in" / "a", 36)
    spoil(tmp_path / "in" / "a")
    assert run() == {"a": "refused"}


def test_a_batch_that_runs_again_gives_the_same(spark, tmp_path, run):
    """The last batch is taken back as if its commit had been lost."""
    dropped(spark, tmp_path / "in" / "a", 37)
    run()
    dropped(spark, tmp_path / "in" / "b", 38)
    run()

    def seen():
        return {n: sorted(map(str, table(spark, tmp_path, n).collect())) for n in ("outcome", "purchase_orders", "orderpoint_creates", "ledger")}

    before = seen()
    for part in ("commits",):
        for name in ("1", ".1.crc"):
            (tmp_path / "state" / part / name).unlink()
    assert run() == {"a": "planned", "b": "planned"} and seen() == before


def rows_for(spark, path, rows):
    full = [tuple(r.get(n) for n in decision_schema().names) for r in rows]
    spark.createDataFrame(full, decision_schema()).coalesce(1).write.parquet(f"{path}/decisions.parquet")
    from datetime import datetime

    from quayside.plans.manifest import file_facts, write_manifest

    write_manifest(file_facts(spark, str(path)), str(path), company="", company_id=COMPANY, source_version="", run_uuid=str(path),
                   started_at=None, finished_at=datetime(2024, 1, 1))


def rule(n, product, location, low, high):
    return {"decision_id": str(n), "decision_type": "ORDERPOINT", "_odoo_product_id": product, "_odoo_location_id": location,
            "min_quantity": float(low), "max_quantity": float(high)}


@pytest.mark.parametrize("cleanup", [False, True])
def test_records_of_earlier_drops(spark, tmp_path, run, cleanup):
    product = 987_654  # no rule has it
    rows_for(spark, tmp_path / "in" / "a", [rule(1, product, 4, 1, 2), rule(2, product, 5, 3, 4)])
    run(cleanup=cleanup)
    rows_for(spark, tmp_path / "in" / "b", [rule(1, product, None, 5, 6)])
    run(cleanup=cleanup)
    made = table(spark, tmp_path, "orderpoint_creates")
    first = {r.location_id: r.planned_id for r in made.filter(F.col("drop") == "a").collect()}
    assert set(first) == {4, 5} and min(first.values()) >= PLANNED_FROM and first[4] < first[5]
    updates = table(spark, tmp_path, "orderpoint_updates").filter(F.col("drop") == "b").collect()
    if cleanup:  # the second drop takes the first one's rules back and makes its own
        gone = table(spark, tmp_path, "delete_stock_warehouse_orderpoint").filter(F.col("drop") == "b").collect()
        assert set(first.values()) <= {r.id for r in gone} and updates == []
        assert made.filter(F.col("drop") == "b").count() == 1
    else:  # the rule that the first row of the first drop made is the product's first
        assert [(r.orderpoint_id, r.product_min_qty) for r in updates] == [(first[4], 5.0)]
        assert made.filter(F.col("drop") == "b").count() == 0
