"""What a job leaves on disk while it runs, and when it is done."""

import threading
from pathlib import Path

import pytest

from __spark_entry__ import queries
from checks.exports import erp
from quayside.functions.durable import in_steps, set_aside, shared_folder, shuffles_removed, step
from quayside.operators import export
from quayside.plans import export as plans
from quayside.plans.export import read_entity, run_export


def scratch(spark):
    return {p.name for p in Path(shared_folder(spark).removeprefix("file:"), "quayside").glob("*")}


def test_large_entities_are_written_one_at_a_time(spark, sf_dir, tmp_path, monkeypatch):
    """Two that are cut never run together, the larger one comes first, and joins are done before rows go to their chunks."""
    active, most, order, dealt, lock = 0, 0, [], [], threading.Lock()
    write, chunked = plans.write_entity, plans.in_chunks

    def watched(df, entity, root, cut, *args):
        nonlocal active, most
        with lock:
            active += bool(cut.step)
            most = max(most, active)
            order.append(entity)
        try:
            write(df, entity, root, cut, *args)
        finally:
            with lock:
                active -= bool(cut.step)

    monkeypatch.setattr(plans, "write_entity", watched)
    monkeypatch.setattr(plans, "in_chunks", lambda df, entity, cut: dealt.append(df) or chunked(df, entity, cut))
    before = scratch(spark)
    entities = ["stock_picking", "sale_order", "stock_move", "sale_order_line", "country"]
    run_export(erp(spark, sf_dir), str(tmp_path), entities, spark=spark, max_rows=200)
    assert most == 1 and order.index("stock_move") < order.index("stock_picking")
    assert len(dealt) == 4 and not any("Join" in df._jdf.queryExecution().optimizedPlan().toString() for df in dealt)
    assert scratch(spark) == before  # what was set aside, and the steps, are gone
    assert read_entity(spark, "stock_move", str(tmp_path)).count() == export("stock_move", erp(spark, sf_dir)).count()


def test_an_entity_that_fails_leaves_nothing_aside(spark, tmp_path):
    before = scratch(spark)
    try:
        with set_aside(spark.range(4)) as rows:
            assert rows.count() == 4
            raise KeyError("x")
    except KeyError:
        pass
    assert scratch(spark) == before


def test_steps_are_planned_only_outside_and_written_inside(spark):
    before = scratch(spark)
    df = spark.range(9).selectExpr("id", "id % 2 AS k")
    assert step(df, "s") is df
    with in_steps():
        got = step(df.groupBy("k").count(), "s")
        assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString() and len(scratch(spark) - before) == 1
    assert scratch(spark) == before
    with in_steps(kept=True):
        got = step(df.groupBy("k").count(), "s")
    assert {r.k: r["count"] for r in got.collect()} == {0: 5, 1: 4}


def test_threads_put_the_setting_back(spark):
    """Whoever comes or leaves first, shuffles are removed while anybody is inside and the setting is as it was after that."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    at_first = spark.conf.get(name, None)
    first, second = shuffles_removed(spark), shuffles_removed(spark)
    first.__enter__()
    second.__enter__()
    first.__exit__(None, None, None)
    assert spark.conf.get(name) == "true"
    second.__exit__(None, None, None)
    assert spark.conf.get(name, None) == at_first


def test_steps_outlast_what_is_set_aside_beside_them(spark):
    """Only the write that ends an export takes its steps along."""
    with in_steps():
        kept = step(spark.range(5), "s")
        with set_aside(spark.range(3)) as rows:
            assert rows.count() == 3 and kept.count() == 5
        assert kept.count() == 5


@pytest.mark.parametrize("variant", ["19", "18"])
def test_stock_moves_are_exported_in_steps(spark, sf_dir, variant):
    """The last step reads two lists and the named moves; what made them is not part of its query."""
    files = queries()[f"export_stock_move_{variant}"](spark, sf_dir).inputFiles()
    assert {f.split("/quayside/")[-1].split("-")[0] for f in files} == {"lists", "moves"}
