from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from quayside.operators import runlog
from quayside.operators.profile import languages, mode_of, profile
from quayside.plans.manifest import file_facts, write_manifest
from quayside.plans.receive import receive
from quayside.plans.writeback import PLANNERS
from quayside.schemas import decision_schema
from quayside.sources.catalog import parquet_catalog, view_catalog
from quayside.sources.files import list_files
from quayside.streaming.inbox import plan_stream
from tests.test_writeback import COMPANY, RELATIONS, loop, random_decisions

MODULES = "name string, state string, latest_version string"
LANGS = "code string, active boolean"
COMPANIES = ("id long", [(1,), (2,)])


@pytest.mark.parametrize(
    "flags, mode",
    [("mrp manufacturing", "manufacturing"), ("mrp", "manufacturing_idle"), ("mrp stock sale", "manufacturing_idle"), ("stock sale", "inventory"),
     ("stock purchase", "inventory"), ("stock", "minimal"), ("sale", "minimal"), ("manufacturing", "minimal"), ("", "minimal")],
)
def test_mode(spark, flags, mode):
    names = {"mrp": "has_mrp", "manufacturing": "has_manufacturing_data", "stock": "has_stock", "sale": "has_sale_data", "purchase": "has_purchase_data"}
    row = spark.range(1).select(*[F.lit(short in flags.split()).alias(name) for short, name in names.items()])
    assert row.select(mode_of()).first()[0] == mode


def test_profile_of_a_small_source(source):
    erp = source(
        ir_module_module=(MODULES, [("base", "installed", "19.0.1"), ("stock", "installed", None), ("sale", "uninstalled", None)]),
        res_lang=(LANGS, [("ro_RO", True), ("en_US", True), ("xx_XX", False)]),
        res_company=COMPANIES,
        stock_quant=("id long, quantity double, reserved_quantity double", [(1, 0.0, 0.0), (2, None, None)]),
        stock_move=("id long, state string", [(1, "done"), (2, "cancel")]),
        sale_order_line=("id long", [(1,)]),
    )
    row = profile(erp).first()
    assert row.source_version == "19.0.1" and row.active_languages == ["en_US", "ro_RO"]
    assert (row.has_stock, row.has_sale, row.has_inventory_data, row.has_open_moves, row.has_sale_data) == (True, False, False, False, True)
    assert (row.company_count, row.warehouse_count, row["mode"]) == (2, 0, "inventory")
    assert languages(erp) == ("en_US", "ro_RO")


def test_profile_defaults(source):
    erp = source(ir_module_module=(MODULES, []), res_lang=(LANGS, [("en_US", False)]), res_company=COMPANIES)
    row = profile(erp).first()
    assert row.active_languages == ["en_US"] and row.source_version == "" and row["mode"] == "minimal"


RUNS = "id long, state string, finished_at timestamp"


def test_retention(spark):
    now = datetime(2024, 3, 1)
    runs = spark.createDataFrame(
        [(i, "done" if i % 4 else "error", now - timedelta(days=20 * i)) for i in range(1, 9)] + [(9, "pending", None)], RUNS
    )
    chunks = spark.createDataFrame([(10 * i + j, i) for i in range(1, 10) for j in range(2)], "id long, run_id long")
    ids = lambda df, c="id": sorted({r[c] for r in df.collect()})
    assert ids(runlog.keep_newest(runs, 2)) == [4, 6, 7, 8, 9]
    assert ids(runlog.keep_newest(runs)) == [4, 5, 6, 7, 8, 9]
    old = runlog.expired(runs, F.lit(now), 40)
    assert ids(old) == [3, 5, 6, 7]
    kept, left = runlog.drop_runs(runs, chunks, old)
    assert ids(kept) == [1, 2, 4, 8, 9] and ids(left, "run_id") == [1, 2, 4, 8, 9]
    assert ids(runlog.open_runs(runs)) == [9]


def test_cancel(spark):
    runs = spark.createDataFrame([(1, "collecting", None), (2, "done", None)], RUNS)
    chunks = spark.createDataFrame(
        [(i, 1 + i % 2, i, s, "e", 5 * (i % 2), None if i else "boom") for i, s in enumerate(["error", "pending", "created", "uploaded", "pending"])],
        "id long, run_id long, sequence long, state string, collector string, key_from long, error_message string",
    )
    marked, left = runlog.cancel_runs(runs, chunks)
    assert {r.id: (r.state, r.error_message) for r in marked.collect()} == {1: ("error", "Cancelled by user"), 2: ("done", None)}
    assert sorted(r.id for r in left.collect()) == [0, 1, 3]
    assert [r.error for r in runlog.chunk_errors(chunks).collect()] == ["e: boom"]
    assert {r[0] for r in chunks.select(runlog.chunk_file_name()).collect()} == {"e.parquet", "e_5.parquet"}


def test_stream_plans_each_file_once(spark, source, tmp_path):
    inbox, sink, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    erp = source(**RELATIONS)

    def drop(seed, folder):
        rows = random_decisions(seed, 120)
        spark.createDataFrame(rows, decision_schema()).coalesce(1).write.parquet(f"{inbox}/{folder}/decisions.parquet")
        plan_stream(spark, inbox, erp, COMPANY, sink, state).awaitTermination()
        return loop(rows)[1]

    def outcome(batch):
        rows = spark.read.parquet(f"{sink}/outcome").filter(F.col("batch") == batch).collect()
        return {r.decision_type: (r.created, r.updated, r.errors) for r in rows}

    first = drop(11, "a")
    assert outcome(0) == first
    second = drop(12, "b")
    assert outcome(0) == first and outcome(1) == second
    plan_stream(spark, inbox, erp, COMPANY, sink, state).awaitTermination()
    assert spark.read.parquet(f"{sink}/outcome").select("batch").distinct().count() == 2
    assert list_files(spark, sink, "*.parquet").count() > len(PLANNERS)


def dropped(spark, path, seed, listed=True):
    """A drop with a manifest that lists its decisions, or nothing; the expected outcome."""
    rows = random_decisions(seed, 60)
    spark.createDataFrame(rows, decision_schema()).coalesce(1).write.parquet(f"{path}/decisions.parquet")
    facts = file_facts(spark, str(path)).filter(F.lit(listed))
    write_manifest(facts, str(path), company="", company_id=COMPANY, source_version="", run_uuid="u", started_at=None,
                   finished_at=datetime(2024, 1, 1))
    return loop(rows)[1]


def spoil(path):
    (file,) = path.glob("decisions.parquet/*.parquet")
    file.with_name(f".{file.name}.crc").unlink()
    file.write_bytes(b"other")


def counts(rows):
    return {r.decision_type: (r.created, r.updated, r.errors) for r in rows}


def test_receive_plans_what_the_manifest_lists(spark, source, tmp_path):
    erp = source(**RELATIONS)

    def refused(path):
        got = receive(spark, str(path), erp, COMPANY)
        assert got.batch is None
        return [(r.error, (r.detail or "")[:17]) for r in got.errors.collect()]

    expected = dropped(spark, tmp_path / "a", 1)
    got = receive(spark, str(tmp_path / "a"), erp, COMPANY)
    assert got.errors.count() == 0 and counts(got.batch.outcome.collect()) == expected
    spoil(tmp_path / "a")
    assert refused(tmp_path / "a") == [("Manifest validation failed", "Checksum mismatch")]
    dropped(spark, tmp_path / "unlisted", 2, listed=False)
    assert refused(tmp_path / "unlisted") == [("No decisions.parquet found", "")]
    (tmp_path / "none").mkdir()
    assert refused(tmp_path / "none") == [("No manifest.json found", "")]
    (tmp_path / "none" / "manifest.json").write_text("{")
    assert refused(tmp_path / "none") == [("manifest.json is not a JSON document", "")]


@pytest.mark.parametrize("manifests", [False, True])
def test_drops_that_wait_together_are_planned_alone(spark, source, tmp_path, manifests):
    inbox, sink = tmp_path / "in", str(tmp_path / "out")
    expected = {n: dropped(spark, inbox / n, seed) for n, seed in (("a", 21), ("b", 22))}
    dropped(spark, inbox / "bad", 23)
    if manifests:
        spoil(inbox / "bad")
    else:
        expected["bad"] = loop(random_decisions(23, 60))[1]
    plan_stream(spark, str(inbox), source(**RELATIONS), COMPANY, sink, str(tmp_path / "state"), manifests=manifests).awaitTermination()
    rows = spark.read.parquet(f"{sink}/outcome").collect()
    assert {r.batch for r in rows} == {0}
    names = {r.prefix: r.prefix.rsplit("/", 1)[1] for r in rows}
    assert {n: counts(r for r in rows if r.prefix == p) for p, n in names.items()} == expected
    if manifests:
        assert [(r.error, r.prefix[-3:]) for r in spark.read.parquet(f"{sink}/refused").collect()] == [("Manifest validation failed", "bad")]


def test_catalogs(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "res_lang"))
    stored = parquet_catalog(spark, str(tmp_path), ["res_lang", "absent"])
    assert stored["res_lang"].count() == 3 and "absent" in stored and len(stored) == 2
    stored["res_lang"].createOrReplaceTempView("res_lang_view")
    views = view_catalog(spark, ["res_lang_view"])
    assert views.has_column("res_lang_view", "id") and not views.has_column("res_lang_view", "x")
    with pytest.raises(KeyError):
        views.first_of("stock_package", "stock_quant_package")
    assert "res_lang" not in stored.without(["res_lang"])
    assert stored.without(columns={"res_lang": ["id"]})["res_lang"].columns == []
