import hashlib
import json
from datetime import UTC, datetime
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from checks.exports import erp
from quayside import __version__
from quayside.functions.columns import ids_only
from quayside.operators import EXPORTS, compatible, registry
from quayside.operators.profile import capabilities, modules, profile
from quayside.plans.export import read_entity, run_export, versions_of, write_entity
from quayside.plans.manifest import (
    file_facts, manifest_facts, manifest_files, malformed_entries, read_manifest, recount, validate_manifest, write_manifest,
)
from quayside.operators.chunks import Cut
from quayside.sources.catalog import Catalog, Erp
from quayside.sources.files import checksums, list_files, row_counts


def document(root):
    return json.loads(Path(root, "manifest.json").read_text())


def errors(spark, root):
    return sorted(r.error for r in validate_manifest(spark, str(root)).collect())


@pytest.fixture
def exported(spark, sf_dir, tmp_path):
    source = erp(spark, sf_dir)
    run = run_export(
        source, str(tmp_path), ["sale_order", "country", "currency"], spark=spark, company="Acme", company_id=7,
        source_version="19.0.1", max_rows=400, capabilities=profile(source),
    )
    return tmp_path, run


def test_export_writes_files_and_manifest(spark, exported):
    root, run = exported
    doc = document(root)
    assert doc["run_uuid"] == run and doc["export_mode"] == "full" and doc["errors"] == [] and doc["warnings"] == []
    assert (doc["company"], doc["company_id"], doc["odoo_version"], doc["version"]) == ("Acme", 7, "19.0.1", __version__)
    assert doc["schema_version"] == doc["finished_at"][:10] and doc["total_duration_seconds"] > 0
    assert doc["capabilities"]["mode"] == "inventory" and doc["capabilities"]["company_count"] == 5
    assert {f["collector"] for f in doc["files"]} == {"sale_order", "country", "currency"}
    assert sum(f["rows"] for f in doc["files"] if f["collector"] == "sale_order") == 1500
    for entry in doc["files"]:
        path = root / entry["file"]
        assert entry["bytes"] == path.stat().st_size and entry["duration_seconds"] > 0
        assert entry["checksum"] == "sha256:" + hashlib.sha256(path.read_bytes()).hexdigest()
        meta = pq.read_metadata(path)
        assert meta.num_rows == entry["rows"] <= 400 and meta.row_group(0).column(0).compression == "SNAPPY"
        assert __version__ in str(meta.metadata) and "19.0.1" in str(meta.metadata)
    assert len({Path(f["file"]).parent for f in doc["files"] if f["collector"] == "sale_order"}) == 4
    assert versions_of(read_entity(spark, "country", str(root))) == {"exporter_version": __version__, "odoo_version": "19.0.1"}
    assert errors(spark, root) == []
    assert recount(manifest_files(read_manifest(spark, str(root))), row_counts(spark, str(root))).count() == 0


def test_missing_and_changed_files_are_reported(spark, exported):
    root, _ = exported
    files = [f["file"] for f in document(root)["files"]]
    lost = next(f for f in files if f.startswith("country"))
    changed = next(f for f in files if f.startswith("currency"))
    known = {f["file"]: f["checksum"] for f in document(root)["files"]}
    for path in (lost, changed):
        crc = (root / path).with_name(f".{Path(path).name}.crc")
        crc.unlink()
    (root / lost).unlink()
    (root / changed).write_bytes(b"other")
    other = "sha256:" + hashlib.sha256(b"other").hexdigest()
    assert errors(spark, root) == [
        f"Checksum mismatch for {changed}: expected '{known[changed]}', got {other}",
        f"Missing file: {lost}",
    ]


def test_failing_entity_is_an_error_in_the_manifest(spark, sf_dir, tmp_path):
    source = erp(spark, sf_dir)
    broken = type(source)(source.tables.without(["res_country"]), "19", ("en_US",))
    run_export(broken, str(tmp_path), ["country", "uom"], spark=spark)
    doc = document(tmp_path)
    assert len(doc["errors"]) == 1 and doc["errors"][0].startswith("country: ")
    assert {f["collector"] for f in doc["files"]} == {"uom"}


def test_manifest_lists_what_the_run_wrote(spark, sf_dir, tmp_path):
    source = erp(spark, sf_dir)
    run_export(source, str(tmp_path), ["uom", "country"], spark=spark)
    run_export(source, str(tmp_path), ["uom"], spark=spark)
    doc = document(tmp_path)
    assert {f["collector"] for f in doc["files"]} == {"uom"} and all(f["duration_seconds"] > 0 for f in doc["files"])
    assert sorted(p.name for p in tmp_path.iterdir() if not p.name.startswith(".")) == ["country", "manifest.json", "uom"]


def test_entities_a_source_can_give(spark, sf_dir):
    source = erp(spark, sf_dir)
    small = Catalog({n: (lambda n=n: source[n]) for n in ("uom_uom", "res_country", "res_partner", "res_currency")})
    assert compatible(Erp(small, "19", ("en_US",))) == ["uom", "partner", "country"]
    less = small.without(columns={"res_partner": ["customer_rank"]})
    assert compatible(Erp(less, "19", ("en_US",))) == ["uom", "country"]


def test_full_export_hides_no_entity(spark, sf_dir, tmp_path, monkeypatch):
    source = erp(spark, sf_dir)
    names = ("uom_uom", "res_country", "res_partner", "sale_order", "ir_module_module")
    less = Catalog({n: (lambda n=n: source[n]) for n in names}).without(columns={"res_partner": ["customer_rank"]})

    def bug(erp):
        raise KeyError("bug")

    monkeypatch.setattr(registry, "EXPORTS", only := {e: EXPORTS[e] for e in ("uom", "partner", "sale_order", "stock_quant", "country")})
    monkeypatch.setattr("quayside.plans.export.EXPORTS", only)
    monkeypatch.setitem(only, "country", bug)
    run_export(Erp(less, "19", ("en_US",), modules=("base", "stock")), str(tmp_path), spark=spark)
    doc = document(tmp_path)
    assert {f["collector"] for f in doc["files"]} == {"uom"}
    assert [e.split(":")[0] for e in doc["errors"]] == ["country", "partner"] and "customer_rank" in doc["errors"][1]
    assert doc["warnings"] == [
        "sale_order: left out, the source has no module sale", "stock_quant: left out, the source has no relation stock_quant",
    ]
    assert modules(source) == ("base", "purchase", "sale", "stock")
    assert set(registry.REQUIRED) <= set(EXPORTS)


def test_malformed_manifests(spark, tmp_path):
    def check(content):
        (tmp_path / "manifest.json").write_text(json.dumps(content))
        return sorted(r.error for r in malformed_entries(read_manifest(spark, str(tmp_path))).collect())

    assert check({}) == [] and check({"files": []}) == []
    assert check({"files": "x"}) == ["manifest['files'] must be a list"]
    got = check({"files": ["a", 3, 1.5, True, None, [1], {"file": 5}, {"rows": 1}, {"file": "ok"}]})
    kinds = ("NoneType", "bool", "float", "int", "list", "str")
    assert got == sorted(
        [f"Expected dict in manifest['files'], got {k}" for k in kinds] + ["manifest['files'][].file must be a string"] * 2
    )


def test_entries_without_checksum_do_not_match(spark, tmp_path):
    (tmp_path / "a.parquet").write_bytes(b"abc")
    (tmp_path / "manifest.json").write_text(json.dumps({"files": [{"file": "a.parquet"}]}))
    actual = "sha256:" + hashlib.sha256(b"abc").hexdigest()
    assert errors(spark, tmp_path) == [f"Checksum mismatch for a.parquet: expected None, got {actual}"]


def test_files_are_listed_by_name(spark, tmp_path):
    for name in ("b.parquet", "x/a b.parquet", "a.json"):
        path = tmp_path / name
        path.parent.mkdir(exist_ok=True)
        path.write_bytes(b"1234")
    got = [(r.file, r.bytes) for r in list_files(spark, str(tmp_path)).collect()]
    assert [b for _, b in got] == [4, 4, 4] and [f for f, _ in got][:2] == ["a.json", "b.parquet"]
    assert checksums(spark, f"file://{tmp_path}").count() == 2


def test_crowded_key_range_becomes_several_files(spark, tmp_path):
    from quayside.schemas import outbound_schema

    schema = outbound_schema("partner")
    ids = [*range(1, 2001), 10**9]  # nearly all keys fall into the first chunk
    df = spark.createDataFrame([(i, *[None] * (len(schema) - 1)) for i in ids], schema)
    write_entity(df, "partner", str(tmp_path), Cut(1, 10**8), "19", max_rows=300)
    files = list((tmp_path / "partner" / "key_from=1").glob("*.parquet"))
    assert len(files) >= 7 and all(pq.read_metadata(f).num_rows <= 300 for f in files)
    assert sorted(r[0] for r in read_entity(spark, "partner", str(tmp_path)).collect()) == ids


def test_manifest_facts(spark):
    begin = datetime(2024, 1, 1, tzinfo=UTC)
    head, tail = manifest_facts(spark, company="c", company_id=1, source_version="", run_uuid="u", started_at=begin,
                                finished_at=datetime(2024, 1, 1, 0, 0, 2, tzinfo=UTC), errors=["x: y"])
    assert tail.first().errors == ["x: y"] and tail.first().total_duration_seconds == 2.0
    assert head.first().company == "c" and head.first().export_mode == "full"


FACTS = dict(company='a "b"\n', company_id=1, source_version="", run_uuid="u", started_at=None, finished_at=datetime(2024, 1, 1))


@pytest.mark.parametrize("n", [0, 1, 5000])
def test_manifest_is_written_in_parts(spark, tmp_path, n):
    files = spark.range(n).select(F.format_string("e/%05d \"x\n.parquet", F.lit(n) - F.col("id")).alias("file"), F.col("id").alias("rows"))
    files = files.repartition(7)
    for _ in range(2):  # written again, over the old one
        write_manifest(files, str(tmp_path), **FACTS)
    doc = document(tmp_path)
    assert [f["file"] for f in doc["files"]] == [f'e/{i:05d} "x\n.parquet' for i in range(1, n + 1)]
    assert doc["company"] == 'a "b"\n' and doc["run_uuid"] == "u" and list(doc)[-1] == "run_uuid"
    assert sorted(p.name for p in tmp_path.iterdir() if not p.name.startswith(".")) == ["manifest.json"]
    manifest = read_manifest(spark, str(tmp_path))
    assert sorted((r.file, r.rows) for r in manifest_files(manifest).collect()) == [(f["file"], f["rows"]) for f in doc["files"]]
    assert malformed_entries(manifest).count() == 0
    plan = manifest_files(manifest)._jdf.queryExecution().executedPlan().toString()
    assert "wholetext" not in plan.lower() and "Generate" not in plan  # entries are lines, not one row


def test_other_documents_are_read_whole(spark, tmp_path):
    write_manifest(spark.createDataFrame([("a", 1), ("b", 2)], "file string, rows long"), str(tmp_path), **FACTS)
    doc = document(tmp_path)
    for text in (json.dumps(doc), json.dumps(doc, indent=2), json.dumps({"files": doc["files"], "x": {"files": []}}, indent=0)):
        (tmp_path / ".manifest.json.crc").unlink(missing_ok=True)
        (tmp_path / "manifest.json").write_text(text)
        assert sorted(r.file for r in manifest_files(read_manifest(spark, str(tmp_path))).collect()) == ["a", "b"]
    lines = ('{"x": 1, "files":[', '{"file": "a"}', '{"file": "b"}', "]")
    (tmp_path / "manifest.json").write_text("\n".join(lines))
    with pytest.raises(ValueError, match="not a JSON document"):
        read_manifest(spark, str(tmp_path))


def test_large_files_are_hashed_in_blocks(spark, tmp_path, monkeypatch):
    for name, size in (("a b%é.parquet", 70_000), ("x/small.parquet", 10), ("x/large.parquet", 300_000)):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_bytes(bytes(i * i % 251 for i in range(size)))
    before = sorted(map(tuple, checksums(spark, str(tmp_path)).collect()))
    monkeypatch.setattr("quayside.sources.files.STREAM_FROM", 50_000)
    monkeypatch.setattr("quayside.sources.files._BLOCK", 999)
    assert sorted(map(tuple, checksums(spark, str(tmp_path)).collect())) == before and len(before) == 3


def test_a_file_beyond_a_row(spark, tmp_path):
    size = 2**31 + 4096
    with open(tmp_path / "huge.parquet", "wb") as file:
        file.truncate(size)  # takes no disk
    (row,) = checksums(spark, str(tmp_path)).collect()
    total = hashlib.sha256()
    for _ in range(2**31 // 2**20):
        total.update(bytes(2**20))
    total.update(bytes(4096))
    assert (row.bytes, row.checksum) == (size, f"sha256:{total.hexdigest()}")


def test_capabilities_are_grouped(spark, sf_dir, tmp_path):
    source = erp(spark, sf_dir)
    run_export(source, str(tmp_path), ["uom"], spark=spark, capabilities=capabilities(source, "db1"))
    got = document(tmp_path)["capabilities"]
    assert got["mode"] == "inventory" and got["database"] == "db1" and got["companies"] == 5
    assert got["modules"] == {
        "stock": True, "sale": True, "purchase": True, "mrp": False, "mrp_subcontracting": False, "mrp_mps": False, "product_expiry": False,
        "pos": False, "quality": False,
    }
    assert set(got["data"]) == {"inventory", "open_moves", "manufacturing", "orderpoints", "sales", "purchases", "supplier_info"}
    assert got["languages"]["lang1"] == got["languages"]["active"][0]


def test_ids_only_leaves_out_name_joins(spark, sf_dir):
    source = erp(spark, sf_dir)
    with ids_only():
        lean = EXPORTS["sale_order_line"](source)
    full = EXPORTS["sale_order_line"](source)
    joins = lambda df: df._jdf.queryExecution().optimizedPlan().toString().count("Join ")
    ids = [c for c in full.columns if c.endswith("_id")]
    assert lean.columns == full.columns and joins(lean) < joins(full)
    assert lean.select(ids).exceptAll(full.select(ids)).isEmpty() and lean.count() == full.count()


def test_an_export_leaves_no_shuffle_files(spark, sf_dir, tmp_path):
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    before = disk.getAllFiles().size()
    run_export(erp(spark, sf_dir), str(tmp_path), ["sale_order_line", "stock_move"], spark=spark, max_rows=1_000)
    left = disk.getAllFiles().size() - before
    assert left < 50, left  # of the manifest; 90 with the shuffles of the entities
    assert read_entity(spark, "stock_move", str(tmp_path)).count() > 1_000


def test_rows_are_counted_by_path(spark, tmp_path):
    """A name is spelled once for each file: rows are grouped by the path as it is."""
    spark.range(100).repartition(3).write.parquet(f"{tmp_path}/a +b%20c")
    counted = row_counts(spark, str(tmp_path))
    rows = counted.collect()
    assert sum(r.rows for r in rows) == 100 and all(r.file.startswith("a +b%20c/part-") for r in rows)
    assert "Aggregate [path#" in counted._jdf.queryExecution().optimizedPlan().toString()
