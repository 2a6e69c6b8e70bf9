"""Sources, chunked export, manifest, integrity, profile, run log and streaming, with SQL twins."""

from __future__ import annotations

from datetime import UTC, datetime
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks.exports import entity_sql, erp
from checks.writeback import COMPANY
from checks.writeback import oracle_sql as writeback_sql
from checks.writeback import rules_kept as writeback_rules_kept
from quayside.functions.columns import json_text, language_key
from quayside.functions.durable import scratch_path, shuffles_removed
from quayside.functions.lists import id_lists
from quayside.operators import export, runlog
from quayside.operators.chunks import chunk_plan, entity_chunks, entity_cut, id_span, key_range, primary_relation
from quayside.operators.integrity import LINKS, integrity_report
from quayside.operators.profile import capabilities, profile
from quayside.operators.stock import packages
from quayside.plans.export import read_entity, run_export, versions_of, write_entity
from quayside.plans.manifest import (
    file_facts, manifest_files, read_manifest, recount, validate_files, validate_manifest, write_manifest,
)
from quayside.plans.receive import receive
from quayside.schemas import CHUNKABLE, ENTITIES, decision_schema, key_column
from quayside.sources.catalog import parquet_catalog
from quayside.sources.decisions import conform_decisions, decision_types, read_decisions
from quayside.sources.driver_tables import RELATIONS, with_relations
from quayside.sources.files import checksums, copy_file, list_files, row_counts
from quayside.streaming.inbox import plan_stream
from quayside.streaming.ledger import ledger

AT = datetime(2024, 1, 1, tzinfo=UTC)
MAX_ROWS = 4_000  # small, so that the test tables are cut at all
EXPORTED = ("partner", "sale_order", "sale_order_line", "stock_quant", "pos_order_line")
SOURCES = tuple(name for name in RELATIONS if name not in ("li", "ptype", "pbrand"))


def _exported(spark, sf_dir):
    root = scratch_path(spark, "export")
    run_export(erp(spark, sf_dir), root, list(EXPORTED), spark=spark, max_rows=MAX_ROWS, source_version="19.0")
    return root


def _source_rows(spark, sf_dir):
    source = erp(spark, sf_dir)
    parts = [source[n].agg(F.lit(n).alias("relation"), F.count("*").alias("rows")) for n in SOURCES]
    return reduce(DataFrame.unionByName, parts)


def _parquet_source(spark, sf_dir):
    """A relation written as Parquet and opened through the Parquet catalog."""
    root = scratch_path(spark, "source")
    erp(spark, sf_dir)["sale_order"].write.parquet(f"{root}/sale_order")
    return parquet_catalog(spark, root, ["sale_order"])["sale_order"].select("id", "name", "state", "partner_id")


def _chunked_roundtrip(entity):
    def run(spark, sf_dir):
        root, source = scratch_path(spark, "sink"), erp(spark, sf_dir)
        write_entity(export(entity, source), entity, root, entity_cut(source, entity, MAX_ROWS), "19.0", MAX_ROWS)
        return read_entity(spark, entity, root)

    return run


def _chunk_facts(spark, sf_dir):
    """Rows per written chunk, summed over its files, from the files' own footers."""
    root = _exported(spark, sf_dir)
    start = F.regexp_extract("file", r"key_from=(\d+)", 1)
    facts = checksums(spark, root).join(row_counts(spark, root), "file")
    return facts.groupBy(
        F.element_at(F.split("file", "/"), 1).alias("entity"),
        F.coalesce(F.nullif(start, F.lit("")).cast("bigint"), F.lit(0)).alias("key_from"),
    ).agg(
        F.sum("rows").alias("rows"),
        F.bool_and((F.col("bytes") > 0) & F.col("checksum").rlike("^sha256:[0-9a-f]{64}$")).alias("sound"),
    )


def _stamps(spark, sf_dir):
    root = _exported(spark, sf_dir)
    parts = [
        read.agg(F.lit(e).alias("entity"), F.lit(versions_of(read)["odoo_version"]).alias("odoo_version"),
                 F.count("*").alias("rows"))
        for e in EXPORTED
        for read in [read_entity(spark, e, root)]
    ]
    return reduce(DataFrame.unionByName, parts)


def _folders(spark, sf_dir):
    files = list_files(spark, _exported(spark, sf_dir), "*.parquet")
    return files.select(F.regexp_replace("file", "/[^/]+$", "").alias("folder")).distinct()


def _manifest_rows(spark, sf_dir):
    files = manifest_files(read_manifest(spark, _exported(spark, sf_dir)))
    return files.groupBy("collector").agg(F.sum("rows").alias("rows"))


def _document(spark, sf_dir):
    manifest = read_manifest(spark, _exported(spark, sf_dir))
    document = manifest.document
    fields = [F.try_variant_get("manifest", f"$.{n}", "string").alias(n) for n in ("export_mode", "odoo_version", "company")]
    entries = manifest_files(manifest).agg(F.count_distinct("collector").alias("entities"), F.sum("rows").alias("rows"))
    return document.select(*fields, F.try_variant_get("manifest", "$.run_uuid", "string").isNotNull().alias("named")).join(entries)


def _full_export(spark, sf_dir):
    """Every entity the source can give, by one run; rows by the manifest, and the errors."""
    root = scratch_path(spark, "export")
    run_export(erp(spark, sf_dir), root, spark=spark, source_version="19.0")
    manifest = read_manifest(spark, root)
    errors = manifest.document.select(F.size(F.try_variant_get("manifest", "$.errors", "array<string>"))).scalar()
    return manifest_files(manifest).groupBy("collector").agg(F.sum("rows").alias("rows"), F.first(errors).alias("errors"))


def _text_checksums(spark, sf_dir):
    """Checksums of text files whose bytes follow from a table: each nation's customers, a name in each line."""
    root = scratch_path(spark, "names")
    names = spark.read.parquet(f"{sf_dir}/customer.parquet").select("c_nationkey", "c_custkey", "c_name")
    names = names.repartition("c_nationkey").sortWithinPartitions("c_nationkey", "c_custkey")
    names.select("c_nationkey", "c_name").write.partitionBy("c_nationkey").text(root)
    nation = F.regexp_extract("file", r"c_nationkey=(\d+)/", 1).cast("int")
    return checksums(spark, root, "*.txt").select(nation.alias("nation"), "bytes", "checksum")


def _sound(spark, sf_dir):
    """Errors of an untouched export: a count of 0 beside the count of its entities."""
    root = _exported(spark, sf_dir)
    listed = manifest_files(read_manifest(spark, root))
    wrong = validate_manifest(spark, root).agg(F.count("*")).scalar()
    off = recount(listed, row_counts(spark, root)).agg(F.count("*")).scalar()
    return listed.agg(
        F.count_distinct("collector").alias("entities"), wrong.alias("errors"), off.alias("row_errors")
    )


def _tampered(spark, sf_dir):
    """Per entity, the errors after one more file is listed for it and the listed checksums are altered."""
    root = _exported(spark, sf_dir)
    listed = manifest_files(read_manifest(spark, root))
    spoilt = listed.withColumn("checksum", F.concat("checksum", F.lit("0")))
    lost = listed.select("collector").distinct().withColumn("file", F.concat("collector", F.lit("/lost.parquet")))
    both = spoilt.select("file", "checksum").unionByName(lost.withColumn("checksum", F.lit("sha256:00")).drop("collector"))
    errors = validate_files(both, checksums(spark, root))
    kind = F.regexp_extract("error", "^(Missing file|Checksum mismatch)", 1)
    entity = F.regexp_extract("error", r"(?:file: |for )(\w+)/", 1)
    return errors.select(kind.alias("kind"), entity.alias("entity")).distinct()


def _chunk_plans(spark, sf_dir):
    source = erp(spark, sf_dir)
    parts = [entity_chunks(source, e, MAX_ROWS).select(F.lit(e).alias("entity"), "*") for e in (*CHUNKABLE, "uom")]
    return reduce(DataFrame.unionByName, parts)


def _spans(spark, sf_dir):
    source = erp(spark, sf_dir)
    return reduce(
        DataFrame.unionByName,
        [id_span(source[primary_relation(e)]).select(F.lit(e).alias("entity"), "*") for e in CHUNKABLE],
    )


def _ranges(spark, sf_dir):
    """All of an entity, range by range; the outer ranges are open."""
    quants, key = export("stock_quant", erp(spark, sf_dir)), key_column("stock_quant")
    bounds = ((0, 20_000), (20_000, 90_000), (90_000, 0))
    parts = [key_range(quants, key, low, high).withColumn("key_from", F.lit(low)) for low, high in bounds]
    return reduce(DataFrame.unionByName, parts)


def _decision_file(spark, sf_dir):
    root = scratch_path(spark, "inbound")
    with shuffles_removed(spark):
        conform_decisions(erp(spark, sf_dir)["decisions"]).write.parquet(f"{root}/decisions.parquet")
    return root


def _streamed(name):
    def run(spark, sf_dir):
        folder, sink = _decision_file(spark, sf_dir), scratch_path(spark, "planned")
        state = scratch_path(spark, "state")
        plan_stream(spark, folder, erp(spark, sf_dir), COMPANY, sink, state).awaitTermination()
        return spark.read.parquet(f"{sink}/{name}").drop("batch", "prefix")

    return run


def _drop(spark, sf_dir, inbox, name, run_uuid, files=None, entries=None):
    """A drop with the decisions of the source and a manifest that lists them; ``files`` and ``entries`` change its parts."""
    at = f"{inbox}/{name}"
    decisions = conform_decisions(erp(spark, sf_dir)["decisions"])
    if files is None:
        with shuffles_removed(spark):
            decisions.write.parquet(f"{at}/decisions.parquet")
    listed = file_facts(spark, files or at)
    listed = entries(listed) if entries else listed
    write_manifest(listed, at, company="", company_id=COMPANY, source_version="", run_uuid=run_uuid, started_at=None, finished_at=AT)


def _received(spark, sf_dir):
    at = scratch_path(spark, "inbound")
    _drop(spark, sf_dir, at, "a", "1")
    return receive(spark, f"{at}/a", erp(spark, sf_dir), COMPANY).batch.outcome


def _damaged(spark, sf_dir):
    """A drop that lists one lost file for each type of decision, and wrong checksums for those that are there."""
    at, kinds = scratch_path(spark, "inbound"), decision_types(erp(spark, sf_dir)["decisions"])

    def spoilt(listed):
        lost = kinds.select(F.concat(F.lit("decisions.parquet/"), "decision_type", F.lit(".parquet")).alias("file"))
        return listed.withColumn("checksum", F.lit("sha256:00")).unionByName(lost, allowMissingColumns=True)

    _drop(spark, sf_dir, at, "a", "1", entries=spoilt)
    got = receive(spark, f"{at}/a", erp(spark, sf_dir), COMPANY)
    return got.errors.select("error", F.regexp_replace("detail", "(Checksum mismatch).*", "$1").alias("detail")).distinct()


def _run_stream(spark, sf_dir, at, **options):
    paths = [f"{at}/in", erp(spark, sf_dir), COMPANY, f"{at}/out", f"{at}/state"]
    plan_stream(spark, *paths, manifests=True, **options).awaitTermination()
    return f"{at}/out"


def _by_manifest(spark, sf_dir):
    at = scratch_path(spark, "drops")
    _drop(spark, sf_dir, f"{at}/in", "a", "1")
    return spark.read.parquet(f"{_run_stream(spark, sf_dir, at)}/outcome").drop("batch", "prefix")


def _states(spark, out):
    """What became of each drop, with the rows of its outcome."""
    done = spark.read.parquet(f"{out}/outcome").groupBy("prefix").agg(F.sum(F.col("created") + F.col("updated") + F.col("errors")).alias("rows"))
    states = ledger(spark, out).join(done, "prefix", "left")
    return states.select(F.element_at(F.split("prefix", "/"), -1).alias("drop"), "state", F.coalesce("rows", F.lit(0)).alias("rows"))


def _repeated_drop(spark, sf_dir):
    """The same drop again under another prefix, found by a later trigger."""
    at = scratch_path(spark, "drops")
    _drop(spark, sf_dir, f"{at}/in", "a", "1")
    _run_stream(spark, sf_dir, at)
    _drop(spark, sf_dir, f"{at}/in", "b", "1", files=f"{at}/in/a")
    return _states(spark, _run_stream(spark, sf_dir, at))


def _late_drop(spark, sf_dir):
    """A drop whose manifest comes first and whose files come later; ``waited`` is what the first trigger saw."""
    at = scratch_path(spark, "drops")
    _drop(spark, sf_dir, f"{at}/kept", "a", "1")
    _drop(spark, sf_dir, f"{at}/in", "a", "1", files=f"{at}/kept/a")
    out = _run_stream(spark, sf_dir, at)
    waited = ledger(spark, out).filter("state = 'waiting'").count() == 1
    for path in spark.read.format("binaryFile").load(f"{at}/kept/a/decisions.parquet").select("path").collect():
        copy_file(spark, path[0], f"{at}/in/a/decisions.parquet/{path[0].rsplit('/', 1)[-1]}")
    return _states(spark, _run_stream(spark, sf_dir, at)).withColumn("waited", F.lit(waited))


def _earlier_records(spark, sf_dir):
    """The rules that a first drop makes, as a second one with the same wishes updates them by their planned ids."""
    at = scratch_path(spark, "drops")
    for name in ("a", "b"):
        _drop(spark, sf_dir, f"{at}/in", name, name)
    out = _run_stream(spark, sf_dir, at, cleanup=False)
    made = spark.read.parquet(f"{out}/orderpoint_creates").select(F.col("planned_id").alias("orderpoint_id"), "product_id", "location_id")
    return spark.read.parquet(f"{out}/orderpoint_updates").drop("batch", "prefix").join(made, "orderpoint_id").drop("orderpoint_id")


def _runs(spark, sf_dir):
    source = erp(spark, sf_dir)
    return source["export_run"], source["export_chunk"]


NOW = "TIMESTAMP '2000-01-01 00:00:00'"


def _expired(part):
    def run(spark, sf_dir):
        runs, chunks = _runs(spark, sf_dir)
        gone = runlog.expired(runs, F.lit("2000-01-01 00:00:00").cast("timestamp_ntz"))
        return runlog.drop_runs(runs, chunks, gone)[part].select("id", "state")

    return run


def _cancelled(part):
    def run(spark, sf_dir):
        kept = runlog.cancel_runs(*_runs(spark, sf_dir))[part]
        return kept.select("id", "state", "error_message") if part == 0 else kept.select("id", "state")

    return run


def _named_chunks(spark, sf_dir):
    chunks = _runs(spark, sf_dir)[1]
    return chunks.select("id", runlog.chunk_file_name().alias("file"))


def _capabilities(spark, sf_dir):
    row = capabilities(erp(spark, sf_dir))
    parts = [F.col(f"{g}.{f.name}").alias(f"{g}_{f.name}") for g in ("modules", "data") for f in row.schema[g].dataType.fields]
    spoken = [F.array_join("languages.active", ",").alias("active"), *[F.col(f"languages.lang{i}").alias(f"lang{i}") for i in (1, 2, 3)]]
    return row.select("mode", "odoo_version", "database", "warehouses", "companies", *parts, *spoken)


def _language_texts(spark, sf_dir):
    """Language lookup with a present, a partly missing, an absent and a malformed language code."""
    codes = {"en": "en_US", "fr": "fr_FR", "de": "de_DE", "bad": "en_US'"}
    names = erp(spark, sf_dir)["product_template"]
    return names.select("id", *[json_text("name", language_key(code)).alias(n) for n, code in codes.items()])


def queries():
    return {
        "source_relation_rows": _source_rows,
        "source_parquet_catalog": _parquet_source,
        "source_first_existing_table": lambda s, d: packages(erp(s, d, "18")).select("id", "name", "company_id"),
        "source_decisions_file": lambda s, d: read_decisions(s, _decision_file(s, d)),
        "source_files_listed": _folders,
        "file_checksums": _text_checksums,
        "sink_chunks_sale_order_line": _chunked_roundtrip("sale_order_line"),
        "sink_chunks_stock_quant": _chunked_roundtrip("stock_quant"),
        "sink_whole_pos_order_line": _chunked_roundtrip("pos_order_line"),
        "sink_version_stamp": _stamps,
        "sink_chunk_facts": _chunk_facts,
        "chunk_spans": _spans,
        "chunk_plans": _chunk_plans,
        "chunk_key_ranges": _ranges,
        "manifest_rows": _manifest_rows,
        "manifest_document": _document,
        "manifest_full_export": _full_export,
        "manifest_sound": _sound,
        "manifest_tampered": _tampered,
        "integrity_report": lambda s, d: integrity_report(erp(s, d)),
        "list_aggregate": lambda s, d: id_lists(
            erp(s, d)["stock_move_move_rel"], "move_dest_id", "move_orig_id", ids="move_orig_id"
        ),
        "language_lookup": _language_texts,
        "profile_source": lambda s, d: profile(erp(s, d)).withColumn("active_languages", F.array_join("active_languages", ",")),
        "runlog_keep_newest": lambda s, d: runlog.keep_newest(_runs(s, d)[0]).select("id", "state"),
        "runlog_open": lambda s, d: runlog.open_runs(_runs(s, d)[0]).select("id", "state"),
        "runlog_expired_runs": _expired(0),
        "runlog_expired_chunks": _expired(1),
        "runlog_chunk_states": lambda s, d: runlog.chunk_states(_runs(s, d)[1]),
        "runlog_chunk_errors": lambda s, d: runlog.chunk_errors(_runs(s, d)[1]),
        "runlog_chunk_files": _named_chunks,
        "runlog_cancelled_runs": _cancelled(0),
        "runlog_cancelled_chunks": _cancelled(1),
        "file_checksums_all": lambda s, d: checksums(s, d),
        "capabilities_summary": _capabilities,
        "receive_outcome": _received,
        "receive_damaged": _damaged,
        "stream_by_manifest": _by_manifest,
        "stream_repeated_drop": _repeated_drop,
        "stream_late_drop": _late_drop,
        "stream_earlier_records": _earlier_records,
        "stream_outcome": _streamed("outcome"),
        "stream_transfers": _streamed("transfers"),
        "stream_messages": _streamed("messages"),
    }


def _span_sql(entity):
    return f"SELECT '{entity}' AS entity, count(*) AS rows, ifnull(min(id), 0) AS low, ifnull(max(id), 0) AS high FROM {primary_relation(entity)}"


SPANS = " UNION ALL ".join(_span_sql(e) for e in CHUNKABLE)
STEPS = f"""SELECT *, CASE WHEN rows > {MAX_ROWS} AND high > low
    THEN CAST(ceil((high - low + 1) / ceil(rows / {MAX_ROWS})) AS BIGINT) ELSE 0 END AS step FROM spans"""
PLANS = """SELECT entity, unnest(range(CAST(CASE WHEN step > 0 THEN ceil((high - low + 1) / step) ELSE 1 END AS BIGINT))) AS sequence, low, high, step FROM steps"""


def _missing_sql(child, column, parent):
    return f"""SELECT '{child}' AS child, '{column}' AS key_column, '{parent}' AS parent, count(DISTINCT {column}) AS missing_keys, count(*) AS orphan_rows
        FROM x_{child} AS c WHERE {column} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM x_{parent} AS p WHERE p.{key_column(parent)} = c.{column})"""


def _exists(relation, where="TRUE"):
    return f"EXISTS (SELECT 1 FROM {relation} WHERE {where})"


def oracle_sql():
    decision_columns = ", ".join(decision_schema().names)
    shared = writeback_sql()
    flags = {
        f"has_{n}": f"EXISTS (SELECT 1 FROM ir_module_module WHERE name = '{m}' AND state = 'installed')"
        for n, m in (
            ("stock", "stock"), ("sale", "sale"), ("purchase", "purchase"), ("mrp", "mrp"), ("mrp_subcontracting", "mrp_subcontracting"),
            ("product_expiry", "product_expiry"), ("purchase_requisition", "purchase_requisition"), ("pos", "point_of_sale"),
            ("quality", "quality"), ("mrp_mps", "mrp_mps"),
        )
    } | {
        "has_inventory_data": _exists("stock_quant", "quantity <> 0 OR reserved_quantity <> 0"),
        "has_open_moves": _exists("stock_move", "state NOT IN ('done', 'cancel')"),
        "has_manufacturing_data": _exists("mrp_production"),
        "has_orderpoint_data": _exists("stock_warehouse_orderpoint"),
        "has_sale_data": _exists("sale_order_line"),
        "has_purchase_data": _exists("purchase_order_line"),
        "has_supplier_info": _exists("product_supplierinfo"),
        "source_version": "(SELECT latest_version FROM ir_module_module WHERE name = 'base')",
        "company_count": "(SELECT count(*) FROM res_company)",
        "warehouse_count": "(SELECT count(*) FROM stock_warehouse)",
        "active_languages": "(SELECT string_agg(code, ',' ORDER BY code) FROM res_lang WHERE active)",
        "mode": "'inventory'",
    }
    names = {"stock": "stock", "sale": "sale", "purchase": "purchase", "mrp": "mrp", "mrp_subcontracting": "mrp_subcontracting",
             "mrp_mps": "mrp_mps", "product_expiry": "product_expiry", "pos": "pos", "quality": "quality"}
    data = {"inventory": "inventory_data", "open_moves": "open_moves", "manufacturing": "manufacturing_data", "orderpoints": "orderpoint_data",
            "sales": "sale_data", "purchases": "purchase_data", "supplier_info": "supplier_info"}
    code = "(SELECT code FROM res_lang WHERE active ORDER BY code LIMIT 1 OFFSET {})"
    shown = {
        "mode": flags["mode"], "odoo_version": flags["source_version"], "database": "''", "warehouses": flags["warehouse_count"],
        "companies": flags["company_count"], "active": flags["active_languages"],
    } | {f"modules_{n}": flags[f"has_{f}"] for n, f in names.items()} | {f"data_{n}": flags[f"has_{f}"] for n, f in data.items()}
    shown |= {"lang1": f"ifnull({code.format(0)}, 'en_US')", "lang2": code.format(1), "lang3": code.format(2)}
    involved = {e for child, _, parent in LINKS for e in (child, parent)}
    exported = {f"x_{e}": entity_sql(e) for e in sorted(involved)}
    entity_rows = " UNION ALL ".join(
        f"SELECT '{e}' AS collector, {key_column(e)} AS k FROM ({entity_sql(e)}) AS x" for e in EXPORTED
    )
    cut_rows = f"""SELECT collector AS entity, CASE WHEN step > 0 THEN low + CAST(floor((k - low) / step) AS BIGINT) * step ELSE 0 END AS key_from
        FROM ({entity_rows}) AS r LEFT JOIN steps ON entity = collector"""
    cut = {"spans": SPANS, "steps": STEPS, "cut_rows": cut_rows}
    gone = f"state = 'done' AND finished_at < {NOW} - INTERVAL 30 DAY"
    stopped = "state IN ('pending', 'collecting', 'uploading')"
    return {
        "source_relation_rows": with_relations(
            " UNION ALL ".join(f"SELECT '{n}' AS relation, count(*) AS rows FROM {n}" for n in SOURCES)
        ),
        "source_parquet_catalog": with_relations("SELECT id, name, state, partner_id FROM sale_order"),
        "source_first_existing_table": with_relations("SELECT id, name, company_id FROM stock_package"),
        "source_decisions_file": with_relations(f"SELECT {decision_columns} FROM decisions"),
        "source_files_listed": with_relations(
            "SELECT DISTINCT entity || CASE WHEN key_from > 0 THEN '/key_from=' || key_from ELSE '' END AS folder FROM cut_rows", **cut
        ),
        "sink_chunks_sale_order_line": with_relations(entity_sql("sale_order_line")),
        "sink_chunks_stock_quant": with_relations(entity_sql("stock_quant")),
        "sink_whole_pos_order_line": with_relations(entity_sql("pos_order_line")),
        "sink_version_stamp": with_relations(
            f"SELECT collector AS entity, '19.0' AS odoo_version, count(*) AS rows FROM ({entity_rows}) AS r GROUP BY collector"
        ),
        "sink_chunk_facts": with_relations("SELECT entity, key_from, count(*) AS rows, TRUE AS sound FROM cut_rows GROUP BY entity, key_from", **cut),
        "chunk_spans": with_relations(SPANS),
        "chunk_plans": with_relations(
            """SELECT entity, sequence, CASE WHEN step > 0 THEN low + sequence * step ELSE 0 END AS key_from,
            CASE WHEN step > 0 THEN least(low + (sequence + 1) * step, high + 1) ELSE 0 END AS key_to FROM plans UNION ALL SELECT 'uom', 0, 0, 0""",
            spans=SPANS, steps=STEPS, plans=PLANS,
        ),
        "chunk_key_ranges": with_relations(
            f"SELECT *, CASE WHEN _odoo_quant_id < 20000 THEN 0 WHEN _odoo_quant_id < 90000 THEN 20000 ELSE 90000 END AS key_from FROM ({entity_sql('stock_quant')}) AS x"
        ),
        "file_checksums": """SELECT c_nationkey AS nation, sum(strlen(c_name) + 1)::BIGINT AS bytes,
            'sha256:' || sha256(string_agg(c_name || chr(10), '' ORDER BY c_custkey)) AS checksum
            FROM customer GROUP BY c_nationkey""",
        "manifest_document": with_relations(
            f"""SELECT 'full' AS export_mode, '19.0' AS odoo_version, '' AS company, TRUE AS named,
            count(DISTINCT collector) AS entities, count(*) AS rows FROM ({entity_rows}) AS r"""
        ),
        "manifest_full_export": with_relations(
            " UNION ALL ".join(f"SELECT '{e}' AS collector, count(*) AS rows, 0 AS errors FROM ({entity_sql(e)}) AS e HAVING count(*) > 0" for e in ENTITIES)
        ),
        "manifest_rows": with_relations(f"SELECT collector, count(*) AS rows FROM ({entity_rows}) AS r GROUP BY collector"),
        "manifest_sound": with_relations(
            f"SELECT count(DISTINCT collector) AS entities, 0 AS errors, 0 AS row_errors FROM ({entity_rows}) AS r"
        ),
        "manifest_tampered": with_relations(
            f"""SELECT DISTINCT kind, collector AS entity FROM ({entity_rows}) AS r, (VALUES ('Missing file'), ('Checksum mismatch')) AS k(kind)"""
        ),
        "integrity_report": with_relations(" UNION ALL ".join(_missing_sql(*link) for link in LINKS), **exported),
        "list_aggregate": with_relations(
            "SELECT move_dest_id, string_agg(CAST(move_orig_id AS VARCHAR), ',' ORDER BY move_orig_id) AS ids FROM stock_move_move_rel GROUP BY move_dest_id"
        ),
        "language_lookup": with_relations(
            "SELECT id, name ->> 'en_US' AS en, name ->> 'fr_FR' AS fr, name ->> 'de_DE' AS de, CAST(NULL AS VARCHAR) AS bad FROM product_template"
        ),
        "profile_source": with_relations("SELECT " + ", ".join(f"{v} AS {k}" for k, v in flags.items())),
        "runlog_keep_newest": with_relations(
            "SELECT id, state FROM export_run WHERE state <> 'done' OR id IN (SELECT id FROM export_run WHERE state = 'done' ORDER BY id DESC LIMIT 3)"
        ),
        "runlog_open": with_relations("SELECT id, state FROM export_run WHERE state NOT IN ('done', 'error')"),
        "runlog_expired_runs": with_relations(f"SELECT id, state FROM export_run WHERE NOT ifnull({gone}, FALSE)"),
        "runlog_expired_chunks": with_relations(f"SELECT id, state FROM export_chunk WHERE run_id NOT IN (SELECT id FROM export_run WHERE {gone})"),
        "runlog_chunk_states": with_relations("SELECT run_id, state, count(*) AS chunks FROM export_chunk GROUP BY run_id, state"),
        "runlog_chunk_errors": with_relations(
            "SELECT run_id, sequence, collector || ': ' || ifnull(error_message, state) AS error FROM export_chunk WHERE state = 'error'"
        ),
        "runlog_chunk_files": with_relations(
            "SELECT id, collector || CASE WHEN key_from > 0 THEN '_' || key_from ELSE '' END || '.parquet' AS file FROM export_chunk"
        ),
        "runlog_cancelled_runs": with_relations(
            f"SELECT id, CASE WHEN {stopped} THEN 'error' ELSE state END AS state, CASE WHEN {stopped} THEN 'Cancelled by user' END AS error_message FROM export_run"
        ),
        "runlog_cancelled_chunks": with_relations(
            f"SELECT id, state FROM export_chunk WHERE NOT (state IN ('pending', 'created') AND run_id IN (SELECT id FROM export_run WHERE {stopped}))"
        ),
        "capabilities_summary": with_relations("SELECT " + ", ".join(f"{v} AS {k}" for k, v in shown.items())),
        "receive_outcome": shared["decision_outcome"],
        "receive_damaged": with_relations(
            """SELECT DISTINCT 'Manifest validation failed' AS error, 'Missing file: decisions.parquet/' || decision_type || '.parquet' AS detail
            FROM decisions WHERE decision_type IS NOT NULL UNION ALL SELECT 'Manifest validation failed', 'Checksum mismatch'"""
        ),
        "stream_by_manifest": shared["decision_outcome"],
        "stream_repeated_drop": f"""SELECT 'a' AS "drop", 'planned' AS state, sum(created + updated + errors)::BIGINT AS rows FROM ({shared["decision_outcome"]}) AS o
            UNION ALL SELECT 'b', 'repeated', 0""",
        "stream_late_drop": f"""SELECT 'a' AS "drop", 'planned' AS state, sum(created + updated + errors)::BIGINT AS rows, TRUE AS waited
            FROM ({shared["decision_outcome"]}) AS o""",
        "stream_earlier_records": writeback_rules_kept(),
        "stream_outcome": shared["decision_outcome"],
        "stream_transfers": shared["plan_transfers"],
        "stream_messages": shared["decision_messages"],
    }
