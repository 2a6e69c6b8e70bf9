"""Exporting a source: entities as Parquet in key chunks, then the manifest."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from datetime import UTC, datetime
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside import __version__
from quayside.functions.durable import in_steps, set_aside, shuffles_removed
from quayside.operators import EXPORTS, export, left_out
from quayside.operators.chunks import MAX_CHUNK_ROWS, Cut, entity_cut, in_chunks
from quayside.plans.manifest import file_facts, write_manifest
from quayside.schemas import key_column, outbound_schema
from quayside.sources.catalog import Erp


def stamped(df: DataFrame, source_version: str) -> DataFrame:
    """``df`` with the exporter's and the source's version on its first column.

    Spark keeps column metadata in the footer of every Parquet file it writes.
    """
    versions = {"exporter_version": __version__, "odoo_version": source_version or "unknown"}
    first, *rest = df.columns
    return df.select(F.col(first).alias(first, metadata=versions), *rest)


def versions_of(df: DataFrame) -> dict[str, str]:
    """The versions that :func:`stamped` left on a table."""
    return dict(df.schema[0].metadata)


def write_entity(
    df: DataFrame, entity: str, root: str, cut: Cut, source_version: str = "", max_rows: int = MAX_CHUNK_ROWS
) -> None:
    """Write an entity below ``root``: whole, or in one folder per chunk in key order.

    Chunks are cut by key value, and keys may cluster. Rows are range-partitioned on the key, which
    Spark balances by sampling, so a crowded chunk is written by several tasks into several files. They are set aside
    first: the shuffles of the joins are gone when the rows are dealt to their chunks, and no join runs again for the sample.
    """
    path = f"{root.rstrip('/')}/{entity}"

    def written(rows: DataFrame, *folders: str) -> None:
        writer = rows.write.mode("overwrite").option("compression", "snappy").option("maxRecordsPerFile", max_rows)
        writer.partitionBy(*folders).parquet(path)

    if not cut.step:
        written(stamped(df, source_version))
        return
    key = key_column(entity)
    with set_aside(df, entity, steps_done=True) as rows:
        chunks = in_chunks(stamped(rows, source_version), entity, cut)
        written(chunks.repartitionByRange(key).sortWithinPartitions(key), "key_from")


def read_entity(spark: SparkSession, entity: str, root: str) -> DataFrame:
    """An exported entity, all chunks together."""
    columns = outbound_schema(entity).names
    return spark.read.parquet(f"{root.rstrip('/')}/{entity}").select(*columns)


def run_export(
    erp: Erp,
    root: str,
    entities: list[str] | None = None,
    *,
    spark: SparkSession,
    company: str = "",
    company_id: int = 0,
    source_version: str = "",
    max_rows: int = MAX_CHUNK_ROWS,
    capabilities: DataFrame | None = None,
    jobs: int = 4,
) -> str:
    """Export entities below ``root`` and write their manifest. Returns the run's id.

    Without ``entities``, all but those whose declared modules or relations the source lacks, which the manifest's
    warnings name. The manifest lists what this run wrote, not what an earlier one left. An entity that fails, for a
    missing column too, is one of its errors and the others go on. Entities do not depend
    on each other, so ``jobs`` of them are handed to Spark at a time. Of those that are cut into chunks, which fill the
    cluster alone, one at a time, the largest first: what an entity shuffled is removed when it is written, so the disk holds
    the shuffles of one large entity and of ``jobs - 1`` small ones, and most of what is exported comes after the largest.
    """
    started, run_uuid = datetime.now(UTC), str(uuid.uuid4())
    cuts: dict[str, Cut] = {}
    spent: dict[str, float] = {}
    errors: list[str] = []
    absent = left_out(erp) if entities is None else {}
    wanted = entities if entities is not None else [e for e in EXPORTS if e not in absent]

    def cut(entity: str) -> None:
        cuts[entity] = entity_cut(erp, entity, max_rows)

    def write(entity: str) -> None:
        with in_steps():
            write_entity(export(entity, erp), entity, root, cuts[entity], source_version, max_rows)

    def attempted(work: Callable[[str], None], entity: str) -> None:
        begin = time.monotonic()
        try:
            work(entity)
        except Exception as error:
            errors.append(f"{entity}: {error}")
            spent.pop(entity, None)
        else:
            spent[entity] = spent.get(entity, 0.0) + time.monotonic() - begin

    with shuffles_removed(spark):
        with ThreadPoolExecutor(jobs) as pool:
            list(pool.map(partial(attempted, cut), wanted))
        whole = [e for e in wanted if e in cuts and not cuts[e].step]
        chunked = [e for e in wanted if e in cuts and cuts[e].step]
        chunked.sort(key=lambda e: cuts[e].rows * len(outbound_schema(e)), reverse=True)
        with ThreadPoolExecutor(1) as one, ThreadPoolExecutor(max(1, jobs - 1)) as some:
            one.map(partial(attempted, write), chunked)
            (some if jobs > 1 else one).map(partial(attempted, write), whole)
    seconds = {entity: round(took, 3) for entity, took in spent.items()}
    write_manifest(
        file_facts(spark, root, seconds).filter(F.col("collector").isin(*seconds)),
        root,
        company=company,
        company_id=company_id,
        source_version=source_version,
        run_uuid=run_uuid,
        started_at=started,
        finished_at=datetime.now(UTC),
        errors=sorted(errors),
        warnings=[f"{entity}: left out, the source has no {what}" for entity, what in absent.items()],
        capabilities=capabilities,
    )
    return run_uuid
