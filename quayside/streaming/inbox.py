"""The decision inbox as a stream: each new drop is planned once and alone."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quayside.functions.durable import settled, shuffles_removed
from quayside.plans.receive import Received, receive
from quayside.plans.writeback import ORIGIN, Batch, plan_decisions
from quayside.schemas import decision_schema
from quayside.sources.catalog import Erp, utc
from quayside.sources.files import decoded
from quayside.streaming.ledger import MADE, PLANNED, REFUSED, REPEATED, WAITING, enter, ledger, planned_id, with_planned

SEEN_BEFORE = "Drop was planned before"
_ARRIVAL = "path string, modificationTime timestamp, length long, content binary"


def decision_stream(spark: SparkSession, folder: str, files_per_batch: int | None = None) -> DataFrame:
    """Decision files dropped anywhere below ``folder``, as an unbounded table."""
    reader = utc(spark).readStream.schema(decision_schema()).option("recursiveFileLookup", True)
    reader = reader.option("pathGlobFilter", "*.parquet")
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


def arrival_stream(spark: SparkSession, folder: str, files_per_batch: int | None = None) -> DataFrame:
    """``path`` and ``modificationTime`` of files of any kind dropped anywhere below ``folder``; none is read."""
    reader = utc(spark).readStream.format("binaryFile").schema(_ARRIVAL).option("recursiveFileLookup", True)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(folder).select("path", "modificationTime")


def _tables(plan: Batch) -> dict[str, DataFrame]:
    tables = dict(plan.writes) | {f"delete_{k}": v for k, v in plan.deletes.items()}
    return tables | {"outcome": plan.outcome, "messages": plan.messages}


class _Sink:
    """The tables of one batch: the first write to one replaces what an earlier run of the batch left."""

    def __init__(self, path: str, batch_id: int, jobs: int):
        self.path, self.batch_id, self.jobs, self.begun = path, batch_id, jobs, set()

    def write(self, tables: dict[str, DataFrame], prefix: str) -> None:
        def one(name: str) -> None:
            mode = "append" if name in self.begun else "overwrite"
            rows = tables[name].withColumn("prefix", F.lit(prefix))
            rows.write.mode(mode).parquet(f"{self.path}/{name}/batch={self.batch_id}")

        with ThreadPoolExecutor(max_workers=self.jobs) as pool:
            list(pool.map(one, tables))
        self.begun |= set(tables)


def plan_stream(
    spark: SparkSession,
    folder: str,
    erp: Erp | Callable[[], Erp],
    company_id: int,
    sink: str,
    checkpoint: str,
    origin: str = ORIGIN,
    cleanup: bool = True,
    files_per_batch: int | None = None,
    jobs: int = 4,
    manifests: bool = False,
    patience: int | None = None,
) -> StreamingQuery:
    """Plan all new drops and stop. A batch that is run again overwrites its own folders only.

    A drop is what lies under one prefix: ``decisions.parquet``, or other Parquet files of one folder. Drops that
    wait together share a batch but are planned one by one; ``prefix`` in each table tells them apart. An ``erp`` that is a
    function is called for each batch, so that the source is opened anew. The tables of a drop are independent; ``jobs`` of
    them are written at a time. What a table of a drop shuffled is removed when it is written.

    Without ``manifests`` files are planned as they come, unchecked. With them, a ``manifest.json`` is what starts a drop,
    and what it lists is planned by :func:`receive`. The table ``ledger`` remembers drops across batches and restarts:

    * A drop whose manifest was planned before, under this prefix or another, is refused.
    * One whose listed files are not all there waits: whenever files arrive, drops that wait are looked at again. After
      ``patience`` such batches it is refused; without it, it waits for good.
    * Any other error of the manifest refuses the drop. Refusals are written to the table ``refused``.
    * A drop is planned as if the records of the drops before it had been created: their ids, ``planned_id`` in the
      tables, are from ``PLANNED_FROM`` on, and it updates or deletes them by those.
    """
    source = erp if callable(erp) else lambda: erp

    def unchecked(batch: DataFrame, batch_id: int) -> None:
        out, now = _Sink(sink, batch_id, jobs), source()
        # a prefix is worked out for each file, not for each row
        prefix_of = F.regexp_replace(decoded(F.col("__path")), r"(/decisions\.parquet/.*|/[^/]+)$", "")
        files = settled(batch.select("__path").distinct().withColumn("__prefix", prefix_of), "arrived")
        prefixes = sorted(r[0] for r in files.select("__prefix").distinct().collect())
        for prefix in prefixes:
            rows = batch
            if len(prefixes) > 1:
                rows = batch.join(files.filter(F.col("__prefix") == prefix), "__path", "left_semi")
            rows = rows.drop("__path")
            out.write(_tables(plan_decisions(rows, now, company_id, origin, cleanup)), prefix)

    def by_manifest(batch: DataFrame, batch_id: int) -> None:
        out, now = _Sink(sink, batch_id, jobs), source()
        known = ledger(spark, sink, batch_id)
        waiting = {r.prefix: r for r in known.filter(F.col("state") == WAITING).collect()}
        came = batch.filter(F.col("path").rlike(r"(^|/)manifest\.json$")).collect()
        came = sorted((r.modificationTime, r.path.rsplit("/", 1)[0]) for r in came)
        drops = list(dict.fromkeys([*sorted(waiting, key=lambda p: (waiting[p].since, p)), *(p for _, p in came)]))
        if not drops:
            return
        sums = _checksums(spark, drops)
        planned = known.filter(F.col("state") == PLANNED)
        seen = {r.checksum: r.prefix for r in planned.filter(F.col("checksum").isin(*sums.values())).collect()}
        number = (planned.agg(F.max("number")).first()[0] or 0) + 1
        entries, done = [], []

        def refuse(errors: DataFrame, prefix: str) -> None:
            out.write({"refused": errors}, prefix)

        for prefix in drops:
            checksum = sums.get(prefix)
            since = waiting[prefix].since if prefix in waiting else batch_id
            if checksum in seen:
                refuse(spark.createDataFrame([(SEEN_BEFORE, seen[checksum])], "error string, detail string"), prefix)
                entries.append((checksum, prefix, REPEATED, seen[checksum], since, None))
                continue
            earlier = (F.col("batch") < batch_id) | ((F.col("batch") == batch_id) & F.col("prefix").isin(*done))
            got: Received = receive(spark, prefix, with_planned(now, spark, sink, company_id, earlier), company_id, origin, cleanup)
            if got.batch is not None:
                tables = _tables(got.batch)
                for name in MADE:
                    tables[name] = got.batch.placed[name].withColumn("planned_id", planned_id(number)).drop("_row")
                out.write(tables, prefix)
                entries.append((checksum, prefix, PLANNED, None, since, number))
                seen[checksum], number = prefix, number + 1
                done.append(prefix)
            elif got.missing and (patience is None or batch_id - since < patience):
                entries.append((checksum, prefix, WAITING, f"{len(got.missing)} files", since, None))
            else:
                refuse(got.errors, prefix)
                entries.append((checksum, prefix, REFUSED, got.errors.first().error, since, None))
        enter(spark, sink, batch_id, entries)

    def tidied(batch: DataFrame, batch_id: int) -> None:
        # a batch belongs to the stream's own session, the source to the caller's
        with shuffles_removed(spark), shuffles_removed(batch.sparkSession):
            apply(batch, batch_id)

    if manifests:
        files, apply = arrival_stream(spark, folder, files_per_batch), by_manifest
    else:
        files, apply = decision_stream(spark, folder, files_per_batch), unchecked
        files = files.withColumn("__path", F.col("_metadata.file_path"))
    return (
        files.writeStream.foreachBatch(tidied)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _checksums(spark: SparkSession, prefixes: list[str]) -> dict[str, str]:
    """SHA-256 of the manifests of some drops; one that is gone has none."""
    out = {}
    for prefix in prefixes:
        text = spark.read.option("ignoreMissingFiles", True).text(f"{prefix}/manifest.json", wholetext=True)
        row = text.select(F.sha2("value", 256).alias("sum")).first()
        if row is not None:
            out[prefix] = row["sum"]
    return out
