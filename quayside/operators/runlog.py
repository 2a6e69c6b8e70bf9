"""The log of export runs and their chunks: retention, progress, cancelling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.functions.columns import first_column

# States of runs that are under way, and of chunks a cancelled run drops.
OPEN_RUN_STATES = ("pending", "collecting", "uploading")
DROPPED_CHUNK_STATES = ("pending", "created")
FINISHED_RUN_STATES = ("done", "error")


def open_runs(runs: DataFrame) -> DataFrame:
    return runs.filter(~F.col("state").isin(*FINISHED_RUN_STATES))


def keep_newest(runs: DataFrame, keep_last: int = 3) -> DataFrame:
    """Drop finished runs but for the newest ``keep_last``; runs in any other state stay."""
    newest = runs.filter(F.col("state") == "done").select("id").orderBy(F.desc("id")).limit(keep_last)
    kept = newest.withColumn("_kept", F.lit(True))
    rows = runs.join(kept, "id", "left")
    done = F.coalesce(F.col("state") == "done", F.lit(False))  # a run without a state is in another state
    return rows.filter(~done | F.col("_kept").isNotNull()).drop("_kept")


def expired(runs: DataFrame, now: Column, days: int = 30) -> DataFrame:
    """Finished runs whose end is more than ``days`` before ``now``."""
    return runs.filter((F.col("state") == "done") & (F.col("finished_at") < now - F.make_dt_interval(F.lit(days))))


def drop_runs(runs: DataFrame, chunks: DataFrame, gone: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Runs and chunks without the runs in ``gone``; a run takes its chunks with it."""
    ids = gone.select("id")
    return runs.join(ids, "id", "left_anti"), chunks.join(ids.withColumnRenamed("id", "run_id"), "run_id", "left_anti")


def chunk_states(chunks: DataFrame) -> DataFrame:
    """Chunks per run and state."""
    return chunks.groupBy("run_id", "state").agg(F.count("*").alias("chunks"))


def cancel_runs(runs: DataFrame, chunks: DataFrame, message: str = "Cancelled by user") -> tuple[DataFrame, DataFrame]:
    """Mark open runs as failed and drop their pending and created chunks."""
    stopped = F.col("state").isin(*OPEN_RUN_STATES)
    said = first_column(runs, "error_message").cast("string")
    marked = runs.withColumns(
        {
            "error_message": F.when(stopped, F.lit(message)).otherwise(said),
            "state": F.when(stopped, "error").otherwise(F.col("state")),
        }
    )
    ids = runs.filter(stopped).select(F.col("id").alias("run_id"), F.lit(True).alias("_stopped"))
    dropped = F.col("_stopped").isNotNull() & F.col("state").isin(*DROPPED_CHUNK_STATES)
    return marked, chunks.join(ids, "run_id", "left").filter(~F.coalesce(dropped, F.lit(False))).drop("_stopped")


def chunk_errors(chunks: DataFrame) -> DataFrame:
    """Error lines of a run's manifest: entity and message, or the state where no message was kept."""
    text = F.concat("collector", F.lit(": "), F.coalesce("error_message", "state"))
    return chunks.filter(F.col("state") == "error").select("run_id", "sequence", text.alias("error"))


def chunk_file_name() -> Column:
    """Name of a chunk's file: the entity, and the first key where it is positive."""
    suffix = F.when(F.col("key_from") > 0, F.concat(F.lit("_"), F.col("key_from").cast("string"))).otherwise("")
    return F.concat("collector", suffix, F.lit(".parquet"))
