"""Listing many folders: a task looks through many of them."""

import uuid

from quayside.sources.files import checksums, list_files, row_counts

FOLDERS = 60


def _tasks(spark, run):
    """The most tasks that a stage of ``run`` had, and its rows."""
    context, group = spark.sparkContext, uuid.uuid4().hex
    context.setJobGroup(group, group)
    try:
        rows = run().collect()
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    tracker = context.statusTracker()
    stages = [s for j in tracker.getJobIdsForGroup(group) for s in tracker.getJobInfo(j).stageIds]
    return max(i.numTasks for i in map(tracker.getStageInfo, stages) if i is not None), rows


def test_folders_are_listed_by_a_few_tasks_for_each_core(spark, tmp_path):
    spark.range(FOLDERS, numPartitions=1).selectExpr("id", "id AS key_from").write.partitionBy("key_from").parquet(f"{tmp_path}/t")
    name = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    before = spark.conf.get(name)
    for run in (checksums, row_counts, list_files):
        most, rows = _tasks(spark, lambda run=run: run(spark, f"{tmp_path}/t"))
        found = [r for r in rows if r.file.endswith(".parquet")]
        assert len(found) == len({r.file for r in found}) == FOLDERS
        assert most <= 4 * spark.sparkContext.defaultParallelism
    assert sum(r.rows for r in row_counts(spark, f"{tmp_path}/t").collect()) == FOLDERS
    assert spark.conf.get(name) == before
