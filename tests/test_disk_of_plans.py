"""What lookups, numbering and streams leave on disk."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import queries
from quayside.functions.durable import shared_folder
from quayside.functions.lookup import best_tier
from quayside.functions.numbering import number_rows


@pytest.fixture
def shuffled(spark):
    """Shuffle files that came since the test began."""

    def files():
        disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
        found = disk.getAllFiles()
        return {found.apply(i).getName() for i in range(found.size()) if found.apply(i).getName().startswith("shuffle_")}

    before = files()
    return lambda: files() - before


def test_a_lookup_leaves_its_line_alone(spark, shuffled):
    """No shuffles, and nothing of the tiers that were set aside."""
    folder = Path(shared_folder(spark).removeprefix("file:"), "quayside")
    before = set(folder.glob("*"))
    asks = spark.range(2000).select(F.col("id").alias("ask"), (F.col("id") % 50).alias("k"), (F.col("id") % 7).cast("double").alias("q"))
    tiers = spark.range(900).select("id", (F.col("id") % 90).alias("k"), (F.col("id") % 5).cast("double").alias("floor"), F.col("id").alias("price"))
    found = best_tier(asks, tiers, ("k",), "q", "floor", ("price",))
    assert not shuffled()
    assert [p.name.split("-")[0] for p in set(folder.glob("*")) - before] == ["line"]
    assert found.count() == 2000


def test_numbering_leaves_no_shuffles_of_its_rows(spark, shuffled):
    number_rows(spark.range(500).selectExpr("id", "CAST(id % 3 AS STRING) AS kind"), "kind", ("id",))
    assert len(shuffled()) <= 8  # of the counts for each partition, which are written next


@pytest.mark.parametrize("name", ["stream_messages", "stream_earlier_records"])
def test_a_stream_leaves_no_shuffles(spark, sf_dir, shuffled, name):
    rows = queries()[name](spark, sf_dir)
    assert len(shuffled()) <= 40, len(shuffled())
    assert rows.count() > 0
