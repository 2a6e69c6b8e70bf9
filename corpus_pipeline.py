"""The training-data pipeline: stages over ``documents``, each written and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quayside.functions.durable import settled
from quayside.llm import op2_sentencepiece, op4_jaccard_join, op5_source_mix, op7_quality_rules, op10_line_dedup
from quayside.llm.texts import small_batches

#: (name, function (spark, docs, sf_dir) -> DataFrame); all but the last return the columns of documents.
STAGES = [
    ("quality rules", op7_quality_rules.stage),
    ("line dedup", op10_line_dedup.stage),
    ("near duplicates", op4_jaccard_join.stage),
    ("source mix", op5_source_mix.stage),
    ("sentencepiece", op2_sentencepiece.stage),
]

#: Repetition, seeded choice and sampled segmentation have no SQL form; the tests hold each stage against a plain model.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in turn; each reads what the one before wrote under ``spark.checkpoint.dir``.

    Python gets small batches in every stage: an executor's heap has grown by the last one and leaves little beside it.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        with small_batches(spark):
            docs = settled(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
