"""Corpus pipeline: documents in, packed training sequences out.

``STAGES`` lists (name, function). A function takes (spark, docs, sf_dir) and returns a DataFrame; its
rows are written as Parquet and reread as the next stage's ``docs``. All but the last return the
columns of ``documents``.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from chatloom.llm import decontaminate, jaccard_join, quality_rules, queries, substring_dedup
from chatloom.llm.common import table
from chatloom.session import scratch_path

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the current policy rejects go. The kept flag is a projection beside the text."""
    carried = docs.select(*COLUMNS)
    judged = quality_rules.judge(carried, quality_rules.POLICIES[-1])
    return judged.where("kept").select(*COLUMNS)


def jaccard_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of equal or near-equal documents, the one with the least id stays."""
    return jaccard_join.keep_one(docs, COLUMNS)


def substring_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words under a 50-word window that an earlier document has are cut out of the text."""
    return substring_dedup.drop_repeats(docs, COLUMNS, size="n_chars")


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that cover a benchmark item go."""
    return decontaminate.drop_leaks(docs.select(*COLUMNS), table(spark, sf_dir, "benchmark"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the remaining documents in sequences of at most 1024 tokens."""
    return queries.packed(docs)


STAGES = [
    ("quality_rules", quality_stage),
    ("jaccard_join", jaccard_stage),
    ("substring_dedup", substring_stage),
    ("decontamination", decontamination_stage),
    ("packing", packing_stage),
]

#: SQL cannot tokenise: the tests compare run() with a brute-force version of every stage
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
