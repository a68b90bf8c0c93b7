"""The corpus pipeline: ``documents`` through the stages of ``STAGES``.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run``
writes each result as Parquet into the shared folder and reads it back as
the next stage's docs.  All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick.llm import bpe, decontaminate, jaccard_join, line_dedup, quality
from candlewick.session import scratch_path, temporary
from candlewick.sources import fs


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines that other documents share."""
    return line_dedup.replace_lines(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return jaccard_join.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of the benchmark."""
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with digests of the ids and of the bytes
    that they decode to."""
    ranks, pattern = bpe.public_vocabulary()
    out = bpe.encode(docs, ranks, pattern, round_trip=True)
    return out.select("doc_id", "n_tokens", "ids", F.sha2("ids", 256).alias("ids_sha256"),
                      F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup_stage),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("bpe", tokens),
]

# The last stage is no SQL; tests/llm/test_pipeline.py holds run() against a
# plain Python version of all stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the last stage.  What a stage wrote for itself, and the result
    of the stage before, are deleted once its own result is written."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        with temporary(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        if before is not None:
            fs.delete(spark, before)
        docs, before = spark.read.parquet(path), path
    return docs
