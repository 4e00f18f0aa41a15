"""Corpus pipeline: quality rules, near-duplicates, decontamination, mixing, sharding.

Each stage takes what its predecessor kept; ``run`` writes every stage to the shared folder as Parquet and reads it back.

Cases: null and empty texts fail the quality rules; null ids sort last among near-duplicates; a null source is a source of
its own; repeated rows are one class, of which one row stays; further columns, whatever their names, are kept by all stages
but the last; texts are read whole; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framegrid.llm import common, decontaminate, mixing, near_dups, quality, sharding


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rule and the compression bands."""
    common.tune(spark)
    return quality.keep(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class."""
    common.tune(spark)
    return near_dups.distinct(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    common.tune(spark)
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixing_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    common.tune(spark)
    return mixing.sent(docs)


def shard_assignment(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, size, shard and slot of each row."""
    common.tune(spark)
    return sharding.shards(docs).select("doc_id", "size", "text_crc32", "shard", F.col("slot").cast("long"))


STAGES = [
    ("quality rules", quality_rules),
    ("near-duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mixing_sources),
    ("sharding", shard_assignment),
]
#: SQL has neither zstandard ratios nor edit distances to parts of a text; tests/llm/test_pipeline.py compares with plain stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table; each result is stored before the next stage reads it, and what it was made of is deleted."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    begun = common.stored()
    for name, stage in STAGES:
        made = stage(spark, docs, sf_dir)
        before = common.stored()
        docs = common.saved(made, name.replace(" ", "-"))
        kept = common.stored() - before
        common.release(common.stored() - begun - kept)
    return docs
