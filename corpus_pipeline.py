"""A corpus pipeline: STAGES in order, each (name, function of (spark, docs, sf_dir)); run() applies them to documents.

Defined results, for every stage: an empty table gives an empty table; further columns, whatever their names, and null ids, languages and sources pass through as they are; what a stage does with null and empty texts, repeated rows and ties is stated at it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from voxtrail.llm.decontaminate import drop_leaks
from voxtrail.llm.minhash import drop_near_duplicates
from voxtrail.llm.mixing import mix_documents
from voxtrail.llm.quality import keep_good
from voxtrail.llm.shards import shard_documents


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or the divergence from their language reject go: null, empty and short texts among them. Repeated rows get equal verdicts."""
    return keep_good(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, of similarity 0.8 or more, stays: that of the least doc_id, null last; of rows repeated in full one. Texts without words are no duplicates."""
    return drop_near_duplicates(docs, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of a benchmark item go, repeated rows alike. Null and empty texts or items match nothing."""
    return drop_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's target weight asks. Null sources are one source; texts without words weigh nothing and come with their source's whole epochs; repeated rows are taken one after the other."""
    return mix_documents(docs)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents in shards of the target size, with the number of their shard in a column shard, or shard_ where there is one. Every row is in one shard, as it is."""
    return shard_documents(docs)[1]


STAGES = [
    ("quality rules", quality_rules),
    ("MinHash near-dedup", near_dedup),
    ("benchmark decontamination", decontamination),
    ("mixing to target weights", mixing),
    ("sharding", sharding),
]

#: The stages' sketches, edit distances and files are beyond SQL; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
    return docs
