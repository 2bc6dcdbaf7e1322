"""From raw documents to padded training batches in five stages.

Each stage takes the whole of what its predecessor kept. Null ids and texts, empty and very long texts, repeated rows, ties,
empty tables and further columns fare as the docstrings of the operators say; all columns of documents are passed on as they
are, up to packing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from foliary.llm.common import documents, forget, materialize, passing
from foliary.llm.exact_dedup import drop_copies
from foliary.llm.mixing import interleave
from foliary.llm.packing import in_batches
from foliary.llm.quality_rules import keep_good
from foliary.llm.queries import pipeline_sql
from foliary.llm.simhash import keep_one_each


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that fail the base rules or a cutoff proven safe on the labelled documents."""
    return keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each text."""
    return drop_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near-duplicates."""
    return keep_one_each(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Put the documents into the order of the mix of sources."""
    return interleave(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Form padded batches, in the order of the mix: a row for each document with its batch and its place there."""
    return in_batches(docs)


STAGES = [("quality_rules", quality_rules), ("exact_dedup", exact_dedup), ("near_dedup", near_dedup), ("mixing", mixing), ("packing", packing)]

ORACLE_SQL = pipeline_sql()


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each is written to the shared folder and read again by the next. What a stage wrote on its way goes with it."""
    docs = documents(spark, sf_dir)
    for k, (name, stage) in enumerate(STAGES):
        with passing():
            done, docs = docs, materialize(stage(spark, docs, sf_dir), f"stage-{name}", passes=False)
        if k:
            forget(done)
    return docs
