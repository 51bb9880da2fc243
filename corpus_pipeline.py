"""From documents to training shards: each stage filters, mixes or shards the one before.

A stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as
Parquet and read again as the documents of the next one. All stages but the
last keep the columns of documents; the last adds shard and slot. Rows a stage
keeps are those its operator in hourly_star/llm keeps, ties, nulls and repeated
rows as described there; empty documents give empty results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from hourly_star.llm import decontaminate, mixing, sharding, simhash, toxicity
from hourly_star.llm.common import Scratch, table


def toxic_documents_go(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.one_of_each(spark, docs)


def no_benchmark_items(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mixed_to_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed(spark, docs)


def dealt_to_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sharding.sharded(spark, docs)


STAGES = [
    ("toxicity", toxic_documents_go),
    ("simhash_near_dedup", one_of_each_group),
    ("benchmark_decontamination", no_benchmark_items),
    ("source_mixing", mixed_to_weights),
    ("sharding", dealt_to_shards),
]

# Fingerprints, the classifier and edit distances are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; the last stage's rows."""
    scratch = Scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = scratch.keep(stage(spark, docs, sf_dir))
    return docs
