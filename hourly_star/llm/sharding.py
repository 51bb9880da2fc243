"""Uniform shuffle into shards of exact size, by a hypergeometric communication matrix.

Contract. Every row gets a shard (0 to `SHARDS` - 1) and a slot in it, gapless
from 0; shard sizes differ by at most one row (law `rows`), whatever the
sources or copies. The size of a document is the UTF-8 bytes of its text
(null: none) plus 8. `text_crc32` is the CRC-32 of these bytes (null or empty:
0). `grown_shard` is null, as the law says nothing of it. Nulls in other
columns, ties and repeated rows do not matter; an empty table gives an empty
result; further columns are kept by the stage, and must not be called
`shard` or `slot` there.

Method. Rows are numbered within the partitions they were read in. The number
of rows that each partition sends to each shard is drawn from the multivariate
hypergeometric distribution, which makes the shard sizes exact and the shuffle
uniform. A partition permutes its rows and deals them out by these numbers; a
shard permutes what it receives. Numbers of partitions and shards bound what
the driver holds. No shard is gathered in one task: its second permutation
is a sort by ranges of (shard, random key).
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hourly_star.llm.common import Scratch, running_total, table

SHARDS = 24
OVERHEAD = 8
SEED = 20_240


def communication_matrix(counts: list[int], shards: int, seed: int = SEED) -> np.ndarray:
    """Rows from each partition (first index) to each shard, uniformly at random.

    Shards get total // shards rows or one more; which get more is drawn too.
    """
    rng = np.random.default_rng([seed, len(counts), shards])
    total = sum(counts)
    left = np.full(shards, total // shards, np.int64)
    left[rng.permutation(shards)[:total % shards]] += 1
    matrix = np.zeros((len(counts), shards), np.int64)
    for p, count in enumerate(counts):
        need = int(count)
        rest = int(left.sum())
        for s in range(shards):
            others = rest - int(left[s])
            matrix[p, s] = _draw(rng, int(left[s]), others, need)
            need -= int(matrix[p, s])
            rest = others
        left -= matrix[p]
    return matrix


def _draw(rng: np.random.Generator, good: int, bad: int, count: int) -> int:
    """How many of `count` rows taken from good + bad are good ones."""
    if count == 0 or good == 0:
        return 0
    if bad == 0:
        return count
    if good + bad < 1_000_000_000:
        return int(rng.hypergeometric(good, bad, count))
    # beyond the generator's range; at such counts the normal law is as close as a double
    share = good / (good + bad)
    spread = np.sqrt(count * share * (1 - share) * (good + bad - count) / (good + bad - 1))
    drawn = int(round(rng.normal(count * share, spread)))
    return max(max(0, count - bad), min(drawn, good, count))


def assignments(scratch: Scratch, rows: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """Adds shard and slot to rows numbered by (part, at): partition, and place in it."""
    counts = {r["part"]: r["n"] for r in rows.groupBy("part").agg(F.count("*").alias("n")).collect()}
    parts = sorted(counts)
    matrix = communication_matrix([counts[p] for p in parts], shards, seed)
    ends = np.cumsum(matrix, axis=1)
    spark = rows.sparkSession
    bounds = spark.createDataFrame(
        [(int(p), [int(e) for e in row]) for p, row in zip(parts, ends)], "part long, ends array<long>")
    permuted = Window.partitionBy("part").orderBy(F.xxhash64(F.lit(seed), "part", "at"), "at")
    dealt = (rows.withColumn("_rank", F.row_number().over(permuted).cast("long") - 1)
             .join(bounds, "part")
             .withColumn("shard", F.size(F.filter("ends", lambda e: e <= F.col("_rank"))).cast("int"))
             .withColumn("_key", F.xxhash64(F.lit(seed + 1), "at", "part"))
             .withColumn("_one", F.lit(1)).drop("ends", "_rank"))
    return running_total(scratch, dealt, ["shard"], ["_key", "part", "at"], "_one", "slot").drop(
        "_key", "_one")


def numbered(df: DataFrame) -> DataFrame:
    """Adds (part, at): the partition a row was read in and its place there."""
    return df.withColumns({
        "part": F.spark_partition_id().cast("long"),
        "at": F.monotonically_increasing_id() - F.shiftleft(F.spark_partition_id().cast("long"), 33)})


def sharded_ids(spark: SparkSession, docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """The digest of every row; see the head of the module."""
    scratch = Scratch(spark, "shards")
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = scratch.keep(numbered(docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.length(text) + OVERHEAD).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))))
    return assignments(scratch, rows, shards).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


def sharded(spark: SparkSession, docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """All columns of the documents, which may have any other names, and shard and slot."""
    scratch = Scratch(spark, "shards")
    rows = scratch.keep(docs.select(F.struct("*").alias("doc"), F.spark_partition_id().cast("long").alias("part"),
                                    F.monotonically_increasing_id().alias("at")))
    placed = assignments(scratch, rows.select("part", "at"), shards).select("at", "shard", "slot")
    return rows.join(placed, "at").select("doc.*", "shard", "slot")


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharded_ids(spark, table(spark, sf_dir, "documents"))


QUERIES = {"op5_sharding": op5_sharding}
ORACLES = {}
