"""Helpers the training-data operators share: scratch tables, words, running sums."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourly_star.session import shared_dir

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
WHITE_SPACE = r"[\x20\x09-\x0D]+"
ROWS_A_BATCH = 256  # texts may be long, so a batch holds few of them


class Scratch:
    """Tables of one run in the folder all executors share.

    A written table cuts the lineage and outlives the executors that made it.
    """

    def __init__(self, spark: SparkSession, purpose: str):
        self.spark = spark
        self.root = f"{shared_dir(spark)}/{purpose}-{uuid.uuid4().hex}"
        self.tables = 0

    def keep(self, df: DataFrame) -> DataFrame:
        """Write the rows once and read them back."""
        self.tables += 1
        path = f"{self.root}/{self.tables:04d}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *numbers: int) -> None:
        """Delete tables of this run that no later step reads."""
        jvm = self.spark.sparkContext._jvm
        for number in numbers:
            path = jvm.org.apache.hadoop.fs.Path(f"{self.root}/{number:04d}")
            path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lower_ascii(text: Column) -> Column:
    """A to Z lower-cased, all else as it is."""
    return F.translate(text, UPPER, UPPER.lower())


def word_count(text: Column) -> Column:
    """Words between ASCII white space; none in a null."""
    words = F.filter(F.split(F.coalesce(text, F.lit("")), WHITE_SPACE), lambda w: w != "")
    return F.size(words).cast("long")


def map_rows(df: DataFrame, schema: str | T.StructType,
             function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> DataFrame:
    """mapInArrow over small batches of long texts."""
    spark = df.sparkSession
    # workers that share this file system find the package where the driver found it
    spark.sparkContext.environment.setdefault("PYTHONPATH", str(Path(__file__).resolve().parents[2]))
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(key) != str(ROWS_A_BATCH):
        spark.conf.set(key, str(ROWS_A_BATCH))
    return df.mapInArrow(function, schema)


def bucketed_join(left: DataFrame, right: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """Equi-join that takes two nulls in a key for equal; keeps the left columns and adds the others.

    Left as a plain join so that size decides on broadcasting and adaptive
    execution may split a hot key of the left side.
    """
    renamed = right.select(*[F.col(c).alias(f"_r_{c}") if c in on else F.col(c) for c in right.columns])
    condition = None
    for c in on:
        same = left[c].eqNullSafe(renamed[f"_r_{c}"])
        condition = same if condition is None else condition & same
    return left.join(renamed, condition, how).drop(*[f"_r_{c}" for c in on])


def running_total(scratch: Scratch, df: DataFrame, group: list[str], order: list[str],
                  value: str, out: str) -> DataFrame:
    """Adds `out`: the sum of `value` over the rows of the group that come before, by `order`.

    A group may hold any share of the rows. Rows are dealt by ranges of
    (group, order), so a range is bounded whatever the group; sums within a
    range come from a window over the range, sums of earlier ranges from one
    row per (range, group). The result is a written table.
    """
    keys = [*group, *order]
    dealt = scratch.keep(df.repartitionByRange(*[F.col(c).asc_nulls_first() for c in keys])
                         .withColumn("_range", F.spark_partition_id()))
    before = Window.partitionBy(*group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = (dealt.groupBy("_range", *group).agg(F.sum(value).alias("_sum"))
              .withColumn("_before", F.coalesce(F.sum("_sum").over(before), F.lit(0)))
              .select("_range", *group, "_before"))
    within = (Window.partitionBy("_range", *group)
              .orderBy(*[F.col(c).asc_nulls_first() for c in order])
              .rowsBetween(Window.unboundedPreceding, -1))
    summed = dealt.withColumn("_within", F.coalesce(F.sum(value).over(within), F.lit(0)))
    joined = bucketed_join(summed, ranges, ["_range", *group])
    return scratch.keep(joined.withColumn(out, (F.col("_before") + F.col("_within")).cast("long"))
                        .drop("_before", "_within", "_range"))
