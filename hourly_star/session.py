"""Session settings the results depend on, and the folder shared by all executors."""

from __future__ import annotations

import tempfile
from contextlib import contextmanager
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Time stamps are read and rendered in UTC; ANSI makes bad casts fail instead
# of turning into NULL; adaptive execution splits skewed join and write
# partitions, also where an aggregate after the join then needs a shuffle.
REQUIRED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def build_session(cores: str = "*", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A local session for tests and the bench; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("hourly_star")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for key, value in {**REQUIRED, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return prepare(spark)


def prepare(spark: SparkSession) -> SparkSession:
    """Put the required settings in place on a session made elsewhere."""
    for key, value in REQUIRED.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    Only a local session may fall back on a temporary folder of its own.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    folder = tempfile.mkdtemp(prefix="hourly-star-")
    spark.sparkContext.setCheckpointDir(folder)
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def stage(df: DataFrame, path: str) -> DataFrame:
    """Write once, read back: cuts lineage and survives the loss of executors."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


TASKS_PER_CORE = 4


def spread(df: DataFrame) -> DataFrame:
    """Rows dealt over several tasks a core where `df` has fewer files than that.

    A scan is cut by the size of its files, and texts that compress well may be
    few small files with hours of work in them.
    """
    tasks = TASKS_PER_CORE * df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(tasks) if len(df.inputFiles()) < tasks else df


def instant(ts: datetime | str) -> Column:
    """A UTC time stamp literal; naive datetimes are taken as UTC."""
    if isinstance(ts, datetime):
        if ts.tzinfo is not None:
            ts = ts.astimezone(timezone.utc).replace(tzinfo=None)
        ts = ts.isoformat(sep=" ", timespec="microseconds")
    return F.lit(ts).cast("timestamp")


@contextmanager
def partition_overwrite(spark: SparkSession, mode: str):
    """Overwrite either the touched partitions ("dynamic") or the table ("static")."""
    key = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(key)
    spark.conf.set(key, mode)
    try:
        yield
    finally:
        spark.conf.set(key, before)
