"""The three layers as Spark databases of Parquet tables."""

from __future__ import annotations

import hashlib

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourly_star.schemas import LAYERS, TABLES
from hourly_star.session import partition_overwrite, prepare, shared_dir


class Warehouse:
    """Names, creation and writes of the tables under one root folder.

    One writer at a time, as a run owns the partitions it overwrites.
    """

    def __init__(self, spark: SparkSession, root: str, prefix: str = ""):
        self.spark = prepare(spark)
        self.root = root.rstrip("/")
        self.prefix = prefix

    def name(self, table: str) -> str:
        return f"{self.prefix}{TABLES[table].layer}.{table}"

    def location(self, table: str) -> str:
        return f"{self.root}/{TABLES[table].layer}/{table}"

    def staging_path(self, step: str) -> str:
        """Where a step keeps its intermediate rows; one run's worth at most."""
        owner = hashlib.md5(f"{self.root} {self.prefix}".encode()).hexdigest()[:12]
        return f"{shared_dir(self.spark)}/hourly_star_{owner}/{step}"

    def create(self) -> "Warehouse":
        """Create what is missing; what exists is left as it is."""
        for layer, comment in LAYERS.items():
            self.spark.sql(
                f"CREATE DATABASE IF NOT EXISTS {self.prefix}{layer} "
                f"COMMENT '{comment}' LOCATION '{self.root}/{layer}'"
            )
        for table in TABLES:
            if not self.spark.catalog.tableExists(self.name(table)):
                self._create_table(table)
        return self

    def _create_table(self, table: str) -> None:
        spec = TABLES[table]
        declared = {field.name for field in spec.schema}
        stored = self._stored_fields(table)
        known = [f for f in stored if f.name not in declared]
        body = [f for f in spec.schema if f.name not in spec.partitions] + known
        columns = ", ".join(
            _column_ddl(f) for f in body + [spec.schema[p] for p in spec.partitions]
        )
        by = f"PARTITIONED BY ({', '.join(spec.partitions)})" if spec.partitions else ""
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.name(table)} ({columns}) USING parquet {by} "
            f"LOCATION '{self.location(table)}' COMMENT '{spec.comment}'"
        )
        if stored and spec.partitions:
            self.spark.catalog.recoverPartitions(self.name(table))

    def _stored_fields(self, table: str) -> list[T.StructField]:
        # Files left by an earlier session whose catalog was not kept may hold
        # columns that were appended to the table since.
        try:
            reader = self.spark.read.option("mergeSchema", "true")
            return list(reader.parquet(self.location(table)).schema)
        except AnalysisException:
            return []

    def read(self, table: str) -> DataFrame:
        return self.spark.table(self.name(table))

    def partition_days(self, table: str, column: str) -> DataFrame:
        """The days a table has partitions for, from the catalog alone."""
        day = F.regexp_extract("partition", f"{column}=([0-9-]+)", 1)
        listed = self.spark.sql(f"SHOW PARTITIONS {self.name(table)}")
        return listed.select(day.cast("date").alias(column)).distinct()

    def add_columns(self, table: str, df: DataFrame) -> None:
        """Append columns the table does not have yet; older rows read as NULL."""
        present = set(self.read(table).columns)
        missing = [field for field in df.schema if field.name not in present]
        if missing:
            columns = ", ".join(_column_ddl(field) for field in missing)
            self.spark.sql(f"ALTER TABLE {self.name(table)} ADD COLUMNS ({columns})")

    def replace_partitions(self, table: str, df: DataFrame) -> None:
        """Overwrite exactly the partitions that occur in `df`.

        Files appear under their final name only when the whole job has
        succeeded, so the table may be among the inputs of `df`.
        """
        self._insert(table, df, "dynamic")

    def replace_all(self, table: str, df: DataFrame) -> None:
        self._insert(table, df, "static")

    def append(self, table: str, df: DataFrame) -> None:
        """Add rows to a small table without partitions."""
        self._insert(table, df, "static", overwrite=False)

    def _insert(self, table: str, df: DataFrame, mode: str, overwrite: bool = True) -> None:
        # insertInto goes by position.
        target = self.read(table)
        have = set(df.columns)
        ordered = df.select(*[
            F.col(f.name).cast(f.dataType).alias(f.name) if f.name in have
            else F.lit(None).cast(f.dataType).alias(f.name)
            for f in target.schema
        ])
        # The rows may belong to another session, as those of a micro-batch do.
        with partition_overwrite(df.sparkSession, mode):
            ordered.write.insertInto(self.name(table), overwrite=overwrite)
        self.spark.catalog.refreshTable(self.name(table))


def _column_ddl(field: T.StructField) -> str:
    comment = (field.metadata or {}).get("comment")
    text = f"`{field.name}` {field.dataType.simpleString()}"
    return f"{text} COMMENT '{comment}'" if comment else text


def by_partition(df: DataFrame, column: str | tuple[str, ...], *order: str) -> DataFrame:
    """Gather rows of a partition into few files before a write, sorted inside.

    Rebalancing lets adaptive execution split a partition that is far larger
    than the others over several tasks, and join small ones.
    """
    columns = [column] if isinstance(column, str) else list(column)
    return df.hint("rebalance", *[F.col(c) for c in columns]).sortWithinPartitions(*columns, *order)
