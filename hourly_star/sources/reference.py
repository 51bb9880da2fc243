"""The reference domain: which variables exist, in which unit, with which bounds."""

from __future__ import annotations

from pyspark.sql import DataFrame, Row, SparkSession

from hourly_star.schemas import POLLUTANT_ROWS, POLLUTANTS
from hourly_star.operators.constraints import duplicates, enforce_none
from hourly_star.session import stage
from hourly_star.sources.tables import Warehouse

# A document carries one array per code, and the list of codes becomes the
# schema of the document. The table is refused beyond this size, which keeps
# it below the size up to which Spark broadcasts a table by itself.
MAX_CODES = 10_000


def seed(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(POLLUTANT_ROWS, POLLUTANTS)


def upserted(old: DataFrame, new: DataFrame, key: str = "pollutant_code") -> DataFrame:
    """`new` wins wherever its key exists, other rows stay."""
    return old.join(new.select(key), key, "left_anti").select(*new.columns).unionByName(new)


def store(warehouse: Warehouse, new: DataFrame) -> None:
    """Upsert into staging.pollutants; a code occurs once in what is stored."""
    enforce_none(duplicates(new, ["pollutant_code"]), "pollutant codes that occur twice")
    merged = stage(upserted(warehouse.read("pollutants"), new),
                   warehouse.staging_path("pollutants"))
    if merged.limit(MAX_CODES + 1).count() > MAX_CODES:
        raise ValueError(f"more than {MAX_CODES} pollutant codes")
    warehouse.replace_all("pollutants", merged)


def domain_rows(pollutants: DataFrame) -> list[Row]:
    """The rows that shape documents and plans; at most MAX_CODES of them."""
    rows = (pollutants.select("pollutant_code", "unit", "sort_order")
            .limit(MAX_CODES + 1).collect())
    if len(rows) > MAX_CODES:
        raise ValueError(f"more than {MAX_CODES} pollutant codes")
    return sorted(rows, key=lambda row: (row.sort_order, row.pollutant_code))


def expected_units(pollutants: DataFrame) -> dict[str, str]:
    """Unit per code, read once per run."""
    return {row.pollutant_code: row.unit for row in domain_rows(pollutants)}
