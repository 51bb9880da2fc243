"""Impossible data is refused: conditions a batch must meet before it is written."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourly_star.schemas import READING_KEY


class ConstraintViolation(ValueError):
    """A batch holds rows that cannot exist."""


# A name and the SQL condition under which a row is bad.
Rule = tuple[str, str]


def nonnegative(column: str) -> Rule:
    return f"nonnegative:{column}", f"`{column}` < 0"


def positive(column: str) -> Rule:
    return f"positive:{column}", f"`{column}` <= 0"


def on_grid(column: str, unit: str = "hour") -> Rule:
    return f"on_{unit}:{column}", f"date_trunc('{unit}', `{column}`) != `{column}`"


def required(*columns: str) -> list[Rule]:
    return [(f"required:{c}", f"`{c}` IS NULL") for c in columns]


def ordered(start: str, end: str) -> Rule:
    return f"ordered:{start},{end}", f"`{end}` < `{start}`"


def within(column: str, low: int, high: int) -> Rule:
    return f"within:{column}", f"`{column}` NOT BETWEEN {low} AND {high}"


READING_RULES = [
    *required(*READING_KEY, "unit", "response_id"),
    nonnegative("value"),
    on_grid("measured_at_utc"),
]

RESPONSE_RULES = [
    *required("response_id", "source", "request_url", "request_params", "window_start",
              "window_end", "http_status", "payload", "payload_sha256", "ingested_at"),
    ordered("window_start", "window_end"),
    within("http_status", 100, 599),
]

# What can be judged before a document is landed.
ENVELOPE_RULES = [
    *required("document", "location_code", "request_url", "request_params", "window_start",
              "window_end", "http_status", "body"),
    *RESPONSE_RULES[-2:],
]

POLLUTANT_RULES = [
    *required("pollutant_code", "display_name", "unit", "plausible_max", "sort_order"),
    positive("plausible_max"),
]


def violations(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """Offending rows with the first rule they break; one pass."""
    first = F.coalesce(*[F.when(F.expr(broken), F.lit(name)) for name, broken in rules])
    return df.withColumn("violation", first).filter(F.col("violation").isNotNull())


def violation_counts(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """One row with the number of offending rows per rule; one aggregate."""
    return df.agg(*[F.count_if(F.expr(broken)).alias(name) for name, broken in rules])


def references(df: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Child values without a parent, with their number of rows.

    Children are counted per value first, so that a value that occurs in a
    large part of the rows reaches the join once.
    """
    children = (df.filter(F.col(column).isNotNull())
                .groupBy(F.col(column).alias("missing_value"))
                .agg(F.count(F.lit(1)).alias("offending")))
    parents = parent.select(F.col(parent_column).alias("missing_value"))
    return children.join(parents, "missing_value", "left_anti")


def duplicates(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies"))
            .filter(F.col("copies") > 1))


def enforce(df: DataFrame, rules: list[Rule]) -> None:
    """Raise when any row breaks a rule."""
    raise_if_any(violation_counts(df, rules).first().asDict())


def raise_if_any(counts: dict[str, int]) -> None:
    broken = [f"{name} ({n} rows)" for name, n in counts.items() if n]
    if broken:
        raise ConstraintViolation(", ".join(broken))


def enforce_none(found: DataFrame, what: str) -> None:
    """Raise when a query for offenders finds any, naming a few."""
    some = found.limit(5).collect()
    if some:
        raise ConstraintViolation(f"{what}: {[tuple(row) for row in some]}")


def enforce_domain(pollutants: DataFrame) -> None:
    """The reference table must be loaded before any reading is."""
    if pollutants.isEmpty():
        raise ConstraintViolation("the pollutants table is empty; store the reference rows first")
