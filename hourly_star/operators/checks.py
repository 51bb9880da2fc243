"""Quality checks: queries for offending rows, where no row means the check passes."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourly_star.functions.predicates import outside
from hourly_star.operators.constraints import references
from hourly_star.session import instant


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def unique(df: DataFrame, *columns: str) -> DataFrame:
    """Values, or combinations, that occur more than once; NULLs do not count."""
    present = df.dropna(subset=list(columns))
    return (present.groupBy(*columns).agg(F.count(F.lit(1)).alias("n_records"))
            .filter(F.col("n_records") > 1))


def accepted_values(df: DataFrame, column: str, values: list) -> DataFrame:
    """Values outside the list with their number of rows; NULL passes."""
    return (df.filter(~F.col(column).isin(values))
            .groupBy(F.col(column).alias("value_field"))
            .agg(F.count(F.lit(1)).alias("n_records")))


def accepted_range(df: DataFrame, column: str, low=None, high=None,
                   inclusive: bool = True) -> DataFrame:
    return df.filter(outside(F.col(column), low, high, inclusive)).select(
        F.col(column).alias("offending_value"))


def relationships(df: DataFrame, column: str, parent: DataFrame, field: str) -> DataFrame:
    """Non-null values without a parent and the rows they occur in."""
    return references(df, column, parent, field)


def above_plausible(fact: DataFrame, pollutants: DataFrame) -> DataFrame:
    """Readings above the bound of their own pollutant."""
    bounds = pollutants.select("pollutant_key", "plausible_max")
    return fact.join(bounds, "pollutant_key").filter(
        F.col("concentration").isNotNull() & (F.col("concentration") > F.col("plausible_max"))
    ).select("reading_key", "pollutant_key", "measured_at_utc", "concentration", "plausible_max")


def stale(fact: DataFrame, as_of: datetime | str, hours: int = 48,
          allow_empty: bool = True) -> DataFrame:
    """The newest measurement if it is older than `hours`.

    An empty table passes unless `allow_empty` is off.
    """
    latest = F.col("latest_reading_utc")
    late = instant(as_of) - latest > F.make_dt_interval(hours=F.lit(hours))
    if not allow_empty:
        late = late | latest.isNull()
    return (
        fact.agg(F.max("measured_at_utc").alias("latest_reading_utc"))
        .filter(late)
        .select(latest, (instant(as_of) - latest).alias("staleness"))
    )


def source_freshness(df: DataFrame, column: str, as_of: datetime | str, warn_hours: int = 26,
                     error_hours: int = 48) -> DataFrame:
    """How long ago the loader last changed anything: pass, warn or error."""
    lag = instant(as_of) - F.col("max_loaded_at")

    def older(hours: int) -> Column:
        return lag > F.make_dt_interval(hours=F.lit(hours))

    return df.agg(F.max(column).alias("max_loaded_at")).select(
        "max_loaded_at", lag.alias("lag"),
        F.when(F.col("max_loaded_at").isNull() | older(error_hours), "error")
        .when(older(warn_hours), "warn").otherwise("pass").alias("status"),
    )


Tables = dict[str, DataFrame]


@dataclass(frozen=True)
class Check:
    """One declared check on a table.

    `row` marks bad rows and shares a scan with the other row checks of its
    table; `query` finds offenders with a query of its own.
    """

    name: str
    table: str
    row: Callable[[], Column] | None = None
    query: Callable[[Tables], DataFrame] | None = None
    weight: str | None = None
    severity: str = "error"


def check_not_null(table: str, column: str) -> Check:
    return Check(f"not_null_{table}_{column}", table, row=lambda: F.col(column).isNull())


def check_accepted_values(table: str, column: str, values: list) -> Check:
    return Check(f"accepted_values_{table}_{column}", table,
                 row=lambda: ~F.col(column).isin(values))


def check_accepted_range(table: str, column: str, low=None, high=None,
                         inclusive: bool = True) -> Check:
    if low is None and high is None:
        raise ValueError("give a lower or an upper bound")
    return Check(f"accepted_range_{table}_{column}", table,
                 row=lambda: outside(F.col(column), low, high, inclusive))


def check_unique(table: str, *columns: str) -> Check:
    return Check(f"unique_{table}_{'_'.join(columns)}", table,
                 query=lambda tables: unique(tables[table], *columns))


def check_relationships(table: str, column: str, parent: str, field: str) -> Check:
    return Check(f"relationships_{table}_{column}__{parent}_{field}", table,
                 query=lambda tables: relationships(tables[table], column, tables[parent], field),
                 weight="offending")


def run_checks(tables: Tables, checks: list[Check]) -> DataFrame:
    """One row per check: check, target, severity, offending, passed."""
    parts = []
    for table in dict.fromkeys(c.table for c in checks):
        of_rows = [c for c in checks if c.table == table and c.row is not None]
        if of_rows:
            parts.append(_row_checks(tables[table], of_rows))
    for check in checks:
        if check.query is not None:
            found = check.query(tables)
            n = F.coalesce(F.sum(check.weight), F.lit(0)) if check.weight else F.count(F.lit(1))
            parts.append(found.agg(n.cast("long").alias("offending")).select(
                F.lit(check.name).alias("check"), F.lit(check.table).alias("target"),
                F.lit(check.severity).alias("severity"), "offending"))
    results = reduce(DataFrame.unionByName, parts)
    return results.withColumn("passed", F.col("offending") == 0)


def _row_checks(df: DataFrame, checks: list[Check]) -> DataFrame:
    counted = df.agg(*[F.count_if(c.row()).alias(f"c{i}") for i, c in enumerate(checks)])
    return counted.select(F.inline(F.array(*[
        F.struct(F.lit(c.name).alias("check"), F.lit(c.table).alias("target"),
                 F.lit(c.severity).alias("severity"), F.col(f"c{i}").alias("offending"))
        for i, c in enumerate(checks)
    ])))
