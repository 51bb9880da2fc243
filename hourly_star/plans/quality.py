"""The declared checks on sources, view, dimensions and fact."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourly_star.operators.checks import (
    Check, Tables, above_plausible, check_accepted_range, check_accepted_values, check_not_null,
    check_relationships, check_unique, run_checks, source_freshness, stale,
)
from hourly_star.operators.upsert import in_days
from hourly_star.plans.star import TIME_ZONE, staged_of
from hourly_star.session import instant
from hourly_star.sources.tables import Warehouse

READINGS, POLLUTANTS = "hourly_readings", "pollutants"
STAGED, DATES = "stg_hourly_readings", "dim_date"
DIM, FACT = "dim_pollutant", "fct_hourly_readings"


def _not_null(table: str, *columns: str) -> list[Check]:
    return [check_not_null(table, column) for column in columns]


def declared_checks(as_of: datetime | str, recency_hours: int = 48,
                    allow_empty: bool = True) -> list[Check]:
    """The forty checks; `as_of` is the time data age is measured at."""
    return [
        *_not_null(READINGS, "location_code", "pollutant_code", "measured_at_utc"),
        *_not_null(POLLUTANTS, "pollutant_code", "plausible_max"),
        check_unique(POLLUTANTS, "pollutant_code"),

        *_not_null(STAGED, "measured_at_utc", "measured_at_local", "pollutant_code"),
        check_relationships(STAGED, "pollutant_code", POLLUTANTS, "pollutant_code"),

        *_not_null(DATES, "date_key", "date_day", "is_weekend", "day_of_week"),
        check_unique(DATES, "date_key"),
        check_unique(DATES, "date_day"),
        check_accepted_values(DATES, "day_of_week", [1, 2, 3, 4, 5, 6, 7]),

        *_not_null(DIM, "pollutant_key", "display_name", "unit", "plausible_max"),
        check_unique(DIM, "pollutant_key"),
        check_accepted_values(DIM, "unit", ["ug/m3"]),

        *_not_null(FACT, "reading_key", "date_key", "pollutant_key", "location_code",
                   "measured_at_utc", "measured_at_local", "hour_of_day_local", "unit",
                   "source_response_id", "source_loaded_at"),
        check_unique(FACT, "reading_key"),
        check_relationships(FACT, "date_key", DATES, "date_key"),
        check_relationships(FACT, "pollutant_key", DIM, "pollutant_key"),
        check_accepted_range(FACT, "hour_of_day_local", 0, 23),
        check_accepted_range(FACT, "concentration", 0, 10000),

        Check("concentration_within_pollutant_bounds", FACT,
              query=lambda tables: above_plausible(tables[FACT], tables[DIM])),
        Check("readings_are_recent", FACT,
              query=lambda tables: stale(tables[FACT], as_of, recency_hours, allow_empty)),
    ]


def freshness_check(readings: DataFrame, as_of: datetime | str) -> DataFrame:
    """Source freshness in the layout of the check results."""
    result = source_freshness(readings, "loaded_at", as_of)
    return result.select(
        F.lit("source_freshness").alias("check"), F.lit(READINGS).alias("target"),
        F.when(F.col("status") == "warn", "warn").otherwise("error").alias("severity"),
        (F.col("status") != "pass").cast("long").alias("offending"),
        (F.col("status") == "pass").alias("passed"),
    )


def check_star(tables: Tables, as_of: datetime | str, **options) -> DataFrame:
    """All declared checks and source freshness, one row each."""
    return run_checks(tables, declared_checks(as_of, **options)).unionByName(
        freshness_check(tables[READINGS], as_of))


def warehouse_tables(warehouse: Warehouse, zone: str = TIME_ZONE,
                     days: DataFrame | None = None) -> Tables:
    """The tables to check, readings and fact restricted to `days` if given."""
    tables = {name: warehouse.read(name)
              for name in (READINGS, POLLUTANTS, DATES, DIM, FACT)}
    if days is not None:
        for name in (READINGS, FACT):
            tables[name] = in_days(tables[name], days)
    return {**tables, STAGED: staged_of(warehouse, tables[READINGS], zone)}


def check_changed(warehouse: Warehouse, since: datetime | str, as_of: datetime | str,
                  zone: str = TIME_ZONE, **options) -> DataFrame:
    """The declared checks on the days with changes at or after `since`.

    Whole days are read, so a key that now occurs twice is found: both copies
    have the same hour. The newest day is always among them, as it decides
    about recency. The cost follows the change, not the history.
    """
    changed = warehouse.read(FACT).filter(F.col("source_loaded_at") >= instant(since))
    newest = warehouse.partition_days(FACT, "utc_date").agg(F.max("utc_date").alias("utc_date"))
    days = changed.select("utc_date").unionByName(newest).distinct()
    checked = run_checks(warehouse_tables(warehouse, zone, days),
                         declared_checks(as_of, **options))
    return checked.unionByName(freshness_check(warehouse.read(READINGS), as_of))
