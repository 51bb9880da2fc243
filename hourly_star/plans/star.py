"""The star schema: staging view, two dimensions and the incremental fact."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourly_star.functions.calendar import (
    date_key, is_weekend, iso_day_of_week, local_time, padded_name,
)
from hourly_star.functions.keys import reading_key
from hourly_star.functions.predicates import exceeds
from hourly_star.operators.calendars import as_of_calendar
from hourly_star.operators.constraints import enforce_domain
from hourly_star.operators.incremental import changed_since, merge_counted, pending
from hourly_star.operators.upsert import in_days
from hourly_star.schemas import FACT_KEY
from hourly_star.sources.tables import Warehouse

# --- Fixed values: the local calendar the results are reported on.
TIME_ZONE = "Africa/Cairo"
WEEKEND = (5, 6)

STAGING_VIEW = "stg_hourly_readings"


def staged_readings(readings: DataFrame, zone: str | Column = TIME_ZONE) -> DataFrame:
    """Readings under warehouse names with local time derived; no row is dropped.

    Local time is derived here and stored nowhere upstream, so a change of the
    zone rules needs a rebuild, not a reload.
    """
    return readings.select(
        "location_code", "pollutant_code", "measured_at_utc",
        local_time(F.col("measured_at_utc"), zone).alias("measured_at_local"),
        F.col("value").alias("concentration"), "unit", "source_response_id",
        "first_loaded_at", "loaded_at",
    )


def staged_by_location(readings: DataFrame, locations: DataFrame) -> DataFrame:
    """The staging view with every location on its own clock and weekend.

    `locations` has a time zone and weekend days per location; where it has
    none, the common calendar applies.
    """
    calendar = locations.select("location_code", "time_zone", "weekend_days")
    return _on_own_clock(readings.join(calendar, "location_code", "left"), TIME_ZONE, WEEKEND)


def staged_as_of(readings: DataFrame, calendars: DataFrame, first: date | None, last: date | None,
                 zone: str = TIME_ZONE, weekend: Iterable[int] = WEEKEND) -> DataFrame:
    """The staging view with every location on the clock and weekend valid at the hour.

    `first` and `last` are the UTC days that readings span; where a location
    has no calendar at an hour, the common one applies.
    """
    return _on_own_clock(as_of_calendar(readings, calendars, first, last), zone, weekend)


def staged_of(warehouse: Warehouse, readings: DataFrame, zone: str = TIME_ZONE,
              weekend: Iterable[int] = WEEKEND) -> DataFrame:
    """Readings of the warehouse as staged: by the stored calendars, all by the common one if there are none."""
    calendars = warehouse.read("location_calendars")
    if calendars.isEmpty():
        return staged_readings(readings, zone)
    first, last = warehouse.partition_days("hourly_readings", "utc_date").agg(
        F.min("utc_date"), F.max("utc_date")).first()
    return staged_as_of(readings, calendars, first, last, zone, weekend)


def _on_own_clock(placed: DataFrame, common_zone: str, common_weekend: Iterable[int]) -> DataFrame:
    """Staged rows of readings that carry `time_zone` and `weekend_days`."""
    zone = F.coalesce("time_zone", F.lit(common_zone))
    weekend = F.coalesce("weekend_days", F.array(*[F.lit(d) for d in common_weekend]))
    kept = staged_readings(placed, zone).columns
    local = placed.withColumn("measured_at_local", local_time(F.col("measured_at_utc"), zone)) \
        .withColumnRenamed("value", "concentration")
    return local.select(*kept, is_weekend(F.col("measured_at_local"), weekend)
                        .alias("is_weekend_local"))


def dim_date(staged: DataFrame, weekend: Iterable[int] = WEEKEND,
             padding: bool = True) -> DataFrame:
    """One row per local calendar day between the first and the last reading."""
    bounds = staged.agg(F.min("measured_at_local").cast("date").alias("first_day"),
                        F.max("measured_at_local").cast("date").alias("last_day"))
    day = F.col("date_day")
    return bounds.select(F.explode(F.sequence("first_day", "last_day")).alias("date_day")).select(
        date_key(day).alias("date_key"),
        "date_day",
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.month(day).alias("month"),
        padded_name(day, "MMMM", padding).alias("month_name"),
        F.dayofmonth(day).alias("day_of_month"),
        iso_day_of_week(day).alias("day_of_week"),
        padded_name(day, "EEEE", padding).alias("day_name"),
        F.weekofyear(day).alias("iso_week"),
        is_weekend(day, weekend).alias("is_weekend"),
    )


def dim_pollutant(pollutants: DataFrame) -> DataFrame:
    return pollutants.select(
        F.col("pollutant_code").alias("pollutant_key"), "display_name", "unit",
        "who_guideline", "who_averaging_hours", "plausible_max", "sort_order",
    )


def fact(staged: DataFrame, pollutants: DataFrame) -> DataFrame:
    """One row per reading of a known pollutant.

    The reference table is refused beyond a fixed size when it is stored, well
    below what Spark broadcasts by itself, so no reading is shuffled.
    """
    guideline = pollutants.select("pollutant_key", "who_guideline")
    return staged.join(
        guideline, F.col("pollutant_code") == F.col("pollutant_key")
    ).select(
        reading_key(F.col("location_code"), F.col("pollutant_code"),
                    F.col("measured_at_utc")).alias("reading_key"),
        date_key(F.col("measured_at_local")).alias("date_key"),
        "pollutant_key",
        "location_code",
        "measured_at_utc",
        "measured_at_local",
        F.hour("measured_at_local").alias("hour_of_day_local"),
        "concentration",
        "unit",
        exceeds(F.col("concentration"), F.col("who_guideline")).alias("exceeds_guideline"),
        "source_response_id",
        F.col("loaded_at").alias("source_loaded_at"),
        *[c for c in staged.columns if c == "is_weekend_local"],
    )


def with_lineage(readings: DataFrame, responses: DataFrame,
                 column: str = "source_response_id") -> DataFrame:
    """Each reading or fact row with the response its value came from."""
    origin = responses.select(
        F.col("response_id").alias(column), "request_url", "payload_sha256", "ingested_at")
    return readings.join(origin, column)


def with_date(fact_rows: DataFrame, dates: DataFrame, *columns: str) -> DataFrame:
    """Fact rows with attributes of their local day."""
    return fact_rows.join(dates.select("date_key", *columns), "date_key")


def build_star(warehouse: Warehouse, full_refresh: bool = False, zone: str = TIME_ZONE,
               weekend: Iterable[int] = WEEKEND, padding: bool = True) -> int:
    """Rebuild both dimensions, then bring the fact up to date.

    Returns the number of fact rows written. Without `full_refresh` only days
    that the change log names after the last run are read, of them only
    readings loaded since, and only days with news are rewritten. A run that
    dies before it is noted in analytics.star_runs is done again, which
    changes nothing. Where no run was noted, all of the log is taken up.
    Where calendars are stored, local times follow them and the fact has
    `is_weekend_local`; `zone` and `weekend` serve all other locations.
    """
    enforce_domain(warehouse.read("pollutants"))
    create_staging_view(warehouse, zone)
    edges = staged_of(warehouse, _edge_days(warehouse), zone, weekend)
    warehouse.replace_all("dim_date", dim_date(edges, weekend, padding))
    warehouse.replace_all("dim_pollutant", dim_pollutant(warehouse.read("pollutants")))

    pollutants = warehouse.read("dim_pollutant")
    consumed = warehouse.read("star_runs").agg(F.coalesce(F.max("seq"), F.lit(0))).first()[0]
    days, since, last = pending(warehouse, consumed)
    if full_refresh:
        # Readings are laid out by the same date, so without calendars nothing is shuffled.
        staged = staged_of(warehouse, warehouse.read("hourly_readings"), zone, weekend)
        rows = _dated(fact(staged, pollutants))
        warehouse.add_columns("fct_hourly_readings", rows)
        warehouse.replace_all("fct_hourly_readings", rows)
        n = warehouse.read("fct_hourly_readings").count()
        _note_run(warehouse, last, None, n, n)
        return n
    if last == consumed:
        return 0
    news_of = changed_since(in_days(warehouse.read("hourly_readings"), days), since)
    staged = staged_of(warehouse, news_of, zone, weekend)
    read, written = merge_counted(warehouse, "fct_hourly_readings", _dated(fact(staged, pollutants)),
                                  list(FACT_KEY), days=days)
    _note_run(warehouse, last, days.count(), read, written)
    return written


def _note_run(warehouse: Warehouse, seq: int, days: int | None, read: int, written: int) -> None:
    warehouse.append("star_runs", warehouse.spark.createDataFrame(
        [(seq, days, read, written)], "seq long, days long, rows_read long, rows_written long").coalesce(1))


def create_staging_view(warehouse: Warehouse, zone: str = TIME_ZONE) -> str:
    """The staged readings as a view of the staging layer, for every session; returns its name."""
    name = f"{warehouse.prefix}staging.{STAGING_VIEW}"
    common = "'" + zone.replace("'", "''") + "'"
    warehouse.spark.sql(f"""
        CREATE OR REPLACE VIEW {name} COMMENT 'Readings under warehouse names with local time' AS
        SELECT r.location_code, pollutant_code, measured_at_utc,
          CAST(convert_timezone('UTC', coalesce(time_zone, {common}), CAST(measured_at_utc AS TIMESTAMP_NTZ))
            AS TIMESTAMP_NTZ) AS measured_at_local,
          value AS concentration, unit, source_response_id, first_loaded_at, loaded_at
        FROM {warehouse.name("hourly_readings")} r LEFT JOIN (
          SELECT location_code, time_zone, valid_from,
            lead(valid_from) OVER (PARTITION BY location_code ORDER BY valid_from) AS valid_to
          FROM {warehouse.name("location_calendars")}) c
        ON c.location_code = r.location_code AND (valid_from IS NULL OR valid_from <= measured_at_utc)
          AND (valid_to IS NULL OR measured_at_utc < valid_to)""")
    return name


def _edge_days(warehouse: Warehouse, n: int = 2) -> DataFrame:
    """Readings of the first and last few days, all a range of days depends on.

    More than one on each side, as a clock set back may put a later instant
    on an earlier local day.
    """
    days = warehouse.partition_days("hourly_readings", "utc_date")
    listed = [row[0] for row in days.orderBy("utc_date").limit(n).collect()
              + days.orderBy(F.desc("utc_date")).limit(n).collect()]
    return warehouse.read("hourly_readings").filter(F.col("utc_date").isin(listed))


def _dated(rows: DataFrame) -> DataFrame:
    # By UTC date: the local date of a row could move when zone rules change.
    return rows.withColumn("utc_date", F.to_date("measured_at_utc"))
