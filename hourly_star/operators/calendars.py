"""Time zones and weekends of locations, each valid from an instant, and the as-of join."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hourly_star.functions.predicates import differs
from hourly_star.operators.constraints import duplicates, enforce, enforce_none, required
from hourly_star.operators.incremental import BEGINNING
from hourly_star.operators.upsert import last_change
from hourly_star.schemas import CALENDARS
from hourly_star.session import stage
from hourly_star.sources.tables import Warehouse

COLUMNS = [f.name for f in CALENDARS]

CALENDAR_RULES = [
    *required("location_code", "time_zone", "weekend_days"),
    ("within:weekend_days", "exists(weekend_days, d -> d IS NULL OR d NOT BETWEEN 1 AND 7)"),
    # A zone that does not exist raises here, not in the first report.
    ("known:time_zone", "convert_timezone(time_zone, 'UTC', TIMESTAMP_NTZ '2024-01-01') IS NULL"),
]


def ranges(calendars: DataFrame) -> DataFrame:
    """Calendars with `valid_to`, the instant the next one of the location starts, NULL for the last.

    A `valid_from` of NULL means from the beginning. A location has as many
    rows as its calendar has changed, so it is a small group.
    """
    own = Window.partitionBy("location_code").orderBy("valid_from")
    return calendars.withColumn("valid_to", F.lead("valid_from").over(own))


def day_cells(calendars: DataFrame, first: date | None, last: date | None) -> DataFrame:
    """A row per location, UTC day and calendar that applies on a part of that day.

    `cell_from` and `cell_to` are set where a change falls into the day. Days
    outside `first` to `last` are left out.
    """
    low, high = F.lit(first).cast("date"), F.lit(last).cast("date")
    # A range ends just before the next one starts.
    start = F.greatest(F.coalesce(F.to_date("valid_from"), low), low)
    end = F.least(F.coalesce(F.to_date(F.col("valid_to") - F.expr("INTERVAL 1 MICROSECOND")), high), high)
    days = ranges(calendars).select("*", start.alias("start"), end.alias("end")).filter("start <= end")
    cells = days.withColumn("cell_day", F.explode(F.sequence("start", "end")))

    def within(edge: str, day_of: str):
        return F.when(F.expr(f"to_date({day_of}) = cell_day"), F.col(edge))

    return cells.select(
        "location_code", "cell_day", "time_zone", "weekend_days",
        within("valid_from", "valid_from").alias("cell_from"),
        within("valid_to", "valid_to - INTERVAL 1 MICROSECOND").alias("cell_to"))


def as_of_calendar(readings: DataFrame, calendars: DataFrame, first: date | None,
                   last: date | None) -> DataFrame:
    """Readings with `time_zone` and `weekend_days` valid when they were measured; NULL if none was.

    The join is on location and UTC day, so the readings of a location that
    holds a large part of them are spread over their days, and a reading meets
    one calendar, or those of one day. No reading is dropped or doubled.
    """
    cells = day_cells(calendars, first, last).withColumnRenamed("location_code", "cell_location")
    at = F.col("measured_at_utc")
    valid = ((F.col("location_code") == F.col("cell_location")) & (F.to_date(at) == F.col("cell_day"))
             & (F.col("cell_from").isNull() | (F.col("cell_from") <= at))
             & (F.col("cell_to").isNull() | (at < F.col("cell_to"))))
    return readings.join(cells, valid, "left").drop("cell_location", "cell_day", "cell_from", "cell_to")


def store_calendars(warehouse: Warehouse, new: DataFrame) -> int:
    """Check and upsert calendars by location and start; returns the number of days they change.

    These days are noted in the change log first, with all their readings, so
    the next increment of the fact takes the new calendar up. A note too many
    does no harm.
    """
    new = new.select(*COLUMNS)
    enforce(new, CALENDAR_RULES)
    enforce_none(duplicates(new, ["location_code", "valid_from"]), "calendars that occur twice")
    old = warehouse.read("location_calendars")
    replaced = new.select(F.col("location_code").alias("new_code"), F.col("valid_from").alias("new_from"))
    same = (F.col("location_code") == F.col("new_code")) & ~differs(F.col("valid_from"), F.col("new_from"))
    merged = stage(old.join(replaced, same, "left_anti").select(*COLUMNS).unionByName(new),
                   warehouse.staging_path("calendars"))

    stored = warehouse.partition_days("hourly_readings", "utc_date")
    first, last = stored.agg(F.min("utc_date"), F.max("utc_date")).first()
    before, after = day_cells(old, first, last), day_cells(merged, first, last)
    changed = (before.exceptAll(after).unionByName(after.exceptAll(before))
               .select(F.col("cell_day").alias("utc_date")).distinct().join(stored, "utc_date", "left_semi"))
    days = stage(changed, warehouse.staging_path("calendar_days"))
    n = days.count()
    if n:
        warehouse.append("reading_changes", days.coalesce(1).select(
            F.lit(last_change(warehouse) + 1).cast("long").alias("seq"), "utc_date",
            F.lit(BEGINNING).cast("timestamp").alias("since"),
            F.lit(0).cast("long").alias("inserted"), F.lit(0).cast("long").alias("changed")))
    warehouse.replace_all("location_calendars", merged)
    return n
