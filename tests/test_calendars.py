"""Calendars valid from an instant, gapless ids, counts taken from the document."""

from datetime import date, datetime, timedelta
from zoneinfo import ZoneInfo

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from conftest import CODES, body, envelopes, utc
from hourly_star.operators.calendars import as_of_calendar, day_cells, store_calendars
from hourly_star.operators.constraints import ConstraintViolation
from hourly_star.plans.ingest import dry_run, ingest
from hourly_star.plans.star import build_star
from hourly_star.sources.landing import land

T = datetime(2027, 3, 10, 3)
DAYS = [date(2027, 3, d) for d in (6, 7, 8)]
MOVE = datetime(2027, 3, 7, 9, 30)
ROWS = [("giza", None, "Asia/Tokyo", [6, 7]), ("giza", MOVE, "America/New_York", [5]),
        ("suez", MOVE, "Asia/Kolkata", [7])]


def calendars(spark, rows):
    return spark.createDataFrame(
        rows, "location_code string, valid_from timestamp_ntz, time_zone string, weekend_days array<int>"
    ).withColumn("valid_from", F.col("valid_from").cast("timestamp"))


def in_force(location, at):
    """Zone and weekend of a location at an instant, looked up one by one."""
    found = [r for r in ROWS if r[0] == location and (r[1] is None or r[1] <= at)]
    return found[-1][2:] if found else ("Africa/Cairo", [5, 6])


def load(spark, warehouse, **options):
    hours = [f"{d}T{h:02d}:00" for d in DAYS for h in range(24)]
    docs = envelopes(spark, body(hours, [float(i) for i in range(72)]), location="giza").unionByName(
        envelopes(spark, body(hours, [1.0] * 72), location="suez").withColumn("document", F.lit("doc-suez")))
    docs = docs.unionByName(
        envelopes(spark, body(hours, [2.0] * 72), location="cairo").withColumn("document", F.lit("doc-cairo")))
    ingest(warehouse, docs, T, **options)


def local_rows(warehouse):
    return {(r[0], r[1], r[2]): r[3:] for r in utc(warehouse.read("fct_hourly_readings").select(
        "location_code", "pollutant_key", "measured_at_utc", "measured_at_local", "is_weekend_local", "date_key"))}


def expected(keys):
    result = {}
    for location, code, at in keys:
        zone, weekend = in_force(location, at)
        local = at.replace(tzinfo=ZoneInfo("UTC")).astimezone(ZoneInfo(zone)).replace(tzinfo=None)
        result[location, code, at] = (local, local.isoweekday() in weekend, int(f"{local:%Y%m%d}"))
    return result


def test_fact_follows_the_calendar_in_force(spark, warehouse):
    load(spark, warehouse)
    store_calendars(warehouse, calendars(spark, ROWS))
    build_star(warehouse)
    rows = local_rows(warehouse)
    assert len(rows) == 3 * 72 * 4 and rows == expected(rows)
    days = {r.date_key for r in warehouse.read("dim_date").collect()}
    assert {r[2] for r in rows.values()} <= days
    view = spark.table(f"{warehouse.prefix}staging.stg_hourly_readings")
    assert {r[:3]: r[3] for r in utc(view.select("location_code", "pollutant_code", "measured_at_utc",
                                                 "measured_at_local"))} == {k: v[0] for k, v in rows.items()}


def test_a_calendar_stored_later_is_taken_up_by_the_next_increment(spark, warehouse):
    load(spark, warehouse)
    store_calendars(warehouse, calendars(spark, ROWS[:1]))
    build_star(warehouse)
    # the move falls into the second of three days, the first stays as it is
    assert store_calendars(warehouse, calendars(spark, ROWS[1:])) == 2
    written = build_star(warehouse)
    moved = sum(at >= MOVE for d in DAYS for at in [datetime(d.year, d.month, d.day, h) for h in range(24)])
    assert written == 2 * 4 * moved
    rows = local_rows(warehouse)
    assert rows == expected(rows)
    assert store_calendars(warehouse, calendars(spark, ROWS)) == 0 and build_star(warehouse) == 0
    build_star(warehouse, full_refresh=True)
    assert local_rows(warehouse) == rows


def test_without_calendars_the_fact_is_as_before(spark, warehouse):
    load(spark, warehouse)
    assert store_calendars(warehouse, calendars(spark, [])) == 0
    build_star(warehouse)
    assert "is_weekend_local" not in warehouse.read("fct_hourly_readings").columns


def test_several_changes_on_one_day_and_the_plan(spark):
    day = datetime(2027, 3, 7)
    rows = [("giza", None, "Asia/Tokyo", [7])] + [
        ("giza", day + timedelta(hours=h), zone, [h]) for h, zone in ((1, "Asia/Kolkata"), (5, "Europe/Paris"))]
    at = spark.createDataFrame([("giza", day + timedelta(hours=h)) for h in (-1, 0, 1, 4, 5, 30)] + [(None, day)],
                               "location_code string, measured_at_utc timestamp_ntz").withColumn(
        "measured_at_utc", F.col("measured_at_utc").cast("timestamp"))
    joined = as_of_calendar(at, calendars(spark, rows), DAYS[0], DAYS[2])
    got = {(r[0], r[1]): r[2] for r in utc(joined.select("location_code", "measured_at_utc", "time_zone"))}
    zones = ["Asia/Tokyo"] * 2 + ["Asia/Kolkata"] * 2 + ["Europe/Paris"] * 2
    assert got == {**{("giza", day + timedelta(hours=h)): z for h, z in zip((-1, 0, 1, 4, 5, 30), zones)},
                   (None, day): None}
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    cells = day_cells(calendars(spark, rows), DAYS[0], DAYS[2])
    assert sorted(r.cell_day.day for r in cells.collect()) == [6, 7, 7, 7, 8]


@pytest.mark.parametrize("row", [("giza", None, None, [5]), ("giza", None, "Asia/Tokyo", [8]),
                                 (None, None, "Asia/Tokyo", [5]), ("giza", None, "Asia/Tokyo", None)])
def test_bad_calendars_are_refused(spark, warehouse, row):
    with pytest.raises(ConstraintViolation):
        store_calendars(warehouse, calendars(spark, [row]))


def test_unknown_zones_and_doubled_calendars_are_refused(spark, warehouse):
    with pytest.raises(PySparkException):
        store_calendars(warehouse, calendars(spark, [("giza", None, "Mars/Olympus", [5])]))
    with pytest.raises(ConstraintViolation):
        store_calendars(warehouse, calendars(spark, [ROWS[0], ROWS[0]]))
    assert warehouse.read("location_calendars").isEmpty()


def test_ids_have_no_gaps_over_batches(spark, warehouse):
    for batch in range(3):
        docs = envelopes(spark, *[body() for _ in range(23)]).repartition(5).withColumn(
            "fetched_at", F.col("fetched_at") - F.make_dt_interval(mins=F.substring("document", 5, 9).cast("int")))
        land(warehouse, docs, T + timedelta(days=batch))
    rows = warehouse.read("responses").orderBy("response_id").collect()
    assert [r.response_id for r in rows] == list(range(1, 70))
    # fetched backwards within each batch
    assert [r.document for r in rows] == [f"doc-{i}" for i in reversed(range(23))] * 3


def test_dry_run_counts_without_unpivoting(spark):
    docs = envelopes(spark, body(), body(offset=3600), body(times=[], values=[]), "{")
    counts = dry_run(docs, CODES, datetime(2027, 3, 8, 17))
    plan = counts._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and plan.count("from_json(") == 1
    got = sorted((r.guard_error or "", r.submitted, r.dropped_future) for r in counts.collect())
    assert got == [("", 8, 4), ("malformed", 0, 0), ("no_time_axis", 0, 0), ("utc_offset", 0, 0)]
