from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import submissions, utc
from hourly_star.functions.calendar import hours_in_local_day, local_time
from hourly_star.operators.revisions import fold
from hourly_star.plans import reports
from hourly_star.plans.star import (
    dim_date, dim_pollutant, fact, staged_by_location, staged_readings,
)
from hourly_star.sources import reference
from hourly_star.sources.fixture import profile, seeded_readings
from hourly_star.sources.windows import LOCATIONS

NOW = datetime(2026, 9, 20, 10, 25)


def series(spark, hours, code="pm2_5", location="giza"):
    """`hours` maps an hour to its value."""
    return fold(submissions(spark, [
        (location, code, at, value, "ug/m3", i, NOW) for i, (at, value) in enumerate(hours.items())]))


def star_of(spark, readings):
    dim = dim_pollutant(reference.seed(spark))
    staged = staged_readings(readings)
    return fact(staged, dim), dim_date(staged), dim


def hourly(start, n, value=lambda i: 10.0):
    return {start + timedelta(hours=i): value(i) for i in range(n)}


def test_local_time_around_clock_changes(spark):
    instants = ["2026-07-01 10:00", "2026-01-01 10:00", "2026-10-29 20:00", "2026-10-29 21:00",
                "2026-04-23 21:00", "2026-04-23 22:00"]
    df = spark.createDataFrame([(t,) for t in instants], "t string").select(
        local_time(F.col("t").cast("timestamp"), "Africa/Cairo"))
    assert [r[0] for r in df.collect()] == [
        datetime(2026, 7, 1, 13), datetime(2026, 1, 1, 12), datetime(2026, 10, 29, 23),
        datetime(2026, 10, 29, 23), datetime(2026, 4, 23, 23), datetime(2026, 4, 24, 1)]


def test_zone_may_differ_per_row(spark):
    df = spark.createDataFrame([("Africa/Cairo",), ("Asia/Tokyo",)], "z string").select(
        local_time(F.lit("2026-07-01 10:00").cast("timestamp"), F.col("z")).alias("t"))
    assert [r.t.hour for r in df.collect()] == [13, 19]


@pytest.mark.parametrize("day, hours", [("2026-04-24", 23), ("2026-10-29", 25), ("2026-07-01", 24)])
def test_length_of_local_days(spark, day, hours):
    df = spark.range(1).select(hours_in_local_day(F.lit(day).cast("date"), "Africa/Cairo"))
    assert df.first()[0] == hours


def test_keys_are_unique_where_the_local_hour_repeats(spark):
    rows, _, _ = star_of(spark, series(spark, hourly(datetime(2026, 10, 29, 18), 6)))
    assert rows.select("reading_key").distinct().count() == 6
    assert rows.filter("hour_of_day_local = 23").count() == 2


def test_dim_date(spark):
    hours = {datetime(2026, 12, 30, 12): 1.0, datetime(2027, 1, 2, 23): 2.0}
    days = star_of(spark, series(spark, hours))[1]
    rows = {r.date_key: r for r in days.collect()}
    # The last reading falls on the third in Cairo, and days without data are there.
    assert list(rows) == [20261230, 20261231, 20270101, 20270102, 20270103]
    first = rows[20270101]
    assert (first.date_day, first.iso_week, first.day_of_week) == (date(2027, 1, 1), 53, 5)
    assert (first.month_name, first.day_name) == ("January  ", "Friday   ")
    assert [r.is_weekend for r in rows.values()] == [False, False, True, True, False]
    plain = dim_date(staged_readings(series(spark, hours)), weekend=(6, 7), padding=False)
    assert [(r.day_name, r.is_weekend) for r in plain.collect()][-2:] == [
        ("Saturday", True), ("Sunday", True)]


def test_dim_date_of_nothing_is_empty(spark):
    assert dim_date(staged_readings(series(spark, hourly(NOW, 1)).limit(0))).isEmpty()


def test_fact_flag_has_three_values(spark):
    values = {datetime(2026, 9, 19, 1): None, datetime(2026, 9, 19, 2): 15.0,
              datetime(2026, 9, 19, 3): 15.001}
    rows, _, _ = star_of(spark, series(spark, values))
    assert [r.exceeds_guideline for r in rows.orderBy("measured_at_utc").collect()] == [
        None, False, True]


def test_fact_drops_unknown_pollutants_and_keeps_nulls(spark):
    both = series(spark, hourly(datetime(2026, 9, 19), 3, lambda i: None)).unionByName(
        series(spark, hourly(datetime(2026, 9, 19), 3), code="radon"))
    rows, _, _ = star_of(spark, both)
    assert rows.count() == 3 and rows.filter("concentration IS NULL").count() == 3


def test_reading_key(spark):
    import hashlib

    rows, _, _ = star_of(spark, series(spark, hourly(datetime(2026, 9, 19, 4), 1)))
    assert rows.first().reading_key == hashlib.md5(b"giza|pm2_5|2026-09-19 04:00:00").hexdigest()


def test_fixture(spark):
    place = spark.createDataFrame([("giza", 1, NOW)],
                                  "location_code string, response_id long, now timestamp_ntz")
    rows = seeded_readings(place.withColumn("now", F.col("now").cast("timestamp")),
                           reference.seed(spark))
    p = utc(profile(rows))[0]
    assert p == (288, 276, datetime(2026, 9, 17, 11), datetime(2026, 9, 20, 10))


def brute_rolling(values, hours):
    out = {}
    for at in values:
        got = [v for t, v in values.items()
               if v is not None and timedelta(0) <= at - t < timedelta(hours=hours)]
        out[at] = (round(sum(map(Decimal, map(str, got))) / len(got), 6) if got else None, len(got))
    return out


@pytest.mark.parametrize("code, hours", [("pm2_5", 24), ("ozone", 8)])
@pytest.mark.parametrize("block", [24, 31, 768])
def test_rolling_mean_over_blocks(spark, code, hours, block):
    start = datetime(2026, 9, 1)
    values = {at: None if i % 11 == 4 else float(i * 7 % 50) for i, at in enumerate(hourly(start, 120))
              if i % 13 != 5 and not 40 < i < 75}
    rows, _, dim = star_of(spark, series(spark, values, code))
    got = {r[2]: (r[5], r[6]) for r in utc(reports.rolling_guideline(rows, dim, block))}
    assert got == brute_rolling(values, hours)


@pytest.mark.parametrize("block", [3, 23, 768])
def test_periods_longer_than_a_block(spark, block):
    values = {at: float(i % 9) for i, at in enumerate(hourly(datetime(2026, 9, 1), 60)) if i % 5}
    rows, _, dim = star_of(spark, series(spark, values))
    got = {r[2]: (r[5], r[6]) for r in utc(reports.rolling_guideline(rows, dim, block))}
    assert got == brute_rolling(values, 24)
    annual = dim.withColumn("who_averaging_hours", F.lit(8760).cast("short"))
    got = {r[2]: (r[5], r[6]) for r in utc(reports.rolling_guideline(rows, annual, block))}
    assert got == brute_rolling(values, 8760)


def test_gap_report_on_a_long_day(spark):
    # 29 October has 25 hours in Cairo; it starts at 21:00 UTC on the 28th.
    values = hourly(datetime(2026, 10, 28, 21), 25, lambda i: None if i == 3 else 1.0)
    del values[datetime(2026, 10, 29, 5)]
    values[datetime(2026, 10, 31, 3)] = 1.0
    rows, days, dim = star_of(spark, series(spark, values))
    got = {(r.pollutant_key, r.date_key): (r.expected_hours, r.null_hours, r.absent_hours)
           for r in reports.gap_report(rows, days, dim).collect()}
    assert len(got) == 4 * 3
    assert got[("pm2_5", 20261029)] == (25, 1, 1)
    assert got[("pm2_5", 20261030)] == (24, 0, 24)
    assert got[("ozone", 20261029)] == (25, 0, 25)


def test_weekend_profile_and_shares(spark):
    # 2026-09-18 is a Friday, 2026-09-20 a Sunday.
    values = {datetime(2026, 9, 18, 10): 30.0, datetime(2026, 9, 18, 11): 10.0,
              datetime(2026, 9, 20, 10): 7.0, datetime(2026, 9, 20, 11): None}
    rows, days, _ = star_of(spark, series(spark, values))
    got = {r.is_weekend: (r.mean_concentration, r.n_known)
           for r in reports.weekend_profile(rows, days).collect()}
    assert got == {True: (Decimal("20"), 2), False: (Decimal("7"), 1)}
    share = reports.exceed_share(rows).first()
    assert (share.n_above, share.n_known, share.n_hours) == (1, 3, 4)
    assert share.share_above == Decimal("0.333333")


def test_mean_of_nothing_is_null(spark):
    rows, _, _ = star_of(spark, series(spark, hourly(datetime(2026, 9, 1), 3, lambda i: None)))
    assert reports.daily_mean(rows).first().mean_concentration is None
    assert reports.exceed_share(rows).first().share_above is None


def test_each_location_on_its_own_calendar(spark):
    # Friday 20:00 UTC is Friday in Cairo and Saturday in Tokyo.
    at = {datetime(2026, 9, 18, 20): 1.0}
    readings = series(spark, at).unionByName(series(spark, at, location="tokyo")).unionByName(
        series(spark, at, location="nowhere"))
    locations = spark.createDataFrame(
        [("giza", 0.0, 0.0, "Africa/Cairo", [5, 6], 7), ("tokyo", 0.0, 0.0, "Asia/Tokyo", [7], 7)],
        LOCATIONS)
    got = {r.location_code: (r.measured_at_local.day, r.is_weekend_local)
           for r in staged_by_location(readings, locations).collect()}
    assert got == {"giza": (18, True), "tokyo": (19, False), "nowhere": (18, True)}
