import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from hourly_star.sources.windows import LOCATIONS, lookback, request_plan, split_windows

EPOCH = date(1999, 11, 5)


def drawn_ranges(seed, count=80):
    """Ranges of many places: single days, short ones, and some of several years."""
    rng = random.Random(seed)
    ranges = []
    for i in range(count):
        start = EPOCH + timedelta(days=rng.randrange(20_000))
        ranges.append((f"place-{i}", start, start + timedelta(days=rng.choice([0, 1, 6, 40, 366, 1500]))))
    return ranges


def split(spark, ranges, chunk):
    rows = split_windows(spark.createDataFrame(ranges, "location_code string, start date, end date"), chunk)
    by_place = {}
    for r in rows.collect():
        by_place.setdefault(r.location_code, []).append((r.window_start, r.window_end))
    return by_place


@pytest.mark.parametrize("chunk", [1, 4, 29, 90, 5000])
def test_windows_tile_every_range(spark, chunk):
    ranges = drawn_ranges(chunk)
    got = split(spark, ranges, chunk)
    assert set(got) == {place for place, _, _ in ranges}
    for place, start, end in ranges:
        windows = sorted(got[place])
        assert windows[0][0] == start and windows[-1][1] == end
        assert all(b - a == timedelta(days=chunk - 1) for a, b in windows[:-1])
        assert timedelta() <= windows[-1][1] - windows[-1][0] < timedelta(days=chunk)
        assert all(after[0] - before[1] == timedelta(days=1) for before, after in zip(windows, windows[1:]))


def test_other_columns_stay_and_bad_ranges_raise(spark):
    frame = spark.createDataFrame(drawn_ranges(3, 5), "location_code string, start date, end date")
    kept = split_windows(frame.withColumn("note", F.lit("n")), 10)
    assert kept.columns == ["location_code", "note", "window_start", "window_end"]
    swapped = frame.select("location_code", F.col("end").alias("start"), F.col("start").alias("end")).where("start > end")
    with pytest.raises(Exception, match="ends before it starts"):
        split_windows(swapped, 10).collect()
    for chunk in (0, -7):
        with pytest.raises(ValueError):
            split_windows(frame, chunk)


def places(spark, days):
    rng = random.Random(17)
    return spark.createDataFrame(
        [(f"place-{i}", rng.uniform(-80, 80), rng.uniform(-170, 170), "UTC", [6, 7], n) for i, n in enumerate(days)],
        LOCATIONS)


def test_each_place_looks_back_its_own_number_of_days(spark):
    days = [1, 2, 10, 45, 400]
    for as_of in (date(2004, 3, 1), date(2031, 1, 1)):
        rows = lookback(places(spark, days), as_of).collect()
        assert {r.location_code: (r.end - r.start).days + 1 for r in rows} == {
            f"place-{i}": n for i, n in enumerate(days)}
        assert {r.end for r in rows} == {as_of}
    for n in (0, -3):
        with pytest.raises(Exception, match="at least one day"):
            lookback(places(spark, [n]), date(2004, 3, 1)).collect()


def test_a_place_may_bring_its_own_range(spark):
    own = places(spark, [5, 5, 5]).withColumns({
        "from_day": F.expr("if(location_code = 'place-1', date'2003-05-06', null)"),
        "to_day": F.expr("if(location_code = 'place-1', date'2003-07-08', null)")})
    rows = {r.location_code: (r.start, r.end) for r in lookback(own, date(2010, 10, 10)).collect()}
    assert rows["place-1"] == (date(2003, 5, 6), date(2003, 7, 8))
    assert rows["place-0"] == rows["place-2"] == (date(2010, 10, 6), date(2010, 10, 10))
    with pytest.raises(Exception, match="both ends"):
        lookback(own.withColumn("to_day", F.lit(None).cast("date")), date(2010, 10, 10)).collect()


def test_requests_say_what_the_window_says(spark):
    ranges = places(spark, [3, 3]).select("*", F.lit("2011-06-28").cast("date").alias("start"),
                                          F.lit("2011-07-30").cast("date").alias("end"))
    windows = split_windows(ranges, 20)
    plan = request_plan(windows, ["ozone", "pm10"], "https://example.invalid/api").collect()
    assert len(plan) == 4
    asked = {r.location_code: r for r in windows.collect()}
    for r in plan:
        place = asked[r.location_code]
        for text in (f"latitude={place.latitude}", f"longitude={place.longitude}", "hourly=ozone%2Cpm10",
                     f"start_date={r.window_start}", f"end_date={r.window_end}", "timezone=UTC"):
            assert text in r.request_url.split("?")[1].split("&")
        for text in ('"hourly":"ozone,pm10"', f'"start_date":"{r.window_start}"', '"timezone":"UTC"'):
            assert text in r.request_params
