"""Date windows and the request plan, for any number of locations at once."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

LOCATIONS = T.StructType([
    T.StructField("location_code", T.StringType()),
    T.StructField("latitude", T.DoubleType()),
    T.StructField("longitude", T.DoubleType()),
    T.StructField("time_zone", T.StringType()),
    T.StructField("weekend_days", T.ArrayType(T.IntegerType())),
    T.StructField("lookback_days", T.IntegerType()),
])


def windows_of(start: Column, end: Column, chunk_days: int) -> Column:
    """Array of contiguous (window_start, window_end), each at most `chunk_days` long."""
    if chunk_days < 1:
        raise ValueError("a window holds at least one day")
    step = F.lit(chunk_days)
    offsets = F.sequence(F.lit(0), F.datediff(end, start), step)
    windows = F.transform(offsets, lambda i: F.struct(
        F.date_add(start, i).alias("window_start"),
        F.least(F.date_add(start, i + step - 1), end).alias("window_end"),
    ))
    backwards = F.raise_error(F.concat_ws(" ", F.lit("range ends before it starts:"),
                                          start.cast("string"), end.cast("string")))
    # The failing branch needs the type of the other one.
    return F.when(end < start, backwards.cast(T.NullType())).otherwise(windows)


def split_windows(ranges: DataFrame, chunk_days: int, start: str = "start",
                  end: str = "end") -> DataFrame:
    """One row per window instead of one row per range; other columns are kept."""
    others = [c for c in ranges.columns if c not in (start, end)]
    return ranges.select(
        *others, F.inline(windows_of(F.col(start), F.col(end), chunk_days))
    )


def lookback(locations: DataFrame, as_of: date | Column) -> DataFrame:
    """The window a run asks for: `lookback_days` days ending at `as_of`.

    A location may bring a range of its own in `from_day` and `to_day`; they
    come together.
    """
    last = as_of if isinstance(as_of, Column) else F.lit(as_of).cast("date")
    days = F.col("lookback_days")
    first = F.when(
        days < 1, F.raise_error(F.lit("lookback must be at least one day")).cast("date")
    ).otherwise(F.date_sub(last, days - 1))
    if not {"from_day", "to_day"} <= set(locations.columns):
        return locations.select("*", first.alias("start"), last.alias("end"))
    given, until = F.col("from_day"), F.col("to_day")
    half = given.isNull() != until.isNull()
    return locations.select(
        "*", F.when(half, F.raise_error(F.lit("give both ends of the range or neither")).cast("date"))
        .when(given.isNotNull(), given).otherwise(first).alias("start"),
        F.coalesce(until, last).alias("end"))


def request_plan(windows: DataFrame, codes: list[str], base_url: str) -> DataFrame:
    """What to ask for: one row per location and window, with its parameters."""
    params = F.struct(
        F.col("latitude"),
        F.col("longitude"),
        F.array_join(F.array(*[F.lit(c) for c in codes]), ",").alias("hourly"),
        F.date_format("window_start", "yyyy-MM-dd").alias("start_date"),
        F.date_format("window_end", "yyyy-MM-dd").alias("end_date"),
        F.lit("UTC").alias("timezone"),
    )
    query = F.concat_ws("&", *[
        F.concat(F.lit(f"{name}="), F.url_encode(params[name].cast("string")))
        for name in ("latitude", "longitude", "hourly", "start_date", "end_date", "timezone")
    ])
    return windows.select(
        "location_code", "window_start", "window_end",
        F.to_json(params).alias("request_params"),
        F.concat(F.lit(base_url + "?"), query).alias("request_url"),
    )
