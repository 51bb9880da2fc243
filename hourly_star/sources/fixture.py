"""A deterministic series of readings for any set of locations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourly_star.schemas import CONCENTRATION
from hourly_star.sources.reference import domain_rows


def seeded_readings(locations: DataFrame, pollutants: DataFrame, hours: int = 72) -> DataFrame:
    """`hours` hourly slots up to `now` for each location and pollutant.

    `locations` has location_code, response_id and now. The value is NULL at
    four o'clock UTC, elsewhere a sine around a level set by the sort order.
    """
    last = F.date_trunc("hour", F.col("now"))
    slots = locations.select(
        "location_code", F.col("response_id").alias("source_response_id"),
        F.explode(F.sequence(last - F.make_dt_interval(hours=F.lit(hours - 1)), last,
                             F.make_dt_interval(hours=F.lit(1)))).alias("measured_at_utc"),
    )
    # Every slot gets every row of the reference table, whose size is checked.
    domain = F.array(*[
        F.struct(F.lit(row.pollutant_code).alias("pollutant_code"),
                 F.lit(row.unit).alias("unit"), F.lit(row.sort_order).alias("sort_order"))
        for row in domain_rows(pollutants)
    ])
    wave = 25 + 10 * F.sin(F.unix_timestamp("measured_at_utc") / F.lit(7200.0))
    return (
        slots.select("location_code", "source_response_id", "measured_at_utc", F.inline(domain))
        .select(
            "location_code", "pollutant_code", "measured_at_utc",
            F.when(F.hour("measured_at_utc") == 4, F.lit(None))
            .otherwise(F.round(wave + F.col("sort_order") * 6, 3)).cast(CONCENTRATION)
            .alias("value"),
            "unit", "source_response_id",
        )
    )


def profile(readings: DataFrame) -> DataFrame:
    """Row count, known values and the time range."""
    return readings.agg(
        F.count(F.lit(1)).alias("readings"), F.count("value").alias("non_null"),
        F.min("measured_at_utc").alias("earliest"), F.max("measured_at_utc").alias("latest"),
    )
