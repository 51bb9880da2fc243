"""Questions the star schema answers."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hourly_star.functions.calendar import date_key, hours_in_local_day
from hourly_star.functions.numbers import exact_mean, ratio
from hourly_star.plans.star import TIME_ZONE, with_date
from hourly_star.sources.reference import MAX_CODES

SERIES = ["location_code", "pollutant_key"]

# Length of the pieces a series is cut into for moving averages.
BLOCK_HOURS = 32 * 24


def daily_mean(fact: DataFrame) -> DataFrame:
    """Mean, range and coverage per pollutant and local calendar day."""
    return fact.groupBy("date_key", "pollutant_key").agg(
        exact_mean(F.col("concentration")).alias("mean_concentration"),
        F.min("concentration").alias("min_concentration"),
        F.max("concentration").alias("max_concentration"),
        F.count("concentration").alias("n_known"),
        F.count(F.lit(1)).alias("n_hours"),
    )


def weekend_profile(fact: DataFrame, dates: DataFrame) -> DataFrame:
    """Weekend against weekdays per pollutant."""
    # Per day first, so the join with the calendar sees one row per day.
    daily = fact.groupBy("date_key", "pollutant_key").agg(
        F.sum("concentration").alias("total"), F.count("concentration").alias("n"),
        F.max("concentration").alias("top"))
    return with_date(daily, dates, "is_weekend").groupBy("is_weekend", "pollutant_key").agg(
        ratio(F.sum("total"), F.sum("n")).alias("mean_concentration"),
        F.max("top").alias("max_concentration"),
        F.sum("n").alias("n_known"),
    )


def local_weekend_profile(staged: DataFrame) -> DataFrame:
    """Weekend against weekdays per location, each by its own calendar."""
    return staged.groupBy("location_code", "is_weekend_local").agg(
        exact_mean(F.col("concentration")).alias("mean_concentration"),
        F.count("concentration").alias("n_known"),
    )


def gap_report(fact: DataFrame, dates: DataFrame, pollutants: DataFrame,
               zone: str = TIME_ZONE) -> DataFrame:
    """Hours without a value and hours without a row, per series and local day.

    Days of which a series has no row at all are in the report.
    """
    codes = [row[0] for row in pollutants.select("pollutant_key").limit(MAX_CODES + 1).collect()]
    if len(codes) > MAX_CODES:
        raise ValueError(f"more than {MAX_CODES} pollutant codes")
    span = dates.agg(F.min("date_day"), F.max("date_day")).first()
    days = F.sequence(F.lit(span[0]).cast("date"), F.lit(span[1]).cast("date"))
    spine = (
        fact.select("location_code").distinct()
        .select("location_code", F.explode(F.array(*[F.lit(c) for c in codes]))
                .alias("pollutant_key"))
        .select("*", F.explode(days).alias("date_day"))
        .select("*", date_key(F.col("date_day")).alias("date_key"),
                hours_in_local_day(F.col("date_day"), zone).alias("expected_hours"))
    )
    seen = fact.groupBy(*SERIES, "date_key").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col("concentration").isNull()).alias("n_null"))
    return spine.join(seen, [*SERIES, "date_key"], "left").select(
        *SERIES, "date_key", "expected_hours",
        F.coalesce("n_null", F.lit(0)).alias("null_hours"),
        (F.col("expected_hours") - F.coalesce("n_rows", F.lit(0))).alias("absent_hours"),
    )


def exceed_share(fact: DataFrame) -> DataFrame:
    """Share of the known hours above the guideline, per location and pollutant."""
    above = F.count_if("exceeds_guideline")
    known = F.count("exceeds_guideline")
    return fact.groupBy(*SERIES).agg(
        above.alias("n_above"), known.alias("n_known"),
        F.count(F.lit(1)).alias("n_hours"),
        ratio(above, known).alias("share_above"),
    )


def rolling_guideline(fact: DataFrame, pollutants: DataFrame,
                      block_hours: int = BLOCK_HOURS) -> DataFrame:
    """Mean over the guideline's own averaging period, and whether it is above.

    The frame is a range of time, so absent hours do not stretch it; `n_known`
    of `averaging_hours` tells how much of it is covered. A series is cut into
    blocks which are averaged apart; a row is sent to every later block that
    its own averaging period reaches, so periods may be of any length.
    """
    periods = sorted({row[0] for row in pollutants.select("who_averaging_hours")
                      .filter("who_averaging_hours IS NOT NULL").distinct().collect()})
    hour, length = 3600, block_hours * 3600
    limits = pollutants.select(
        "pollutant_key", "who_guideline", F.col("who_averaging_hours").alias("averaging_hours"))
    second = F.unix_timestamp("measured_at_utc")
    own = F.expr("second div {}".format(length))
    placed = (
        fact.select(*SERIES, "measured_at_utc", "concentration", second.alias("second"))
        .join(limits, "pollutant_key")
        .withColumn("own", own)
        .withColumn("block", F.explode(F.sequence("own", F.expr(
            f"(second + (coalesce(averaging_hours, 1) - 1) * {hour}L) div {length}"))))
    )
    total, known = F.lit(None).cast("decimal(20,3)"), F.lit(None).cast("long")
    for hours in periods:
        w = (Window.partitionBy(*SERIES, "block").orderBy("second")
             .rangeBetween(-(hours - 1) * hour, 0))
        chosen = F.col("averaging_hours") == hours
        total = F.when(chosen, F.sum("concentration").over(w)).otherwise(total)
        known = F.when(chosen, F.count("concentration").over(w)).otherwise(known)
    averaged = placed.withColumn("total", total).withColumn("n_known", known)
    mean = ratio(F.col("total"), F.col("n_known"))
    return averaged.filter(F.col("block") == F.col("own")).select(
        *SERIES, "measured_at_utc", "concentration",
        F.col("averaging_hours").cast("int").alias("averaging_hours"),
        mean.alias("rolling_mean"), "n_known",
        (mean > F.col("who_guideline")).alias("above_guideline"),
    )


def hour_profile(fact: DataFrame) -> DataFrame:
    """Mean per pollutant and local hour of day."""
    return fact.groupBy("hour_of_day_local", "pollutant_key").agg(
        exact_mean(F.col("concentration")).alias("mean_concentration"),
        F.count("concentration").alias("n_known"),
    )


def pull_novelty(responses: DataFrame, log: DataFrame) -> DataFrame:
    """How much of what was pulled was new, per location.

    Bodies already seen are counted by digest, submissions by what their
    upsert did.
    """
    bodies = responses.groupBy("location_code", "payload_sha256").agg(
        F.count(F.lit(1)).alias("n")).groupBy("location_code").agg(
        F.sum("n").alias("n_responses"),
        F.sum(F.col("n") - 1).alias("n_repeated_bodies"))
    rows = log.groupBy("location_code").agg(
        F.count(F.lit(1)).alias("submitted"),
        F.count_if(F.col("action") == "I").alias("inserted"),
        F.count_if(F.col("action") == "U").alias("changed"))
    return bodies.join(rows, "location_code").select(
        "*", ratio(F.col("submitted") - F.col("inserted") - F.col("changed"),
                   F.col("submitted")).alias("unchanged_share"))
