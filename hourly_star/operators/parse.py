"""Response documents to readings: decode, guard, unpivot."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourly_star.functions.units import normalised_unit
from hourly_star.operators.constraints import RESPONSE_RULES
from hourly_star.schemas import CONCENTRATION, payload_schema

TIME_PATTERN = "yyyy-MM-dd'T'HH:mm"

# The smallest double that no longer rounds into decimal(10,3).
TOO_LARGE = 9999999.9995

# The greatest double that rounds to a negative decimal(10,3).
NEGATIVE = -0.0005

JSON_OPTIONS = {
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": "_corrupt_record",
    "allowNonNumericNumbers": "false",
}


class UpstreamDataError(ValueError):
    """Responses that do not mean what the tables expect."""


def parse_responses(responses: DataFrame, codes: list[str],
                    expected_units: dict[str, str] | None = None,
                    as_of: str | Column = "ingested_at") -> DataFrame:
    """All rows the responses give rise to, in one pass over the documents.

    A good response gives one row per hour and code, forecast hours marked; a
    refused one gives a single row that carries the reason. Use `readings`,
    `rejected` and `dropped_forecast` to take the parts. `as_of` is the time
    beyond which an hour is a forecast, by default the landing time.
    """
    codes = list(codes)
    guarded = _guarded(responses, codes, expected_units or {}, as_of)
    columns = range(len(codes))
    series = F.arrays_zip("times", *[f"values_{i}" for i in columns])
    # The guard sits inside the generator, not in a filter: a filter would be
    # pushed below the projection and decode the document once per reference.
    hours = guarded.select(
        "response_id", "location_code", "ingested_at", "as_of", "guard_error",
        *[f"unit_{i}" for i in columns],
        F.explode_outer(F.when(F.col("guard_error").isNull(), series)).alias("hour"),
    )
    wide = hours.select(
        "response_id", "location_code", "ingested_at", "guard_error",
        F.col("hour")["times"].alias("measured_at_utc"),
        (F.col("hour")["times"] > F.col("as_of")).alias("is_forecast"),
        *[F.col("hour")[f"values_{i}"].alias(f"value_{i}") for i in columns],
        *[f"unit_{i}" for i in columns],
    )
    per_code = F.array(*[
        F.struct(F.lit(code).alias("pollutant_code"), F.col(f"value_{i}").alias("raw_value"),
                 F.col(f"unit_{i}").alias("unit"))
        for i, code in enumerate(codes)
    ])
    cells = wide.select(
        "response_id", "location_code", "ingested_at", "guard_error", "measured_at_utc",
        "is_forecast", F.inline_outer(F.when(F.col("measured_at_utc").isNotNull(), per_code)),
    )
    return cells.select(
        "response_id", "location_code", "pollutant_code", "measured_at_utc",
        F.col("raw_value").cast(CONCENTRATION).alias("value"), "unit", "ingested_at",
        "is_forecast", "guard_error",
    )


def _guarded(responses: DataFrame, codes: list[str], expected: dict[str, str],
             as_of: str | Column) -> DataFrame:
    limit = F.col(as_of) if isinstance(as_of, str) else as_of
    doc = F.col("doc")
    status = F.col("http_status") if "http_status" in responses.columns else F.lit(200)
    decoded = responses.select(
        "response_id", "location_code", "ingested_at", limit.alias("as_of"),
        status.alias("http_status"), _broken_rule(responses.columns).alias("broken_rule"),
        F.from_json("payload", payload_schema(codes), JSON_OPTIONS).alias("doc"),
    )
    hourly = doc["hourly"]
    fields = decoded.select(
        "response_id", "location_code", "ingested_at", "as_of", "http_status", "broken_rule",
        (doc.isNull() | doc["_corrupt_record"].isNotNull()).alias("malformed"),
        doc["utc_offset_seconds"].alias("utc_offset"),
        F.transform(hourly["time"], lambda t: F.try_to_timestamp(t, F.lit(TIME_PATTERN)))
        .alias("times"),
        *[hourly[code].alias(f"values_{i}") for i, code in enumerate(codes)],
        *[normalised_unit(doc["hourly_units"][code]).alias(f"unit_{i}")
          for i, code in enumerate(codes)],
    )
    return fields.select("*", _first_error(codes, expected).alias("guard_error"))


def _broken_rule(columns: list[str]) -> Column:
    """The first rule for raw rows that fails, of those whose columns are there."""
    checked = [(name, broken) for name, broken in RESPONSE_RULES
               if set(re.findall(r"`(\w+)`", broken)) <= set(columns)]
    return F.coalesce(F.lit(None).cast("string"),
                      *[F.when(F.expr(broken), F.lit(name)) for name, broken in checked])


def _first_error(codes: list[str], expected: dict[str, str]) -> Column:
    """Reason of the first guard that fails, NULL when all pass."""
    times = F.col("times")
    n_times = F.coalesce(F.size(times), F.lit(0))

    def fails(condition: Column, reason: str) -> Column:
        return F.when(condition, F.lit(reason))

    guards = [
        # What no run may load, replays included: one verdict for all of them.
        F.col("broken_rule"),
        fails(F.col("location_code").isNull(), "required:location_code"),
        # Bodies of failed requests are landed for the record, never loaded.
        fails(F.col("http_status") >= 400, "http_error"),
        # A value of a wrong JSON type turns its whole array into NULL, so a
        # body that does not decode in full is refused before anything else.
        fails(F.col("malformed"), "malformed"),
        fails(~F.col("utc_offset").eqNullSafe(F.lit(0.0)), "utc_offset"),
        fails(n_times < 1, "no_time_axis"),
    ]
    for i, code in enumerate(codes):
        values, unit = F.col(f"values_{i}"), F.col(f"unit_{i}")
        guards += [
            fails(values.isNull(), f"missing:{code}"),
            fails(F.size(values) != n_times, f"length:{code}"),
            fails(unit.isNull(), f"unknown_unit:{code}"),
        ]
        if code in expected:
            guards.append(fails(unit != F.lit(expected[code]), f"unexpected_unit:{code}"))
    kept = F.filter(times, lambda t: t <= F.col("as_of"))
    guards += [
        fails(F.exists(times, lambda t: t.isNull()), "malformed_time"),
        fails(F.size(F.array_distinct(kept)) < F.size(kept), "duplicate_time"),
        fails(F.exists(kept, lambda t: F.date_trunc("hour", t) != t), "on_hour:measured_at_utc"),
    ]
    for i, code in enumerate(codes):
        values = F.col(f"values_{i}")
        guards.append(fails(
            (F.array_max(values) >= TOO_LARGE) | (F.array_min(values) <= -TOO_LARGE),
            f"overflow:{code}",
        ))
    for i in range(len(codes)):
        pairs = F.arrays_zip(times.alias("t"), F.col(f"values_{i}").alias("v"))
        guards.append(fails(
            F.exists(pairs, lambda p: (p["t"] <= F.col("as_of")) & (p["v"] <= NEGATIVE)),
            "nonnegative:value"))
    return F.coalesce(*guards)


def readings(parsed: DataFrame) -> DataFrame:
    """Measured hours, with those whose value is NULL."""
    return (
        parsed.filter(F.col("measured_at_utc").isNotNull() & ~F.col("is_forecast"))
        .drop("is_forecast", "guard_error")
    )


def rejected(parsed: DataFrame) -> DataFrame:
    """One row per refused response."""
    # Only refused responses have no hour. Asking for the hour, not for the
    # error, keeps the condition above the generator.
    return parsed.filter(F.col("measured_at_utc").isNull()).select(
        "response_id", "location_code", "guard_error"
    )


def dropped_forecast(parsed: DataFrame) -> DataFrame:
    """Rows kept and forecast rows dropped per accepted response."""
    return (
        parsed.filter(F.col("measured_at_utc").isNotNull())
        .groupBy("response_id", "location_code")
        .agg(F.count_if(~F.col("is_forecast")).alias("submitted"),
             F.count_if("is_forecast").alias("dropped_future"))
    )


def document_counts(responses: DataFrame, codes: list[str],
                    expected_units: dict[str, str] | None = None,
                    as_of: str | Column = "ingested_at") -> DataFrame:
    """What `parse_responses` would make of each document, without unpivoting it.

    One row per response: submitted and dropped_future of an accepted one, the
    reason of a refused one. Every hour gives one row per code, so the lengths
    of the time axis tell the numbers.
    """
    codes = list(codes)
    good = F.col("guard_error").isNull()
    dropped = F.size(F.filter("times", lambda t: t > F.col("as_of")))

    def rows(hours: Column) -> Column:
        return F.when(good, hours.cast("long") * len(codes)).otherwise(F.lit(0))

    return _guarded(responses, codes, expected_units or {}, as_of).select(
        "response_id", "location_code", rows(F.size("times") - dropped).alias("submitted"),
        rows(dropped).alias("dropped_future"), "guard_error")


def refuse(rejects: DataFrame, shown: int = 20) -> None:
    """Raise if any response was refused, naming the first few."""
    some = rejects.orderBy("response_id").limit(shown).collect()
    if some:
        reasons = reduce(lambda a, b: f"{a}, {b}",
                         [f"{row.response_id}: {row.guard_error}" for row in some])
        raise UpstreamDataError(f"refused responses ({reasons})")
