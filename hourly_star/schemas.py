"""Column layout of every table and of the response document."""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import types as T

CONCENTRATION = T.DecimalType(10, 3)

# The natural key of a reading, and of a fact row.
READING_KEY = ("location_code", "pollutant_code", "measured_at_utc")
FACT_KEY = ("location_code", "pollutant_key", "measured_at_utc")

# --- Fixed values: the measured variables and their reference attributes.
# code, display name, unit, guideline, averaging hours, plausible maximum, order
POLLUTANT_ROWS = (
    ("pm2_5", "PM2.5", "ug/m3", Decimal("15.0"), 24, Decimal("1000.0"), 1),
    ("pm10", "PM10", "ug/m3", Decimal("45.0"), 24, Decimal("2000.0"), 2),
    ("nitrogen_dioxide", "NO2", "ug/m3", Decimal("25.0"), 24, Decimal("1000.0"), 3),
    ("ozone", "O3", "ug/m3", Decimal("100.0"), 8, Decimal("1000.0"), 4),
)

# --- Fixed values: accepted spellings of the unit. The first character of the
# first is GREEK SMALL LETTER MU, of the second MICRO SIGN.
UNIT_SPELLINGS = {
    "μg/m³": "ug/m3",
    "µg/m³": "ug/m3",
    "ug/m3": "ug/m3",
}


def _struct(*fields: tuple[str, T.DataType | str, str]) -> T.StructType:
    named = {"string": T.StringType(), "binary": T.BinaryType(), "long": T.LongType(), "int": T.IntegerType(),
             "short": T.ShortType(), "date": T.DateType(), "timestamp": T.TimestampType(),
             "ntz": T.TimestampNTZType(), "boolean": T.BooleanType(), "ints": T.ArrayType(T.IntegerType())}
    return T.StructType([
        T.StructField(name, named[kind] if isinstance(kind, str) else kind, True,
                      {"comment": comment} if comment else None)
        for name, kind, comment in fields
    ])


POLLUTANTS = _struct(
    ("pollutant_code", "string", "variable name as the source spells it"),
    ("display_name", "string", ""),
    ("unit", "string", "unit readings must arrive in"),
    ("who_guideline", CONCENTRATION, "reference line, not a validation bound"),
    ("who_averaging_hours", "short", ""),
    ("plausible_max", CONCENTRATION, "above this a reading is reported"),
    ("sort_order", "short", ""),
)

RESPONSES = _struct(
    ("response_id", "long", "increases with arrival"),
    ("source", "string", ""),
    ("location_code", "string", ""),
    ("request_url", "string", ""),
    ("request_params", "string", "JSON"),
    ("window_start", "date", ""),
    ("window_end", "date", ""),
    ("http_status", "short", ""),
    ("payload", "string", "body as received"),
    ("payload_sha256", "string", "digest of the body bytes, before parsing"),
    ("ingested_at", "timestamp", "when the row landed"),
    ("document", "string", "name of the document in its batch"),
    ("ingest_date", "date", ""),
    ("ingest_batch", "string", "landing the same batch twice keeps one copy"),
)

REFUSALS = _struct(
    ("document", "string", ""),
    ("location_code", "string", ""),
    ("response_id", "long", "NULL: the envelope was refused, so the body is not in the raw log"),
    ("reason", "string", "the first rule or guard that fails"),
    ("body", "binary", "of a refused envelope"),
    ("ingest_date", "date", ""),
    ("ingest_batch", "string", ""),
)

READINGS = _struct(
    ("location_code", "string", ""),
    ("pollutant_code", "string", ""),
    ("measured_at_utc", "timestamp", "hour of measurement; local time is derived"),
    ("value", CONCENTRATION, "NULL: the source had no data for this hour"),
    ("unit", "string", ""),
    ("source_response_id", "long", "response the present value came from"),
    ("first_loaded_at", "timestamp", "never moves"),
    ("loaded_at", "timestamp", "when value or unit last changed"),
    ("utc_date", "date", ""),
    ("bucket", "int", "of the location"),
)

CALENDARS = _struct(
    ("location_code", "string", ""),
    ("valid_from", "timestamp", "NULL: from the beginning"),
    ("time_zone", "string", ""),
    ("weekend_days", "ints", "Monday = 1"),
)

CHANGES = _struct(
    ("seq", "long", "increases with every upsert that writes"),
    ("utc_date", "date", "a day it wrote"),
    ("since", "timestamp", "earliest load time among the rows it wrote there"),
    ("inserted", "long", ""),
    ("changed", "long", ""),
)

STAR_RUNS = _struct(
    ("seq", "long", "changes up to here are in the fact"),
    ("days", "long", "days the increment looked at"),
    ("rows_read", "long", "changed readings on them"),
    ("rows_written", "long", "of which the fact did not hold"),
)

DIM_DATE = _struct(
    ("date_key", "int", "yyyymmdd"),
    ("date_day", "date", "local calendar day"),
    ("year", "int", ""),
    ("quarter", "int", ""),
    ("month", "int", ""),
    ("month_name", "string", ""),
    ("day_of_month", "int", ""),
    ("day_of_week", "int", "Monday = 1"),
    ("day_name", "string", ""),
    ("iso_week", "int", ""),
    ("is_weekend", "boolean", ""),
)

DIM_POLLUTANT = T.StructType(
    [T.StructField("pollutant_key", T.StringType())] + POLLUTANTS.fields[1:]
)

FACT = _struct(
    ("reading_key", "string", "md5 of the natural key"),
    ("date_key", "int", ""),
    ("pollutant_key", "string", ""),
    ("location_code", "string", ""),
    ("measured_at_utc", "timestamp", ""),
    ("measured_at_local", "ntz", ""),
    ("hour_of_day_local", "int", ""),
    ("concentration", CONCENTRATION, ""),
    ("unit", "string", ""),
    ("exceeds_guideline", "boolean", "NULL when the concentration is unknown"),
    ("source_response_id", "long", ""),
    ("source_loaded_at", "timestamp", "change watermark"),
    ("utc_date", "date", ""),
)


@dataclass(frozen=True)
class Table:
    layer: str
    schema: T.StructType
    partitions: tuple[str, ...]
    comment: str


TABLES = {
    "responses": Table("raw", RESPONSES, ("ingest_date", "ingest_batch"),
                       "Append-only log of responses as received"),
    "refusals": Table("raw", REFUSALS, ("ingest_date", "ingest_batch"),
                      "Envelopes and responses that were refused, and why"),
    "pollutants": Table("staging", POLLUTANTS, (), "Reference domain of measured variables"),
    "hourly_readings": Table("staging", READINGS, ("utc_date", "bucket"),
                             "One row per location, pollutant and hour"),
    "location_calendars": Table("staging", CALENDARS, (), "Time zone and weekend of locations, each valid from an instant"),
    "reading_changes": Table("staging", CHANGES, (), "Days that upserts wrote, for what is built on readings"),
    "star_runs": Table("analytics", STAR_RUNS, (), "What each increment of the fact took up"),
    "dim_date": Table("analytics", DIM_DATE, (), "One row per local calendar day"),
    "dim_pollutant": Table("analytics", DIM_POLLUTANT, (), "One row per pollutant"),
    "fct_hourly_readings": Table("analytics", FACT, ("utc_date",),
                                 "One row per location, pollutant and hour"),
}

LAYERS = {
    "raw": "Responses as received, never edited",
    "staging": "Typed measurements, one row per natural key",
    "analytics": "Star schema",
}


def payload_schema(codes: list[str]) -> T.StructType:
    """Schema of a response document carrying one array per pollutant code."""
    hourly = T.StructType(
        [T.StructField("time", T.ArrayType(T.StringType()))]
        + [T.StructField(code, T.ArrayType(T.DoubleType())) for code in codes]
    )
    return T.StructType([
        T.StructField("utc_offset_seconds", T.DoubleType()),
        T.StructField("hourly_units", T.MapType(T.StringType(), T.StringType())),
        T.StructField("hourly", hourly),
        T.StructField("_corrupt_record", T.StringType()),
    ])
