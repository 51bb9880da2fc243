from __future__ import annotations

import json
import uuid
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from hourly_star import build_session
from hourly_star.plans.ingest import store_reference
from hourly_star.schemas import CONCENTRATION
from hourly_star.sources import reference
from hourly_star.sources.landing import ENVELOPE
from hourly_star.sources.tables import Warehouse

CODES = ["pm2_5", "pm10", "nitrogen_dioxide", "ozone"]
UNITS = {code: "ug/m3" for code in CODES}
NOW = datetime(2027, 3, 8, 17, 45)  # when documents of the tests land


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "4", shuffle_partitions=4,
        **{"spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
           "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse"))})
    yield session
    session.stop()


@pytest.fixture
def warehouse(spark, tmp_path):
    made = Warehouse(spark, str(tmp_path / "tables"), f"t{uuid.uuid4().hex[:8]}_").create()
    store_reference(made, reference.seed(spark))
    return made


def body(times=None, values=None, units=None, offset=0, drop=(), **series):
    """A response document; `values` is the array of every code unless named.

    By default two past hours of a day, the first without a value, and one to come.
    """
    times = [f"2027-03-08T{hour:02d}:00" for hour in (4, 15, 20)] if times is None else times
    values = [None, 21.75, 8.5] if values is None else values
    arrays = {"time": times} | dict.fromkeys(CODES, values) | series
    spelled = dict(zip(CODES, ["\u03bcg/m\u00b3", "\u00b5g/m\u00b3", "ug/m3", "\u03bcg/m\u00b3"]))
    document = {"hourly": {name: arrays[name] for name in arrays if name not in drop},
                "hourly_units": spelled if units is None else units, "utc_offset_seconds": offset}
    return json.dumps(document, ensure_ascii=False)


def responses(spark, *bodies, location="giza", at=NOW):
    rows = [(i + 1, location, text, at) for i, text in enumerate(bodies)]
    return spark.createDataFrame(
        rows, "response_id long, location_code string, payload string, ingested_at timestamp_ntz"
    ).withColumn("ingested_at", F.col("ingested_at").cast("timestamp"))


def envelopes(spark, *bodies, location="giza", day=date(2027, 3, 8), fetched=NOW):
    rows = [(f"doc-{i}", location, f"https://example.invalid/{i}", "{}", day, day, 200, fetched,
             text if isinstance(text, (bytes, bytearray)) else bytearray(text.encode()))
            for i, text in enumerate(bodies)]
    return spark.createDataFrame(rows, ENVELOPE)


def submissions(spark, rows):
    """Rows of (location, code, hour, value, unit, response id, ingested at)."""
    df = spark.createDataFrame(
        [(*r[:3], None if r[3] is None else Decimal(str(r[3])), *r[4:]) for r in rows],
        "location_code string, pollutant_code string, measured_at_utc timestamp_ntz, "
        "value decimal(10,3), unit string, response_id long, ingested_at timestamp_ntz")
    return df.withColumn("measured_at_utc", F.col("measured_at_utc").cast("timestamp")) \
        .withColumn("ingested_at", F.col("ingested_at").cast("timestamp")) \
        .withColumn("value", F.col("value").cast(CONCENTRATION))


def utc(df):
    """Rows with instants as naive UTC datetimes."""
    return [tuple(row) for row in df.select(*[
        F.col(n).cast("timestamp_ntz").alias(n) if t == "timestamp" else F.col(n)
        for n, t in df.dtypes]).collect()]
