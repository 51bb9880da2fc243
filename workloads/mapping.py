"""The given tables read as submissions, documents and request plans.

Every event is one submission of a reading: the user group is the location,
the event type the pollutant, the hour of the event the hour of measurement.
The oracle text of the same mapping stands next to each Spark form.
"""

from __future__ import annotations

import uuid
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourly_star.operators.revisions import fold
from hourly_star.plans.ingest import store_reference
from hourly_star.plans.star import dim_date, dim_pollutant, fact, staged_readings
from hourly_star.schemas import CONCENTRATION, POLLUTANTS
from hourly_star.session import prepare, shared_dir, stage
from hourly_star.sources import reference
from hourly_star.sources.tables import Warehouse

CODES = ["pm2_5", "pm10", "nitrogen_dioxide", "ozone"]
UNITS = {code: "ug/m3" for code in CODES}
EVENT_CODES = {"view": "pm2_5", "click": "pm10", "purchase": "nitrogen_dioxide",
               "signup": "ozone"}
# Events of any other type are readings of one more variable of the documents.
OTHER = "unknown"
DOC_CODES = [*CODES, OTHER]
DOC_UNITS = {code: "ug/m3" for code in DOC_CODES}
USERS_PER_LOCATION = 25
FIRST_DAY = "2024-01-01"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def plain(df: DataFrame) -> DataFrame:
    """Instants as UTC wall clock, the way the oracle has them."""
    return df.select(*[
        F.col(f.name).cast("timestamp_ntz").alias(f.name)
        if isinstance(f.dataType, T.TimestampType) else F.col(f.name) for f in df.schema
    ])


def submissions(spark: SparkSession, sf_dir: str, coarse: bool = False) -> DataFrame:
    """One row per event. `coarse` values repeat often, so not all revisions change."""
    events = table(spark, sf_dir, "events")
    code = F.lit(OTHER)
    for kind, name in EVENT_CODES.items():
        code = F.when(F.col("event_type") == kind, name).otherwise(code)
    value = F.floor(F.col("value") / 10) * 10 if coarse else F.col("value")
    at = F.col("ts").cast("timestamp")
    return events.select(
        F.concat(F.lit("loc_"), F.expr(f"user_id div {USERS_PER_LOCATION}").cast("string"))
        .alias("location_code"),
        code.alias("pollutant_code"),
        F.date_trunc("hour", at).alias("measured_at_utc"),
        F.when(F.hour(at) != 4, value).cast(CONCENTRATION).alias("value"),
        F.lit("ug/m3").alias("unit"),
        F.col("event_id").alias("response_id"),
        at.alias("ingested_at"),
    )


def sub_sql(coarse: bool = False) -> str:
    value = "floor(value / 10) * 10" if coarse else "value"
    return f"""sub AS (
  SELECT 'loc_' || CAST(user_id // {USERS_PER_LOCATION} AS VARCHAR) AS location_code,
    CASE event_type WHEN 'view' THEN 'pm2_5' WHEN 'click' THEN 'pm10'
      WHEN 'purchase' THEN 'nitrogen_dioxide' WHEN 'signup' THEN 'ozone'
      ELSE 'unknown' END AS pollutant_code,
    date_trunc('hour', ts) AS measured_at_utc,
    CASE WHEN hour(ts) <> 4 THEN CAST({value} AS DECIMAL(10,3)) END AS value,
    'ug/m3' AS unit, event_id AS response_id, ts AS ingested_at
  FROM events)"""


KEYS = "location_code, pollutant_code, measured_at_utc"


def fold_sql(source: str = "sub", out: str = "folded") -> str:
    """The upsert sequence over `source`, one row after another."""
    return f"""{out}_seq AS (
  SELECT *, row_number() OVER w AS rn, lag(value) OVER w AS pv, lag(unit) OVER w AS pu,
    count(*) OVER (PARTITION BY {KEYS}) AS cnt,
    first_value(ingested_at) OVER w AS first_loaded_at
  FROM {source} WINDOW w AS (PARTITION BY {KEYS} ORDER BY response_id)),
{out}_log AS (
  SELECT *, CASE WHEN rn = 1 THEN 'I'
    WHEN value IS DISTINCT FROM pv OR unit IS DISTINCT FROM pu THEN 'U' ELSE 'N' END AS action
  FROM {out}_seq),
{out}_change AS (
  SELECT {KEYS}, max(response_id) AS cid, CAST(count(*) AS BIGINT) - 1 AS n_updates
  FROM {out}_log WHERE action <> 'N' GROUP BY {KEYS}),
{out} AS (
  SELECT l.location_code, l.pollutant_code, l.measured_at_utc, l.value, l.unit,
    c.cid AS source_response_id, l.first_loaded_at, x.ingested_at AS loaded_at, c.n_updates, l.cnt
  FROM {out}_log l JOIN {out}_change c USING ({KEYS})
  JOIN {out}_log x ON x.location_code = l.location_code
    AND x.pollutant_code = l.pollutant_code AND x.measured_at_utc = l.measured_at_utc
    AND x.response_id = c.cid
  WHERE l.rn = l.cnt)"""


# --- Star over the folded submissions ---------------------------------------

def reference_rows(spark: SparkSession, plausible_max: float | None = None) -> DataFrame:
    rows = reference.seed(prepare(spark))
    if plausible_max is None:
        return rows
    return rows.withColumn("plausible_max", F.lit(plausible_max).cast(CONCENTRATION))


def star(spark: SparkSession, sf_dir: str, plausible_max: float | None = None,
         stored: bool = False) -> dict:
    """All tables of the star.

    `stored` readings are written once, for queries that read the star several
    times; else everything stays lazy.
    """
    readings = fold(submissions(spark, sf_dir))
    if stored:
        readings = stage(readings, f"{shared_dir(spark)}/run_{uuid.uuid4().hex[:12]}/readings")
    pollutants = reference_rows(spark, plausible_max)
    staged = staged_readings(readings)
    dim = dim_pollutant(pollutants)
    return {
        "hourly_readings": readings, "pollutants": pollutants, "stg_hourly_readings": staged,
        "dim_date": dim_date(staged), "dim_pollutant": dim,
        "fct_hourly_readings": fact(staged, dim),
    }


def document_reference(spark: SparkSession) -> DataFrame:
    """The reference rows, and one for the further variable of the documents."""
    return reference.seed(spark).unionByName(spark.createDataFrame(
        [(OTHER, "Other", "ug/m3", Decimal("50.0"), 24, Decimal("1000.0"), 5)], POLLUTANTS))


def pollutants_sql(plausible_max: str | None = None, documents: bool = False) -> str:
    top = {"pm10": "2000.0"}
    other = (("unknown", "Other", "50.0", 24, 5),) if documents else ()
    return "pollutants AS (SELECT * FROM (VALUES " + ", ".join(
        f"('{code}', '{name}', 'ug/m3', CAST({guide} AS DECIMAL(10,3)), "
        f"CAST({hours} AS SMALLINT), "
        f"CAST({plausible_max or top.get(code, '1000.0')} AS DECIMAL(10,3)), "
        f"CAST({order} AS SMALLINT))"
        for code, name, guide, hours, order in (
            ("pm2_5", "PM2.5", "15.0", 24, 1), ("pm10", "PM10", "45.0", 24, 2),
            ("nitrogen_dioxide", "NO2", "25.0", 24, 3), ("ozone", "O3", "100.0", 8, 4), *other)
    ) + (") AS v(pollutant_key, display_name, unit, who_guideline, who_averaging_hours, "
         "plausible_max, sort_order))")


def fact_sql(source: str = "folded", out: str = "fct") -> str:
    return f"""{out}_staged AS (
  SELECT *, (measured_at_utc AT TIME ZONE 'UTC') AT TIME ZONE 'Africa/Cairo'
    AS measured_at_local FROM {source}),
{out} AS (
  SELECT md5(location_code || '|' || pollutant_code || '|'
      || strftime(measured_at_utc, '%Y-%m-%d %H:%M:%S')) AS reading_key,
    CAST(strftime(measured_at_local, '%Y%m%d') AS INTEGER) AS date_key,
    p.pollutant_key, location_code, measured_at_utc, measured_at_local,
    CAST(hour(measured_at_local) AS INTEGER) AS hour_of_day_local,
    value AS concentration, r.unit,
    CASE WHEN value IS NULL THEN NULL ELSE value > p.who_guideline END AS exceeds_guideline,
    source_response_id, loaded_at AS source_loaded_at
  FROM {out}_staged r JOIN pollutants p ON r.pollutant_code = p.pollutant_key)"""


def dates_sql(source: str = "fct_staged") -> str:
    return f"""dates AS (
  SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, d AS date_day,
    CAST(year(d) AS INTEGER) AS year, CAST(quarter(d) AS INTEGER) AS quarter,
    CAST(month(d) AS INTEGER) AS month, rpad(monthname(d), 9, ' ') AS month_name,
    CAST(day(d) AS INTEGER) AS day_of_month, CAST(isodow(d) AS INTEGER) AS day_of_week,
    rpad(dayname(d), 9, ' ') AS day_name, CAST(week(d) AS INTEGER) AS iso_week,
    isodow(d) IN (5, 6) AS is_weekend
  FROM (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS d
    FROM (SELECT CAST(CAST(min(measured_at_local) AS DATE) AS TIMESTAMP) AS lo,
      CAST(CAST(max(measured_at_local) AS DATE) AS TIMESTAMP) AS hi FROM {source})))"""


def star_sql(plausible_max: str | None = None) -> str:
    return "WITH " + ",\n".join([sub_sql(), fold_sql(), pollutants_sql(plausible_max),
                                 fact_sql(), dates_sql()])


def mean_sql(total: str, n: str) -> str:
    """total / n rounded half up to six places, by whole numbers."""
    s, k = f"CAST(({total}) * 1000 AS HUGEINT)", f"CAST({n} AS HUGEINT)"
    return (f"CASE WHEN {n} > 0 THEN CAST(((2000 * {s} + {k}) // (2 * {k})) / 1000000.0 "
            f"AS DECIMAL(18,6)) END")


# --- Response documents ------------------------------------------------------

def _located(rows: DataFrame) -> DataFrame:
    return rows.withColumn("loc_no", F.substring("location_code", 5, 20).cast("long"))


def documents(spark: SparkSession, sf_dir: str, corrupt: bool = False) -> DataFrame:
    """A response per location, day and issue: 24 hours of each pollutant.

    Events with an even id make issue 0 of a day, those with an odd id issue
    1, so the second issue revises the first. With `corrupt`, most documents
    get one defect, chosen by their id.
    """
    known = _located(submissions(spark, sf_dir))
    day, issue = F.to_date("measured_at_utc").alias("day"), (F.col("response_id") % 2).alias("issue")
    cell = F.concat_ws("|", "pollutant_code", F.hour("measured_at_utc"))
    # Latest value per cell first: a document gathers 120 cells at most.
    cells = known.groupBy("location_code", "loc_no", day, issue, cell.alias("cell")).agg(
        F.max_by("value", "response_id").cast("double").alias("value"),
        F.max("ingested_at").alias("ingested_at"))
    docs = cells.groupBy("location_code", "loc_no", "day", "issue").agg(
        F.map_from_entries(F.collect_list(F.struct("cell", "value"))).alias("cells"),
        F.max("ingested_at").alias("ingested_at"))
    number = (F.col("loc_no") * 1000 + F.datediff("day", F.lit(FIRST_DAY)) * 2 + F.col("issue"))
    docs = docs.withColumn("response_id", number)
    payload = _corrupted_payload() if corrupt else _payload()
    return docs.select(
        "response_id", "location_code", "issue",
        F.concat_ws("/", F.lit("doc"), "location_code", F.col("day").cast("string"),
                    F.col("issue").cast("string")).alias("request_url"),
        F.lit("{}").alias("request_params"),
        F.col("day").alias("window_start"), F.col("day").alias("window_end"),
        F.lit(200).cast("smallint").alias("http_status"),
        payload.alias("payload"), "ingested_at",
    )


def _series(code: str, low: int = 0) -> Column:
    return F.transform(F.sequence(F.lit(low), F.lit(23)), lambda h: F.try_element_at(
        F.col("cells"), F.concat_ws("|", F.lit(code), h.cast("string"))))


def _times() -> Column:
    start = F.col("day").cast("timestamp")
    return F.transform(F.sequence(F.lit(0), F.lit(23)), lambda h: F.date_format(
        start + F.make_dt_interval(hours=h), "yyyy-MM-dd'T'HH:mm"))


def _units() -> dict[str, Column]:
    # Both spellings of the unit occur.
    spelled = F.when(F.col("issue") == 0, "μg/m³").otherwise("µg/m³")
    return {code: spelled for code in DOC_CODES}


def _json(offset: Column, units: dict[str, Column], times: Column,
          series: dict[str, Column]) -> Column:
    return F.to_json(F.struct(
        offset.alias("utc_offset_seconds"),
        F.struct(*[unit.alias(code) for code, unit in units.items()]).alias("hourly_units"),
        F.struct(times.alias("time"), *[s.alias(code) for code, s in series.items()])
        .alias("hourly"),
    ))


def _payload() -> Column:
    return _json(F.lit(0), _units(), _times(), {code: _series(code) for code in DOC_CODES})


DEFECTS = 12


def _corrupted_payload() -> Column:
    k = F.col("response_id") % DEFECTS
    nothing = F.lit(None)
    times = _times()
    repeated = F.concat(F.slice(times, 1, 1), F.slice(times, 1, 23))
    bad_text = F.concat(F.array(F.lit("24 o'clock")), F.slice(times, 2, 23))
    body = _json(
        F.when(k == 1, F.lit(7200)).when(k == 2, nothing).otherwise(F.lit(0)),
        {**_units(), "pm2_5": F.when(k == 6, "mg/m3").otherwise(_units()["pm2_5"]),
         "nitrogen_dioxide": F.when(k == 7, nothing).otherwise(_units()["nitrogen_dioxide"])},
        F.when(k == 3, F.slice(times, 1, 0)).when(k == 10, repeated).when(k == 11, bad_text)
        .otherwise(times),
        {"pm2_5": _series("pm2_5"),
         "pm10": F.when(k == 5, _series("pm10", 1)).otherwise(_series("pm10")),
         "nitrogen_dioxide": _series("nitrogen_dioxide"),
         "ozone": F.when(k == 4, nothing)
         .when(k == 9, F.concat(F.array(F.lit(1e8)), F.slice(_series("ozone"), 2, 23)))
         .otherwise(_series("ozone")),
         OTHER: _series(OTHER)},
    )
    return F.when(k == 8, F.substring(body, 1, 200)).otherwise(body)


DOCS_SQL = """known AS (
  SELECT *, CAST(substr(location_code, 5) AS BIGINT) AS loc_no,
    CAST(measured_at_utc AS DATE) AS day, response_id % 2 AS issue,
    hour(measured_at_utc) AS h FROM sub),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY location_code, day, issue, h, pollutant_code
    ORDER BY response_id DESC) AS back FROM known),
docs AS (
  SELECT location_code, day, issue, max(ingested_at) AS ingested_at,
    loc_no * 1000 + date_diff('day', DATE '2024-01-01', day) * 2 + issue AS doc_id,
    'doc/' || location_code || '/' || strftime(day, '%Y-%m-%d') || '/'
      || CAST(issue AS VARCHAR) AS request_url
  FROM known GROUP BY location_code, loc_no, day, issue),
cells AS (
  SELECT d.doc_id, d.location_code, d.issue, d.ingested_at, d.request_url, c.pollutant_code,
    CAST(d.day AS TIMESTAMP) + g.h * INTERVAL 1 HOUR AS measured_at_utc, r.value,
    'ug/m3' AS unit
  FROM docs d
  CROSS JOIN (SELECT unnest(range(24)) AS h) g
  CROSS JOIN (SELECT unnest(['pm2_5', 'pm10', 'nitrogen_dioxide', 'ozone', 'unknown'])
    AS pollutant_code) c
  LEFT JOIN ranked r ON r.back = 1 AND r.location_code = d.location_code AND r.day = d.day
    AND r.issue = d.issue AND r.h = g.h AND r.pollutant_code = c.pollutant_code)"""


def envelopes(docs: DataFrame, *extra: str) -> DataFrame:
    """Documents the way a fetcher leaves them."""
    return docs.select(
        *extra,
        F.col("request_url").alias("document"), "location_code", "request_url",
        "request_params", "window_start", "window_end", "http_status",
        F.col("ingested_at").alias("fetched_at"), F.col("payload").cast("binary").alias("body"))


# --- Tables of a run of its own ----------------------------------------------

def scratch_warehouse(spark: SparkSession) -> Warehouse:
    """An empty set of tables in the shared folder, under a name of its own."""
    tag = uuid.uuid4().hex[:12]
    warehouse = Warehouse(spark, f"{shared_dir(prepare(spark))}/run_{tag}", f"run_{tag}_").create()
    store_reference(warehouse, document_reference(spark))
    return warehouse
