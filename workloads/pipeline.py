"""Queries on documents and on tables: parse, guards, ingest, increments, stream."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourly_star.operators.parse import (
    dropped_forecast, parse_responses, readings, rejected,
)
from hourly_star.operators.calendars import store_calendars
from hourly_star.operators.incremental import merge
from hourly_star.plans.daily import daily_run
from hourly_star.plans.ingest import dry_run, ingest, rebuild, replay
from hourly_star.plans.star import build_star, fact, staged_readings, with_lineage
from hourly_star.schemas import FACT, FACT_KEY
from hourly_star.sources.landing import ENVELOPE, land
from hourly_star.sources.tables import Warehouse
from hourly_star.streaming.upsert_stream import envelope_stream, start_upserts
from workloads.star import star_checks_sql
from workloads.mapping import (
    DEFECTS, DOC_CODES, DOC_UNITS, DOCS_SQL, KEYS, documents, dates_sql, envelopes, fact_sql, fold_sql,
    plain, pollutants_sql, scratch_warehouse, sub_sql,
)

# Batches of documents: first issues, second issues, first issues again.
BATCHES = (0, 1, 0)
FIRST_RUN = datetime(2030, 1, 1)

FAR = "2999-01-01 00:00:00"


def _times(batch: int) -> datetime:
    return FIRST_RUN + timedelta(days=batch)


def parsed_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = parse_responses(documents(spark, sf_dir), DOC_CODES, DOC_UNITS,
                             as_of=F.lit(FAR).cast("timestamp"))
    return plain(readings(parsed))


def parse_forecast_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hours after the last event of a document are forecasts."""
    return dropped_forecast(parse_responses(documents(spark, sf_dir), DOC_CODES, DOC_UNITS))


def guard_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rejected(parse_responses(documents(spark, sf_dir, corrupt=True), DOC_CODES, DOC_UNITS,
                                    as_of=F.lit(FAR).cast("timestamp")))


def dry_run_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = dry_run(envelopes(documents(spark, sf_dir, corrupt=True)), DOC_CODES,
                     datetime(2024, 1, 20, 9))
    return counts.groupBy("location_code", "guard_error").agg(
        F.count(F.lit(1)).alias("n_documents"), F.sum("submitted").alias("submitted"),
        F.sum("dropped_future").alias("dropped_future"))


def _fetched(spark: SparkSession, sf_dir: str, warehouse: Warehouse) -> dict[int, DataFrame]:
    """Documents as files a fetcher left, one folder per issue."""
    docs, folder = documents(spark, sf_dir), f"{warehouse.root}/fetched"
    envelopes(docs, "issue").write.partitionBy("issue").parquet(folder)
    return {issue: spark.read.schema(ENVELOPE).parquet(f"{folder}/issue={issue}")
            for issue in set(BATCHES)}


def _state(warehouse: Warehouse) -> DataFrame:
    rows = with_lineage(warehouse.read("hourly_readings"), warehouse.read("responses"))
    return plain(rows.select(*KEYS.split(", "), "value", "unit", "request_url",
                             "first_loaded_at", "loaded_at"))


def upsert_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three batches through landing, parse and upsert, with the tables read back."""
    warehouse = scratch_warehouse(spark)
    docs = _fetched(spark, sf_dir, warehouse)
    for i, issue in enumerate(BATCHES):
        ingest(warehouse, docs[issue], _times(i))
    return _state(warehouse)


def raw_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same state rebuilt from the raw log in one job."""
    warehouse = scratch_warehouse(spark)
    docs = _fetched(spark, sf_dir, warehouse)
    for i, issue in enumerate(BATCHES):
        land(warehouse, docs[issue], _times(i))
    rebuilt = replay(warehouse.read("responses"), DOC_UNITS)
    rows = with_lineage(rebuilt, warehouse.read("responses"))
    return plain(rows.select(*KEYS.split(", "), "value", "unit", "request_url",
                             "first_loaded_at", "loaded_at"))


def run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The counters the three runs report."""
    warehouse = scratch_warehouse(spark)
    docs = _fetched(spark, sf_dir, warehouse)
    rows = [(i, *ingest(warehouse, docs[issue], _times(i)))
            for i, issue in enumerate(BATCHES)]
    return spark.createDataFrame(
        rows, "run int, windows long, submitted long, inserted long, changed long, "
              "unchanged long, dropped_future long, rejected long")


def fct_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact brought up to date after each batch."""
    warehouse = scratch_warehouse(spark)
    docs = _fetched(spark, sf_dir, warehouse)
    for i, issue in enumerate(BATCHES):
        ingest(warehouse, docs[issue], _times(i))
        build_star(warehouse)
    rows = with_lineage(warehouse.read("fct_hourly_readings").drop("utc_date"), warehouse.read("responses"))
    return plain(rows.select(*[f.name for f in FACT if f.name not in ("source_response_id", "utc_date")],
                             "request_url"))


def increment_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each increment of the fact read and wrote, by the notes of its run."""
    warehouse = scratch_warehouse(spark)
    docs = _fetched(spark, sf_dir, warehouse)
    for i, issue in enumerate(BATCHES):
        ingest(warehouse, docs[issue], _times(i))
        build_star(warehouse)
    return warehouse.read("star_runs").select("seq", "days", "rows_read", "rows_written")


def fct_schema_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The model gains a column after the first increment."""
    warehouse = scratch_warehouse(spark)
    docs = _fetched(spark, sf_dir, warehouse)
    for i, issue in enumerate(BATCHES):
        ingest(warehouse, docs[issue], _times(i))
        if i == 0:
            build_star(warehouse)
            continue
        changed = warehouse.read("hourly_readings").filter(
            F.col("loaded_at") >= F.lit(str(_times(i))).cast("timestamp"))
        batch = fact(staged_readings(changed), warehouse.read("dim_pollutant")).withColumn(
            "is_high", F.col("concentration") > 50).withColumn(
            "utc_date", F.to_date("measured_at_utc"))
        merge(warehouse, "fct_hourly_readings", batch, list(FACT_KEY))
    return plain(warehouse.read("fct_hourly_readings").select(
        "reading_key", "concentration", "is_high", "source_loaded_at"))


# Calendars of locations by the remainder of their number by 3; those of 2 keep the common one.
# The second zone of 0 starts within an hour of a day that has readings before and after.
MOVES = "2024-01-15 11:30:00"
CALENDARS = [(0, None, "Asia/Tokyo", [6, 7]), (0, MOVES, "America/New_York", [5, 6]),
             (1, MOVES, "Asia/Kolkata", [7])]


def star_by_location(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Locations on clocks of their own, one of which is set to another zone between two increments."""
    warehouse = scratch_warehouse(spark)
    docs = _fetched(spark, sf_dir, warehouse)
    codes = docs[0].union(docs[1]).select("location_code").distinct().withColumn(
        "kind", F.substring("location_code", 5, 20).cast("long") % 3)
    rules = spark.createDataFrame(CALENDARS, "kind long, valid_from string, time_zone string, weekend_days array<int>")
    calendars = codes.join(rules, "kind").withColumn("valid_from", F.col("valid_from").cast("timestamp"))
    for i, issue in enumerate(BATCHES):
        ingest(warehouse, docs[issue], _times(i))
        if i == 0:
            store_calendars(warehouse, calendars.filter("valid_from IS NULL"))
        if i == 2:
            build_star(warehouse)  # before the move is known
            store_calendars(warehouse, calendars.filter("valid_from IS NOT NULL"))
        build_star(warehouse)
    return plain(warehouse.read("fct_hourly_readings").select(
        "reading_key", "date_key", "location_code", "measured_at_local", "hour_of_day_local", "concentration",
        "is_weekend_local"))


def land_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of three batches: no gaps, in the order of arrival."""
    warehouse = scratch_warehouse(spark)
    docs = _fetched(spark, sf_dir, warehouse)
    for i, issue in enumerate(BATCHES):
        land(warehouse, docs[issue], _times(i))
    return plain(warehouse.read("responses").select("response_id", "document", "ingested_at"))


def stream_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The batches as files in a landing folder, taken up by a stream."""
    warehouse = scratch_warehouse(spark)
    docs = _fetched(spark, sf_dir, warehouse)
    folder = f"{warehouse.root}/landing"
    for i, issue in enumerate(BATCHES):
        docs[issue].write.mode("append").parquet(folder)
        query = start_upserts(warehouse, envelope_stream(spark, folder),
                              f"{warehouse.root}/progress", clock=_times)
        query.awaitTermination()
    return _state(warehouse)


def daily_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three daily runs; the checks as of the last one."""
    warehouse = scratch_warehouse(spark)
    docs = _fetched(spark, sf_dir, warehouse)
    for i, issue in enumerate(BATCHES):
        _, results = daily_run(warehouse, docs[issue], _times(i))
    return results


def _with_defects(spark: SparkSession, sf_dir: str) -> Warehouse:
    """Tables after one batch of all documents, most of them with a defect."""
    warehouse = scratch_warehouse(spark)
    ingest(warehouse, envelopes(documents(spark, sf_dir, corrupt=True)), _times(0), strict=False)
    return warehouse


def ingest_with_refusals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a batch that is not strict left out, and why."""
    return _with_defects(spark, sf_dir).read("refusals").select("document", "location_code", "reason")


def rebuild_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The readings table written anew from the raw log, refused documents among it."""
    warehouse = _with_defects(spark, sf_dir)
    rebuild(warehouse)
    return plain(warehouse.read("hourly_readings").select(*KEYS.split(", "), "value", "unit"))


def land_repeated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch name that comes again with more documents: each is landed once."""
    warehouse = scratch_warehouse(spark)
    docs = _fetched(spark, sf_dir, warehouse)
    land(warehouse, docs[0], _times(0), "again")
    land(warehouse, docs[0].union(docs[1]), _times(1), "again")
    stored = land(warehouse, docs[1], _times(2), "again")
    return plain(stored.select("document", "location_code", "request_url", "ingested_at"))


QUERIES = {f.__name__: f for f in (
    ingest_with_refusals, rebuild_tables, land_repeated,
    daily_checks, parse_forecast_drop, guard_violations, dry_run_counts, upsert_tables, raw_replay, run_summary,
    fct_incremental, increment_profile, fct_schema_append, star_by_location, land_ids, stream_upsert,
)}
QUERIES["parse_responses"] = parsed_responses

_DOCS = f"WITH {sub_sql()}, {DOCS_SQL}"


def _runs_sql(batches=BATCHES) -> str:
    """Submissions of the batches in order of arrival."""
    parts = " UNION ALL ".join(
        f"SELECT location_code, pollutant_code, measured_at_utc, value, unit, request_url, "
        f"CAST({i} AS BIGINT) * 1000000000 + doc_id AS response_id, "
        f"TIMESTAMP '{_times(i)}' AS ingested_at FROM cells WHERE issue = {issue}"
        for i, issue in enumerate(batches))
    return f"{_DOCS}, runs AS ({parts}), {fold_sql('runs', 'folded')}"


_STATE_SQL = f"""{_runs_sql()} SELECT f.location_code, f.pollutant_code, f.measured_at_utc, f.value,
    f.unit, d.request_url, f.first_loaded_at, f.loaded_at
    FROM folded f JOIN docs d ON d.doc_id = f.source_response_id % 1000000000"""

_ALL = f"{_runs_sql()}, {pollutants_sql(documents=True)}, {fact_sql()}, {dates_sql()}"

_REASONS = " ".join(f"WHEN {k} THEN '{reason}'" for k, reason in (
    (1, "utc_offset"), (2, "utc_offset"), (3, "no_time_axis"), (4, "missing:ozone"),
    (5, "length:pm10"), (6, "unknown_unit:pm2_5"), (7, "unknown_unit:nitrogen_dioxide"),
    (8, "malformed"), (9, "overflow:ozone"), (10, "duplicate_time"), (11, "malformed_time")))
_REASON = f"CASE doc_id % {DEFECTS} {_REASONS} END"

ORACLES = {
    "daily_checks": star_checks_sql(_ALL, str(_times(2))),
    "parse_responses": f"""{_DOCS} SELECT doc_id AS response_id, location_code, pollutant_code,
        measured_at_utc, value, unit, ingested_at FROM cells""",
    "parse_forecast_drop": f"""{_DOCS} SELECT doc_id AS response_id, location_code,
        count(*) FILTER (measured_at_utc <= ingested_at) AS submitted,
        count(*) FILTER (measured_at_utc > ingested_at) AS dropped_future FROM cells GROUP BY ALL""",
    "guard_violations": f"""{_DOCS}, r AS (SELECT doc_id AS response_id, location_code,
        {_REASON} AS guard_error FROM docs) SELECT * FROM r WHERE guard_error IS NOT NULL""",
    # A repeated hour is an error only if it is loaded, so days after the
    # given time pass that guard; their hours are all dropped.
    "dry_run_counts": f"""{_DOCS}, reasons AS (SELECT doc_id, location_code, CASE
          WHEN doc_id % {DEFECTS} = 10 AND day > DATE '2024-01-20' THEN NULL
          ELSE {_REASON} END AS guard_error FROM docs),
        n AS (SELECT doc_id,
          count(*) FILTER (measured_at_utc <= TIMESTAMP '2024-01-20 09:00:00') AS ok,
          count(*) FILTER (measured_at_utc > TIMESTAMP '2024-01-20 09:00:00') AS later
          FROM cells GROUP BY 1)
        SELECT location_code, guard_error, count(*) AS n_documents,
          CAST(sum(CASE WHEN guard_error IS NULL THEN ok ELSE 0 END) AS BIGINT) AS submitted,
          CAST(sum(CASE WHEN guard_error IS NULL THEN later ELSE 0 END) AS BIGINT)
            AS dropped_future
        FROM reasons JOIN n USING (doc_id) GROUP BY location_code, guard_error""",
    "ingest_with_refusals": f"""{_DOCS}, r AS (SELECT request_url AS document, location_code,
        {_REASON} AS reason FROM docs) SELECT * FROM r WHERE reason IS NOT NULL""",
    # Ids follow the time of fetching, so the last document wins.
    "rebuild_tables": f"""{_DOCS}, good AS (SELECT * FROM cells WHERE {_REASON} IS NULL),
        last AS (SELECT *, row_number() OVER (
          PARTITION BY location_code, pollutant_code, measured_at_utc
          ORDER BY ingested_at DESC, request_url DESC) AS back FROM good)
        SELECT location_code, pollutant_code, measured_at_utc, value, unit FROM last WHERE back = 1""",
    "land_repeated": f"""{_DOCS} SELECT request_url AS document, location_code, request_url,
        CASE issue WHEN 0 THEN TIMESTAMP '{_times(0)}' ELSE TIMESTAMP '{_times(1)}' END AS ingested_at
        FROM docs""",
    "upsert_tables": _STATE_SQL,
    "raw_replay": _STATE_SQL,
    "stream_upsert": _STATE_SQL,
    "run_summary": f"""{_runs_sql()} SELECT CAST(response_id // 1000000000 AS INTEGER) AS run,
        count(DISTINCT response_id) AS windows, count(*) AS submitted,
        count(*) FILTER (action = 'I') AS inserted, count(*) FILTER (action = 'U') AS changed,
        count(*) FILTER (action = 'N') AS unchanged, CAST(0 AS BIGINT) AS dropped_future,
        CAST(0 AS BIGINT) AS rejected FROM folded_log GROUP BY 1""",
    "fct_incremental": f"""{_ALL} SELECT f.* EXCLUDE (source_response_id), d.request_url
        FROM fct f JOIN docs d ON d.doc_id = f.source_response_id % 1000000000""",
    # a batch submits a reading once, so what it inserts or changes is what an increment has to read
    "increment_profile": f"""{_runs_sql()} SELECT response_id // 1000000000 + 1 AS seq,
        count(DISTINCT CAST(measured_at_utc AS DATE)) AS days, count(*) AS rows_read, count(*) AS rows_written
        FROM folded_log WHERE action <> 'N' GROUP BY 1""",
    "star_by_location": f"""{_runs_sql()}, {pollutants_sql(documents=True)},
        placed AS (SELECT *, CAST(substr(location_code, 5) AS BIGINT) % 3 AS kind,
          measured_at_utc >= TIMESTAMP '{MOVES}' AS moved FROM folded),
        local AS (SELECT *, (measured_at_utc AT TIME ZONE 'UTC') AT TIME ZONE
            CASE WHEN kind = 0 AND NOT moved THEN 'Asia/Tokyo' WHEN kind = 0 THEN 'America/New_York'
            WHEN kind = 1 AND moved THEN 'Asia/Kolkata' ELSE 'Africa/Cairo' END AS t FROM placed)
        SELECT md5(location_code || '|' || pollutant_code || '|'
            || strftime(measured_at_utc, '%Y-%m-%d %H:%M:%S')) AS reading_key,
          CAST(strftime(t, '%Y%m%d') AS INTEGER) AS date_key, location_code, t AS measured_at_local,
          CAST(hour(t) AS INTEGER) AS hour_of_day_local, value AS concentration,
          CASE WHEN kind = 0 AND NOT moved THEN isodow(t) IN (6, 7) WHEN kind = 1 AND moved THEN isodow(t) = 7
            ELSE isodow(t) IN (5, 6) END AS is_weekend_local
        FROM local JOIN pollutants ON pollutant_code = pollutant_key""",
    "land_ids": f"""{_DOCS}, runs AS (SELECT * FROM docs JOIN (VALUES
          (0, 0, TIMESTAMP '{_times(0)}'), (1, 1, TIMESTAMP '{_times(1)}'), (2, 0, TIMESTAMP '{_times(2)}'))
          AS b(batch, of_issue, landed) ON issue = of_issue)
        SELECT row_number() OVER (ORDER BY batch, ingested_at, request_url) AS response_id,
          request_url AS document, landed AS ingested_at FROM runs""",
    "fct_schema_append": f"""{_ALL} SELECT reading_key, concentration,
        CASE WHEN source_loaded_at >= TIMESTAMP '{_times(1)}' THEN concentration > 50 END
          AS is_high, source_loaded_at FROM fct""",
}
