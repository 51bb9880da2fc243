"""Queries on submissions: fold, upsert, staging view, constraints, plans, digests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourly_star.operators.constraints import (
    duplicates, nonnegative, on_grid, references, required, violations,
)
from hourly_star.operators.revisions import fold, revised, revision_log
from hourly_star.operators.upsert import counters, merge_actions, upserted
from hourly_star.plans.reports import pull_novelty
from hourly_star.plans.star import staged_readings, with_lineage
from hourly_star.sources.fixture import seeded_readings
from hourly_star.sources.landing import covering, digest_counts, newest_first
from hourly_star.sources.windows import lookback, request_plan, split_windows
from workloads.mapping import (
    CODES, DOCS_SQL, KEYS, documents, fold_sql, plain, reference_rows, sub_sql, submissions, table,
)

MIDDLE = "2024-01-15"
STATE = f"{KEYS}, value, unit, source_response_id, first_loaded_at, loaded_at"

SUB, COARSE = sub_sql(), sub_sql(coarse=True)


def revision_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(fold(submissions(spark, sf_dir, coarse=True)))


def revised_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(revised(fold(submissions(spark, sf_dir, coarse=True))))


def revision_actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(revision_log(submissions(spark, sf_dir, coarse=True)))


def _target_and_batch(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Odd submissions are in the table already, even ones (later ids) arrive."""
    rows = submissions(spark, sf_dir, coarse=True)
    odd = F.col("response_id") % 2 == 1
    later = rows.filter(~odd).withColumn("response_id", F.col("response_id") + 1_000_000_000)
    return fold(rows.filter(odd)), later


def upsert_actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    target, batch = _target_and_batch(spark, sf_dir)
    return plain(merge_actions(target, batch).drop("n_repeated"))


def upsert_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    target, batch = _target_and_batch(spark, sf_dir)
    return counters(merge_actions(target, batch)).drop("repeated")


def upsert_result(spark: SparkSession, sf_dir: str) -> DataFrame:
    target, batch = _target_and_batch(spark, sf_dir)
    return plain(upserted(target, batch))


def upsert_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run totals per day of arrival (one window each), from the log of actions."""
    target, batch = _target_and_batch(spark, sf_dir)
    log = revision_log(batch, target)
    return log.groupBy(F.to_date("ingested_at").alias("window_start")).agg(
        F.count(F.lit(1)).alias("submitted"),
        F.count_if(F.col("action") == "I").alias("inserted"),
        F.count_if(F.col("action") == "U").alias("changed"),
        F.count_if(F.col("action") == "N").alias("unchanged"))


def stg_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(staged_readings(fold(submissions(spark, sf_dir))))


def constraint_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values lowered by five and exact event times break the rules."""
    rows = submissions(spark, sf_dir).withColumn("value", F.col("value") - F.lit(5)) \
        .withColumn("measured_at_utc", F.when(F.col("response_id") % 3 == 0, F.col("ingested_at"))
                    .otherwise(F.col("measured_at_utc"))) \
        .withColumn("unit", F.when(F.col("response_id") % 7 != 0, F.col("unit")))
    rules = [*required("unit"), nonnegative("value"), on_grid("measured_at_utc")]
    return violations(rows, rules).select("response_id", "violation")


def constraint_references(spark: SparkSession, sf_dir: str) -> DataFrame:
    return references(submissions(spark, sf_dir), "pollutant_code", reference_rows(spark),
                      "pollutant_code")


def constraint_response_reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings whose response is not in the raw log (every fifth was lost)."""
    rows = submissions(spark, sf_dir)
    held = rows.filter(F.col("response_id") % 5 != 0).select("response_id")
    return references(rows, "response_id", held, "response_id")


def constraint_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(duplicates(submissions(spark, sf_dir), KEYS.split(", ")))


def lineage_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    responses = events.select(
        F.col("event_id").alias("response_id"),
        F.concat(F.lit("event/"), F.col("event_id").cast("string")).alias("request_url"),
        F.sha2("props", 256).alias("payload_sha256"),
        F.col("ts").cast("timestamp").alias("ingested_at"))
    return plain(with_lineage(fold(submissions(spark, sf_dir)), responses))


def fixture_seed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """72 hours up to the newest event of each user."""
    users = table(spark, sf_dir, "events").groupBy("user_id").agg(
        F.max(F.col("ts").cast("timestamp")).alias("now"), F.max("event_id").alias("response_id"))
    locations = users.select(
        F.concat(F.lit("user_"), F.col("user_id").cast("string")).alias("location_code"),
        "now", "response_id")
    return plain(seeded_readings(locations, reference_rows(spark)))


def _locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    users = table(spark, sf_dir, "events").groupBy("user_id").agg(
        F.min("ts").cast("date").alias("start"), F.max("ts").cast("date").alias("end"))
    return users.select(
        F.concat(F.lit("user_"), F.col("user_id").cast("string")).alias("location_code"),
        (F.col("user_id") % 90).cast("double").alias("latitude"),
        (F.col("user_id") % 180).cast("double").alias("longitude"),
        (F.col("user_id") % 9 + 1).cast("int").alias("lookback_days"),
        "start", "end")


def window_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    windows = split_windows(_locations(spark, sf_dir), 7)
    return request_plan(windows, CODES, "https://example.invalid/hourly")


def lookback_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The next scheduled run of each location, as of its newest event."""
    at = _locations(spark, sf_dir).withColumnRenamed("end", "as_of").drop("start")
    return lookback(at, F.col("as_of")).select("location_code", "start", "end")


def raw_digest_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    bodies = table(spark, sf_dir, "documents").select(
        F.sha2(F.col("text").cast("binary"), 256).alias("payload_sha256"))
    return digest_counts(bodies)


def raw_window_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    windows = split_windows(_locations(spark, sf_dir), 7)
    return covering(windows, F.lit(MIDDLE).cast("date")).select(
        "location_code", "window_start", "window_end")


def raw_newest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(newest_first(documents(spark, sf_dir), 25)
                 .select("response_id", "request_url", "ingested_at"))


def novelty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bodies are the events' properties, which repeat."""
    rows = submissions(spark, sf_dir, coarse=True)
    bodies = table(spark, sf_dir, "events").select(
        F.concat(F.lit("loc_"), F.expr("user_id div 25").cast("string")).alias("location_code"),
        F.sha2("props", 256).alias("payload_sha256"))
    return pull_novelty(bodies, revision_log(rows))


QUERIES = {f.__name__: f for f in (
    revision_fold, revised_readings, revision_actions, upsert_actions, upsert_counters,
    upsert_result, upsert_log, stg_readings, constraint_violations, constraint_references,
    constraint_response_reference, constraint_duplicates, lineage_join, fixture_seed,
    window_plan, lookback_plan, raw_digest_profile, raw_window_lookup, raw_newest,
)}
QUERIES["pull_novelty"] = novelty

_ODD = """odd AS (SELECT * FROM sub WHERE response_id % 2 = 1),
late AS (SELECT * FROM (SELECT * REPLACE (response_id + 1000000000 AS response_id)
  FROM sub WHERE response_id % 2 = 0))"""

# One sequence: what is in the table first, what arrives after it.
_BOTH = f"""WITH {COARSE}, {_ODD},
seq AS (SELECT * FROM odd UNION ALL SELECT * FROM late),
{fold_sql('seq', 'whole')}"""

_LOCATIONS = """loc AS (
  SELECT 'user_' || CAST(user_id AS VARCHAR) AS location_code,
    CAST(user_id % 90 AS DOUBLE) AS latitude, CAST(user_id % 180 AS DOUBLE) AS longitude,
    CAST(user_id % 9 + 1 AS INTEGER) AS lookback_days,
    CAST(min(ts) AS DATE) AS lo, CAST(max(ts) AS DATE) AS hi
  FROM events GROUP BY user_id),
win AS (
  SELECT *, least(window_start + 6, hi) AS window_end FROM (
    SELECT *, CAST(unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP),
      INTERVAL 7 DAY)) AS DATE) AS window_start FROM loc))"""

ORACLES = {
    "revision_fold": f"WITH {COARSE}, {fold_sql()} SELECT {STATE} FROM folded",
    "revised_readings": f"""WITH {COARSE}, {fold_sql()} SELECT {STATE} FROM folded
        WHERE loaded_at > first_loaded_at""",
    "revision_actions": f"""WITH {COARSE}, {fold_sql()}
        SELECT {KEYS}, response_id, ingested_at, value, unit, action FROM folded_log""",
    "upsert_actions": f"""{_BOTH},
        arrived AS (SELECT {KEYS}, count(*) AS n_submitted,
          CAST(sum(CASE WHEN action = 'U' THEN 1 ELSE 0 END) AS BIGINT) AS n_updates,
          max(CASE WHEN action = 'I' THEN 1 ELSE 0 END) AS is_new
          FROM whole_log WHERE response_id >= 1000000000 GROUP BY {KEYS})
        SELECT {STATE}, n_submitted, a.n_updates,
          CASE WHEN is_new = 1 THEN 'I' WHEN a.n_updates > 0 THEN 'U' ELSE 'N' END AS action
        FROM whole w JOIN arrived a USING ({KEYS})""",
    "upsert_counters": f"""{_BOTH}
        SELECT count(*) AS submitted, count(*) FILTER (action = 'I') AS inserted,
          count(*) FILTER (action = 'U') AS changed, count(*) FILTER (action = 'N') AS unchanged
        FROM whole_log WHERE response_id >= 1000000000""",
    "upsert_result": f"{_BOTH} SELECT {STATE} FROM whole",
    "upsert_log": f"""{_BOTH}
        SELECT CAST(ingested_at AS DATE) AS window_start, count(*) AS submitted,
          count(*) FILTER (action = 'I') AS inserted, count(*) FILTER (action = 'U') AS changed,
          count(*) FILTER (action = 'N') AS unchanged
        FROM whole_log WHERE response_id >= 1000000000 GROUP BY ALL""",
    "stg_readings": f"""WITH {SUB}, {fold_sql()}
        SELECT {KEYS}, (measured_at_utc AT TIME ZONE 'UTC') AT TIME ZONE 'Africa/Cairo'
          AS measured_at_local, value AS concentration, unit, source_response_id,
          first_loaded_at, loaded_at FROM folded""",
    "constraint_violations": f"""WITH {SUB},
        bad AS (SELECT response_id, CASE WHEN response_id % 7 = 0 THEN 'required:unit'
            WHEN value - 5 < 0 THEN 'nonnegative:value'
            WHEN response_id % 3 = 0 AND date_trunc('hour', ingested_at) <> ingested_at
              THEN 'on_hour:measured_at_utc' END AS violation FROM sub)
        SELECT * FROM bad WHERE violation IS NOT NULL""",
    "constraint_references": f"""WITH {SUB} SELECT pollutant_code AS missing_value,
        count(*) AS offending FROM sub WHERE pollutant_code = 'unknown' GROUP BY 1""",
    "constraint_response_reference": """SELECT event_id AS missing_value, count(*) AS offending
        FROM events WHERE event_id % 5 = 0 GROUP BY 1""",
    "constraint_duplicates": f"""WITH {SUB} SELECT {KEYS}, count(*) AS copies FROM sub
        GROUP BY ALL HAVING count(*) > 1""",
    "lineage_join": f"""WITH {SUB}, {fold_sql()} SELECT {STATE},
        'event/' || CAST(event_id AS VARCHAR) AS request_url, sha256(props) AS payload_sha256,
        ts AS ingested_at FROM folded JOIN (SELECT event_id, ts, props FROM events)
          ON source_response_id = event_id""",
    "fixture_seed": """WITH users AS (SELECT user_id, date_trunc('hour', max(ts)) AS last,
            max(event_id) AS response_id FROM events GROUP BY user_id),
        slots AS (SELECT *, unnest(generate_series(last - INTERVAL 71 HOUR, last,
            INTERVAL 1 HOUR)) AS measured_at_utc FROM users)
        SELECT 'user_' || CAST(user_id AS VARCHAR) AS location_code, p.code AS pollutant_code,
          measured_at_utc, CASE WHEN hour(measured_at_utc) <> 4 THEN CAST(round(25
            + 10 * sin(epoch(measured_at_utc) / 7200.0) + p.n * 6, 3) AS DECIMAL(10,3)) END AS value,
          'ug/m3' AS unit, response_id AS source_response_id
        FROM slots CROSS JOIN (VALUES ('pm2_5', 1), ('pm10', 2), ('nitrogen_dioxide', 3),
          ('ozone', 4)) AS p(code, n)""",
    "window_plan": f"""WITH {_LOCATIONS}
        SELECT location_code, window_start, window_end,
          '{{"latitude":' || CAST(latitude AS VARCHAR) || ',"longitude":'
          || CAST(longitude AS VARCHAR)
          || ',"hourly":"pm2_5,pm10,nitrogen_dioxide,ozone","start_date":"'
          || strftime(window_start, '%Y-%m-%d') || '","end_date":"'
          || strftime(window_end, '%Y-%m-%d') || '","timezone":"UTC"}}' AS request_params,
          'https://example.invalid/hourly?latitude=' || CAST(latitude AS VARCHAR)
          || '&longitude=' || CAST(longitude AS VARCHAR)
          || '&hourly=pm2_5%2Cpm10%2Cnitrogen_dioxide%2Cozone&start_date='
          || strftime(window_start, '%Y-%m-%d') || '&end_date='
          || strftime(window_end, '%Y-%m-%d') || '&timezone=UTC' AS request_url FROM win""",
    "lookback_plan": f"""WITH {_LOCATIONS} SELECT location_code,
        hi - (lookback_days - 1) AS start, hi AS "end" FROM loc""",
    "raw_digest_profile": """SELECT sha256(text) AS payload_sha256, count(*) AS copies
        FROM documents GROUP BY 1""",
    "raw_window_lookup": f"""WITH {_LOCATIONS} SELECT location_code, window_start, window_end
        FROM win WHERE window_start <= DATE '{MIDDLE}' AND window_end >= DATE '{MIDDLE}'""",
    "raw_newest": f"""WITH {SUB}, {DOCS_SQL} SELECT doc_id AS response_id, request_url, ingested_at
        FROM docs ORDER BY ingested_at DESC, doc_id DESC LIMIT 25""",
    "pull_novelty": f"""WITH {COARSE}, {fold_sql()},
        bodies AS (SELECT 'loc_' || CAST(user_id // 25 AS VARCHAR) AS location_code,
          count(*) AS n_responses, count(*) - count(DISTINCT props) AS n_repeated_bodies
          FROM events GROUP BY 1),
        acts AS (SELECT location_code, count(*) AS submitted,
          count(*) FILTER (action = 'I') AS inserted, count(*) FILTER (action = 'U') AS changed
          FROM folded_log GROUP BY 1)
        SELECT *, CAST(((2000000 * (submitted - inserted - changed) + submitted)
          // (2 * submitted)) / 1000000.0 AS DECIMAL(18,6)) AS unchanged_share
        FROM bodies JOIN acts USING (location_code)""",
}
