"""Queries on the star schema: models, checks and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourly_star.operators import checks
from hourly_star.operators.incremental import drift
from hourly_star.operators.revisions import fold
from hourly_star.plans import reports
from hourly_star.plans.quality import check_star, declared_checks
from hourly_star.plans.star import dim_pollutant as pollutant_dimension
from hourly_star.plans.star import fact, staged_by_location
from hourly_star.schemas import CONCENTRATION
from hourly_star.sources.fixture import profile
from hourly_star.sources.reference import upserted
from workloads.mapping import (
    fold_sql, mean_sql, plain, pollutants_sql, reference_rows, star, star_sql, sub_sql, submissions, table,
)

# Reports on a bound that the given values do exceed.
BOUND = 300.0
LATER = "2024-02-03 00:00:00"
ZONES = ("Africa/Cairo", "Asia/Tokyo", "America/New_York")


def dim_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star(spark, sf_dir)["dim_date"]


def dim_pollutant(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reference rows upserted with the bounds the data reach."""
    old = reference_rows(spark)
    reached = submissions(spark, sf_dir).groupBy("pollutant_code").agg(
        F.max("value").alias("top"), F.count("value").alias("n"))
    edited = old.join(reached, "pollutant_code").filter(F.col("sort_order") <= 2).withColumn(
        "plausible_max", (F.col("top") + 1).cast(CONCENTRATION)).select(*old.columns)
    return pollutant_dimension(upserted(old, edited))


def fct_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(star(spark, sf_dir)["fct_hourly_readings"])


def drift_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a full rebuild changes after a guideline was edited."""
    tables = star(spark, sf_dir)
    edited = tables["dim_pollutant"].withColumn("who_guideline", F.when(
        F.col("pollutant_key") == "pm10", F.lit(20).cast(CONCENTRATION))
        .otherwise(F.col("who_guideline")))
    rebuilt = fact(tables["stg_hourly_readings"], edited)
    return plain(drift(rebuilt, tables["fct_hourly_readings"])).select(
        "reading_key", "exceeds_guideline", "side")


def load_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(profile(star(spark, sf_dir)["hourly_readings"]))


def daily_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.daily_mean(star(spark, sf_dir)["fct_hourly_readings"])


def weekend_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = star(spark, sf_dir)
    return reports.weekend_profile(tables["fct_hourly_readings"], tables["dim_date"])


def local_weekend(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Locations on three clocks with two kinds of weekend."""
    readings = fold(submissions(spark, sf_dir))
    number = F.substring("location_code", 5, 20).cast("long")
    zones = F.array(*[F.lit(z) for z in ZONES])
    locations = submissions(spark, sf_dir).select("location_code").distinct().select(
        "location_code", F.element_at(zones, (number % 3 + 1).cast("int")).alias("time_zone"),
        F.when(number % 2 == 0, F.array(F.lit(5), F.lit(6)))
        .otherwise(F.array(F.lit(6), F.lit(7))).alias("weekend_days"))
    return reports.local_weekend_profile(staged_by_location(readings, locations))


def gap_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = star(spark, sf_dir)
    return reports.gap_report(tables["fct_hourly_readings"], tables["dim_date"],
                              tables["dim_pollutant"])


def exceed_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.exceed_share(star(spark, sf_dir)["fct_hourly_readings"])


def rolling_guideline(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = star(spark, sf_dir)
    return plain(reports.rolling_guideline(tables["fct_hourly_readings"],
                                           tables["dim_pollutant"]))


def hour_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.hour_profile(star(spark, sf_dir)["fct_hourly_readings"])


def chk_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items, their return flag taken away where it is R."""
    lines = table(spark, sf_dir, "lineitem").withColumn(
        "l_returnflag", F.nullif(F.col("l_returnflag"), F.lit("R")))
    return checks.not_null(lines, "l_returnflag").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_quantity")


def chk_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.unique(table(spark, sf_dir, "lineitem"), "l_orderkey")


def chk_unique_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.unique(table(spark, sf_dir, "lineitem"), "l_partkey", "l_suppkey")


def chk_accepted_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.accepted_values(table(spark, sf_dir, "orders"), "o_orderpriority",
                                  ["1-URGENT", "2-HIGH", "3-MEDIUM"])


def chk_accepted_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.accepted_range(table(spark, sf_dir, "lineitem"), "l_quantity", 3, 45,
                                 inclusive=False)


def chk_relationships(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders against the customers with a positive balance only."""
    customers = table(spark, sf_dir, "customer").filter("c_acctbal > 0")
    return checks.relationships(table(spark, sf_dir, "orders"), "o_custkey", customers,
                                "c_custkey")


def chk_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Several checks on the large tables by the runner, row checks in one scan."""
    tables = {name: table(spark, sf_dir, name) for name in ("lineitem", "orders", "customer")}
    return checks.run_checks(tables, [
        checks.check_not_null("lineitem", "l_shipdate"),
        checks.check_accepted_values("lineitem", "l_linestatus", ["O"]),
        checks.check_accepted_range("lineitem", "l_discount", 0.0, 0.05),
        checks.check_accepted_range("lineitem", "l_extendedprice", low=1000.0),
        checks.check_accepted_values("orders", "o_orderstatus", ["F", "O"]),
        checks.check_unique("orders", "o_orderkey"),
        checks.check_unique("orders", "o_custkey"),
        checks.check_relationships("orders", "o_custkey", "customer", "c_custkey"),
        checks.check_relationships("lineitem", "l_orderkey", "orders", "o_orderkey"),
        checks.check_accepted_range("customer", "c_acctbal", low=0.0),
    ])


def chk_plausible_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = star(spark, sf_dir, BOUND)
    return plain(checks.above_plausible(tables["fct_hourly_readings"], tables["dim_pollutant"]))


def _staleness(spark: SparkSession, sf_dir: str, as_of: str) -> DataFrame:
    return checks.stale(star(spark, sf_dir)["fct_hourly_readings"], as_of)


def chk_recency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(_staleness(spark, sf_dir, LATER).select(
        "latest_reading_utc", _seconds("staleness").alias("staleness_seconds")))


def chk_source_freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    readings = star(spark, sf_dir)["hourly_readings"]
    parts = [checks.source_freshness(readings, "loaded_at", as_of).select(
        F.lit(as_of).alias("as_of"), "max_loaded_at", "status")
        for as_of in ("2024-01-31 12:00:00", "2024-02-01 12:00:00", LATER)]
    return plain(parts[0].unionByName(parts[1]).unionByName(parts[2]))


def _seconds(interval: str) -> F.Column:
    days, hours = F.extract(F.lit("DAY"), F.col(interval)), F.extract(F.lit("HOUR"), F.col(interval))
    minutes = F.extract(F.lit("MINUTE"), F.col(interval))
    return (days * 86400 + hours * 3600 + minutes * 60).cast("long")


def star_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The declared checks and source freshness, some of which fail here."""
    return check_star(star(spark, sf_dir, BOUND, stored=True), LATER)


QUERIES = {f.__name__: f for f in (
    dim_date, dim_pollutant, fct_readings, drift_report, load_profile, daily_mean,
    weekend_profile, local_weekend, gap_report, exceed_share, rolling_guideline, hour_profile, chk_not_null,
    chk_unique, chk_unique_columns, chk_accepted_values, chk_accepted_range, chk_relationships,
    chk_row_counts, chk_plausible_bounds, chk_recency, chk_source_freshness, star_checks,
)}

STAR = star_sql()
BOUNDED = star_sql(str(BOUND))

_MEAN = mean_sql("sum(concentration)", "count(concentration)")


def _rolling_sql() -> str:
    frames = "\n".join(
        f"""UNION ALL SELECT f.location_code, f.pollutant_key, f.measured_at_utc, f.concentration,
          CAST({h} AS INTEGER) AS averaging_hours, p.who_guideline,
          sum(concentration) OVER w AS total, count(concentration) OVER w AS n
        FROM fct f JOIN pollutants p USING (pollutant_key) WHERE p.who_averaging_hours = {h}
        WINDOW w AS (PARTITION BY f.location_code, f.pollutant_key ORDER BY f.measured_at_utc
          RANGE BETWEEN INTERVAL {h - 1} HOUR PRECEDING AND CURRENT ROW)"""
        for h in (8, 24))
    return f"""{STAR}, framed AS ({frames.removeprefix('UNION ALL ')}),
        means AS (SELECT *, {mean_sql('total', 'n')} AS rolling_mean FROM framed)
        SELECT location_code, pollutant_key, measured_at_utc, concentration, averaging_hours,
          rolling_mean, n AS n_known, rolling_mean > who_guideline AS above_guideline FROM means"""


def _check_sql(name: str, target: str, offending: str, severity: str = "error") -> str:
    return (f"SELECT '{name}' AS \"check\", '{target}' AS target, '{severity}' AS severity, "
            f"CAST(({offending}) AS BIGINT) AS offending")


def star_checks_sql(star_text: str, as_of: str) -> str:
    """Every declared check over the tables `star_text` defines."""
    tables = {"hourly_readings": "folded", "pollutants": "pollutant_rows",
              "stg_hourly_readings": "staged", "dim_date": "dates", "dim_pollutant": "pollutants",
              "fct_hourly_readings": "fct"}
    special = {
        "accepted_values_dim_date_day_of_week":
            "SELECT count(*) FROM dates WHERE day_of_week NOT IN (1, 2, 3, 4, 5, 6, 7)",
        "accepted_values_dim_pollutant_unit":
            "SELECT count(*) FROM pollutants WHERE unit NOT IN ('ug/m3')",
        "accepted_range_fct_hourly_readings_hour_of_day_local":
            "SELECT count(*) FROM fct WHERE hour_of_day_local NOT BETWEEN 0 AND 23",
        "accepted_range_fct_hourly_readings_concentration":
            "SELECT count(*) FROM fct WHERE concentration NOT BETWEEN 0 AND 10000",
        "concentration_within_pollutant_bounds":
            "SELECT count(*) FROM fct JOIN pollutants USING (pollutant_key) "
            "WHERE concentration > plausible_max",
        "readings_are_recent":
            f"SELECT CASE WHEN TIMESTAMP '{as_of}' - max(measured_at_utc) > INTERVAL 48 HOUR "
            "THEN 1 ELSE 0 END FROM fct",
    }
    parts = []
    for check in declared_checks(as_of):
        source = tables[check.table]
        column = check.name.split(check.table + "_", 1)[-1]
        if check.name in special:
            sql = special[check.name]
        elif check.name.startswith("not_null"):
            sql = f"SELECT count(*) FROM {source} WHERE {column} IS NULL"
        elif check.name.startswith("unique"):
            sql = (f"SELECT count(*) FROM (SELECT {column} FROM {source} WHERE {column} "
                   f"IS NOT NULL GROUP BY 1 HAVING count(*) > 1)")
        else:
            child, _, parent = column.partition("__")
            field = next(parent[len(t) + 1:] for t in tables if parent.startswith(t))
            to = tables[parent[: -len(field) - 1]]
            sql = (f"SELECT count(*) FROM {source} WHERE {child} IS NOT NULL "
                   f"AND {child} NOT IN (SELECT {field} FROM {to})")
        parts.append(_check_sql(check.name, check.table, sql))
    parts.append(_check_sql("source_freshness", "hourly_readings",
                            f"SELECT CASE WHEN TIMESTAMP '{as_of}' - max(loaded_at) > "
                            "INTERVAL 26 HOUR THEN 1 ELSE 0 END FROM folded"))
    union = " UNION ALL ".join(parts)
    return f"""{star_text},
        pollutant_rows AS (SELECT *, pollutant_key AS pollutant_code FROM pollutants),
        staged AS (SELECT * FROM fct_staged), results AS ({union})
        SELECT *, offending = 0 AS passed FROM results"""


ORACLES = {
    "dim_date": f"{STAR} SELECT * FROM dates",
    "dim_pollutant": f"""WITH {sub_sql()}, {pollutants_sql()},
        top AS (SELECT pollutant_code, max(value) AS top FROM sub GROUP BY 1)
        SELECT p.* REPLACE (CASE WHEN sort_order <= 2 AND top IS NOT NULL
          THEN CAST(top + 1 AS DECIMAL(10,3)) ELSE plausible_max END AS plausible_max)
        FROM pollutants p LEFT JOIN top ON pollutant_key = pollutant_code""",
    "fct_readings": f"{STAR} SELECT * FROM fct",
    "drift_report": f"""{STAR}, both_flags AS (SELECT reading_key, exceeds_guideline AS kept,
          CASE WHEN concentration IS NOT NULL THEN concentration > 20 END AS rebuilt
          FROM fct WHERE pollutant_key = 'pm10'),
        moved AS (SELECT * FROM both_flags WHERE kept IS DISTINCT FROM rebuilt)
        SELECT reading_key, rebuilt AS exceeds_guideline, 'rebuilt' AS side FROM moved
        UNION ALL SELECT reading_key, kept, 'kept' FROM moved""",
    "load_profile": f"""{STAR} SELECT count(*) AS readings, count(value) AS non_null,
        min(measured_at_utc) AS earliest, max(measured_at_utc) AS latest FROM folded""",
    "daily_mean": f"""{STAR} SELECT date_key, pollutant_key, {_MEAN} AS mean_concentration,
        min(concentration) AS min_concentration, max(concentration) AS max_concentration,
        count(concentration) AS n_known, count(*) AS n_hours FROM fct GROUP BY ALL""",
    "weekend_profile": f"""{STAR} SELECT is_weekend, pollutant_key, {_MEAN} AS mean_concentration,
        max(concentration) AS max_concentration, count(concentration) AS n_known
        FROM fct JOIN dates USING (date_key) GROUP BY is_weekend, pollutant_key""",
    "local_weekend": f"""WITH {sub_sql()}, {fold_sql()},
        numbered AS (SELECT *, CAST(substr(location_code, 5) AS BIGINT) AS n FROM folded),
        local AS (SELECT *, CASE n % 3
            WHEN 0 THEN (measured_at_utc AT TIME ZONE 'UTC') AT TIME ZONE '{ZONES[0]}'
            WHEN 1 THEN (measured_at_utc AT TIME ZONE 'UTC') AT TIME ZONE '{ZONES[1]}'
            ELSE (measured_at_utc AT TIME ZONE 'UTC') AT TIME ZONE '{ZONES[2]}' END AS t
          FROM numbered),
        named AS (SELECT location_code, value AS concentration,
          CASE WHEN n % 2 = 0 THEN isodow(t) IN (5, 6) ELSE isodow(t) IN (6, 7) END
            AS is_weekend_local FROM local)
        SELECT location_code, is_weekend_local, {_MEAN} AS mean_concentration,
          count(concentration) AS n_known FROM named GROUP BY ALL""",
    "gap_report": f"""{STAR},
        spine AS (SELECT l.location_code, p.pollutant_key, d.date_key,
          CAST(date_diff('hour', (CAST(date_day AS TIMESTAMP) AT TIME ZONE 'Africa/Cairo')
              AT TIME ZONE 'UTC', (CAST(date_day + 1 AS TIMESTAMP) AT TIME ZONE 'Africa/Cairo')
              AT TIME ZONE 'UTC') AS INTEGER) AS expected_hours
          FROM (SELECT DISTINCT location_code FROM fct) l CROSS JOIN pollutants p
          CROSS JOIN dates d),
        seen AS (SELECT location_code, pollutant_key, date_key, count(*) AS n,
          count(*) FILTER (concentration IS NULL) AS n_null FROM fct GROUP BY ALL)
        SELECT location_code, pollutant_key, date_key, expected_hours,
          coalesce(n_null, 0) AS null_hours, expected_hours - coalesce(n, 0) AS absent_hours
        FROM spine LEFT JOIN seen USING (location_code, pollutant_key, date_key)""",
    "exceed_share": f"""{STAR}, s AS (SELECT location_code, pollutant_key,
          count(*) FILTER (exceeds_guideline) AS n_above, count(exceeds_guideline) AS n_known,
          count(*) AS n_hours FROM fct GROUP BY ALL)
        SELECT *, CASE WHEN n_known > 0 THEN CAST(((2000000 * n_above + n_known)
          // (2 * n_known)) / 1000000.0 AS DECIMAL(18,6)) END AS share_above FROM s""",
    "rolling_guideline": _rolling_sql(),
    "hour_profile": f"""{STAR} SELECT hour_of_day_local, pollutant_key,
        {_MEAN} AS mean_concentration, count(concentration) AS n_known FROM fct GROUP BY ALL""",
    "chk_not_null": """SELECT l_orderkey, l_linenumber, l_partkey, l_quantity FROM lineitem
        WHERE l_returnflag IS NULL OR l_returnflag = 'R'""",
    "chk_unique": """SELECT l_orderkey, count(*) AS n_records FROM lineitem
        WHERE l_orderkey IS NOT NULL GROUP BY 1 HAVING count(*) > 1""",
    "chk_unique_columns": """SELECT l_partkey, l_suppkey, count(*) AS n_records FROM lineitem
        GROUP BY 1, 2 HAVING count(*) > 1""",
    "chk_accepted_values": """SELECT o_orderpriority AS value_field, count(*) AS n_records
        FROM orders WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM') GROUP BY 1""",
    "chk_accepted_range": """SELECT l_quantity AS offending_value FROM lineitem
        WHERE l_quantity <= 3 OR l_quantity >= 45""",
    "chk_relationships": """SELECT o_custkey AS missing_value, count(*) AS offending FROM orders
        WHERE o_custkey IS NOT NULL AND o_custkey NOT IN
          (SELECT c_custkey FROM customer WHERE c_acctbal > 0) GROUP BY 1""",
    "chk_row_counts": "WITH r AS (" + " UNION ALL ".join([
        _check_sql("not_null_lineitem_l_shipdate", "lineitem",
                   "SELECT count(*) FROM lineitem WHERE l_shipdate IS NULL"),
        _check_sql("accepted_values_lineitem_l_linestatus", "lineitem",
                   "SELECT count(*) FROM lineitem WHERE l_linestatus <> 'O'"),
        _check_sql("accepted_range_lineitem_l_discount", "lineitem",
                   "SELECT count(*) FROM lineitem WHERE l_discount < 0 OR l_discount > 0.05"),
        _check_sql("accepted_range_lineitem_l_extendedprice", "lineitem",
                   "SELECT count(*) FROM lineitem WHERE l_extendedprice < 1000"),
        _check_sql("accepted_values_orders_o_orderstatus", "orders",
                   "SELECT count(*) FROM orders WHERE o_orderstatus NOT IN ('F', 'O')"),
        _check_sql("unique_orders_o_orderkey", "orders", "SELECT count(*) FROM (SELECT o_orderkey "
                   "FROM orders GROUP BY 1 HAVING count(*) > 1)"),
        _check_sql("unique_orders_o_custkey", "orders", "SELECT count(*) FROM (SELECT o_custkey "
                   "FROM orders GROUP BY 1 HAVING count(*) > 1)"),
        _check_sql("relationships_orders_o_custkey__customer_c_custkey", "orders",
                   "SELECT count(*) FROM orders WHERE o_custkey NOT IN "
                   "(SELECT c_custkey FROM customer)"),
        _check_sql("relationships_lineitem_l_orderkey__orders_o_orderkey", "lineitem",
                   "SELECT count(*) FROM lineitem WHERE l_orderkey NOT IN "
                   "(SELECT o_orderkey FROM orders)"),
        _check_sql("accepted_range_customer_c_acctbal", "customer",
                   "SELECT count(*) FROM customer WHERE c_acctbal < 0"),
    ]) + ") SELECT *, offending = 0 AS passed FROM r",
    "chk_plausible_bounds": f"""{BOUNDED} SELECT reading_key, pollutant_key, measured_at_utc,
        concentration, plausible_max FROM fct JOIN pollutants USING (pollutant_key)
        WHERE concentration > plausible_max""",
    "chk_recency": f"""{STAR} SELECT max(measured_at_utc) AS latest_reading_utc,
        CAST(epoch(TIMESTAMP '{LATER}' - max(measured_at_utc)) AS BIGINT) AS staleness_seconds
        FROM fct HAVING TIMESTAMP '{LATER}' - max(measured_at_utc) > INTERVAL 48 HOUR""",
    "chk_source_freshness": f"""{STAR}, m AS (SELECT max(loaded_at) AS max_loaded_at FROM folded)
        SELECT a.as_of, max_loaded_at,
          CASE WHEN CAST(a.as_of AS TIMESTAMP) - max_loaded_at > INTERVAL 48 HOUR THEN 'error'
            WHEN CAST(a.as_of AS TIMESTAMP) - max_loaded_at > INTERVAL 26 HOUR THEN 'warn'
            ELSE 'pass' END AS status
        FROM m CROSS JOIN (VALUES ('2024-01-31 12:00:00'), ('2024-02-01 12:00:00'), ('{LATER}'))
          AS a(as_of)""",
}
ORACLES["star_checks"] = star_checks_sql(BOUNDED, LATER)
