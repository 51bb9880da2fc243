from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import submissions
from hourly_star.operators import checks
from hourly_star.operators.constraints import duplicates, references, violation_counts, violations
from hourly_star.operators.constraints import nonnegative, on_grid, required
from hourly_star.operators.revisions import fold
from hourly_star.plans.quality import check_star, declared_checks
from hourly_star.plans.star import dim_date, dim_pollutant, fact, staged_readings
from hourly_star.sources import reference

NOW = datetime(2026, 9, 20, 10)


def tables(spark, value=20.0, age=timedelta(0), loaded=NOW, code="pm2_5"):
    rows = [("giza", code, NOW - age - timedelta(hours=i), value if i == 0 else 5.0, "ug/m3", i, loaded)
            for i in range(30)]
    readings = fold(submissions(spark, rows))
    pollutants = reference.seed(spark)
    staged = staged_readings(readings)
    dim = dim_pollutant(pollutants)
    return {"hourly_readings": readings, "pollutants": pollutants, "stg_hourly_readings": staged,
            "dim_date": dim_date(staged), "dim_pollutant": dim, "fct_hourly_readings": fact(staged, dim)}


def failing(spark, **kw):
    return {r["check"] for r in check_star(tables(spark, **kw), NOW).filter("NOT passed").collect()}


BOUNDS = "concentration_within_pollutant_bounds"
COARSE = "accepted_range_fct_hourly_readings_concentration"


def test_forty_checks_by_place():
    declared = declared_checks(NOW)
    by = [c.name.split("_")[0] for c in declared]
    assert len(declared) == 40 and len({c.name for c in declared}) == 40
    assert by.count("not") == 26 and by.count("unique") == 5 and by.count("relationships") == 3
    assert sum(c.name.startswith("accepted_values") for c in declared) == 2
    assert sum(c.name.startswith("accepted_range") for c in declared) == 2


def test_good_data_pass(spark):
    results = check_star(tables(spark), NOW)
    assert results.count() == 41 and results.filter("NOT passed").isEmpty()


def test_implausible_value_fails_its_own_bound_only(spark):
    assert failing(spark, value=1500.0) == {BOUNDS}


def test_absurd_value_fails_both(spark):
    assert failing(spark, value=99999.0) == {BOUNDS, COARSE}


def test_old_measurements_fail_recency_not_freshness(spark):
    assert failing(spark, age=timedelta(days=5)) == {"readings_are_recent"}


def test_stuck_loader_fails_freshness_not_recency(spark):
    assert failing(spark, loaded=NOW - timedelta(days=5)) == {"source_freshness"}
    assert failing(spark, loaded=NOW - timedelta(hours=30)) == {"source_freshness"}


def test_unknown_pollutant_fails_the_relationship(spark):
    assert failing(spark, code="radon") >= {
        "relationships_stg_hourly_readings_pollutant_code__pollutants_pollutant_code"}


def test_freshness_levels(spark):
    def status(hours):
        rows = tables(spark, loaded=NOW - timedelta(hours=hours))["hourly_readings"]
        return checks.source_freshness(rows, "loaded_at", NOW).first().status
    assert [status(h) for h in (26, 27, 48, 49)] == ["pass", "warn", "warn", "error"]


def test_recency_of_an_empty_table(spark):
    empty = tables(spark)["fct_hourly_readings"].limit(0)
    assert checks.stale(empty, NOW).isEmpty()
    assert checks.stale(empty, NOW, allow_empty=False).count() == 1


def test_recency_boundary(spark):
    rows = tables(spark)["fct_hourly_readings"]
    assert checks.stale(rows, NOW + timedelta(hours=48)).isEmpty()
    found = checks.stale(rows, NOW + timedelta(hours=49)).first()
    assert found.staleness == timedelta(hours=49)


@pytest.mark.parametrize("low, high, inclusive, expected", [
    (1, 3, True, [0, 4]), (1, 3, False, [0, 1, 3, 4]), (2, None, True, [0, 1]), (None, 2, False, [2, 3, 4]),
])
def test_accepted_range(spark, low, high, inclusive, expected):
    df = spark.createDataFrame([(i,) for i in [*range(5), None]], "v int")
    got = checks.accepted_range(df, "v", low, high, inclusive)
    assert sorted(r.offending_value for r in got.collect()) == expected


def test_a_range_needs_a_bound(spark):
    with pytest.raises(ValueError):
        checks.accepted_range(spark.range(1), "id")
    with pytest.raises(ValueError):
        checks.check_accepted_range("t", "id")


def test_nulls_in_generic_checks(spark):
    df = spark.createDataFrame([(1, "a"), (1, None), (None, None), (None, "b")], "k int, v string")
    assert [tuple(r) for r in checks.unique(df, "k").collect()] == [(1, 2)]
    assert checks.unique(df, "k", "v").isEmpty()
    assert [tuple(r) for r in checks.accepted_values(df, "v", ["a"]).collect()] == [("b", 1)]
    assert checks.not_null(df, "v").count() == 2
    parent = spark.createDataFrame([("a",)], "name string")
    assert [tuple(r) for r in checks.relationships(df, "v", parent, "name").collect()] == [("b", 1)]


def test_relationship_with_a_hot_value_counts_rows(spark):
    df = spark.range(9000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise("a").alias("v"))
    parent = spark.createDataFrame([("a",)], "name string")
    results = checks.run_checks({"t": df, "p": parent}, [checks.check_relationships("t", "v", "p", "name")])
    assert (results.first().offending, results.first().passed) == (3000, False)


def test_row_checks_share_a_scan(spark):
    df = spark.createDataFrame([(1, None), (None, 2)], "a int, b int")
    declared = [checks.check_not_null("t", "a"), checks.check_accepted_range("t", "b", 0, 1),
                checks.check_accepted_values("t", "a", [2])]
    results = checks.run_checks({"t": df}, declared)
    assert {r["check"]: r.offending for r in results.collect()} == {
        "not_null_t_a": 1, "accepted_range_t_b": 1, "accepted_values_t_a": 1}


def test_constraints(spark):
    df = spark.createDataFrame([
        (Decimal("1"), datetime(2026, 1, 1, 3), "u"), (Decimal("-1"), datetime(2026, 1, 1, 3, 30), "u"),
        (None, datetime(2026, 1, 1, 3, 0, 0, 1), "u"), (Decimal("0"), datetime(2026, 1, 1), None),
    ], "value decimal(10,3), at timestamp, unit string")
    rules = [nonnegative("value"), on_grid("at"), *required("unit")]
    got = [r.violation for r in violations(df, rules).collect()]
    assert got == ["nonnegative:value", "on_hour:at", "required:unit"]
    assert violation_counts(df, rules).first().asDict() == {
        "nonnegative:value": 1, "on_hour:at": 2, "required:unit": 1}
    assert duplicates(df, ["unit"]).collect()[0].copies == 3
    assert references(df, "unit", df.filter("unit IS NULL"), "unit").first().offending == 3
