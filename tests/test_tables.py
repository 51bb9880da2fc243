from datetime import date, datetime, timedelta
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from conftest import CODES, UNITS, body, envelopes, utc
from hourly_star.operators.constraints import ConstraintViolation
from hourly_star.operators.parse import UpstreamDataError
from hourly_star.plans.daily import CheckFailure, daily_run, raise_on_failure
from hourly_star.plans.ingest import dry_run, ingest, rebuild, replay, store_reference
from hourly_star.plans.star import build_star, fact, staged_readings
from hourly_star.operators.incremental import compared, drift, merge, watermark
from hourly_star.operators.upsert import BUCKETS, merged_cells
from hourly_star.schemas import FACT_KEY, POLLUTANT_ROWS, POLLUTANTS
from hourly_star.session import spread
from hourly_star.sources.landing import covering, digest_counts, newest_first, read_documents
from hourly_star.sources import reference
from hourly_star.sources.tables import Warehouse

T = datetime(2026, 9, 20, 3)
DAY = [f"2026-09-19T{h:02d}:00" for h in range(24)]


def values(**changed):
    return [float(h) if f"h{h}" not in changed else changed[f"h{h}"] for h in range(24)]


def files_of(warehouse, table):
    root = Path(warehouse.location(table))
    return {p: p.stat().st_mtime_ns for p in root.rglob("*.parquet")}


def state(warehouse):
    return sorted(utc(warehouse.read("hourly_readings")), key=repr)


def fact_rows(warehouse):
    return sorted(utc(warehouse.read("fct_hourly_readings")), key=repr)


def test_create_twice_changes_nothing(warehouse):
    before = warehouse.read("pollutants").count()
    warehouse.create()
    assert warehouse.read("pollutants").count() == before == 4


def test_a_new_session_finds_the_tables(spark, warehouse):
    ingest(warehouse, envelopes(spark, body(DAY, values())), T)
    again = Warehouse(spark, warehouse.root, warehouse.prefix + "again_").create()
    assert state(again) == state(warehouse)
    assert again.read("pollutants").count() == 4


def test_reference_rows_are_overwritten_by_key(spark, warehouse):
    edited = [(*row[:5], Decimal("1200"), row[6]) for row in POLLUTANT_ROWS if row[0] == "pm10"]
    store_reference(warehouse, spark.createDataFrame(edited, POLLUTANTS))
    got = {r.pollutant_code: r.plausible_max for r in warehouse.read("pollutants").collect()}
    assert len(got) == 4 and got["pm10"] == 1200 and got["ozone"] == 1000
    bad = [(*row[:5], Decimal("0"), row[6]) for row in POLLUTANT_ROWS[:1]]
    with pytest.raises(ConstraintViolation, match="positive:plausible_max"):
        store_reference(warehouse, spark.createDataFrame(bad, POLLUTANTS))


def test_first_run_and_repetition(spark, warehouse):
    docs = envelopes(spark, body(DAY, values()))
    first = ingest(warehouse, docs, T)
    assert first[:5] == (1, 96, 96, 0, 0)
    before, files = state(warehouse), files_of(warehouse, "hourly_readings")
    second = ingest(warehouse, docs, T + timedelta(days=1))
    assert second[1:5] == (96, 0, 0, 96)
    assert state(warehouse) == before
    # Nothing changed, so no file was written.
    assert files_of(warehouse, "hourly_readings") == files
    assert warehouse.read("responses").count() == 2


def test_one_changed_reading_reaches_the_fact_alone(spark, warehouse):
    ingest(warehouse, envelopes(spark, body(DAY, values())), T)
    assert build_star(warehouse) == 96
    result = ingest(warehouse, envelopes(spark, body(DAY, values(), pm10=values(h7=70.5))),
                    T + timedelta(days=1))
    assert (result.submitted, result.inserted, result.changed, result.unchanged) == (96, 0, 1, 95)
    # The watermark is inclusive: rows that carry it are looked at again, but
    # what has not changed is not written.
    before = set(fact_rows(warehouse))
    assert build_star(warehouse) == 1
    after = set(fact_rows(warehouse))
    assert len(after - before) == 1 and len(after) == 96
    files = files_of(warehouse, "fct_hourly_readings")
    assert build_star(warehouse) == 0
    assert files_of(warehouse, "fct_hourly_readings") == files
    row = warehouse.read("hourly_readings").filter("loaded_at > first_loaded_at").first()
    assert (row.value, row.pollutant_code) == (Decimal("70.500"), "pm10")


def test_only_touched_days_are_rewritten(spark, warehouse):
    other = [t.replace("09-19", "09-18") for t in DAY]
    ingest(warehouse, envelopes(spark, body(DAY, values()), body(other, values())), T)
    files = files_of(warehouse, "hourly_readings")
    ingest(warehouse, envelopes(spark, body(DAY, values(h3=0.5))), T + timedelta(days=1))
    kept = {p for p in files if "utc_date=2026-09-18" in str(p)}
    now = files_of(warehouse, "hourly_readings")
    assert kept and all(now.get(p) == files[p] for p in kept)
    assert not any(p in now for p in set(files) - kept)


def test_one_changed_reading_rewrites_one_bucket(spark, warehouse):
    places = [f"place{i}" for i in range(12)]
    docs = [envelopes(spark, body(DAY, values()), location=p).withColumn("document", F.lit(p)) for p in places]
    whole = docs[0]
    for other in docs[1:]:
        whole = whole.unionByName(other)
    ingest(warehouse, whole, T)
    held = warehouse.read("hourly_readings").select("location_code", "bucket").distinct().collect()
    bucket = dict(map(tuple, held))
    assert set(bucket.values()) == set(range(BUCKETS))
    files = files_of(warehouse, "hourly_readings")
    ingest(warehouse, envelopes(spark, body(DAY, values(h3=0.5)), location="place3"), T + timedelta(days=1))
    now = files_of(warehouse, "hourly_readings")
    kept = {p for p in files if f"/bucket={bucket['place3']}/" not in str(p)}
    assert kept and all(now.get(p) == files[p] for p in kept)
    assert not any(p in now for p in set(files) - kept)
    assert warehouse.read("hourly_readings").count() == 12 * 96


def test_the_upsert_reads_its_cells_once_and_joins_once(spark, warehouse):
    ingest(warehouse, envelopes(spark, body(DAY, values())), T)
    again = warehouse.read("hourly_readings").select(
        "location_code", "pollutant_code", "measured_at_utc", "value", "unit",
        F.lit(9).cast("long").alias("response_id"), F.col("loaded_at").alias("ingested_at"))
    again = spark.createDataFrame(again.collect(), again.schema)
    plan = merged_cells(warehouse.read("hourly_readings"), again)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation spark_catalog") == 1 and plan.count("Join ") == 1 and "Join FullOuter" in plan


def test_the_change_log_tells_the_fact_what_to_read(spark, warehouse):
    other = [t.replace("09-19", "09-18") for t in DAY]
    ingest(warehouse, envelopes(spark, body(DAY, values()), body(other, values())), T)
    build_star(warehouse)
    ingest(warehouse, envelopes(spark, body(DAY, values(h3=0.5)), body(other, values())), T + timedelta(days=1))
    ingest(warehouse, envelopes(spark, body(DAY, values(h3=0.5))), T + timedelta(days=2))  # nothing new: no entry
    log = [(r.seq, r.utc_date.day, r.inserted, r.changed) for r in warehouse.read("reading_changes").collect()]
    assert sorted(log) == [(1, 18, 96, 0), (1, 19, 96, 0), (2, 19, 0, 4)]
    assert build_star(warehouse) == 4 and build_star(warehouse) == 0
    runs = sorted(tuple(r) for r in warehouse.read("star_runs").collect())
    assert runs == [(1, 2, 192, 192), (2, 1, 4, 4)]
    # a run that died before its note is done again, without effect
    before = fact_rows(warehouse)
    warehouse.replace_all("star_runs", spark.createDataFrame([(1, 2, 192, 192)], warehouse.read("star_runs").schema))
    assert build_star(warehouse) == 0 and fact_rows(warehouse) == before
    assert rebuild(warehouse) == 192 and build_star(warehouse) == 0 and fact_rows(warehouse) == before


def test_nulls_are_stored_and_filled_in_later(spark, warehouse):
    ingest(warehouse, envelopes(spark, body(DAY, values(h5=None))), T)
    assert warehouse.read("hourly_readings").filter("value IS NULL").count() == 4
    second = ingest(warehouse, envelopes(spark, body(DAY, values())), T + timedelta(days=1))
    assert (second.changed, second.unchanged) == (4, 92)


def test_overlapping_documents_in_one_batch(spark, warehouse):
    # The later document wins, whatever order Spark reads them in.
    one = envelopes(spark, body(DAY, values()), fetched=T)
    two = envelopes(spark, body(DAY, values(h1=99.0)), fetched=T - timedelta(hours=1)) \
        .withColumn("document", F.lit("earlier"))
    result = ingest(warehouse, one.unionByName(two), T)
    assert (result.submitted, result.inserted, result.changed) == (192, 96, 4)
    assert warehouse.read("hourly_readings").filter("value = 99").isEmpty()


def test_forecast_hours_are_dropped(spark, warehouse):
    result = ingest(warehouse, envelopes(spark, body(DAY, values())), datetime(2026, 9, 19, 11, 34))
    assert (result.submitted, result.dropped_future) == (48, 48)


def test_refused_document_is_landed_and_stops_the_batch(spark, warehouse):
    docs = envelopes(spark, body(DAY, values()), body(DAY, values(), offset=3600), b"\xff\xfe{")
    with pytest.raises(UpstreamDataError, match="malformed"):
        ingest(warehouse, docs, T)
    assert warehouse.read("responses").count() == 3
    assert state(warehouse) == []
    # The same batch again, this time loading what is good.
    result = ingest(warehouse, docs, T, strict=False)
    assert (result.windows, result.rejected, result.inserted) == (1, 2, 96)
    assert warehouse.read("responses").count() == 3


def test_impossible_values_are_refused(spark, warehouse):
    with pytest.raises(UpstreamDataError, match="nonnegative:value"):
        ingest(warehouse, envelopes(spark, body(DAY, values(h2=-1.0))), T)
    off = [t.replace(":00", ":30") for t in DAY]
    with pytest.raises(UpstreamDataError, match="on_hour"):
        ingest(warehouse, envelopes(spark, body(off, values())), T + timedelta(hours=1))
    assert state(warehouse) == [] and warehouse.read("responses").count() == 2


def test_bad_request_metadata_is_refused(spark, warehouse):
    docs = envelopes(spark, body(DAY, values()))
    with pytest.raises(ConstraintViolation, match="within:http_status"):
        ingest(warehouse, docs.withColumn("http_status", F.lit(99).cast("short")), T)
    with pytest.raises(ConstraintViolation, match="ordered:window_start"):
        ingest(warehouse, docs.withColumn("window_end", F.lit(date(2026, 9, 1))),
               T + timedelta(hours=1))
    assert warehouse.read("responses").isEmpty()


def test_reference_table_must_be_loaded(spark, tmp_path):
    empty = Warehouse(spark, str(tmp_path / "e"), f"e{tmp_path.name[-3:]}_").create()
    with pytest.raises(ConstraintViolation, match="pollutants table is empty"):
        ingest(empty, envelopes(spark, body(DAY, values())), T)


def test_empty_batch_is_a_no_op(spark, warehouse):
    docs = envelopes(spark, body(DAY, values())).filter("document = 'none'")
    assert tuple(ingest(warehouse, docs, T)) == (0,) * 7


def test_ids_follow_arrival_and_time_may_not_go_back(spark, warehouse):
    ingest(warehouse, envelopes(spark, body(DAY, values()), body(DAY, values(h1=5.5))), T)
    ingest(warehouse, envelopes(spark, body(DAY, values(h1=6.5))), T + timedelta(days=1))
    rows = warehouse.read("responses").orderBy("response_id").collect()
    assert [r.request_url[-1] for r in rows] == ["0", "1", "0"]
    assert len({r.response_id for r in rows}) == 3
    with pytest.raises(ValueError, match="before the newest landing"):
        ingest(warehouse, envelopes(spark, body(DAY, values())), T - timedelta(days=1))


def test_late_document_reaches_the_fact(spark, warehouse):
    # A document for an old day lands after a newer one was loaded.
    ingest(warehouse, envelopes(spark, body(DAY, values())), T)
    build_star(warehouse)
    old = [t.replace("09-19", "08-01") for t in DAY]
    ingest(warehouse, envelopes(spark, body(old, values()), fetched=datetime(2026, 8, 2)),
           T + timedelta(days=1))
    build_star(warehouse)
    assert warehouse.read("fct_hourly_readings").filter("utc_date = DATE'2026-08-01'").count() == 96
    assert warehouse.read("dim_date").count() == 51


def test_incremental_fact_equals_full_rebuild(spark, warehouse):
    runs = [values(), values(h2=1.25), values(h2=2.0, h3=None), values()]
    for i, series in enumerate(runs):
        days = [t.replace("09-19", f"09-{17 + i % 3}") for t in DAY]
        ingest(warehouse, envelopes(spark, body(days, series), body(DAY, series)),
               T + timedelta(days=i))
        build_star(warehouse)
    kept = fact_rows(warehouse)
    build_star(warehouse, full_refresh=True)
    assert fact_rows(warehouse) == kept
    assert watermark(warehouse.read("fct_hourly_readings")) == "2026-09-23 03:00:00"


def test_drift_after_an_edited_guideline(spark, warehouse):
    # Rows at the watermark are looked at again, so a second batch moves it on.
    for i in range(2):
        ingest(warehouse, envelopes(spark, body(DAY, values(h0=0.5 + i))), T + timedelta(days=i))
        build_star(warehouse)
    edited = [(*row[:3], Decimal("10"), *row[4:]) for row in POLLUTANT_ROWS if row[0] == "pm2_5"]
    store_reference(warehouse, spark.createDataFrame(edited, POLLUTANTS))
    ingest(warehouse, envelopes(spark, body([DAY[1]], [50.0])), T + timedelta(days=2))
    build_star(warehouse)
    # Old rows keep the flag they were loaded with until a full refresh.
    stale = ("pollutant_key = 'pm2_5' AND concentration BETWEEN 11 AND 15 "
             "AND NOT exceeds_guideline")
    assert warehouse.read("fct_hourly_readings").filter(stale).count() == 5
    rebuilt = fact(staged_readings(warehouse.read("hourly_readings")),
                   warehouse.read("dim_pollutant"))
    assert drift(rebuilt, warehouse.read("fct_hourly_readings")).count() == 10
    build_star(warehouse, full_refresh=True)
    assert drift(rebuilt, warehouse.read("fct_hourly_readings")).isEmpty()


def test_new_columns_are_appended(spark, warehouse):
    ingest(warehouse, envelopes(spark, body(DAY, values())), T)
    build_star(warehouse)
    batch = warehouse.read("fct_hourly_readings").filter("hour_of_day_local = 5").withColumn(
        "is_high", F.col("concentration") > 1)
    merge(warehouse, "fct_hourly_readings", batch, list(FACT_KEY))
    table = warehouse.read("fct_hourly_readings")
    assert table.columns[-2:] == ["is_high", "utc_date"]
    assert table.count() == 96 and table.filter("is_high IS NOT NULL").count() == 4
    # A model without the column leaves it in place.
    ingest(warehouse, envelopes(spark, body(DAY, values(h0=9.5))), T + timedelta(days=1))
    build_star(warehouse)
    assert "is_high" in warehouse.read("fct_hourly_readings").columns
    # A catalog made anew finds it in the files.
    again = Warehouse(spark, warehouse.root, warehouse.prefix + "again_").create()
    assert again.read("fct_hourly_readings").columns == table.columns


def test_replay_rebuilds_the_readings(spark, warehouse):
    for i, series in enumerate([values(), values(h2=None), values(), values(h9=3.25)]):
        ingest(warehouse, envelopes(spark, body(DAY, series)), T + timedelta(days=i))
    rebuilt = replay(warehouse.read("responses"), UNITS)
    assert sorted(utc(rebuilt), key=repr) == sorted(
        utc(warehouse.read("hourly_readings").drop("utc_date")), key=repr)


def test_dry_run_writes_nothing(spark, warehouse):
    docs = envelopes(spark, body(DAY, values()), body(DAY, values(), offset=1))
    rows = {r.guard_error: r for r in dry_run(docs, CODES, datetime(2026, 9, 19, 11, 34)).collect()}
    assert (rows[None].submitted, rows[None].dropped_future) == (48, 48)
    assert rows["utc_offset"].submitted == 0
    assert warehouse.read("responses").isEmpty()


def test_raw_lookups(spark, warehouse):
    text = body(DAY, values())
    for i in range(3):
        ingest(warehouse, envelopes(spark, text, day=date(2026, 9, 17 + i)), T + timedelta(days=i))
    raw = warehouse.read("responses")
    assert [r.window_start.day for r in newest_first(raw, 2).collect()] == [19, 18]
    assert covering(raw, date(2026, 9, 18)).count() == 1
    assert [r.copies for r in digest_counts(raw).collect()] == [3]


def test_files_and_manifest(spark, warehouse, tmp_path):
    import hashlib

    folder = tmp_path / "docs"
    folder.mkdir()
    text = body(DAY, values()).encode()
    (folder / "a.json").write_bytes(text)
    manifest = spark.createDataFrame(
        [("a.json", "giza", "https://example.invalid/a", "{}", date(2026, 9, 19),
          date(2026, 9, 19), 200)],
        "document string, location_code string, request_url string, request_params string, "
        "window_start date, window_end date, http_status int")
    result = ingest(warehouse, read_documents(spark, str(folder), manifest), T)
    assert result.inserted == 96
    assert warehouse.read("responses").first().payload_sha256 == hashlib.sha256(text).hexdigest()
    assert warehouse.read("responses").first().payload.encode() == text


def test_daily_run(spark, warehouse):
    fresh = datetime(2026, 9, 20, 3)
    summary, results = daily_run(warehouse, envelopes(spark, body(DAY, values())), fresh)
    assert summary.inserted == 96 and results.filter("NOT passed").isEmpty()
    raise_on_failure(results)
    _, results = daily_run(warehouse, envelopes(spark, body(DAY, values(h4=1500.0))),
                           fresh + timedelta(days=1))
    with pytest.raises(CheckFailure, match="within_pollutant_bounds"):
        raise_on_failure(results)


def test_checks_of_changed_days(spark, warehouse):
    old = [t.replace("09-19", "08-01") for t in DAY]
    ingest(warehouse, envelopes(spark, body(old, values(h4=1500.0))), T - timedelta(days=1))
    build_star(warehouse)

    def failed(hours, series, n):
        _, results = daily_run(warehouse, envelopes(spark, body(hours, series)),
                               T + timedelta(hours=n), check_all=False)
        assert results.count() == 41
        return {r["check"] for r in results.filter("NOT passed").collect()}

    # The bad value of August is not looked at again until its day changes.
    assert failed(DAY, values(), 0) == set()
    assert failed(DAY, values(), 1) == set()
    # A batch of late documents only does not make the data look old.
    late = [t.replace("09-19", "08-02") for t in DAY]
    assert failed(late, values(), 2) == set()
    assert failed(old, values(h4=1500.0, h5=4.5), 3) == {"concentration_within_pollutant_bounds"}


def test_a_known_batch_name_never_swallows_documents(spark, warehouse):
    one, other = (envelopes(spark, body(DAY, values()), location=x) for x in ("giza", "luxor"))
    ingest(warehouse, one, T, "b")
    result = ingest(warehouse, other.withColumn("document", F.lit("new")), T, "b")
    assert (result.submitted, result.inserted) == (192, 96)
    assert {r.location_code for r in warehouse.read("responses").collect()} == {"giza", "luxor"}
    both = one.union(other.withColumn("document", F.lit("new")))
    assert ingest(warehouse, both, T, "b").inserted == 0 and warehouse.read("responses").count() == 2
    with pytest.raises(ConstraintViolation, match="differ"):
        ingest(warehouse, other, T, "b")  # the same document name, another place
    assert warehouse.read("responses").count() == 2


def test_replay_and_ingest_share_one_verdict(spark, warehouse):
    off = [t.replace(":00", ":30") for t in DAY]
    docs = envelopes(spark, body(DAY, values()), body(DAY, values(h2=-1.0)), body(off, values()),
                     body([t.replace("09-19", "09-18") for t in DAY], values(), offset=60))
    bad = envelopes(spark, body(DAY, values())).withColumn("document", F.lit("bad")).withColumn(
        "window_end", F.lit(date(2026, 9, 1)))
    result = ingest(warehouse, docs.union(bad), T, strict=False)
    assert (result.windows, result.rejected, result.inserted) == (1, 4, 96)
    assert warehouse.read("responses").count() == 4
    noted = {r.document: r.reason for r in warehouse.read("refusals").collect()}
    assert noted == {"doc-1": "nonnegative:value", "doc-2": "on_hour:measured_at_utc", "doc-3": "utc_offset",
                     "bad": "ordered:window_start,window_end"}
    before = state(warehouse)
    assert rebuild(warehouse) == 96 and state(warehouse) == before


def test_a_code_occurs_once(spark, warehouse):
    twice = reference.seed(spark).union(reference.seed(spark).limit(1))
    with pytest.raises(ConstraintViolation, match="occur twice"):
        store_reference(warehouse, twice)


def test_the_staging_view_is_there_for_every_session(spark, warehouse):
    ingest(warehouse, envelopes(spark, body(DAY, values())), T)
    build_star(warehouse)
    view = f"{warehouse.prefix}staging.stg_hourly_readings"
    other = spark.newSession().table(view)
    expected = staged_readings(warehouse.read("hourly_readings"))
    assert other.columns == expected.columns
    assert sorted(map(str, other.collect())) == sorted(map(str, expected.collect()))


def test_manifest_dates_are_read_strictly(spark, tmp_path):
    (tmp_path / "a.json").write_text(body(DAY, values()))
    row = ("a.json", "giza", "u", "{}", "2026-09-19", "2026-09-19", 200)
    schema = ("document string, location_code string, request_url string, request_params string, "
              "window_start string, window_end string, http_status int")
    good = read_documents(spark, str(tmp_path), spark.createDataFrame([row], schema)).first()
    assert good.window_start == date(2026, 9, 19)
    for text in ("19/09/2026", "2026-9-19", "2026-02-30", "soon"):
        bad = spark.createDataFrame([(*row[:4], text, *row[5:])], schema)
        with pytest.raises(Exception, match="(?i)parse|date"):
            read_documents(spark, str(tmp_path), bad).collect()


def test_the_merge_joins_once(spark):
    target = spark.createDataFrame([(1, "a", "x"), (2, "b", "x"), (3, None, "y")], "k int, v string, d string")
    batch = spark.createDataFrame([(2, "b", "x"), (3, "c", "y"), (4, None, "y")], "k int, v string, d string")
    after = compared(target, batch, ["k"])
    assert sorted(tuple(row) for row in after.collect()) == [
        (1, "a", "x", False, False), (2, "b", "x", True, False), (3, "c", "y", True, True), (4, None, "y", True, True)]
    assert after._jdf.queryExecution().optimizedPlan().toString().count("Join") == 1


def test_one_file_of_documents_is_parsed_by_many_tasks(spark, tmp_path):
    spark.range(1000).coalesce(1).write.parquet(str(tmp_path / "few"))
    spark.range(1000).repartition(40).write.parquet(str(tmp_path / "many"))
    few, many = (spark.read.parquet(str(tmp_path / name)) for name in ("few", "many"))
    assert spread(few).rdd.getNumPartitions() == 16
    assert spread(many) is many
