"""Ingest: land a batch of documents, parse it, upsert its readings."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from hourly_star.operators.constraints import (
    ENVELOPE_RULES, POLLUTANT_RULES, READING_RULES, enforce, enforce_domain, raise_if_any,
    violations,
)
from hourly_star.operators.parse import (
    document_counts, parse_responses, readings, refuse, rejected,
)
from hourly_star.operators.revisions import INSERTED, fold
from hourly_star.operators.upsert import CELL, note_changes, placed, upsert
from hourly_star.session import instant, spread, stage
from hourly_star.sources import reference
from hourly_star.schemas import READING_KEY
from hourly_star.sources.landing import SOURCE, batch_name, land, raw_columns
from hourly_star.sources.tables import Warehouse, by_partition


def ingest(warehouse: Warehouse, envelopes: DataFrame, batch_ts: datetime,
           batch_id: str | None = None, strict: bool = True,
           source: str = SOURCE) -> Row:
    """Ingest one batch. Doing it again for the same documents changes nothing.

    With `strict`, a bad envelope stops the batch before it is landed and a
    refused response before any reading is written. Without it the others are
    landed and loaded, and the table of refusals says what was left out. The
    counts of the run are returned: windows, submitted, inserted, changed,
    unchanged, dropped_future, rejected.
    """
    pollutants = warehouse.read("pollutants")
    enforce_domain(pollutants)
    units = reference.expected_units(pollutants)
    checked = violations(envelopes, ENVELOPE_RULES)
    bad = stage(checked, warehouse.staging_path("envelopes"))
    n_bad = bad.count()
    if n_bad and strict:
        enforce(bad.drop("violation"), ENVELOPE_RULES)
    if n_bad:
        good = F.coalesce(*[F.when(F.expr(broken), True) for _, broken in ENVELOPE_RULES]).isNull()
        envelopes = envelopes.filter(good)
    landed = land(warehouse, envelopes, batch_ts, batch_id, source)

    # Documents are decoded once; all that follows reads the narrow copy. Codes
    # come from the reference table, so a reading of an unknown one cannot occur.
    parsed = stage(parse_responses(spread(landed), list(units), units),
                   warehouse.staging_path("parsed"))
    counts = _profile(parsed)
    if strict and counts["rejected"]:
        refuse(rejected(parsed))
    raise_if_any({name: counts[name] for name, _ in READING_RULES})
    if n_bad or counts["rejected"]:
        _note_refusals(warehouse, bad, landed, parsed, batch_ts, batch_id)
    result = upsert(warehouse, readings(parsed), counts["accepted"])
    return Row(windows=counts["accepted"], submitted=result.submitted, inserted=result.inserted,
               changed=result.changed, unchanged=result.unchanged,
               dropped_future=counts["dropped"], rejected=counts["rejected"] + n_bad)


def _note_refusals(warehouse: Warehouse, bad: DataFrame, landed: DataFrame, parsed: DataFrame,
                   batch_ts: datetime, batch_id: str | None) -> None:
    """Keep what was left out of a batch, with the reason; again for the same batch, again so."""
    ts, name = batch_name(batch_ts, batch_id)
    envelopes = bad.select("document", "location_code", F.lit(None).cast("long").alias("response_id"),
                           F.col("violation").alias("reason"), "body")
    responses = rejected(parsed).join(landed.select("response_id", "document"), "response_id").select(
        "document", "location_code", "response_id", F.col("guard_error").alias("reason"),
        F.lit(None).cast("binary").alias("body"))
    warehouse.replace_partitions("refusals", envelopes.unionByName(responses).withColumns(
        {"ingest_date": F.lit(ts.date()), "ingest_batch": F.lit(name)}))


def rebuild(warehouse: Warehouse) -> int:
    """Write the readings table anew from the raw log; returns the number of readings."""
    units = reference.expected_units(warehouse.read("pollutants"))
    whole = stage(placed(replay(warehouse.read("responses"), units)), warehouse.staging_path("rebuild"))
    note_changes(warehouse, whole.withColumn("action", F.lit(INSERTED)))
    warehouse.replace_all("hourly_readings", by_partition(whole, CELL, *READING_KEY))
    return whole.count()


def _profile(parsed: DataFrame) -> dict[str, int]:
    """All a run needs to know of a parsed batch, in one scan of it."""
    measured = F.col("measured_at_utc").isNotNull()
    submitted = measured & ~F.col("is_forecast")
    per_response = parsed.groupBy("response_id").agg(
        F.max(measured.cast("int")).alias("accepted"),
        F.count_if(F.col("is_forecast")).alias("dropped"),
        *[F.count_if(submitted & F.expr(broken)).alias(name) for name, broken in READING_RULES])
    totals = per_response.agg(
        F.sum("accepted").alias("accepted"), F.sum(1 - F.col("accepted")).alias("rejected"),
        F.sum("dropped").alias("dropped"),
        *[F.sum(F.col(f"`{name}`")).alias(name) for name, _ in READING_RULES]).first()
    return {name: n or 0 for name, n in totals.asDict().items()}


def dry_run(envelopes: DataFrame, codes: list[str], as_of: datetime,
            source: str = SOURCE) -> DataFrame:
    """Parse and count without writing: one row per document.

    There is no reference table in this mode, so only the spelling of units is
    checked, not whether they are the expected ones.
    """
    responses = envelopes.select(
        F.monotonically_increasing_id().alias("response_id"), *raw_columns(source),
        instant(as_of).alias("ingested_at"))
    return document_counts(responses, codes)


def replay(responses: DataFrame, units: dict[str, str]) -> DataFrame:
    """State of the readings table rebuilt from the raw log in one job.

    Refused responses contribute nothing, as when they were first seen; the
    time beyond which an hour is a forecast is each response's own landing.
    The bucket is as stored; the day follows from the hour.
    """
    return placed(fold(readings(parse_responses(responses, list(units), units)))).drop("utc_date")


def store_reference(warehouse: Warehouse, rows: DataFrame) -> None:
    """Check and upsert reference rows."""
    enforce(rows, POLLUTANT_RULES)
    reference.store(warehouse, rows)
