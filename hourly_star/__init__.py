"""Hourly measurement data on Spark: landing, parsing, upsert, star schema, checks."""

from hourly_star.operators.calendars import store_calendars
from hourly_star.plans.daily import CheckFailure, daily_run, raise_on_failure
from hourly_star.plans.ingest import dry_run, ingest, rebuild, replay, store_reference
from hourly_star.plans.quality import check_changed, check_star, warehouse_tables
from hourly_star.plans.star import build_star
from hourly_star.session import build_session, prepare, shared_dir
from hourly_star.sources.landing import read_documents
from hourly_star.sources.tables import Warehouse
from hourly_star.streaming.upsert_stream import document_stream, envelope_stream, start_upserts

__all__ = [
    "CheckFailure", "Warehouse", "build_session", "build_star",
    "check_changed", "check_star", "daily_run", "document_stream", "dry_run",
    "envelope_stream", "ingest", "prepare", "raise_on_failure", "read_documents", "replay",
    "shared_dir", "start_upserts", "store_calendars", "store_reference", "warehouse_tables",
]
