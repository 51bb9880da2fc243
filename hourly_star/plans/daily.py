"""The daily run: ingest, then the star, then its checks."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, Row

from hourly_star.plans.ingest import ingest
from hourly_star.plans.quality import check_changed, check_star, warehouse_tables
from hourly_star.plans.star import TIME_ZONE, build_star
from hourly_star.sources.tables import Warehouse


class CheckFailure(RuntimeError):
    """The tables were built and their data are wrong."""


def daily_run(warehouse: Warehouse, envelopes: DataFrame, batch_ts: datetime,
              batch_id: str | None = None, zone: str = TIME_ZONE,
              strict: bool = True, check_all: bool = True) -> tuple[Row, DataFrame]:
    """Ingest a batch and bring the star up to date.

    Returns the counters and the check results as of the batch. A step that
    cannot be done raises; data that look wrong are in the results, and
    `raise_on_failure` turns them into an error. Without `check_all`, only the
    days the batch changed are checked.
    """
    summary = ingest(warehouse, envelopes, batch_ts, batch_id, strict)
    build_star(warehouse, zone=zone)
    if not check_all:
        return summary, check_changed(warehouse, batch_ts, batch_ts, zone)
    return summary, check_star(warehouse_tables(warehouse, zone), batch_ts)


def raise_on_failure(results: DataFrame) -> None:
    """Raise if a check of severity "error" found anything."""
    failed = results.filter("NOT passed AND severity = 'error'").collect()
    if failed:
        text = ", ".join(f"{row['check']} ({row.offending})" for row in failed)
        raise CheckFailure(text)
