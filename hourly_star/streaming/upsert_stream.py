"""The daily run as a stream over the landing folder."""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from hourly_star.plans.ingest import ingest
from hourly_star.plans.star import build_star
from hourly_star.sources.landing import ENVELOPE, with_manifest
from hourly_star.sources.tables import Warehouse

# Columns of the binary file source; a stream has to be told.
BINARY_FILE = "path string, modificationTime timestamp, length long, content binary"


def envelope_stream(spark: SparkSession, path: str, files_per_batch: int = 1000) -> DataFrame:
    """New envelope files (Parquet, many documents each)."""
    return (spark.readStream.schema(ENVELOPE).option("maxFilesPerTrigger", files_per_batch)
            .parquet(path))


def document_stream(spark: SparkSession, path: str, manifest: DataFrame,
                    files_per_batch: int = 10_000) -> DataFrame:
    """New files of one document each, described by a manifest."""
    files = (spark.readStream.format("binaryFile").schema(BINARY_FILE)
             .option("maxFilesPerTrigger", files_per_batch).load(path))
    return with_manifest(files, manifest)


def _now(batch_id: int) -> datetime:
    return datetime.now(timezone.utc)


def start_upserts(warehouse: Warehouse, envelopes: DataFrame, checkpoint: str,
                  clock: Callable[[int], datetime] = _now, star: bool = True,
                  strict: bool = True, name: str = "stream") -> StreamingQuery:
    """Upsert all documents that have arrived, then end; start it again for more.

    There is no event-time watermark: a late or revised reading updates its
    row whenever it comes. Micro-batches run one after another. A batch that
    is delivered again after a crash finds its raw rows already landed, and
    upsert and fact merge are idempotent by key. Batches are named after the
    checkpoint whose counter they follow, so streams do not meet; where a
    checkpoint starts anew, landing compares documents and adds the new ones.
    Without `strict`, refused documents are noted and the stream goes on.
    """
    owner = hashlib.md5(checkpoint.encode()).hexdigest()[:8]

    def each(batch: DataFrame, batch_id: int) -> None:
        ingest(warehouse, batch, clock(batch_id), f"{name}-{owner}-{batch_id:09d}", strict=strict)
        if star:
            build_star(warehouse)

    return (envelopes.writeStream.foreachBatch(each)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())
