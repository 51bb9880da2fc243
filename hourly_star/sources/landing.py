"""Response documents in storage, and the raw log they are appended to."""

from __future__ import annotations

from datetime import date, datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hourly_star.operators.constraints import duplicates, enforce_none
from hourly_star.session import instant, stage
from hourly_star.sources.tables import Warehouse

SOURCE = "hourly-api"

# What a fetcher leaves for one request. `document` is unique in a batch and
# orders documents fetched at the same instant.
ENVELOPE = (
    "document string, location_code string, request_url string, request_params string, "
    "window_start date, window_end date, http_status smallint, fetched_at timestamp, "
    "body binary"
)


def read_documents(spark: SparkSession, path: str, manifest: DataFrame) -> DataFrame:
    """One file per document, joined to what the manifest says about its name."""
    files = spark.read.format("binaryFile").load(path)
    return with_manifest(files, manifest)


def with_manifest(files: DataFrame, manifest: DataFrame) -> DataFrame:
    """Envelopes from binary files and a manifest keyed by file name.

    Window dates may be text; it has to read yyyy-MM-dd, anything else is an error.
    """
    texts = [c for c, kind in manifest.dtypes if c in ("window_start", "window_end") and kind == "string"]
    manifest = manifest.withColumns({c: F.to_date(F.col(c), "yyyy-MM-dd") for c in texts})
    named = files.select(
        F.element_at(F.split("path", "/"), -1).alias("document"),
        F.col("modificationTime").alias("fetched_at"),
        F.col("content").alias("body"),
    )
    return named.join(manifest, "document")


def raw_columns(source: str = SOURCE) -> list[Column]:
    """Raw columns that follow from the envelope alone.

    The digest is over the bytes. The cast keeps them as they are, so that a
    body which is no valid text is landed too and refused later.
    """
    return [
        F.lit(source).alias("source"), F.col("location_code"), F.col("request_url"),
        F.col("request_params"), F.col("window_start"), F.col("window_end"),
        F.col("http_status").cast("smallint").alias("http_status"),
        F.col("body").cast("string").alias("payload"),
        F.sha2("body", 256).alias("payload_sha256"),
    ]


def batch_name(batch_ts: datetime, batch_id: str | None) -> tuple[datetime, str]:
    """Time of the batch in UTC, naive taken as such, and its name, by default the time."""
    if batch_ts.tzinfo is None:
        batch_ts = batch_ts.replace(tzinfo=timezone.utc)
    batch_ts = batch_ts.astimezone(timezone.utc)
    return batch_ts, batch_id or f"{batch_ts:%Y%m%dT%H%M%S%f}"


def land(warehouse: Warehouse, envelopes: DataFrame, batch_ts: datetime,
         batch_id: str | None = None, source: str = SOURCE) -> DataFrame:
    """Append a batch to the raw log and return it as stored.

    Landing ends before anything is parsed, so a body that breaks the parser
    is kept. A batch lives in a partition of its own. If one of the same name
    is there already, documents are compared: those stored stay as they are,
    new ones are added, and a document that differs from its stored namesake
    is an error. All rows of the name are returned.
    """
    batch_ts, batch_id = batch_name(batch_ts, batch_id)
    stored = warehouse.read("responses").filter(F.col("ingest_batch") == batch_id)
    again = not stored.isEmpty()
    if again:
        envelopes = _not_stored(envelopes, stored)
        if envelopes.isEmpty():
            return stored

    top_id, newest = _high_water(warehouse)
    if newest is not None and batch_ts.replace(tzinfo=None) < newest:
        raise ValueError(f"batch time {batch_ts} is before the newest landing {newest}")
    numbered = _numbered(warehouse, envelopes.select("document", "fetched_at"), top_id)
    rows = envelopes.join(numbered, "document").select(
        "response_id",
        *raw_columns(source),
        instant(batch_ts).alias("ingested_at"),
        "document",
        F.lit(batch_ts.date()).alias("ingest_date"),
        F.lit(batch_id).alias("ingest_batch"),
    )
    if again:  # the partition is written as a whole
        rows = stage(rows.unionByName(stored), warehouse.staging_path("landing"))
    warehouse.replace_partitions("responses", rows)
    return warehouse.read("responses").filter(F.col("ingest_batch") == batch_id)


def _not_stored(envelopes: DataFrame, stored: DataFrame) -> DataFrame:
    """Envelopes whose document is not among the stored rows of the batch."""
    same = ["location_code", "window_start", "window_end", "payload_sha256"]
    arrived = envelopes.select("document", *[F.col(c) for c in same[:-1]],
                               F.sha2("body", 256).alias("payload_sha256"))
    held = stored.select("document", *[F.col(c).alias(f"held_{c}") for c in same])
    alike = F.lit(True)
    for c in same:
        alike = alike & F.col(c).eqNullSafe(F.col(f"held_{c}"))
    enforce_none(arrived.join(held, "document").filter(~alike).select("document"),
                 "documents that differ from those landed under the same batch name")
    return envelopes.join(stored.select("document"), "document", "left_anti")


# monotonically_increasing_id() counts rows within a partition in its lowest bits.
ROW_BITS = 33


def _numbered(warehouse: Warehouse, documents: DataFrame, top_id: int) -> DataFrame:
    """Ids without gaps that grow with the time of fetching, above all ids so far.

    Only names and times are sorted. Bodies are read once and, as long as the
    list of names is small enough to be broadcast, not moved at all. The sorted
    names are written with their partition and place in it; what comes before a
    partition follows from the counts, one row per partition.
    """
    enforce_none(duplicates(documents, ["document"]), "documents that occur twice in a batch")
    place = F.monotonically_increasing_id()
    ordered = stage(documents.orderBy("fetched_at", "document").select(
        "document", F.shiftright(place, ROW_BITS).alias("part"),
        place.bitwiseAND(F.lit((1 << ROW_BITS) - 1)).alias("place")), warehouse.staging_path("numbered"))
    counts = ordered.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    before = counts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    return ordered.join(before, "part").select(
        "document", (F.lit(top_id + 1) + F.col("before") + F.col("place")).alias("response_id"))


def _high_water(warehouse: Warehouse) -> tuple[int, datetime | None]:
    """Largest id and landing time. Both grow, so the newest date has them."""
    newest = warehouse.partition_days("responses", "ingest_date").agg(F.max("ingest_date"))
    day = newest.first()[0]
    if day is None:
        return 0, None
    top = (warehouse.read("responses").filter(F.col("ingest_date") == F.lit(day))
           .agg(F.max("response_id").alias("id"),
                F.max("ingested_at").cast("string").alias("at")).first())
    if top["id"] is None:
        return 0, None
    return top["id"], datetime.fromisoformat(top["at"])


def newest_first(responses: DataFrame, limit: int) -> DataFrame:
    """The last `limit` responses landed (a top-k report)."""
    return responses.orderBy(F.desc("ingested_at"), F.desc("response_id")).limit(limit)


def covering(responses: DataFrame, day: date | Column) -> DataFrame:
    """Responses whose requested window contains a day."""
    at = day if isinstance(day, Column) else F.lit(day).cast("date")
    return responses.filter((F.col("window_start") <= at) & (F.col("window_end") >= at))


def digest_counts(responses: DataFrame, digest: str = "payload_sha256") -> DataFrame:
    """How often each body arrived."""
    return responses.groupBy(digest).agg(F.count(F.lit(1)).alias("copies"))
