"""Incremental tables driven by a change watermark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourly_star.functions.predicates import differs
from hourly_star.operators.upsert import in_days
from hourly_star.session import stage
from hourly_star.sources.tables import Warehouse, by_partition

BEGINNING = "1900-01-01 00:00:00"


def watermark(target: DataFrame, column: str = "source_loaded_at") -> str:
    """Newest change the target has seen, as UTC text; the beginning if it is empty."""
    newest = target.agg(F.coalesce(F.max(column), F.lit(BEGINNING).cast("timestamp"))
                        .cast("string").alias("newest"))
    return newest.first()["newest"]


def changed_since(df: DataFrame, mark: str, column: str = "loaded_at") -> DataFrame:
    """Rows changed at or after the mark.

    At the mark too, as rows of one batch share a time stamp and writing a row
    twice does no harm. The mark is a literal, so it reaches the file scan.
    """
    return df.filter(F.col(column) >= F.lit(mark).cast("timestamp"))


def pending(warehouse: Warehouse, consumed: int) -> tuple[DataFrame, str, int]:
    """Days in the change log after entry `consumed`, the earliest load time on them, the last entry.

    What to look at follows from the log alone: neither the table that is
    brought up to date nor the readings are scanned for it.
    """
    entries = warehouse.read("reading_changes").filter(F.col("seq") > F.lit(consumed))
    since, last = entries.agg(F.min("since").cast("string"), F.max("seq")).first()
    return entries.select("utc_date").distinct(), since or BEGINNING, last or consumed


def delete_insert(target: DataFrame, batch: DataFrame, keys: list[str]) -> DataFrame:
    """Target without the keys of the batch, plus the batch.

    Columns only one of the two has are kept and read as NULL in the other.
    """
    return (target.join(batch.select(*keys), keys, "left_anti")
            .unionByName(batch, allowMissingColumns=True))


def news(target: DataFrame, batch: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of the batch the target does not hold in just this form.

    The inclusive watermark brings rows back that were written before. Leaving
    them out changes no result and keeps their days from being rewritten.
    """
    others = [c for c in target.columns if c not in keys]
    held = target.select(*keys, F.struct(*others).alias("held"))
    changed = F.col("held").isNull()
    for c in others:
        changed = changed | differs(F.col("held")[c], F.col(c))
    return batch.join(held, keys, "left").filter(changed).select(*batch.columns)


def compared(target: DataFrame, batch: DataFrame, keys: list[str]) -> DataFrame:
    """Target and batch in one join: all rows as they are after the merge.

    `arrived` marks rows of the batch, `is_news` those the target does not hold
    in just this form. Keys are unique on either side.
    """
    others = [c for c in target.columns if c not in keys]
    held = target.select(*keys, *[F.col(c).alias(f"held_{c}") for c in others], F.lit(True).alias("held"))
    new = batch.select(*keys, *others, F.lit(True).alias("arrived"))
    arrived, changed = F.col("arrived").isNotNull(), F.col("held").isNull()
    for c in others:
        changed = changed | differs(F.col(f"held_{c}"), F.col(c))
    is_news = arrived & changed
    return new.join(held, keys, "full_outer").select(
        *keys, *[F.when(arrived, F.col(c)).otherwise(F.col(f"held_{c}")).alias(c) for c in others],
        arrived.alias("arrived"), is_news.alias("is_news"))


def merge(warehouse: Warehouse, table: str, batch: DataFrame, keys: list[str],
          part: str = "utc_date") -> int:
    """Delete+insert on the days with news; returns the number of rows written."""
    return merge_counted(warehouse, table, batch, keys, part)[1]


def merge_counted(warehouse: Warehouse, table: str, batch: DataFrame, keys: list[str],
                  part: str = "utc_date", days: DataFrame | None = None) -> tuple[int, int]:
    """`merge` that returns the number of rows read, too.

    The days of the batch are read once and joined once. The rows they leave
    are written to the shared folder; what follows reads that copy, and of its
    days only those with news are replaced. `days`, if known, are days that
    hold all rows of the batch.
    """
    warehouse.add_columns(table, batch)
    target = warehouse.read(table)
    gone = [f for f in target.schema if f.name not in batch.columns]
    batch = batch.withColumns({f.name: F.lit(None).cast(f.dataType) for f in gone})
    if days is None:
        days = batch.select(part).distinct()
    after = stage(compared(in_days(target, days, part), batch, keys), warehouse.staging_path(f"merge_{table}"))
    found = after.groupBy(part).agg(F.count_if("arrived").alias("read"), F.count_if("is_news").alias("written"))
    per_day = stage(found, warehouse.staging_path(f"merged_days_{table}"))
    read, written = per_day.agg(F.coalesce(F.sum("read"), F.lit(0)), F.coalesce(F.sum("written"), F.lit(0))).first()
    if written:
        rows = in_days(after, per_day.filter("written > 0").select(part), part).select(*target.columns)
        warehouse.replace_partitions(table, by_partition(rows, part, *keys))
    return read, written


def drift(rebuilt: DataFrame, kept: DataFrame) -> DataFrame:
    """Rows in which an incremental table differs from a full rebuild."""
    columns = rebuilt.columns
    kept = kept.select(*columns)
    return (rebuilt.exceptAll(kept).withColumn("side", F.lit("rebuilt"))
            .unionByName(kept.exceptAll(rebuilt).withColumn("side", F.lit("kept"))))
