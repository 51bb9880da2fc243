"""Many submissions of the same reading folded as if they were upserted in turn.

A reading may have been submitted any number of times, so no step gathers all
submissions of one reading. They are cut into segments of consecutive response
ids first; a response submits a reading at most once, which bounds a segment.
Each segment is reduced to one row, and only those rows meet per reading.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hourly_star.functions.predicates import differs
from hourly_star.schemas import READING_KEY

# Response ids per segment.
SEGMENT = 1 << 18

KEY = list(READING_KEY)

INSERTED, UPDATED, UNCHANGED = "I", "U", "N"


def _changed(before: str, after: str) -> Column:
    a, b = F.col(before), F.col(after)
    return differs(a["value"], b["value"]) | differs(a["unit"], b["unit"])


def _grouping(segment: int | None) -> list[str]:
    return KEY if segment is None else [*KEY, "segment"]


def _compared(submissions: DataFrame, segment: int | None) -> DataFrame:
    """Each submission next to the one before it in its segment."""
    group = _grouping(segment)
    w = Window.partitionBy(*group).orderBy("response_id")
    rows = submissions if segment is None else submissions.withColumn(
        "segment", F.expr(f"response_id div {segment}"))
    beside = rows.select(
        *group, "response_id", "ingested_at", "value", "unit",
        F.lag("value").over(w).alias("before_value"),
        F.lag("unit").over(w).alias("before_unit"),
        F.lag("response_id").over(w).alias("before_id"))
    moved = F.col("before_id").isNotNull() & (
        differs(F.col("before_value"), F.col("value"))
        | differs(F.col("before_unit"), F.col("unit")))
    return beside.select(*group, "response_id", "ingested_at", "before_id",
                         F.struct("value", "unit").alias("now"), moved.alias("moved"))


def _reduced(compared: DataFrame, segment: int | None) -> DataFrame:
    """One row per reading and segment. Grouped as it was compared: no shuffle."""
    origin = F.struct("response_id", "ingested_at")
    return compared.groupBy(*_grouping(segment)).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if("moved").alias("n_moved"),
        F.count_if(F.col("before_id") == F.col("response_id")).alias("n_repeated"),
        F.min_by("now", "response_id").alias("first"),
        F.min(origin).alias("first_origin"),
        F.max_by("now", "response_id").alias("last"),
        F.max(F.when(F.col("moved"), origin)).alias("moved_origin"),
    )


def _chained(reduced: DataFrame) -> DataFrame:
    """Each segment next to the end of the one before."""
    w = Window.partitionBy(*KEY).orderBy("segment")
    return (
        reduced.withColumn("earlier", F.lag("last").over(w))
        .withColumn("position", F.row_number().over(w))
        .withColumn("entered", (F.col("position") > 1) & _changed("earlier", "first"))
    )


def segment_for(n_responses: int) -> int | None:
    """None, for no segments, when so few responses cannot make a group too large."""
    return None if n_responses <= SEGMENT else SEGMENT


def collapse(submissions: DataFrame, segment: int | None = SEGMENT) -> DataFrame:
    """One row per reading: its first and last state and its last change.

    `submissions` has the key, value, unit, response_id and ingested_at. Ids
    grow with arrival, so the order of the ids is the order of the upserts.
    `n_changes` counts the changes after the first submission, and
    `n_repeated` the submissions that repeat a key within one response.
    Without segments there is one shuffle instead of two; that is for batches
    known to have few responses, see `segment_for`.
    """
    folded = _reduced(_compared(submissions, segment), segment)
    if segment is not None:
        here = F.coalesce(F.col("moved_origin"), F.when(F.col("entered"), F.col("first_origin")))
        folded = _chained(folded).groupBy(*KEY).agg(
            F.sum("n").alias("n"),
            F.sum(F.col("n_moved") + F.col("entered").cast("int")).alias("n_moved"),
            F.sum("n_repeated").alias("n_repeated"),
            F.min_by("first", "segment").alias("first"),
            F.min("first_origin").alias("first_origin"),
            F.max_by("last", "segment").alias("last"),
            F.max(here).alias("moved_origin"),
        )
    return folded.select(
        *KEY, F.col("n").alias("n_submitted"), F.col("n_moved").alias("n_changes"), "n_repeated",
        F.col("first")["value"].alias("first_value"),
        F.col("first")["unit"].alias("first_unit"),
        F.col("first_origin")["response_id"].alias("first_response_id"),
        F.col("first_origin")["ingested_at"].alias("first_ingested_at"),
        F.col("last")["value"].alias("value"),
        F.col("last")["unit"].alias("unit"),
        F.col("moved_origin")["response_id"].alias("change_response_id"),
        F.col("moved_origin")["ingested_at"].alias("change_ingested_at"),
    )


def submitted_once(submissions: DataFrame) -> bool:
    """Whether no reading is submitted twice, so that nothing has to be collapsed.

    Per series and day the hours are gathered in a mask of 24 bits next to the
    number of rows, which aggregates before the shuffle. Rows off the hour may
    be taken for a repetition, never the other way round.
    """
    hour = F.call_function("shiftleft", F.lit(1), F.hour("measured_at_utc"))
    days = submissions.groupBy("location_code", "pollutant_code", F.to_date("measured_at_utc")).agg(
        F.count(F.lit(1)).alias("n"), F.bit_count(F.bit_or(hour)).alias("n_hours"))
    return days.filter(F.col("n_hours").isNull() | (F.col("n") != F.col("n_hours"))).isEmpty()


def single(submissions: DataFrame) -> DataFrame:
    """What `collapse` returns where no reading is submitted twice, row by row."""
    now = submissions.schema
    return submissions.select(
        *KEY, F.lit(1).cast("long").alias("n_submitted"), F.lit(0).cast("long").alias("n_changes"),
        F.lit(0).cast("long").alias("n_repeated"),
        F.col("value").alias("first_value"), F.col("unit").alias("first_unit"),
        F.col("response_id").alias("first_response_id"), F.col("ingested_at").alias("first_ingested_at"),
        "value", "unit", F.lit(None).cast(now["response_id"].dataType).alias("change_response_id"),
        F.lit(None).cast(now["ingested_at"].dataType).alias("change_ingested_at"))


def fold(submissions: DataFrame, segment: int | None = SEGMENT) -> DataFrame:
    """State of the readings table after upserting all submissions in turn."""
    return collapse(submissions, segment).select(
        *KEY, "value", "unit",
        F.coalesce("change_response_id", "first_response_id").alias("source_response_id"),
        F.col("first_ingested_at").alias("first_loaded_at"),
        F.coalesce("change_ingested_at", "first_ingested_at").alias("loaded_at"),
    )


def revision_log(submissions: DataFrame, target: DataFrame | None = None,
                 segment: int = SEGMENT) -> DataFrame:
    """Every submission with what its upsert did: insert, update or nothing."""
    compared = _compared(submissions, segment)
    inner = compared.filter(F.col("before_id").isNotNull()).select(
        *KEY, "response_id", "ingested_at", "now",
        F.when(F.col("moved"), UPDATED).otherwise(UNCHANGED).alias("action"),
    )
    edges = _chained(_reduced(compared, segment)).select(
        *KEY, F.col("first_origin")["response_id"].alias("response_id"),
        F.col("first_origin")["ingested_at"].alias("ingested_at"),
        F.col("first").alias("now"), "position", "earlier", "entered",
    )
    if target is not None:
        held = target.select(*KEY, F.struct("value", "unit").alias("held"))
        edges = edges.join(held, KEY, "left")
    else:
        edges = edges.withColumn("held", F.lit(None).cast(edges.schema["now"].dataType))
    at_edge = (
        F.when(F.col("position") > 1, F.when(F.col("entered"), UPDATED).otherwise(UNCHANGED))
        .when(F.col("held").isNull(), INSERTED)
        .when(_changed("held", "now"), UPDATED)
        .otherwise(UNCHANGED)
    )
    outer = edges.select(*KEY, "response_id", "ingested_at", "now", at_edge.alias("action"))
    return inner.unionByName(outer).select(
        *KEY, "response_id", "ingested_at", F.col("now")["value"].alias("value"),
        F.col("now")["unit"].alias("unit"), "action",
    )


def revised(readings: DataFrame) -> DataFrame:
    """Readings whose value or unit changed after the first load."""
    return readings.filter(F.col("loaded_at") > F.col("first_loaded_at"))
