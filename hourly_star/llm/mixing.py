"""Mixing sources to target weights by a low-discrepancy schedule.

Contract. The size of a document is its number of words between ASCII white
space (null text: 0). Sources, in the order of their code points with null
last, weigh 3, 1, 2 and so on; together they share `SHARE` times all sizes, no
source more than `REPEATS` times its own size, the excess going to the others
by weight. `taken` is how many words of a document the mix takes, repeats
counted; it is at most `REPEATS` times the size. Documents without words take
part with nothing taken. Equal rows stay separate rows and may differ in
`taken`. An empty table gives an empty result; other columns are ignored by
the query and kept by the stage.

Method. The words of a source, its documents in shuffled order, are cut into
blocks of equal length (`BLOCK` words or a little less). Each slot i of the mix
has a point, the fractional part of i * golden ratio; the slots in the order of
their points are dealt to the sources, to each as many as it wants. The r-th
slot of a source takes block r of its shuffled blocks, starting over after the
last one, `REPEATS` times at most; its last slot takes only the words the target,
rounded to whole words, still lacks. As the points spread evenly, every stretch
of the mix has all sources near their weights.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hourly_star.llm.common import (
    WHITE_SPACE,
    Scratch,
    bucketed_join,
    running_total,
    table,
    word_count,
)

WEIGHTS = (3, 1, 2)
SHARE = Decimal("1.5")
REPEATS = 2
BLOCK = 128
CHUNK = 1 << 16  # slots that are numbered together
POINTS = 1 << 52  # points are whole numbers below this
GOLDEN = 2_783_366_279_640_671  # the fraction of the golden ratio times POINTS
SEED = 1_618


def targets(scratch: Scratch, sizes: DataFrame) -> DataFrame:
    """(source, source_size, weight, target): one row for each source.

    `sizes` has (source, size) of every document. Targets are the least of cap
    and weight times level; the level rises as sources reach their cap, with
    one aggregate over the sources for each step.
    """
    sums = scratch.keep(sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
                        .withColumn("last", F.col("source").isNull()).withColumn("one", F.lit(1)))
    placed = running_total(scratch, sums, [], ["last", "source"], "one", "place")
    weights = F.array(*[F.lit(w) for w in WEIGHTS])
    weighted = scratch.keep(placed.select(
        "source", "source_size", weights[(F.col("place") % len(WEIGHTS)).cast("int")].alias("weight")))
    total = weighted.agg(F.sum("source_size")).first()[0] or 0
    level, cap = 0.0, F.col("source_size") * REPEATS
    while total:
        capped = cap <= F.col("weight") * F.lit(level)
        held, free = weighted.agg(F.sum(F.when(capped, cap)), F.sum(F.when(~capped, F.col("weight")))).first()
        if not free:
            break
        higher = float((Decimal(total) * SHARE - (held or 0)) / Decimal(free))
        if higher <= level:
            break
        level = higher
    return weighted.withColumn("target", F.least(cap.cast("double"), F.col("weight") * F.lit(level)))


def _point(slot: Column) -> Column:
    """The slot's point in whole numbers below `POINTS`; no two slots share one."""
    point = slot.cast("decimal(20,0)") * F.lit(GOLDEN).cast("decimal(17,0)") % F.lit(POINTS).cast("decimal(38,0)")
    return point.cast("long")


def schedule(scratch: Scratch, shares: DataFrame) -> DataFrame:
    """(slot, source, rank): the source of every slot and its running number there.

    `shares` has (source, slots wanted) with as many rows as sources.
    """
    spark = shares.sparkSession
    total = int(shares.agg(F.sum("wanted")).first()[0] or 0)
    ordered = shares.where("wanted > 0").withColumn("last", F.col("source").isNull())
    parts = running_total(scratch, ordered, [], ["last", "source"], "wanted", "low")
    parts = parts.select("source", F.col("low"), (F.col("low") + F.col("wanted")).alias("high"))
    cells = max(1, 2 * parts.count())
    width = max(1, -(-total // cells))
    by_cell = parts.select("source", "low", "high", F.explode(F.sequence(
        F.expr(f"low div {width}"), F.expr(f"(high - 1) div {width}"))).alias("cell"))
    points = spark.range(total).select(F.col("id").alias("slot"), _point(F.col("id")).alias("point"),
                                       F.lit(1).alias("one"))
    slots = running_total(scratch, points, [], ["point"], "one", "at").select("slot", "at")
    owned = scratch.keep(slots.withColumn("cell", F.expr(f"at div {width}")).join(by_cell, "cell")
                         .where("low <= at AND at < high")
                         .select("slot", "source", F.expr(f"slot div {CHUNK}").alias("chunk")))
    before = Window.partitionBy("source").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    counts = owned.groupBy("source", "chunk").agg(F.count("*").alias("n")).withColumn(
        "before", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    within = Window.partitionBy("source", "chunk").orderBy("slot")
    return bucketed_join(owned.withColumn("within", F.row_number().over(within) - 1), counts,
                         ["source", "chunk"]).select(
        "slot", "source", (F.col("before") + F.col("within")).alias("rank"))


def mixture(spark: SparkSession, docs: DataFrame, scratch: Scratch | None = None,
            row: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """The documents with their sizes, and the mix as parts of documents.

    The first has (row, doc_id, source, size, source_size, target), the second
    (slot, source, row, first_word, n_words) in slots of nearly equal length.
    """
    scratch = scratch or Scratch(spark, "mix")
    sizes = scratch.keep(docs.select(
        (F.monotonically_increasing_id() if row is None else row).alias("row"), F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").cast("string").alias("source"), word_count(F.col("text")).alias("size"),
        F.xxhash64(F.lit(SEED), F.col("doc_id").cast("long"), F.xxhash64("text")).alias("mixed")))
    goals = scratch.keep(targets(scratch, sizes).withColumn(
        "blocks", F.ceil(F.col("source_size") / BLOCK).cast("long")).withColumn(
        "goal", F.round("target").cast("long")).withColumn(
        # words of the last pass, and slots up to the block of its last word
        "upto", F.expr("if(goal > 0, (goal - 1) % source_size + 1, 0)")).withColumn(
        "wanted", F.expr("if(goal > 0, (goal - 1) div source_size * blocks + 1"
                         " + cast(cast(upto - 1 AS decimal(38,0)) * blocks div source_size AS long), 0)")))
    placed = running_total(scratch, sizes.where("size > 0"), ["source"], ["mixed", "doc_id", "row"],
                           "size", "start")
    placed = bucketed_join(placed.select("row", "source", "size", "start"),
                           goals.select("source", "source_size", "blocks"), ["source"])
    # block b of a source covers its words from ceil(b * size / blocks) on
    parts = placed.select("row", "source", "start", "size", "source_size", "blocks", F.explode(F.sequence(
        F.expr("cast(cast(start AS decimal(38,0)) * blocks div source_size AS long)"),
        F.expr("cast(cast(start + size - 1 AS decimal(38,0)) * blocks div source_size AS long)"))).alias("block"))
    edge = "cast((cast({b} AS decimal(38,0)) * source_size + blocks - 1) div blocks AS long)"
    parts = parts.select(
        "row", "source", "block", "start",
        (F.greatest(F.expr(edge.format(b="block")), F.col("start")) - F.col("start")).alias("first_word"),
        (F.least(F.expr(edge.format(b="block + 1")), F.col("start") + F.col("size"))
         - F.greatest(F.expr(edge.format(b="block")), F.col("start"))).alias("n_words")).where("n_words > 0")
    slots = bucketed_join(schedule(scratch, goals.select("source", "wanted")),
                          goals.select("source", "blocks", "wanted", "upto"), ["source"])
    slots = slots.select("slot", "source", F.expr("rank % blocks").alias("block"),
                         F.expr("if(rank = wanted - 1, upto, null)").alias("upto"))
    mix = bucketed_join(slots, parts, ["source", "block"]).select(
        "slot", "source", "row", "first_word",
        F.least("n_words", F.col("upto") - F.col("start") - F.col("first_word")).alias("n_words")).where("n_words > 0")
    return bucketed_join(sizes.drop("mixed"), goals.select("source", "source_size", "target"),
                         ["source"]), mix


def taken_words(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """(doc_id, size, source_size, target, taken) for every row."""
    scratch = Scratch(spark, "mix")
    sized, mix = mixture(spark, docs, scratch)
    taken = mix.groupBy("row").agg(F.sum("n_words").alias("taken"))
    return bucketed_join(sized, taken, ["row"], "left").select(
        "doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))


def mixed(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """The documents as often as the mix takes them, whole, all columns as they were.

    The mix ends inside one document of a source; that one is taken once more
    or not by which is nearer the target. Columns may have any names.
    """
    scratch = Scratch(spark, "mix")
    numbered = scratch.keep(docs.select(F.struct("*").alias("doc"), F.monotonically_increasing_id().alias("row")))
    sized, mix = mixture(spark, numbered.select("row", "doc.doc_id", "doc.source", "doc.text"), scratch, F.col("row"))
    taken = mix.groupBy("row").agg(F.sum("n_words").alias("taken"))
    times = F.expr("cast(taken div size + if(2 * (taken % size) >= size, 1, 0) AS int)")
    counts = sized.join(taken, "row").select("row", F.explode(F.array_repeat(F.lit(True), times)).alias("copy"))
    return numbered.join(counts, "row").select("doc.*")


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return taken_words(spark, table(spark, sf_dir, "documents"))


QUERIES = {"op9_mixing": op9_mixing}
ORACLES = {}
