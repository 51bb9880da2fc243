"""Benchmark decontamination by pigeonhole edit matching.

Contract. Texts and test items are compared lower-cased, with every run of
white space as one space and none at the ends. A document holds an item if
some passage of its text is within the item's error budget, which is
`ERROR_SHARE` of the item's code points, rounded down. The item is cut into
budget + 1 pieces; a passage within the budget holds one of them unchanged, so
exact hits of pieces (Aho-Corasick) give every place to look at, and Myers'
bit-parallel distance decides. Items without letters or digits (null, empty,
signs only) are in no document, nor is anything in a null or empty text.
Items with equal text are all reported; repeated rows and ids of documents are
judged one by one; empty tables give no match. Further columns of documents
are kept by the filter and ignored by the search.

Items go to the tasks in blocks of bounded size, one pass over the documents
for each; a benchmark of some thousand items is one block.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourly_star.llm.common import Scratch, map_rows, running_total, table

ERROR_SHARE = 0.08
BLOCK_CHARS = 4_000_000  # code points of items that one automaton holds


def normal(text: str | None) -> str:
    return " ".join((text or "").lower().split())


def best_distance(pattern: str, text: str) -> int:
    """Least edit distance between the pattern and any passage of the text (Myers 1999)."""
    m = len(pattern)
    masks: dict[str, int] = {}
    for i, c in enumerate(pattern):
        masks[c] = masks.get(c, 0) | 1 << i
    top, full = 1 << (m - 1), (1 << m) - 1
    plus, minus, score = full, 0, m
    best = m
    for c in text:
        eq = masks.get(c, 0)
        vertical = eq | minus
        horizontal = (((eq & plus) + plus) ^ plus) | eq
        up = minus | (full & ~(horizontal | plus))
        down = plus & horizontal
        if up & top:
            score += 1
        elif down & top:
            score -= 1
            if score < best:
                best = score
        up = up << 1 & full  # a passage may start anywhere: no cost carried in
        down = down << 1 & full
        plus = down | (full & ~(vertical | up))
        minus = up & vertical
    return best


class Item(NamedTuple):
    item_id: int | None
    text: str
    budget: int


def pieces_of(text: str, budget: int) -> list[tuple[int, str]]:
    """budget + 1 pieces that make up the text, with their offsets."""
    cuts = [len(text) * i // (budget + 1) for i in range(budget + 2)]
    return [(a, text[a:b]) for a, b in zip(cuts, cuts[1:])]


class Matcher:
    """Finds the items of one block in texts."""

    def __init__(self, items: list[tuple[int | None, str | None]]):
        self.items = []
        for item_id, text in items:
            text = normal(text)
            if any(c.isalnum() for c in text):
                self.items.append(Item(item_id, text, int(len(text) * ERROR_SHARE)))
        places: dict[str, list[tuple[int, int]]] = {}
        for number, item in enumerate(self.items):
            for offset, piece in pieces_of(item.text, item.budget):
                places.setdefault(piece, []).append((number, offset))
        self.automaton = ahocorasick.Automaton()
        for piece, where in places.items():
            self.automaton.add_word(piece, (len(piece), where))
        if places:
            self.automaton.make_automaton()

    def matches(self, text: str | None, first_only: bool = False) -> list[tuple[int | None, int]]:
        """(item_id, distance) of every item the text holds."""
        if not self.items or not text:
            return []
        text = normal(text)
        starts: dict[int, set[int]] = {}
        for end, (length, where) in self.automaton.iter(text):
            for number, offset in where:
                starts.setdefault(number, set()).add(end - length + 1 - offset)
        found = []
        for number, candidates in starts.items():
            distance = self._distance(self.items[number], text, sorted(candidates))
            if distance is not None:
                found.append((self.items[number].item_id, distance))
                if first_only:
                    break
        return found

    @staticmethod
    def _distance(item: Item, text: str, starts: list[int]) -> int | None:
        if any(text.startswith(item.text, s) for s in starts if s >= 0):
            return 0
        best = None
        reach = len(item.text) + item.budget
        low = high = None
        for s in [*starts, None]:
            if high is not None and (s is None or s - item.budget > high):
                distance = best_distance(item.text, text[low:high])
                if distance <= item.budget and (best is None or distance < best):
                    best = distance
                low = high = None
            if s is not None:
                low = max(0, s - item.budget) if low is None else low
                high = s + reach
        return best


def blocks(spark: SparkSession, benchmark: DataFrame) -> Iterator[list[tuple[int | None, str | None]]]:
    """The items in lists of at most BLOCK_CHARS code points (or one item)."""
    sized = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string"),
                             (F.length(F.coalesce("text", F.lit(""))) + 1).cast("long").alias("chars"))
    total = sized.agg(F.sum("chars")).first()[0] or 0
    if total <= BLOCK_CHARS:
        yield [(r[0], r[1]) for r in sized.collect()] if total else []
        return
    scratch = Scratch(spark, "benchmark")
    placed = running_total(scratch, sized, [], ["item_id", "text"], "chars", "before").withColumn(
        "block", F.expr(f"before div {BLOCK_CHARS}"))
    for block in range(total // BLOCK_CHARS + 1):
        rows = placed.where(F.col("block") == block).select("item_id", "text").collect()
        if rows:
            yield [(r[0], r[1]) for r in rows]


def contaminations(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, distance) for every document and item it holds."""
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    schema = "doc_id long, item_id long, distance int"
    found = spark.createDataFrame([], schema)
    for items in blocks(spark, benchmark):
        shared = spark.sparkContext.broadcast(items)  # at most BLOCK_CHARS code points

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            matcher = Matcher(shared.value)
            for batch in batches:
                rows = [(doc_id, *match) for doc_id, text in zip(*(c.to_pylist() for c in batch.columns))
                        for match in matcher.matches(text)]
                columns = zip(*rows) if rows else ([], [], [])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(c), t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.int32()))],
                    ["doc_id", "item_id", "distance"])

        found = found.union(map_rows(texts, schema, run))
    return found


def without_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that hold no item, all columns as they were."""
    at = docs.columns.index("text")
    for items in blocks(docs.sparkSession, benchmark):
        shared = docs.sparkSession.sparkContext.broadcast(items)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            matcher = Matcher(shared.value)
            for batch in batches:
                clean = [not matcher.matches(t, first_only=True) for t in batch.column(at).to_pylist()]
                yield batch.filter(pa.array(np.array(clean, bool)))

        docs = map_rows(docs, docs.schema, run)
    return docs


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminations(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {"op3_decontaminate": op3_decontaminate}
ORACLES = {}
