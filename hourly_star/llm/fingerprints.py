"""Document fingerprints: weighted SimHash, and a search by permuted block tables.

Contract. A text (null: empty) is lower-cased (A-Z only) and cut into words at
ASCII white space. Its terms are pairs of neighbouring words, with the two
ends as neighbours too; a term that occurs c times weighs 1 + ln c in steps of
1/16. Every term's hash votes with its weight on `BITS` signed sums; a bit of
the fingerprint is 1 where the sum is above zero. A text without words has
fingerprint zero. Equal texts have equal fingerprints, on any machine, as all
sums are exact. The likeness of two fingerprints is the share of equal bits:
about 0.5 for unrelated texts, 1 for equal ones.

The edited text of a document replaces its last floor(n_chars / 2) code points
by the first as many (or all) of the next document in the order of doc_id,
null last, rows of one doc_id by a hash of their text; after the last comes
the first. `n_links` counts the other fingerprints in the table that differ in
at most `RADIUS` bits. Repeated rows stay separate rows; an empty table gives
an empty result; other columns are ignored.

Method. Documents are sorted by ranges of doc_id; a task meets each document
with its successor, and only the last of a range waits for the first of the
next, as one row for each range. For the search, different fingerprints are
cut into RADIUS + 1 blocks of bits: two within the radius agree in one block
at least. Table t is keyed by block t; a bucket with more than `BUCKET`
fingerprints is compared part by part. A pair is counted in the first table
that brings it together, so that only counts leave a bucket, never pairs.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hourly_star.llm.common import Scratch, bucketed_join, map_rows, table
from hourly_star.session import prepare

BITS = 256
RADIUS = 7
BUCKET = 16_384  # fingerprints compared with each other in one group
STEPS = 16  # weights are whole numbers of 1/16
SLICE = 1 << 18  # bytes of a text cut into words at a time
BLOCK = 4_096  # terms that vote at a time; their sums are exact in 32-bit floats
SPACE = re.compile(rb"[\x20\x09-\x0D]")
EDGE = np.array([0x9E3779B97F4A7C15], np.uint64)  # the neighbour of the first and the last word


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _word_hashes(text: str) -> np.ndarray:
    data, digest, parts, start = text.encode("utf-8", "surrogatepass"), xxhash.xxh64_intdigest, [], 0
    while start < len(data):
        stop = start + SLICE
        if stop < len(data):  # not within a word
            end = SPACE.search(data, stop)
            stop = end.start() if end else len(data)
        parts.append(np.array([digest(w) for w in data[start:stop].lower().split()], np.uint64))
        start = stop
    return np.concatenate(parts) if parts else np.zeros(0, np.uint64)


def fingerprint(text: str | None) -> np.ndarray:
    """The fingerprint of a text as BITS / 64 unsigned numbers."""
    words = _word_hashes(text or "")
    if not len(words):
        return np.zeros(BITS // 64, np.uint64)
    words = np.concatenate([EDGE, words, EDGE])
    terms, counts = np.unique(_mixed(words[:-1] * np.uint64(3) + words[1:]), return_counts=True)
    weights = np.round(STEPS * (1 + np.log(counts))).astype(np.float32)
    lanes = np.arange(1, BITS // 64 + 1, dtype=np.uint64) * EDGE
    votes = np.zeros(BITS)
    for start in range(0, len(terms), BLOCK):
        hashes = _mixed(terms[start:start + BLOCK, None] + lanes[None, :])
        bits = np.unpackbits(hashes.view(np.uint8), axis=1, bitorder="little").astype(np.float32)
        votes += weights[start:start + BLOCK] @ bits
    return np.packbits(2 * votes > weights.sum(dtype=np.float64), bitorder="little").view(np.uint64)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    return 1 - int(np.bitwise_count(a ^ b).sum()) / BITS


def edited_text(text: str, following: str) -> str:
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


RESULT = ("doc_id long, n_chars long, edited_sha256 string, fp binary, edited_fp binary, "
          "near_edited double, near_next double")
WAITING = "kind int, part int, text string"  # kind 0: a result; 1: the last, 2: the first of a range


def _result(doc_id: int | None, text: str, own: np.ndarray, following: str, next_fp: np.ndarray) -> tuple:
    edited = edited_text(text, following)
    edited_fp = fingerprint(edited)
    return (doc_id, len(text), hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(), own.tobytes(),
            edited_fp.tobytes(), likeness(own, edited_fp), likeness(own, next_fp))


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, schema.types)], schema=schema)


_FIELDS = [("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fp", pa.binary()),
           ("edited_fp", pa.binary()), ("near_edited", pa.float64()), ("near_next", pa.float64())]
_DONE = pa.schema(_FIELDS)
_ALL = pa.schema([*_FIELDS, ("kind", pa.int32()), ("part", pa.int32()), ("text", pa.string())])


def _along(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Results of all rows of a range but the last, which waits with the first."""
    part, before = TaskContext.get().partitionId(), None
    for batch in batches:
        rows = []
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            own = fingerprint(text)
            if before is None:
                rows.append((doc_id, len(text), None, own.tobytes(), None, None, None, 2, part, text))
            else:
                rows.append((*_result(*before, text, own), 0, part, None))
            before = (doc_id, text, own)
        yield _batch(rows, _ALL)
    if before is not None:
        doc_id, text, own = before
        yield _batch([(doc_id, len(text), None, own.tobytes(), None, None, None, 1, part, text)], _ALL)


def _across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Results of rows that waited, beside the first of the next range."""
    for batch in batches:
        yield _batch([_result(doc_id, text, np.frombuffer(fp, np.uint64), following, np.frombuffer(next_fp, np.uint64))
                      for doc_id, text, fp, following, next_fp in zip(*[c.to_pylist() for c in batch.columns])], _DONE)


def with_edits(scratch: Scratch, docs: DataFrame) -> DataFrame:
    """`RESULT` for every row."""
    ordered = [F.col("doc_id").asc_nulls_last(), F.col("mark"), F.col("row")]
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
                       F.monotonically_increasing_id().alias("row")).withColumn("mark", F.xxhash64("text"))
    dealt = rows.repartitionByRange(*ordered).sortWithinPartitions(*ordered).select("doc_id", "text")
    made = scratch.keep(map_rows(dealt, f"{RESULT}, {WAITING}", _along))
    first = made.where("kind = 2").select(F.col("part").alias("next_part"), F.col("text").alias("following"),
                                          F.col("fp").alias("next_fp"))
    by_part = Window.orderBy("part")  # one row for each range that has rows
    ring = made.where("kind = 2").select("part").select(
        "part", F.coalesce(F.lead("part").over(by_part),
                           F.min("part").over(by_part.rowsBetween(Window.unboundedPreceding, 0))).alias("next_part"))
    waiting = made.where("kind = 1").join(ring, "part").join(first, "next_part").select(
        "doc_id", "text", "fp", "following", "next_fp")
    fields = [name for name, _ in _FIELDS]
    return scratch.keep(made.where("kind = 0").select(*fields).union(map_rows(waiting, RESULT, _across)))


def blocks(radius: int = RADIUS) -> list[tuple[int, int]]:
    """(start, stop) of the bits of radius + 1 blocks, as equal as can be."""
    edges = [i * BITS // (radius + 1) for i in range(radius + 2)]
    return list(zip(edges, edges[1:]))


def _masks(radius: int) -> np.ndarray:
    bits = np.zeros((radius + 1, BITS), np.uint8)
    for t, (start, stop) in enumerate(blocks(radius)):
        bits[t, start:stop] = 1
    return np.packbits(bits, axis=1, bitorder="little").view(np.uint64)


def _deal(prints: DataFrame, radius: int) -> DataFrame:
    """(t, key, fp): every fingerprint once in each table, keyed by the bits of the table's block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.column(0)
            bits = np.unpackbits(np.frombuffer(b"".join(own.to_pylist()), np.uint8).reshape(-1, BITS // 8), axis=1,
                                 bitorder="little")
            for t, (start, stop) in enumerate(blocks(radius)):
                if stop - start <= 62:
                    keys = bits[:, start:stop].astype(np.int64) @ (np.int64(1) << np.arange(stop - start, dtype=np.int64))
                else:  # wide blocks by a hash: a bucket may then hold more than its block's fingerprints
                    keys = np.array([xxhash.xxh64_intdigest(row.tobytes()) for row in bits[:, start:stop]],
                                    np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(own), t, np.int32)), pa.array(keys), own],
                                                 ["t", "key", "fp"])

    return map_rows(prints.select("fp"), "t int, key long, fp binary", run)


def _count(x: np.ndarray, t: int, masks: np.ndarray, radius: int) -> np.ndarray:
    """Which differences are within the radius and agree in block t but in none before."""
    near = np.bitwise_count(x).sum(axis=1) <= radius
    rows = np.nonzero(near)[0]
    if len(rows):
        new = (x[rows, None, :] & masks[None, :t, :]).any(axis=2).all(axis=1)
        new &= ~(x[rows] & masks[t]).any(axis=1)
        near[rows] = new
    return near


def count_links(fps: np.ndarray, part: np.ndarray, t: int, masks: np.ndarray, radius: int) -> np.ndarray:
    """Links of each fingerprint of a group, to all others of one part or to those of the other part."""
    links = np.zeros(len(fps), np.int64)
    if part.min() == part.max():
        for i in range(len(fps) - 1):
            near = _count(fps[i + 1:] ^ fps[i], t, masks, radius)
            links[i] += near.sum()
            links[i + 1:] += near
        return links
    left, right = np.nonzero(part == part.min())[0], np.nonzero(part == part.max())[0]
    for i in left:
        near = _count(fps[right] ^ fps[i], t, masks, radius)
        links[i] += near.sum()
        links[right] += near
    return links


def links_within(scratch: Scratch, prints: DataFrame, radius: int = RADIUS, bucket: int = BUCKET) -> DataFrame:
    """(fp, n_links) for every different fingerprint that has others within the radius; `prints` has them once."""
    dealt = scratch.keep(_deal(prints, radius))
    sizes = scratch.keep(dealt.groupBy("t", "key").agg(F.count("*").alias("n")).where("n > 1"))
    parts = F.ceil(F.col("n") / bucket).cast("int")
    shared = dealt.join(sizes, ["t", "key"]).withColumn("parts", parts).withColumn(
        "part", F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int"))
    # a part meets itself and each other part once
    met = shared.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).select(
        "t", "key", F.least("part", "other").alias("low"), F.greatest("part", "other").alias("high"),
        F.struct("part", "fp").alias("one"))
    groups = met.groupBy("t", "key", "low", "high").agg(F.collect_list("one").alias("own"))
    masks = _masks(radius)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for t, low, high, own in zip(*[batch.column(i).to_pylist() for i in (0, 1, 2)], batch.column(3)):
                part = np.asarray(own.values.field(0))
                if low != high and part.min() == part.max():
                    continue  # one of the parts is empty
                prints = own.values.field(1).to_pylist()
                fps = np.frombuffer(b"".join(prints), np.uint64).reshape(-1, BITS // 64)
                links = count_links(fps, part, t, masks, radius)
                rows = np.nonzero(links)[0]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([prints[i] for i in rows], pa.binary()), pa.array(links[rows])], ["fp", "links"])

    found = map_rows(groups.select("t", "low", "high", "own"), "fp binary, links long", run)
    return scratch.keep(found.groupBy("fp").agg(F.sum("links").alias("n_links")))


def document_fingerprints(spark: SparkSession, docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """One row for every document; see the head of the module."""
    scratch = Scratch(prepare(spark), "fingerprints")
    rows = with_edits(scratch, docs)
    links = links_within(scratch, scratch.keep(rows.select("fp").distinct()), radius)
    return bucketed_join(rows, links, ["fp"], "left").select(
        "doc_id", "n_chars", "edited_sha256", F.lower(F.hex("fp")).alias("fingerprint"),
        F.lower(F.hex("edited_fp")).alias("edited_fingerprint"), "near_edited", "near_next",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))


def op12_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return document_fingerprints(spark, table(spark, sf_dir, "documents"))


QUERIES = {"op12_fingerprints": op12_fingerprints}
ORACLES = {}
