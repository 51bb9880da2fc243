"""SimHash near-duplicates by covering locality-sensitive hashing.

Contract. A text is lower-cased (A-Z only) and cut into words at ASCII white
space; its fingerprint has bit i set if over half the XXH64 values of its
three-word shingles, repeats included, have it set. A text of one or two words
is one shingle; a null, empty or blank text has fingerprint zero and is linked
like any other. Fingerprints that differ in at most three bits are linked;
`component_id` is the least doc_id that links reach. A row whose doc_id is
null takes part and gets the least known doc_id (null if there is none);
repeated rows are returned as often as they come; an empty table gives an
empty result; further columns of the input are ignored.

Candidates. For radius r, every bit position gets a nonzero vector of r + 1
bits; table v keeps the positions whose vector has an odd product with v. The
vectors of r differing positions leave some v with even products only, so
every pair within the radius agrees in some of the 2^(r+1) - 1 tables. A
bucket with more than `BUCKET` different fingerprints is not compared as it
is: its fingerprints agree in the kept bits, so the same construction over the
bits left free deals them out again. After three such steps a bucket has at
most as many fingerprints as its few free bits can express.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourly_star.llm.common import Scratch, bucketed_join, map_rows, table
from hourly_star.llm.components import connected_components

WORDS = 3
RADIUS = 3
SEED = 42
BITS = 64
BUCKET = 2_048  # fingerprints that one task compares with each other
BLOCK = 65_536  # shingles hashed at a time, whatever the length of the text


def fingerprint(text: str | None, words: int = WORDS, seed: int = SEED) -> int:
    """The unsigned 64-bit SimHash of a text."""
    tokens = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not tokens:
        return 0
    if len(tokens) < words:
        return xxhash.xxh64_intdigest(b" ".join(tokens), seed)
    digest, join = xxhash.xxh64_intdigest, b" ".join
    total = len(tokens) - words + 1
    ones = np.zeros(BITS, np.int64)
    for start in range(0, total, BLOCK):
        stop = min(start + BLOCK, total)
        shingles = zip(*[tokens[start + i:stop + i] for i in range(words)])
        hashes = np.array([digest(join(s), seed) for s in shingles], np.uint64)
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > total, bitorder="little").view(np.uint64)[0])


def with_fingerprints(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """(doc_id, fp): the fingerprint as a signed long, for every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = np.array([fingerprint(t, words) for t in batch.column(1).to_pylist()],
                              np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints.view(np.int64))],
                                             ["doc_id", "fp"])

    return map_rows(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")),
                    "doc_id long, fp long", run)


def covering_masks(positions: tuple[int, ...], radius: int = RADIUS) -> list[int]:
    """One mask for each table, over the given bit positions."""
    size = 2 ** (radius + 1)
    masks = []
    for v in range(1, size):
        mask = 0
        for i, position in enumerate(positions):
            if bin((1 + i % (size - 1)) & v).count("1") % 2:
                mask |= 1 << position
        masks.append(mask)
    return masks


def _signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >= 1 << (BITS - 1) else mask


def _free(kept: int) -> tuple[int, ...]:
    return tuple(i for i in range(BITS) if not kept >> i & 1)


def _deal(prints: DataFrame, kept: list[int], radius: int) -> DataFrame:
    """(kept, bucket, fp) for every fingerprint and table of the masks it is dealt by.

    `kept` is the bits a bucket of the step before agreed in; a table's mask
    adds bits to them.
    """
    tables = {k: [k | mask for mask in covering_masks(_free(k), radius)] for k in kept}
    literals = {k: F.array(*[F.lit(_signed(m)) for m in masks]) for k, masks in tables.items()}
    if kept == [0]:
        dealt = prints.select("fp", F.explode(literals[0]).alias("kept"))
    else:
        by_kept = F.create_map(*[x for k, masks in literals.items() for x in (F.lit(_signed(k)), masks)])
        dealt = prints.select("fp", F.explode(by_kept[F.col("kept")]).alias("kept"))
    return dealt.withColumn("bucket", F.col("fp").bitwiseAND(F.col("kept")))


def near_pairs(scratch: Scratch, prints: DataFrame, radius: int = RADIUS,
               bucket: int = BUCKET) -> DataFrame:
    """(a, b): links that connect all different fingerprints within the radius of each other.

    Within a bucket a spanning forest of its links is returned, not each pair.
    """
    found = None
    rows, kept = prints.select("fp"), [0]
    for step in range(4):
        dealt = _deal(rows, kept, radius)
        sizes = dealt.groupBy("kept", "bucket").agg(F.count("*").alias("n")).where("n > 1")
        shared = scratch.keep(bucketed_join(dealt, sizes, ["kept", "bucket"]))
        whole = shared if step == 3 else shared.where(F.col("n") <= bucket)
        gathered = whole.groupBy("kept", "bucket").agg(F.collect_list("fp").alias("fps"))
        links = scratch.keep(_compare(gathered.select("fps"), radius).distinct())
        found = links if found is None else found.union(links)
        large = shared.where(F.col("n") > bucket)
        if step == 3 or large.isEmpty():
            break
        kept = sorted(r[0] % (1 << BITS) for r in large.select("kept").distinct().collect())
        rows = large.select("fp", "kept")
    return found


def _compare(gathered: DataFrame, radius: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = [], []
            for fps in batch.column(0):
                a, b = forest(np.sort(np.array(fps.as_py(), np.int64)), radius)
                left.append(a)
                right.append(b)
            a, b = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (left, right))
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    return map_rows(gathered, "a long, b long", run)


def forest(fps: np.ndarray, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray]:
    """Links of a spanning forest over different fingerprints, breadth first."""
    left, right = [], []
    rest = fps
    bits = fps.view(np.uint64)
    if len(fps) == 2:
        near = int(bits[0] ^ bits[1]).bit_count() <= radius
        return fps[1:][:near], fps[:1][:near]
    while len(rest) > 1:
        queue, rest = [rest[0]], rest[1:]
        while queue and len(rest):
            x = queue.pop()
            near = np.bitwise_count((rest ^ x).view(np.uint64)) <= radius
            if near.any():
                hit = rest[near]
                left.append(hit)
                right.append(np.full(len(hit), x))
                queue.extend(hit)
                rest = rest[~near]
    if not left:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(left), np.concatenate(right)


def _classes(scratch: Scratch, prints: DataFrame, radius: int, bucket: int) -> DataFrame:
    """(fp, root, component_id) for every different fingerprint of (fp, doc_id)."""
    different = scratch.keep(prints.groupBy("fp").agg(F.min("doc_id").alias("least")))
    roots = connected_components(scratch, near_pairs(scratch, different, radius, bucket))
    linked = different.join(roots, F.col("fp") == F.col("node"), "left").withColumn(
        "root", F.coalesce("root", "fp"))
    return scratch.keep(bucketed_join(
        linked.select("fp", "root"),
        linked.groupBy("root").agg(F.min("least").alias("component_id")), ["root"]))


def near_duplicates(spark: SparkSession, docs: DataFrame, words: int = WORDS,
                    radius: int = RADIUS, bucket: int = BUCKET) -> DataFrame:
    """(doc_id, fingerprint, component_id) for every row; see the head of the module."""
    scratch = Scratch(spark, "simhash")
    prints = scratch.keep(with_fingerprints(docs, words))
    classes = _classes(scratch, prints, radius, bucket)
    return bucketed_join(prints, classes.select("fp", "component_id"), ["fp"]).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def one_of_each(spark: SparkSession, docs: DataFrame, words: int = WORDS, radius: int = RADIUS,
                bucket: int = BUCKET) -> DataFrame:
    """One document of each component, all columns as they were: that of the least
    doc_id, null last, and of equal ids that of the least hash of the whole row.
    Columns may have any names."""
    scratch = Scratch(spark, "simhash")
    kept = docs.select(F.struct("*").alias("doc"), F.xxhash64(*docs.columns).alias("_hash"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = np.array([fingerprint(t, words) for t in batch.column(1).to_pylist()],
                              np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(prints.view(np.int64)), batch.column(2)],
                ["doc_id", "fp", "_hash"])

    prints = scratch.keep(map_rows(
        kept.select(F.col("doc.doc_id").cast("long").alias("doc_id"), F.col("doc.text").cast("string").alias("text"), "_hash"),
        "doc_id long, fp long, _hash long", run))
    classes = _classes(scratch, prints, radius, bucket)
    first = F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "_hash")
    per_print = prints.groupBy("fp", "doc_id", "_hash").agg(F.count("*").alias("copies"))
    chosen = (bucketed_join(per_print, classes.select("fp", "root"), ["fp"])
              .groupBy("root").agg(F.min(F.struct(first.alias("first"), "copies")).alias("c"))
              .select(F.col("c.first.doc_id").alias("_id"), F.col("c.first._hash").alias("_chosen"),
                      "c.copies"))
    rows = kept.join(chosen, F.col("doc.doc_id").cast("long").eqNullSafe(F.col("_id"))
                     & (F.col("_hash") == F.col("_chosen")))
    # only where the very same row comes several times are rows compared
    once = rows.where("copies = 1").select("doc.*")
    return once.union(rows.where("copies > 1").select("doc.*").dropDuplicates())


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark, table(spark, sf_dir, "documents"))


QUERIES = {"op1_simhash": op1_simhash}
ORACLES = {}
