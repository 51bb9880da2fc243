"""Exact removal of repeated byte strings, by rank doubling over sampled positions.

Contract. Every text is a string of UTF-8 bytes (null: none). A byte goes if a
string of `THRESHOLD` bytes that covers it also starts anywhere else, in the
same document or another; matches never cross documents and are judged on the
input. `n_spans` counts maximal runs of removed bytes, `kept_sha256` is the
digest of the bytes left, concatenated. Texts shorter than the threshold lose
nothing. A text that several rows share loses everything from the threshold
up; repeated rows count as different places. Empty tables give empty results;
further columns are ignored.

Method. Ranks stand for strings: equal rank, equal string. Prefix doubling
takes ranks at growing lengths, drops positions whose rank is unique and ends
at the threshold. Sorting all byte positions once would move some thirty times
the input, so only chosen positions are ranked:

1. In each text, ranks of 32-byte strings come from five doublings of the bytes
   (numpy, in the task that reads the text). Each window of THRESHOLD bytes
   elects the least of its ranks; equal windows elect the same place. Windows
   that elect the same position form one run; about one position in 85 is
   elected at all.
2. Spark groups elected positions by rank. Where it is unique, no window of the
   run occurs twice, and the run ends here.
3. The other runs are halved twice a round, to 64, 16, 4 and 1 windows. A part's
   common core (bytes that all of its windows share: longer each round, as far
   as the threshold) is ranked again by a Spark aggregate: unique, and the part
   is done; if the string that all of its windows span together is not unique,
   all windows of the part occur twice, and it is done, too.

Bytes go only where 128-bit hashes of whole strings are equal: with 10^12 strings
at hand two different ones share a hash with a chance of about 10^-15. The 64-bit
rank of a gram only says where to look again.
Ranks are aggregated to least and greatest place before the shuffle, so a
passage in very many documents is no hot key. The bytes around a position that
is not yet decided travel with it; at most 2 * THRESHOLD of them. Equal texts
are taken as one by their digest, so a group of copies of any size is one text
in all steps but the last join, which adaptive execution may split.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hourly_star.llm.common import Scratch, map_rows, table

THRESHOLD = 200
GRAM = 32  # bytes of the first rank
REACH = THRESHOLD - GRAM  # an elected position is at most so far into its windows
PARTS = (64, 16, 4, 1)  # windows of a part in each round
PIECE = 1 << 19  # windows looked at together, whatever the length of the text
_PRIME = np.uint64(0x9E3779B97F4A7C15)


def gram_ranks(data: np.ndarray) -> np.ndarray:
    """A 64-bit rank of the 32 bytes from each position on, by doubling."""
    rank = (data.astype(np.uint64) + np.uint64(1)) * _PRIME
    length = 1
    while length < GRAM:
        rank ^= rank >> np.uint64(29)
        rank = rank[:len(rank) - length] * _PRIME + rank[length:]
        length *= 2
    rank ^= rank >> np.uint64(32)
    return rank * _PRIME


def elected(data: np.ndarray, piece: int | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows by the position they elect: position, first and last window, rank.

    The least rank wins, of equal ones the leftmost. Elected positions never go
    back, so windows of two pieces that elect the same one follow each other:
    they are one run, and a position is elected by one run only.
    """
    piece = piece or PIECE
    found = []
    for begin in range(0, len(data) - THRESHOLD + 1, piece):
        ranks = gram_ranks(data[begin:begin + piece + THRESHOLD - 1])
        bits = np.uint64(20)
        least = (ranks >> bits << bits) | np.arange(len(ranks), dtype=np.uint64)
        size = 1
        while 2 * size <= REACH + 1:
            least = np.minimum(least[:len(least) - size], least[size:])
            size *= 2
        more = REACH + 1 - size
        if more:
            least = np.minimum(least[:len(least) - more], least[more:])
        at = (least & np.uint64((1 << 20) - 1)).astype(np.int64)
        first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
        last = np.append(first[1:], len(at)) - 1
        found.append((at[first] + begin, first + begin, last + begin, ranks[at[first]].view(np.int64)))
    if not found:
        none = np.zeros(0, np.int64)
        return none, none, none, none
    at, first, last, rank = (np.concatenate(x) for x in zip(*found))
    new = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    return at[new], first[new], last[np.append(new[1:], len(at)) - 1], rank[new]


KEY = ["k0", "k1"]  # 128 bits that stand for a text
EMPTY_SHA = hashlib.sha256(b"").hexdigest()


def keyed(docs: DataFrame) -> DataFrame:
    """(doc_id, text as bytes, k0, k1)."""
    text = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text")).withColumns(
        {"k0": F.xxhash64("text"), "k1": F.xxhash64(F.lit(THRESHOLD), F.col("text"))})


class Seen:
    """Tells the first of the equal texts a task meets; forgets now and then, which costs time only."""

    def __init__(self) -> None:
        self.keys: set[tuple[int, int]] = set()

    def first(self, key: tuple[int, int]) -> bool:
        if key in self.keys:
            return False
        if len(self.keys) >= 200_000:
            self.keys.clear()
        self.keys.add(key)
        return True


def span_rank(data: bytes, low: int, high: int) -> tuple[int, int]:
    """The rank of the string that windows low to high before a position span, as two longs."""
    value = xxhash.xxh3_128_digest(data, low * THRESHOLD + high)
    return int.from_bytes(value[:8], "little", signed=True), int.from_bytes(value[8:], "little", signed=True)


ELECTIONS = "k0 long, k1 long, at long, low int, high int, rank long, w0 long, w1 long"


def elections(texts: DataFrame) -> DataFrame:
    """The elected positions of every text: the windows that elect position `at` start
    `low` to `high` bytes before it; `rank` is that of the gram, (w0, w1) that of
    the string all of these windows span."""
    piece = PIECE  # as set here, for all workers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = Seen()
        for batch in batches:
            columns = [[] for _ in range(8)]
            for k0, k1, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                data = value.as_buffer()
                if len(data) < THRESHOLD or not seen.first((k0, k1)):
                    continue
                at, first, last, rank = elected(np.frombuffer(data, np.uint8), piece)
                view = memoryview(data)
                low, high = at - last, at - first
                whole = np.frombuffer(b"".join(
                    xxhash.xxh3_128_digest(view[f:t + THRESHOLD], l * THRESHOLD + h) for f, t, l, h in zip(
                        first.tolist(), last.tolist(), low.tolist(), high.tolist())), np.int64).reshape(-1, 2)
                for column, values in zip(columns, (np.full(len(at), k0), np.full(len(at), k1), at,
                                                    low, high, rank, *whole.T)):
                    column.append(values)
            if columns[0]:
                types = [pa.int64()] * 3 + [pa.int32()] * 2 + [pa.int64()] * 3
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(c)).cast(t) for c, t in zip(columns, types)],
                    ["k0", "k1", "at", "low", "high", "rank", "w0", "w1"])

    return map_rows(texts.select("k0", "k1", "text"), ELECTIONS, run)


def _place() -> Column:
    return F.xxhash64("k0", "k1", "at")


def several(rows: DataFrame, by: list[str]) -> DataFrame:
    """The ranks that occur at more than one place, with the least of their places."""
    return rows.groupBy(*by).agg(F.min(_place()).alias("least"), F.max(_place()).alias("most")).where(
        "least <> most").drop("most")


def _contexts(texts: DataFrame, places: DataFrame) -> DataFrame:
    """The positions with the bytes their windows span."""
    lists = places.groupBy(*KEY).agg(F.collect_list(F.struct("at", "low", "high", "settled")).alias("places"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = Seen()
        for batch in batches:
            rows = []
            for k0, k1, data, places in zip(*(c.to_pylist() for c in batch.columns)):
                if seen.first((k0, k1)):
                    rows += [(k0, k1, p["at"], p["low"], p["high"], p["settled"],
                              data[p["at"] - p["high"]:p["at"] - p["low"] + THRESHOLD]) for p in places]
            if rows:
                yield pa.RecordBatch.from_pylist(
                    [dict(zip(("k0", "k1", "at", "low", "high", "settled", "bytes"), r)) for r in rows], schema=pa.schema(
                        [("k0", pa.int64()), ("k1", pa.int64()), ("at", pa.int64()), ("low", pa.int32()),
                         ("high", pa.int32()), ("settled", pa.bool_()), ("bytes", pa.binary())]))

    return map_rows(texts.select("k0", "k1", "text").join(lists, KEY),
                    "k0 long, k1 long, at long, low int, high int, settled boolean, bytes binary", run)


PARTS_SCHEMA = ("k0 long, k1 long, at long, low int, high int, settled boolean, "
                "c0 long, c1 long, s0 long, s1 long")


def _parts(contexts: DataFrame, size: int) -> DataFrame:
    """The undecided ranges in parts of at most `size` windows, with the rank of each
    part's core (c0, c1) and of the string it spans (s0, s1).

    Parts have fixed places before the elected position, so that cores compare.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.split()[0] for f in PARTS_SCHEMA.split(", ")]
        read = ["k0", "k1", "at", "low", "high", "bytes", "todo"]
        types = [pa.int64()] * 3 + [pa.int32()] * 2 + [pa.bool_()] + [pa.int64()] * 4
        for batch in batches:
            rows = []
            for k0, k1, at, low, high, data, todo in zip(*(batch.column(c).to_pylist() for c in read)):
                view = memoryview(data)  # starts `high` bytes before the position
                for wanted in todo:
                    if not low <= wanted["low"] <= wanted["high"] <= high:
                        raise ValueError(f"windows {wanted['low']} to {wanted['high']} are outside the bytes at hand")
                    for part in range(wanted["low"] // size, wanted["high"] // size + 1):
                        near, far = part * size, min(REACH, part * size + size - 1)
                        l, h = max(near, wanted["low"]), min(far, wanted["high"])
                        core = span_rank(view[high - near:high - far + THRESHOLD], near, far)
                        span = core if near == far else span_rank(view[high - h:high - l + THRESHOLD], l, h)
                        rows.append((k0, k1, at, l, h, wanted["settled"], *core, *span))
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

    return map_rows(contexts, PARTS_SCHEMA, run)


def repeated_windows(scratch: Scratch, texts: DataFrame) -> DataFrame:
    """(k0, k1, first, last): runs of windows that occur at more than one place of different
    texts, or twice in a text; runs may touch."""
    windows = lambda df: df.select("k0", "k1", (F.col("at") - F.col("high")).alias("first"),
                                   (F.col("at") - F.col("low")).alias("last"))
    all_places = scratch.keep(elections(texts))
    # the ranks that occur again are written before they are joined: a plain join with an
    # aggregate on its key would stay in the aggregate's stage, where a hot rank is not split
    again = scratch.keep(several(all_places, ["rank"]).drop("least"))
    kept = scratch.keep(all_places.join(again, "rank"))
    scratch.drop(scratch.tables - 2, scratch.tables - 1)
    again = scratch.keep(several(kept, ["w0", "w1"]))
    judged = scratch.keep(kept.join(again, ["w0", "w1"], "left").drop("w0", "w1"))
    scratch.drop(scratch.tables - 2, scratch.tables - 1)
    found = [windows(judged.where("least IS NOT NULL"))]
    # of equal strings that are decided, one stays as a witness for undecided ones
    undecided = judged.where("least IS NULL")
    witnesses = judged.where(F.col("least") == _place()).join(
        undecided.select("rank").distinct(), "rank", "semi")
    contexts = scratch.keep(_contexts(texts, undecided.withColumn("settled", F.lit(False)).unionByName(
        witnesses.withColumn("settled", F.lit(True)))))
    todo = contexts.withColumn("todo", F.array(F.struct("low", "high", "settled")))
    for size in PARTS:
        parts = scratch.keep(_parts(todo, size))
        written = scratch.tables
        ranked = parts.join(scratch.keep(several(parts, ["s0", "s1"])), ["s0", "s1"], "left")
        if size > 1:
            ranked = ranked.join(scratch.keep(several(parts, ["c0", "c1"]).drop("least")), ["c0", "c1"])
        ranked = scratch.keep(ranked.drop("s0", "s1"))
        scratch.drop(*range(written, scratch.tables))
        found.append(windows(ranked.where("not settled AND least IS NOT NULL")))
        if size == 1:
            break
        undecided = ranked.where("not settled AND least IS NULL")
        witnesses = (ranked.where("settled OR least IS NOT NULL").where(
            F.col("least").isNull() | (F.col("least") == _place()))
            .join(undecided.select("c0", "c1").distinct(), ["c0", "c1"], "semi")
            .withColumn("settled", F.lit(True)))
        rest = undecided.unionByName(witnesses).groupBy(*KEY, "at").agg(
            F.collect_set(F.struct("low", "high", "settled")).alias("todo"))
        todo = contexts.join(rest, [*KEY, "at"]).select(*contexts.columns, "todo")
    runs = found[0]
    for more in found[1:]:
        runs = runs.union(more)
    return runs


def without(data: bytes, runs: list[tuple[int, int]]) -> tuple[int, int, str]:
    """Bytes removed, maximal runs of them, and the digest of the rest."""
    kept, removed, spans, end = hashlib.sha256(), 0, 0, 0
    begin = stop = None
    for first, last in [*sorted(runs), (None, None)]:
        if begin is not None and (first is None or first > stop):
            kept.update(data[end:begin])
            removed, spans, end = removed + stop - begin, spans + 1, stop
            begin = None
        if first is not None:
            begin = first if begin is None else begin
            stop = max(stop or 0, last + THRESHOLD)
    kept.update(data[end:])
    return removed, spans, kept.hexdigest()


def deduplicated(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """The digest of every row; see the head of the module."""
    scratch = Scratch(spark, "repeats")
    texts = keyed(docs)
    rows = scratch.keep(texts.select("doc_id", *KEY, F.length("text").cast("long").alias("n_bytes"),
                                     F.sha2("text", 256).alias("sha")))
    copied = rows.where(F.col("n_bytes") >= THRESHOLD).groupBy(*KEY).agg(F.count("*").alias("n")).where(
        "n > 1").select(*KEY, F.lit(True).alias("copied"))
    runs = repeated_windows(scratch, texts)
    lists = (runs.join(copied, KEY, "anti").groupBy(*KEY)
             .agg(F.collect_set(F.struct("first", "last")).alias("runs")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            results = [without(data, [(r["first"], r["last"]) for r in runs])
                       for data, runs in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())]
            removed, spans, sha = zip(*results) if results else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()),
                 pa.array(sha, pa.string())], ["k0", "k1", "removed", "spans", "rest"])

    cut = map_rows(texts.select(*KEY, "text").join(lists, KEY),
                   "k0 long, k1 long, removed long, spans long, rest string", run)
    found = rows.join(copied, KEY, "left").join(scratch.keep(cut), KEY, "left")
    whole = F.coalesce("copied", F.lit(False))
    return found.select(
        "doc_id", "n_bytes",
        F.when(whole, F.col("n_bytes")).otherwise(F.coalesce("removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(whole, 1).otherwise(F.coalesce("spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(whole, F.lit(EMPTY_SHA)).otherwise(F.coalesce("rest", "sha")).alias("kept_sha256"))


def op10_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return deduplicated(spark, table(spark, sf_dir, "documents"))


QUERIES = {"op10_repeats": op10_repeats}
ORACLES = {}
