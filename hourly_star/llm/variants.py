"""Spelling variants: words one edit apart, by Bloom-guided neighbourhoods.

Contract. Runs of `[A-Za-z\\u00C0-\\u00FF]` are lower-cased (A-Z only). With h
the unsigned CRC-32 of `<doc_id>:<run>`, a run whose h is a multiple of 199
loses its code point h modulo its length. Words are the different results of
at least six code points that occur at least five times (`n`). Two words are
near if one inserted, deleted or replaced code point makes one into the other.
`form` is the near word of largest n, of ties the first by code point, if that
n is at least five times the word's own; `root` is where forms lead in the
end, the word itself without a form. A null or empty text has no runs, a null
doc_id counts as an empty one; repeated rows count as often as they come; an
empty table or one without words gives an empty result; runs may have any
length; further columns are ignored.

Method. The vocabulary is counted in Spark. Each word has a hash that is a sum
over its code points and their places, so that the hash of every edit follows
from it by one subtraction and one addition. Blocked Bloom filters, one or
more for each word length, are filled by bitmap aggregates and broadcast, at
most `ROUND_BYTES` at a time: a larger vocabulary takes more rounds, not larger
broadcasts. Every deletion and every replacement of a word is probed in the
filters of its length (an insertion is the other word's deletion). Only
positives are shuffled: they are joined by length and hash with the vocabulary
and the two words themselves are compared, which removes false positives.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hourly_star.llm.common import Scratch, lower_ascii, map_rows, table
from hourly_star.session import prepare

RUN = "([a-zÀ-ÿ]+)"  # after A-Z are lower-cased
DAMAGED = 199  # runs whose checksum is a multiple of this lose a code point
LEAST_LENGTH = 6
LEAST_COUNT = 5
RATIO = 5  # a form is so many times as frequent as its variant

ALPHABET = np.array([*range(ord("a"), ord("z") + 1), *range(0xC0, 0x100)], np.uint64)
LONG = 64  # words of this length and more share their filters
BITS_A_WORD = 16
PROBES = 4  # bits of a word, all in one block of 64
CHUNK_BITS = 32_768  # of one bitmap aggregate
PART_BYTES = 1 << 22  # of one filter
ROUND_BYTES = 1 << 25  # of the filters broadcast at a time
CELLS = 1 << 18  # edits hashed at a time, whatever the length of a word


def words(docs: DataFrame) -> DataFrame:
    """(word, n): the words of the documents and how often they occur."""
    runs = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"),
                       F.explode(F.regexp_extract_all(lower_ascii(F.col("text").cast("string")),
                                                      F.lit(RUN), F.lit(1))).alias("run"))
    checked = runs.where(F.length("run") >= LEAST_LENGTH).select(
        "run", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")).alias("h"))
    place = (F.col("h") % F.length("run")).cast("int")
    cut = F.concat(F.substring("run", 1, place), F.substring(F.col("run"), place + 2, F.length("run")))
    word = F.when(F.col("h") % DAMAGED == 0, cut).otherwise(F.col("run"))
    return (checked.select(word.alias("word")).where(F.length("word") >= LEAST_LENGTH)
            .groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= LEAST_COUNT))


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x + np.uint64(0x9E3779B97F4A7C15)).astype(np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _term(place: np.ndarray, code: np.ndarray) -> np.ndarray:
    """What a code point at a place adds to the hash of its word."""
    return _mixed(place.astype(np.uint64) * np.uint64(256) + code.astype(np.uint64))


def _codes(word: str) -> np.ndarray:
    return np.frombuffer(word.encode("latin-1"), np.uint8).astype(np.uint64)


def word_hash(word: str) -> int:
    codes = _codes(word)
    return int(_term(np.arange(len(codes)), codes).sum(dtype=np.uint64))


def _hashed(vocabulary: DataFrame) -> DataFrame:
    """(word, n, size, h) of every word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.column(0).to_pylist()
            hashes = np.array([word_hash(w) for w in own], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([len(w) for w in own], pa.int32()),
                 pa.array(hashes)], ["word", "n", "size", "h"])

    return map_rows(vocabulary.select("word", "n"), "word string, n long, size int, h long", run)


class Layout:
    """Which filter a (length, hash) belongs to and which bits it has there."""

    def __init__(self, counts: dict[int, int], part_bytes: int = PART_BYTES):
        self.parts, self.chunks = {}, {}
        for shard, n in sorted(counts.items()):
            size = n * BITS_A_WORD // 8
            self.parts[shard] = max(1, -(-size // part_bytes))
            self.chunks[shard] = max(1, -(-n * BITS_A_WORD // (self.parts[shard] * CHUNK_BITS)))

    def filters(self) -> list[tuple[int, int, int]]:
        """(shard, part, bytes) of every filter."""
        return [(s, p, self.chunks[s] * CHUNK_BITS // 8) for s in self.parts for p in range(self.parts[s])]

    def rounds(self, most: int = ROUND_BYTES) -> list[list[tuple[int, int]]]:
        """The filters dealt into rounds of at most so many bytes (a single filter may be all of one)."""
        dealt, filled = [[]], 0
        for shard, part, size in self.filters():
            if dealt[-1] and filled + size > most:
                dealt.append([])
                filled = 0
            dealt[-1].append((shard, part))
            filled += size
        return dealt

    def place(self, shard: int, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Part, block and the bits in the block of every hash."""
        spread = _mixed(hashes)
        blocks = np.uint64(self.chunks[shard] * CHUNK_BITS // 64)
        part = (spread >> np.uint64(48)) % np.uint64(self.parts[shard])
        block = (spread & np.uint64(0xFFFFFFFFFFFF)) % blocks
        other, mask = _mixed(spread), np.zeros(len(hashes), np.uint64)
        for i in range(PROBES):
            mask |= np.uint64(1) << ((other >> np.uint64(6 * i)) & np.uint64(63))
        return part.astype(np.int64), block.astype(np.int64), mask


def _shard(size: int) -> int:
    return min(size, LONG)


def _filters(hashed: DataFrame, layout: Layout, chosen: list[tuple[int, int]]) -> dict:
    """The chosen filters as arrays of blocks."""
    wanted = set(chosen)

    def bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.minimum(batch.column(0).to_numpy(), LONG)
            hashes = batch.column(1).to_numpy().view(np.uint64)
            for shard in np.unique(sizes):
                part, block, mask = layout.place(int(shard), hashes[sizes == shard])
                for p in np.unique(part):
                    if (int(shard), int(p)) not in wanted:
                        continue
                    own, masks = block[part == p], mask[part == p]
                    places = [own[(masks >> np.uint64(b) & np.uint64(1)) > 0] * 64 + b for b in range(64)]
                    places = np.concatenate(places)
                    n = len(places)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(n, shard, np.int32)), pa.array(np.full(n, p, np.int32)),
                         pa.array((places // CHUNK_BITS).astype(np.int32)),
                         pa.array(places % CHUNK_BITS)], ["shard", "part", "chunk", "bit"])

    shards = sorted({s for s, _ in chosen})
    own = hashed.where(F.least("size", F.lit(LONG)).isin(shards)).select("size", "h")
    rows = (map_rows(own, "shard int, part int, chunk int, bit long", bits)
            .groupBy("shard", "part", "chunk").agg(F.expr("bitmap_construct_agg(bit)").alias("bits")).collect())
    filters = {key: np.zeros(layout.chunks[key[0]] * CHUNK_BITS // 64, np.uint64) for key in chosen}
    blocks = CHUNK_BITS // 64
    for shard, part, chunk, bitmap in rows:
        filters[shard, part][chunk * blocks:(chunk + 1) * blocks] = np.frombuffer(bytes(bitmap), np.uint64)
    return filters


def edits(codes: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, rows, hashes) of the deletions and half of the replacements of words of one length.

    `codes` has one row for each word. Of equal neighbours only the last is
    deleted, and a code point is replaced by greater ones only: every other
    edit is one of these, from this word or from the other.
    """
    size = codes.shape[1]
    step = max(1, CELLS // len(ALPHABET))
    places = np.arange(size)
    own = _term(places, codes)
    total = own.sum(axis=1, dtype=np.uint64)
    if size > 1:
        shifted = np.zeros_like(own)
        shifted[:, 1:] = _term(places[:-1], codes[:, 1:])
        left = np.cumsum(own, axis=1, dtype=np.uint64) - own
        right = shifted.sum(axis=1, dtype=np.uint64)[:, None] - np.cumsum(shifted, axis=1, dtype=np.uint64)
        distinct = np.ones(codes.shape, bool)
        distinct[:, :-1] = codes[:, :-1] != codes[:, 1:]
        rows, cols = np.nonzero(distinct)
        yield size - 1, rows, (left + right)[rows, cols]
    for start in range(0, size, step):
        stop = min(size, start + step)
        new = _term(places[start:stop, None], ALPHABET[None, :])
        rest = total[:, None] - own[:, start:stop]
        greater = ALPHABET[None, None, :] > codes[:, start:stop, None]
        rows, cols, letters = np.nonzero(greater)
        yield size, rows, rest[rows, cols] + new[cols, letters]


def _candidates(hashed: DataFrame, layout: Layout, filters: dict) -> DataFrame:
    """(size, h, other_size, other_h): the edits of each word that pass a filter."""
    shards = sorted({s for s, _ in filters})
    near = sorted({size for s in shards for size in (s, s + 1)})
    sent = hashed.sparkSession.sparkContext.broadcast(filters)

    def probe(size: int, own: np.ndarray, codes: np.ndarray) -> Iterator[pa.RecordBatch]:
        for other, rows, hashes in edits(codes):
            shard = _shard(other)
            if shard not in layout.parts:
                continue
            part, block, mask = layout.place(shard, hashes)
            for p in np.unique(part):
                blocks = sent.value.get((shard, int(p)))
                if blocks is None:
                    continue
                chosen = np.nonzero(part == p)[0]
                found = blocks[block[chosen]]
                hit = chosen[found & mask[chosen] == mask[chosen]]
                if len(hit):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(hit), size, np.int32)), pa.array(own[rows[hit]]),
                         pa.array(np.full(len(hit), other, np.int32)),
                         pa.array(hashes[hit].view(np.int64))], ["size", "h", "other_size", "other_h"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            by_size: dict[int, list] = {}
            for word, h in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                by_size.setdefault(len(word), []).append((word, h))
            for size, own in by_size.items():
                step = max(1, CELLS // (size * len(ALPHABET)))
                for start in range(0, len(own), step):
                    some = own[start:start + step]
                    yield from probe(size, np.array([h for _, h in some], np.int64),
                                     np.stack([_codes(w) for w, _ in some]))

    # lengths from LONG on share their filters
    own = hashed.where(F.least("size", F.lit(LONG + 1)).isin(near) | (F.col("size") > LONG if LONG in shards
                                                                     else F.lit(False)))
    return map_rows(own.select("word", "h"), "size int, h long, other_size int, other_h long", run)


def near_words(scratch: Scratch, hashed: DataFrame, part_bytes: int = PART_BYTES,
               round_bytes: int = ROUND_BYTES) -> DataFrame:
    """(word, n, other, other_n): every pair of near words once. `hashed` is a written table."""
    counts = {row[0]: row[1] for row in hashed.groupBy(F.least("size", F.lit(LONG))).count().collect()}
    layout = Layout(counts, part_bytes)
    found = None
    for chosen in layout.rounds(round_bytes):
        if not chosen:
            break
        filters = _filters(hashed, layout, chosen)
        positives = scratch.keep(_candidates(hashed, layout, filters))
        found = positives if found is None else found.union(positives)
    if found is None:
        return hashed.select("word", "n", F.col("word").alias("other"), F.col("n").alias("other_n")).limit(0)
    others = hashed.select(F.col("size").alias("other_size"), F.col("h").alias("other_h"),
                           F.col("word").alias("other"), F.col("n").alias("other_n"))
    pairs = found.join(others, ["other_size", "other_h"]).join(hashed, ["size", "h"])
    return pairs.where(F.levenshtein("word", "other", 1) == 1).select("word", "n", "other", "other_n")


def _roots(scratch: Scratch, forms: DataFrame) -> DataFrame:
    """(word, root) for words with a form: forms are followed by doubling, as n grows fivefold each step."""
    links = scratch.keep(forms.select("word", F.col("form").alias("root")))
    while True:
        onward = links.select(F.col("word").alias("root"), F.col("root").alias("further"))
        links = scratch.keep(links.join(onward, "root", "left").select(
            "word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")))
        if links.where("moved").isEmpty():
            return links.drop("moved")
        links = links.drop("moved")


def spelling_variants(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for every word; see the head of the module."""
    scratch = Scratch(prepare(spark), "variants")
    hashed = scratch.keep(_hashed(scratch.keep(words(docs))))
    pairs = scratch.keep(near_words(scratch, hashed))
    both = pairs.union(pairs.select("other", "other_n", "word", "n"))
    best = F.min(F.struct((-F.col("other_n")).alias("less"), "other")).alias("best")
    near = both.groupBy("word").agg(F.count("*").alias("n_near"), best)
    form_n: Column = -F.col("best.less")
    formed = scratch.keep(hashed.select("word", "n").join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(form_n >= RATIO * F.col("n"), F.struct(F.col("best.other").alias("form"), form_n.alias("form_n")))
        .alias("f")).select("word", "n", "n_near", "f.form", "f.form_n"))
    roots = _roots(scratch, formed.where("form IS NOT NULL"))
    return formed.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op11_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(spark, table(spark, sf_dir, "documents"))


QUERIES = {"op11_variants": op11_variants}

# Words near by a replacement share what stands before and after some place;
# words near by an insertion, one word and another less one code point.
SQL = """
WITH RECURSIVE crc AS (
  SELECT list(list_reduce(list_prepend(i, range(8)), lambda c, k:
              CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) ORDER BY i) AS t
  FROM range(256) r(i)),
runs AS (
  SELECT doc_id, run, count(*) AS times FROM (
    SELECT doc_id, unnest(regexp_extract_all(
      translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[a-zÀ-ÿ]+')) AS run FROM documents)
  WHERE length(run) >= 6 GROUP BY ALL),
coded AS (
  SELECT run, times, hex(encode(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run)) AS x FROM runs),
checked AS (
  SELECT run, times, xor(list_reduce(list_prepend(4294967295, list_transform(range(0, length(x), 2), lambda i:
      CAST(('0x' || substr(x, i + 1, 2)) AS BIGINT))),
    lambda c, b: xor(t[xor(c, b) % 256 + 1], c // 256)), 4294967295) AS h
  FROM coded, crc),
damaged AS (
  SELECT CASE WHEN h % 199 = 0 THEN left(run, CAST(h % length(run) AS INT))
                                    || substr(run, CAST(h % length(run) AS INT) + 2) ELSE run END AS word, times
  FROM checked),
w AS (SELECT word, CAST(sum(times) AS BIGINT) AS n FROM damaged WHERE length(word) >= 6
      GROUP BY word HAVING sum(times) >= 5),
places AS (SELECT word, n, unnest(range(0, length(word))) AS i FROM w),
cut AS (SELECT word, n, i, left(word, CAST(i AS INT)) AS a, substr(word, CAST(i AS INT) + 2) AS b FROM places),
near AS (
  SELECT x.word, x.n, y.word AS other, y.n AS other_n FROM cut x JOIN cut y
  ON x.i = y.i AND x.a = y.a AND x.b = y.b AND x.word <> y.word
  UNION SELECT x.word, x.n, w.word, w.n FROM cut x JOIN w ON x.a || x.b = w.word
  UNION SELECT w.word, w.n, x.word, x.n FROM cut x JOIN w ON x.a || x.b = w.word),
ranked AS (
  SELECT word, n, other, other_n, count(*) OVER (PARTITION BY word) AS n_near,
    row_number() OVER (PARTITION BY word ORDER BY other_n DESC, encode(other)) AS r FROM near),
formed AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near,
    CASE WHEN other_n >= 5 * w.n THEN other END AS form, CASE WHEN other_n >= 5 * w.n THEN other_n END AS form_n
  FROM w LEFT JOIN ranked ON w.word = ranked.word AND r = 1),
walk AS (
  SELECT word, word AS at, form FROM formed
  UNION ALL SELECT walk.word, f.word, f.form FROM walk JOIN formed f ON f.word = walk.form)
SELECT formed.word, formed.form, walk.at AS root, n, n_near, form_n
FROM formed JOIN walk ON walk.word = formed.word AND walk.form IS NULL
"""

ORACLES = {"op11_variants": SQL}
