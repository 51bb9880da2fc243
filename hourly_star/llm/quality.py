"""Quality rules: base counts, and divergence from the usual make-up of a language.

Contract. Words are cut at ASCII white space; a null text has none. Base
counts: `word_chars`, `n_symbols`, `n_dup_lines`, `n_repeat_words`; a document
fails them with fewer than `LEAST_WORDS` words or more than 20 % of its words
in repeated five-word windows. Otherwise the verdict is the divergence rule's:

* The share of character classes and the share of common words of a document
  are compared with those of each language by the Jensen-Shannon distance
  (base 2); the nearest language counts, so a wrong or null `lang` does no
  harm. Shares of a language are those of all documents that carry its name,
  so they follow the corpus.
* A document is not kept if its characters alone are far off, or if both its
  characters and its words are somewhat off. Short texts scatter, so limits
  widen with one over the root of the length, and texts under `GUARD_WORDS`
  words are not judged by divergence at all.
* A document in a language without a list of common words is judged by base
  counts only; so is all of a corpus in which no listed language occurs.

Repeated rows and ids are judged one by one; an empty table gives an empty
result; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourly_star.llm.common import Scratch, map_rows, table

LEAST_WORDS = 10
WINDOW = 5
SYMBOLS = "#*$%&|<>"
GUARD_WORDS = 20
CHARS_ALONE = (0.22, 1.0)  # limit and its widening by 1 / sqrt(code points)
CHARS = 0.115  # beside the words' limit
WORDS = (0.22, 1.3)  # limit and its widening by 1 / sqrt(words)
# The most common words of each language.
COMMON = {
    "en": "the of and to in a is that it for was on are as with be by this from or an he not at".split(),
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es".split(),
    "fr": "de la le et les des en un une du que est pour qui dans par au sur pas avec il ce".split(),
    "es": "de la que el en y a los se del las un por con no una su para es al lo como".split(),
}
BINS = {word: i for i, word in enumerate(sorted({w for words in COMMON.values() for w in words}))}
OTHER = len(BINS)
CLASSES = 9  # lower, upper, digit, blank, line end, punctuation, symbol, other ASCII, beyond ASCII
_PUNCTUATION = ".,;:!?'\"()-"


def _class_table() -> np.ndarray:
    """Class of each UTF-8 byte; bytes that continue a code point have none of the classes."""
    table = np.full(256, 7, np.uint8)
    for low, high, kind in ((97, 122, 0), (65, 90, 1), (48, 57, 2), (0x80, 0xBF, CLASSES), (0xC0, 0xFF, 8)):
        table[low:high + 1] = kind
    for chars, kind in ((" \t\v\f\r", 3), ("\n", 4), (_PUNCTUATION, 5), (SYMBOLS, 6)):
        table[[ord(c) for c in chars]] = kind
    return table


CLASS = _class_table()


def repeated_words(words: list[bytes]) -> int:
    """Words inside five-word windows that the text has twice or more."""
    n = len(words) - WINDOW + 1
    if n < 2:
        return 0
    numbers: dict[bytes, int] = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words))
    rank, length = ids, 1
    while length < WINDOW:  # rank of the windows of twice the length, by pairs of ranks
        step = min(length, WINDOW - length)
        pairs = rank[:len(rank) - step] * (int(rank.max()) + 1) + rank[step:]
        rank = np.unique(pairs, return_inverse=True)[1]
        length += step
    twice = np.flatnonzero(np.bincount(rank)[rank] > 1)
    if not len(twice):
        return 0
    edges = np.zeros(len(words) + 1, np.int64)
    np.add.at(edges, twice, 1)
    np.add.at(edges, twice + WINDOW, -1)
    return int((np.cumsum(edges) > 0).sum())


def features(text: str | None) -> tuple[int, int, int, int, int, np.ndarray, np.ndarray]:
    """The five base counts, the histogram of character classes and that of common words."""
    data = (text or "").encode("utf-8", "surrogatepass")
    words = data.split()
    kinds = np.bincount(CLASS[np.frombuffer(data, np.uint8)], minlength=CLASSES)[:CLASSES]
    seen: set[bytes] = set()
    duplicates = 0
    for line in data.split(b"\n"):
        if line.strip():
            duplicates += line in seen
            seen.add(line)
    common = np.zeros(OTHER + 1, np.int64)
    if words:
        get, strip = BINS.get, _PUNCTUATION
        found = [get(w.lower().decode("utf-8", "surrogatepass").strip(strip), OTHER) for w in words]
        common = np.bincount(found, minlength=OTHER + 1)
    code_points = int(kinds.sum())
    return (len(words), code_points - int(kinds[3]) - int(kinds[4]), int(kinds[6]), duplicates,
            repeated_words(words), kinds, common)


SCHEMA = ("doc_id long, lang string, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
          "n_repeat_words long, chars array<int>, words array<int>")


def measured(docs: DataFrame) -> DataFrame:
    """Base counts and histograms of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = SCHEMA.replace(",", "").split()[0::2]
        for batch in batches:
            rows = [features(t) for t in batch.column(2).to_pylist()]
            counts = [pa.array([r[i] for r in rows], pa.int64()) for i in range(5)]
            lists = [pa.array([r[i].tolist() for r in rows], pa.list_(pa.int32())) for i in (5, 6)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *counts, *lists], names)

    return map_rows(docs.select(F.col("doc_id").cast("long"), F.col("lang").cast("string"),
                                F.col("text").cast("string")), SCHEMA, run)


def references(measures: DataFrame) -> dict[str, tuple[np.ndarray, np.ndarray]]:
    """Shares of character classes and common words of each listed language, over all documents.

    At most one row for each language and bin comes to the driver.
    """
    sums = {}
    for column in ("chars", "words"):
        rows = (measures.where(F.col("lang").isin(*COMMON))
                .select("lang", F.posexplode(column).alias("bin", "n"))
                .where("n > 0").groupBy("lang", "bin").agg(F.sum("n").alias("n")).collect())
        for r in rows:
            size = CLASSES if column == "chars" else OTHER + 1
            sums.setdefault(r["lang"], {}).setdefault(column, np.zeros(size))[r["bin"]] = r["n"]
    return {lang: (s["chars"] / s["chars"].sum(), s["words"] / s["words"].sum())
            for lang, s in sorted(sums.items()) if len(s) == 2}


def distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distance of each row of p from q, base 2: 0 to 1."""
    middle = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        left = np.where(p > 0, p * np.log2(p / middle), 0).sum(axis=-1)
        right = np.where(q > 0, q * np.log2(q / middle), 0).sum(axis=-1)
    return np.sqrt(np.clip((left + right) / 2, 0, 1))


def verdicts(chars: np.ndarray, words: np.ndarray, judged: np.ndarray,
             known: dict[str, tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distances from the nearest language, and whether the rows are within the limits."""
    points, total = chars.sum(axis=1), words.sum(axis=1)
    near_chars, near_words = np.ones(len(chars)), np.ones(len(chars))
    for of_chars, of_words in known.values():
        near_chars = np.minimum(near_chars, distance(chars / np.maximum(points, 1)[:, None], of_chars))
        near_words = np.minimum(near_words, distance(words / np.maximum(total, 1)[:, None], of_words))
    off = near_chars > CHARS_ALONE[0] + CHARS_ALONE[1] / np.sqrt(np.maximum(points, 1))
    off |= (near_chars > CHARS) & (near_words > WORDS[0] + WORDS[1] / np.sqrt(np.maximum(total, 1)))
    judged = judged & (total >= GUARD_WORDS) & bool(known)
    return near_chars, near_words, ~(judged & off)


def rules(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """The counts and verdict of every row; see the head of the module."""
    measures = Scratch(spark, "quality").keep(measured(docs))
    shared = spark.sparkContext.broadcast(references(measures))
    base = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            chars, words = (np.array(batch.column(c).to_pylist(), float).reshape(batch.num_rows, -1)
                            for c in ("chars", "words"))
            # a named language without a list is not judged by the lists of others
            judged = np.array([lang is None or lang in COMMON for lang in batch.column("lang").to_pylist()], bool)
            by_chars, by_words, fine = verdicts(chars, words, judged, shared.value)
            n, repeated = (batch.column(c).to_numpy() for c in ("n_words", "n_repeat_words"))
            failed = (n < LEAST_WORDS) | (100 * repeated > 20 * n)
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in base], pa.array(failed), pa.array(~failed & fine),
                 pa.array(by_chars), pa.array(by_words)],
                [*base, "base_failed", "kept", "char_distance", "word_distance"])

    return map_rows(measures, ", ".join(f"{c} long" for c in base) + ", base_failed boolean, kept boolean, "
                    "char_distance double, word_distance double", run)


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules(spark, table(spark, sf_dir, "documents"))


QUERIES = {"op7_quality": op7_quality}
ORACLES = {}
