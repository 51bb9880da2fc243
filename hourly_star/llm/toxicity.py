"""Toxicity scores from subword bags, trained on labelled documents.

Contract. Every row gets score (0 to 1) and predicted (1 from `THRESHOLD` up),
computed from its whole text alone. Labels are learnt only from rows whose
crc32(doc_id as text) mod 3 is not 1; the others are held out. The classifier
is fitted on a bounded sample: the first `POSITIVES` and `NEGATIVES` eligible
labelled documents of at most `LONGEST` code points in the order of a hash of
doc_id, which bounds the training task. A text without any word
(null, empty, blank, only signs) gets the share of label 1 among all eligible
labels; so does every text where one of the labels does not occur. A doc_id
that has several labels counts as toxic if one says so; labels that are null,
or of no document, are not used. A null doc_id is not held out. Repeated rows
are scored as often as they come. An empty table gives an empty result.
Further columns are kept where documents are filtered.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hourly_star.llm import subwords
from hourly_star.llm.common import map_rows, table

POSITIVES = 1_200
NEGATIVES = 4_000
LONGEST = 30_000  # code points of a document to learn from
FOLDS, HELD_OUT = 3, 1
THRESHOLD = 0.7


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == HELD_OUT, F.lit(False))


def sample(docs: DataFrame, labels: DataFrame) -> tuple[DataFrame, float]:
    """(doc_id, text, toxic) of the bounded sample, and the share of label 1 of all eligible."""
    eligible = (
        labels.where("toxic IS NOT NULL AND doc_id IS NOT NULL").where(~held_out(F.col("doc_id")))
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
        .join(docs.select(F.col("doc_id").cast("long").alias("doc_id")).distinct(), "doc_id", "semi"))
    counts = dict(eligible.groupBy("toxic").count().collect())
    share = counts.get(1, 0) / max(1, counts.get(1, 0) + counts.get(0, 0))
    bounded = eligible.join(
        docs.groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.max(F.length("text")).alias("longest")).where(f"longest <= {LONGEST}"), "doc_id", "semi")
    chosen = [bounded.where(F.col("toxic") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(bound)
              for label, bound in ((1, POSITIVES), (0, NEGATIVES))]
    texts = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
             .join(F.broadcast(chosen[0].union(chosen[1])), "doc_id")  # at most the two bounds
             .groupBy("doc_id", "toxic").agg(F.min("text").alias("text")))
    return texts.select("doc_id", "text", "toxic"), share


def fit(docs: DataFrame, labels: DataFrame) -> tuple[np.ndarray | None, float, float]:
    """The collapsed model (None if a label is missing), its bias, and the share of label 1.

    One task trains, as the sample is bounded; the model of 1 MB is all that
    comes to the driver.
    """
    rows, share = sample(docs, labels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = sorted((row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns))),
                       key=lambda row: row[0])
        found = [(text or "", label) for _, text, label in found]
        if len({label for text, label in found if subwords.bags_of([text]).text.size}) < 2:
            return
        model = subwords.train([t for t, _ in found], [label for _, label in found])
        yield pa.RecordBatch.from_arrays(
            [pa.array([model.bucket_scores().tobytes()]), pa.array([model.bias()])], ["scores", "bias"])

    trained = map_rows(rows.repartition(1), "scores binary, bias double", run).collect()
    if not trained:
        return None, 0.0, share
    return np.frombuffer(trained[0]["scores"], np.float32), trained[0]["bias"], share


def _batch_scores(texts: list[str | None], model: tuple[np.ndarray | None, float, float]) -> np.ndarray:
    scores, bias, share = model
    found = np.full(len(texts), share)
    if scores is not None:
        worst = subwords.worst_windows(texts, scores, subwords.WORST)
        judged = ~np.isnan(worst)
        found[judged] = subwords.probability(worst[judged] + bias)
    return found


def with_scores(docs: DataFrame, model: tuple[np.ndarray | None, float, float]) -> DataFrame:
    """(doc_id, score) of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 1 MB at any size of the corpus

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = _batch_scores(batch.column(1).to_pylist(), shared.value)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found)], ["doc_id", "score"])

    return map_rows(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")),
                    "doc_id long, score double", run)


def scored(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row; see the head of the module."""
    return with_scores(docs, fit(docs, labels)).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def without_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents below the threshold, all columns as they were."""
    model = fit(docs, labels)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = _batch_scores(batch.column(at).to_pylist(), shared.value)
            yield batch.filter(pa.array(found < THRESHOLD))

    return map_rows(docs, docs.schema, run)


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES = {"op4_toxicity": op4_toxicity}
ORACLES = {}
