"""Main text of HTML pages, by sum-product messages on the element tree.

Contract. Of every page the text of the article is returned, without menus,
headers, footers, sidebars, notices, adverts, forms, scripts, styles, markup
and reader comments: character references decoded, white space inside a block
as one space, no space at its ends, blocks in page order joined by one space.
Null, empty and text-free pages give an empty text. Broken markup is read as
browsers do where it matters here (unclosed paragraphs, items and inline tags;
comments or scripts that never end; elements over `dom.DEEPEST` deep become
siblings; a tag that never ends is text), in time that grows with the length
alone. Formulas and the text of objects and media elements are text like any
other, drawings (svg) are not. Repeated rows are treated one by one, an
empty table gives an empty result; further columns are ignored.

Model. Every block element is content or not. Its potential is a weight for
each feature (names in its tag, how much text, links, signs and controls it
holds); each parent and child share a table of four weights, by the kind of
child. A page is a tree, so one pass of messages up and one down give exact
marginals; an element's own text is kept if its marginal is above one half.
Weights are fitted by the gradient of the likelihood (seen minus expected
counts, from the same messages) on `PAGES` labelled pages of many layouts that
`labelled_page` draws; the number is a parameter and does not grow with input.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourly_star.llm import dom
from hourly_star.llm.common import map_rows, table
from hourly_star.llm.page_layouts import labelled_page

PAGES = 1_500
STEPS = 200
RATE = 0.15
PENALTY = 1e-3
PIECE = 1 << 21  # characters of pages worked on together


@dataclass
class Weights:
    content: np.ndarray  # of each feature, for the state "content"
    pair: np.ndarray  # of each kind of child, state of the parent, state of the child


def _logsum(values: np.ndarray, axis: int) -> np.ndarray:
    return np.logaddexp(*np.moveaxis(values, axis, 0))


def marginals(forest: dom.Forest, by_depth: list[np.ndarray], pairs: tuple[np.ndarray, np.ndarray],
              weights: Weights) -> tuple[np.ndarray, np.ndarray, float]:
    """Probability of content of each element; of each pair of states with its parent;
    and the logarithm of the sum over all labellings."""
    count = len(forest.parent)
    parent, group = np.array(forest.parent), np.array(forest.group)
    inner = np.zeros((count, 2))
    inner[:, 1] = np.bincount(pairs[0], weights.content[pairs[1]], count)
    up = np.zeros((count, 2))  # message of each element to its parent
    for nodes in reversed(by_depth[1:]):
        up[nodes] = _logsum(weights.pair[group[nodes]] + inner[nodes][:, None, :], 2)
        np.add.at(inner, parent[nodes], up[nodes])
    total = float(_logsum(inner[by_depth[0]], 1).sum())
    outer = np.zeros((count, 2))  # message of the parent to each element
    joint = np.zeros((count, 2, 2))
    for nodes in by_depth[1:]:
        above = inner[parent[nodes]] + outer[parent[nodes]] - up[nodes]
        both = weights.pair[group[nodes]] + above[:, :, None]
        outer[nodes] = _logsum(both, 1)
        both = both + inner[nodes][:, None, :]
        joint[nodes] = np.exp(both - _logsum(_logsum(both, 2), 1)[:, None, None])
    belief = inner + outer
    return 1 / (1 + np.exp(np.clip(belief[:, 0] - belief[:, 1], -60, 60))), joint, total


def fit(pages: int = PAGES, steps: int = STEPS, seed: int = 5) -> Weights:
    """Weights that make the labels of the drawn pages likely; the same for the same arguments."""
    forest = dom.Forest()
    for number in range(pages):
        forest.parse(number, labelled_page(seed * 100_000 + number))
    by_depth = dom.levels(forest)
    pairs = dom.features(forest, by_depth)
    label = np.maximum(np.array(forest.label), 0)
    parent, group = np.array(forest.parent), np.array(forest.group)
    child = np.flatnonzero(parent >= 0)
    weights = Weights(np.zeros(dom.FEATURES), np.zeros((dom.N_GROUPS, 2, 2)))
    seen = np.bincount(pairs[1], label[pairs[0]], dom.FEATURES)
    seen_pairs = np.zeros_like(weights.pair)
    np.add.at(seen_pairs, (group[child], label[parent[child]], label[child]), 1)
    first, second = np.zeros(dom.FEATURES + weights.pair.size), np.zeros(dom.FEATURES + weights.pair.size)
    for step in range(1, steps + 1):
        content, joint, _ = marginals(forest, by_depth, pairs, weights)
        expected = np.bincount(pairs[1], content[pairs[0]], dom.FEATURES)
        expected_pairs = np.zeros_like(weights.pair)
        np.add.at(expected_pairs, group[child], joint[child])
        point = np.concatenate([weights.content, weights.pair.ravel()])
        slope = np.concatenate([seen - expected, (seen_pairs - expected_pairs).ravel()]) / pages - PENALTY * point
        first = .9 * first + .1 * slope
        second = .99 * second + .01 * slope ** 2
        point = point + RATE * (first / (1 - .9 ** step)) / (np.sqrt(second / (1 - .99 ** step)) + 1e-8)
        weights = Weights(point[:dom.FEATURES], point[dom.FEATURES:].reshape(weights.pair.shape))
    return weights


def main_texts(pages: list[str | None], weights: Weights) -> list[str]:
    """The main text of each page; pages are worked on in lists of bounded length."""
    texts: list[str] = []
    begin, held = 0, 0
    for end in range(1, len(pages) + 1):
        held += len(pages[end - 1] or "")
        if held >= PIECE or end == len(pages):
            forest = dom.Forest(labelled=False)
            for number, source in enumerate(pages[begin:end]):
                forest.parse(number, source or "")
            by_depth = dom.levels(forest)
            content, _, _ = marginals(forest, by_depth, dom.features(forest, by_depth), weights)
            texts += dom.text_of(forest, content > .5, end - begin)
            begin, held = end, 0
    return texts


def fitted(spark: SparkSession) -> Weights:
    """The weights, fitted in one task; they are as many numbers as features."""
    schema = "content binary, pair binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _ in batches:
            weights = fit()
            yield pa.RecordBatch.from_arrays(
                [pa.array([weights.content.tobytes()]), pa.array([weights.pair.tobytes()])], ["content", "pair"])

    row = map_rows(spark.range(0, 1, 1, 1), schema, run).first()
    return Weights(np.frombuffer(row["content"]), np.frombuffer(row["pair"]).reshape(dom.N_GROUPS, 2, 2))


def extracted(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of every row; see the head of the module."""
    weights = pages.sparkSession.sparkContext.broadcast(fitted(pages.sparkSession))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = main_texts(batch.column(2).to_pylist(), weights.value)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    return map_rows(pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"),
                                 F.col("html").cast("string")),
                    "page_id long, url string, text string, n_chars long", run)


def op2_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extracted(table(spark, sf_dir, "pages"))


QUERIES = {"op2_extract": op2_extract}
ORACLES = {}
