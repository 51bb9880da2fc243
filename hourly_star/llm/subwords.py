"""Subword-bag text classifier in numpy: train on a bounded sample, score whole texts.

A word is the average of the vectors of its character n-grams (and of the word
itself), a window the average of its words, and a linear softmax over the
window vector says how likely label 1 is. A text is as toxic as its `WORST`
worst windows on average, so a few words in a long text still count, and one
word that looks odd by chance does not. Embeddings and softmax are trained
together. A misspelling nobody has seen shares most n-grams, and so most of its
vector, with the word it stands for; n-grams that only one text has are not
learnt, as they would only know that text by heart.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

GRAMS = (3, 4, 5)
BUCKETS = 1 << 18
DIMENSIONS = 8
WINDOW = 5
WORST = 10  # windows; a word is in five of them, so two words apart count in full
PIECE = 1 << 18  # code points worked on at a time, whatever the length of a text
_PRIME = np.uint64(0x9E3779B97F4A7C15)
_OPEN, _CLOSE = ord("<"), ord(">")
_SPACE, _INSIDE, _LETTER = 0, 1, 2
_SPACES = re.compile(r"\s")
_kinds: list[np.ndarray] = []


def _kind_of() -> np.ndarray:
    """Per code point: white space, letter or digit, or else; made once a worker."""
    if not _kinds:
        kinds = np.full(0x110000, _INSIDE, np.uint8)
        for point in range(0x110000):
            c = chr(point)
            if c.isspace():
                kinds[point] = _SPACE
            elif c.isalnum():
                kinds[point] = _LETTER
        _kinds.append(kinds)
    return _kinds[0]


@dataclass
class Bags:
    """Words of some texts, and the hash buckets of each word's n-grams."""

    text: np.ndarray  # number of the text, for each word
    sizes: np.ndarray  # number of buckets, for each word
    buckets: np.ndarray  # of all words, one word after another
    marks: np.ndarray  # a hash of the whole word

    def word_scores(self, bucket_scores: np.ndarray) -> np.ndarray:
        if not len(self.sizes):
            return np.zeros(0)
        starts = np.cumsum(self.sizes) - self.sizes
        return np.add.reduceat(bucket_scores[self.buckets], starts) / self.sizes


def bags_of(texts: list[str]) -> Bags:
    """Lower-cased words between white space, without the punctuation around
    them, as n-grams of "<word>" and the word itself."""
    points = np.frombuffer(" ".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    lengths = np.array([len(t) for t in texts], np.int64) + 1
    kinds = _kind_of()[points]
    solid = np.concatenate([[False], kinds != _SPACE, [False]])
    edges = np.flatnonzero(solid[1:] != solid[:-1])
    first, last = edges[0::2], edges[1::2]  # words are [first, last)
    letters = np.flatnonzero(kinds == _LETTER)
    begin, end = np.searchsorted(letters, first), np.searchsorted(letters, last)
    kept = begin < end
    if not kept.any():
        none = np.zeros(0, np.int64)
        return Bags(none, none, none, none)
    first, last = letters[begin[kept]], letters[end[kept] - 1] + 1
    text = np.searchsorted(np.cumsum(lengths), first, side="right")

    size = last - first + 2
    stop = np.cumsum(size)
    word = np.repeat(np.arange(len(size)), size)
    place = np.arange(stop[-1]) - (stop - size)[word]
    source = np.clip(first[word] + place - 1, 0, len(points) - 1)
    marked = points[source].astype(np.uint64)
    marked[stop - size], marked[stop - 1] = _OPEN, _CLOSE
    left = size[word] - place  # code points from here to the end of the word
    rolled = (marked + np.uint64(1)) * _PRIME
    value, parts, owner = rolled.copy(), [], []
    for n in range(2, max(GRAMS) + 1):
        value[:-1] = (value[:-1] ^ (value[:-1] >> np.uint64(29))) * _PRIME
        value[:len(value) - n + 1] += rolled[n - 1:]
        if n in GRAMS:
            whole = np.flatnonzero(left >= n)
            parts.append(value[whole] + np.uint64(n))
            owner.append(word[whole])
    powers = _powers(int(size.max()))
    marks = np.add.reduceat(rolled * powers[place], stop - size)
    parts.append(marks)
    owner.append(np.arange(len(size)))
    owner = np.concatenate(owner)
    values = np.concatenate(parts)
    values = ((values ^ (values >> np.uint64(31))) * _PRIME) >> np.uint64(64 - 18)
    by_word = np.argsort(owner, kind="stable")
    return Bags(text, np.bincount(owner, minlength=len(size)), values[by_word].astype(np.int64), marks)


def _powers(count: int) -> np.ndarray:
    powers = np.full(count, np.uint64(0xD6E8FEB86659FD93))
    powers[0] = 1
    return np.cumprod(powers)


def _pieces(texts: list[str | None]) -> tuple[list[list[str]], list[list[int]]]:
    """Lower-cased texts in lists of bounded length; a long text is cut at white space."""
    lists, numbers, held = [[]], [[]], 0
    for number, text in enumerate(texts):
        text = (text or "").lower()
        for piece in _cuts(text) if len(text) > PIECE else (text,):
            if held + len(piece) > PIECE and lists[-1]:
                lists.append([])
                numbers.append([])
                held = 0
            lists[-1].append(piece)
            numbers[-1].append(number)
            held += len(piece)
    return lists, numbers


def _cuts(text: str) -> Iterator[str]:
    """A text in pieces that end at the first white space from PIECE code points on."""
    begin = 0
    while begin < len(text):
        space = _SPACES.search(text, begin + PIECE)
        end = space.start() if space else len(text)
        yield text[begin:end]
        begin = end + 1


def worst_windows(texts: list[str | None], bucket_scores: np.ndarray, count: int = 1) -> np.ndarray:
    """For each text the mean of its `count` highest windows (of all, if it has fewer);
    NaN if it has no word.

    A window is the average of five consecutive words; a text of fewer words is
    one window, which counts the missing words as neutral. The last four words of
    a piece go on into the next piece of the text.
    """
    best = np.full((len(texts), count), -np.inf)  # highest first
    lists, numbers = _pieces(texts)
    text, scores = np.zeros(0, np.int64), np.zeros(0)
    for at, piece in enumerate(lists):
        bags = bags_of(piece)
        text = np.concatenate([text, np.array(numbers[at])[bags.text]])
        scores = np.concatenate([scores, bags.word_scores(bucket_scores)])
        open_ = numbers[at + 1][0] if at + 1 < len(lists) else -1  # the text that may go on
        if len(text):
            starts, totals = _windows(text, scores)
            owner = text[starts]
            short = np.bincount(text, minlength=len(texts))[owner] < WINDOW
            known = ~short | ((owner != open_) & np.isneginf(best[owner, 0]))
            top, place = _highest(owner[known], totals[known], count)
            new = np.full_like(best, -np.inf)
            new[owner[known][top], place] = totals[known][top]
            best = -np.sort(-np.concatenate([best, new], axis=1), axis=1)[:, :count]
        held = np.flatnonzero(text == open_)[1 - WINDOW:]
        text, scores = text[held], scores[held]
    there = ~np.isneginf(best)
    return np.where(there[:, 0], np.where(there, best, 0).sum(1) / np.maximum(there.sum(1), 1), np.nan)


def _windows(text: np.ndarray, scores: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First word and average of every window; windows never cross texts."""
    begins = np.flatnonzero(np.concatenate([[True], text[1:] != text[:-1]]))
    counts = np.diff(np.append(begins, len(text)))
    ends = np.repeat(begins + counts, counts)
    first = np.arange(len(text))
    starts = np.flatnonzero((first + WINDOW <= ends) | (first == ends - np.repeat(counts, counts)))
    padded, stop = np.append(scores, np.zeros(WINDOW - 1)), ends[starts]
    totals = np.zeros(len(starts))
    for step in range(WINDOW):
        totals += np.where(starts + step < stop, padded[starts + step], 0)
    return starts, totals / WINDOW


def _highest(owner: np.ndarray, totals: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the `count` highest windows of every text, and their places among them."""
    order = np.lexsort((-totals, owner))
    sizes = np.unique(owner, return_counts=True)[1]
    place = np.arange(len(order)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    top = place < count
    return order[top], place[top]


def probability(logits: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(logits, -60, 60)))


def _vocabulary(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Text and number of every word, and the bag of each different word."""
    known: dict[int, int] = {}
    text, word, sizes, buckets = [], [], [], []
    for begin in range(0, len(texts), 64):
        bags = bags_of(texts[begin:begin + 64])
        marks, at, inverse = np.unique(bags.marks, return_index=True, return_inverse=True)
        new = np.array([m not in known for m in marks.tolist()], bool)
        known.update(zip(marks[new].tolist(), range(len(known), len(known) + int(new.sum()))))
        numbers = np.array([known[m] for m in marks.tolist()], np.int64)
        n = bags.sizes[at[new]]
        from_ = (np.cumsum(bags.sizes) - bags.sizes)[at[new]]
        buckets.append(bags.buckets[
            np.repeat(from_ - (np.cumsum(n) - n), n) + np.arange(n.sum())].astype(np.int32))
        sizes.append(n)
        text.append(bags.text + begin)
        word.append(numbers[inverse])
    return tuple(np.concatenate(x).astype(t) for x, t in (
        (text, np.int64), (word, np.int64), (sizes, np.int64), (buckets, np.int32)))


@dataclass
class Model:
    """The trained model; for scoring, a bucket is its vector times the softmax weights."""

    embeddings: np.ndarray
    weights: np.ndarray  # one row for each label
    biases: np.ndarray

    def bucket_scores(self) -> np.ndarray:
        return (self.embeddings @ (self.weights[1] - self.weights[0])).astype(np.float32)

    def bias(self) -> float:
        return float(self.biases[1] - self.biases[0])


def _frequent(text: np.ndarray, word: np.ndarray, sizes: np.ndarray, buckets: np.ndarray) -> np.ndarray:
    """Whether a bucket is one of at least two texts."""
    first, last = np.full(BUCKETS, np.iinfo(np.int64).max), np.full(BUCKETS, -1)
    lowest, highest = np.full(len(sizes), np.iinfo(np.int64).max), np.full(len(sizes), -1)
    np.minimum.at(lowest, word, text)
    np.maximum.at(highest, word, text)
    np.minimum.at(first, buckets, np.repeat(lowest, sizes))
    np.maximum.at(last, buckets, np.repeat(highest, sizes))
    return first < last


def train(texts: list[str], labels: list[int], seed: int = 11, warm: int = 2, epochs: int = 24,
          batch: int = 64, rate: float = 0.5) -> Model:
    """Train on whole texts; the same input gives the same model.

    Two epochs average over the whole text, which tells common from telling
    n-grams. The others learn from the worst windows of each text, as the
    model of the epoch's start sees them.
    """
    text, word, sizes, buckets = _vocabulary([(t or "").lower() for t in texts])
    starts = np.cumsum(sizes) - sizes
    different = Bags(np.zeros(0), sizes, buckets, np.zeros(0))

    def spread(words: np.ndarray, shares: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Buckets of the words, each one's share of its word, and the word's place."""
        n = sizes[words]
        ends = np.cumsum(n)
        places = np.repeat(np.arange(len(words)), n)
        return (buckets[np.arange(ends[-1]) + np.repeat(starts[words] - ends + n, n)],
                (shares / n)[places], places)

    y = np.array(labels, np.float64)
    rng = np.random.default_rng(seed)
    learnt = _frequent(text, word, sizes, buckets)
    e = rng.uniform(-.5, .5, (BUCKETS, DIMENSIONS)) / DIMENSIONS * learnt[:, None]
    v = rng.uniform(-.5, .5, (2, DIMENSIONS))
    b = np.zeros(2)
    grown = np.full(BUCKETS, .1)  # first steps are small, so rare n-grams are not learnt by heart
    heavier = max(1.0, min(8.0, (y == 0).sum() / max(1, (y == 1).sum())))
    lengths = np.bincount(text, minlength=len(y))
    begins = np.cumsum(lengths) - lengths
    order = np.flatnonzero(lengths)
    for epoch in range(warm + epochs):
        if epoch < warm:
            spans = [[(begins[i], begins[i] + lengths[i], lengths[i])] for i in range(len(y))]
        else:
            firsts, totals = _windows(text, different.word_scores(e @ (v[1] - v[0]))[word])
            top, _ = _highest(text[firsts], totals, WORST)
            found = np.bincount(text[firsts[top]], minlength=len(y)) * WINDOW
            spans = [[] for _ in y]
            for i, first in zip(text[firsts[top]].tolist(), firsts[top].tolist()):
                spans[i].append((first, min(first + WINDOW, begins[i] + lengths[i]), found[i]))
        rng.shuffle(order)
        for start in range(0, len(order), batch):
            docs = order[start:start + batch]
            chosen = [(place, *span) for place, i in enumerate(docs) for span in spans[i]]
            doc, lo, hi, size = (np.array(x) for x in zip(*chosen))
            n = hi - lo
            ends = np.cumsum(n)
            words = word[np.arange(ends[-1]) + np.repeat(lo - ends + n, n)]
            hits, share, place = spread(words, np.repeat(1 / size, n))
            slope = v[1] - v[0]
            used, inverse = np.unique(hits, return_inverse=True)
            doc_of = np.repeat(doc, n)[place]
            z = np.bincount(doc_of, (e[used] @ slope)[inverse] * share, len(docs)) + b[1] - b[0]
            g = (probability(z) - y[docs]) * np.where(y[docs] == 1, heavier, 1)
            c = np.bincount(inverse, share * g[doc_of], len(used)) * learnt[used]
            toward = c @ e[used]
            grown[used] += c * c
            e[used] -= (rate * c / np.sqrt(grown[used]))[:, None] * slope
            step = rate * .05 * toward / max(1.0, float(np.linalg.norm(toward)))
            v[1] -= step
            v[0] += step
            step = rate * .02 * g.sum() / batch
            b[1] -= step
            b[0] += step
    return Model(e, v, b)
