import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from hourly_star.llm import repeats


def plain(docs):
    data = [(d, (t or "").encode()) for d, t in docs]
    seen = Counter(b[i:i + 200] for _, b in data for i in range(len(b) - 199))
    rows = []
    for doc_id, b in data:
        gone = np.zeros(len(b) + 1, bool)
        for i in range(len(b) - 199):
            if seen[b[i:i + 200]] > 1:
                gone[i:i + 200] = True
        runs = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        kept = bytes(x for x, g in zip(b, gone) if not g)
        rows.append((doc_id, len(b), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(rows, key=repr)


def noise(rng, n):
    return "".join(rng.choices("abcdefgh ijklé", k=n))


def check(spark, docs):
    frame = spark.createDataFrame([(*d, "clash") for d in docs], "doc_id long, text string, n_bytes string")
    got = sorted(map(tuple, repeats.deduplicated(spark, frame).collect()), key=repr)
    expected = plain(docs)
    assert got == expected
    return expected


@pytest.mark.parametrize("seed", range(3))
def test_passages_near_copies_and_overlaps(spark, seed):
    rng = random.Random(seed)
    passages = [noise(rng, n) for n in (150, 199, 200, 201, 260, 400, 900)]
    docs = []
    for i in range(40):
        text = "".join(rng.choice([noise(rng, rng.randint(0, 300)), rng.choice(passages)]) for _ in range(4))
        if docs and rng.random() < .4:  # a copy with a few changes, or a part of one
            text = rng.choice(docs)[1] or ""
            for _ in range(rng.randint(0, 3)):
                at = rng.randint(0, len(text))
                text = text[:at] + rng.choice(["", "Z", noise(rng, 5)]) + text[at + rng.randint(0, 2):]
            text = text[rng.choice([0, 0, 77]):]
        docs.append((i, text))
    expected = check(spark, docs)
    assert any(0 < r[2] < r[1] for r in expected)


def test_repeats_within_a_text_low_entropy_and_odd_rows(spark):
    rng = random.Random(7)
    part = noise(rng, 230)
    docs = [(1, part + noise(rng, 50) + part), (2, "a" * 700), (3, "ab" * 150 + "c"), (4, None), (5, ""),
            (6, "x" * 199), (None, part[:210]), (7, "ü" * 140), (8, "a" * 200), (9, "a" * 199),
            (10, noise(rng, 500)), (10, noise(rng, 500)), (11, None)]
    copy = noise(rng, 300)
    check(spark, docs + [(12, copy)] * 3 + [(13, copy[:250])])


def test_texts_longer_than_a_piece(spark, monkeypatch):
    monkeypatch.setattr(repeats, "PIECE", 256)
    rng = random.Random(2)
    shared = noise(rng, 600)
    found = [repeats.elected(np.frombuffer((noise(rng, n) + shared).encode(), np.uint8)) for n in (100, 333, 1000)]
    for at, first, last, rank in found:
        assert first[0] == 0 and (first[1:] == last[:-1] + 1).all()
        assert (at >= last).all() and (at - first <= repeats.REACH).all()


@pytest.mark.parametrize("seed", range(2))
def test_whole_operator_on_texts_longer_than_a_piece(spark, monkeypatch, seed):
    monkeypatch.setattr(repeats, "PIECE", 97)
    rng = random.Random(seed)
    passages = [noise(rng, n) for n in (205, 230, 290)]
    docs = [(i, "".join(noise(rng, rng.randint(1, 90)) + rng.choice(passages)[rng.randint(0, 40):]
                        for _ in range(4))) for i in range(40)]
    check(spark, docs)
    for _, text in docs:
        at, first, last, _ = repeats.elected(np.frombuffer(text.encode(), np.uint8))
        assert (at[1:] > at[:-1]).all() and (first[1:] == last[:-1] + 1).all()


def test_empty_table(spark):
    frame = spark.createDataFrame([], "doc_id long, text string")
    assert repeats.deduplicated(spark, frame).count() == 0
