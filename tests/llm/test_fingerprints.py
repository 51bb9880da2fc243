import hashlib
import itertools
import math
import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from hourly_star.llm import fingerprints
from hourly_star.llm.common import Scratch, table

FULL = 2 ** 64


def mixed(x):
    x = (x ^ x >> 30) * 0xBF58476D1CE4E5B9 % FULL
    x = (x ^ x >> 27) * 0x94D049BB133111EB % FULL
    return x ^ x >> 31


def plain(text):
    """The fingerprint by the contract, term by term and bit by bit."""
    edge = 0x9E3779B97F4A7C15
    words = [xxhash.xxh64_intdigest(w) for w in (text or "").encode().lower().split()]
    if not words:
        return 0
    words = [edge, *words, edge]
    counts = {}
    for a, b in zip(words, words[1:]):
        term = mixed((a * 3 + b) % FULL)
        counts[term] = counts.get(term, 0) + 1
    votes = [0] * 256
    for term, n in counts.items():
        weight = round(16 * (1 + math.log(n)))
        for lane in range(4):
            h = mixed((term + (lane + 1) * edge) % FULL)
            for bit in range(64):
                votes[64 * lane + bit] += weight if h >> bit & 1 else -weight
    return sum(1 << i for i, v in enumerate(votes) if v > 0)


def number(fp):
    return int.from_bytes(fp.tobytes(), "little")


def drawn(seed, n=40):
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 7))) for _ in range(300)]
    return [" ".join(rng.choice(vocabulary) for _ in range(rng.randint(0, 90))) for _ in range(n)]


def test_fingerprints_follow_the_contract(monkeypatch):
    texts = [None, "", " \n", "one", "One", "a b", "a b a b a b", "É é 漢字 \x00 x", *drawn(1, 12)]
    for text in texts:
        assert number(fingerprints.fingerprint(text)) == plain(text)
    whole = [number(fingerprints.fingerprint(t)) for t in texts]
    monkeypatch.setattr(fingerprints, "SLICE", 7)
    monkeypatch.setattr(fingerprints, "BLOCK", 3)
    assert [number(fingerprints.fingerprint(t)) for t in texts] == whole
    assert fingerprints.fingerprint("word " * 400_000) is not None


def expected_rows(docs):
    prints = {t: plain(t) for _, t in docs}
    order = sorted(docs, key=lambda d: (d[0] is None, d[0] or 0))
    like = lambda a, b: 1 - (a ^ b).bit_count() / 256
    rows = []
    for (doc_id, text), (_, following) in zip(order, order[1:] + order[:1]):
        text, following = text or "", following or ""
        half = len(text) // 2
        edited = text[:len(text) - half] + following[:half]
        own, other = prints.get(text, 0), plain(edited)
        near = sum((own ^ p).bit_count() <= fingerprints.RADIUS for p in {*prints.values()} if p != own)
        hexed = lambda p: p.to_bytes(32, "little").hex()
        rows.append((doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), hexed(own), hexed(other),
                     like(own, other), like(own, prints.get(following, 0)), near))
    return sorted(rows, key=repr)


@pytest.mark.parametrize("partitions", [1, 7])
def test_rows_equal_brute_force(spark, partitions):
    texts = drawn(2) + [None, "", "x", "漢字 漢字"]
    long = " ".join(drawn(3, 60))
    texts += [long, long + " end", long, long.replace(" ", "\n", 3)]
    docs = list(enumerate(texts))
    random.Random(4).shuffle(docs)
    docs.append((None, "last of all"))
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(partitions)
    df = df.withColumn("fp", F.lit(1)).withColumn("part", F.lit(2)).withColumn("kind", F.lit(0))
    got = sorted(map(tuple, fingerprints.document_fingerprints(spark, df).collect()), key=repr)
    assert got == expected_rows(docs)
    assert any(r[-1] for r in got)


def test_repeated_rows_ties_and_empty_tables(spark):
    schema = "doc_id long, text string"
    docs = [(1, "same text here")] * 3 + [(2, "other text")]
    got = fingerprints.document_fingerprints(spark, spark.createDataFrame(docs, schema)).collect()
    assert sorted((r.doc_id, r.near_next == 1.0) for r in got) == [(1, False), (1, True), (1, True), (2, False)]
    assert fingerprints.document_fingerprints(spark, spark.createDataFrame([], schema)).collect() == []
    alone = fingerprints.document_fingerprints(spark, spark.createDataFrame([(5, "abcd")], schema)).collect()
    assert [(r.edited_sha256, r.near_next) for r in alone] == [(hashlib.sha256(b"abab").hexdigest(), 1.0)]


@pytest.mark.parametrize("radius, bucket", [(7, 16_384), (7, 5), (3, 2), (12, 64)])
def test_links_equal_brute_force_also_in_large_buckets(spark, radius, bucket):
    rng = random.Random(radius + bucket)
    prints = [rng.getrandbits(256) for _ in range(50)]
    for _ in range(150):  # a crowd around one fingerprint
        base = prints[0] if rng.random() < .6 else rng.choice(prints)
        prints.append(base ^ sum(1 << b for b in rng.sample(range(256), rng.randint(0, radius + 2))))
    prints = sorted(set(prints))
    df = spark.createDataFrame([(bytearray(p.to_bytes(32, "little")),) for p in prints], "fp binary")
    got = {int.from_bytes(r.fp, "little"): r.n_links
           for r in fingerprints.links_within(Scratch(spark, "test"), df, radius, bucket).collect()}
    expected = {}
    for a, b in itertools.combinations(prints, 2):
        if (a ^ b).bit_count() <= radius:
            expected[a] = expected.get(a, 0) + 1
            expected[b] = expected.get(b, 0) + 1
    assert got == expected


def test_blocks_share_out_all_bits():
    for radius in (1, 3, 7, 12):
        masks = fingerprints._masks(radius)
        assert len(masks) == radius + 1
        assert int(np.bitwise_count(masks).sum()) == 256 == int(np.bitwise_count(np.bitwise_or.reduce(masks)).sum())


def test_half_a_text_is_told_from_its_neighbour(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    rows = [r for r in fingerprints.document_fingerprints(spark, docs).collect() if r.n_chars > 100 and r.near_next < 1]
    assert sum(r.near_edited > r.near_next for r in rows) >= .98 * len(rows)
