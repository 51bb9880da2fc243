import itertools
import random

import pytest
import xxhash
from pyspark.sql import functions as F

from hourly_star.llm import simhash
from hourly_star.llm.common import Scratch


def plain_fingerprint(text):
    words = [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode()
             .replace(b"\t", b" ").replace(b"\n", b" ").split(b" ") if w]
    if not words:
        return 0
    shingles = [b" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_classes(prints, radius=3):
    """Index of the class of each fingerprint, by looking at all pairs."""
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in itertools.combinations(range(len(prints)), 2):
        if (prints[i] ^ prints[j]).bit_count() <= radius:
            a, b = sorted((find(i), find(j)))
            root[b] = a
    return [find(i) for i in range(len(prints))]


def rows(spark, docs):
    return spark.createDataFrame(docs, "doc_id long, text string, lang string")


def test_fingerprints_follow_the_contract():
    for text in (None, "", " \t\n", "One", "one two", "one two three", "a b c d e a b c",
                 "É É é x y z" * 7, "word " * 200_000):
        assert simhash.fingerprint(text) == plain_fingerprint(text)


def test_hash_is_that_of_the_engine(spark):
    text = "thé quick brown fox"
    got = spark.range(1).select(F.xxhash64(F.lit(text))).first()[0]
    assert got % 2 ** 64 == xxhash.xxh64_intdigest(text.encode(), 42)


def test_masks_cover_every_pair_within_the_radius():
    rng = random.Random(5)
    for positions in (tuple(range(64)), tuple(range(3, 31)), (1, 5, 9, 40)):
        masks = simhash.covering_masks(positions)
        assert len(masks) == 15
        for _ in range(3000):
            changed = sum(1 << b for b in rng.sample(positions, rng.randint(1, 3)))
            assert any(not mask & changed for mask in masks)


@pytest.mark.parametrize("bucket", [2, 5, 2048])
def test_classes_equal_brute_force_also_in_large_buckets(spark, bucket):
    rng = random.Random(bucket)
    prints = [rng.getrandbits(64) for _ in range(60)]
    for _ in range(240):  # a crowd around one fingerprint, and chains away from it
        base = prints[0] if rng.random() < .6 else rng.choice(prints)
        prints.append(base ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 5))))
    signed = sorted({p - 2 ** 64 if p >= 2 ** 63 else p for p in prints})
    links = simhash.near_pairs(Scratch(spark, "test"), spark.createDataFrame(
        [(p,) for p in signed], "fp long"), bucket=bucket).collect()
    assert all(((a ^ b) % 2 ** 64).bit_count() <= 3 for a, b in links)
    root = {p: p for p in signed}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    for a, b in links:
        low, high = sorted((find(a), find(b)))
        root[high] = low
    expected = plain_classes([p % 2 ** 64 for p in signed])
    ours = [signed.index(find(p)) for p in signed]
    assert ours == expected


def test_rows_with_nulls_copies_and_ties(spark):
    long = " ".join(f"w{i}" for i in range(400))
    docs = [(5, long, "en"), (3, long + " tail", "en"), (9, None, None), (2, "", "x"),
            (None, long, None), (5, long, "en"), (7, "short", "de"), (None, "alone here now", "")]
    frame = rows(spark, docs).withColumn("component_id", F.lit("clash"))
    got = sorted(map(tuple, simhash.near_duplicates(spark, frame).collect()), key=repr)
    prints = [plain_fingerprint(t) for _, t, _ in docs]
    classes = plain_classes(prints)
    least = {c: min((d[0] for d, k in zip(docs, classes) if k == c and d[0] is not None),
                    default=None) for c in classes}
    assert got == sorted([(d[0], f"{p:016x}", least[c])
                          for d, p, c in zip(docs, prints, classes)], key=repr)


def test_empty_table(spark):
    assert simhash.near_duplicates(spark, rows(spark, [])).count() == 0
