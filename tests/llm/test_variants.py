import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from hourly_star.llm import variants
from hourly_star.llm.common import Scratch


def plain_words(docs):
    counts = {}
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= 6:
                counts[run] = counts.get(run, 0) + 1
    return {w: n for w, n in counts.items() if n >= 5}


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return len(long) - len(short) == 1 and any(long[:i] + long[i + 1:] == short for i in range(len(long)))


def plain_variants(docs):
    words = plain_words(docs)
    found = {w: [o for o in words if o != w and near(w, o)] for w in words}
    form = {}
    for w, others in found.items():
        best = min(others, key=lambda o: (-words[o], o), default=None)
        form[w] = best if best and words[best] >= 5 * words[w] else None
    rows = set()
    for w in words:
        root = w
        while form[root]:
            root = form[root]
        rows.add((w, form[w], root, words[w], len(found[w]), words.get(form[w])))
    return rows


def misspelt(rng, word):
    i, letter = rng.randrange(len(word)), rng.choice("aeioué÷×ÿzst")
    return rng.choice([word[:i] + word[i + 1:], word[:i] + letter + word[i:],
                       word[:i] + letter + word[i + 1:]])


def drawn(seed, n_docs=120):
    rng = random.Random(seed)
    stems = ["".join(rng.choice("aabestoné") for _ in range(rng.randint(5, 11))) for _ in range(40)]
    stems += ["aaaaaa", "aaaaaaa", "x" * 70, "x" * 71, "y" * 64, "y" * 63 + "z", "ÿ" * 90 + "é" * 90]
    docs = []
    for i in range(n_docs):
        words = []
        for _ in range(150):
            word = rng.choice(stems[:6] if rng.random() < .5 else stems)
            while rng.random() < .3:
                word = misspelt(rng, word)
            words.append(rng.choice([word, word.upper(), word.title()]))
        docs.append((None if i == 7 else i // 2, rng.choice(["; ", " ", "\n", "9"]).join(words)))
    chain = [(900 + i, " ".join(["planted"] * 6 + ["plantes"] * (i < 40) + ["plantesx"] * (i < 6))) for i in range(60)]
    return docs + chain + [(500, None), (501, ""), (502, "\x00 12 _"), (503, docs[0][1]), (503, docs[0][1])]


def frame(spark, docs):
    return spark.createDataFrame(docs, "doc_id long, text string")


@pytest.mark.parametrize("seed", [1, 2])
def test_rows_equal_brute_force(spark, seed):
    docs = drawn(seed)
    df = frame(spark, docs).withColumn("word", F.lit("clash")).withColumn("n", F.lit(1)).withColumn("run", F.lit(2))
    got = [tuple(r) for r in variants.spelling_variants(spark, df).collect()]
    expected = plain_variants(docs)
    assert set(got) == expected and len(got) == len(expected)
    assert any(form not in (None, root) for _, form, root, *_ in expected)  # chains occur


def test_many_small_filters_give_the_same_pairs(spark):
    docs = drawn(3, 60)
    words = plain_words(docs)
    scratch = Scratch(spark, "test")
    hashed = scratch.keep(variants._hashed(spark.createDataFrame(list(words.items()), "word string, n long")))
    expected = {frozenset((a, b)) for a in words for b in words if a < b and near(a, b)}
    for part_bytes, round_bytes in ((16, 1), (64, 8192), (1 << 22, 1 << 25)):
        pairs = variants.near_words(scratch, hashed, part_bytes, round_bytes).collect()
        assert {frozenset((r.word, r.other)) for r in pairs} == expected and len(pairs) == len(expected)


def test_rounds_are_bounded_and_cover_all_filters():
    layout = variants.Layout({6: 10_000_000, 7: 3, 64: 50_000_000})
    rounds = layout.rounds()
    sizes = {(s, p): b for s, p, b in layout.filters()}
    assert sorted(k for r in rounds for k in r) == sorted(sizes)
    assert all(sum(sizes[k] for k in r) <= variants.ROUND_BYTES for r in rounds)
    assert sum(sizes.values()) >= 60_000_000 * variants.BITS_A_WORD // 8


def test_hashes_of_edits_are_those_of_the_edited_words():
    word = "bananañaa"
    made = {(size, int(h)) for size, _, hashes in variants.edits(np.stack([variants._codes(word)])) for h in hashes}
    letters = [chr(c) for c in variants.ALPHABET]
    expected = {(len(word) - 1, variants.word_hash(word[:i] + word[i + 1:])) for i in range(len(word))}
    expected |= {(len(word), variants.word_hash(word[:i] + c + word[i + 1:]))
                 for i in range(len(word)) for c in letters if c > word[i]}
    assert made == expected


def test_filters_hold_every_word_and_few_others(spark):
    rng = random.Random(9)
    words = {"".join(rng.choice("abcdefgh") for _ in range(8)) for _ in range(20_000)}
    scratch = Scratch(spark, "test")
    hashed = scratch.keep(variants._hashed(spark.createDataFrame([(w, 5) for w in words], "word string, n long")))
    layout = variants.Layout({8: len(words)}, 4096)
    filters = variants._filters(hashed, layout, [(s, p) for s, p, _ in layout.filters()])

    def passes(word):
        part, block, mask = layout.place(8, np.array([variants.word_hash(word)], np.uint64))
        return filters[8, int(part[0])][block[0]] & mask[0] == mask[0]

    assert all(passes(w) for w in list(words)[:5000])
    others = [w for w in ("".join(rng.choice("ijklmnop") for _ in range(8)) for _ in range(5000))]
    assert sum(map(bool, map(passes, others))) < 100


def test_a_very_long_run_and_empty_tables(spark):
    long = "ab" * 30_000
    docs = [(i, f"{long} {long}s") for i in range(5)]
    assert plain_words(docs) == {long: 5, long + "s": 5}
    assert {tuple(r) for r in variants.spelling_variants(spark, frame(spark, docs)).collect()} == {
        (long, None, long, 5, 1, None), (long + "s", None, long + "s", 5, 1, None)}
    for empty in ([], [(1, None), (2, "short")]):
        assert variants.spelling_variants(spark, frame(spark, empty)).collect() == []
