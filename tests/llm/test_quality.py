import random
import re
from collections import Counter

import numpy as np

from hourly_star.llm import quality

SPACE = r"[\x20\x09-\x0D]"


def plain(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    many = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if many[w] > 1 for k in range(5)}
    lines, duplicates = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            duplicates += line in lines
            lines.add(line)
    n = len(words)
    failed = n < 10 or 100 * len(covered) > 20 * n
    return (n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), duplicates, len(covered), failed)


def german(rng, n):
    return " ".join(rng.choice(quality.COMMON["de"] + ["haus", "baum", "schöne", "Straße", "laufen"] * 5)
                    for _ in range(n))


def english(rng, n):
    return " ".join(rng.choice(quality.COMMON["en"] + ["house", "tree", "lovely", "street", "running,"] * 5)
                    for _ in range(n)) + "."


def test_base_counts_equal_brute_force(spark):
    rng = random.Random(2)
    parts = ["a", "b", "Ünï", "#*$", "x|y", "\n", "\n\n", "\t", "a b c d e", "a b c d e", "\x0b", " ", " "]
    texts = ["".join(rng.choice(parts) + rng.choice([" ", "", "\n"]) for _ in range(rng.randint(0, 60)))
             for _ in range(200)] + [None, "", " \n ", "w " * 50_000, "same line\nsame line\n\n\nsame line"]
    frame = spark.createDataFrame([(i, t, "xx", 1) for i, t in enumerate(texts)],
                                  "doc_id long, text string, lang string, n_words int")
    rows = sorted(quality.rules(spark, frame).collect(), key=lambda r: r.doc_id)
    got = [(r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in rows]
    assert got == [plain(t) for t in texts]
    assert all(r.kept == (not r.base_failed) for r in rows)  # no listed language: base alone decides


def test_divergence_keeps_texts_and_drops_junk(spark):
    rng = random.Random(3)
    good = [(german if i % 3 == 0 else english)(rng, rng.randint(25, 400)) for i in range(300)]
    junk = [" ".join(w.upper() + "!!" for w in english(rng, 200).split()),
            " ".join(w + "%%%" for w in german(rng, 300).split()),
            " ".join(f"q{rng.randint(0, 10 ** 6)}z |" for _ in range(300))]
    odd = [" ".join(f"слово{i}" for i in range(100))]
    rows = [(i, t, "de" if i % 3 == 0 else "en") for i, t in enumerate(good)]
    rows += [(1000 + i, t, "en") for i, t in enumerate(junk)] + [(2000, odd[0], "ru"), (2001, good[1], None),
                                                                (2002, good[0], "en"), (None, good[2], "en")]
    got = {r.doc_id: r for r in quality.rules(spark, spark.createDataFrame(
        rows, "doc_id long, text string, lang string")).collect()}
    assert np.mean([got[i].kept for i in range(300) if not got[i].base_failed]) == 1
    assert not any(got[1000 + i].kept for i in range(3))
    assert got[2000].kept and got[2001].kept and got[2002].kept and got[None].kept


def test_distance():
    p = np.array([[1.0, 0], [.5, .5], [0, 1.0]])
    assert np.allclose(quality.distance(p, np.array([.5, .5])), [0.5579230452841438, 0, 0.5579230452841438])
    assert np.allclose(quality.distance(p[:1], np.array([0, 1.0])), 1)


def test_empty_table(spark):
    assert quality.rules(spark, spark.createDataFrame([], "doc_id long, text string, lang string")).count() == 0
