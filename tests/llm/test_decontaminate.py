import random

import pytest

from hourly_star.llm import decontaminate as d


def plain_distance(pattern, text):
    row = [0] * (len(text) + 1)
    for i, c in enumerate(pattern, 1):
        new = [i]
        for j, x in enumerate(text, 1):
            new.append(min(row[j - 1] + (c != x), row[j] + 1, new[-1] + 1))
        row = new
    return min(row)


def plain_matches(docs, items):
    rows = []
    for doc_id, text in docs:
        for item_id, item in items:
            item, body = d.normal(item), d.normal(text)
            if any(c.isalnum() for c in item) and body:
                distance = plain_distance(item, body)
                if distance <= int(len(item) * d.ERROR_SHARE):
                    rows.append((doc_id, item_id, distance))
    return sorted(rows, key=repr)


def test_distance_equals_the_table():
    rng = random.Random(1)
    for _ in range(400):
        pattern = "".join(rng.choices("abç", k=rng.randint(1, 70)))
        text = "".join(rng.choices("abç", k=rng.randint(0, 90)))
        assert d.best_distance(pattern, text) == plain_distance(pattern, text)


def edited(rng, text, edits):
    for _ in range(edits):
        i = rng.randrange(len(text))
        text = rng.choice([text[:i] + text[i + 1:], text[:i] + "q" + text[i:], text[:i] + "z" + text[i + 1:]])
    return text


def data(seed, count=60):
    rng = random.Random(seed)
    words = ["lorem", "ipsum", "dolor", "sit", "amet", "Élan", "vita"]
    make = lambda n: " ".join(rng.choices(words, k=n))
    items = [(i, make(rng.randint(4, 25))) for i in range(8)]
    docs = []
    for i in range(count):
        text = make(rng.randint(0, 30))
        if rng.random() < .6:
            text += "\n " + edited(rng, rng.choice(items)[1], rng.randint(0, 12)).upper() + "  " + make(5)
        docs.append((i, text))
    return docs, items


@pytest.mark.parametrize("block", [4_000_000, 120])
def test_matches_equal_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(d, "BLOCK_CHARS", block)
    docs, items = data(4)
    docs += [(105, None), (105, ""), (None, items[0][1]), (107, items[1][1]), (107, items[1][1])]
    items += [(3, None), (4, ""), (None, "?!"), (20, items[2][1])]
    frame = spark.createDataFrame([(*x, "clash") for x in docs], "doc_id long, text string, item_id string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = sorted(map(tuple, d.contaminations(frame, bench).collect()), key=repr)
    expected = plain_matches(docs, items)
    assert got == expected and expected
    dirty = {x[0] for x in expected}
    kept = d.without_contaminated(frame, bench)
    assert kept.columns == frame.columns
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == sorted(
        (x[0] for x in docs if x[0] not in dirty or not x[1]), key=repr)


def test_item_in_a_very_long_text_and_repeated_text(spark):
    item = "the quick brown fox jumps over the lazy dog by the river"
    text = "the quick brown " * 60_000
    frame = spark.createDataFrame([(1, text), (2, text + item[:30] + "X" + item[31:] + text)], "doc_id long, text string")
    bench = spark.createDataFrame([(9, item)], "item_id long, text string")
    assert [tuple(r) for r in d.contaminations(frame, bench).collect()] == [(2, 9, 1)]


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "x")], "doc_id long, text string")
    bench = spark.createDataFrame([(1, "x")], "item_id long, text string")
    assert d.contaminations(docs.limit(0), bench).count() == 0
    assert d.contaminations(docs, bench.limit(0)).count() == 0
    assert d.without_contaminated(docs, bench.limit(0)).count() == 1
