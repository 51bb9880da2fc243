import random
import re

import pytest

from hourly_star.llm import licenses


def plain(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)
    places, labels = [], set()
    for phrase, label in licenses.PHRASES.items():
        p = phrase.split()
        for i in range(len(words) - len(p) + 1):
            if words[i:i + len(p)] == p:
                places.append(i)
                labels.add(label)
    return (len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels)))


def scan(spark, texts):
    frame = spark.createDataFrame([(i, t, "clash", 5) for i, t in enumerate(texts)],
                                  "doc_id long, text string, labels string, n_words int")
    return sorted(licenses.scan(spark, frame).collect(), key=lambda r: r.doc_id)


def test_base_columns_equal_brute_force(spark):
    rng = random.Random(1)
    parts = ["MIT License", "apache-license", "general   public\nLICENSE", "mit", "license", "general", "public",
             "Éte", "x_y", "MİT license", "a1", "", "--", "gnu general", "the", "of the", "\x00", "mit\x7flicense"]
    texts = [" ".join(rng.choices(parts, k=rng.randint(0, 40))) for _ in range(150)]
    texts += [None, "", " - ", "mit", "mit license", "mit license mit license", "x " * 120_000 + "mit license"]
    rows = scan(spark, texts)
    assert [(r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in rows] == [plain(t) for t in texts]
    for r in rows:
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(","))
        assert 0 <= r.score <= 1 and (r.score > 0) == bool(r.labels)


@pytest.mark.parametrize("label,text", licenses.NOTICES)
def test_notices_whole_and_with_changes(spark, label, text):
    words = text.split()
    filler = "some words before it all of the and under"
    longer = [*words[:len(words) // 2], "really", *words[len(words) // 2:]]
    texts = [f"{filler} {text} {filler}", f"{filler}\n{' '.join(longer).upper()}!", " ".join(words[:len(words) // 2]),
             " ".join(reversed(words)), f"{text}. {text}"]
    rows = scan(spark, texts)
    found = [label in r.labels.split(",") for r in rows]
    assert found[0] and found[4] and rows[0].score == 1.0
    if len(words) >= 12:
        assert found[1] and not found[2]
    assert not found[3]


def test_same_rows_and_empty_table(spark):
    frame = spark.createDataFrame([(1, "mit license"), (1, "mit license"), (None, "x")], "doc_id long, text string")
    rows = licenses.scan(spark, frame)
    assert sorted((r.doc_id or 0, r.n_base) for r in rows.collect()) == [(0, 0), (1, 1), (1, 1)]
    assert licenses.scan(spark, frame.limit(0)).count() == 0


def test_no_python_and_no_shuffle_of_texts(spark):
    frame = spark.createDataFrame([(1, "mit license")], "doc_id long, text string")
    plan = licenses.votes(frame)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "ArrowEval" not in plan
    assert plan.count("BroadcastHashJoin") >= 1 and "SortMergeJoin" not in plan
