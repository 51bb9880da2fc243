import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from hourly_star.llm import subwords, toxicity

RUDE = ["dimwit", "numbskull", "blockhead", "scoundrel"]
SYLLABLES = "ba ce di fo gu ha je ki lo mu na pe ri so tu".split()


def text(rng, rude):
    words = ["".join(rng.choices(SYLLABLES, k=rng.randint(1, 3))) for _ in range(rng.randint(5, 80))]
    for _ in range(2 * rude):
        words.insert(rng.randrange(len(words)), rng.choice(RUDE) + rng.choice(["", ",", "!"]))
    return " ".join(words)


def tables(spark, count=900, seed=3):
    rng = random.Random(seed)
    toxic = [int(rng.random() < .3) for _ in range(count)]
    docs = [(i, text(rng, t), "en", "clash") for i, t in enumerate(toxic)]
    labels = [(i, t) for i, t in enumerate(toxic)]
    return (spark.createDataFrame(docs, "doc_id long, text string, lang string, score string"),
            spark.createDataFrame(labels, "doc_id long, toxic int"))


def fold(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 3 == 1


def test_held_out_texts_and_unseen_spellings(spark):
    docs, labels = tables(spark)
    truth = dict(map(tuple, labels.collect()))
    got = toxicity.scored(docs, labels).collect()
    assert len(got) == len(truth)
    assert all(r.held_out == fold(r.doc_id) for r in got)
    assert all(r.predicted == (r.score >= .7) and 0 <= r.score <= 1 for r in got)
    right = [r.predicted == truth[r.doc_id] for r in got if r.held_out]
    assert np.mean(right) > .97
    rng = random.Random(8)
    odd = spark.createDataFrame(
        [(i, text(rng, 0) + (" dimmwit numbskulls " if i % 2 else " ") + text(rng, 0)) for i in range(40)],
        "doc_id long, text string")
    scores = {r.doc_id: r.score for r in toxicity.with_scores(odd, toxicity.fit(docs, labels)).collect()}
    assert np.mean([scores[i] >= .7 for i in range(1, 40, 2)]) >= .85
    assert np.mean([scores[i] >= .7 for i in range(0, 40, 2)]) < .1


def test_labels_of_held_out_rows_do_not_matter(spark):
    docs, labels = tables(spark, 300)
    other = labels.withColumn("toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic"))
                              .otherwise(F.col("toxic")))
    one, two = (sorted(map(tuple, toxicity.scored(docs, x).collect())) for x in (labels, other))
    assert one == two


def test_nulls_copies_and_long_texts(spark):
    docs, labels = tables(spark, 300)
    long = " ".join(SYLLABLES * 20_000)
    odd = spark.createDataFrame(
        [(1001, None, None, None), (1001, None, None, None), (1002, "", "x", ""), (None, "!!! ---", "x", ""),
         (1007, long + " dimwit scoundrel " + long, "", ""), (1008, "a" * 700_000, "", ""), (1009, long, "", "")],
        docs.schema)
    model = toxicity.fit(docs, labels.union(spark.createDataFrame([(1, None), (None, 1), (10 ** 6, 1)], labels.schema)))
    scores = toxicity.with_scores(odd, model).collect()
    share = model[2]
    assert [r.score for r in scores if r.doc_id in (1001, 1002, None)] == [share] * 4
    by_id = {r.doc_id: r.score for r in scores}
    assert by_id[1007] >= .7 > by_id[1009]
    kept = toxicity.without_toxic(docs.union(odd), labels)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.where("length(text) > 800000 or text is null").collect()} >= {1001, 1009}


def test_no_labels_and_no_documents(spark):
    docs, labels = tables(spark, 60)
    assert {r.score for r in toxicity.scored(docs, labels.limit(0)).collect()} == {0.0}
    assert {r.score for r in toxicity.scored(docs, labels.withColumn("toxic", F.lit(1))).collect()} == {1.0}
    assert toxicity.scored(docs.limit(0), labels).count() == 0


def test_words_and_buckets():
    bags = subwords.bags_of(["a (Bcd), --", "", "x"])
    assert bags.text.tolist() == [0, 0, 2]
    assert bags.sizes.tolist() == [2, 7, 2]  # <a> and itself; three, two and one n-grams of <bcd> and itself
    again = subwords.bags_of(["a bcd x".replace("b", "B")])
    assert again.buckets.tolist()[:2] == bags.buckets.tolist()[:2]


def test_worst_window_does_not_depend_on_its_place(monkeypatch):
    words = [w for w in ("".join(p) for p in zip(SYLLABLES, SYLLABLES[1:])) if len(w) > 3]
    scores = np.zeros(subwords.BUCKETS, np.float32)
    scores[subwords.bags_of(RUDE).buckets] = 2
    scores[subwords.bags_of(words + ["."]).buckets] = 0
    rng = random.Random(4)

    def plain(text):
        bags = subwords.bags_of([text])
        each = bags.word_scores(scores)
        return max(sum(each[i:i + 5]) / 5 for i in range(max(1, len(each) - 4)))

    def calm(n):
        return rng.choices(words, k=n)

    texts = [" ".join(calm(n) + RUDE[:k] + calm(m)) for k in (1, 2, 3, 4) for n, m in ((0, 0), (4, 9), (11, 3), (300, 50))]
    for piece in (1 << 18, 40):
        monkeypatch.setattr(subwords, "PIECE", piece)
        base = subwords.worst_windows(texts, scores)
        assert base.tolist() == [plain(t) for t in texts]
        for n in range(5):
            shifted = [" ".join(calm(n) + [t]) for t in texts]
            assert subwords.worst_windows(shifted, scores).tolist() == base.tolist()
    odd = ["", "one . . - two", None, "!!", " ".join(RUDE) + " -" * 60, "x " * 7]
    assert np.isnan(subwords.worst_windows(odd, scores)).tolist() == [True, False, True, True, False, False]
    assert subwords.worst_windows(odd, scores)[4] == plain(odd[4])
