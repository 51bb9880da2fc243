import random
from decimal import Decimal

import pytest

from pyspark.sql import functions as F

from hourly_star.llm import mixing
from hourly_star.llm.common import Scratch


def plain_targets(sizes):
    """Targets by resharing the excess until no source is above its cap."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    total, target, open_ = 1.5 * sum(sizes.values()), {s: 0.0 for s in names}, set(names)
    while open_:
        left = total - sum(target[s] for s in names if s not in open_)
        level = left / sum(weight[s] for s in open_)
        over = {s for s in open_ if weight[s] * level > 2 * sizes[s]}
        if not over:
            target.update({s: weight[s] * level for s in open_})
            break
        target.update({s: 2.0 * sizes[s] for s in over})
        open_ -= over
    return target


def documents(seed=1):
    rng = random.Random(seed)
    docs = []
    for source, count, top in (("a", 40, 300), ("b", 400, 200), ("Z", 30, 60), (None, 60, 200), ("é", 1, 9000),
                               ("tiny", 2, 3)):
        for _ in range(count):
            docs.append((len(docs), " \n".join(["w"] * rng.randint(0 if count > 2 else top, top)), source))
    return docs + [(5000, None, "a"), (5001, "", "none"), (None, "x y z", "a"), (7007, "same words", "b"), (7007, "same words", "b")]


def frame(spark, docs):
    return spark.createDataFrame([(*d, "clash", 3) for d in docs],
                                 "doc_id long, text string, source string, size string, n_chars long")


def test_targets_and_what_is_taken(spark):
    docs = documents()
    sizes = {}
    for _, text, source in docs:
        sizes[source] = sizes.get(source, 0) + len((text or "").split())
    expected = plain_targets(sizes)
    of = {d[0]: d for d in docs}
    rows = mixing.taken_words(spark, frame(spark, docs)).collect()
    assert len(rows) == len(docs)
    taken = {}
    for r in rows:
        _, text, source = of[r.doc_id]
        assert r.size == len((text or "").split()) and r.source_size == sizes[source]
        assert r.target == pytest.approx(expected[source])
        assert 0 <= r.taken <= 2 * r.size
        taken[source] = taken.get(source, 0) + r.taken
    for source, target in expected.items():
        assert abs(taken[source] - target) <= max(4 * mixing.BLOCK, .02 * target)
    again = mixing.taken_words(spark, frame(spark, docs).repartition(5)).collect()
    assert sorted(map(str, again)) == sorted(map(str, rows))


def test_many_small_sources_get_their_targets(spark):
    rng = random.Random(5)
    sizes = {f"s{i:04d}": rng.randint(1, 500) for i in range(2000)} | {"a": 400_000, "z": 300_000}
    docs = []
    for source, size in sizes.items():
        for begin in range(0, size, 5000):
            docs.append((len(docs), " ".join(["w"] * min(5000, size - begin)), source))
    source_of = {d[0]: d[2] for d in docs}
    taken = dict.fromkeys(sizes, 0)
    for r in mixing.taken_words(spark, frame(spark, docs)).collect():
        assert 0 <= r.taken <= 2 * r.size
        taken[source_of[r.doc_id]] += r.taken
    for source, target in plain_targets(sizes).items():
        assert abs(taken[source] - target) <= .501 + 1e-6 * target


def test_schedule_is_even_everywhere(spark):
    shares = spark.createDataFrame([("a", 300), ("b", 100), (None, 600)], "source string, wanted long")
    rows = sorted(mixing.schedule(Scratch(spark, "test"), shares).collect())
    assert [r.slot for r in rows] == list(range(1000))
    for source, share in (("a", .3), ("b", .1), (None, .6)):
        mine = [r for r in rows if r.source == source]
        assert [r.rank for r in mine] == list(range(len(mine)))
        assert abs(len(mine) - 1000 * share) <= 3
        for begin in range(0, 1000, 100):
            here = sum(begin <= r.slot < begin + 100 for r in mine)
            assert abs(here - 100 * share) <= 5


def test_stage_repeats_whole_documents(spark):
    docs = documents(2)
    docs = [d for d in docs if d[0] != 7007]  # a document with its own id each
    source = frame(spark, docs).withColumn("row", F.lit("clash"))
    mixed = mixing.mixed(spark, source)
    assert mixed.columns == source.columns
    of, times = {r.doc_id: r for r in source.collect()}, {}
    for r in mixed.collect():
        assert r == of[r.doc_id]
        times[r.doc_id] = times.get(r.doc_id, 0) + 1
    rows = mixing.taken_words(spark, source).collect()
    for r in rows:  # the last copy by which is nearer
        full, rest = divmod(r.taken, r.size) if r.size else (0, 0)
        assert times.get(r.doc_id, 0) == full + (r.size > 0 and 2 * rest >= r.size)
    partial = [r for r in rows if r.size and r.taken % r.size]
    assert len(partial) <= len({of[r.doc_id].source for r in rows})


def test_one_source_and_no_words(spark):
    rows = mixing.taken_words(spark, frame(spark, [(1, "a b c", "s"), (2, "d", "s")])).collect()
    assert sum(r.taken for r in rows) in (4, 6, 8) and {r.target for r in rows} == {6.0}
    rows = mixing.taken_words(spark, frame(spark, [(1, "", "s"), (2, None, None)])).collect()
    assert [(r.size, r.target, r.taken) for r in rows] == [(0, 0.0, 0)] * 2
    assert mixing.taken_words(spark, frame(spark, [])).count() == 0
    assert mixing.mixed(spark, frame(spark, [])).count() == 0


def test_weights_add_up():
    assert mixing.SHARE == Decimal("1.5") and mixing.POINTS > mixing.GOLDEN > mixing.POINTS // 2
