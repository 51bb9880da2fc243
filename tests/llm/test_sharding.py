import zlib

import numpy as np
from pyspark.sql import functions as F

from hourly_star.llm import sharding


def documents(spark, count):
    rows = [(i, f"text {i % 7} é", "s") for i in range(count)] + [(None, None, None), (3, "", "x"), (3, "", "x")]
    return spark.createDataFrame(rows, "doc_id long, text string, law string")


def test_matrix_has_exact_margins_and_is_uniform():
    counts = [5, 0, 1000, 37, 1]
    for seed in range(50):
        matrix = sharding.communication_matrix(counts, 6, seed)
        assert matrix.sum(axis=1).tolist() == counts
        assert sorted(matrix.sum(axis=0)) == [173, 174, 174, 174, 174, 174]
        assert (matrix >= 0).all()
    cells = [sharding.communication_matrix([10, 30], 4, s)[0] for s in range(4000)]
    assert np.allclose(np.mean(cells, axis=0), 2.5, atol=.08)
    # variance of the hypergeometric law: 10 drawn of 40 rows, 10 of them in a shard
    assert np.allclose(np.var(cells, axis=0), 10 * .25 * .75 * 30 / 39, atol=.12)


def test_large_counts_keep_margins():
    counts = [3 * 10 ** 9, 7, 10 ** 9 + 1]
    matrix = sharding.communication_matrix(counts, 24)
    assert matrix.sum(axis=1).tolist() == counts
    assert matrix.sum(axis=0).max() - matrix.sum(axis=0).min() <= 1


def test_shards_slots_and_digests(spark):
    docs = documents(spark, 700).repartition(9)
    rows = sharding.sharded_ids(spark, docs).collect()
    assert len(rows) == 703
    shards = {}
    for r in rows:
        shards.setdefault(r.shard, []).append(r.slot)
        assert r.law == "rows" and r.grown_shard is None
    assert sorted(shards) == list(range(24))
    assert all(sorted(s) == list(range(len(s))) for s in shards.values())
    assert {len(s) for s in shards.values()} <= {29, 30}
    one = next(r for r in rows if r.doc_id == 12)
    assert (one.size, one.text_crc32) == (len("text 5 é".encode()) + 8, zlib.crc32("text 5 é".encode()))
    assert [(r.size, r.text_crc32) for r in rows if r.doc_id is None] == [(8, 0)]
    order = [r.doc_id or 0 for r in sorted(rows, key=lambda r: (r.shard, r.slot))]
    assert abs(np.corrcoef(order, range(len(order)))[0, 1]) < .15


def test_stage_keeps_rows_and_columns(spark):
    docs = documents(spark, 100)
    out = sharding.sharded(spark, docs)
    assert out.columns == [*docs.columns, "shard", "slot"]
    assert out.select(docs.columns).exceptAll(docs).count() == 0 and out.count() == docs.count()
    assert out.groupBy("shard").agg(F.max("slot").alias("m"), F.count("*").alias("n")).where("n <> m + 1").isEmpty()


def test_fewer_rows_than_shards_and_none(spark):
    assert sorted(r.slot for r in sharding.sharded_ids(spark, documents(spark, 2)).collect()) == [0] * 5
    assert sharding.sharded_ids(spark, documents(spark, 2).limit(0)).count() == 0
    assert sharding.sharded(spark, documents(spark, 2).limit(0)).count() == 0
