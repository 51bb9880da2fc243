import random

from pyspark.sql import functions as F

import corpus_pipeline
from hourly_star.llm import decontaminate, simhash, toxicity
from hourly_star.llm.common import Scratch

WORDS = "river stone cloud garden window paper music silver forest morning letter bridge".split()


def make_tables(folder, spark, count=260):
    rng = random.Random(6)
    item = " ".join(rng.choices(WORDS, k=20))
    docs, labels = [], []
    for i in range(count):
        text = " ".join(rng.choices(WORDS, k=rng.randint(20, 60)))
        toxic = rng.random() < .25
        if toxic:
            words = text.split()
            for _ in range(3):
                words.insert(rng.randrange(len(words)), rng.choice(["dimwit", "numbskull", "blockhead"]))
            text = " ".join(words)
        elif rng.random() < .1:
            text += " " + item
        elif rng.random() < .2 and docs:
            text = docs[rng.randrange(len(docs))][1] or text
        docs.append((i, text, "en", f"src{i % 4}" if i % 3 else "src0", len(text)))
        labels.append((i, 1, int("dimwit" in text or "numbskull" in text or "blockhead" in text)))
    docs += [(900, None, None, None, None), (901, "", "en", "src1", 0), docs[0], docs[0], (902, None, None, None, None)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, item), (2, None)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return docs


def test_stages_one_by_one(spark, tmp_path):
    folder = str(tmp_path)
    make_tables(folder, spark)
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "toxicity", "simhash_near_dedup", "benchmark_decontamination", "source_mixing", "sharding"]
    scratch, docs = Scratch(spark, "test"), spark.read.parquet(f"{folder}/documents.parquet")
    seen = [docs.collect()]
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        after = scratch.keep(stage(spark, docs, folder))
        assert after.columns == docs.columns + (["shard", "slot"] if number == 4 else [])
        docs = after
        seen.append(docs.collect())
    key = lambda rows: sorted(map(tuple, rows), key=repr)

    labels = spark.read.parquet(f"{folder}/labels.parquet")
    scores = toxicity.scored(spark.read.parquet(f"{folder}/documents.parquet"), labels)
    bad = {(r.doc_id) for r in scores.collect() if r.predicted}
    assert bad and key(seen[1]) == key([r for r in seen[0] if r.doc_id not in bad])

    prints = [simhash.fingerprint(r.text) for r in seen[1]]
    left = list(range(len(prints)))
    classes = []
    while left:  # flood each class
        group, queue = set(), [left[0]]
        while queue:
            i = queue.pop()
            group.add(i)
            queue += [j for j in left if j not in group and j not in queue and (prints[i] ^ prints[j]).bit_count() <= 3]
        classes.append(group)
        left = [i for i in left if i not in group]
    assert len(classes) < len(prints)
    assert sorted(r.doc_id for r in seen[2]) == sorted(min(seen[1][i].doc_id for i in g) for g in classes)
    assert set(map(tuple, seen[2])) <= set(map(tuple, seen[1]))

    matcher = decontaminate.Matcher([(r.item_id, r.text) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()])
    assert key(seen[3]) == key([r for r in seen[2] if not matcher.matches(r.text)]) and len(seen[3]) < len(seen[2])

    before, times = {tuple(r) for r in seen[3]}, {}
    for r in seen[4]:  # whole documents, byte for byte
        assert tuple(r) in before
        times[r.doc_id] = times.get(r.doc_id, 0) + 1
    assert max(times.values()) <= 2
    words = lambda rows: sum(len((r.text or "").split()) for r in rows)
    assert abs(words(seen[4]) - 1.5 * words(seen[3])) < .1 * words(seen[3])

    assert key([r[:5] for r in seen[5]]) == key(seen[4])
    sizes = {}
    for r in seen[5]:
        sizes.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in sizes.values())
    assert max(map(len, sizes.values())) - min(map(len, sizes.values())) <= 1


def test_run_is_all_stages_and_takes_empty_documents(spark, tmp_path):
    folder = str(tmp_path)
    make_tables(folder, spark, 60)
    assert corpus_pipeline.run(spark, folder).count() > 0
    empty = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        empty = stage(spark, empty, folder)
        assert empty.count() == 0


def test_columns_may_have_any_names(spark, tmp_path):
    folder = str(tmp_path)
    make_tables(folder, spark, 80)
    plain = spark.read.parquet(f"{folder}/documents.parquet")
    names = ["copies", "_id", "_hash", "_chosen", "_row", "_words", "row", "taken", "copy", "size", "at", "part", "_key",
             "_rank", "_one", "ends", "fp", "root", "node", "doc", "n", "score", "predicted", "label", "toxic", "hits"]
    docs = plain.withColumns({name: F.col("doc_id") + i for i, name in enumerate(names)})
    scratch, key = Scratch(spark, "test"), lambda df: sorted(map(tuple, df.select(*plain.columns).collect()), key=repr)
    for _, stage in corpus_pipeline.STAGES:
        own = scratch.keep(stage(spark, docs, folder))
        assert own.columns[:len(docs.columns)] == docs.columns
        assert all(r[name] is None if r.doc_id is None else r[name] == r.doc_id + i
                   for r in own.collect() for i, name in enumerate(names))
        assert key(own) == key(scratch.keep(stage(spark, docs.select(*plain.columns), folder)))
        docs = own
