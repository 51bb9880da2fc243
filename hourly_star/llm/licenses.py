"""License scans by diagonal voting, in DataFrame functions alone.

Contract. A text is lower-cased (A-Z only) and cut into words of ASCII digits,
letters and all code points beyond ASCII. Base phrases are found wherever
their words stand consecutively: `n_base` places in all, `first_word` and
`last_word` the smallest and largest start (null without a place). License
notices of `NOTICES` are found also where some words differ; they add labels
of their own. `score` is the greatest share of a template's word pairs found
in one verified span (a base phrase is a template too), 0 without any. A null
or empty text has no words and no labels; repeated rows are scanned one by
one; an empty table gives an empty result; other columns are ignored.

Method. Every pair of consecutive words of every document is joined by its
hash with the pairs of the templates, and the words themselves are compared.
A hit votes for the diagonal (place in the text minus place in the template);
diagonals with enough votes that lie next to each other are merged, as a
missing or added word moves the diagonal by one, and the merged span is
verified by the share of pairs it holds and by its length. The templates are
constants, so they are the one broadcast side; the documents are read once
and no text is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hourly_star.llm.common import Scratch, bucketed_join, lower_ascii, table

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# Phrases and their labels.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
# Short notices in common use, in words as above, and their labels.
NOTICES = [
    ("mit-notice", "released under the mit license"),
    ("mit-notice", "permission is hereby granted free of charge to any person obtaining a copy of this "
                   "software and associated documentation files"),
    ("apache-2.0", "licensed under the apache license version 2 0"),
    ("apache-2.0", "you may not use this file except in compliance with the license"),
    ("gpl-3.0", "licensed under the gnu general public license version 3"),
    ("gpl-notice", "you can redistribute it and or modify it under the terms of the gnu general public "
                   "license as published by the free software foundation"),
    ("lgpl-notice", "under the terms of the gnu lesser general public license"),
    ("bsd-notice", "redistribution and use in source and binary forms with or without modification are "
                   "permitted provided that the following conditions are met"),
    ("mpl-2.0", "subject to the terms of the mozilla public license v 2 0"),
    ("isc-notice", "permission to use copy modify and or distribute this software for any purpose with "
                   "or without fee is hereby granted"),
    ("cc-by-nc-4.0", "licensed under cc by nc 4 0"),
    ("cc-by-sa-4.0", "licensed under cc by sa 4 0"),
    ("cc-by-4.0", "licensed under cc by 4 0"),
    ("cc-notice", "licensed under a creative commons attribution 4 0 international license"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
]
LEAST_SHARE = 0.8  # of a notice's pairs in a span
LEAST_VOTES = 2  # on a diagonal, before diagonals are merged
NEIGHBOURS = 2  # words by which merged diagonals may differ
STRETCH = 1.3  # a span may be so much longer than its notice


def templates() -> list[tuple[int, int, str, str, str, bool, int]]:
    """(template, place, word, next word, label, is a base phrase, pairs) of every pair."""
    texts = [(label, text, True) for text, label in PHRASES.items()]
    texts += [(label, text, False) for label, text in NOTICES]
    rows = []
    for number, (label, text, base) in enumerate(texts):
        words = text.split()
        if len(words) > 63:
            raise ValueError("a template's pairs are kept as bits of a long")
        rows += [(number, i, a, b, label, base, len(words) - 1) for i, (a, b) in enumerate(zip(words, words[1:]))]
    return rows


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(lower_ascii(F.coalesce(text, F.lit(""))), SEPARATORS), "")


def votes(docs: DataFrame) -> DataFrame:
    """One row for each document and diagonal hit; one with null template for each document.

    (row, doc_id, n_words, label, base, pairs, template, diagonal, n, places)
    """
    spark = docs.sparkSession
    known = spark.createDataFrame(
        templates(), "template int, place int, t0 string, t1 string, label string, base boolean, pairs int")
    known = F.broadcast(known.withColumn("hash", F.xxhash64("t0", "t1")))
    words = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long"),
                        words_of(F.col("text").cast("string")).alias("w"))
    pairs = words.select("row", "doc_id", F.size("w").cast("long").alias("n_words"), F.posexplode_outer(
        F.arrays_zip(F.col("w").alias("w0"), F.slice("w", 2, F.greatest(F.size("w"), F.lit(1))).alias("w1"))))
    pairs = pairs.select("row", "doc_id", "n_words", "pos", F.col("col.w0").alias("w0"), F.col("col.w1").alias("w1"))
    hits = pairs.join(known, (F.xxhash64("w0", "w1") == F.col("hash")) & (F.col("w0") == F.col("t0"))
                      & (F.col("w1") == F.col("t1")), "left")
    return hits.groupBy("row", "doc_id", "n_words", "template", "label", "base", "pairs",
                        (F.col("pos") - F.col("place")).cast("long").alias("diagonal")).agg(
        F.count("place").alias("n"), F.expr("bit_or(shiftleft(1L, place))").alias("places"),
        F.min("place").alias("lowest"), F.max("place").alias("highest"))


def spans(voted: DataFrame) -> DataFrame:
    """(row, label, share): the verified spans of notices."""
    order = Window.partitionBy("row", "template").orderBy("diagonal")
    merged = (voted.where(f"not base AND n >= {LEAST_VOTES}")
              .withColumn("starts", F.coalesce(
                  F.col("diagonal") - F.lag("diagonal").over(order) > NEIGHBOURS, F.lit(True)).cast("long"))
              .withColumn("island", F.sum("starts").over(order))
              .groupBy("row", "template", "label", "pairs", "island")
              .agg(F.expr("bit_count(bit_or(places))").alias("found"),
                   F.min(F.col("diagonal") + F.col("lowest")).alias("first"),
                   F.max(F.col("diagonal") + F.col("highest") + 1).alias("last")))
    share = F.col("found") / F.col("pairs")
    length = F.col("last") - F.col("first") + 1
    return merged.where((share >= LEAST_SHARE) & (length <= (F.col("pairs") + 1) * STRETCH)).select(
        "row", "label", share.alias("share"))


def scan(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """The digest of every row; see the head of the module."""
    voted = Scratch(spark, "licenses").keep(votes(docs))
    phrases = voted.where("base AND n = pairs")
    base = phrases.groupBy("row").agg(
        F.count("*").alias("n_base"), F.min("diagonal").alias("first_word"),
        F.max("diagonal").alias("last_word"), F.sort_array(F.collect_set("label")).alias("base_set"))
    own = spans(voted).groupBy("row").agg(F.max("share").alias("share"), F.collect_set("label").alias("own_set"))
    none = F.array().cast("array<string>")
    base_set, own_set = F.coalesce("base_set", none), F.coalesce("own_set", none)
    found = bucketed_join(bucketed_join(voted.select("row", "doc_id", "n_words").distinct(), base, ["row"], "left"),
                          own, ["row"], "left")
    return found.select(
        "doc_id", "n_words", F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"),
        "first_word", "last_word", F.array_join(base_set, ",").alias("base_labels"),
        F.array_join(F.sort_array(F.array_union(base_set, own_set)), ",").alias("labels"),
        F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("share", F.lit(0.0))).alias("score"))


def op8_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(spark, table(spark, sf_dir, "documents"))


QUERIES = {"op8_licenses": op8_licenses}
ORACLES = {}
