"""License scans by diagonal voting.

Every pair of neighbouring words of a text is hashed and joined to the
positions at which the same pair stands in a license template. A hit at word
``pos`` of the text and ``tpos`` of the template votes for the diagonal
``pos - tpos``: the place where the template would begin. Votes are gathered as
bitmaps of template positions (a template of any length has one for each
``BITS`` of them), so they add up in any order and repeated votes do not count
twice. Neighbouring diagonals of long templates (words
put in or left out) are merged. A span is verified twice: every joined hash
is compared with the template's words, and a merged span needs
``MIN_COVERAGE`` of the template's pairs. A template of which every pair voted
on one diagonal stands there word for word.

Base phrases are short templates of their own; ``n_base`` counts the places
where one of them stands in full.

Defined results: null text has no words; repeated rows get equal results;
other columns are ignored.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import ascii_lower

# Words: digits, letters and everything beyond ASCII, after lower-casing A-Z.
SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

# Base phrases and their labels.
BASE = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))
# Openings of common notices and the label each stands for.
NOTICES = (
    ("permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
     "documentation files", "mit"),
    ("licensed under the apache license version 2 0", "apache"),
    ("redistribution and use in source and binary forms with or without modification are permitted provided that the "
     "following conditions are met", "bsd"),
    ("permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
     "granted", "isc"),
    ("this program is free software you can redistribute it and or modify it under the terms of the gnu general "
     "public license", "gpl"),
    ("licensed under the gnu general public license version 3", "gpl"),
    ("gnu lesser general public license", "lgpl"),
    ("gnu affero general public license", "agpl"),
    ("mozilla public license", "mpl"),
    ("licensed under cc by nc", "cc-by-nc"),
    ("creative commons attribution", "cc-by"),
    ("all rights reserved", "all-rights-reserved"),
)
MIN_COVERAGE = 0.7
SLACK = 3  # words put in or left out between merged diagonals
LONG = 6  # templates of at least so many words may match in part
BITS = 62  # template positions in one bitmap
MAX_BROADCAST = 200_000  # word pairs of all templates


def words(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(text.cast("string"), F.lit("")), SEPARATORS), "")


def templates(spark: SparkSession, texts=None) -> DataFrame:
    """(gram, template, label, base, pairs, tpos, first, second): a row for
    each word pair of each template (text in lower case, label, base), of the
    listed phrases and notices unless others are given. Only a table of at
    most ``MAX_BROADCAST`` pairs is broadcast."""
    rows = []
    listed = texts or [(t, label, True) for t, label in BASE] + [(t, label, False) for t, label in NOTICES]
    for k, (text, label, base) in enumerate(listed):
        w = [x for x in re.split(SEPARATORS, text) if x]
        if len(w) < 2:
            raise ValueError(f"a template has 2 words or more: {text!r}")
        rows += [(k, label, base, len(w) - 1, i, w[i], w[i + 1]) for i in range(len(w) - 1)]
    t = spark.createDataFrame(rows, "template int, label string, base boolean, pairs int, tpos int, first string, second string")
    t = t.withColumn("gram", F.xxhash64("first", "second"))
    return F.broadcast(t) if len(rows) <= MAX_BROADCAST else t


def votes(docs: DataFrame, table: DataFrame) -> DataFrame:
    """(doc_id, digest, template, label, base, pairs, diagonal, block, mask):
    for each diagonal and block of ``BITS`` template positions the bitmap of
    those that voted for it."""
    text = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64(F.col("text").cast("string")).alias("digest"),
                       words(F.col("text")).alias("words"))
    hashed = text.select("doc_id", "digest", "words", F.transform("words", lambda w, i: F.xxhash64(
        F.lower(w), F.lower(F.get(F.col("words"), i + 1)))).alias("grams"))
    # The outer form: the plain one adds a filter that tokenises once more for each word.
    each = hashed.select("doc_id", "digest", "words", F.posexplode_outer("grams").alias("pos", "gram"))
    hits = each.join(table, "gram")
    # A sum, as plain equalities would become join keys made for every word of every text.
    same = [F.when(ascii_lower(F.get("words", F.col("pos") + k)) == F.col(c), 1).otherwise(0) for k, c in ((0, "first"), (1, "second"))]
    hits = hits.filter(same[0] + same[1] == 2).select("doc_id", "digest", "template", "label", "base", "pairs",
                                    (F.col("pos") - F.col("tpos")).alias("diagonal"), "tpos")
    hits = hits.withColumn("block", F.floor(F.col("tpos") / BITS).cast("int"))
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("tpos") % BITS)
    return hits.groupBy("doc_id", "digest", "template", "label", "base", "pairs", "diagonal", "block").agg(F.bit_or(bit).alias("mask"))


def spans(diagonals: DataFrame) -> DataFrame:
    """Neighbouring diagonals merged: one row per span with its place (first
    word, end), coverage and whether it stands word for word."""
    of = Window.partitionBy("doc_id", "digest", "template")
    in_order = of.orderBy("diagonal", "block")
    apart = F.col("diagonal") - F.lag("diagonal").over(in_order)  # 0 between blocks of one diagonal
    merge = (apart == 0) | ((F.col("pairs") >= LONG - 1) & (apart <= SLACK))
    run = F.sum(F.when(merge, 0).otherwise(1)).over(in_order.rowsBetween(Window.unboundedPreceding, 0))
    # All blocks of a diagonal; clustered as above, so neither shuffles again.
    full = F.sum(F.bit_count("mask")).over(Window.partitionBy("doc_id", "digest", "template", "diagonal")) == F.col("pairs")
    numbered = diagonals.withColumn("run", run).withColumn("whole", full)
    span = ["doc_id", "digest", "template", "label", "base", "pairs", "run"]
    in_blocks = numbered.groupBy(*span, "block").agg(
        F.min("diagonal").alias("start"), F.max("diagonal").alias("last"), F.bit_count(F.bit_or("mask")).alias("covered"),
        F.max("whole").alias("whole"))
    merged = in_blocks.groupBy(*span).agg(F.min("start").alias("start"), F.max("last").alias("last"),
                                          F.sum("covered").alias("covered"), F.max("whole").alias("whole"))
    return merged.select("doc_id", "digest", "template", "label", "base", "start",
                         (F.col("last") + F.col("pairs") + 1).alias("end"), "whole",
                         (F.col("covered") / F.col("pairs")).alias("coverage"),
                         (F.col("whole") | ((F.col("pairs") >= LONG - 1) & (F.col("covered") >= F.col("pairs") * MIN_COVERAGE)
                                            )).alias("accepted"))


def scan(docs: DataFrame, texts=None) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_base, first_word,
    last_word, base_labels, labels, score; ``texts`` as in ``templates``."""
    found = spans(votes(docs, templates(docs.sparkSession, texts)))
    at_base = F.col("base") & F.col("whole")
    label = lambda cond: F.array_join(F.array_sort(F.collect_set(F.when(cond, F.col("label")))), ",")
    per_doc = found.groupBy(F.col("doc_id").alias("of_doc"), F.col("digest").alias("of_digest")).agg(
        F.count_if(at_base).alias("n_base"), F.min(F.when(at_base, F.col("start"))).cast("bigint").alias("first_word"),
        F.max(F.when(at_base, F.col("start"))).cast("bigint").alias("last_word"), label(at_base).alias("base_labels"),
        label(F.col("accepted")).alias("labels"), F.max("coverage").alias("score"))
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64(F.col("text").cast("string")).alias("digest"),
                       F.size(words(F.col("text"))).cast("bigint").alias("n_words"))
    out = rows.join(per_doc, F.col("doc_id").eqNullSafe(F.col("of_doc")) & (F.col("digest") == F.col("of_digest")), "left")
    return out.select("doc_id", "n_words", F.coalesce("n_base", F.lit(0).cast("bigint")).alias("n_base"), "first_word",
                      "last_word", F.coalesce("base_labels", F.lit("")).alias("base_labels"),
                      F.coalesce("labels", F.lit("")).alias("labels"), F.coalesce("score", F.lit(0.0)).alias("score"))
