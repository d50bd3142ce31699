"""Licence scan (operator 6), DataFrame and MLlib (JVM) functions only.

A paragraph (a line; a long one by sentences) is classified by multinomial
logistic regression on its word 1- to 3-grams.  The model is trained here: licence
families from the notices below and from cut-down copies of them, the unknown
class from all different corpus paragraphs that have no licence stem and resemble no notice.  Paragraphs with the same
n-grams of notices are one training row with their number as its weight; however many they are, the class weighs
``UNKNOWN_WEIGHT`` at most beside the families.  Calibration: half of these paragraphs, by a hash of their text, is kept
out of the training, and a prediction counts only above the highest family
probability met in all of it (and ``LEAST_PROBABILITY``).  A predicted family is confirmed
by comparison with its notices: the share of a notice's words that the paragraph
holds, or of the paragraph's words that the notice holds.

Every paragraph with a word is scored, whether or not it holds one of the word stems below.

Defined results: a row per confirmed paragraph (doc_id, paragraph, part, family,
probability, similarity); null and empty texts give none; repeated rows give
repeated results; ties between families go to the first in order.
"""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel, NGram
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cardwatch.llm.common import stored

UNKNOWN = "unknown"
#: What all training paragraphs of the unknown class weigh at most; a notice weighs 20.
UNKNOWN_WEIGHT = 1000.0
LEAST_PROBABILITY = 0.5
LEAST_SIMILARITY = 0.6
#: Words of a paragraph from which it is cut into sentences.
LONG = 60

#: Usual notices of licence families.
NOTICES = {
    "apache": ["Licensed under the Apache License, Version 2.0.",
               "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License.",
               "This project is released under the Apache 2.0 license.", "SPDX-License-Identifier: Apache-2.0"],
    "mit": ["Released under the MIT License.", "This software is licensed under the MIT license.",
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
            "SPDX-License-Identifier: MIT"],
    "gpl": ["This work is licensed under the GNU General Public License, version 3.",
            "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License",
            "Licensed under the GPL version 2 or later.", "SPDX-License-Identifier: GPL-3.0-or-later"],
    "lgpl": ["Licensed under the GNU Lesser General Public License, version 2.1.",
             "This library is free software; you can redistribute it under the terms of the GNU Lesser General Public License"],
    "bsd": ["Released under the BSD 3-Clause License.", "Licensed under the BSD license.",
            "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
            "SPDX-License-Identifier: BSD-3-Clause"],
    "mpl": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
            "Licensed under the Mozilla Public License, version 2.0."],
    "cc_by": ["This work is licensed under a Creative Commons Attribution 4.0 International License.", "Licensed under CC BY 4.0.",
              "Licensed under CC BY-SA 4.0."],
    "cc_by_nc": ["Licensed under CC BY-NC 4.0.", "Licensed under CC BY-NC-SA 4.0.",
                 "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "public_domain": ["This work is dedicated to the public domain under CC0 1.0 Universal.",
                      "This is free and unencumbered software released into the public domain."],
    "all_rights_reserved": ["All rights reserved.", "Copyright 2020 The Authors. All rights reserved.",
                            "No part of this publication may be reproduced without prior written permission. All rights reserved."],
}
#: Distinct words from which a paragraph that a notice holds is left out of the unknown class, and the least share of the
#: notice's words that it has (function words alone do not make up that).
RESEMBLING_WORDS, RESEMBLING_SHARE = 4, 0.3

#: Every notice holds one of these; a paragraph that does is no example of the unknown class.
STEMS = ("licens", "licenc", "copyright", "rights reserved", "public domain", "permission is hereby", "redistribut",
         "creative commons", "free software")
FAMILIES = sorted(NOTICES)


def words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))


def grams(w: Column) -> Column:
    """Distinct word 1-, 2- and 3-grams."""
    def n(k):
        return F.when(F.size(w) >= k, F.transform(F.sequence(F.lit(1), F.size(w) - (k - 1)),
                                                  lambda i: F.array_join(F.slice(w, i, k), " "))).otherwise(F.array())
    return F.array_distinct(F.concat(*(n(k) for k in (1, 2, 3))))


def with_grams(rows: DataFrame) -> DataFrame:
    """``rows`` (with ``w`` and ``hits``) plus ``grams``: the words that a notice has and, if there are any, the 2- and 3-grams, which the
    vectoriser counts once each.  Others are in no notice."""
    have = rows.columns
    # made by generators: else each use of a column computes what it is made of again
    rows = rows.select(*have, F.explode(F.array(F.when(F.size("hits") > 0, F.col("w")).otherwise(F.array().cast("array<string>")))).alias("_w"))
    for n in (2, 3):
        rows = NGram(n=n, inputCol="_w", outputCol=f"_w{n}").transform(rows)
    return rows.select(*have, F.explode(F.array(F.concat("hits", "_w2", "_w3"))).alias("grams"))


def has_stem(text: Column) -> Column:
    low, out = F.lower(text), F.lit(False)
    for s in STEMS:
        out = out | low.contains(s)
    return out


def paragraphs(docs: DataFrame) -> DataFrame:
    """(doc_id, paragraph, part, t): lines, long ones by sentences."""
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("t")).filter("t is not null")
    d = d.select("doc_id", F.posexplode(F.split("t", "\n")).alias("paragraph", "t"))
    parts = F.when(F.size(F.split("t", " ")) > LONG, F.split("t", r"(?<=[.;!?])\s+")).otherwise(F.array("t"))
    return d.select("doc_id", F.col("paragraph").cast("long").alias("paragraph"), F.posexplode(parts).alias("part", "t")) \
        .withColumn("part", F.col("part").cast("long"))


def notices(spark: SparkSession) -> DataFrame:
    """(family, w): the notices and, for robustness, each without its first or last words."""
    d = spark.createDataFrame([(f, t) for f in FAMILIES for t in NOTICES[f]], "family string, t string")
    w = d.select("family", words(F.col("t")).alias("w"))
    cut = F.array(F.col("w"), *(F.slice("w", 1 + a, F.greatest(F.size("w") - a - b, F.lit(1)))
                                for a, b in ((1, 0), (2, 0), (0, 1), (0, 2))))
    return w.select("family", F.explode(F.when(F.size("w") >= 6, cut).otherwise(F.array("w"))).alias("w"))


def shares(hits: Column, n_own: Column, notice: str) -> tuple[Column, Column]:
    """The share of the notice's words among a paragraph's ``n_own`` distinct words, and of these in the notice; ``hits``: those in any notice."""
    n = F.array(*map(F.lit, sorted(set(_plain(notice)))))
    both = F.size(F.array_intersect(n, hits))
    return both / F.size(n), both / n_own


def resembles(hits: Column, n_own: Column) -> Column:
    """Whether a notice may be meant: most of its words are there or, if there are some, most of the paragraph's are its."""
    out = F.lit(False)
    for of_notice, of_own in (shares(hits, n_own, t) for f in FAMILIES for t in NOTICES[f]):
        out = out | (of_notice >= LEAST_SIMILARITY) | (
            (n_own >= RESEMBLING_WORDS) & (of_own >= LEAST_SIMILARITY) & (of_notice >= RESEMBLING_SHARE))
    return out


def vectoriser(spark: SparkSession) -> CountVectorizerModel:
    """It marks which of the notices' n-grams a paragraph holds."""
    names = [r[0] for r in notices(spark).select(F.explode(grams(F.col("w"))).alias("g")).distinct().orderBy("g").collect()]
    return CountVectorizerModel.from_vocabulary(names, inputCol="grams", outputCol="features").setBinary(True)


def featured(docs: DataFrame) -> DataFrame:
    """(doc_id, paragraph, part, h, stem, hits, n_own, features) of each paragraph with a word: the text's hash, its distinct
    words that a notice has, the number of its distinct words, and the notices' n-grams in it."""
    p = paragraphs(docs).filter(F.col("t").rlike(r"[\p{L}\p{N}]")).select("*", F.explode(F.array(words(F.col("t")))).alias("w"))
    p = p.select("doc_id", "paragraph", "part", F.xxhash64("t").alias("h"), has_stem(F.col("t")).alias("stem"), "w")
    of_notices = F.array(*map(F.lit, sorted({x for f in FAMILIES for t in NOTICES[f] for x in _plain(t)})))
    p = p.select("*", F.inline(F.array(F.struct(F.array_intersect(of_notices, F.col("w")).alias("hits"), F.size(F.array_distinct("w")).alias("n_own")))))
    return vectoriser(docs.sparkSession).transform(with_grams(p)).drop("w", "grams")


def unknown_rows(rows: DataFrame) -> DataFrame:
    """(features, half, n): the different paragraphs without a stem that resemble no notice, counted by what they hold of the
    notices; half 1 is kept out of the training."""
    one = rows.filter("not stem").groupBy("h").agg(F.first(F.struct("features", "hits", "n_own")).alias("r"))
    # equal features have equal hits, so few of these are compared with the notices
    one = one.groupBy("r", F.pmod("h", F.lit(2)).alias("half")).agg(F.count("*").alias("n")).select("r.*", "half", "n")
    # by a generator, as a filter would be moved below the count and compare every paragraph
    one = one.select("*", F.explode(F.array(resembles(F.col("hits"), F.col("n_own")))).alias("near"))
    return one.filter("not near").groupBy("features", "half").agg(F.sum("n").alias("n"))


class Model:
    """The fitted regression over the notices' n-grams, and the calibrated probability limit."""

    def __init__(self, fitted, limit: float):
        self.fitted, self.limit = fitted, limit

    def probabilities(self, rows: DataFrame) -> DataFrame:
        """``rows`` (with ``features``) plus ``family`` and ``probability`` of the likeliest family."""
        d = self.fitted.transform(rows)
        # made by a generator, so that filters and later columns read the probabilities and do not compute them again
        d = d.select(*rows.columns, F.explode(F.array(F.slice(vector_to_array("p"), 1, len(FAMILIES)))).alias("_p"))
        return d.withColumn("probability", F.array_max("_p")).withColumn(
            "family", F.element_at(F.array(*map(F.lit, FAMILIES)), F.array_position("_p", F.array_max("_p")).cast("int"))).drop("_p")


def train(docs: DataFrame, rows: DataFrame | None = None) -> Model:
    """``rows``: the paragraphs of ``docs`` as ``featured`` gives them, if they are at hand."""
    spark = docs.sparkSession
    known = notices(spark).select((F.array_position(F.array(*map(F.lit, FAMILIES)), F.col("family")) - 1).cast("double").alias("label"), "w")
    sample = stored(unknown_rows(featured(docs) if rows is None else rows), "licence-unknown")
    total = sample.filter("half = 0").agg(F.sum("n")).first()[0] or 1
    known = known.withColumn("weight", F.lit(20.0))
    other = sample.filter("half = 0").select(F.lit(float(len(FAMILIES))).alias("label"), "features", (F.col("n") * min(1.0, UNKNOWN_WEIGHT / total)).alias("weight"))
    # texts without any n-gram of a notice, so that the class is known even where the corpus is empty
    none = spark.createDataFrame([(float(len(FAMILIES)), ["the"], 50.0), (float(len(FAMILIES)), ["of", "this"], 50.0)],
                                 "label double, w array<string>, weight double")
    own = vectoriser(spark).transform(known.unionByName(none).withColumn("grams", grams(F.col("w"))))
    fitted = LogisticRegression(family="multinomial", regParam=1e-3, maxIter=60, weightCol="weight", probabilityCol="p",
                                rawPredictionCol="raw").fit(own.select("label", "features", "weight").unionByName(other))
    model = Model(fitted, LEAST_PROBABILITY)
    worst = model.probabilities(sample.filter("half = 1")).agg(F.max("probability")).first()[0]
    model.limit = max(LEAST_PROBABILITY, worst or 0.0)
    return model


def find_licences(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """(doc_id, paragraph, part, family, probability, similarity) of each confirmed paragraph."""
    rows = featured(docs)
    if model is None:
        rows = stored(rows, "licence-paragraphs")
        model = train(docs, rows)
    scored = model.probabilities(rows).filter(F.col("probability") > model.limit)
    similar = {}
    for f in FAMILIES:
        each = [x for t in NOTICES[f] for x in shares(F.col("hits"), F.col("n_own"), t)]
        similar[f] = F.greatest(*each)
    sim = F.coalesce(*(F.when(F.col("family") == f, v) for f, v in similar.items()))
    return scored.withColumn("similarity", sim).filter(F.col("similarity") >= LEAST_SIMILARITY).select(
        "doc_id", "paragraph", "part", "family", "probability", "similarity")


def _plain(text: str) -> list[str]:
    out, word = [], ""
    for c in text.lower() + " ":
        if c.isalnum():
            word += c
        elif word:
            out.append(word)
            word = ""
    return out
