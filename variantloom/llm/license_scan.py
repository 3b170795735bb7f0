"""Licence paragraphs by a trained classifier, in DataFrame functions and Spark's own regression only.

A multinomial logistic regression over sparse word bigrams is trained on parts of known notices and,
as its unknown class, on all of the corpus's other paragraphs: half of the different ones teach it, the
other half calibrate it. Only which of the notices' bigrams a paragraph holds counts, so paragraphs that
hold the same are one weighted row. A family is reported where its probability passes the level that
held-out unknown paragraphs stay below, and confirmed where the paragraph also holds most of one of
the family's notices.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from variantloom.llm.text import lower_ascii
from variantloom.session import written

# Common notices of each licence family.
NOTICES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("Apache-2.0", "you may not use this file except in compliance with the License. You may obtain a copy of the License at apache.org/licenses/LICENSE-2.0"),
    ("MIT", "Released under the MIT License"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("GPL", "This work is licensed under the GNU General Public License, version 3"),
    ("GPL", "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"),
    ("LGPL", "Licensed under the GNU Lesser General Public License, version 2.1 or later"),
    ("AGPL", "Licensed under the GNU Affero General Public License, version 3"),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("BSD", "Licensed under the BSD 3-Clause License"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("CC-BY", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("CC-BY", "Licensed under CC BY 4.0"),
    ("CC-BY-SA", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("CC-BY-SA", "Licensed under CC BY-SA 4.0"),
    ("CC-BY-NC", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("CC-BY-NC", "Licensed under CC BY-NC 4.0"),
    ("CC0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work"),
    ("CC0", "This work has been dedicated to the public domain under CC0 1.0 Universal"),
    ("Proprietary", "All rights reserved"),
    ("Proprietary", "No part of this publication may be reproduced or transmitted in any form without the prior written permission of the publisher"),
]
UNKNOWN = "unknown"
FAMILIES = [UNKNOWN, *dict.fromkeys(f for f, _ in NOTICES)]


@dataclass(frozen=True)
class Limits:
    frequent: float = 0.005  # a bigram in more of the unknown paragraphs than this is no feature
    part: float = 0.6  # shortest part of a notice that is a training example
    least: float = 0.6  # lowest probability of a family, whatever the calibration says
    calls: float = 0.999  # share of held-out unknown paragraphs that must stay unknown
    held: float = 0.6  # share of a notice's features that confirms its family


def tokens(text: Column) -> Column:
    return F.array_remove(F.split(lower_ascii(text), "[^a-z0-9]+"), "")


def paragraphs(docs: DataFrame) -> DataFrame:
    """doc_id, text_id, place, words: the lines of every whole text that have two words or more."""
    lines = F.posexplode(F.split("text", "\n"))
    rows = docs.select("doc_id", F.xxhash64("text").alias("text_id"), lines.alias("place", "line"))
    return rows.select("doc_id", "text_id", "place", tokens(F.col("line")).alias("words")).filter(F.size("words") > 1)


def notice_parts(spark: SparkSession, part: float) -> DataFrame:
    """notice, family, example, words: every run of words of a notice that is long enough."""
    rows = spark.createDataFrame([(i, f, t) for i, (f, t) in enumerate(NOTICES)], "notice int, family string, text string")
    rows = rows.select("notice", "family", tokens(F.col("text")).alias("all")).withColumn("size", F.size("all"))
    least = F.greatest(F.lit(2), F.ceil(F.col("size") * part)).cast("int")
    rows = rows.select("*", F.explode(F.sequence(least, "size")).alias("length"))
    rows = rows.select("*", F.explode(F.sequence(F.lit(1), F.col("size") - F.col("length") + 1)).alias("start"))
    return rows.select("notice", "family", (F.col("length") == F.col("size")).alias("whole"), F.slice("all", F.col("start"), F.col("length")).alias("words"))


@dataclass(frozen=True)
class Model:
    """Features (bigrams) with their weights per family, intercepts, each notice's features, and the level of a call."""

    features: list[str]
    weights: list[list[float]]
    intercepts: list[float]
    notices: list[tuple[str, list[int]]]
    level: float


def joined_words(words: Column) -> Column:
    """The bigrams of a word array as texts."""
    n = F.size(words) - 1
    return F.zip_with(F.slice(words, F.lit(1), n), F.slice(words, F.lit(2), n), lambda a, b: F.concat(a, F.lit(" "), b))


def listed_bigrams(spark: SparkSession, limits: Limits) -> list[str]:
    """All bigrams of the notices."""
    parts = notice_parts(spark, limits.part).filter("whole")
    return sorted(r[0] for r in parts.select(F.explode(joined_words(F.col("words")))).distinct().collect())


def scanned(docs: DataFrame, limits: Limits) -> DataFrame:
    """doc_id, text_id, place, words_id, grams of all paragraphs: `grams` are the notices' bigrams in it."""
    listed = listed_bigrams(docs.sparkSession, limits)
    grams = F.filter(joined_words(F.col("words")), lambda g: g.isin(listed))
    rows = paragraphs(docs).select("doc_id", "text_id", "place", F.xxhash64("words").alias("words_id"), F.array_sort(F.array_distinct(grams)).alias("grams"))
    return written(rows, "paragraphs")


PATTERNS = 100_000  # weighted rows that a task of the regression holds


def trained(rows: DataFrame, limits: Limits = Limits()) -> Model:
    """Fit the classifier to the notices and to all different paragraphs of `scanned` rows."""
    spark = rows.sparkSession
    parts = notice_parts(spark, limits.part).withColumn("grams", joined_words(F.col("words")))
    different = rows.groupBy("words_id", "grams").agg(F.lit(1))
    seen = written(different.groupBy("grams", F.pmod("words_id", F.lit(2)).alias("half")).agg(F.count(F.lit(1)).alias("n")), "patterns")
    total = seen.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    listed = {r[0] for r in parts.select(F.explode("grams")).distinct().collect()}
    counts = seen.select(F.explode("grams").alias("gram"), "n").groupBy("gram").agg(F.sum("n").alias("n")).collect()
    frequent = {r["gram"] for r in counts if r["n"] > max(limits.frequent * total, 8)}
    whole = parts.filter("whole").select("notice", "family", "grams").collect()
    # A bigram that only names the family is a feature however often the corpus has it.
    short = {g for r in whole if len(r["grams"]) <= 10 for g in r["grams"]}
    vocabulary = sorted(g for g in listed if g not in frequent or g in short)
    place = {g: i for i, g in enumerate(vocabulary)}
    notices = [(r["family"], sorted({place[g] for g in r["grams"] if g in place})) for r in whole]

    # Paragraphs that hold most of a notice are no examples of the unknown.
    held = reduce(F.greatest, [share(F.col("grams"), [vocabulary[i] for i in ids]) for _, ids in notices if ids], F.lit(0.0))
    unknown = seen.filter(held < limits.held)
    label = F.create_map(*[x for i, f in enumerate(FAMILIES) for x in (F.lit(f), F.lit(float(i)))])
    known = F.filter("grams", lambda g: g.isin(vocabulary))
    unknown = unknown.groupBy(known.alias("grams"), "half").agg(F.sum("n").alias("n"))
    examples = parts.select(label[F.col("family")].alias("label"), "grams", F.lit(1).cast("bigint").alias("n")).union(
        unknown.filter("half = 0").select(F.lit(0.0).alias("label"), "grams", "n")
    ).union(spark.createDataFrame([(0.0, [], 1)], "label double, grams array<string>, n bigint"))
    # Each family and the unknown weigh the same in all.
    per = {r["label"]: r["n"] for r in examples.groupBy("label").agg(F.sum("n").alias("n")).collect()}
    weight = F.create_map(*[x for k, v in per.items() for x in (F.lit(k), F.lit(1.0 / v))])[F.col("label")]
    vectors = CountVectorizerModel.from_vocabulary(vocabulary, inputCol="grams", outputCol="features")
    vectors = written(vectors.setBinary(True).transform(examples.withColumn("weight", weight * F.col("n") * F.lit(100.0))).select("label", "weight", "features"), "examples")
    vectors = vectors.coalesce(-(-vectors.count() // PATTERNS))
    fit = LogisticRegression(family="multinomial", weightCol="weight", regParam=0.002, maxIter=60).fit(vectors)
    matrix = fit.coefficientMatrix.toArray()
    weights = [[float(matrix[k, i]) for k in range(len(FAMILIES))] for i in range(len(vocabulary))]
    model = Model(vocabulary, weights, [float(x) for x in fit.interceptVector], notices, 0.0)
    # Calibration: on the other half of the unknown paragraphs.
    other = written(unknown.filter("half = 1").select(F.monotonically_increasing_id().alias("pattern"), "grams", "n"), "others")
    best = classified(other, ["pattern", "n"], model)
    level = best.agg(F.percentile(F.when(F.col("family") == UNKNOWN, 0.0).otherwise(F.col("probability")), F.lit(limits.calls), F.col("n"))).first()[0] or 0.0
    return Model(model.features, model.weights, model.intercepts, notices, min(max(level, limits.least), 0.99))


def share(grams: Column, wanted: list[str]) -> Column:
    """How much of a notice a paragraph holds."""
    return F.size(F.array_intersect(grams, F.array(*[F.lit(g) for g in wanted]))) / F.lit(len(wanted))


def classified(rows: DataFrame, key: list[str], model: Model) -> DataFrame:
    """`key`, family, probability, notice_share for rows whose `grams` hold any feature."""
    spark = rows.sparkSession
    table = [(g, i, w) for i, (g, w) in enumerate(zip(model.features, model.weights))]
    # The feature table is as long as the notices; it never grows with the corpus.
    features = F.broadcast(spark.createDataFrame(table, "gram string, id int, w array<double>"))
    hits = rows.select(*key, F.explode("grams").alias("gram")).join(features, "gram")
    sums = [F.sum(F.col("w")[k]).alias(f"z{k}") for k in range(len(FAMILIES))]
    scored = hits.groupBy(*key).agg(F.collect_list("id").alias("ids"), *sums)
    logits = [F.col(f"z{k}") + F.lit(model.intercepts[k]) for k in range(len(FAMILIES))]
    best = F.array_max(F.array(*[F.struct(z.alias("z"), F.lit(k).alias("k")) for k, z in enumerate(logits)]))
    scored = scored.select(*key, "ids", best.alias("_best"), F.array(*logits).alias("_z"))
    probability = 1 / F.aggregate("_z", F.lit(0.0), lambda s, z: s + F.exp(z - F.col("_best.z")))
    names = F.array(*[F.lit(f) for f in FAMILIES])
    shares = []
    for family, ids in model.notices:
        if ids:
            part = F.size(F.array_intersect("ids", F.array(*[F.lit(i) for i in ids]))) / F.lit(len(ids))
            shares.append(F.when(F.col("_best.k") == FAMILIES.index(family), part).otherwise(0.0))
    return scored.select(
        *key, F.get(names, F.col("_best.k")).alias("family"), probability.alias("probability"),
        reduce(F.greatest, shares, F.lit(0.0)).alias("notice_share"),
    )


def licence_paragraphs(docs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """doc_id, paragraph, family, probability, notice_share, confirmed: paragraphs that name a licence.

    A row for each paragraph (line, from 0) of a text whose likeliest family is not the unknown and
    passes the calibrated level; `confirmed` if it holds `held` of one of the family's notices. NULL
    and empty texts have no paragraphs. Rows with one doc_id and equal texts give one set of rows, with
    different texts a set each. Other columns are not read; an empty table gives an empty table.
    """
    texts = docs.select("doc_id", "text").filter("text IS NOT NULL")
    rows = scanned(texts, limits)
    model = trained(rows, limits)
    key = ["doc_id", "text_id", "place"]
    found = classified(rows.filter(F.size("grams") > 0).select(*key, "grams").distinct(), key, model)
    return found.filter((F.col("family") != UNKNOWN) & (F.col("probability") >= model.level)).select(
        "doc_id", F.col("place").alias("paragraph"), "family", "probability", "notice_share",
        (F.col("notice_share") >= limits.held).alias("confirmed"),
    )
