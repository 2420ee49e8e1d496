"""License scans: a trained paragraph classifier, checked against templates.

A paragraph (a line of the text) is a sparse bag of words and word pairs. A multinomial logistic regression tells license families and
"none" apart. It is trained on license names in carrier sentences, on template texts, and on paragraphs of the corpus as examples of
"none": those ``NONE_SAMPLE`` with the smallest hash that name no license, a bounded sample. A quarter of the training rows is kept from the fit;
the probability that all but a twentieth of those rightly classified reach is the bar below which a license-like paragraph is
"unknown". The paragraph's similarity to the family's nearest template, the share of the template's word pairs that it has, confirms
the prediction.

Training and scoring are DataFrame and Spark ML work without Python on the executors, and scoring needs no shuffle.

Defined cases: a null or empty text has no paragraph and gives no row; nor does a paragraph without a word. A null id stays null. Rows that repeat
give repeated results. An empty table gives an empty result. Other columns of the input are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import CountVectorizer, CountVectorizerModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

NONE_SAMPLE, VOCABULARY = 1500, 6000
CONFIRMED = 0.6

# Names of license families as they are commonly written, and the sentences that grant them.
NAMES = {
    "apache-2.0": ("the Apache License, Version 2.0", "Apache License 2.0", "Apache-2.0", "the Apache 2.0 license"),
    "mit": ("the MIT License", "MIT", "the MIT license terms", "the Expat (MIT) license"),
    "bsd": ("the BSD 3-Clause License", "BSD-3-Clause", "the New BSD License", "the BSD license"),
    "gpl": (
        "the GNU General Public License, version 3",
        "GNU GPL v3",
        "GPL-3.0-or-later",
        "the GNU General Public License, version 2",
    ),
    "lgpl": ("the GNU Lesser General Public License, version 2.1", "GNU LGPL v3", "LGPL-3.0-only", "the LGPL"),
    "mpl-2.0": ("the Mozilla Public License, version 2.0", "MPL-2.0", "Mozilla Public License 2.0", "the MPL"),
    "cc-by": ("CC BY 4.0", "a Creative Commons Attribution 4.0 International License", "CC-BY-4.0", "CC BY 3.0"),
    "cc-by-sa": (
        "CC BY-SA 4.0",
        "a Creative Commons Attribution-ShareAlike 4.0 International License",
        "CC-BY-SA-4.0",
        "CC BY-SA 3.0",
    ),
    "cc-by-nc": (
        "CC BY-NC 4.0",
        "a Creative Commons Attribution-NonCommercial 4.0 International License",
        "CC-BY-NC-4.0",
        "CC BY-NC-SA 4.0",
    ),
    "public-domain": ("CC0 1.0", "the Unlicense", "CC0-1.0", "the Creative Commons Zero public domain dedication"),
}
CARRIERS = (
    "Licensed under {}.",
    "Released under {}.",
    "This work is licensed under {}.",
    "Distributed under the terms of {}.",
    "This software is made available under {}.",
    "SPDX-License-Identifier: {}",
    "License: {}",
    "You may use this file under {}.",
)
TEXTS = {
    "apache-2.0": ("you may not use this file except in compliance with the License",),
    "mit": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
    ),
    "bsd": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    ),
    "gpl": (
        "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
    ),
    "lgpl": (
        "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation",
    ),
    "mpl-2.0": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",),
    "cc-by": ("you must give appropriate credit, provide a link to the license, and indicate if changes were made",),
    "cc-by-sa": ("if you remix, transform, or build upon the material, you must distribute your contributions under the same license",),
    "cc-by-nc": ("you may not use the material for commercial purposes",),
    "public-domain": ("to the extent possible under law, the author has waived all copyright and related or neighboring rights",),
}
NOT_LICENSES = (
    "His driving license was revoked last year.",
    "The film was released under a new title.",
    "She works under the general public health act.",
    "Permission to land was granted at noon.",
    "The apache helicopter was redistributed to another base.",
    "A common version of the creative work is sold in the domain of art.",
)


def grams(text: Column) -> Column:
    """Words and word pairs, lower case."""
    words = F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}.+-]+|[.](?=\s|$)"), "")
    return F.concat(words, _pairs(words))


def _pairs(words: Column) -> Column:
    n = F.size(words)
    joined = F.zip_with(F.slice(words, 1, F.greatest(n - 1, F.lit(0))), F.slice(words, 2, F.greatest(n - 1, F.lit(0))), lambda a, b: F.concat(a, F.lit(" "), b))
    return F.when(n > 1, joined).otherwise(F.array().cast("array<string>"))


def paragraphs(docs: DataFrame) -> DataFrame:
    """(``doc_id``, ``paragraph`` number from 0, ``line``)."""
    return docs.select("doc_id", F.posexplode(F.split("text", "\n")).alias("paragraph", "line")).where(
        F.col("line").rlike(r"[\p{L}\p{N}]")
    )


@dataclass(frozen=True)
class Scanner:
    classes: tuple[str, ...]
    vectors: CountVectorizerModel
    model: LogisticRegressionModel
    bar: float

    def scan(self, docs: DataFrame) -> DataFrame:
        """One row for each paragraph that isn't "none"."""
        scored = self._probabilities(paragraphs(docs).withColumn("grams", grams(F.col("line"))))
        none = self.classes.index("none")
        best = F.array_max(F.transform(F.array_remove(F.sequence(F.lit(0), F.lit(len(self.classes) - 1)), none), lambda i: F.struct(F.get("p", i).alias("p"), i.alias("i"))))
        found = scored.select("doc_id", "paragraph", "grams", F.get("p", F.lit(none)).alias("p_none"), best.alias("best"))
        found = found.where("p_none < 0.5")
        family = F.element_at(F.array(*map(F.lit, self.classes)), F.col("best.i") + 1)
        # Given that it is a license at all, how sure is the family?
        sure = F.col("best.p") / (1 - F.col("p_none"))
        templates = F.create_map(
            *(x for c in self.classes if c != "none" for x in (F.lit(c), F.array(*(_pair_literal(t) for t in _templates(c)))))
        )
        nearest = F.array_max(
            F.transform(F.element_at(templates, F.col("guess")), lambda t: F.size(F.array_intersect(t, F.col("grams"))) / F.size(t))
        )
        found = found.select("doc_id", "paragraph", "grams", family.alias("guess"), (1 - F.col("p_none")).alias("p_license"), sure.alias("p_family"))
        found = found.withColumn("similarity", F.coalesce(nearest, F.lit(0.0)))
        known = (F.col("p_family") >= self.bar) & (F.col("p_license") >= self.bar)
        return found.select(
            "doc_id",
            "paragraph",
            F.when(known, F.col("guess")).otherwise("unknown").alias("family"),
            "p_license",
            "p_family",
            "similarity",
            (known & (F.col("similarity") >= CONFIRMED)).alias("confirmed"),
        )

    def _probabilities(self, rows: DataFrame) -> DataFrame:
        made = self.model.transform(self.vectors.transform(rows))
        return made.withColumn("p", vector_to_array("probability"))


def _templates(family: str) -> list[str]:
    return [*NAMES[family], *TEXTS[family]]


def _pair_literal(text: str) -> Column:
    """The words and word pairs of a template; names of one word are compared by that word."""
    return grams(F.lit(text))


def training_rows(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """(``line``, ``class``): grants of every family, and paragraphs of the corpus that name no license."""
    named = [
        (c.format(n), family) for family, names in NAMES.items() for n in names for c in CARRIERS
    ] + [(t, family) for family, texts in TEXTS.items() for t in texts for _ in range(4)]
    named += [(t, "none") for t in NOT_LICENSES for _ in range(4)]
    listed = spark.range(1).select(
        F.inline(F.array(*(F.struct(F.lit(t).alias("line"), F.lit(c).alias("class")) for t, c in named)))
    )
    plain = (
        paragraphs(docs)
        .where(~F.col("line").rlike(r"(?i)licen[sc]e|copyright|permission|public domain|\bcc|spdx"))
        .select("line", F.lit("none").alias("class"))
        .orderBy(F.xxhash64("line"), "line")
        .limit(NONE_SAMPLE)
    )
    return listed.unionByName(plain)


def train(spark: SparkSession, docs: DataFrame) -> Scanner:
    classes = (*NAMES, "none")
    label = F.element_at(F.create_map(*(x for i, c in enumerate(classes) for x in (F.lit(c), F.lit(float(i))))), F.col("class"))
    rows = training_rows(spark, docs).select(grams(F.col("line")).alias("grams"), label.alias("label"), F.pmod(F.xxhash64("line"), F.lit(4)).alias("fold"))
    rows = rows.coalesce(1).cache()
    learn = rows.where("fold > 0")
    vectors = CountVectorizer(inputCol="grams", outputCol="features", vocabSize=VOCABULARY, binary=True).fit(learn)
    made = vectors.transform(learn)
    model = LogisticRegression(maxIter=60, regParam=1e-3, family="multinomial").fit(made)
    held = model.transform(vectors.transform(rows.where("fold = 0 and label <> %f" % classes.index("none"))))
    right = held.where("prediction = label").select(F.array_max(vector_to_array("probability")).alias("p"))
    bar = right.agg(F.percentile("p", 0.05)).first()[0]
    rows.unpersist()
    return Scanner(classes, vectors, model, min(0.9, max(0.4, bar if bar is not None else 0.5)))


def scan(spark: SparkSession, docs: DataFrame) -> DataFrame:
    return train(spark, docs).scan(docs)
