"""Licence scans by a trained classifier of paragraphs.

A sparse logistic regression over hashed word n-grams tells the licence family
of each paragraph, with classes for licences of no known family and for text that
is none. Its probabilities are calibrated on held-out rows, and a family counts
only if the paragraph also agrees with one of the family's templates. Scoring is
made of DataFrame expressions.
"""

from __future__ import annotations

import json
import math
from dataclasses import dataclass
from functools import reduce

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bronzeway.llm.common import fresh

NONE, UNKNOWN = "none", "unknown"
#: Bins of the hashed n-grams.
BINS = 1 << 13
#: Documents (about so many, the smallest hashes of their texts) whose paragraphs
#: teach what is no licence. The bound of the labelled sample; nothing else is
#: sampled.
SAMPLE_DOCS = 1500
#: Share of a template's words that a paragraph must hold to confirm its family.
AGREEMENT = 0.8
LEAST_PROBABILITY = 0.5

# Notices of well-known licences, one text each (fixed values).
TEMPLATES = {
    "apache": [
        "Licensed under the Apache License, Version 2.0",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file"
        " except in compliance with the License. You may obtain a copy of the License at",
        "Unless required by applicable law or agreed to in writing, software distributed under the"
        " License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND",
        "Apache License 2.0",
        "SPDX-License-Identifier: Apache-2.0",
    ],
    "mit": [
        "Released under the MIT License",
        "Licensed under the MIT License",
        "The MIT License (MIT)",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"
        " and associated documentation files, to deal in the Software without restriction",
        "SPDX-License-Identifier: MIT",
    ],
    "gpl": [
        "This work is licensed under the GNU General Public License, version 3",
        "GNU General Public License",
        "This program is free software: you can redistribute it and/or modify it under the terms of"
        " the GNU General Public License as published by the Free Software Foundation",
        "SPDX-License-Identifier: GPL-3.0-or-later",
        "Licensed under the GNU Affero General Public License",
        "This library is licensed under the GNU Lesser General Public License",
    ],
    "cc": [
        "Licensed under CC BY-NC 4.0",
        "Licensed under CC BY 4.0",
        "Licensed under CC BY-SA 4.0",
        "This work is licensed under a Creative Commons Attribution 4.0 International License",
        "Creative Commons Attribution-NonCommercial-ShareAlike 3.0",
        "Dedicated to the public domain under CC0 1.0",
    ],
    "bsd": [
        "Licensed under the BSD 3-Clause License",
        "Redistribution and use in source and binary forms, with or without modification, are"
        " permitted provided that the following conditions are met",
        "Released under the 2-clause BSD License",
        "SPDX-License-Identifier: BSD-3-Clause",
    ],
    "mpl": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
        "Licensed under the Mozilla Public License 2.0",
        "SPDX-License-Identifier: MPL-2.0",
    ],
    UNKNOWN: [
        "Licensed under the terms of the licence that comes with it",
        "All rights reserved. See the license file for the terms of use",
        "This work is licensed under its own terms",
        "Distributed under a proprietary license",
        "Released under an open source license, see LICENSE",
        "Copyright by the authors. License terms apply",
    ],
}


def words(text: Column) -> Column:
    """Lower-case words, digits as 0."""
    plain = F.regexp_replace(F.lower(text), r"[0-9]+", "0")
    return F.filter(F.split(plain, r"[^\p{L}\p{N}]+"), lambda w: w != "")


def bins(tokens: Column) -> Column:
    """Bins of the words and word pairs; ``tokens`` should be a plain column or field.

    Lambdas work out anew what they refer to for each element.
    """
    pairs = F.transform(
        F.slice(tokens, 2, F.greatest(F.size(tokens) - 1, F.lit(0))),
        lambda w, i: F.pmod(F.xxhash64(F.get(tokens, i), w), F.lit(BINS)).cast("int"),
    )
    singles = F.transform(tokens, lambda w: F.pmod(F.xxhash64(w), F.lit(BINS)).cast("int"))
    return F.concat(singles, pairs)


def paragraphs(text: Column) -> Column:
    return F.filter(F.split(text, r"\s*\n\s*"), lambda p: F.trim(p) != "")


def blocks(text: Column) -> Column:
    """Parts between blank lines; their lines are those of ``paragraphs``."""
    return F.filter(F.split(text, r"\s*\n[^\S\n]*\n\s*"), lambda b: F.trim(b) != "")


@dataclass(frozen=True)
class Model:
    """Weights by bin and class, with what the held-out rows say."""

    classes: tuple[str, ...]
    bias: tuple[float, ...]
    weights: dict[int, tuple[float, ...]]
    temperature: float
    accuracy: float


def labelled(spark: SparkSession, docs: DataFrame, text: str, sample_docs: int) -> DataFrame:
    """(label, paragraph): templates alone and among words of the corpus; corpus paragraphs.

    Corpus paragraphs that hold most of a template's words are left out: nobody
    has labelled them.
    """
    share_of_docs = sample_docs / max(1, docs.count())
    place = F.pmod(F.xxhash64(text), F.lit(1 << 31))
    chosen = docs.select(F.col(text), place.alias("place")).dropna()
    chosen = chosen.filter(F.col("place") < int(share_of_docs * (1 << 31))).dropDuplicates(["place"])
    plain = chosen.select(F.explode(paragraphs(F.col(text))).alias("paragraph")).distinct()
    rows = [(f, t) for f, found in TEMPLATES.items() for t in found]
    known = spark.createDataFrame(rows, "label string, paragraph string")
    about = known.agg(F.array_distinct(F.flatten(F.collect_list(words(F.col("paragraph")))))).scalar()
    share = F.size(F.array_intersect(words(F.col("paragraph")), about)) / F.greatest(
        F.size(F.array_distinct(words(F.col("paragraph")))), F.lit(1)
    )
    tells = F.lower("paragraph").rlike("licen[cs]e|copyright|spdx|warrant|redistribut")
    none = plain.filter(~tells & (share < 0.5)).select(F.lit(NONE).alias("label"), "paragraph")
    # Each template also with corpus words around it.
    around = (
        none.select(F.slice(F.split("paragraph", " "), 1, 6).alias("w"))
        .orderBy(F.xxhash64("w"))
        .limit(24)
    )
    wrapped = known.join(around, F.pmod(F.xxhash64("paragraph", "w"), F.lit(2)) == 0).select(
        "label",
        F.concat_ws(" ", F.array_join("w", " "), "paragraph", F.array_join(F.reverse("w"), " ")).alias(
            "paragraph"
        ),
    )
    return none.union(wrapped).union(known)


def train(docs: DataFrame, text: str = "text", sample_docs: int = SAMPLE_DOCS) -> Model:
    """Fit on labelled paragraphs; a fifth of them calibrates and measures.

    Paragraphs go to the held-out part by a hash. A corpus without paragraphs
    still teaches the families from their templates.
    """
    spark = docs.sparkSession
    rows = labelled(spark, docs, text, sample_docs)
    classes = (*sorted(f for f in TEMPLATES if f != UNKNOWN), UNKNOWN, NONE)
    number = reduce(
        lambda when, c: when.when(F.col("label") == c[1], float(c[0])),
        enumerate(classes),
        F.when(F.lit(False), 0.0),
    )
    # A bounded sample: two partitions keep the many small steps of the fit short.
    rows = rows.coalesce(2).withColumn("tokens", words(F.col("paragraph")))
    rows = rows.select(
        number.alias("label"),
        F.transform(F.array_distinct(bins(F.col("tokens"))), lambda b: b.cast("string")).alias("bins"),
        (F.pmod(F.xxhash64("paragraph"), F.lit(5)) == 0).alias("held_out"),
        F.when(F.col("label") == NONE, 1.0).otherwise(4.0).alias("weight"),
    ).persist()
    try:
        vectors = CountVectorizer(inputCol="bins", outputCol="features", binary=True).fit(rows)
        regression = LogisticRegression(
            family="multinomial", maxIter=60, regParam=2e-4, elasticNetParam=0.3, weightCol="weight"
        )
        seen = vectors.transform(rows)
        fitted = regression.fit(seen.filter("not held_out"))
        matrix = fitted.coefficientMatrix.toArray()
        n = matrix.shape[0]  # classes up to the largest label seen
        bias = [float(x) for x in fitted.interceptVector] + [-20.0] * (len(classes) - n)
        weights = {}
        for j, name in enumerate(vectors.vocabulary):
            column = [float(matrix[k, j]) if k < n else 0.0 for k in range(len(classes))]
            if any(column):
                weights[int(name)] = tuple(column)
        raw = fitted.transform(seen.filter("held_out")).select(
            "label", "prediction", vector_to_array("rawPrediction").alias("raw")
        )
        temperature, accuracy = calibrate(raw)
    finally:
        rows.unpersist()
    return Model(classes, tuple(bias), weights, temperature, accuracy)


def calibrate(raw: DataFrame) -> tuple[float, float]:
    """(temperature with the least log loss, accuracy) on held-out rows."""
    grid = [0.5, 0.7, 1.0, 1.4, 2.0, 2.8, 4.0]

    def loss(t: float) -> Column:
        top = F.array_max("raw")
        total = F.aggregate("raw", F.lit(0.0), lambda a, x: a + F.exp((x - top) / t))
        return F.avg(F.log(total) - (F.get("raw", F.col("label").cast("int")) - top) / t)

    row = raw.agg(
        F.avg((F.col("label") == F.col("prediction")).cast("double")), *(loss(t) for t in grid)
    ).first()
    if row[0] is None:
        return 1.0, math.nan
    losses = list(row)[1:]
    return grid[losses.index(min(losses))], float(row[0])


def constant(value: list, kind: str) -> Column:
    """A literal of any array type; the optimizer parses the text once."""
    return F.from_json(F.lit(json.dumps(value)), kind)


def _adder(weights: Column, i: int):
    return lambda total, slot: total + F.get(F.get(weights, slot), F.lit(i))


def scan(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Add ``licences``: array of (paragraph, family, probability) of each text.

    Every paragraph (line that isn't blank, counted from 0) of every whole text is
    scored, and so are the lines between blank ones as a whole, which wrapped
    notices need. A line is listed if the calibrated classifier holds it for a licence: with
    a family's name if that is the likeliest class, has at least
    LEAST_PROBABILITY, and a template of the family is found in it; else as
    unknown. Lines together are listed by their first one, in place of their
    unknown lines, if they have a family by the same rule that none of them has
    by itself. NULL and empty texts list nothing; repeated rows are scanned each; an
    input column ``licences`` is replaced.
    """
    k = len(model.classes)
    held = sorted(model.weights)
    slot = {b: i for i, b in enumerate(held)}
    slots = constant([slot.get(b, -1) for b in range(BINS)], "array<int>")
    weights = constant([model.weights[b] for b in held], "array<array<double>>")
    rows = [(f, t) for f, found in TEMPLATES.items() if f != UNKNOWN for t in found]
    templates = F.array(
        *(F.struct(F.lit(f).alias("f"), F.array_distinct(words(F.lit(t))).alias("w")) for f, t in rows)
    )
    names = F.array(*map(F.lit, model.classes))

    def read(paragraph: Column, at: Column) -> Column:
        return F.struct(at.alias("paragraph"), words(paragraph).alias("tokens"))

    def look_up(entry: Column) -> Column:
        known = F.filter(
            F.transform(bins(entry["tokens"]), lambda b: F.get(slots, b)), lambda slot: slot >= 0
        )
        return F.struct(
            entry["paragraph"].alias("paragraph"),
            entry["tokens"].alias("tokens"),
            F.array_distinct(known).alias("found"),
        )

    def logits(found: Column) -> Column:
        return F.array(
            *(
                F.aggregate(
                    found,
                    F.lit(model.bias[i]),
                    _adder(weights, i),
                )
                for i in range(k)
            )
        )

    def decide(entry: Column) -> Column:
        raw = logits(entry["found"])
        return F.struct(entry["paragraph"].alias("paragraph"), entry["tokens"].alias("tokens"), raw.alias("raw"))

    def name(entry: Column) -> Column:
        raw, t = entry["raw"], model.temperature
        top = F.array_max(raw)
        total = F.aggregate(raw, F.lit(0.0), lambda a, x: a + F.exp((x - top) / t))
        family = F.get(names, F.array_position(raw, top).cast("int") - 1)
        probability = 1.0 / total
        own = F.array_distinct(entry["tokens"])
        confirmed = F.exists(
            templates,
            lambda x: (x["f"] == family)
            & (F.size(F.array_intersect(x["w"], own)) >= AGREEMENT * F.size(x["w"])),
        )
        sure = (probability >= LEAST_PROBABILITY) & confirmed
        return F.struct(
            entry["paragraph"].alias("paragraph"),
            F.when(family == NONE, NONE).when(sure, family).otherwise(UNKNOWN).alias("family"),
            F.round(probability, 4).alias("probability"),
        )

    def named(candidates: Column) -> Column:
        parts = F.transform(F.transform(candidates, read), look_up)
        # Paragraphs without any n-gram that has a weight are what the bias says: none.
        scored = F.transform(F.filter(parts, lambda p: F.size(p["found"]) > 0), decide)
        likely = F.filter(scored, lambda p: F.element_at(p["raw"], k) < F.array_max(p["raw"]))
        return F.transform(likely, name)

    lines, whole, sizes = fresh("_lines", docs.columns), fresh("_whole", docs.columns), fresh("_sizes", docs.columns)
    value = F.coalesce(text, F.lit(""))
    known = docs.withColumns(
        {
            lines: named(paragraphs(value)),
            # A block of one line is that line.
            whole: named(F.transform(blocks(value), lambda b: F.when(b.contains("\n"), b).otherwise(""))),
            sizes: F.transform(blocks(value), lambda b: F.size(paragraphs(b))),
        }
    )

    def place(block: Column) -> Column:
        before = F.slice(F.col(sizes), F.lit(1), block["paragraph"].cast("int"))
        start = F.aggregate(before, F.lit(0), lambda a, n: a + n)
        return F.struct(
            start.alias("paragraph"),
            block["family"].alias("family"),
            block["probability"].alias("probability"),
            (start + F.get(F.col(sizes), block["paragraph"])).alias("end"),
        )

    def among(line: Column, block: Column) -> Column:
        return (line["paragraph"] >= block["paragraph"]) & (line["paragraph"] < block["end"])

    placed = F.transform(F.filter(F.col(whole), lambda b: b["family"] != UNKNOWN), place)
    known = known.withColumn(whole, placed)
    own = F.filter(
        F.col(whole),
        lambda b: ~F.exists(F.col(lines), lambda x: among(x, b) & (x["family"] == b["family"])),
    )
    known = known.withColumn(whole, own)
    left = F.filter(
        F.col(lines),
        lambda x: (x["family"] != UNKNOWN) | ~F.exists(F.col(whole), lambda b: among(x, b)),
    )
    added = F.transform(
        F.col(whole),
        lambda b: F.struct(b["paragraph"].alias("paragraph"), b["family"].alias("family"), b["probability"].alias("probability")),
    )
    listed = F.when(F.size(F.col(whole)) == 0, F.col(lines)).otherwise(F.array_sort(F.concat(left, added)))
    return known.withColumn("licences", listed).drop(lines, whole, sizes)
