"""License scans with a trained paragraph classifier.

A paragraph is a run of lines without a blank one between, as notices stand in files, with the
marks of comments taken off; its lines are also judged one by one, since a notice may stand among
other lines. Its features are word 1-, 2- and 3-grams; a logistic regression
over them, trained here on notices of each family and on ordinary paragraphs of the corpus,
gives a probability for each family and for ``none``. The probabilities are calibrated by a
temperature fitted on paragraphs left out of the training; where no family is probable enough
the paragraph is of an unknown licence. A family is confirmed when the paragraph holds enough of
the words of one of its templates.

Scoring is a join of n-grams with a table of weights and grouped sums.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfledger.llm.common import documents, written

#: Usual notices of public licences, by family.
TEMPLATES = {
    "apache": (
        "Licensed under the Apache License, Version 2.0.",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this '
        "file except in compliance with the License.",
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "This project is released under the Apache 2.0 license.",
        "SPDX-License-Identifier: Apache-2.0",
    ),
    "bsd": (
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met:",
        "Use of this source code is governed by a BSD-style license that can be found in the "
        "LICENSE file.",
        "Licensed under the BSD 3-Clause License.",
        "Released under the 2-clause BSD license.",
        "SPDX-License-Identifier: BSD-3-Clause",
    ),
    "cc": (
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "This work is licensed under the Creative Commons Attribution-ShareAlike 4.0 license.",
        "To the extent possible under law, the author has waived all copyright under CC0.",
        "Content is available under CC BY-SA 3.0 unless otherwise noted.",
        "SPDX-License-Identifier: CC-BY-4.0",
        "The person who associated a work with this deed has dedicated the work to the public "
        "domain by waiving all of his or her rights to the work worldwide.",
        "This work is dedicated to the public domain.",
    ),
    "gpl": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the "
        "terms of the GNU General Public License as published by the Free Software Foundation.",
        "You should have received a copy of the GNU General Public License along with this "
        "program.",
        "Licensed under the GPL version 2 or later.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ),
    "lgpl": (
        "This library is free software; you can redistribute it and/or modify it under the "
        "terms of the GNU Lesser General Public License.",
        "Licensed under the LGPL version 2.1 or later.",
        "SPDX-License-Identifier: LGPL-2.1-only",
    ),
    "mit": (
        "Released under the MIT License.",
        "Licensed under the MIT license.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        "software and associated documentation files, to deal in the Software without "
        "restriction.",
        'The software is provided "as is", without warranty of any kind, express or implied.',
        "The above copyright notice and this permission notice shall be included in all copies or "
        "substantial portions of the Software.",
        "The MIT License (MIT)",
        "This project is available under the terms of the MIT License, see LICENSE for details.",
        "SPDX-License-Identifier: MIT",
    ),
    "mpl": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License, version 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
    ),
    "other": (
        "All rights reserved.",
        "Copyright 2019 by the authors, all rights reserved.",
        "This software is licensed under the terms in the license agreement.",
        "You must accept the licence terms before use.",
        "No part of this work may be copied without written permission of the copyright holder.",
    ),
}
NONE, UNKNOWN = "none", "unknown"
#: Words without which a paragraph is no notice. They are part of the model: every notice it is
#: trained on has one of them, and other paragraphs are of class ``none`` by definition.
CUES = (
    "licen[sc]e", "licen[sc]ed", "licen[sc]ing", "copyright", "redistribut", "permission",
    "gnu", "gpl", "cc0", "cc by", "all rights reserved", "free software", "creative commons",
    "source code form", "warrant", "public domain",
)
#: Ordinary paragraphs of the corpus used for training: those of least hash.
ORDINARY = 500
#: Least calibrated probability of a family, and least share of a template's words.
LEAST_PROBABILITY, LEAST_SHARE = 0.6, 0.6
#: Longest n-gram, and gradient steps of the training.
LONGEST, STEPS = 3, 400

#: Blanks and the marks of comments that a line may begin or end with.
_MARKS = r"^[\s]*(?:/\*+|//+|\*+/?|[#;%]+|--+|<!--)?[\s]*|[\s]*(?:\*+/|-->)?[\s]*$"
_WORD = r"[^a-z0-9+.]+"


def tokens_of(paragraph: str) -> list[str]:
    found = re.split(_WORD, paragraph.lower())
    return [t for t in (w.strip(".") for w in found) if t]


def tokens(paragraph: Column) -> Column:
    """Lower-case words of a paragraph, without dots at their ends."""
    return F.filter(
        F.transform(F.split(F.lower(paragraph), _WORD), lambda w: F.btrim(w, F.lit("."))),
        lambda w: w != "",
    )


def grams_of(words: list[str]) -> list[str]:
    """Distinct n-grams, in the order of their first word, shorter ones first."""
    return list(dict.fromkeys(
        " ".join(words[i:i + n]) for n in range(1, LONGEST + 1)
        for i in range(len(words) - n + 1)
    ))


def grams(words: Column) -> Column:
    """Distinct n-grams of an array of words."""
    def of_length(n: int) -> Column:
        return F.transform(
            F.slice(words, 1, F.greatest(F.size(words) - (n - 1), F.lit(0))),
            lambda w, i: F.concat_ws(" ", w, *(F.get(words, i + k) for k in range(1, n))),
        )

    return F.array_distinct(F.concat(*(of_length(n) for n in range(1, LONGEST + 1))))


@dataclass
class Model:
    """``weights[g, c]`` of each n-gram for each class, the classes' biases, and the
    temperature that the scores are divided by."""

    classes: list[str]
    vocabulary: list[str]
    weights: np.ndarray
    bias: np.ndarray
    temperature: float = 1.0

    def scores(self, paragraphs: list[str]) -> np.ndarray:
        number = {g: i for i, g in enumerate(self.vocabulary)}
        out = np.tile(self.bias, (len(paragraphs), 1))
        for i, p in enumerate(paragraphs):
            found = [number[g] for g in grams_of(tokens_of(p)) if g in number]
            out[i] += self.weights[found].sum(axis=0)
        return out


def _variants(notice: str) -> list[str]:
    """A notice as it stands and with words around it, as notices occur in texts."""
    return [notice, f"{notice} See the file for details.", f"Note: {notice}"]


def train(ordinary: list[str]) -> Model:
    """Fits the regression by gradient steps on all variants, then the temperature on the
    paragraphs left out (each fifth)."""
    labelled = [(v, f) for f, notices in TEMPLATES.items() for n in notices for v in _variants(n)]
    labelled += [(p, NONE) for p in ordinary]
    classes = [NONE, *TEMPLATES]
    vocabulary = sorted({g for p, c in labelled if c != NONE for g in grams_of(tokens_of(p))})
    number = {g: i for i, g in enumerate(vocabulary)}
    x = np.zeros((len(labelled), len(vocabulary)), dtype=np.float32)
    for i, (p, _) in enumerate(labelled):
        x[i, [number[g] for g in grams_of(tokens_of(p)) if g in number]] = 1
    y = np.eye(len(classes))[[classes.index(c) for _, c in labelled]]
    share = y / np.maximum(y.sum(axis=0), 1)  # classes count alike, however many paragraphs
    each = share.sum(axis=1, keepdims=True)
    out = np.arange(len(labelled)) % 5 == 4

    def chances(z: np.ndarray) -> np.ndarray:
        e = np.exp(z - z.max(axis=1, keepdims=True))
        return e / e.sum(axis=1, keepdims=True)

    w, b = np.zeros((len(vocabulary), len(classes))), np.zeros(len(classes))
    for rows, steps in ((~out, STEPS), (np.ones(len(out), dtype=bool), 0)):
        for _ in range(steps):
            off = (chances(x[rows] @ w + b) - y[rows]) * each[rows]
            w -= 1.0 * (x[rows].T @ off + 1e-3 * w)
            b -= 1.0 * off.sum(axis=0)
    z = x[out] @ w + b
    losses = {
        t: -(np.log(np.maximum((chances(z / t) * y[out]).sum(axis=1), 1e-12)) * each[out, 0]).sum()
        for t in (0.5, 0.7, 1.0, 1.4, 2.0, 2.8, 4.0)
    }
    return Model(classes, vocabulary, w, b, min(losses, key=losses.get))


def bare(line: Column) -> Column:
    """A line without blanks and the marks of comments at its ends."""
    return F.regexp_replace(line, _MARKS, "")


def _cue() -> str:
    """A pattern of the cues; their blanks may be ends of lines."""
    return "(?i)" + "|".join(CUES).replace(" ", r"\s+")


def paragraphs(docs: DataFrame) -> DataFrame:
    """(doc_id, row, piece, line, lines, paragraph): the runs of lines that hold a cue, and in
    runs of several lines also the lines that do. ``line`` is the first one, counted from 0, and
    ``piece`` numbers the runs of a text."""
    cue = _cue()
    held = docs.select(
        "doc_id", F.monotonically_increasing_id().alias("row"), "text"
    ).where(F.col("text").rlike(cue))
    clean = F.concat_ws("\n", F.transform(F.split("text", "\n"), bare))
    pieces = held.select(
        "doc_id", "row", F.posexplode(F.split(clean, "\n\n")).alias("piece", "text")
    ).select(
        "doc_id", "row", "piece", F.size(F.split("text", "\n")).alias("n"),
        F.when(F.col("text").rlike(cue), F.col("text")).alias("text"),
    )
    # a text's pieces in order, without the words of those that hold no cue
    before = Window.partitionBy("row").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    placed = pieces.withColumn(
        "first", F.coalesce(F.sum(F.col("n") + 1).over(before), F.lit(0)).cast("int")
    ).where(F.col("text").isNotNull())
    lines = F.split("text", "\n")
    leading = F.length("text") - F.length(F.ltrim("text", F.lit("\n")))
    run = F.struct(
        (F.col("first") + leading).alias("line"),
        F.size(F.split(F.btrim("text", F.lit("\n")), "\n")).alias("lines"),
        F.btrim("text", F.lit("\n")).alias("paragraph"),
    )
    singly = F.filter(F.transform(lines, lambda x, i: F.struct(
        (F.col("first") + i).alias("line"), F.lit(1).alias("lines"), x.alias("paragraph")
    )), lambda s: s["paragraph"].rlike(cue))
    return placed.select("doc_id", "row", "piece", F.inline(
        F.when(F.btrim("text", F.lit("\n")).contains("\n"), F.concat(F.array(run), singly))
        .otherwise(F.array(run))
    ))


def ordinary_paragraphs(docs: DataFrame, most: int = ORDINARY) -> list[str]:
    """At most ``most`` paragraphs without a cue: a bounded sample for training that does not
    depend on the order of the rows.

    Hashes are dealt into ``most`` classes and the paragraph of least hash is taken from each.
    Only hashes are compared in the first pass; the second one fetches the paragraphs, so as
    many rows reach the driver however many files there are.
    """
    cue = _cue()
    lines = docs.select(F.explode(F.split("text", "\n")).alias("p")).where(
        (F.length("p") >= 20) & (F.length("p") <= 2000) & ~F.col("p").rlike(cue)
    ).withColumn("h", F.xxhash64("p"))
    least = lines.groupBy(F.pmod("h", F.lit(most))).agg(F.min("h").alias("h")).collect()
    chosen = [r["h"] for r in least]
    found = lines.where(F.col("h").isin(chosen)).groupBy("h").agg(F.min("p").alias("p"))
    return [r["p"] for r in sorted(found.collect(), key=lambda r: r["h"])] if chosen else []


def classify(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """(doc_id, line, lines, family, probability, template_share, confirmed, paragraph): one row
    per notice found, with its first line, counted from 0, and their number.

    Takes doc_id and text; other columns are left out. A null or empty text has no notices,
    an empty table gives no rows, and repeated rows give their notices each. ``family`` is
    ``unknown`` where no family is probable enough; paragraphs of class ``none`` are left out.
    Of equally probable families the first in alphabetical order is taken. A run of lines is given
    whole where it is confirmed and none of its lines is confirmed by itself, else line by line.
    """
    model = train(ordinary_paragraphs(docs)) if model is None else model
    spark = docs.sparkSession
    found = written(paragraphs(docs).withColumn("words", tokens(F.col("paragraph"))), "notices")
    weights = spark.createDataFrame(
        [(g, [float(v) for v in row]) for g, row in
         zip(model.vocabulary, model.weights, strict=True)],
        "gram string, weight array<double>",
    )  # one row per n-gram of the templates
    unit = ["row", "line", "lines"]
    summed = (
        found.select(*unit, F.explode(grams(F.col("words"))).alias("gram"))
        .join(F.broadcast(weights), "gram")
        .groupBy(*unit).agg(*(
            F.sum(F.get("weight", F.lit(c))).alias(f"z{c}") for c in range(len(model.classes))
        ))
    )
    z = [
        (F.coalesce(f"z{c}", F.lit(0.0)) + float(b)) / model.temperature
        for c, b in enumerate(model.bias)
    ]
    top = F.greatest(*z)
    total = sum((F.exp(v - top) for v in z[1:]), F.exp(z[0] - top))
    best = F.array_sort(F.array(*(
        F.struct((-F.exp(v - top) / total).alias("p"), F.lit(name).alias("family"))
        for v, name in zip(z, model.classes, strict=True)
    )))[0]
    judged = found.join(summed, unit, "left").withColumn("best", best).where(
        F.col("best.family") != NONE
    )
    templates = spark.createDataFrame(
        [(f, sorted(set(tokens_of(n)))) for f, notices in TEMPLATES.items() for n in notices],
        T.StructType([T.StructField("of", T.StringType()),
                      T.StructField("template", T.ArrayType(T.StringType()))]),
    )  # as many rows as templates
    share = F.size(F.array_intersect("words", "template")) / F.size("template")
    compared = judged.join(
        F.broadcast(templates), F.col("best.family") == F.col("of"), "left"
    ).groupBy("doc_id", "piece", *unit).agg(
        F.first("best").alias("best"), F.first("paragraph").alias("paragraph"),
        F.max(share).alias("template_share"),
    )
    sure = -F.col("best.p") >= LEAST_PROBABILITY
    notices = compared.withColumn(
        "confirmed", sure & F.coalesce(F.col("template_share") >= LEAST_SHARE, F.lit(False))
    )
    one = Window.partitionBy("row", "piece")
    several = F.col("lines") > 1
    return notices.withColumns({
        "by_line": F.max(F.col("confirmed") & ~several).over(one),
        "whole": F.max(F.col("confirmed") & several).over(one),
        "singly": F.max(~several).over(one),
    }).where(
        # single lines stand where one of them, or nothing, is confirmed
        F.when(F.col("whole") & ~F.col("by_line"), several & F.col("confirmed"))
        .otherwise(~several | ~F.col("singly"))
    ).select(
        "doc_id", "line", "lines",
        F.when(sure, F.col("best.family")).otherwise(UNKNOWN).alias("family"),
        (-F.col("best.p")).alias("probability"), "template_share", "confirmed", "paragraph",
    )


def op3_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(documents(spark, sf_dir))
