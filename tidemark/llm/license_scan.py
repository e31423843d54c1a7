"""Licence scan: a trained paragraph classifier with a calibrated unknown class, confirmed against templates.

Everything is DataFrame operations. Paragraphs are runs of lines without an empty one, so that wrapped notices stay
whole; they are cut into overlapping windows of lower-cased words (``WINDOWS``), and a template is looked for in the
windows of the smallest size that is sure to hold a whole copy of it. Features are the word uni- and bigrams of a
window, restricted to those that occur in the licence templates; windows without a cue of any template are dropped
before anything is shuffled. A multinomial logistic regression is trained on the templates, on partial
templates, and on the unknown class: a bounded sample of corpus windows without a cue and one of windows with a cue
but no template (``BACKGROUND`` of each, the first in the order of a hash; a documented bound), and templates
without their names. Some partial templates and every fourth window of the unknown class are held out; on them the
confidence is calibrated (one temperature, by likelihood), and so is the least confidence of each
family (a standard deviation below the lowest held-out notice of the family, as what comes so far has its words).
A family counts in a window if its confidence against the unknown class
reaches that, and the window holds at least ``CONFIRM`` of the bigrams of one of its templates and one of that
template's name words (``NAMES``); every family that passes counts, not the likeliest only.

Defined results: null and empty texts have no licence; several licences in a text are all listed; repeated
rows are treated alike; an empty table gives no rows; other
columns are ignored. Texts are read whole.
"""

from __future__ import annotations

import numpy as np
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize
from .sampling import least_hashes

UNKNOWN = "unknown"
BACKGROUND = 2000
DRAWN = 4
HELD_OUT = 4
EMBEDDED = 64
CONFIRM = 0.6
# (words, step) of the windows: a run of words - step + 1 words lies whole in one
WINDOWS = ((20, 8), (48, 16))

# Short notices of common licences, as their texts recommend them.
TEMPLATES = {
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
        "SPDX-License-Identifier: Apache-2.0",
    ],
    "BSD": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        "Use of this source code is governed by a BSD-style license",
        "Released under the BSD License",
        "SPDX-License-Identifier: BSD-3-Clause",
    ],
    "CC-BY": [
        "This work is licensed under a Creative Commons Attribution 4.0 International License",
        "Licensed under CC BY 4.0",
    ],
    "CC-BY-NC": [
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License",
        "Licensed under CC BY-NC 4.0",
    ],
    "CC-BY-SA": [
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
        "Licensed under CC BY-SA 4.0",
    ],
    "GPL": [
        "This work is licensed under the GNU General Public License, version 3",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ],
    "LGPL": [
        "This library is licensed under the GNU Lesser General Public License",
        "SPDX-License-Identifier: LGPL-2.1",
    ],
    "MIT": [
        "Released under the MIT License",
        "Licensed under the MIT License",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
        "SPDX-License-Identifier: MIT",
    ],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
        "SPDX-License-Identifier: MPL-2.0",
    ],
    "proprietary": [
        "All rights reserved",
        "Copyright. All rights reserved. No part of this publication may be reproduced without permission",
    ],
    "public-domain": [
        "This work is dedicated to the public domain under CC0 1.0 Universal",
        "This is free and unencumbered software released into the public domain",
    ],
}
# Words or bigrams that tell a family from others with the same wording; each template has one of them.
NAMES = {
    "Apache-2.0": ["apache license", "apache-2.0"],
    "BSD": ["redistribution and", "bsd-style", "bsd", "bsd-3-clause"],
    "CC-BY": ["commons attribution", "cc by"],
    "CC-BY-NC": ["attribution-noncommercial", "by-nc"],
    "CC-BY-SA": ["attribution-sharealike", "by-sa"],
    "GPL": ["gnu general", "gpl-3.0-or-later"],
    "LGPL": ["gnu lesser", "lgpl-2.1"],
    "MIT": ["mit", "permission is"],
    "MPL-2.0": ["mozilla public", "mpl-2.0"],
    "proprietary": ["rights reserved"],
    "public-domain": ["cc0", "public domain"],
}
# Words that every template has at least one of; only paragraphs with one of them can be confirmed.
CUES = "licen[sc]|spdx|copyright|rights reserved|permission is hereby|redistribution and use|public domain|free software|public license"
# the same in unwrapped text, where anything but letters and digits may stand between two words
WRAPPED_CUES = CUES.replace(" ", "[^a-z0-9]+")


def words(text: Column) -> Column:
    """Lower-case words of a paragraph: letters and digits, with dots and hyphens inside."""
    return F.regexp_extract_all(F.lower(text), F.lit("[a-z0-9]+(?:[.-][a-z0-9]+)*"), F.lit(0))


def grams(found: Column) -> Column:
    """Distinct word uni- and bigrams."""
    pairs = F.zip_with(found, F.slice(found, F.lit(2), F.greatest(F.size(found), F.lit(1))), lambda a, b: F.concat_ws(" ", a, b))
    return F.array_distinct(F.concat(found, pairs))


def bigrams(found: Column) -> Column:
    """Distinct word bigrams."""
    pairs = F.zip_with(F.slice(found, F.lit(1), F.greatest(F.size(found) - 1, F.lit(0))), F.slice(found, F.lit(2), F.greatest(F.size(found) - 1, F.lit(0))), lambda a, b: F.concat_ws(" ", a, b))
    return F.array_distinct(pairs)


def templates(spark: SparkSession) -> DataFrame:
    """(family, template, words, size): a fixed list, with the size of the windows that hold the template."""
    rows = [(family, number, text) for family, texts in TEMPLATES.items() for number, text in enumerate(texts)]
    made = spark.createDataFrame(rows, "family string, template int, text string").select("family", "template", words(F.col("text")).alias("words"))
    size = F.lit(WINDOWS[-1][0])
    for length, step in reversed(WINDOWS[:-1]):
        size = F.when(F.size("words") <= length - step + 1, length).otherwise(size)
    return made.withColumn("size", size)


def paragraphs(docs: DataFrame) -> DataFrame:
    """(doc_id, row, place, size, words) of the windows with a cue; ``row`` tells repeated ids apart."""
    blocks = docs.where(F.lower("text").rlike(WRAPPED_CUES)).select(
        "doc_id", F.monotonically_increasing_id().alias("row"), F.posexplode(F.split("text", "\n[ \t\r]*\n")).alias("place", "block")
    )
    found = blocks.where(F.lower("block").rlike(WRAPPED_CUES)).select("doc_id", "row", "place", words(F.col("block")).alias("all"))
    cuts = [
        F.expr(f"transform(sequence(1, greatest(1, size(all) - {size} + {step}), {step}), i -> struct({size} AS size, slice(all, i, {size}) AS words))")
        for size, step in WINDOWS
    ]
    windows = found.select("doc_id", "row", "place", F.explode(F.concat(*cuts)).alias("w")).select("doc_id", "row", "place", "w.size", "w.words")
    return windows.where(F.concat_ws(" ", "words").rlike(CUES))


def confirmed(windows: DataFrame) -> DataFrame:
    """``windows`` with ``found``: (family, match) of the families of which a window holds enough of a template."""
    wants = named(templates(windows.sparkSession)).select("family", "size", bigrams(F.col("words")).alias("want"), "names")
    wants = wants.groupBy("size").agg(F.collect_list(F.struct("family", "want", "names")).alias("wants"))
    have = windows.select("*", bigrams(F.col("words")).alias("have"), grams(F.col("words")).alias("grams")).join(F.broadcast(wants), "size")
    own = F.filter("wants", lambda w: F.arrays_overlap(w["names"], F.col("grams")))
    shares = F.transform(own, lambda w: F.struct(w["family"], (F.size(F.array_intersect(w["want"], F.col("have"))) / F.size(w["want"])).alias("match")))
    return have.withColumn("found", F.filter(shares, lambda x: x["match"] >= CONFIRM)).drop("have", "grams", "wants")


def named(known: DataFrame) -> DataFrame:
    """``known`` with ``names``: the name words that each template has itself."""
    of = F.create_map(*[part for family, names in NAMES.items() for part in (F.lit(family), F.array(*map(F.lit, names)))])
    return known.withColumn("names", F.array_intersect(of[F.col("family")], grams(F.col("words"))))


class Model:
    """Weights by n-gram, as a table of a few thousand rows (those of the templates), and the intercepts.

    ``temperature`` divides the log odds of a family against the unknown class; ``least`` is the confidence it needs.
    """

    def __init__(self, weights: DataFrame, classes: list[str], intercepts: list[float], temperature: float, least: dict[str, float]):
        self.weights, self.classes, self.intercepts = weights, classes, intercepts
        self.temperature, self.least = temperature, least


def background_windows(docs: DataFrame, limit: int) -> DataFrame:
    """(words) of one window, at a place told by a hash, of texts without a cue: of about DRAWN x ``limit`` texts by
    smallest hash, at most ``limit``."""
    size = WINDOWS[-1][0]
    h = F.xxhash64("text")
    place = f"substring(text, CAST(1 + pmod(xxhash64(text), greatest(length(text) - {12 * size}, 1)) AS INT), {12 * size})"
    texts = docs.select("text", F.expr(place).alias("part"))
    plain = F.expr(f"length(text) > 0 AND NOT lower(text) RLIKE '{WRAPPED_CUES}'")
    drawn = least_hashes(texts, h, DRAWN * limit, docs.count(), plain)
    return drawn.orderBy("h").limit(limit).select(F.slice(words(F.col("part")), 1, size).alias("words"))


def nameless_windows(windows: DataFrame, limit: int) -> DataFrame:
    """(words) of the first ``limit`` different windows by hash, of about twice as many, that have a cue and hold no template."""
    bare = windows.where("size(found) = 0").select("words")
    return least_hashes(bare, F.xxhash64("words"), 2 * limit, bare.count()).orderBy("h").limit(limit).select("words")


def word_grams(found: list[str]) -> set[str]:
    """``grams`` on the driver, for the bounded training rows."""
    return {*found, *(f"{a} {b}" for a, b in zip(found, found[1:]))}


def examples(known: list, unknown: list[list[str]]) -> tuple[list, list]:
    """(class, words) to train on and those held out; ``known`` are the templates, ``unknown`` sampled windows."""
    train, held = [], []
    for family, found, size, names in known:
        cut = max(4, int(len(found) * 0.7))
        train += [(family, found), (family, found[:cut])]
        # shortened at the front, but with a name: without one a window is not confirmed
        tail = found[-cut:]
        held += [(family, part) for part in (found, tail) if word_grams(part) & set(names)]
        bare = {word for name in names for word in name.split()}
        train.append((UNKNOWN, [word for word in found if word not in bare]))
        held.append((UNKNOWN, ["acme" if word in bare else word for word in found]))
        # notices inside other text, as windows have them
        for number in range(min(len(unknown), EMBEDDED)):
            around = unknown[number][: max(0, size - len(found))]
            before = len(around) * (number % 4) // 4
            (held if number % HELD_OUT == 0 else train).append((family, around[:before] + found + around[before:]))
    # two notices in one window are an example of both families
    for place, (family, found, _, _) in enumerate(known):
        for step in range(1, len(known)):
            other = known[(place + step) % len(known)]
            (held if step % HELD_OUT == 0 else train).extend([(family, found + other[1]), (other[0], found + other[1])])
    for number, found in enumerate(unknown):
        (held if number % HELD_OUT == 0 else train).append((UNKNOWN, found))
    return train, held


def calibrate(odds: np.ndarray, labels: list[str], classes: list[str]) -> tuple[float, dict[str, float]]:
    """Temperature and least confidences from the log odds (row, class) of the held-out examples."""
    labels = np.array(labels)
    own = {family: odds[labels == family, number] for number, family in enumerate(classes) if number}
    other = odds[labels == UNKNOWN]
    right = np.concatenate(list(own.values()))
    wrong = other[:, 1:].max(axis=1)

    def loss(t):
        return np.logaddexp(0, -right / t).mean() + np.logaddexp(0, wrong / t).mean()

    temperature = min(np.geomspace(0.25, 8, 41).tolist(), key=loss)
    least = {}
    for number, family in enumerate(classes):
        if number:
            # only windows that are confirmed by words come this far: no held-out notice may be lost
            border = own[family].min() - own[family].std()
            least[family] = float(1 / (1 + np.exp(-border / temperature)))
    return temperature, least


def fit(docs: DataFrame, windows: DataFrame, background: int = BACKGROUND) -> Model:
    """``windows``: those of ``docs`` with a cue, after ``confirmed``."""
    spark = docs.sparkSession
    known = [tuple(r) for r in named(templates(spark)).select("family", "words", "size", "names").orderBy("family", "template").collect()]
    plain, hard = (list(r[0] for r in rows.collect()) for rows in (background_windows(docs, background), nameless_windows(windows, background)))
    train, held = examples(known, [found for found in plain if found] + hard)  # at most twice ``background`` rows
    index = {gram: number for number, gram in enumerate(sorted(set().union(*(word_grams(found) for _, found, _, _ in known))))}
    classes = [UNKNOWN, *sorted(TEMPLATES)]

    def numbers(found):
        return sorted(index[gram] for gram in word_grams(found) if gram in index)

    vectors = [(float(classes.index(c)), 0.2 if c == UNKNOWN else 1.0, Vectors.sparse(len(index), n, [1.0] * len(n))) for c, n in ((c, numbers(w)) for c, w in train)]
    frame = spark.createDataFrame(vectors, ["label", "weight", "features"])
    fitted = LogisticRegression(family="multinomial", regParam=1e-3, maxIter=60, weightCol="weight").fit(frame)
    matrix, intercepts = fitted.coefficientMatrix.toArray(), fitted.interceptVector.toArray()
    scores = np.array([matrix[:, numbers(found)].sum(axis=1) for _, found in held]) + intercepts
    temperature, least = calibrate(scores - scores[:, :1], [c for c, _ in held], classes)
    table = spark.createDataFrame([(gram, matrix[:, number].tolist()) for gram, number in index.items()], "gram string, weights array<double>")
    return Model(table, classes, intercepts.tolist(), temperature, least)


def scan(docs: DataFrame, background: int = BACKGROUND) -> DataFrame:
    """(doc_id, row, place, family, confidence, match) of every confirmed licence in a paragraph."""
    windows = materialize(confirmed(paragraphs(docs)).withColumn("window", F.monotonically_increasing_id()))
    model = fit(docs, windows, background)
    hits = (
        windows.where("size(found) > 0")
        .select("doc_id", "row", "place", "window", "found", F.explode(grams(F.col("words"))).alias("gram"))
        .join(F.broadcast(model.weights), "gram")  # a row per n-gram of the templates
        .groupBy("doc_id", "row", "place", "window")
        .agg(F.first("found").alias("found"), *[F.sum(F.col("weights")[number]).alias(f"s{number}") for number in range(len(model.classes))])
    )
    odds = F.create_map(*[part for number, name in enumerate(model.classes) for part in (F.lit(name), F.col(f"s{number}") - F.col("s0") + F.lit(model.intercepts[number] - model.intercepts[0]))])
    scored = hits.select("doc_id", "row", "place", F.explode("found").alias("hit"), odds.alias("odds"))
    scored = scored.select("doc_id", "row", "place", "hit.*", F.col("odds")[F.col("hit.family")].alias("odds"))
    least = F.create_map(*[part for family, value in model.least.items() for part in (F.lit(family), F.lit(value))])
    scored = scored.withColumn("confidence", 1 / (1 + F.exp(-F.col("odds") / model.temperature)))
    return (
        scored.where(F.col("confidence") >= least[F.col("family")])
        .groupBy("doc_id", "row", "place", "family")
        .agg(F.max("confidence").alias("confidence"), F.max("match").alias("match"))
    )


def licences(docs: DataFrame, background: int = BACKGROUND) -> DataFrame:
    """(doc_id, licences, n_paragraphs, confidence) of every document with a confirmed licence."""
    return (
        scan(docs, background)
        .groupBy("doc_id", "row")
        .agg(
            F.array_join(F.array_sort(F.collect_set("family")), ",").alias("licences"),
            F.count_distinct("place").alias("n_paragraphs"),
            F.max("confidence").alias("confidence"),
        )
        .drop("row")
    )
