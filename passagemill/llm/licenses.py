"""Licence families of paragraphs, in DataFrame operations only.

A multinomial logistic regression over words and word pairs of known licence notices is fitted
with an L1 penalty, which leaves few of them with a weight; those in one ordinary paragraph of a
hundred or more are left out from the start. A paragraph without any weighted word
scores as the intercepts do, so only paragraphs with one need scoring; they are scored inside the
row of their document. A least probability, set on held-out paragraphs, turns doubtful ones into
``unknown``, and so does a comparison with the notices of the predicted family that fails.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.common import compute_once

#: Notices by licence family, as their publishers word them.
NOTICES = [
    ("mit", "Released under the MIT License."),
    ("mit", "This project is licensed under the terms of the MIT license."),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction."),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License."),
    ("apache-2.0", "This project is released under the Apache 2.0 license."),
    ("gpl", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation."),
    ("gpl", "Distributed under the terms of the GNU GPL version 2 or later."),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met."),
    ("bsd", "Released under the BSD 3-Clause License."),
    ("bsd", "Use of this source code is governed by a BSD-style license."),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0."),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("cc-by", "Licensed under CC BY 4.0."),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("lgpl", "Licensed under the GNU Lesser General Public License, version 2.1 or later."),
    ("lgpl", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation."),
    ("agpl", "Licensed under the GNU Affero General Public License, version 3."),
    ("agpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation."),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0."),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("cc-by-nd", "Licensed under CC BY-ND 4.0."),
    ("cc-by-nd", "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License."),
    ("cc0", "To the extent possible under law, the author has waived all copyright and related rights to this work under CC0 1.0 Universal."),
    ("epl", "Licensed under the Eclipse Public License, Version 2.0."),
    ("epl", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0."),
    ("isc", "Released under the ISC License."),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted."),
    ("bsl", "Distributed under the Boost Software License, Version 1.0."),
    ("unlicense", "This is free and unencumbered software released into the public domain."),
]
NONE, UNKNOWN = "none", "unknown"


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(text), "[^a-z0-9]+"), "")


def grams_of(words: Column) -> Column:
    """Words, and pairs of neighbouring words."""
    pairs = F.transform(F.slice(words, 1, F.greatest(F.size(words) - 1, F.lit(0))), lambda w, i: F.concat_ws(" ", w, F.get(words, i + 1)))
    return F.concat(words, pairs)


@dataclass(frozen=True)
class LicenceModel:
    """Classes, intercepts, weighted grams with a weight per class, words of which a paragraph with a weighted gram has one, least probability."""

    classes: list[str]
    intercepts: list[float]
    weights: dict[str, list[float]]
    needed: list[str]
    least: float


def _notices(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(NOTICES, "family string, notice string")


def _overlap(grams: Column, notices: list[list[str]]) -> Column:
    """Greatest share of common grams, of the smaller side, with any of several notices."""
    own = F.array_distinct(grams)
    return F.greatest(F.lit(0.0), *[F.size(F.array_intersect(own, F.array(*map(F.lit, n)))) / F.least(F.size(own), F.lit(len(n))) for n in notices])


def own_grams(known: dict[str, list[list[str]]]) -> dict[str, list[list[str]]]:
    """Of each notice the grams that no notice of another family has: those that tell its family apart."""
    out = {}
    for family, notices in known.items():
        others = {g for other, some in known.items() if other != family for n in some for g in n}
        out[family] = [own for own in ([g for g in n if g not in others] for n in notices) if own]
    return out


def _told_apart(grams: Column, notices: list[list[str]]) -> Column:
    """Greatest share of a notice's own grams that a paragraph has, with any of several notices."""
    own = F.array_distinct(grams)
    return F.greatest(F.lit(0.0), F.lit(0.0), *[F.size(F.array_intersect(own, F.array(*map(F.lit, n)))) / F.lit(float(len(n))) for n in notices])


def notice_grams(spark: SparkSession) -> dict[str, list[list[str]]]:
    rows = _notices(spark).select("family", F.array_distinct(grams_of(words_of(F.col("notice")))).alias("g")).collect()
    out: dict[str, list[list[str]]] = {}
    for r in rows:
        out.setdefault(r["family"], []).append(r["g"])
    return out


def train_licences(docs: DataFrame, text_col: str = "text", sample_rows: int = 4000, false_rate: float = 0.001) -> LicenceModel:
    """Model from the notices, each also without any one of its words, and ``sample_rows`` paragraphs of ``docs`` at most.

    Paragraphs are drawn by a hash of their text, from an eighth as many documents, drawn by a hash of theirs; equal texts and
    equal paragraphs count once. Those
    that share half their grams with a notice are left out of the class ``none``. A quarter of
    them is held out: the least probability lets at most ``false_rate`` of these pass for a
    licence, and is one half at least.
    """
    spark = docs.sparkSession
    known = notice_grams(spark)
    texts = docs.select(F.col(text_col).cast("string").alias("text")).filter("text is not null")
    share = min(1.0, sample_rows / 8 / max(1, texts.select(F.xxhash64("text")).distinct().count()))
    drawn = texts.filter(F.pmod(F.xxhash64("text"), F.lit(1 << 40)) < int(share * (1 << 40))).distinct()
    lines = drawn.select(F.explode(F.split("text", "\n")).alias("line")).distinct().select("line", grams_of(words_of(F.col("line"))).alias("grams")).filter(F.size("grams") > 0)
    plain = lines.filter(_overlap(F.col("grams"), [n for group in known.values() for n in group]) < 0.5)
    plain = plain.orderBy(F.xxhash64("line"), "line").limit(sample_rows).select(F.lit(NONE).alias("family"), "grams", (F.pmod(F.xxhash64(F.lit(3), "line"), F.lit(4)) == 0).alias("held"))
    words = words_of(F.col("notice"))
    shorter = F.transform(F.sequence(F.lit(0), F.size(words)), lambda i: F.filter(words, lambda w, j: j + 1 != i))
    notices = _notices(spark).select("family", F.explode(shorter).alias("w")).select("family", grams_of(F.col("w")).alias("grams"), F.lit(False).alias("held"))
    rows = [(r["family"], r["grams"], r["held"]) for r in plain.unionByName(notices).collect()]  # bounded by sample_rows and the notices
    classes = [NONE, *sorted(known)]
    seen = Counter(g for f, grams, _ in rows if f == NONE for g in set(grams))
    often = 0.01 * max(1, sum(f == NONE for f, _, _ in rows))
    vocabulary = sorted({g for group in known.values() for n in group for g in n if seen[g] <= often})
    number = {g: i for i, g in enumerate(vocabulary)}
    fit = [(classes.index(f), g) for f, g, h in rows if not h]
    features = np.zeros((len(fit), len(vocabulary)))
    for i, (_, grams) in enumerate(fit):
        features[i, [number[g] for g in grams if g in number]] = 1
    matrix, intercepts = _fit(features, np.array([c for c, _ in fit]), len(classes))
    weights = {g: [float(x) for x in matrix[:, i]] for i, g in enumerate(vocabulary) if abs(matrix[:, i]).max() > 0}
    # Any paragraph with a weighted gram has one of these words: of a pair, the rarer one is enough.
    needed = sorted({min(g.split(" "), key=lambda w: (seen[w], w)) for g in weights})
    model = LicenceModel(classes, [float(x) for x in intercepts], weights, needed, 0.5)
    held = [1 - _probabilities(model, g)[0] for f, g, h in rows if h]
    held.sort(reverse=True)
    least = max(0.5, held[int(false_rate * len(held))] + 1e-6) if held else 0.5
    return LicenceModel(classes, model.intercepts, weights, needed, least)


def _fit(features: np.ndarray, label: np.ndarray, classes: int, penalty: float = 0.0003, steps: int = 600) -> tuple[np.ndarray, np.ndarray]:
    """Multinomial logistic regression with an L1 penalty, by accelerated proximal gradient steps.

    The sample is bounded, so it is fitted where it was collected. Intercepts have no penalty.
    """
    n = len(label)
    x = np.hstack([features, np.ones((n, 1))])
    wanted = np.eye(classes)[label]
    rate = 2 * n / max(1e-9, np.linalg.norm(x, 2) ** 2)
    weight = ahead = np.zeros((classes, x.shape[1]))
    momentum = 1.0
    for _ in range(steps):
        z = x @ ahead.T
        share = np.exp(z - z.max(1, keepdims=True))
        share /= share.sum(1, keepdims=True)
        moved = ahead - rate * ((share - wanted).T @ x) / n
        moved[:, :-1] = np.sign(moved[:, :-1]) * np.maximum(np.abs(moved[:, :-1]) - rate * penalty, 0)
        after = (1 + math.sqrt(1 + 4 * momentum**2)) / 2
        ahead = moved + (momentum - 1) / after * (moved - weight)
        weight, momentum = moved, after
    return weight[:, :-1], weight[:, -1]


def _probabilities(model: LicenceModel, grams: list[str]) -> list[float]:
    z = list(model.intercepts)
    for g in set(grams):
        for k, w in enumerate(model.weights.get(g, ())):
            z[k] += w
    top = max(z)
    e = [math.exp(x - top) for x in z]
    return [x / sum(e) for x in e]


def license_scan(docs: DataFrame, model: LicenceModel | None = None, id_col: str = "doc_id", text_col: str = "text", overlap: float = 0.5, apart: float = 0.3) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, paragraphs``, an array of (line, family, probability, overlap).

    A paragraph is a line; ``line`` counts from 0. Listed are those that the model gives to a
    licence family rather than to ``none``. ``family`` is ``unknown`` if the family's probability
    is below what the model learned, or if less than ``overlap`` of the paragraph's words and
    word pairs (of the notice's, if those are fewer) are in one notice of that family, or if it has less
    than ``apart`` of the words and pairs that no other family's notices have: what many licences say
    confirms none of them. A null or empty text has none. Of equal probabilities the first family by
    name counts. Repeated rows are scanned each; an empty table gives no row. Whole texts are read,
    other columns are not.
    """
    spark = docs.sparkSession
    model = model or train_licences(docs, text_col)
    known = notice_grams(spark)
    apart_of = own_grams(known)
    if not model.weights:
        weights = F.lit(None).cast("map<string,array<double>>")
    else:
        weights = F.create_map(*[x for g, w in sorted(model.weights.items()) for x in (F.lit(g), F.array(*map(F.lit, w)))])
    needed = F.array(*map(F.lit, model.needed)) if model.needed else F.array().cast("array<string>")
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    lines = F.transform(F.split("text", "\n"), lambda line, i: F.struct(i.alias("line"), words_of(line).alias("words")))
    rows = compute_once(rows.select("doc_id", lines.alias("lines")), some=F.filter("lines", lambda x: F.arrays_overlap(x["words"], needed))).drop("lines")
    rows = compute_once(rows, grams=F.transform("some", lambda x: F.struct(x["line"], F.array_distinct(grams_of(x["words"])).alias("grams")))).drop("some")

    def logits(x):
        found = F.filter(F.transform(x["grams"], lambda g: F.try_element_at(weights, g)), lambda v: v.isNotNull())
        return F.aggregate(found, F.array(*map(F.lit, model.intercepts)), lambda a, v: F.zip_with(a, v, lambda p, q: p + q))

    rows = compute_once(rows, scored=F.transform("grams", lambda x: F.struct(x["line"], x["grams"], logits(x).alias("z")))).drop("grams")

    def decide(x):
        top = F.array_max(x["z"])
        best = F.element_at(F.array(*map(F.lit, model.classes)), F.array_position(x["z"], top).cast("int"))
        total = F.aggregate(x["z"], F.lit(0.0), lambda a, v: a + F.exp(v - top))
        share = tells = F.lit(0.0)
        for family, notices in known.items():
            share = F.when(best == family, _overlap(x["grams"], notices)).otherwise(share)
            tells = F.when(best == family, _told_apart(x["grams"], apart_of[family])).otherwise(tells)
        return F.struct(x["line"], best.alias("best"), (1 / total).alias("probability"), share.alias("overlap"), tells.alias("apart"))

    rows = compute_once(rows, judged=F.transform("scored", decide)).drop("scored")
    listed = F.filter("judged", lambda x: x["best"] != NONE)
    sure = lambda x: (x["probability"] >= model.least) & (x["overlap"] >= overlap) & (x["apart"] >= apart)
    named = F.transform(listed, lambda x: F.struct(x["line"], F.when(sure(x), x["best"]).otherwise(UNKNOWN).alias("family"), x["probability"], x["overlap"]))
    return rows.select("doc_id", named.alias("paragraphs"))
