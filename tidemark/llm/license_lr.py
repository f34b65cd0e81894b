"""Licence scan: a trained paragraph classifier over sparse word n-grams. DataFrame, SQL and ML API only.

Paragraphs are lines, and runs of lines up to a blank line: a notice may stand in one line or be wrapped
over several. A multinomial logistic regression with an L1 penalty over word 1- and 2-grams learns
the licence families from ``TEMPLATES`` (whole notices, their sentences, and both next to ordinary lines), a
class ``unknown`` from notices of licences that are no family here (``OTHERS``), and ``none``
from ordinary lines of the corpus itself: a bounded sample of ``MAX_LINES`` distinct lines, taken by hash, that
share no two-gram of licence words with a template. N-grams of more than ``COMMON`` of these lines, or made of
such words alone, are no features, so most words weigh nothing and only lines with a weighted n-gram need a score: all others have
the bias alone, which says none.

Siblings. Families whose notices differ in a word or two (the GNU licences, the Creative Commons ones) have
``TELLS``. A text that holds a tell of a sibling which no template of a family has cannot be of that family;
the probabilities of the classes are those given this.

Unknown. Probabilities are calibrated by one temperature, fitted on a held-out part of the training rows. A
line that is licence text (probability of ``none`` under one half) without a family of at least
``CONFIDENT`` is ``unknown``. A family is *confirmed* where the line holds at least ``TEMPLATE_SHARE`` of
the n-grams of one of its templates; an unconfirmed prediction is ``unknown`` as well.

Wrapped notices. The lines of a block are judged together where there are several and none is confirmed by
itself. As a long block may hold the words of a short notice by chance, only templates of ``WRAPPED_WORDS`` words count for
it, by the share of their 2-grams. If the block is confirmed, it is one finding, at its first line with a
weighted word, in place of those of its lines; if not, the findings of its lines stay.

Rows. One row for each licence line or wrapped notice (``paragraph`` is the number of its line); a document without any has one row, family ``none``. Null and empty
texts are such documents. Repeated rows and null ids come back as they are. Extra columns are ignored. An
empty table gives no rows.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.frames import clash_free, hashed_values, let, stored

MAX_LINES = 3000
WRAPPED_WORDS = 10
COMMON = 0.004
CONFIDENT = 0.6
TEMPLATE_SHARE = 0.6
NONE, UNKNOWN = "none", "unknown"
#: The customary notices of each family.
TEMPLATES = {
    "mit": (
        "Released under the MIT License.",
        "Licensed under the MIT license.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files, to deal in the Software without restriction.",
    ),
    "apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0; you may not use this file except in compliance with the License.",
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0.",
    ),
    "gpl-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License.",
        "You should have received a copy of the GNU General Public License along with this program.",
    ),
    "gpl-2.0": (
        "This work is licensed under the GNU General Public License, version 2.",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation; either version 2 of the License.",
    ),
    "lgpl": (
        "This library is licensed under the GNU Lesser General Public License, version 3.",
        "GNU Lesser General Public License version 2.1.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
        "General Public License as published by the Free Software Foundation; either version 2.1 of the License.",
    ),
    "agpl-3.0": (
        "This work is licensed under the GNU Affero General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero "
        "General Public License as published by the Free Software Foundation, either version 3 of the License.",
    ),
    "bsd": (
        "Released under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met.",
    ),
    "isc": (
        "Released under the ISC License.",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    "mpl-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License, version 2.0.",
    ),
    "unlicense": (
        "This is free and unencumbered software released into the public domain.",
    ),
    "cc-by": (
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ),
    "cc-by-nc": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ),
    "cc-by-sa": (
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ),
    "cc0": (
        "This work is dedicated to the public domain under CC0 1.0 Universal.",
    ),
}
#: Notices of licences that are no family above.
OTHERS = (
    "Licensed under the Eclipse Public License, version 2.0.",
    "This program and the accompanying materials are made available under the terms of the Eclipse Public License.",
    "Distributed under the Boost Software License, Version 1.0.",
    "This Font Software is licensed under the SIL Open Font License, Version 1.1.",
    "Licensed under the Artistic License 2.0.",
    "Licensed under the European Union Public License, version 1.2.",
    "Licensed under the Microsoft Public License.",
    "This software is provided under a proprietary license; all rights reserved.",
    "Released under the zlib License.",
)
#: Words that tell a family from its siblings.
TELLS = (
    {"gpl-3.0": ("version 3", "gplv3"), "gpl-2.0": ("version 2", "gplv2"), "lgpl": ("lesser", "lgpl"), "agpl-3.0": ("affero", "agpl")},
    {"cc-by-nc": ("by nc", "noncommercial"), "cc-by-sa": ("by sa", "nc sa", "sharealike"), "cc-by": ()},
)
CLASSES = (NONE, *sorted(TEMPLATES), UNKNOWN)


def words_of(text: Column) -> Column:
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def grams_of(words: Column) -> Column:
    """Distinct 1- and 2-grams."""

    def grams(w: Column) -> Column:
        n = F.size(w)
        pairs = F.when(n >= 2, F.transform(F.sequence(F.lit(1), F.greatest(n - 1, F.lit(1))), lambda i: F.concat_ws(
            " ", F.slice(w, i, 2)))).otherwise(F.array().cast("array<string>"))
        return F.array_distinct(F.concat(w, pairs))

    return let(words, grams)


@dataclass(frozen=True)
class Model:
    """Weights of the n-grams that have any, for each class; the bias of each class; the temperature."""

    weights: dict[str, tuple[float, ...]]
    bias: tuple[float, ...]
    temperature: float
    cues: tuple[str, ...]  # words of which every weighted n-gram has one


def _training(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    spark = docs.sparkSession
    rows = []
    for family, texts in [*TEMPLATES.items(), (UNKNOWN, OTHERS)]:
        for text in texts:
            rows += [(family, text)] * 4
            parts = [p for p in text.replace(";", ".").replace(":", ".").split(". ") if len(p.split()) >= 5]
            rows += [(family, p) for p in parts]
    templates = spark.createDataFrame(rows, "family string, text string")
    pairs = spark.createDataFrame([(t,) for ts in (*TEMPLATES.values(), OTHERS) for t in ts], "text string").select(
        F.explode(grams_of(words_of(F.col("text")))).alias("gram")).where(F.col("gram").contains(" ")).distinct()
    lines = clash_free(docs, "text").select(F.explode(F.split("text", "\n")).alias("text")).where(
        F.length(F.trim("text")) > 0)
    sample = stored(hashed_values(lines, 4 * MAX_LINES), "license-lines")
    shared = sample.select("text", F.explode(grams_of(words_of(F.col("text")))).alias("gram")).join(
        F.broadcast(pairs), "gram").groupBy("text").agg(F.count("*").alias("n")).where("n >= 2").select("text")
    ordinary = stored(sample.join(shared, "text", "left_anti").orderBy(F.xxhash64("text"), "text").limit(MAX_LINES), "license-ordinary")
    return templates, ordinary


def fit(docs: DataFrame) -> Model:
    spark: SparkSession = docs.sparkSession
    templates, ordinary = _training(docs)
    gram_rows = grams_of(words_of(F.col("text")))
    total = ordinary.count()
    known = templates.select(F.explode(gram_rows).alias("gram")).distinct()
    often = ordinary.select(F.explode(gram_rows).alias("gram")).join(F.broadcast(known), "gram").groupBy("gram").agg(
        F.count("*").alias("n"))
    often = {r.gram: r.n for r in often.collect()}  # n-grams of the templates only
    rare = {r.gram for r in known.collect() if often.get(r.gram, 0) <= COMMON * total}
    vocabulary = sorted(g for g in rare if any(w in rare for w in g.split(" ")))  # "of this" says nothing
    # Each template also stands in front of ordinary lines, as where a notice does not end its line.
    few = ordinary.orderBy(F.xxhash64("text"), "text").limit(40)
    numbered_few = few.withColumn("k", F.pmod(F.xxhash64("text"), F.lit(8)))
    numbered = templates.withColumn("k", F.pmod(F.xxhash64("text", "family"), F.lit(8)))
    beside = numbered.join(F.broadcast(numbered_few.select("k", F.col("text").alias("more"))), "k").select(
        "family", F.concat_ws(" ", "text", "more").alias("text"))
    rows = templates.union(beside).union(ordinary.select(F.lit(NONE).alias("family"), "text"))
    labels = F.create_map(*[F.lit(x) for i, c in enumerate(CLASSES) for x in (c, float(i))])
    rows = stored(rows.select(F.element_at(labels, F.col("family")).alias("label"), gram_rows.alias("grams"),
                              F.pmod(F.xxhash64("text"), F.lit(5)).alias("fold")).coalesce(2), "license-training")  # a bounded sample
    if not vocabulary:
        return Model({}, tuple([1.0] + [0.0] * (len(CLASSES) - 1)), 1.0, ())
    vectors = CountVectorizerModel.from_vocabulary(vocabulary, inputCol="grams", outputCol="features", binary=True)
    featured = vectors.transform(rows)
    learner = LogisticRegression(family="multinomial", elasticNetParam=1.0, regParam=5e-4, maxIter=60, standardization=False)
    model = learner.fit(featured)
    matrix, bias = model.coefficientMatrix.toArray(), model.interceptVector.toArray()
    size = matrix.shape[0]
    weights = {g: tuple(matrix[:, i]) + (0.0,) * (len(CLASSES) - size) for i, g in enumerate(vocabulary) if abs(matrix[:, i]).max() > 1e-6}
    rarest = {g: min(g.split(" "), key=lambda w: (often.get(w, 0), w)) for g in weights}
    temperature = _temperature(model.transform(featured.where("fold = 0")))
    return Model(weights, tuple(bias) + (-30.0,) * (len(CLASSES) - size), temperature, tuple(sorted(set(rarest.values()))))


def _temperature(scored: DataFrame) -> float:
    """The temperature of least log loss on held-out rows, over a fixed grid, in one aggregate."""
    z = vector_to_array("rawPrediction")
    grid = [0.2, 0.35, 0.5, 0.75, 1.0, 1.5, 2.0, 3.0, 4.0]
    top = F.array_max(z)

    def loss(t: float) -> Column:
        total = F.aggregate(z, F.lit(0.0), lambda a, x: a + F.exp((x - top) / t))
        return F.avg((top - F.element_at(z, F.col("label").cast("int") + 1)) / t + F.log(total))

    losses = [loss(t).alias(f"t{i}") for i, t in enumerate(grid)]
    row = scored.agg(*losses).first()
    found = [(v, t) for v, t in zip(row, grid) if v is not None and not math.isnan(v)]
    return min(found)[1] if found else 1.0


def scan(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, paragraph, family, probability, template_share, confirmed``."""
    if not model.weights:
        return clash_free(docs, "doc_id").select(
            "doc_id", F.lit(None).cast("int").alias("paragraph"), F.lit(NONE).alias("family"), F.lit(None).cast("double").alias(
                "probability"), F.lit(None).cast("double").alias("template_share"), F.lit(False).alias("confirmed"))
    cues = F.array(*[F.lit(w) for w in model.cues])
    vocabulary = F.array(*[F.lit(g) for g in model.weights])
    table = F.create_map(*[x for g, w in model.weights.items() for x in (F.lit(g), F.array(*[F.lit(float(v)) for v in w]))])
    bias = F.array(*[F.lit(float(b)) for b in model.bias])
    names = F.array(*[F.lit(c) for c in CLASSES])
    alien = F.array(*[F.array(*[F.lit(g) for g in _alien(c)]).cast("array<string>") for c in CLASSES])

    def logits(grams: Column) -> Column:
        return let(F.array_intersect(grams, vocabulary), lambda hits: F.transform(bias, lambda b, c: (b + F.aggregate(
            hits, F.lit(0.0), lambda a, g: a + F.get(F.element_at(table, g), c))) / model.temperature))

    def possible(z: Column, grams: Column) -> Column:
        """The logits, null of a family whose sibling's tell the text holds."""
        return F.transform(z, lambda v, c: F.when(~F.arrays_overlap(F.get(alien, c), grams), v))

    def share(grams: Column, family: str, wrapped: bool) -> Column | None:
        """The greatest share of a template's n-grams; None if no template of the family counts."""
        templates = [_python_grams(t) for t in TEMPLATES[family] if not wrapped or len(t.split()) >= WRAPPED_WORDS]
        owned = [[g for g in t if not wrapped or " " in g] for t in templates]
        shares = [F.size(F.array_intersect(grams, F.array(*[F.lit(g) for g in own]))) / F.lit(len(own)) for own in owned]
        return (F.greatest(*shares) if len(shares) > 1 else shares[0]) if shares else None

    def against_none(z: Column) -> Column:
        """The other classes' probability mass over that of none."""
        return F.aggregate(F.slice(z, 2, len(CLASSES) - 1), F.lit(0.0), lambda a, v: a + F.coalesce(
            F.exp(v - F.get(z, F.lit(0))), F.lit(0.0)))

    def scored(x: Column) -> Column:
        return let(grams_of(words_of(x["text"])), lambda grams: F.struct(
            x["paragraph"].alias("paragraph"), x["first"].alias("first"), x["last"].alias("last"), grams.alias("grams"),
            logits(grams).alias("z")))

    def judged(y: Column, wrapped: bool) -> Column:
        """A scored unit as a finding."""
        def finding(guess: Column, probability: Column) -> Column:
            chosen = F.lit(None).cast("double")
            for family in TEMPLATES:
                part = share(y["grams"], family, wrapped)
                chosen = chosen if part is None else F.when(guess == family, part).otherwise(chosen)
            return let(chosen, lambda part: F.struct(
                y["paragraph"].alias("paragraph"), y["first"].alias("first"), y["last"].alias("last"), guess.alias("guess"),
                probability.alias("probability"), part.alias("template_share"), F.coalesce(
                    (probability >= CONFIDENT) & (part >= TEMPLATE_SHARE), F.lit(False)).alias("confirmed")))

        def choice(z: Column) -> Column:
            others = F.slice(z, 2, len(CLASSES) - 1)
            return let(F.array_max(others), lambda top: let(  # nulls are skipped
                F.get(names, F.array_position(others, top).cast("int")), lambda guess: let(
                    F.exp(top - F.get(z, F.lit(0))) / (1 + against_none(z)), lambda probability: finding(guess, probability))))

        return let(possible(y["z"], y["grams"]), choice)

    def found(units: Column, wrapped: bool) -> Column:
        licences = F.filter(F.transform(units, scored), lambda y: against_none(y["z"]) > 1)
        return F.transform(licences, lambda y: judged(y, wrapped))

    def cued(text: Column) -> Column:
        return F.arrays_overlap(words_of(text), cues)

    # Blocks hold the line feeds between their lines, so a running sum of these numbers the lines.
    none = F.array().cast("array<struct<paragraph:int,first:int,last:int,text:string>>")

    def with_block(known: Column, block: Column) -> Column:
        return let(F.split(block, "\n"), lambda own: let(known["line"] + F.size(own) - 1, lambda last: F.struct(
            last.alias("line"),
            F.when(cued(block) & (F.size(F.filter(own, lambda p: F.trim(p) != "")) > 1), F.concat(known["blocks"], F.array(F.struct(
                (known["line"] + F.array_position(F.transform(own, cued), True).cast("int") - 1).alias("paragraph"),
                known["line"].alias("first"), last.alias("last"), block.alias("text"))))).otherwise(known["blocks"]).alias("blocks"))))

    lines = F.filter(F.transform(F.split("text", "\n"), lambda p, i: F.struct(
        i.alias("paragraph"), i.alias("first"), i.alias("last"), p.alias("text"))), lambda x: cued(x["text"]))
    blocks = F.aggregate(F.split("text", r"(?<=\n)[ \t\r]*(?=\n)"), F.struct(F.lit(0).alias("line"), none.alias("blocks")), with_block)["blocks"]

    def covers(block: Column, line: Column) -> Column:
        return (block["first"] <= line["paragraph"]) & (line["paragraph"] <= block["last"])

    def together(by_line: Column) -> Column:
        """Findings of lines, or of the blocks of several lines that are confirmed though none of their lines is."""
        alone = F.filter(by_line, lambda x: x["confirmed"])
        whole = F.filter(found(blocks, True), lambda b: b["confirmed"] & ~F.exists(alone, lambda x: covers(b, x)))
        return let(whole, lambda wrapped: F.concat(wrapped, F.filter(
            by_line, lambda x: ~F.exists(wrapped, lambda b: covers(b, x)))))

    findings = F.when(cued(F.col("text")), let(found(lines, False), together))
    out = clash_free(docs, "doc_id", "text").select("doc_id", F.explode_outer(findings).alias("y")).select("doc_id", "y.*")
    confirmed = F.coalesce("confirmed", F.lit(False))
    family = F.when(F.col("paragraph").isNull(), F.lit(NONE)).when(confirmed, F.col("guess")).otherwise(F.lit(UNKNOWN))
    return out.select("doc_id", "paragraph", family.alias("family"), "probability", "template_share", confirmed.alias("confirmed"))


def _alien(name: str) -> list[str]:
    """The tells of a family's siblings that no template of the family holds."""
    own = {g for t in TEMPLATES.get(name, ()) for g in _python_grams(t)}
    return [g for group in TELLS if name in group for other, tells in group.items() if other != name for g in tells if g not in own]


def _python_grams(text: str) -> list[str]:
    """The n-grams of a template, as ``grams_of`` gives them."""
    words = [w for w in re.split(r"[\W_]+", text.lower()) if w]
    return list(dict.fromkeys([*words, *(" ".join(p) for p in zip(words, words[1:]))]))
