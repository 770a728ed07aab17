"""Licence scans with built-in functions: n-gram logistic regression over windows of lines, confirmed by templates."""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import CountVectorizerModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import written

# Customary wordings of licence notices by family.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
                   "compliance with the License. You may obtain a copy of the License at"),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files (the \"Software\"), to deal in the Software without restriction"),
    ("MIT", "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE "
            "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("GPL", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
            "Public License as published by the Free Software Foundation, either version 3 of the License, or any later version."),
    ("GPL", "SPDX-License-Identifier: GPL-3.0-or-later"),
    ("LGPL", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
             "General Public License as published by the Free Software Foundation"),
    ("AGPL", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("BSD", "Released under the BSD 3-Clause License."),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
            "the following conditions are met"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY", "Licensed under CC BY 4.0."),
    ("CC-BY-SA", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-SA", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-NC", "Licensed under CC BY-NC 4.0."),
    ("CC0", "To the extent possible under law, the author has waived all copyright and related rights to this work under CC0 1.0 Universal."),
    ("Proprietary", "All rights reserved."),
    ("Proprietary", "Copyright (c) the authors. All rights reserved."),
    ("Proprietary", "No part of this publication may be reproduced or distributed without the prior written permission of the copyright holder."),
]
# Names of licences as short notices and badges give them.
NAMES = [
    ("Apache-2.0", "Apache License 2.0"), ("Apache-2.0", "Apache 2.0 license"), ("MIT", "MIT License"), ("MIT", "the MIT license"),
    ("GPL", "GNU GPL v3"), ("GPL", "GNU General Public License v2.0"), ("GPL", "the GPL, version 2 or later"),
    ("LGPL", "GNU LGPL v2.1"), ("LGPL", "GNU Lesser General Public License"), ("AGPL", "GNU AGPL v3"),
    ("AGPL", "GNU Affero General Public License"), ("BSD", "BSD 2-Clause License"), ("BSD", "the new BSD license"),
    ("MPL-2.0", "Mozilla Public License 2.0"), ("MPL-2.0", "MPL 2.0"), ("CC-BY", "CC BY 4.0"),
    ("CC-BY", "Creative Commons Attribution 4.0 International"), ("CC-BY-SA", "CC BY-SA 4.0"),
    ("CC-BY-SA", "Creative Commons Attribution-ShareAlike 4.0 International"), ("CC-BY-NC", "CC BY-NC 4.0"),
    ("CC-BY-NC", "Creative Commons Attribution-NonCommercial 4.0 International"), ("CC0", "CC0 1.0 Universal"),
]
# How short notices begin.
OPENINGS = ["", "Licensed under", "Released under", "Available under", "Distributed under", "Published under",
            "This work is licensed under", "This project is covered by"]
# Sentences with the words of licences that are none.
NO_LICENCES = [
    "She renewed her driving licence after the summer fair had closed.", "He asked for permission to leave the room early.",
    "The fishing license is valid for one season and costs ten dollars.", "Copyright law was debated in parliament for years.",
    "Students are permitted to use calculators during the exam.", "They released the new version of the film under pressure.",
    "The software is available in the shop on the corner.", "All rights and duties of the members are described in chapter two.",
    "The public library is free and open to the public.", "A general discussion of the work is published in the journal.",
    "The bar lost its liquor licence last spring.", "Creative people share common interests.",
]

UNKNOWN = "unknown"
OTHER = "other"
#: The overlap that confirms, and that from which a window of the corpus is no example of the class of no licence.
OVERLAP = 0.8
RESEMBLES = 0.5
#: Weight of the fixed sentences that are no licence, as a share of that of the corpus.
SENTENCES = 0.1
#: Words of a window, and from one window's start to the next; a shorter paragraph is one window.
WINDOW, STEP = 32, 24
#: Share of paragraphs that are no licence which may be believed to be one.
MISTAKES = 0.001


def words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}+]+"), lambda w: w != "")


def grams(tokens: Column) -> Column:
    """Single words and pairs of neighbours."""
    pairs = F.zip_with(tokens, F.slice(tokens, 2, F.greatest(F.size(tokens) - 1, F.lit(0))),
                       lambda a, b: F.when(b.isNotNull(), F.concat_ws(" ", a, b)))
    return F.concat(tokens, F.filter(pairs, lambda p: p.isNotNull()))


def paragraphs(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(doc_id, paragraph, text)`` of every non-blank line."""
    lines = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                        F.posexplode(F.split(F.col(text_col).cast("string"), "\n")).alias("paragraph", "text"))
    return lines.withColumn("text", F.trim("text")).where("text <> ''")


def windows(tokens: Column, length: int = WINDOW, step: int = STEP) -> Column:
    """Runs of ``length`` words, a new one every ``step`` words, so neighbours share what a short notice needs."""
    starts = F.sequence(F.lit(0), F.greatest(F.lit(0), F.size(tokens) - (length - step) - 1), F.lit(step))
    return F.transform(starts, lambda i: F.slice(tokens, i + 1, length))


def cut(lines: DataFrame) -> DataFrame:
    """``lines`` with a row for each window: ``part`` and ``tokens`` instead of ``text``.

    The words are a column of their own: within the lambda of ``windows`` the
    expression would be evaluated again for every window of a line.
    """
    split = lines.withColumn("line_words", words(F.col("text")))
    kept = [c for c in lines.columns if c != "text"]
    return split.select(*kept, F.posexplode(windows(F.col("line_words"))).alias("part", "tokens")).where("size(tokens) > 0")


def templates(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(TEMPLATES + NAMES, "family string, text string").withColumn("tokens", words(F.col("text")))


def pairs(tokens: Column) -> Column:
    return F.array_distinct(F.filter(grams(tokens), lambda g: g.contains(" ")))


def similarity(forms: Column, own: Column, pairs_in_all: Column) -> Column:
    """Share of common word pairs with the closest form: of the ``pairs_in_all`` of the window or of the form's, whichever is more."""
    common = lambda t: F.size(F.array_intersect(t, own))
    return F.coalesce(F.array_max(F.transform(forms, lambda t: F.greatest(
        common(t) / F.greatest(pairs_in_all, F.lit(3)), common(t) / F.greatest(F.size(t), F.lit(1))))), F.lit(0.0))


def notices(spark: SparkSession) -> DataFrame:
    """``(family, tokens)``: the templates' windows, their lines where they are wrapped, and each name behind each opening."""
    openings = spark.createDataFrame([(o,) for o in OPENINGS], "opening string")
    short = (spark.createDataFrame(NAMES, "family string, name string").join(F.broadcast(openings), F.lit(True))  # two fixed lists
             .select("family", words(F.concat_ws(" ", "opening", "name")).alias("tokens")))
    forms = templates(spark)
    lines = forms.where(F.size("tokens") > 16).select("family", F.explode(windows(F.col("tokens"), 14, 4)).alias("tokens"))  # wrapped
    return forms.select("family", F.explode(windows(F.col("tokens"))).alias("tokens")).union(lines).union(short)


def vocabulary(spark: SparkSession) -> list[str]:
    """The words and word pairs of the notices: some hundreds, from fixed lists."""
    return sorted(r.gram for r in notices(spark).select(F.explode(grams(F.col("tokens"))).alias("gram")).distinct().collect())


def known_windows(docs: DataFrame, vocabulary: list[str], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, paragraph, part, held, known, pairs_in_all)`` of every window of every line.

    ``known`` are the window's words and pairs that a notice may have, sorted,
    with repeats; null for a window without any such pair, which can be no
    licence. ``held`` is one half of the windows, equal ones together.
    """
    known_pairs = [g for g in vocabulary if " " in g]
    known_words = [g for g in vocabulary if " " not in g]
    first, second = (sorted({p.split(" ")[i] for p in known_pairs}) for i in (0, 1))
    tokens = F.col("tokens")
    both = F.zip_with(tokens, F.slice(tokens, 2, F.greatest(F.size(tokens) - 1, F.lit(0))),
                      lambda a, b: F.when(a.isin(first) & b.isin(second), F.concat_ws(" ", a, b)))
    found = (cut(paragraphs(docs, id_col, text_col)).withColumn("held", F.pmod(F.xxhash64("tokens", F.lit(1)), F.lit(2)) == 1)
             .withColumn("found", F.filter(both, lambda p: p.isin(known_pairs))))
    some = F.size("found") > 0
    return found.select("doc_id", "paragraph", "part", "held",
                        F.when(some, F.sort_array(F.concat(F.filter(tokens, lambda w: w.isin(known_words)), "found"))).alias("known"),
                        F.when(some, F.size(pairs(tokens))).alias("pairs_in_all"))


def no_licences(rows: DataFrame) -> DataFrame:
    """``(held, known, n)``: all windows of the corpus that resemble no form, counted by what they hold of the vocabulary.

    Those that hold no pair are counted together, with ``known`` null.
    """
    forms = templates(rows.sparkSession).agg(F.collect_list(pairs(F.col("tokens"))).alias("forms"))
    counted = rows.groupBy("held", "known", "pairs_in_all").agg(F.count("*").alias("n")).join(F.broadcast(forms), F.lit(True))  # one row
    alike = F.when(F.col("known").isNull(), 0.0).otherwise(similarity(F.col("forms"), F.col("known"), F.col("pairs_in_all")))
    return counted.where(alike < RESEMBLES).groupBy("held", "known").agg(F.sum("n").alias("n"))


class Classifier:
    """Multinomial logistic regression on word n-grams, and the probability from which a family is believed."""

    def __init__(self, counts: CountVectorizerModel, model: LogisticRegressionModel, families: list[str], least: float):
        self.counts, self.model, self.families, self.least = counts, model, families, least

    def predict(self, texts: DataFrame) -> DataFrame:
        """``texts(known, ...)`` that are likelier a licence than none, with ``likeliest``, ``family`` and ``probability``.

        The family is the likeliest one; below the calibrated limit it is unknown.
        """
        scored = self.model.transform(self.counts.transform(texts)).where("prediction <> 0")  # class 0 is OTHER
        named = F.element_at(F.array(*map(F.lit, self.families)), F.col("prediction").cast("int") + 1)
        p = F.array_max(vector_to_array("probability"))
        return (scored.withColumn("likeliest", named).withColumn("probability", p)
                .withColumn("family", F.when(F.col("probability") >= self.least, F.col("likeliest")).otherwise(F.lit(UNKNOWN)))
                .drop("features", "rawPrediction", "prediction"))


def train(rows: DataFrame, vocabulary: list[str]) -> Classifier:
    """A classifier from the notices, their parts, notices among other words, and all windows of the corpus.

    ``rows`` are the corpus's ``known_windows``, of which those count that
    share a word pair with a notice; the others are no licence anyway. A
    family's examples are its notices, what is left of them when words are
    missing at either end, and both among the words of ordinary sentences. The
    class of no licence is learned from one half of the corpus windows that
    resemble no form, and from sentences that use the words of licences; it
    weighs as much as all others, however large the corpus. The limit of
    belief comes from the other half: at most MISTAKES of all its windows reach it.
    """
    spark = rows.sparkSession
    size = F.size("tokens")
    whole = notices(spark)
    cuts = F.explode(F.array(*[F.struct(F.lit(a).alias("a"), F.lit(z).alias("z")) for a in range(4) for z in range(4)])).alias("cut")
    parts = (whole.select("family", "tokens", cuts)
             .where((F.col("cut.a") + F.col("cut.z") == 0)
                    | (size - F.col("cut.a") - F.col("cut.z") >= F.greatest(F.lit(5), F.floor(size * 0.7))))
             .select("family", F.slice("tokens", F.col("cut.a") + 1, size - F.col("cut.a") - F.col("cut.z")).alias("tokens")))
    sentences = spark.createDataFrame([(t,) for t in NO_LICENCES], "text string").select(words(F.col("text")).alias("w"))
    # each notice once alone and once among the words of each sentence
    among = (whole.join(F.broadcast(sentences), F.lit(True))  # a fixed list
             .select("family", F.slice(F.concat(F.slice("w", 1, 8), "tokens", F.slice("w", 9, 24)), 1, WINDOW).alias("tokens")))
    examples = parts.union(among).select("family", grams(F.col("tokens")).alias("known"), F.lit(1.0).alias("weight"))
    corpus = written(no_licences(rows), "license-corpus")
    licences = examples.count()
    learned = corpus.where("NOT held AND known IS NOT NULL")
    windows_learned = learned.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    shares = (1 / (1 + SENTENCES), SENTENCES / (1 + SENTENCES)) if windows_learned else (0.0, 1.0)
    none = (learned.select(F.lit(OTHER).alias("family"), "known", (F.col("n") * (licences * shares[0] / max(windows_learned, 1))).alias("weight"))
            .union(sentences.select(F.lit(OTHER), grams(F.col("w")), F.lit(licences * shares[1] / len(NO_LICENCES)))))
    families = [OTHER, *sorted({f for f, _ in TEMPLATES})]
    label = F.array_position(F.array(*map(F.lit, families)), F.col("family")) - 1
    counts = CountVectorizerModel.from_vocabulary(vocabulary, "known", "features")
    weighed = counts.transform(examples.union(none).withColumn("label", label.cast("double"))).select("features", "label", "weight")
    model = LogisticRegression(family="multinomial", regParam=1e-3, elasticNetParam=0.5, maxIter=60, weightCol="weight").fit(weighed)
    held = corpus.where("held").select(F.coalesce("known", F.array().cast("array<string>")).alias("known"), "n", F.col("known").isNull().alias("bare"))
    p = F.array_max(F.slice(vector_to_array("probability"), 2, len(families) - 1))
    # by steps of a ten-thousandth: the percentile keeps what is distinct
    steps = (model.transform(counts.transform(held)).select(F.when(F.col("bare"), 0.0).otherwise(F.ceil(p * 10_000) / 10_000).alias("p"), "n")
             .groupBy("p").agg(F.sum("n").alias("n")))
    wrong = steps.agg(F.percentile("p", F.lit(1 - MISTAKES), F.col("n"))).first()[0]
    return Classifier(counts, model, families, max(0.5, wrong or 0.0))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, paragraph, part, family, probability, similarity, confirmed)`` of every window of a paragraph that is likelier a licence than none.

    Paragraphs are lines, numbered from 0; every line of every text is
    classified, a long one by overlapping windows of WINDOW words (``part``
    numbers them), each with a row of its own. ``similarity`` is the share of word pairs
    in common with the family's closest template or name (of the window's
    pairs, or of the template's, whichever is more); ``confirmed`` from OVERLAP
    on. A hard-wrapped notice shows in each line that is telling by itself.
    ``unknown`` windows are likelier a licence than none, but below the limit;
    their similarity is that with the likeliest family. A window that shares no
    word pair with any form of its likeliest family is no licence. Null and empty texts have none; ids may be null or repeat
    (each row gives its own lines); an empty table gives an empty result.
    The texts are read once, into a table of what each window holds of the
    notices' words and pairs; the class of no licence and the limit are
    learned from all of it.
    """
    spark = docs.sparkSession
    grams_known = vocabulary(spark)
    rows = written(known_windows(docs, grams_known, id_col, text_col), "license-windows")
    named = train(rows, grams_known).predict(rows.where("known IS NOT NULL"))
    forms = templates(spark).select(F.col("family").alias("likeliest"), pairs(F.col("tokens")).alias("pairs")).groupBy(
        "likeliest").agg(F.collect_list("pairs").alias("forms"))
    judged = (named.join(F.broadcast(forms), "likeliest")
              .withColumn("similarity", similarity(F.col("forms"), F.col("known"), F.col("pairs_in_all"))).where("similarity > 0"))
    return judged.select("doc_id", "paragraph", "part", "family", "probability", "similarity",
                         ((F.col("similarity") >= OVERLAP) & (F.col("family") != UNKNOWN)).alias("confirmed"))
