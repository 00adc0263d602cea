"""Licence scans by a trained paragraph classifier, in DataFrame functions only.

A line is a paragraph, together with the lines that it is continued on (see ``_WRAP``). Two nested logistic
regressions over words and word pairs (Spark's own, on the JVM) assign it a licence family or none. The first
tells notices from all else. It is trained on variants of public licence notices against every paragraph of the
corpus that it may be asked about and that resembles no notice; the words and pairs it weighs are those of the
notices and the ``MOST_GRAMS`` that most of all these paragraphs have. The second, multinomial, tells the families
apart by the words and pairs of the notices. A family's probability is the product of both. So the many words of
the corpus have one coefficient each, not one for each family, which the driver could not hold. A family is predicted only above a probability that all but a thousandth of the
paragraphs kept aside for calibration stay below, found for each family, and confirmed only if the paragraph
shares enough words with a notice of that family. A predicted paragraph that resembles some notice, but not
enough, is of the unknown class: licence text of no known family.

What is confirmed or unknown shares half of a notice's words at least, so a paragraph without any of the words
that this implies (``telling_words``) cannot be a result; it is neither learned from nor classified.
"""

from __future__ import annotations

import math
import re
from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel, NGram, SQLTransformer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from relweave.llm.exact_dedup import quoted
from relweave.session import materialise

MOST_GRAMS, SHARE_ASIDE, TASK_PARAGRAPHS = 1 << 15, 4, 25_000
LEAST_SHARED, LEAST_ALIKE = 0.6, 0.5
LEAST_PROBABILITY, MOST_PROBABILITY, ASIDE_QUANTILE = 0.5, 0.95, 0.999
NONE, UNKNOWN = "none", "unknown"

# Short notices of the licence families, as published.
NOTICES = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT license."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("MIT", "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License."),
    ("Apache-2.0", "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or any later version."),
    ("LGPL-3.0", "This library is licensed under the GNU Lesser General Public License, version 3."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related rights to this work. CC0 1.0 Universal."),
    ("AGPL-3.0", "This program is licensed under the GNU Affero General Public License, version 3."),
    ("EPL-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("proprietary", "All rights reserved."),
    ("proprietary", "All rights reserved. No part of this publication may be reproduced without the prior written permission of the publisher."),
)

# The machine-readable form names the family itself.
NOTICES += tuple((f, f"SPDX-License-Identifier: {f}") for f in sorted({f for f, _ in NOTICES} - {"proprietary"}))
# a line break before a line that goes on in lower case or with a bracket, or after a word that cannot end a line;
# looked for where white space with a line break begins, not at every character
_WRAP = (
    r"(?=[ \t\r\n])(?<!\s)(?=[ \t\r]*+\n)(?:(?<![.!?:;])[ \t\r]*+\n(?=[ \t]*+[a-z(])"
    r"|(?<=,| by| the| of| or| and| to| in| with| for| as)[ \t\r]*+\n(?=[ \t]*+\S))"
)
_WORD = r"[0-9]+(?:\.[0-9]+)*|[a-z]+"
_COMMON = frozenset("a all an and any as at be by for from in is it may no not of or that the this to under with you your".split())


def words_of(text: Column) -> Column:
    """Lower-case runs of ASCII letters and digits; numbers keep their dots, so that versions are one word."""
    return F.regexp_extract_all(F.lower(text), F.lit(_WORD), F.lit(0))


def notices(spark: SparkSession) -> DataFrame:
    """(family, words) of the notices."""
    rows = F.array(*[F.struct(F.lit(f).alias("family"), F.lit(t).alias("notice")) for f, t in NOTICES])
    return spark.range(1).select(F.inline(rows)).select("family", words_of(F.col("notice")).alias("words"))


def telling_words(least: float = LEAST_ALIKE) -> list[str]:
    """Words of which every text that shares ``least`` of some notice's distinct words has one.

    Of the n distinct words of a notice it has m = ceil(least * n), so one of any n - m + 1; the longest are taken.
    """
    telling: set[str] = set()
    for _, notice in NOTICES:
        words = set(re.findall(_WORD, notice.lower()))
        ranked = sorted(words, key=lambda w: (w in _COMMON or w[0].isdigit(), -len(w), w))
        telling |= set(ranked[: len(words) - math.ceil(least * len(words)) + 1])
    return sorted(telling)


def may_match(text: Column) -> Column:
    """Whether a telling word occurs, as a run of letters of its own; numbers anywhere."""
    telling = telling_words()
    numbers = [re.escape(w) for w in telling if w[0].isdigit()]
    tails: dict[str, list[str]] = {}
    for w in telling:
        if not w[0].isdigit():
            tails.setdefault(w[0], []).append(w[1:])
    words = "|".join(f"{first}(?:{'|'.join(rest)})" for first, rest in tails.items())
    return F.lower(text).rlike("|".join([*numbers, f"(?<![a-z])(?:{words})(?![a-z])"]))


def lines_of(docs: DataFrame, text: str, carry: Sequence[str]) -> DataFrame:
    """(row, place, line) of every paragraph, empty ones too."""
    joined = F.regexp_replace(quoted(text).cast("string"), _WRAP, " ")
    return docs.select(F.struct(*[quoted(c) for c in carry]).alias("row"), F.posexplode(F.split(joined, "\n")).alias("place", "line"))


def paragraphs(docs: DataFrame, text: str, carry: Sequence[str]) -> DataFrame:
    """(row, place, words) of every paragraph that can resemble a notice."""
    lines = lines_of(docs.where(may_match(quoted(text).cast("string"))), text, carry).where(may_match(F.col("line")))
    return lines.select("row", "place", words_of(F.col("line")).alias("words"))


def shared_words(words: Column, template: Column) -> Column:
    """Share of the template's distinct words that the paragraph has."""
    return F.size(F.array_intersect(words, template)) / F.size(F.array_distinct(template))


def best_match(words: Column, family: Column | None = None) -> Column:
    """Largest share over all notices, or over those of one family."""
    known = F.array(*[F.struct(F.lit(name).alias("family"), words_of(F.lit(notice)).alias("words")) for name, notice in NOTICES])
    if family is not None:
        known = F.filter(known, lambda n: n["family"] == family)
    return F.coalesce(F.array_max(F.transform(known, lambda n: shared_words(words, n["words"]))), F.lit(0.0))


def training_rows(spark: SparkSession, others: DataFrame) -> DataFrame:
    """(family, words): every notice, whole and without each one of its words, and the corpus paragraphs as none.

    A variant that is the notice of another family is left out.
    """
    whole = notices(spark)
    without = whole.select("family", "words", F.explode(F.sequence(F.lit(0), F.size("words"))).alias("gap"))
    variants = without.select("family", F.expr("filter(words, (w, i) -> i <> gap - 1)").alias("words"))
    other = whole.select(F.col("family").alias("other"), F.col("words").alias("whole"))
    variants = variants.join(F.broadcast(other), (F.col("words") == F.col("whole")) & (F.col("family") != F.col("other")), "left_anti")
    return variants.unionByName(others.select(F.lit(NONE).alias("family"), "words"))


def counterexamples(docs: DataFrame, text: str, order: str) -> DataFrame:
    """(draw, words) of all paragraphs that are looked at and resemble no notice, equal ones once; ``draw`` is their hash."""
    every = paragraphs(docs, text, [order]).select("words").distinct()
    return every.where(best_match(F.col("words")) < LEAST_ALIKE).select(F.xxhash64("words").alias("draw"), "words")


def gram_names(rows: DataFrame) -> list[str]:
    """All of ``gram_names_by_use`` together."""
    return sorted(sum(gram_names_by_use(rows), []))


def gram_names_by_use(rows: DataFrame) -> tuple[list[str], list[str]]:
    """The grams of two rows or more of (family, grams): all of the notices, and the ``MOST_GRAMS`` most frequent of the others."""
    counted = rows.select("family", F.explode(F.array_distinct("grams")).alias("gram")).groupBy("gram").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("family") != NONE).alias("n_notices")
    ).where("n > 1")
    frequent = counted.where("n_notices = 0").orderBy(F.desc("n"), "gram").limit(MOST_GRAMS)
    chosen = counted.where("n_notices > 0").union(frequent).select("gram", "n_notices").collect()
    return sorted(r.gram for r in chosen if r.n_notices), sorted(r.gram for r in chosen if not r.n_notices)


def fit(docs: DataFrame, text: str = "text", order: str = "doc_id") -> tuple[PipelineModel, list[str], dict[str, float]]:
    """The trained stages, the families by number, and the probability from which each is predicted.

    All ``counterexamples`` take part: a quarter of them by their hash is kept aside for the probabilities, the
    model learns from the others.
    """
    spark = docs.sparkSession
    chosen = materialise(counterexamples(docs, text, order), "license-paragraphs")
    families = [NONE, *sorted({f for f, _ in NOTICES})]
    number = F.array_position(F.array(*map(F.lit, families)), F.col("family")) - 1
    aside = F.pmod("draw", F.lit(SHARE_ASIDE)) == 0
    rows = training_rows(spark, chosen.where(~aside))
    # as few tasks as the rows allow, as each sends all coefficients in every iteration
    rows = materialise(rows.withColumn("label", number.cast("double")).coalesce(2 + chosen.count() // TASK_PARAGRAPHS), "license-rows")
    grams = [NGram(n=2, inputCol="words", outputCol="pairs"), SQLTransformer(statement="SELECT *, concat(words, pairs) AS grams FROM __THIS__")]
    own, others = gram_names_by_use(PipelineModel(grams).transform(rows))
    stages = [
        *grams,
        CountVectorizerModel.from_vocabulary(sorted(own + others), "grams", "counts").setBinary(True),
        CountVectorizerModel.from_vocabulary(own, "grams", "notice_counts").setBinary(True),
    ]
    rows = PipelineModel(stages).transform(rows)
    settings = {"regParam": 0.002, "elasticNetParam": 0.5, "maxIter": 60}
    noticed = LogisticRegression(featuresCol="counts", labelCol="noticed", predictionCol="is_notice", rawPredictionCol="notice_raw", probabilityCol="p_notice", **settings)
    learner = LogisticRegression(featuresCol="notice_counts", family="multinomial", **settings)
    fitted = [
        noticed.fit(rows.withColumn("noticed", (F.col("label") > 0).cast("double"))),
        learner.fit(rows.where("label > 0").withColumn("label", F.col("label") - 1)),
    ]
    model = PipelineModel([*stages, *fitted])
    scored = classify(chosen.where(aside).select("words"), model, families)
    reached = scored.groupBy("family").agg(F.percentile_approx("probability_of", ASIDE_QUANTILE).alias("p")).collect()
    least = dict.fromkeys(families[1:], LEAST_PROBABILITY)
    least |= {r.family: min(max(LEAST_PROBABILITY, r.p + 0.01), MOST_PROBABILITY) for r in reached}
    return model, families, least


def classify(rows: DataFrame, model: PipelineModel, families: list[str]) -> DataFrame:
    """``rows`` with ``family`` and ``probability_of``, of the likeliest licence family."""
    scored = model.transform(rows).withColumn("_p", vector_to_array("probability"))
    best = F.array_max("_p")
    name = F.element_at(F.array(*map(F.lit, families[1:])), F.array_position("_p", best).cast("int"))
    notice = F.element_at(vector_to_array("p_notice"), 2)
    return scored.select(*rows.columns, name.alias("family"), (best * notice).alias("probability_of"))


def scan(docs: DataFrame, text: str = "text", carry: Sequence[str] = ("doc_id",), order: str = "doc_id") -> DataFrame:
    """(row, place, family, probability_of, matched) of every paragraph found to be a licence notice.

    ``place`` is the number of the paragraph; ``family`` may be ``unknown``. NULL, empty and wordless texts have none; equal rows come out each.
    Input columns stay inside ``row`` and cannot clash.
    """
    model, families, least = fit(docs, text, order)
    boundary = F.create_map(*[F.lit(x) for pair in least.items() for x in pair])[F.col("family")]
    found = classify(paragraphs(docs, text, carry), model, families).where(F.col("probability_of") >= boundary)
    found = found.withColumns({"own": best_match(F.col("words"), F.col("family")), "any": best_match(F.col("words"))})
    confirmed = F.col("own") >= LEAST_SHARED
    family = F.when(confirmed, F.col("family")).otherwise(F.lit(UNKNOWN))
    matched = F.when(confirmed, F.col("own")).otherwise(F.col("any"))
    found = found.where(confirmed | (F.col("any") >= LEAST_ALIKE))
    return found.select("row", "place", family.alias("family"), "probability_of", matched.alias("matched"))


def query(spark, folder: str) -> DataFrame:
    """Every document with a licence notice, its families and how many paragraphs name one."""
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    found = scan(docs).groupBy("row.doc_id").agg(
        F.array_join(F.array_sort(F.collect_set("family")), ",").alias("families"),
        F.count(F.lit(1)).alias("n_notices"), F.min("place").alias("first_line"),
    )
    return docs.select("doc_id").join(found, "doc_id", "left").select(
        "doc_id", F.coalesce("families", F.lit("")).alias("families"), F.coalesce("n_notices", F.lit(0)).alias("n_notices"), "first_line"
    )
