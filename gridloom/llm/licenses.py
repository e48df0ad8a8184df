"""Licence notices in documents: a trained paragraph classifier, confirmed by templates.

A text is cut at blank lines into paragraphs, whose wrapped lines are joined; a paragraph is judged by its
sentences, and what is longer than ``RUN`` words by runs of that many, each half over the one before.
Features are the word n-grams of known notices. A multinomial logistic regression over them is fitted on
these notices, alone and inside other text, on notices of licences that are not told apart (class
``unknown``), and on sentences of a bounded sample of documents, those that agree with a notice left out.
The probability from which a run counts as a notice is set on rows that the fit did not see. A family is
given where a template of it agrees; all other notices are ``unknown``.

Texts without any notice are passed over by a test that follows from the fitted weights
(``LicenseModel.anchors``): words are put on a list, heavy and rare ones first, until a run without any of
them cannot reach that probability whatever else it holds. So the test loses nothing that the model finds.
All of this runs in Spark's own expressions.

Nulls and edge cases: null and empty texts have no sentences; a row without an id is reported with a
null id; rows that repeat are reported each, and so is a notice in two runs that overlap; an empty table
gives an empty result. Only the named columns are read, so others may have any name.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from gridloom.llm.common import cut_lineage, shuffle_partitions

# Usual wording of notices of public licences, by family.
NOTICES = {
    "MIT": [
        "MIT License",
        "Released under the MIT License.",
        "Licensed under the MIT license.",
        "This project is licensed under the terms of the MIT license.",
        "SPDX-License-Identifier: MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        "software and associated documentation files",
    ],
    "Apache-2.0": [
        "Apache 2.0",
        "Licensed under the Apache License, Version 2.0.",
        "Released under the Apache 2.0 license.",
        "SPDX-License-Identifier: Apache-2.0",
        "You may not use this file except in compliance with the Apache License",
    ],
    "GPL-3.0": [
        "Released under GPL v3.",
        "This work is licensed under the GNU General Public License, version 3.",
        "Released under the GNU GPL license v3.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
        "You can redistribute it and/or modify it under the terms of the GNU General Public License "
        "as published by the Free Software Foundation",
    ],
    "LGPL": [
        "Licensed under the GNU Lesser General Public License, version 2.1.",
        "Released under the GNU LGPL license.",
    ],
    "BSD": [
        "BSD-3-Clause",
        "Released under the BSD 3-Clause License.",
        "Licensed under the BSD license.",
        "SPDX-License-Identifier: BSD-2-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted",
    ],
    "MPL-2.0": [
        "Licensed under the Mozilla Public License, version 2.0.",
        "This Source Code Form is subject to the terms of the Mozilla Public License",
    ],
    "CC-BY-SA-4.0": [
        "Available under CC-BY-SA 4.0.",
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ],
    "CC0": ["CC0", "Released under CC0 1.0 Universal."],
    "CC-BY-NC-4.0": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 "
        "International License.",
    ],
    "CC-BY-4.0": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ],
    "proprietary": ["All rights reserved.", "Copyright, all rights reserved."],
}
# Notices of licences that are not told apart, and the same words used otherwise.
UNLISTED = [
    "Released under the license.",
    "Licensed under the terms of the license.",
    "Distributed under its own license.",
    "Released under the ISC license.",
    "Licensed under the Artistic License 2.0.",
    "Licensed under the Eclipse Public License 2.0.",
    "Released under the Unlicense.",
    "Distributed under the Boost Software License, Version 1.0.",
    "Licensed under the zlib license.",
    "Licensed under the European Union Public Licence.",
    "SPDX-License-Identifier: ISC",
    "This software is dual licensed.",
    "Use of this source code is governed by a license that can be found in the LICENSE file.",
    "Permission to use, copy, modify and distribute this software for any purpose with or without fee "
    "is hereby granted",
    'Provided "as is", without warranty of any kind.',
]
OTHERWISE = [
    "His driving license was renewed in spring.",
    "The poet took license with the facts.",
    "They asked permission to leave the room.",
    "The rights were reserved for later talks about the land.",
    "A license fee is paid by every household.",
    "The restaurant lost its license to sell wine.",
    "Without permission nobody may enter.",
    "The warrant was issued by the court.",
    "Goods are redistributed among the shops.",
    "The law of copyright is older than the press.",
]
NONE, UNKNOWN = "none", "unknown"
FEATURES = 1 << 14
#: Documents of the corpus whose sentences training sees, and sentences of these, at most.
SAMPLE_DOCS, SAMPLE = 1000, 4000
#: Part of a template's words, weighted by how few families use them, that a confirmed notice has.
AGREES = 0.8
#: Part from which a sentence of the sample is left out, as it may be a notice.
RESEMBLES = 0.5
#: Words of a run.
RUN = 96
#: What is added to a word's frequency where anchors are chosen: words as rare as that count alike.
RARE = 0.001
_WORD = "[^a-z0-9.+-]+"


def words_of(sentence: Column) -> Column:
    found = F.split(F.lower(sentence), _WORD)
    bare = F.transform(found, lambda w: F.regexp_replace(w, "^[.-]+|[.-]+$", ""))
    return F.filter(bare, lambda w: w != "")


def _plain(text: str) -> list[str]:
    """The words of a text, as ``words_of`` finds them."""
    found = (w.strip(".-") for w in re.split(_WORD, text.lower()))
    return [w for w in found if w]


def _grams(words: list[str]) -> list[str]:
    return [" ".join(words[i : i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)]


#: N-grams of one to three words of the notices: the features.
VOCABULARY = sorted({g for t in [*sum(NOTICES.values(), []), *UNLISTED] for g in _grams(_plain(t))})


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)``; an expression that lambdas mention is worked out once a row, not per element."""
    return F.element_at(F.transform(F.array(value), use), 1)


def grams_of(words: Column) -> Column:
    """The distinct n-grams of one to three words that notices have."""

    def found(words: Column) -> Column:
        size = F.size(words)

        def of(n: int) -> Column:
            places = F.when(size >= n, F.sequence(F.lit(1), size - n + 1)).otherwise(F.array())
            return F.transform(
                places.cast("array<int>"), lambda i: F.array_join(F.slice(words, i, F.lit(n)), " ")
            )

        return F.array_intersect(F.concat(of(1), of(2), of(3)), F.lit(VOCABULARY))

    return _once(words, found)


def sentences(df: DataFrame, id_col: str, text_col: str, passed: Callable[[Column], Column]) -> DataFrame:
    """id, paragraph, sentence (numbers in the text and in the paragraph), start (word in the sentence)
    and text of the runs that ``passed`` lets through; it lets a text through if it does so with a part."""
    docs = df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    blocks = F.posexplode(F.split("text", "\\n[\\x20\\t\\r]*\\n")).alias("paragraph", "text")
    blocks = docs.where(passed(F.col("text"))).select("id", blocks)
    joined = F.regexp_replace("text", "[\\x20\\x09-\\x0D]+", " ")
    each = F.posexplode(F.split(joined, "(?<=[.!?])\\x20")).alias("sentence", "text")
    each = blocks.select("id", "paragraph", each).where(passed(F.col("text")))

    def runs(words: Column) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.size(words) - RUN // 2, F.lit(1)), F.lit(RUN // 2))
        return F.transform(
            starts,
            lambda i: F.struct(
                (i - 1).alias("start"), F.array_join(F.slice(words, i, F.lit(RUN)), " ").alias("text")
            ),
        )

    cut = F.inline(_once(F.split("text", " "), runs))
    return each.select("id", "paragraph", "sentence", cut).where(passed(F.col("text")))


def _weights() -> dict[str, float]:
    """Words of the templates by how few families use them."""
    families = [*NOTICES.values(), UNLISTED]
    used = [{w for t in family for w in _plain(t)} for family in families]
    return {w: math.log1p(len(used) / sum(w in u for u in used)) for w in set().union(*used)}


def _nameless() -> list[str]:
    """The notices that speak of a licence, with a word unknown to the model in place of those that only
    one family uses: what notices of a licence never heard of look like."""
    weights = _weights()
    most = max(weights.values())
    texts = [_plain(t) for t in [*sum(NOTICES.values(), []), *UNLISTED]]
    told = [[w if weights[w] < most else "xx" for w in words] for words in texts]
    good = [ws for ws in told if "xx" in ws and any(w.startswith("licen") for w in ws)]
    return sorted({" ".join(ws) for ws in good if sum(w != "xx" for w in ws) > 2})


def _agreement(words: Column, templates: Column) -> Column:
    """The largest part of a template that ``words`` hold, by weight."""

    def share(template: Column) -> Column:
        held = F.filter(template, lambda w: F.array_contains(words, w["word"]))
        weigh = lambda ws: F.aggregate(ws, F.lit(0.0), lambda total, w: total + w["weight"])
        return weigh(held) / weigh(template)

    return F.array_max(F.transform(templates, share))


def _templates(spark: SparkSession) -> DataFrame:
    """family, templates (their words with weights): one row per family, a short fixed list."""
    weights = _weights()
    told = [*NOTICES.items(), (UNKNOWN, UNLISTED)]
    rows = [(f, [[(w, weights[w]) for w in dict.fromkeys(_plain(t))] for t in ts]) for f, ts in told]
    kind = "array<array<struct<word:string,weight:double>>>"
    return spark.createDataFrame(rows, f"family string, templates {kind}")


def _sample(df: DataFrame, text_col: str) -> DataFrame:
    """Sentences of about ``SAMPLE_DOCS`` documents, by hash and so the same on every run, that do not
    look like a notice."""
    texts = df.select(F.lit(0).alias("id"), F.col(f"`{text_col}`").alias("text")).where("text <> ''")
    steps = 1 << 30
    part = math.ceil(steps * min(1.0, SAMPLE_DOCS / max(1, texts.count())))
    # By content, so that copies come all or not at all; they count once.
    some = texts.where(F.pmod(F.xxhash64("text"), F.lit(steps)) < part).dropDuplicates(["text"])
    some = some.orderBy(F.xxhash64("text"), "text").limit(SAMPLE_DOCS)
    lines = sentences(some, "id", "text", lambda text: F.length(text) > 0).select("text").distinct()
    lines = cut_lineage(lines.orderBy(F.xxhash64("text"), "text").limit(SAMPLE), "lines")
    # One file of few rows, but each is dear: over all tasks.
    lines = lines.repartition(shuffle_partitions(df.sparkSession), "text")
    every = _templates(df.sparkSession).select(F.explode("templates").alias("template"))
    every = every.groupBy(F.lit(0).alias("id")).agg(F.collect_list("template").alias("templates"))
    # One row, the same for all.
    near = lines.withColumn("id", F.lit(0)).join(F.broadcast(every), "id")
    words = words_of(F.col("text"))
    far = near.where(_once(words, lambda w: _agreement(w, F.col("templates"))) < RESEMBLES)
    return cut_lineage(far.select("text"), "sample")


def _training(spark: SparkSession, df: DataFrame, text_col: str) -> DataFrame:
    """label, text, held_out: notices alone and inside sentences of the corpus, and other text."""
    known = [(float(n), t) for n, ts in enumerate([[], *NOTICES.values(), UNLISTED]) for t in ts]
    known += [(float(len(NOTICES) + 1), t) for t in _nameless()]
    known += [(0.0, t) for t in OTHERWISE]
    count = len(known)
    known = spark.createDataFrame(known, "label double, text string")
    sample = _sample(df, text_col)
    left_out = F.pmod(F.xxhash64("text"), F.lit(4)) == 0
    # Each notice meets eight sentences, two of them in the part that is left out of the fit.
    number = F.pmod(F.xxhash64("text"), F.lit(count * 8))
    some = sample.groupBy(number.alias("n")).agg(F.min("text").alias("other"))
    # Over the notices only: a fixed, short list.
    place = (F.row_number().over(W.orderBy("label", "text")) - 1).cast("long")
    around = known.withColumn("at", place).join(F.broadcast(some.withColumn("at", F.col("n") % count)), "at")
    inside = around.select("label", F.concat_ws(" ", "other", "text", "other").alias("text"))
    met = inside.unionByName(sample.select(F.lit(0.0).alias("label"), "text"))
    alone = known.withColumn("held_out", F.lit(False))
    return alone.unionByName(met.withColumn("held_out", left_out))


def _pattern(words: list[str]) -> str:
    """A regular expression of the words that tries common beginnings once."""
    ends = "" in words
    heads = sorted({w[0] for w in words if w})
    if not heads:
        return ""
    rest = [re.escape(h) + _pattern([w[1:] for w in words if w[:1] == h]) for h in heads]
    return f"(?:{'|'.join(rest)})" + ("?" if ends else "")


def _frequency(rows: DataFrame, text_col: str) -> dict[str, float]:
    """The part of the texts that holds each word of the notices; words that none holds are left out."""
    held = F.array_intersect(words_of(F.col(text_col)), F.lit(sorted({w for g in VOCABULARY for w in g.split()})))
    counted = rows.select(F.explode(held).alias("word")).groupBy("word").count()
    total = rows.count()
    # Not more rows than the notices have words.
    return {r["word"]: r["count"] / total for r in counted.collect()}


class LicenseModel:
    """The fitted classifier with the probability from which a run counts as a notice."""

    def __init__(self, spark: SparkSession, df: DataFrame, text_col: str = "text"):
        self.tf = HashingTF(inputCol="grams", outputCol="features", numFeatures=FEATURES, binary=True)
        rows = _training(spark, df, text_col).repartition(shuffle_partitions(spark), "text")
        rows = cut_lineage(rows, "training")
        fit = LogisticRegression(regParam=0.001, maxIter=40, family="multinomial")
        self.model = fit.fit(self._features(rows.where("NOT held_out")))
        self.model.setProbabilityCol("all").setPredictionCol("top").setRawPredictionCol("raw")
        # Between what notices and other sentences got that were not fitted; never below an even chance.
        judged = self._scored(rows.where("held_out")).groupBy(F.col("label") > 0).agg(
            F.percentile("probability", 0.999).alias("high"), F.percentile("probability", 0.05).alias("low")
        )
        seen = {r[0]: r for r in judged.collect()}
        high = seen[False].high if False in seen else 0.5
        low = seen[True].low if True in seen else 0.5
        self.believed = max(0.5, min(0.95, (high + low) / 2))
        self.anchors = self._anchors(_frequency(rows.where("label = 0"), "text"))

    def _features(self, rows: DataFrame) -> DataFrame:
        return self.tf.transform(rows.withColumn("grams", grams_of(words_of(F.col("text")))))

    def _scored(self, rows: DataFrame, least: float = 0.0) -> DataFrame:
        """``rows`` with the probability of a notice, where that is ``least`` or more, and the most likely
        family's number, from 1."""
        scored = self.model.transform(self._features(rows))

        def top(chances: Column) -> Column:
            families = F.slice(chances, 2, len(NOTICES) + 1)
            best = F.array_position(families, F.array_max(families)).cast("int").alias("best")
            return F.struct((1 - F.element_at(chances, 1)).alias("probability"), best)

        # A generator, below which no filter is pushed: each run is scored once.
        likely = F.filter(
            F.transform(F.array(vector_to_array("all")), top), lambda s: s["probability"] >= least
        )
        return scored.select(*rows.columns, F.inline(likely))

    def _anchors(self, frequency: dict[str, float]) -> list[str]:
        """Words without any of which no run reaches ``believed``.

        A family's odds against no notice are at most those of its intercept and of all its positive
        weights; words are taken until the n-grams without them leave too little: those that take most
        for the part of other texts that holds them. Then those go that are not needed, common ones first.
        """
        weights, start = self.model.coefficientMatrix.toArray(), self.model.interceptVector.toArray()
        gain = {}
        for gram in VOCABULARY:
            place = self.tf.indexOf(gram)
            gain[gram] = [max(0.0, w[place] - weights[0][place]) for w in weights[1:]]
        gain = {g: gs for g, gs in gain.items() if any(gs)}
        found: list[str] = []

        def without(words: list[str]) -> dict[str, list[float]]:
            return {g: gs for g, gs in gain.items() if not any(w in words for w in g.split())}

        def reached(left: dict[str, list[float]]) -> bool:
            reach = (sum(gs[k] for gs in left.values()) + start[k + 1] - start[0] for k in range(len(weights) - 1))
            return sum(math.exp(r) for r in reach) >= self.believed / (1 - self.believed)

        left = gain
        while left and reached(left):
            heavy: dict[str, float] = {}
            for gram, gs in left.items():
                for word in set(gram.split()):
                    heavy[word] = heavy.get(word, 0.0) + max(gs)
            found.append(max(sorted(heavy), key=lambda w: heavy[w] / (frequency.get(w, 0.0) + RARE)))
            left = without(found)
        if reached(left):
            raise ValueError("the training rows tell notices and other text too little apart")
        for word in sorted(found, key=lambda w: (-frequency.get(w, 0.0), w)):
            rest = [w for w in found if w != word]
            if not reached(without(rest)):
                found = rest
        return found

    def passed(self, text: Column) -> Column:
        """Whether the text holds an anchor; parts between points and hyphens count too, which only lets
        more through."""
        return F.rlike(F.lower(text), F.lit(f"(?<![a-z0-9+]){_pattern(self.anchors)}(?![a-z0-9+])"))

    def classify(self, rows: DataFrame) -> DataFrame:
        """``rows`` that are notices, with family, probability and agreement."""
        likely = self._scored(rows, self.believed)
        numbers = {f: n for n, f in enumerate([*NOTICES, UNKNOWN], 1)}
        number = F.create_map(*[F.lit(x) for pair in numbers.items() for x in pair])
        every = _templates(rows.sparkSession).withColumn("best", number[F.col("family")])
        # A fixed, short list.
        joined = likely.join(F.broadcast(every), "best")
        agreement = _once(words_of(F.col("text")), lambda words: _agreement(words, F.col("templates")))
        joined = joined.withColumn("agreement", agreement)
        family = F.when(F.col("agreement") >= AGREES, F.col("family")).otherwise(UNKNOWN)
        return joined.select(*rows.columns, family.alias("family"), "probability", "agreement")


def scan_licenses(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per run that is a notice: id, paragraph, sentence, start, family, probability, agreement
    and text."""
    model = LicenseModel(df.sparkSession, df, text_col)
    found = model.classify(sentences(df, id_col, text_col, model.passed))
    return found.select(
        F.col("id").alias(id_col), "paragraph", "sentence", "start", "family", "probability", "agreement", "text"
    )
