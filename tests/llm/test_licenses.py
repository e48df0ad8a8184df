"""Licence notices: wrapped headers, short forms, unlisted licences, and texts without any."""

import random
import re

import pytest
from pyspark.sql import functions as F

from gridloom.llm.licenses import UNKNOWN, LicenseModel, _pattern, scan_licenses, sentences

WRAPPED = {
    "MIT": 'Permission is hereby granted, free of charge, to any person obtaining a copy\nof this software and '
    'associated documentation files (the "Software"), to deal\nin the Software without restriction.',
    "BSD": "Redistribution and use in source and binary forms, with or without\nmodification, are permitted "
    "provided that the following conditions\nare met:",
    "GPL-3.0": "This program is free software: you can redistribute it and/or modify\nit under the terms of the "
    "GNU General Public License as published by\nthe Free Software Foundation, either version 3 of the License.",
    "Apache-2.0": 'Licensed under the Apache License, Version 2.0 (the "License");\nyou may not use this file '
    "except in compliance with the License.",
}
SHORT = {
    "Released under the MIT License.": "MIT",
    "Available under CC-BY-SA 4.0": "CC-BY-SA-4.0",
    "CC0": "CC0",
    "Released under GPL v3": "GPL-3.0",
    "SPDX-License-Identifier: MIT": "MIT",
    "BSD-3-Clause": "BSD",
    "Apache 2.0": "Apache-2.0",
    "All rights reserved.": "proprietary",
    'Provided "as is", without warranty.': UNKNOWN,
    "Licensed under the ISC license.": UNKNOWN,
    "Licensed under the Artistic License 2.0.": UNKNOWN,
    "Released under the Frobnicate license.": UNKNOWN,
}
CLEAN = [
    "The dog runs over the hill and the river is cold.",
    "His driving license was renewed in spring by the office.",
    "She asked for permission to read the file before the talk.",
    "Version 2.0 of the plan is free for all people in the town.",
]


@pytest.fixture(scope="module")
def found(spark):
    dice = random.Random(5)
    words = "river stone the of and to house is a in city for with walks this under work you can any".split()
    plain = [" ".join(dice.choices(words, k=12)).capitalize() + "." for _ in range(400)]
    texts = [f"{a}\n{b}" for a, b in zip(plain[::2], plain[1::2])]
    rows = [(n, t) for n, t in enumerate(texts)]
    rows += [(1000 + n, f"{texts[n]}\n\n{t}\n\n{texts[n + 50]}") for n, t in enumerate(WRAPPED.values())]
    rows += [(2000 + n, t) for n, t in enumerate(SHORT)]
    rows += [(3000 + n, t) for n, t in enumerate(CLEAN)]
    rows += [(4000, " ".join(words * 3000) + " released under the mit license " + " ".join(words * 3000))]
    rows += [(None, "Released under the MIT License."), (5000, None), (5001, ""), (5002, " \n\n \n")]
    rows += [(6000, "Released under the MIT License.")] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    docs = docs.withColumns({n: F.lit(1) for n in ("family", "probability", "sentence", "id", "best", "start")})
    return [tuple(r) for r in scan_licenses(docs).select("doc_id", "family", "text").collect()], docs


def families(found, doc_id):
    return {f for i, f, _ in found[0] if i == doc_id}


def test_wrapped_headers_are_joined(found):
    assert [families(found, 1000 + n) for n in range(len(WRAPPED))] == [{f} for f in WRAPPED]


def test_short_forms_and_unlisted_licences(found):
    assert {t: families(found, 2000 + n) for n, t in enumerate(SHORT)} == {t: {f} for t, f in SHORT.items()}


def test_other_texts_are_left_alone(found):
    assert not [r for r in found[0] if r[0] is not None and (r[0] < 1000 or 3000 <= r[0] < 4000 or r[0] in (5000, 5001, 5002))]


def test_null_ids_repeated_rows_and_very_long_sentences(found):
    assert families(found, None) == {"MIT"} and families(found, 4000) == {"MIT"}
    assert len([r for r in found[0] if r[0] == 6000]) == 2


def test_the_word_test_loses_no_notice(spark, found):
    """Brute force: every run of every text scored by the model."""
    docs = found[1]
    model = LicenseModel(spark, docs)
    every = model.classify(sentences(docs, "doc_id", "text", lambda text: F.length(text) > 0))
    passed = model.classify(sentences(docs, "doc_id", "text", model.passed))
    key = ["id", "paragraph", "sentence", "start", "family"]
    assert sorted(map(str, every.select(key).collect())) == sorted(map(str, passed.select(key).collect()))


def test_texts_of_common_words_are_passed_over(spark):
    """Words that most texts hold are no anchors, though notices hold them as well."""
    dice = random.Random(8)
    words = "the of is this and under a any use with can house river stone city walks work you in to".split()
    texts = [(n, " ".join(dice.choices(words, k=9)).capitalize() + ".") for n in range(600)]
    notices = [(1000, "Released under the MIT License."), (1001, "CC0"), (1002, "Rights? All rights reserved...")]
    docs = spark.createDataFrame(texts + notices, "doc_id long, text string")
    model = LicenseModel(spark, docs)
    passed = [r.doc_id for r in docs.where(model.passed(F.col("text"))).select("doc_id").collect()]
    assert sorted(i for i in passed if i >= 1000) == [1000, 1001, 1002]
    assert len(passed) < 300


def test_the_pattern_finds_whole_words_alone():
    words = ["a", "any", "by", "by-sa", "4.0"]
    found = re.compile(f"(?<![a-z0-9+]){_pattern(words)}(?![a-z0-9+])")
    assert all(found.search(f"x {w}. y") for w in words)
    assert not any(found.search(t) for t in ["an", "anya", "bys", "4x0", "+a", "ba", ""])


def test_an_empty_table(spark):
    assert scan_licenses(spark.createDataFrame([], "doc_id long, text string")).count() == 0
