"""The quality rules against counts and cutoffs worked out plainly."""

import hashlib
import math
import re

import numpy as np
import pytest

from gridloom.llm import quality_rules as qr

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def counts(text):
    words = WORD.findall(text or "")
    grams = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    again = {i + k for i, g in enumerate(grams) if grams.count(g) > 1 for k in range(5)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return (
        len(words),
        sum(map(len, words)),
        sum((text or "").count(c) for c in "#*$%&|<>"),
        len(lines) - len(set(lines)),
        len(again),
    )


TEXTS = [
    None,
    "",
    " \t\n\x0b\x0c\r ",
    "one two three four five",
    "a b c d e a b c d e a b c d e",
    "x y z u v w x y z u v q",
    "é ü 𝄞 # $ |\n\n  \né ü\né ü\n",
    " ".join(["Und"] * 3000),
    "line one is here\nline one is here\nother\tline\nline one is here",
    "no\xa0break stays in a word",
    " ".join(f"w{i % 700}" for i in range(20_000)),
]


def test_counts_equal_plain_ones(spark):
    rows = [(i, t, "en", 1) for i, t in enumerate(TEXTS)] + [(None, "a b", None, 2), (3, TEXTS[3], "en", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, n_words int")
    labels = spark.createDataFrame([], "doc_id long, quality int")
    out = qr.quality_verdicts(docs, labels, ["lang"]).collect()
    assert len(out) == len(rows)
    for r in out:
        text = "a b" if r.doc_id is None else TEXTS[r.doc_id]
        got = (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)
        if r.n_words < 5000:
            assert got == counts(text), text
        else:
            assert got[0] == got[4] == 20_000
        assert r.base_failed == (got[0] < 10 or 100 * got[4] > 20 * got[0])
        # Nothing is labelled, so the base rule decides alone.
        assert r.kept == (not r.base_failed) and r.rejected_by == []


@pytest.mark.parametrize("n, k", [(10, 0), (200, 3), (200, 25), (5000, 250), (100_000, 4800)])
def test_binomial_tail(spark, n, k):
    from pyspark.sql import functions as F

    tail = qr.binomial_tail(F.lit(n).cast("long"), F.lit(k).cast("long"), 0.05)
    got = spark.range(1).select(tail).first()[0]
    logs = [
        math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(0.05) + (n - i) * math.log(0.95)
        for i in range(k + 1)
    ]
    assert got == pytest.approx(math.fsum(map(math.exp, logs)), rel=1e-6)


def corpus(n=900):
    rng = np.random.default_rng(5)
    rows, labels = [], []
    for i in range(n):
        lang = ("en", "fr", None)[i % 3]
        words = [f"w{x}" for x in rng.integers(0, 4000, 40)]
        bad = i % 7 == 0
        if bad:
            words = [w + "$$" for w in words]
        elif i % 50 == 1:
            words = [w + "$" for w in words]
        rows.append((i, " ".join(words), lang))
        labels.append((i, 0 if bad else 1))
    return rows, labels


def test_cutoffs_by_hand(spark):
    """The level of each stratum, from counts and an exact tail over plain lists."""
    rows, labels = corpus()
    rows += [(5000 + i, rows[1][1], "en") for i in range(60)]
    labels += [(5000 + i, 1) for i in range(60)] + [(2, 1), (2, None), (None, 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    told = spark.createDataFrame(labels, "doc_id long, quality int")
    rated = qr.rate(docs, ["lang"])
    lab = qr.labelled(rated, told)
    picked = {r.stratum: r for r in qr.chosen(lab, qr.proposed(lab)).collect()}
    scores = {r.digest: list(r.scores) for r in rated.collect()}
    quality = {}
    for i, q in labels:
        if i is not None and q is not None:
            quality[i] = min(q, quality.get(i, 9))
    seen = {}
    for i, text, lang in rows:
        key = (lang, hashlib.md5(text.encode()).hexdigest())
        seen[key] = min(seen.get(key, 9), quality[i])
    strata = {lang for lang, _ in seen}
    for lang in strata:
        mine = [(d >= "8", q, scores[d]) for (x, d), q in seen.items() if x == lang]
        tune = {q: [s for h, g, s in mine if not h and g == q] for q in (0, 1)}
        hold = [s for h, g, s in mine if h and g == 1]
        best = None
        for t, share in enumerate(qr.LEVELS):
            cuts = []
            for rule in range(len(qr.RULES)):
                able = [qr.NEVER]
                for v in {s[rule] for s in tune[0] + tune[1]}:
                    good, bad = (sum(s[rule] >= v for s in tune[q]) for q in (1, 0))
                    if good <= share * len(tune[1]) and bad * len(tune[1]) > qr.LIFT * good * len(tune[0]):
                        able.append(v)
                cuts.append(min(able))
            out = lambda ss, cuts=cuts: sum(any(a >= b for a, b in zip(s, cuts, strict=True)) for s in ss)
            n, k = len(hold), out(hold)
            tail = sum(math.comb(n, i) * 0.05**i * 0.95 ** (n - i) for i in range(k + 1))
            if tail > qr.RISK / len(strata):
                break
            gain = out(tune[0]) / len(tune[0]) - qr.COST * out(tune[1]) / len(tune[1])
            if gain > 0 and (best is None or gain > best[0]):
                best = (gain, t, cuts)
        row = picked['["' + lang + '"]' if lang else "[null]"]
        assert row.n == len(hold)
        assert (row.level, row.cuts) == ((best[1], best[2]) if best else (None, None))
    assert any(r.level is not None for r in picked.values())


def test_bad_go_and_good_stay(spark):
    rows, labels = corpus(1500)
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    told = spark.createDataFrame(labels, "doc_id long, quality int")
    out = qr.quality_verdicts(docs, told, ["lang"]).collect()
    good = [r.kept for r in out if dict(labels)[r.doc_id]]
    assert not any(r.kept for r in out if not dict(labels)[r.doc_id])
    assert np.mean(good) > 0.95


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string")
    told = spark.createDataFrame([(1, 1)], "doc_id long, quality int")
    assert qr.quality_verdicts(docs, told, ["lang"]).collect() == []
