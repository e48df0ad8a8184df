"""Quality rules whose cutoffs bound the share of good documents they reject.

Each document gets plain counts and, from them, one whole-number score from 0 to 1000 per rule (high is
bad). Labelled documents are halved by a hash of the text. One half proposes, per stratum, a sequence of
cutoff sets, from lenient to strict: at level t every rule may reject at most a share ``LEVELS[t]`` of the
half's good documents, and a rule that catches few bad ones there is left out. The other half, the holdout,
tests each set as a whole: with n good documents of which k would be rejected, the hypothesis "more than
``limit`` of the stratum's good documents are rejected" falls if P(Binomial(n, limit) <= k) is at most
``risk`` divided by the number of strata tested (Bonferroni). Within a stratum levels are tested in their
fixed order up to the first that stands, which needs no further correction. So with a probability of at
least ``1 - risk`` no stratum rejects more than ``limit`` of its good documents. Of the levels that passed
the most lenient with the best balance of bad and good documents rejected in the first half is taken (a good
one costs as much as ``COST`` bad ones). A stratum with too few labels passes none and is judged by the base rule alone.

Only functions of Spark are used. Texts are read once; scores and counts, a few numbers per document, are
written and read again. Labelled rows meet in counts per (stratum, rule, score), at most 1001 scores each;
the table of cutoffs has one row per stratum.

Nulls and edge cases: a null text has no words; a null stratum is a stratum of its own; labels without an
id or quality are ignored, a document with several labels is good only if all say so, and copies of a text
count once in a stratum, good only if all are. Documents that fail the base rule take no part in the choice.
Repeated rows are each rated; rows without an id are rated by the chosen cutoffs. Without labels or
documents nothing but the base rule applies, or nothing comes out. Only the named columns are read, so others
may have any name. Runs of five words count as equal when their 64-bit hashes are.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from gridloom.llm.common import cut_lineage
from gridloom.operators.lookup import lookup_join

#: The share of a stratum's good documents that may be rejected, and the risk that more are somewhere.
LIMIT, RISK = 0.05, 0.05
#: Shares of good documents a single rule may reject, from lenient to strict.
LEVELS = [0.0, 0.001, 0.002, 0.005, 0.01, 0.02, 0.04]
#: A rule must reject bad documents this many times as often as good ones.
LIFT = 3
#: In the choice of a level a share of good documents counts as many times that of bad ones.
COST = 5
TOP = 1000
NEVER = TOP + 1
WINDOW = 5

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_capitals", "n_marks"]
RULES = ["symbols", "dup_lines", "repeats", "long_words", "short_words", "capitals", "marks"]
SYMBOLS = "#*$%&|<>"
MARKS = "!?"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
BLANKS = " \t\n\x0b\x0c\r"


def _how_many(text: Column, of: str) -> Column:
    """Occurrences of the ASCII characters ``of``."""
    return F.octet_length(text) - F.octet_length(F.translate(text, of, ""))


def _repeat_words(grams: Column) -> Column:
    """Words in windows that stand in the text twice or more, by sorting the windows' hashes."""
    placed = F.sort_array(F.transform(grams, lambda h, i: F.struct(h.alias("h"), i.alias("at"))))

    def twice(p: Column) -> Column:
        at = F.transform(
            p,
            lambda x, i: F.when(
                ((i > 0) & (F.get(p, i - 1)["h"] == x["h"])) | F.coalesce(F.get(p, i + 1)["h"] == x["h"], F.lit(False)),
                x["at"],
            ),
        )
        return F.sort_array(F.filter(at, lambda x: x.isNotNull()))

    start = F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).alias("n"))
    # A lambda binds the sorted windows, which would else be sorted at each mention.
    covered = F.transform(
        F.array(placed),
        lambda p: F.aggregate(
            twice(p),
            start,
            lambda acc, at: F.struct(at.alias("last"), (acc["n"] + F.least(F.lit(WINDOW), at - acc["last"])).alias("n")),
            lambda acc: acc["n"],
        ),
    )
    return covered[0]


def text_counts(text: Column) -> dict[str, Column]:
    """What is taken from the text itself."""
    text = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))
    return {
        "words": F.array_remove(F.split(F.translate(text, BLANKS, " " * len(BLANKS)), " "), ""),
        "word_chars": F.char_length(F.translate(text, BLANKS, "")),
        "n_symbols": _how_many(text, SYMBOLS),
        "n_capitals": _how_many(text, CAPITALS),
        "n_marks": _how_many(text, MARKS),
        "lines": lines,
        "digest": F.md5(text.cast("binary")),
    }


def _grams(words: Column) -> Column:
    first = F.sequence(F.lit(0), F.size(words) - WINDOW)
    gram = F.transform(first, lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(WINDOW)]))
    return F.when(F.size(words) >= WINDOW, gram).otherwise(F.array().cast("array<long>"))


def _scores() -> Column:
    """One score from 0 to 1000 per rule, high is bad."""
    per_mille = [("n_symbols", "word_chars"), ("n_dup_lines", "n_lines"), ("n_repeat_words", "n_words")]
    mean = F.expr("10 * word_chars div greatest(n_words, 1)")
    share = lambda a, b: F.expr(f"{TOP} * {a} div greatest({b}, 1)")
    found = [share(a, b) for a, b in per_mille]
    found += [mean, TOP - F.least(mean, F.lit(TOP)), share("n_capitals", "word_chars"), share("n_marks", "word_chars")]
    return F.array(*[F.least(s, F.lit(TOP)).cast("int") for s in found])


def rate(docs: DataFrame, strata: list[str], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: id, stratum, digest of the text, the counts, base_failed, scores."""
    stratum = F.to_json(F.array(*[F.col(f"`{c}`").cast("string") for c in strata]))
    text = F.col(f"`{text_col}`")
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), stratum.alias("stratum"), text.alias("text"))
    rows = rows.withColumns(text_counts(F.col("text"))).drop("text").withColumn("grams", _grams(F.col("words")))
    rows = rows.select(
        "id",
        "stratum",
        "digest",
        *[F.col(c).cast("long").alias(c) for c in ("word_chars", "n_symbols", "n_capitals", "n_marks")],
        F.size("words").cast("long").alias("n_words"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        _repeat_words(F.col("grams")).cast("long").alias("n_repeat_words"),
    )
    failed = F.expr("n_words < 10 OR 100 * n_repeat_words > 20 * n_words")
    return rows.select("id", "stratum", "digest", *COUNTS, failed.alias("base_failed"), _scores().alias("scores"))


def labelled(rated: DataFrame, labels: DataFrame, id_col: str = "doc_id", quality_col: str = "quality") -> DataFrame:
    """One row per stratum and labelled text that passes the base rule: half, good, scores."""
    told = labels.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{quality_col}`").alias("q"))
    told = told.where("id IS NOT NULL AND q IS NOT NULL").groupBy("id").agg(F.min("q").alias("q"))
    rows = rated.where("NOT base_failed").select("id", "stratum", "digest", "scores")
    rows = lookup_join(rows, told, ["id"], ["digest"], "inner", bound=labels.select(id_col, quality_col))
    rows = rows.groupBy("stratum", "digest").agg(F.min("q").alias("q"), F.first("scores").alias("scores"))
    holdout = F.substring("digest", 1, 1) >= "8"
    return rows.select("stratum", holdout.alias("holdout"), (F.col("q") > 0).alias("good"), "scores")


def proposed(rows: DataFrame, levels: list[float] = LEVELS) -> DataFrame:
    """Per stratum: ``cutoffs``, per level one cutoff per rule, from the half that is not the holdout."""
    half = rows.where("NOT holdout").select(
        "stratum", F.col("good").cast("int").alias("good"), F.posexplode("scores").alias("rule", "score")
    )
    bins = half.groupBy("stratum", "rule", "score").agg(
        F.sum("good").alias("good"), F.sum(1 - F.col("good")).alias("bad")
    )
    # At most 1001 scores each.
    above = W.partitionBy("stratum", "rule").orderBy(F.desc("score"))
    whole = W.partitionBy("stratum", "rule")
    tails = bins.select(
        "stratum",
        "rule",
        "score",
        *[F.sum(c).over(above).alias(f"{c}_tail") for c in ("good", "bad")],
        *[F.sum(c).over(whole).alias(f"{c}_all") for c in ("good", "bad")],
    )
    worth = F.expr(f"bad_tail * good_all > {LIFT} * good_tail * bad_all")
    cut = [
        F.coalesce(F.min(F.when(worth & (F.col("good_tail") <= F.lit(q) * F.col("good_all")), F.col("score"))), F.lit(NEVER))
        for q in levels
    ]
    by_rule = tails.groupBy("stratum", "rule").agg(F.array(*cut).alias("cuts"))
    sets = by_rule.groupBy("stratum").agg(F.array_sort(F.collect_list(F.struct("rule", "cuts"))).alias("r"))
    return sets.select(
        "stratum",
        F.array(*[F.transform("r", lambda x, t=t: x["cuts"][t]) for t in range(len(levels))]).alias("cutoffs"),
    )


def _rejects(scores: Column, cutoffs: Column) -> Column:
    return F.exists(F.arrays_zip(scores.alias("s"), cutoffs.alias("c")), lambda x: x["s"] >= x["c"])


def binomial_tail(n: Column, k: Column, limit: float) -> Column:
    """P(Binomial(n, limit) <= k), added up term by term in logarithms."""
    first = n * F.lit(math.log1p(-limit))
    start = F.struct(first.alias("term"), first.alias("all"))

    def add(acc: Column, i: Column) -> Column:
        term = acc["term"] + F.log((n - i + 1) / i * F.lit(limit / (1 - limit)))
        high, low = F.greatest(acc["all"], term), F.least(acc["all"], term)
        return F.struct(term.alias("term"), (high + F.log1p(F.exp(low - high))).alias("all"))

    steps = F.when(k > 0, F.sequence(F.lit(1).cast("long"), k)).otherwise(F.array().cast("array<long>"))
    return F.aggregate(steps, start, add, lambda acc: F.exp(acc["all"]))


def chosen(
    rows: DataFrame, cutoffs: DataFrame, limit: float = LIMIT, risk: float = RISK, levels: list[float] = LEVELS
) -> DataFrame:
    """Per stratum: ``tested`` (n, strata, per level k and tail), ``level`` taken (null: none), its cutoffs."""
    joined = lookup_join(rows, cutoffs, ["stratum"], ["scores"], "inner")
    marks = {"n": F.expr("holdout AND good"), "good": F.expr("NOT holdout AND good"), "bad": F.expr("NOT holdout AND NOT good")}
    sums = [F.sum(m.cast("long")).alias(c) for c, m in marks.items()]
    for t in range(len(levels)):
        out = _rejects(F.col("scores"), F.col("cutoffs")[t])
        sums += [F.sum((m & out).cast("long")).alias(f"{c}_{t}") for c, m in marks.items()]
    counts = cut_lineage(joined.groupBy("stratum").agg(*sums), "rejections")
    strata = counts.where("n > 0").count()

    def level(t: int) -> Column:
        tail = binomial_tail(F.col("n"), F.col(f"n_{t}"), limit)
        share = lambda c: F.col(f"{c}_{t}") / F.greatest(F.col(c), F.lit(1))
        return F.struct(
            F.lit(t).alias("t"),
            F.col(f"n_{t}").alias("k"),
            tail.alias("tail"),
            ((F.col("n") > 0) & (tail <= risk / max(strata, 1))).alias("ok"),
            (share("bad") - F.lit(COST) * share("good")).alias("gain"),
        )

    tested = counts.select("stratum", "n", F.array(*[level(t) for t in range(len(levels))]).alias("tests"))
    stands = F.array_position(F.col("tests.ok"), False)
    passed = F.when(stands == 0, F.col("tests")).otherwise(F.slice("tests", 1, F.greatest(stands - 1, F.lit(0)).cast("int")))
    gains = F.transform(F.filter(passed, lambda x: x["gain"] > 0), lambda x: F.struct(x["gain"], (-x["t"]).alias("t")))
    tested = tested.withColumn("level", -F.array_max(gains)["t"])
    picked = lookup_join(tested, cutoffs, ["stratum"], ["stratum"])
    return picked.select("stratum", "n", "tests", "level", F.get("cutoffs", F.col("level")).alias("cuts"))


def quality_verdicts(
    docs: DataFrame,
    labels: DataFrame,
    strata: list[str],
    id_col: str = "doc_id",
    text_col: str = "text",
    quality_col: str = "quality",
    limit: float = LIMIT,
    risk: float = RISK,
    levels: list[float] = LEVELS,
) -> DataFrame:
    """Per document: id, stratum, counts, base_failed, scores by rule, the rules that reject it, kept."""
    rated = cut_lineage(rate(docs, strata, id_col, text_col), "rated")
    rows = cut_lineage(labelled(rated, labels, id_col, quality_col), "labelled")
    cutoffs = cut_lineage(proposed(rows, levels), "cutoffs")
    picked = cut_lineage(chosen(rows, cutoffs, limit, risk, levels), "chosen")
    taken = picked.where("level IS NOT NULL").select("stratum", "cuts")
    out = lookup_join(rated, taken, ["stratum"], ["id", "digest"])
    rules = F.array(*[F.lit(r) for r in RULES])
    over = F.filter(
        F.arrays_zip(rules.alias("rule"), F.col("scores").alias("s"), F.col("cuts").alias("c")), lambda x: x["s"] >= x["c"]
    )
    rejected = F.coalesce(F.transform(over, lambda x: x["rule"]), F.array().cast("array<string>"))
    return out.select(
        F.col("id").alias(id_col),
        "stratum",
        *COUNTS,
        "base_failed",
        "scores",
        rejected.alias("rejected_by"),
        (~F.col("base_failed") & (F.size(rejected) == 0)).alias("kept"),
    )
