"""Periodic runs of words, found by uniting suffixes in the order of falling common prefixes.

The words of a document are numbered and its suffixes sorted by prefix doubling. Neighbours in that order
share a prefix (LCP); they are united from the longest prefix to the shortest by union-find, Kruskal's way.
Each class keeps its positions in order, and the smaller class is put into the larger one. Two positions that
become neighbours in their class at a distance d, when prefixes of length l are united, d <= l, start a
repetition: the words from the first position to l words past the second have the smallest period d. All
seeds of one run have the same period and end, and the first of them is the run's start, so nothing has to be
extended. A run that is at least three periods and 24 words long shares a prefix of two thirds of its length
(and so 16 words) with itself one period on; shorter prefixes are never united.

A document is worked on whole within one row; Spark spreads the rows. What a task holds is a constant times
the words of about ``TOGETHER`` bytes of texts, or of one longer text.

Nulls and edge cases: a null or empty text has no words and no runs; rows with a null id and repeated rows are
each worked on; an empty table gives an empty result. Only the named columns are read, so others may have any
name. Words are compared by their bytes.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A run is at least so many words and so many periods long.
LEAST_WORDS, LEAST_PERIODS = 24, 3
#: Bytes of short texts whose suffixes are sorted together.
TOGETHER = 1 << 19

Run = tuple[int, int, int]


def suffix_ranks(ids: np.ndarray) -> list[np.ndarray]:
    """Ranks of all suffixes by their first 1, 2, 4, ... ids, until they differ."""
    ranks = [np.unique(ids, return_inverse=True)[1].astype(np.int32)]
    step = 1
    while len(ids) and ranks[-1].max() < len(ids) - 1:
        rank = ranks[-1]
        key = rank.astype(np.int64) * (len(ids) + 1)
        key[: len(ids) - step] += rank[step:] + 1
        ranks.append(np.unique(key, return_inverse=True)[1].astype(np.int32))
        step *= 2
    return ranks


def neighbours(ids: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Suffixes next to each other in order that share ``least`` ids or more: both and how many."""
    ranks = suffix_ranks(ids)
    order = np.empty(len(ids), dtype=np.int64)
    order[ranks[-1]] = np.arange(len(ids))
    a, b = order[:-1], order[1:]
    shared = np.zeros(len(a), dtype=np.int64)
    for level in range(len(ranks) - 1, -1, -1):
        x, y = a + shared, b + shared
        inside = np.maximum(x, y) < len(ids)
        same = inside.copy()
        same[inside] = ranks[level][x[inside]] == ranks[level][y[inside]]
        shared[same] += 1 << level
    long = shared >= least
    return a[long], b[long], shared[long]


def seeds(a: np.ndarray, b: np.ndarray, shared: np.ndarray) -> dict[tuple[int, int], int]:
    """The first position of each repetition by (period, end), from the neighbours' prefixes."""
    falling = np.argsort(-shared, kind="stable")
    parent: dict[int, int] = {}
    members: dict[int, list[int]] = {}
    found: dict[tuple[int, int], int] = {}

    def root(x: int) -> int:
        while (up := parent.setdefault(x, x)) != x:
            parent[x] = x = parent[up]
        return x

    def near(first: int, second: int, prefix: int) -> None:
        period = second - first
        if period <= prefix:
            key = (period, second + prefix)
            if first < found.get(key, first + 1):
                found[key] = first

    for x, y, prefix in zip(a[falling].tolist(), b[falling].tolist(), shared[falling].tolist(), strict=True):
        x, y = root(x), root(y)
        large, small = members.get(x) or [x], members.get(y) or [y]
        if len(large) < len(small):
            x, y, large, small = y, x, small, large
        parent[y] = x
        members.pop(y, None)
        # Pairs within one of the classes have met before, with a longer prefix.
        mine = set(small)
        if 8 * len(small) < len(large):
            for p in small:
                at = bisect_left(large, p)
                if at and large[at - 1] not in mine:
                    near(large[at - 1], p, prefix)
                if at < len(large) and large[at] not in mine:
                    near(p, large[at], prefix)
                large.insert(at, p)
        elif len(large) == 1:
            large = [large[0], small[0]] if large[0] < small[0] else [small[0], large[0]]
            near(large[0], large[1], prefix)
        else:
            large = sorted(large + small)
            for p, q in zip(large, large[1:], strict=False):
                if (p in mine) != (q in mine):
                    near(p, q, prefix)
        members[x] = large
    return found


def runs_of(texts: list[list[bytes]]) -> list[list[Run]]:
    """(start, length, period) of the runs of each list of words, by start and then period."""
    ids, starts = [], []
    many = 0
    for words in texts:
        starts.append(len(ids))
        number: dict[bytes, int] = {}
        ids += [number.setdefault(w, many + len(number)) for w in words]
        many += len(number)
        # Ends a text; stands nowhere else.
        ids.append(many)
        many += 1
    least = LEAST_WORDS - LEAST_WORDS // LEAST_PERIODS
    found: list[list[Run]] = [[] for _ in texts]
    for (period, end), first in seeds(*neighbours(np.array(ids, dtype=np.int64), least)).items():
        if end - first >= max(LEAST_WORDS, LEAST_PERIODS * period):
            text = int(np.searchsorted(starts, first, side="right")) - 1
            insort(found[text], (first - starts[text], end - first, period), key=lambda r: (r[0], r[2]))
    return found


def collapsed(words: list[bytes], runs: list[Run]) -> list[bytes]:
    """The words without those that a run holds after its first period."""
    if not runs:
        return words
    change = np.zeros(len(words) + 1, dtype=np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    return [words[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0)]


def strongest(runs: list[Run]) -> Run | None:
    """The run with the greatest length by period; of equals the first start, then period."""
    return min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)


def _in_batches(texts: Iterator[bytes]) -> Iterator[list[list[bytes]]]:
    held, size = [], 0
    for text in texts:
        if held and size + len(text) > TOGETHER:
            yield held
            held, size = [], 0
        held.append(text.split())
        size += len(text)
    if held:
        yield held


def _rows(batches: Iterator[pa.RecordBatch], with_text: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        at = 0
        texts = (t.as_py() or b"" for t in batch.column("text"))
        for group in _in_batches(texts):
            rows = []
            for words, runs in zip(group, runs_of(group), strict=True):
                best = strongest(runs) or (None, None, None)
                told = "".join(f"{s},{n},{p}\n" for s, n, p in runs).encode()
                left = b" ".join(collapsed(words, runs))
                rows.append(
                    (
                        [dict(zip(("start", "length", "period"), r, strict=True)) for r in runs],
                        *best,
                        1000 * best[1] // best[2] if runs else None,
                        hashlib.sha256(told).hexdigest(),
                        hashlib.sha256(left).hexdigest(),
                        left.decode("utf-8", "replace") if with_text else None,
                    )
                )
            run = pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")]))
            kinds = [run, *[pa.int64()] * 4, *[pa.string()] * 3]
            arrays = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
            ident = batch.column("id").slice(at, len(rows))
            at += len(rows)
            names = ["id", "runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256", "text"]
            yield pa.RecordBatch.from_arrays([ident, *arrays], names)


def collapse_runs(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", with_text: bool = True
) -> DataFrame:
    """Per document: id, ``runs`` (start, length, period), the strongest run, digests of the runs and
    of the text without repetitions, and that text itself where ``with_text``."""
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("binary").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    schema = (
        f"id {kind}, runs array<struct<start: long, length: long, period: long>>, start long, length long, "
        "period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string, text string"
    )
    found = rows.mapInArrow(lambda batches: _rows(batches, with_text), schema)
    return found.select(F.col("id").alias(id_col), *found.columns[1:])


def with_planted_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every tenth document by a hash of its id repeats words of its own from some place on.

    With h the CRC of the id, g = h div 10, n words, a = g mod n and p = 1 + (n - a) div (3 + g mod 8), the
    word at i >= a becomes that at a + (i - a) mod p. Other texts stay as they are.
    """
    ident, text = F.col(f"`{id_col}`"), F.col(f"`{text_col}`")
    blanks = " \t\n\x0b\x0c\r"
    words = F.array_remove(F.split(F.translate(text, blanks, " " * len(blanks)), " "), "")
    h = F.crc32(ident.cast("string").cast("binary"))
    rows = docs.select(ident.alias("id"), text.alias("text"), F.floor(h / 10).alias("g"), (h % 10 == 0).alias("hit"))
    # Words are split only where they are changed.
    rows = rows.withColumn("w", F.when(F.col("hit"), words)).withColumn("n", F.size("w").cast("long"))
    rows = rows.withColumn("a", F.expr("CASE WHEN n > 0 THEN g % n END"))
    rows = rows.withColumn("p", F.expr("1 + (n - a) div (3 + g % 8)"))
    repeated = F.expr("array_join(transform(w, (x, i) -> IF(i < a, x, w[CAST(a + (i - a) % p AS INT)])), ' ')")
    changed = F.when(F.col("n") > 0, repeated).otherwise(F.col("text"))
    return rows.select(F.col("id").alias(id_col), changed.alias(text_col))
