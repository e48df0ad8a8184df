"""Near-duplicate documents: a size-aware join of their word n-gram sets under Jaccard similarity.

Documents with equal sets are one class, and only its smallest id goes on. Small sets list all their
subsets of the size that a similar pair must share; two sets are similar if they list the same one.
Large sets are compared through inverted lists, which need only the first part of each set in a
common order of all n-grams: two similar sets share an n-gram there. The boundary between small
and large is the size with the least total cost, from the number of sets of each size.

The common order puts n-grams that many documents repeat last and goes by hash otherwise, so lists
stay short. Which n-grams are put last decides about cost only, never about results; so the list of
them may be bounded (``FREQUENT``). From a list, its most typical set is compared with the others (a
star), then in some rounds each set outside the list's largest component with a set inside. Sets that
this has linked need no further comparison with each other; what is left are pairs across
components, which are all compared. So all links that matter for the components are found, but
the pairs inside a large group of copies are never listed. Every candidate pair is checked on whole
sets.

Nulls and edge cases: a null or empty text, or one without words, has an empty set and no links; a
row without an id has no links and a null component; rows that repeat an id count as one document with any of
their texts; an empty table gives an empty result. Only the named columns are read; others may have any name.
N-grams are told apart by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from gridloom.llm.common import cut_lineage, nothing_kept, sliced, utf8
from gridloom.llm.components import components
from gridloom.llm.words import mixed, word_arrays
from gridloom.operators.lookup import lookup_join

GRAM = 4
#: Similar: 100 * intersection >= PERCENT * union.
PERCENT = 85
#: N-grams known to be in several sets are put last in the common order; at most so many.
FREQUENT = 250_000
#: Sets that share an entry of a list before its n-gram counts as frequent.
SHARED = 3
#: Rounds in which every set outside a list's main component is compared with one set inside.
ROUNDS = 1
#: Entries of a list that a task puts in order together.
TOGETHER = 500
#: Buckets of the counts that bound what two sets share.
BUCKETS = 256
#: A set of more than this many n-grams is never small, whatever the costs.
MOST_SMALL = 40
#: Cost of one entry of an inverted list against one subset.
ENTRY_COST = 4
#: N-grams held by a task while counting.
HELD = 1_000_000


def need(a: int, b: int, percent: int = PERCENT) -> int:
    """How many n-grams sets of sizes a and b share at least when they are similar."""
    return -(-percent * (a + b) // (100 + percent))


def prefix_size(n: int, percent: int = PERCENT) -> int:
    """Similar sets share an n-gram among so many first ones of a set of n."""
    return n - -(-percent * n // 100) + 1


def gram_sets(texts: Iterable[bytes], gram: int = GRAM) -> Iterator[np.ndarray]:
    """Sorted distinct hashes of each text's word n-grams; all words are one if there are fewer."""
    for words in word_arrays(texts):
        size = min(gram, len(words))
        if not size:
            yield words
            continue
        n = len(words) - size + 1
        grams = np.full(n, size, np.uint64)
        for k in range(size):
            grams = mixed(grams + words[k : k + n])
        grams.sort()
        fresh = np.ones(n, dtype=bool)
        np.not_equal(grams[1:], grams[:-1], out=fresh[1:])
        yield grams[fresh]


def texts_of(batch: pa.RecordBatch) -> Iterator[bytes]:
    nothing_kept()
    return (data.as_py() for data in batch.column("data"))


def size_classes(n: int, small: int, percent: int = PERCENT) -> list[tuple[int, int, int]]:
    """(smaller size, larger size, shared) of the pairs that a small set of n can be in."""
    found = []
    for other in range(1, small + 1):
        a, b = min(n, other), max(n, other)
        # Equal sizes that must share all are equal sets, which are one class already.
        if 100 * a >= percent * b and need(a, b, percent) < b:
            found.append((a, b, need(a, b, percent)))
    return found


def boundary(sizes: dict[int, int], percent: int = PERCENT, most: int = MOST_SMALL) -> int:
    """The largest size of small sets: where subsets and inverted lists cost least together."""
    costs = []
    for small in range(most + 1):
        listed = sum(
            times * comb(n, c)
            for n, times in sizes.items()
            if n <= small
            for _, _, c in size_classes(n, small, percent)
        )
        indexed = sum(
            times * prefix_size(n, percent) * ENTRY_COST
            for n, times in sizes.items()
            if 100 * n >= percent * (small + 1)
        )
        costs.append(listed + indexed)
    return int(np.argmin(costs))


def subset_keys(grams: np.ndarray, small: int, percent: int = PERCENT) -> list[int]:
    """A key for each subset that a small set shares with a similar one of each size."""
    n, values = len(grams), mixed(grams)
    whole = values.sum(dtype=np.uint64)
    keys = []
    for a, b, shared in size_classes(n, small, percent):
        out = list(combinations(range(n), n - shared))
        left = whole - values[np.array(out, dtype=np.int64)].sum(axis=1, dtype=np.uint64)
        keys.append(mixed(left + np.uint64((a * 1000 + b) * 1000 + shared)))
    return keys


def _digests(docs: DataFrame, gram: int) -> DataFrame:
    """Rows with id, n and two halves of a digest of the set; and rows with the hash of an n-gram
    (s1) that a task saw in n > 1 different sets, whose s2 is null."""
    fields = ["id", "n", "s1", "s2"]

    def repeated(held: dict[int, np.ndarray]) -> pa.RecordBatch:
        grams, times = np.unique(np.concatenate(list(held.values())), return_counts=True)
        often = times > 1
        none = pa.nulls(int(often.sum()), pa.int64())
        counts = pa.array(times[often].astype(np.int64))
        hashes = pa.array(grams[often].view(np.int64))
        return pa.RecordBatch.from_arrays([none, counts, hashes, none], names=fields)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        size = 0
        for batch in sliced(batches):
            n, first, second = [], [], []
            for grams in gram_sets(texts_of(batch), gram):
                both = xxhash.xxh3_128_intdigest(grams.tobytes())
                n.append(len(grams))
                first.append((both >> 64) - (1 << 63)), second.append(both % (1 << 64) - (1 << 63))
                if both not in held:
                    held[both] = grams
                    size += len(grams)
                if size > HELD:
                    yield repeated(held)
                    held, size = {}, 0
            made = [pa.array(c, pa.int64()) for c in (n, first, second)]
            yield pa.RecordBatch.from_arrays([batch.column("id"), *made], names=fields)
        if held:
            yield repeated(held)

    return docs.mapInArrow(digest, "id long, n long, s1 long, s2 long")


def _frequent(counts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Hashes (s1) of frequent n-grams, sorted, and the power of two of their counts (n)."""
    often = cut_lineage(counts.groupBy("s1").agg(F.sum("n").alias("n")), "repeated")
    least, room = 0, FREQUENT
    for n, times in often.groupBy("n").count().orderBy(F.desc("n")).toLocalIterator():
        room -= times
        if room < 0:
            break
        least = n
    # At most FREQUENT rows, 4 MB.
    first = often.where(F.col("n") >= least) if least else often.limit(0)
    found = first.select("s1", F.floor(F.log2("n")).cast("int").alias("class")).toPandas()
    hashes = found["s1"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(hashes)
    return hashes[order], found["class"].to_numpy(np.int8)[order]


def in_order(grams: np.ndarray, frequent: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, int]:
    """The set in the common order, by class of frequency and then by hash; and how many n-grams
    are frequent."""
    last, classes = frequent
    if not len(last):
        return grams, 0
    at = np.minimum(np.searchsorted(last, grams), len(last) - 1)
    often = last[at] == grams
    level = np.where(often, classes[at], np.int8(-1))
    return grams[np.argsort(level, kind="stable")], int(often.sum())


def _postings(docs: DataFrame, frequent: tuple, small: int, gram: int, percent: int) -> DataFrame:
    """listed (0 inverted list, 1 subset), key, n, id, rank (the least heads its list), and left:
    how many n-grams of the set come with or after the entry in the common order."""
    shared = docs.sparkSession.sparkContext.broadcast(frequent)

    def entries(grams: np.ndarray) -> Iterator[tuple[int, np.ndarray, int]]:
        n = len(grams)
        if n <= small:
            for keys in subset_keys(grams, small, percent):
                yield 1, keys, n
        if 100 * n >= percent * (small + 1):
            ordered, often = in_order(grams, shared.value)
            # A set of n-grams that others have too is in the middle of its copies.
            yield 0, ordered[: prefix_size(n, percent)], 1000 * (n - often) // n

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            ids = batch.column("id").to_numpy(zero_copy_only=False)
            rows = []
            for i, grams in zip(ids, gram_sets(texts_of(batch), gram), strict=True):
                if len(grams):
                    rows += [(kind, k, len(grams), i, rank) for kind, k, rank in entries(grams)]
            if rows:
                times = [len(r[1]) for r in rows]
                each = [np.repeat([r[c] for r in rows], times) for c in (0, 2, 3, 4)]
                after = [r[2] - np.arange(k) if r[0] == 0 else np.full(k, r[2]) for r, k in zip(rows, times)]
                keys = pa.array(np.concatenate([r[1] for r in rows]).view(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(each[0].astype(np.int32)),
                        keys,
                        *[pa.array(c.astype(np.int64)) for c in [*each[1:], np.concatenate(after)]],
                    ],
                    names=["listed", "key", "n", "id", "rank", "left"],
                )

    return docs.mapInArrow(post, "listed int, key long, n long, id long, rank long, left long")


def _with_both(docs: DataFrame, pairs: DataFrame, make: Callable[[np.ndarray], np.ndarray], gram: int):
    """The pairs (a, b) with what ``make`` makes of the set of a (x) and of b (y), as bytes."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            found = [make(grams).tobytes() for grams in gram_sets(texts_of(batch), gram)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(found, pa.binary())], names=["id", "made"]
            )

    ids = pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct()
    wanted = lookup_join(docs, cut_lineage(ids, "ids"), ["id"], ["id"], "left_semi")
    whole = cut_lineage(wanted.mapInArrow(made, "id long, made binary"), "sets")
    joined = pairs.join(whole.select(F.col("id").alias("a"), F.col("made").alias("x")), "a")
    joined = joined.join(whole.select(F.col("id").alias("b"), F.col("made").alias("y")), "b")
    return joined.select("a", "b", "x", "y")


def bucket_counts(grams: np.ndarray) -> np.ndarray:
    """Size of the set, and how many of its n-grams fall into each of ``BUCKETS`` buckets."""
    place = (mixed(grams) >> np.uint64(64 - 8)).astype(np.int64)
    return np.append(np.bincount(place, minlength=BUCKETS), len(grams)).astype(np.uint32)


def _kept(joined: DataFrame, similar: Callable[[np.ndarray, np.ndarray], bool], kind: type):
    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            good = [
                similar(np.frombuffer(x.as_buffer(), kind), np.frombuffer(y.as_buffer(), kind))
                for x, y in zip(batch.column("x"), batch.column("y"), strict=True)
            ]
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    return joined.mapInArrow(keep, "a long, b long")


def _verified(docs: DataFrame, pairs: DataFrame, gram: int, percent: int) -> DataFrame:
    """The pairs (a, b) that are similar, judged on their whole sets.

    Sets cannot share more than their bucket counts do; pairs that this rules out need no more.
    """

    def may_be(x: np.ndarray, y: np.ndarray) -> bool:
        most = int(np.minimum(x[:-1], y[:-1]).sum())
        return most >= need(int(x[-1]), int(y[-1]), percent)

    def are(x: np.ndarray, y: np.ndarray) -> bool:
        both = len(np.intersect1d(x, y, assume_unique=True))
        return 100 * both >= percent * (len(x) + len(y) - both)

    likely = _kept(_with_both(docs, pairs, bucket_counts, gram), may_be, np.uint32)
    likely = cut_lineage(likely.distinct(), "likely")
    return _kept(_with_both(docs, likely, lambda grams: grams, gram), are, np.uint64)


def _across(lists: DataFrame, linked: DataFrame) -> DataFrame:
    """Entries of the lists that hold several components, with theirs and the list's largest."""
    lists = lookup_join(lists, linked, ["id"], ["key"])
    lists = cut_lineage(lists.withColumn("component", F.coalesce("component", "id")), "lists")
    parts = lists.groupBy("key", "component").agg(F.count("*").alias("k"))
    parts = parts.groupBy("key").agg(
        F.max(F.struct("k", "component")).alias("most"), F.count("*").alias("parts")
    )
    several = parts.where("parts > 1").select("key", F.col("most.component").alias("main"))
    return cut_lineage(lists.join(several, "key"), "several")


def near_duplicates(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    gram: int = GRAM,
    percent: int = PERCENT,
) -> DataFrame:
    """One row per row of ``df``: id, n_shingles, component_id (the least id linked with it)."""
    docs = df.select(
        F.col(f"`{id_col}`").cast("long").alias("id"), utf8(F.col(f"`{text_col}`")).alias("data")
    )
    sets = cut_lineage(_digests(docs, gram), "sets")
    repeated = sets.where("s2 IS NULL").select("s1", "n")
    sets = sets.where("s2 IS NOT NULL")
    known = sets.where("id IS NOT NULL AND n > 0")
    copies = known.groupBy("s1", "s2").agg(F.min("id").alias("first"), F.count("*").alias("c"))
    copies = cut_lineage(copies.where("c > 1").select("s1", "s2", "first"), "copies")
    sets = lookup_join(sets, copies, ["s1", "s2"], ["id"])
    sets = sets.withColumn("first", F.when(F.col("n") > 0, F.coalesce("first", "id")).otherwise(F.col("id")))
    sets = cut_lineage(sets, "classes")

    # The rows that are not the first of their class, or have nothing to compare, stay out.
    rest = sets.where("id != first OR n = 0").select("id").distinct()
    one = lookup_join(docs.where("id IS NOT NULL"), cut_lineage(rest, "rest"), ["id"], ["id"], "left_anti")
    heads = sets.where(f"id = first AND n > 0 AND n <= {MOST_SMALL * 2}").groupBy("n")
    # At most as many rows as sizes.
    sizes = {r[0]: r[1] for r in heads.count().collect()}
    small = boundary(sizes, percent)
    # What a first order puts into several lists comes last in the second one.
    counts = _postings(one, _frequent(repeated), small, gram, percent).where("listed = 0")
    counts = counts.groupBy(F.col("key").alias("s1")).agg(F.count("*").alias("n"))
    counts = cut_lineage(counts.where(F.col("n") >= SHARED), "counts")
    frequent = _frequent(repeated.unionByName(counts))
    postings = cut_lineage(_postings(one, frequent, small, gram, percent), "postings")

    place = ["listed", "key"]
    head = F.min(F.struct("rank", "n", "id", "left")).alias("head")
    lists = postings.groupBy(*place).agg(head, F.count("*").alias("c")).where("c > 1")
    lists = lists.select(*place, "c", *[F.col(f"head.{c}").alias(f"hub_{c}") for c in ("id", "n", "left")])
    lists = cut_lineage(postings.join(lists, place), "lists")

    def pairs(rows: DataFrame, x: str, y: str) -> DataFrame:
        return rows.select(F.least(x, y).alias("a"), F.greatest(x, y).alias("b")).distinct()

    def near(n: str, left: str, other_n: str, other_left: str):
        """Whether two sets may be similar if an entry of both is the first that they share: then
        they share no more than either has from there on. A similar pair passes at that entry."""
        shared = F.lit(percent) * (F.col(n) + F.col(other_n))
        return F.least(F.col(left), F.col(other_left)) * (100 + percent) >= shared

    stars = lists.where(near("n", "left", "hub_n", "hub_left") & (F.col("id") != F.col("hub_id")))
    tested = cut_lineage(pairs(stars, "id", "hub_id"), "stars")
    links = cut_lineage(_verified(one, tested, gram, percent), "links")
    lists = lists.where("listed = 0").select("key", "c", "n", "id", "left")
    linked = cut_lineage(components(links), "linked")
    several = _across(lists, linked)

    def similar(met: DataFrame) -> DataFrame | None:
        """The similar ones of the pairs met; None if there are none, and components stay as they are."""
        if met.isEmpty():
            return None
        found = cut_lineage(_verified(one, met, gram, percent), "links")
        return None if found.isEmpty() else found

    for turn in range(ROUNDS):
        part = F.pmod(F.xxhash64("id"), F.ceil(F.col("c") / TOGETHER))
        order = W.partitionBy("key", part).orderBy(F.xxhash64(F.lit(turn), "key", "id"), "id")
        inside = F.when(F.col("component") == F.col("main"), F.struct("id", "n", "left"))
        before = F.last(inside, True).over(order.rowsBetween(W.unboundedPreceding, -1))
        met = several.withColumn("met", before).where("component != main AND met IS NOT NULL")
        met = met.where(near("n", "left", "met.n", "met.left")).withColumn("y", F.col("met.id"))
        met = cut_lineage(pairs(met, "id", "y").join(tested, ["a", "b"], "left_anti"), "met")
        tested, found = tested.union(met), similar(met)
        if found is not None:
            links = links.union(found)
            linked = cut_lineage(components(links), "linked")
        several = _across(lists, linked)

    # What is still apart: across components every pair of a list is compared.
    side = several.where("component != main").select(
        "key",
        F.col("id").alias("x"),
        F.col("n").alias("xn"),
        F.col("left").alias("x_left"),
        F.col("component").alias("xc"),
    )
    apart = (F.col("xc") != F.col("component")) & near("xn", "x_left", "n", "left")
    across = pairs(side.join(several, "key").where(apart), "x", "id")
    across = cut_lineage(across.join(tested, ["a", "b"], "left_anti"), "across")
    found = similar(across)
    if found is not None:
        linked = cut_lineage(components(links.union(found)), "linked")

    out = lookup_join(sets, linked.withColumnRenamed("id", "first"), ["first"], ["id"])
    return out.select(
        F.col("id").alias(id_col),
        F.col("n").alias("n_shingles"),
        F.coalesce("component", "first").alias("component_id"),
    )
