"""Ranked lexical search: the best documents for each item, by sorted reads without random access (NRA).

A document's terms are the maximal runs of ASCII letters, digits and non-ASCII characters, A to Z in lower
case. The items' terms are looked up in every whole text; what is found is written as one row per document
(its number of terms and, per term found, how often), from which the corpus counts follow.

Documents are then searched in shards of bounded size within Spark's tasks. A shard holds, per term, its
documents sorted by falling impact (what the term adds to the score). For an item all lists are read down to
the same impact, which falls from round to round. What was read of a document is the lower bound of its score;
with the impact reached in the lists where it was not seen yet it gives the upper bound. Documents whose upper
bound is below the lower bound of the task's tenth best are out; reading goes on until no document, seen or
not, can still join or tie, and the scores of those that stay are complete. A task carries the tenth best score of each item
from shard to shard, so later shards are read less deep. The best of each task meet in two windows, ten
rows per task and item.

Scores are whole numbers: a term's weight is w = floor(1000 ln((2N + 2) / (2 df + 1))), its impact
w * (10^9 tf div (1000 tf + 8 m)) with m = 10 + (90 n N) div L, for N documents with terms, L terms in all, n in
this one. Equal scores go by the smaller id; only scores above 0 count.

Items are gone through in groups of at most ``GROUP_BYTES`` of text, each with a pass over the documents, so
that what is broadcast stays bounded however many there are.

Nulls and edge cases: a null or empty text has no terms and is never found; a null or empty item finds nothing;
repeated terms of an item count once; documents that repeat an id are ranked one by one, a null id after all
others of its score; items that repeat an id are searched together, each as a row of its own. Empty tables give an
empty result. Only the named columns are read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from gridloom.llm.common import cut_lineage

#: Best documents of an item.
BEST = 10
#: Bytes of item texts that are searched together.
GROUP_BYTES = 16 << 20
#: Postings and documents of a shard; a document is never split.
SHARD_POSTINGS, SHARD_DOCS = 1_500_000, 20_000
#: The impact down to which lists are read falls by this factor from round to round.
FALL = 0.7
#: Tasks whose best rows are brought together first.
TASKS_TOGETHER = 64

#: Everything but ASCII letters, digits and the bytes of other characters ends a term.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))


def terms(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


def _found(batches: Iterator[pa.RecordBatch], number: dict[bytes, int]) -> Iterator[pa.RecordBatch]:
    """Per document with a term: id, number of terms, the items' terms in it with their frequency."""
    get = number.get
    for batch in batches:
        keep, n, of, tf, ends = [], [], [], [], [0]
        for row, text in enumerate(batch.column("text")):
            words = terms(text.as_py() or b"")
            if words:
                count = Counter(map(get, words))
                count.pop(None, None)
                keep.append(row)
                n.append(len(words))
                of += count.keys()
                tf += count.values()
                ends.append(len(of))
        lists = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(x, pa.int32())) for x in (of, tf)]
        ident = batch.column("id").take(pa.array(keep, pa.int64()))
        yield pa.RecordBatch.from_arrays([ident, pa.array(n, pa.int64()), *lists], ["id", "n", "term", "tf"])


class Shard:
    """Documents of a shard with their lists: per term, falling impacts and the documents they belong to."""

    def __init__(
        self, n: np.ndarray, ends: np.ndarray, term: np.ndarray, tf: np.ndarray, weight: np.ndarray, docs: int, total: int
    ):
        self.size = len(n)
        doc = np.repeat(np.arange(self.size, dtype=np.int32), np.diff(ends))
        m = 10 + (90 * n * docs) // total
        tf = tf.astype(np.int64)
        impact = weight[term] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m[doc]))
        some = impact > 0
        term, doc, impact = term[some], doc[some], impact[some]
        order = np.lexsort((-impact, term))
        self.impact, self.doc = impact[order], doc[order]
        self.start = np.searchsorted(term[order], np.arange(len(weight) + 1))
        # Falling impacts as rising keys, for searches.
        self.falling = -self.impact

    def search(self, wanted: np.ndarray, floor: int, best: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents and scores of all that may be among the ``best``, given that a score below ``floor`` is not."""
        first, last = self.start[wanted], self.start[wanted + 1]
        some = first < last
        first, last = first[some], last[some]
        empty = np.zeros(0, np.int64)
        if not len(first):
            return empty, empty
        at, bound = first.copy(), self.impact[first]
        if bound.sum() < floor:
            return empty, empty
        lists = range(len(first))
        low = np.zeros(self.size, np.int64)
        # What the unread rest of the lists where a document was not seen can add at most: all bounds less those of
        # the lists where it was seen.
        seen = np.zeros((len(first), self.size), bool)
        level = int(bound.max())
        while True:
            level = int(level * FALL)
            for i in lists:
                if bound[i] > level:
                    # A list's last reads end it, whatever the level.
                    to = at[i] + int(np.searchsorted(self.falling[at[i] : last[i]], -level))
                    doc = self.doc[at[i] : to]
                    low[doc] += self.impact[at[i] : to]
                    seen[i, doc] = True
                    at[i] = to
                    bound[i] = self.impact[to] if to < last[i] else 0
            rest = int(bound.sum())
            if self.size > best:
                floor = max(floor, int(np.partition(low, -best)[-best]))
            if rest >= max(floor, 1):
                # A document that was not seen at all may still come in.
                continue
            open_docs = np.flatnonzero((low > 0) & (low + rest >= floor))
            if rest == 0:
                return open_docs, low[open_docs]
            high = low[open_docs] + rest - bound @ seen[:, open_docs]
            open_docs, high = open_docs[high >= floor], high[high >= floor]
            if (high == low[open_docs]).all():
                return open_docs, low[open_docs]


def _search(
    batches: Iterator[pa.RecordBatch],
    queries: list[np.ndarray],
    weight: np.ndarray,
    docs: int,
    total: int,
    best: int,
    shard_docs: int = SHARD_DOCS,
) -> Iterator[pa.RecordBatch]:
    """The best rows of a task: place of the item, id, score."""
    floors = [1] * len(queries)
    tops: list[list[tuple[int, bool, int]]] = [[] for _ in queries]

    def through(parts: list[pa.RecordBatch]) -> None:
        rows = pa.Table.from_batches(parts).combine_chunks()
        lists = [rows.column(c).combine_chunks() for c in ("term", "tf")]
        ends = np.concatenate([[0], np.cumsum(np.asarray(lists[0].value_lengths()))])
        term, tf = (np.asarray(x.flatten()) for x in lists)
        shard = Shard(np.asarray(rows.column("n")), ends, term, tf, weight, docs, total)
        ident = rows.column("id")
        for place, wanted in enumerate(queries):
            found, scores = shard.search(wanted, floors[place], best)
            if len(found):
                ids = ident.take(pa.array(found)).to_pylist()
                new = [(-s, i is None, i) for s, i in zip(scores.tolist(), ids, strict=True)]
                tops[place] = sorted(tops[place] + new, key=lambda r: (r[0], r[1], 0 if r[1] else r[2]))[:best]
                if len(tops[place]) == best:
                    floors[place] = max(1, -tops[place][-1][0])

    held, postings, many, kind = [], 0, 0, None
    for batch in batches:
        kind = batch.schema.field("id").type
        step = min(1000, shard_docs)
        for at in range(0, batch.num_rows, step):
            part = batch.slice(at, step)
            held.append(part)
            many += part.num_rows
            postings += len(part.column("term").flatten())
            if postings >= SHARD_POSTINGS or many >= shard_docs:
                through(held)
                held, postings, many = [], 0, 0
    if held:
        through(held)
    rows = [(place, i, -s) for place, top in enumerate(tops) for s, _, i in top]
    if rows:
        place, ids, scores = zip(*rows, strict=True)
        yield pa.RecordBatch.from_arrays(
            [pa.array(place, pa.int64()), pa.array(ids, kind), pa.array(scores, pa.int64())], ["place", "id", "score"]
        )


def _groups(items: DataFrame, group_bytes: int) -> list[int]:
    """How many groups the items are dealt into, so that each has about ``group_bytes`` of text."""
    size = items.agg(F.coalesce(F.sum(F.octet_length("text") + 16), F.lit(0))).first()[0]
    return list(range(max(1, -(-size // group_bytes))))


def search_items(
    docs: DataFrame,
    items: DataFrame,
    best: int = BEST,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    group_bytes: int = GROUP_BYTES,
    shard_docs: int = SHARD_DOCS,
) -> DataFrame:
    """item, rank (from 1), id, score of the ``best`` documents of each item."""
    spark = docs.sparkSession
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("binary").alias("text"))
    wanted = items.select(F.col(f"`{item_col}`").alias("item"), F.col(f"`{item_text_col}`").cast("binary").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    item_kind = wanted.schema["item"].dataType.simpleString()
    groups = _groups(wanted, group_bytes)
    dealt = F.pmod(F.xxhash64("item", "text"), F.lit(len(groups)))
    hits = None
    for group in groups:
        # About GROUP_BYTES of text.
        here = wanted.where(dealt == group).where("text IS NOT NULL").collect()
        number: dict[bytes, int] = {}
        queries = [np.array(sorted({number.setdefault(t, len(number)) for t in terms(bytes(r.text))}), np.int64) for r in here]
        found = rows.mapInArrow(
            lambda batches, number=number: _found(batches, number), f"id {kind}, n long, term array<int>, tf array<int>"
        )
        found = cut_lineage(found, "terms-found")
        n_docs, total = found.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
        if not n_docs:
            continue
        weight = np.zeros(len(number), np.int64)
        # One row per term of the group.
        for term, df in found.select(F.explode("term").alias("t")).groupBy("t").count().collect():
            weight[term] = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))
        best_of_tasks = found.mapInArrow(
            lambda batches, q=queries, w=weight, n=n_docs, t=total: _search(batches, q, w, n, t, best, shard_docs),
            f"place long, id {kind}, score long",
        )
        named = spark.createDataFrame([(i, r.item) for i, r in enumerate(here)], f"place long, item {item_kind}")
        # One row per item of the group.
        here_hits = best_of_tasks.withColumn("task", F.spark_partition_id()).join(F.broadcast(named), "place")
        here_hits = here_hits.withColumn("group", F.lit(group))
        hits = here_hits if hits is None else hits.unionByName(here_hits)
    if hits is None:
        return spark.createDataFrame([], f"`{item_col}` {item_kind}, rank int, `{id_col}` {kind}, score long")
    order = [F.desc("score"), F.asc_nulls_last("id")]
    some = W.partitionBy("group", "place", F.floor(F.col("task") / TASKS_TOGETHER)).orderBy(*order)
    hits = hits.withColumn("rank", F.row_number().over(some)).where(F.col("rank") <= best)
    ranked = hits.withColumn("rank", F.row_number().over(W.partitionBy("group", "place").orderBy(*order)))
    return ranked.where(F.col("rank") <= best).select(
        F.col("item").alias(item_col), "rank", F.col("id").alias(id_col), "score"
    )
