"""Benchmark items in documents, found by latent semantic retrieval.

Terms are the words of the benchmark. One pass over the texts writes each as a row of term numbers;
everything later reads that. Blocks of ``BLOCK`` words are weighted by TF-IDF over the whole corpus. A
randomised SVD finds the latent space: each task adds up its share of A'(AX) for a random X drawn
in the span of the items, Spark sums the shares by term, and the driver takes the singular directions
from that matrix of terms by ranks. Items longer than a window are also cut into parts that fit one.
Every window of two blocks is compared with every item and part by cosine. Where one comes near, and
holds enough of the words of the item or part in any order, the text around is checked for the whole
item by the longest common subsequence of words, within a stretch not much longer than the item. If nearly all words are there it is a copy; if most are, the end of the item, where its answer
stands, must be there too: then it is a paraphrase.

A large benchmark is gone through in groups of items (``MOST_TARGETS``): the texts are written as
terms and counted once, then each group has a latent space and a search of its own. Every task holds
the words of the benchmark and the items of one group; the driver holds all items. Documents are never
gathered anywhere.

Nulls and edge cases: null and empty texts hold nothing; items without words are never found, rows
that repeat an item are one; a row without an id is reported with a null id; an empty benchmark or
table gives an empty result. Only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.llm.common import cut_lineage, nothing_kept, shuffle_partitions, sliced, utf8
from gridloom.llm.words import NOT_IN_WORDS, word_arrays
from gridloom.operators.lookup import lookup_join

#: Items and parts of items that one search compares with; beyond it there are several searches.
MOST_TARGETS = 2_000
BLOCK = 24
RANK = 96
EXTRA = 8
#: A term in more than this part of all blocks and of all items, and in several items, says nothing
#: about an item.
COMMON, SEVERAL = 0.02, 5
#: Cosine at which a window is a candidate.
NEAR = 0.45
#: Part of the weights of an item, or of a part of it, that the words of a window must hold, whatever their order.
HELD = 0.35
CACHED = 1000
#: Windows times targets that are compared at once.
TOGETHER = 2_000_000
#: Parts of an item's words: a copy, and a paraphrase if the answer is there too.
COPY = 0.8
PARAPHRASE = 0.55
ANSWER = 0.75
#: The last part of an item, at least so many words.
ANSWER_PART, ANSWER_WORDS = 0.25, 3


def lcs(masks: dict[int, int], size: int, words: list[int]) -> int:
    """Length of the longest common subsequence, with one bit per word of the item."""
    whole = (1 << size) - 1
    row = whole
    for word in words:
        mask = masks.get(word)
        if mask is not None:
            hit = row & mask
            row = ((row + hit) | (row - hit)) & whole
    return size - row.bit_count()


class Item:
    """An item as term numbers, with the places of each for the subsequence check."""

    def __init__(self, key: int, terms: np.ndarray):
        self.key, self.terms, self.size = key, terms, len(terms)
        self.masks, self.own = self._masks(terms), np.unique(terms)
        #: Words of a stretch of text that is searched for the whole item.
        self.span = self.size + self.size // 4 + 4
        tail = terms[-max(min(ANSWER_WORDS, self.size), int(self.size * ANSWER_PART)) :]
        self.tail_masks, self.tail_size = self._masks(tail), len(tail)

    @staticmethod
    def _masks(terms: np.ndarray) -> dict[int, int]:
        masks: dict[int, int] = {}
        for i, t in enumerate(terms.tolist()):
            masks[t] = masks.get(t, 0) | 1 << i
        return masks

    def match(self, words: np.ndarray) -> tuple[float, float, int]:
        """Best part of the item's words in order, that of its end there, and where it begins; of the
        places that are a copy or a paraphrase, or else zeros."""
        best = (0.0, 0.0, 0)
        places = np.arange(0, max(1, len(words) - self.size // 2), max(1, self.size // 12))
        # No more words can stand in order than stand there at all.
        held = np.concatenate([[0], np.cumsum(np.isin(words, self.own))])
        most = held[np.minimum(places + self.span, len(words))] - held[places]
        for at in places[most / self.size >= PARAPHRASE].tolist():
            here = words[at : at + self.span].tolist()
            part = lcs(self.masks, self.size, here) / self.size
            if part > best[0] and part >= PARAPHRASE:
                end = lcs(self.tail_masks, self.tail_size, here) / self.tail_size
                if part >= COPY or end >= ANSWER:
                    best = (part, end, at)
        return best


class Benchmark:
    """Items, and their words as terms numbered from 1."""

    def __init__(self, rows: list[tuple[int, str | None]]):
        unique = list({(k, t) for k, t in rows if t})
        unique.sort(key=lambda r: (r[0] is None, r))
        words = list(word_arrays((t.encode() for _, t in unique), NOT_IN_WORDS))
        self.hashes = np.unique(np.concatenate(words)) if words else np.zeros(0, np.uint64)
        self.items = [
            Item(k, np.searchsorted(self.hashes, w) + 1)
            for (k, _), w in zip(unique, words, strict=True)
            if len(w)
        ]
        self.kind = np.uint16 if len(self.hashes) < 65_535 else np.uint32

    def terms(self, words: np.ndarray) -> np.ndarray:
        """Term numbers of words, 0 for words that are in no item."""
        if not len(self.hashes):
            return np.zeros(len(words), self.kind)
        at = np.minimum(np.searchsorted(self.hashes, words), len(self.hashes) - 1)
        return np.where(self.hashes[at] == words, at + 1, 0).astype(self.kind)


    def groups(self, most: int) -> Iterator[Group]:
        """The items in groups of at most ``most`` items and parts; a longer item is one by itself."""
        some, held = [], 0
        for item in self.items:
            parts = len(parts_of(item.terms))
            size = parts + (parts > 1)
            if some and held + size > most:
                yield Group(some, self)
                some, held = [], 0
            some.append(item)
            held += size
        if some:
            yield Group(some, self)


def parts_of(terms: np.ndarray) -> list[np.ndarray]:
    """The item, or parts of it that fit a window."""
    return np.array_split(terms, -(-len(terms) // (2 * BLOCK)))


class Group:
    """Some items of a benchmark, their terms numbered anew from 1."""

    def __init__(self, items: list[Item], benchmark: Benchmark):
        self.kind = benchmark.kind
        #: The benchmark's terms that are in these items, after the 0 of all others.
        self.known = np.unique(np.concatenate([[0], *[i.terms for i in items]])).astype(np.int64)
        self.number = np.zeros(len(benchmark.hashes) + 1, np.int32)
        self.number[self.known] = np.arange(len(self.known))
        self.items = [Item(i.key, self.number[i.terms]) for i in items]
        #: What windows are compared with: parts that fit one, then the items that were cut; and the
        #: item of each.
        cut = [parts_of(i.terms) for i in self.items]
        self.parts = sum(map(len, cut))
        whole = [n for n, parts in enumerate(cut) if len(parts) > 1]
        self.targets = [p for parts in cut for p in parts] + [self.items[n].terms for n in whole]
        self.item_of = np.array([n for n, parts in enumerate(cut) for _ in parts] + whole, np.int64)

    def laid(self, batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        """The texts of a batch in the group's terms one after the other, and where each begins."""
        terms, starts = _laid(batch, self.kind)
        return self.number[terms].astype(np.int64), starts


def term_weights(benchmark: Benchmark, blocks_with: np.ndarray, blocks: int) -> np.ndarray:
    items_with = np.zeros(len(benchmark.hashes) + 1)
    for item in benchmark.items:
        items_with[np.unique(item.terms)] += 1
    common = (blocks_with > COMMON * blocks) & (items_with > COMMON * len(benchmark.items))
    # A text that is copied often makes all words of the items in it frequent.
    common &= items_with >= SEVERAL
    # What is compared with windows keeps some weight.
    for item in benchmark.items:
        for part in (item.terms, *parts_of(item.terms)):
            if common[part].all():
                common[part] = False
    weights = np.log(1 + blocks / np.maximum(blocks_with, 1)).astype(np.float32)
    weights[common] = 0
    weights[0] = 0
    return weights


class Space:
    """Weights of terms and, once found, the latent directions."""

    def __init__(self, weights: np.ndarray):
        self.weights = weights
        self.basis: np.ndarray | None = None

    def triplets(self, terms: np.ndarray, starts: np.ndarray) -> tuple:
        """Block, term and weight of all blocks of texts laid one after the other; and their number.

        ``starts`` are the first words of the texts, and the end."""
        sizes = np.diff(starts)
        blocks = -(-sizes // BLOCK)
        first = np.concatenate([[0], np.cumsum(blocks)])
        place = np.arange(len(terms)) - np.repeat(starts[:-1], sizes)
        block = np.repeat(first[:-1], sizes) + place // BLOCK
        used = np.flatnonzero(self.weights[terms])
        keys, times = np.unique(block[used] * len(self.weights) + terms[used], return_counts=True)
        block, term = np.divmod(keys, len(self.weights))
        return block, term, times.astype(np.float32) * self.weights[term], first

    def project(self, block: np.ndarray, term: np.ndarray, weight: np.ndarray, n: int, to: np.ndarray):
        """Sum over each block's terms of weight times the term's row of ``to``."""
        out = np.zeros((n, to.shape[1]), np.float32)
        if len(block):
            starts = np.flatnonzero(np.r_[True, block[1:] != block[:-1]])
            # Parts that stay in the processor's cache.
            for at in range(0, len(starts), CACHED):
                some = starts[at : at + CACHED]
                end = starts[at + CACHED] if at + CACHED < len(starts) else len(block)
                rows = to[term[some[0] : end]] * weight[some[0] : end, None]
                out[block[some]] = np.add.reduceat(rows, some - some[0], axis=0)
        return out

    def of_targets(self, targets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Target, term and weight, in this order."""
        number = np.repeat(np.arange(len(targets)), [len(t) for t in targets])
        keys, times = np.unique(number * len(self.weights) + np.concatenate(targets), return_counts=True)
        target, term = np.divmod(keys, len(self.weights))
        weight = times.astype(np.float32) * self.weights[term]
        used = weight > 0
        return target[used], term[used], weight[used]


def unit(rows: np.ndarray) -> np.ndarray:
    length = np.linalg.norm(rows, axis=1, keepdims=True)
    return rows / np.where(length > 0, length, 1)


def _laid(batch: pa.RecordBatch, kind) -> tuple[np.ndarray, np.ndarray]:
    """The texts of a batch one after the other, and where each begins."""
    rows = [np.frombuffer(x.as_buffer(), kind) for x in batch.column("terms")]
    starts = np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int64)
    return (np.concatenate(rows) if rows else np.zeros(0, kind)).astype(np.int64), starts


def _term_rows(docs: DataFrame, shared: Broadcast) -> DataFrame:
    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nothing_kept()
        benchmark: Benchmark = shared.value
        for batch in sliced(batches):
            texts = (x.as_py() for x in batch.column("data"))
            found = [benchmark.terms(w).tobytes() for w in word_arrays(texts, NOT_IN_WORDS)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(found, pa.binary())], names=["id", "terms"]
            )

    kind = docs.schema["id"].dataType.simpleString()
    return docs.mapInArrow(number, f"id {kind}, terms binary")


def _block_counts(rows: DataFrame, shared: Broadcast) -> tuple[np.ndarray, int]:
    """In how many blocks each term stands; and the number of blocks, at term 0."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        benchmark: Benchmark = shared.value
        size = len(benchmark.hashes) + 1
        every = Space(np.ones(size, np.float32))
        every.weights[0] = 0
        total = np.zeros(size, np.int64)
        for batch in sliced(batches, 500):
            terms, starts = _laid(batch, benchmark.kind)
            _, term, _, first = every.triplets(terms, starts)
            total += np.bincount(term, minlength=size)
            total[0] += first[-1]
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(seen.astype(np.int32)), pa.array(total[seen])], names=["term", "n"]
        )

    summed = rows.mapInArrow(count, "term int, n long").groupBy("term").agg(F.sum("n").alias("n"))
    out = np.zeros(len(shared.value.hashes) + 1)
    # As many rows as the benchmark has words.
    for r in summed.collect():
        out[r.term] = r.n
    blocks = int(out[0])
    out[0] = 0
    return out, blocks


def _summed(shares: DataFrame, width: int) -> np.ndarray:
    """Rows of a matrix, summed over the shares of all tasks: place, and values as bytes."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, v in zip(batch.column("place").to_pylist(), batch.column("row"), strict=True):
                row = np.frombuffer(v.as_buffer(), np.float32).astype(np.float64)
                total[k] = total[k] + row if k in total else row
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(list(total), pa.int32()),
                pa.array([v.tobytes() for v in total.values()], pa.binary()),
            ],
            names=["place", "row"],
        )

    n = shuffle_partitions(shares.sparkSession)
    found = shares.repartition(n, "place").mapInArrow(add, "place int, row binary").collect()
    out = np.zeros((max([r.place for r in found], default=-1) + 1, width))
    for r in found:
        out[r.place] = np.frombuffer(r.row, np.float64)
    return out


def _shares(matrix: np.ndarray) -> pa.RecordBatch:
    used = np.flatnonzero(np.abs(matrix).sum(1))
    return pa.RecordBatch.from_arrays(
        [
            pa.array(used.astype(np.int32)),
            pa.array([matrix[i].astype(np.float32).tobytes() for i in used], pa.binary()),
        ],
        names=["place", "row"],
    )


def latent_space(rows: DataFrame, space: Space, group: Group, rank: int) -> np.ndarray:
    """Terms by ranks: the leading right singular vectors of the weighted blocks."""
    context = rows.sparkSession.sparkContext
    target, term, weight = space.of_targets(group.targets[: group.parts])
    length = np.sqrt(np.bincount(target, weight * weight, minlength=group.parts))
    width = min(rank + EXTRA, max(1, group.parts))
    draw = np.random.default_rng(7).standard_normal((group.parts, width))
    start = np.zeros((len(space.weights), width))
    for at in range(0, len(term), 20_000):
        some = slice(at, at + 20_000)
        share = weight[some] / length[target[some]]
        np.add.at(start, term[some], draw[target[some]] * share[:, None])
    start = np.linalg.qr(start)[0]
    width = start.shape[1]
    sketch = context.broadcast((group, space, start.astype(np.float32)))

    def blocks_of(batches: Iterator[pa.RecordBatch], group: Group, space: Space):
        for batch in sliced(batches, 500):
            block, term, weight, first = space.triplets(*group.laid(batch))
            length = np.sqrt(np.bincount(block, weight * weight, minlength=int(first[-1])))
            yield block, term, (weight / length[block]).astype(np.float32), int(first[-1])

    def pull(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, space, to = sketch.value
        total = np.zeros(to.shape, np.float32)
        for block, term, weight, n in blocks_of(batches, group, space):
            z = space.project(block, term, weight, n, to)
            order = np.argsort(term, kind="stable")
            term, starts = np.unique(term[order], return_index=True)
            for at in range(0, len(term), CACHED):
                some = starts[at : at + CACHED]
                end = starts[at + CACHED] if at + CACHED < len(starts) else len(order)
                use = order[some[0] : end]
                values = z[block[use]] * weight[use, None]
                total[term[at : at + CACHED]] += np.add.reduceat(values, some - some[0], axis=0)
        yield _shares(total)

    pulled = _summed(rows.mapInArrow(pull, "place int, row binary"), width)
    sketch.destroy()
    pulled = np.vstack([pulled, np.zeros((len(space.weights) - len(pulled), width))])
    # One pass is enough for a symmetric matrix: its singular vectors follow from what it makes of
    # the sketch (Nystrom), a little of which keeps directions that no document has.
    pulled += max(1e-3, 1e-6 * np.linalg.norm(pulled)) * start
    inner = start.T @ pulled
    half = np.linalg.cholesky((inner + inner.T) / 2)
    left, _, _ = np.linalg.svd(np.linalg.solve(half, pulled.T).T, full_matrices=False)
    return left[:, :rank].astype(np.float32)


def _search(rows: DataFrame, shared: Broadcast, near: float) -> DataFrame:
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nothing_kept()
        group, space = shared.value
        number = len(group.targets)
        target, term, weight = space.of_targets(group.targets)
        targets = unit(space.project(target, term, weight, number, space.basis)).T
        # (target, term) in order, and the term's part of the target's weights.
        own = target * len(space.weights) + term
        worth = weight / np.bincount(target, weight, minlength=number)[target]
        together = max(1, TOGETHER // number)
        for batch in sliced(batches, 500):
            terms, starts = group.laid(batch)
            block, term, weight, first = space.triplets(terms, starts)
            z = space.project(block, term, weight, int(first[-1]), space.basis)
            # A window is a block and the next one of the same text.
            following = np.zeros_like(z)
            following[:-1] = z[1:]
            following[first[1:] - 1] = 0
            windows = unit(z + following)
            # Stretches of a document that may hold an item; those that overlap are one.
            around: dict[tuple[int, int], list[list[int]]] = {}
            begins = np.searchsorted(block, np.arange(int(first[-1]) + 1))
            for at in range(0, len(windows), together):
                where, which = np.nonzero(windows[at : at + together] @ targets >= near)
                where += at
                docs = np.searchsorted(first, where, side="right") - 1
                # The terms of a window's one or two blocks stand side by side.
                low, high = begins[where], begins[np.minimum(where + 2, first[docs + 1])]
                sizes = high - low
                place = np.arange(sizes.sum()) + np.repeat(low - (np.cumsum(sizes) - sizes), sizes)
                pairs = np.repeat(which, sizes) * len(space.weights) + term[place]
                spot = np.minimum(np.searchsorted(own, pairs), len(own) - 1)
                held = np.where(own[spot] == pairs, worth[spot], 0)
                held = np.bincount(np.repeat(np.arange(len(where)), sizes), held, minlength=len(where))
                likely = held >= HELD
                found = (where[likely].tolist(), docs[likely].tolist(), group.item_of[which[likely]].tolist())
                for w, d, i in zip(*found, strict=True):
                    item = group.items[i]
                    begin = starts[d] + (w - first[d]) * BLOCK
                    low = int(max(starts[d], begin - item.span))
                    high = int(min(starts[d + 1], begin + 2 * BLOCK + item.span))
                    seen = around.setdefault((d, i), [])
                    if seen and low <= seen[-1][1]:
                        seen[-1][1] = high
                    else:
                        seen.append([low, high])
            hits: dict[tuple[int, int], tuple[float, float, int]] = {}
            for (d, i), seen in around.items():
                for low, high in seen:
                    best = group.items[i].match(terms[low:high])
                    if best[0] > hits.get((d, i), (0.0,))[0]:
                        hits[d, i] = (best[0], best[1], int(low - starts[d]) + best[2])
            kept = [
                (d, group.items[i].key, part, end, at)
                for (d, i), (part, end, at) in hits.items()
            ]
            columns = list(zip(*kept, strict=True)) or [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id").take(pa.array(columns[0], pa.int32())),
                    pa.array(columns[1], pa.int64()),
                    pa.array(columns[2], pa.float64()),
                    pa.array(columns[3], pa.float64()),
                    pa.array(columns[4], pa.int64()),
                ],
                names=["id", "item", "matched", "answer", "word"],
            )

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(
        search, f"id {kind}, item long, matched double, answer double, word long"
    )


def contaminated(
    df: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    rank: int = RANK,
    near: float = NEAR,
    most_targets: int = MOST_TARGETS,
) -> DataFrame:
    """One row per document and item in it: id, item_id, matched and answer (parts of the item's
    words and of its end), word (place in the text) and kind (copy or paraphrase)."""
    spark = df.sparkSession
    named = benchmark.select(F.col(f"`{item_col}`").cast("long"), F.lower(f"`{item_text_col}`"))
    known = Benchmark([tuple(r) for r in named.collect()])
    shared = spark.sparkContext.broadcast(known)
    docs = df.select(F.col(f"`{id_col}`").alias("id"), utf8(F.lower(f"`{text_col}`")).alias("data"))
    out = f"`{id_col}` {docs.schema['id'].dataType.simpleString()}, item_id long, matched double"
    out += ", answer double, word long, kind string"
    if not known.items:
        return spark.createDataFrame([], out)
    rows = cut_lineage(_term_rows(docs, shared), "terms")
    counts, blocks = _block_counts(rows, shared)
    if not blocks:
        return spark.createDataFrame([], out)
    weights = term_weights(known, counts, blocks)
    hits = []
    for group in known.groups(most_targets):
        space = Space(weights[group.known])
        space.basis = latent_space(rows, space, group, rank)
        held = spark.sparkContext.broadcast((group, space))
        # Written, so that only one group is held at a time.
        hits.append(cut_lineage(_search(rows, held, near), "hits"))
        held.destroy()
    found = reduce(DataFrame.unionByName, hits)
    kind = F.when(F.col("matched") >= COPY, "copy").otherwise("paraphrase")
    return found.select(
        F.col("id").alias(id_col),
        F.col("item").alias("item_id"),
        "matched",
        "answer",
        "word",
        kind.alias("kind"),
    )


def without_contaminated(df: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", **other) -> DataFrame:
    """The rows of ``df`` in which no item was found, with all columns."""
    found = contaminated(df, benchmark, id_col=id_col, **other).select(id_col).distinct()
    return lookup_join(df, cut_lineage(found, "found"), [id_col], [id_col], "left_anti")
