"""Repeated runs of lines, by a suffix array over line numbers.

Lines are the letters, documents the texts. Prefix doubling ranks all suffixes: ranks of runs of
2k lines are those of pairs of runs of k lines, in order, numbered by a distributed sort. Only
suffixes whose run occurs again go on, so each round is smaller. Suffixes that share their first lines
stand together in that order, in an interval of their longest common prefix. A line belongs to a
repeated run of at least ``WORDS`` words exactly if the shortest such run that starts or ends somewhere
covers it and occurs again; so the intervals looked up are those of shortest runs, whose length follows
from their first or last line alone. In an interval the first suffix of the corpus (by id and line) is the
original. The other ones are copies, and the lines that they cover are deleted: together, these are the
maximal repeated runs.

Lines are told apart by 128 bits of their hash. Joins go by document and line, so no task holds a
frequent line; counts of a run are combined before the shuffle.

Nulls and edge cases: a null text has no lines and stays null; an empty one has one empty line; rows
without an id are returned as they are and are not compared; rows that repeat id and text are one
document; white space at the ends of a line does not matter; a text all of whose lines are copies
becomes empty; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from gridloom.llm.common import cut_lineage, numbered_in_order, sliced
from gridloom.operators.lookup import lookup_join

#: Words of the shortest run that is deleted.
WORDS = 50
_DOC = ["id", "h"]


def lines_of(df: DataFrame, id_col: str, text_col: str, words: int = WORDS) -> DataFrame:
    """id, h (of the whole text), line (from 0), k1 and k2 (the line's hash), and the lines of the
    shortest runs of ``words`` words that start (ahead) and end (back) there, null if none does."""
    text = F.col(f"`{text_col}`")
    docs = df.select(F.col(f"`{id_col}`").alias("id"), text.alias("text"), F.xxhash64(text).alias("h"))
    docs = docs.where("id IS NOT NULL AND text IS NOT NULL").select(*_DOC, F.col("text").cast("binary"))
    names = [*_DOC, "line", "k1", "k2", "ahead", "back"]
    kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int32()]

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            index, columns = [], [[] for _ in kinds]
            for i, data in enumerate(batch.column("text")):
                lines = [line.strip() for line in data.as_py().split(b"\n")]
                keys = [xxhash.xxh3_128_intdigest(line) for line in lines]
                sizes = np.array([len(line.split()) for line in lines])
                upto, n = np.cumsum(sizes), np.arange(len(lines))
                begin = upto - sizes
                last = np.searchsorted(upto, begin + words)
                first = np.searchsorted(begin, upto - words, side="right") - 1
                index += [i] * len(lines)
                columns[0] += n.tolist()
                columns[1] += [(k >> 64) - (1 << 63) for k in keys]
                columns[2] += [k % (1 << 64) - (1 << 63) for k in keys]
                columns[3] += [e - p + 1 if e < len(lines) else None for p, e in enumerate(last.tolist())]
                columns[4] += [e - b + 1 if b >= 0 else None for e, b in enumerate(first.tolist())]
            rows = pa.array(index, pa.int32())
            made = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([*[batch.column(c).take(rows) for c in _DOC], *made], names=names)

    kind = docs.schema["id"].dataType.simpleString()
    schema = f"id {kind}, h long, line int, k1 long, k2 long, ahead int, back int"
    return docs.mapInArrow(split, schema).dropDuplicates([*_DOC, "line"])


def _numbered(runs: DataFrame, keys: list[str]) -> DataFrame:
    """The runs (id, h, line, keys) that occur again, with their rank among these."""
    counts = runs.groupBy(*keys).agg(F.count("*").alias("c")).where("c > 1").select(*keys)
    ranks = cut_lineage(numbered_in_order(counts, keys, [], "place", "ranks"), "ranks")
    found = lookup_join(runs, ranks, keys, [*_DOC, "line"], "inner")
    return cut_lineage(found.select(*_DOC, "line", F.col("place").alias("rank")), "ranked")


def suffix_ranks(lines: DataFrame, longest: int) -> DataFrame | None:
    """k, id, h, line and rank: of each run of 2 ** k lines that occurs again, up to ``longest``."""
    level = _numbered(lines.select(*_DOC, "line", "k1", "k2"), ["k1", "k2"])
    out, k = None, 0
    while not level.isEmpty():
        named = level.select(F.lit(k).alias("k"), *_DOC, "line", "rank")
        out = named if out is None else out.unionByName(named)
        size = 1 << k
        if 2 * size > longest:
            break
        second = level.select(*_DOC, (F.col("line") - size).alias("line"), F.col("rank").alias("next"))
        level = _numbered(level.join(second, [*_DOC, "line"]), ["rank", "next"])
        k += 1
    return out


def copied_lines(lines: DataFrame) -> DataFrame:
    """id, h and line of the lines to delete; lines are those of ``lines_of``."""
    place = [*_DOC, "line"]
    none = lines.select(*place).limit(0)
    ahead = lines.where("ahead IS NOT NULL").select(*place, F.col("ahead").alias("run"))
    back = lines.where("back IS NOT NULL").select(
        *_DOC, (F.col("line") - F.col("back") + 1).alias("line"), F.col("back").alias("run")
    )
    runs = ahead.unionByName(back).distinct()
    longest = runs.agg(F.max("run")).first()[0]
    ranks = suffix_ranks(lines, longest) if longest else None
    if ranks is None:
        return none
    # Two runs of 2 ** k lines, which may overlap, cover a run.
    runs = runs.withColumn("k", F.floor(F.log2("run")).cast("int"))
    runs = runs.withColumn("at", F.col("line") + F.col("run") - F.pow(F.lit(2), "k").cast("int"))
    second = ranks.select("k", *_DOC, F.col("line").alias("at"), F.col("rank").alias("next"))
    runs = runs.join(ranks, ["k", *place]).join(second, ["k", *_DOC, "at"])
    runs = cut_lineage(runs.select(*place, "run", "rank", "next"), "runs")
    same = ["run", "rank", "next"]
    head = F.min(F.struct(*place)).alias("head")
    heads = runs.groupBy(*same).agg(head, F.count("*").alias("c")).where("c > 1")
    heads = cut_lineage(heads.select(*same, "head"), "heads")
    copies = lookup_join(runs, heads, same, place, "inner").where(F.struct(*place) != F.col("head"))
    copies = copies.groupBy(*place).agg((F.col("line") + F.max("run") - 1).alias("last"))
    copies = cut_lineage(copies, "copies")
    touched = lines.select(*place).join(copies.select(*_DOC).distinct(), _DOC, "left_semi")
    by_line = W.partitionBy(*_DOC).orderBy("line")
    reach = F.max("last").over(by_line.rowsBetween(W.unboundedPreceding, W.currentRow))
    covered = touched.join(copies, place, "left").withColumn("reach", reach)
    return covered.where("reach >= line").select(*place)


def dedup_lines(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS
) -> DataFrame:
    """The rows of ``df`` with the copied lines taken out of the text, and how many (last column,
    ``removed_lines``)."""
    lines = cut_lineage(lines_of(df, id_col, text_col, words), "lines")
    numbers = F.array_join(F.sort_array(F.collect_set("line")).cast("array<string>"), ",")
    gone = copied_lines(lines).groupBy(*_DOC).agg(
        F.concat(F.lit(","), numbers, F.lit(",")).alias("__gone"), F.count_distinct("line").alias("__n")
    )
    gone = cut_lineage(gone, "gone").withColumnsRenamed({"id": "__id", "h": "__h"})
    text = F.col(f"`{text_col}`")
    keyed = df.withColumns({"__id": F.col(f"`{id_col}`"), "__h": F.xxhash64(text)})
    # Short rows for the documents with copies only; the texts stay where they are while these fit.
    joined = lookup_join(keyed, gone, ["__id", "__h"], ["__id"])
    taken = lambda i: F.contains("__gone", F.concat(F.lit(","), i.cast("string"), F.lit(",")))
    kept = F.filter(F.split(text, "\n"), lambda x, i: ~taken(i))
    cleaned = F.when(F.col("__gone").isNull(), text).otherwise(F.array_join(kept, "\n"))
    others = [cleaned.alias(c) if c == text_col else F.col(f"`{c}`") for c in df.columns]
    return joined.select(*others, F.coalesce("__n", F.lit(0)).cast("long").alias("removed_lines"))
