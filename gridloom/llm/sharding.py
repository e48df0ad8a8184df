"""Shards of nearly equal bytes that never split a group of equal texts.

The groups stand in the order of their content hash. A shard is a contiguous stretch of that order,
and the capacity of the fullest shard is the smallest possible: binary search over capacities, each
checked greedily, then cut greedily at the one found. A greedy check only needs, for a start and a
capacity, the last prefix sum that still fits. The driver never sees all prefix sums: it starts from
one value per block, which brackets the capacity and every cut, then asks for the values inside
the brackets only, again in blocks, until what is left inside fits in ``values`` numbers. The result
is exact. A group larger than an equal share of what is left takes a shard for itself.

Nulls and edge cases: a null text has no bytes, and its group is that of the empty text; null ids
come first in their group; repeated rows are numbered one after the other; an empty table gives an
empty result. Only the named columns are read, so others may have any name.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from gridloom.llm.common import PID, cut_lineage, numbered_in_order, shuffle_partitions, utf8

#: Bytes that each row counts besides its text.
ROW_BYTES = 8
#: Prefix sums the driver holds at a time.
VALUES = 65_536


def greedy(prefix: np.ndarray, capacity: int, start: int, shards: int) -> list[int]:
    """Where greedy shards of at most ``capacity`` end among the ascending ``prefix`` sums."""
    cuts, at = [], start
    for _ in range(shards):
        i = int(np.searchsorted(prefix, at + capacity, side="right")) - 1
        at = max(at, int(prefix[i])) if i >= 0 else at
        cuts.append(at)
    return cuts


def smallest(prefix: np.ndarray, low: int, high: int, start: int, shards: int) -> int:
    """The smallest capacity in [low, high] with which greedy shards reach the last prefix sum."""
    end = int(prefix[-1])
    while low < high:
        middle = (low + high) // 2
        if greedy(prefix, middle, start, shards)[-1] >= end:
            high = middle
        else:
            low = middle + 1
    return high


def minimax_cuts(sums: DataFrame, total: int, largest: int, shards: int, values: int) -> list[int]:
    """Prefix sums (column ``upto``) at which the shards of the smallest capacity end."""
    if not total:
        return [0] * shards
    known = np.array([0, total], dtype=np.int64)
    low, high = max(largest, -(-total // shards)), total
    inside, step = [(0, total)], 2 * total
    while True:
        # The last sum of each block of ``step`` in the open stretches.
        width = sum(b - a for a, b in inside)
        step = max(1, min(width // values, step // 2))
        some = F.lit(False)
        for a, b in inside:
            some = some | ((F.col("upto") > a) & (F.col("upto") <= b))
        blocks = sums.where(some).groupBy(F.floor((F.col("upto") - 1) / F.lit(step)).alias("b"))
        found = blocks.agg(F.max("upto").alias("upto"), F.count("*").alias("n")).toPandas()
        known = np.unique(np.concatenate([known, found["upto"].to_numpy(np.int64)]))
        # Some of the sums allow no better shards than all of them; and cuts among all sums, moved
        # to the ends of their blocks, add less than a block to each shard.
        high = smallest(known, low, high, 0, shards)
        if (found["n"] == 1).all():
            return greedy(known, high, 0, shards)
        low = max(low, high - step + 1)
        # Whatever capacity in [low, high] is the smallest, its cuts lie in these stretches.
        least, most = greedy(known, low, 0, shards), greedy(known, high + step, 0, shards)
        inside = _merged(list(zip(least, most, strict=True)))


def _merged(stretches: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(stretches):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _running(groups: DataFrame) -> DataFrame:
    """Groups in the order of their key with the bytes up to and including each."""
    n = shuffle_partitions(groups.sparkSession)
    placed = groups.repartitionByRange(n, "key").withColumn(PID, F.spark_partition_id())
    placed = cut_lineage(placed, "groups")
    # As many rows as partitions.
    sums = placed.groupBy(PID).agg(F.sum("bytes").alias("__n"))
    before = W.orderBy(PID).rowsBetween(W.unboundedPreceding, -1)
    starts = sums.select(PID, F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__off"))
    inside = W.partitionBy(PID).orderBy("key").rowsBetween(W.unboundedPreceding, W.currentRow)
    upto = F.sum("bytes").over(inside) + F.col("__off")
    return placed.join(F.broadcast(starts), PID).select("key", "bytes", upto.alias("upto"))


def shard_documents(
    df: DataFrame,
    shards: int = 24,
    id_col: str = "doc_id",
    text_col: str = "text",
    values: int = VALUES,
) -> DataFrame:
    """Each row with size, text_crc32, law, shard, slot and grown_shard."""
    data = utf8(F.col(f"`{text_col}`"))
    rows = df.select(
        F.col(f"`{id_col}`").alias("id"),
        (F.octet_length(data) + ROW_BYTES).cast("long").alias("size"),
        F.crc32(data).alias("text_crc32"),
        F.unhex(F.sha2(data, 256)).alias("key"),
    )
    rows = cut_lineage(rows, "sizes")
    groups = cut_lineage(rows.groupBy("key").agg(F.sum("size").alias("bytes")), "groups")
    total, largest = groups.agg(F.coalesce(F.sum("bytes"), F.lit(0)), F.max("bytes")).first()
    # Groups above an equal share; fewer than there are shards.
    alone: list[tuple[bytes, int]] = []
    big = groups.where(F.col("bytes") > total // shards).orderBy(F.desc("bytes"), "key")
    left, rest = shards, total
    for r in big.collect() if total else []:
        if left > 1 and r.bytes > rest / left:
            alone.append((bytes(r.key), shards - left))
            left, rest = left - 1, rest - r.bytes
    ordered = groups
    if alone:
        ordered = groups.where(~F.col("key").isin([k for k, _ in alone]))
        largest = ordered.agg(F.max("bytes")).first()[0]
    sums = cut_lineage(_running(ordered), "sums")
    cuts = minimax_cuts(sums, rest, largest or 0, left, values)
    # The key at which each shard ends: at most as many rows as shards.
    ends = sums.where(F.col("upto").isin(sorted(set(cuts)))).collect()
    last = sorted(bytes(r.key) for r in ends)[:-1]
    shard = F.lit(shards - left)
    for key in last:
        shard = shard + (F.col("key") > F.lit(key)).cast("int")
    for key, own in alone:
        shard = F.when(F.col("key") == F.lit(key), own).otherwise(shard)
    placed = rows.withColumn("shard", shard)
    numbered = numbered_in_order(placed, ["shard", "key", "id"], ["shard"], "slot", "slots")
    return numbered.select(
        F.col("id").alias(id_col),
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        F.col("shard").cast("int"),
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
