"""What several operators share: parameters of the session, slim numbering, batches in tasks."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from gridloom.session import cut_lineage, scratch_path

__all__ = [
    "WordCache",
    "cut_lineage",
    "kept",
    "nothing_kept",
    "numbered_in_order",
    "scratch_path",
    "shuffle_partitions",
    "sliced",
    "table",
    "utf8",
]

PID = "__pid"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def utf8(text: Column) -> Column:
    """The text's bytes, none for null."""
    return F.coalesce(text, F.lit("")).cast("binary")


def numbered_in_order(
    df: DataFrame, order: list[str], within: list[str], out: str, name: str = "ordered"
) -> DataFrame:
    """Gapless numbers from 0 within each value of ``within``, whose columns must lead ``order``
    or be monotone in it.

    Rows are range-partitioned by the whole order, so one value of ``within`` may span many tasks;
    the table is written, and one count per (task, value) is carried over the tasks. As the order
    is global, a task shares at most its first and last values with others: there are about as many
    counts as tasks and values together, and values must be few.
    """
    n = shuffle_partitions(df.sparkSession)
    placed = df.repartitionByRange(n, *order).sortWithinPartitions(*order)
    placed = cut_lineage(placed.withColumn(PID, F.spark_partition_id()), name)
    counts = placed.groupBy(*within, PID).agg(F.count("*").alias("__n"))
    before = W.partitionBy(*within).orderBy(PID).rowsBetween(W.unboundedPreceding, -1)
    offsets = counts.select(
        *within, PID, F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__off")
    )
    inside = W.partitionBy(*within, PID).orderBy(*order)
    numbered = placed.withColumn(out, F.row_number().over(inside) - 1)
    same = [numbered[c].eqNullSafe(offsets[c]) for c in (*within, PID)]
    # As many rows as tasks and values of ``within`` together.
    joined = numbered.join(F.broadcast(offsets), same)
    kept = [numbered[c] for c in df.columns]
    return joined.select(*kept, (numbered[out] + offsets["__off"]).cast("long").alias(out))


class WordCache(dict):
    """What ``make`` returns for a word, kept for twice ``most`` words at a time: when as many new ones
    have come, those that were not asked for since the last time go."""

    def __init__(self, make: Callable[[bytes], object], most: int = 350_000):
        super().__init__()
        self.make, self.most, self.older = make, most, {}

    def __missing__(self, word):
        made = self.older.get(word)
        if made is None:
            made = self.make(word)
        if len(self) >= self.most:
            self.older = dict(self)
            self.clear()
        self[word] = made
        return made


_KEPT: dict = {}


def kept(key, make: Callable[[], object]):
    """What ``make`` returned for the key, kept by a worker until it is asked for another one."""
    if key not in _KEPT:
        _KEPT.clear()
        pa.default_memory_pool().release_unused()
        # What was freed goes back to the machine, where the C library can do that.
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim is not None:
            trim(0)
        _KEPT[key] = make()
    return _KEPT[key]


def nothing_kept() -> None:
    kept(None, lambda: None)


def sliced(batches: Iterator[pa.RecordBatch], rows: int = 1000) -> Iterator[pa.RecordBatch]:
    """The same rows in smaller batches, so that what a task makes of one stays small."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
