"""Running values along an integer row order, safe for one very long key.

A window over a whole key runs in one task. Here the order is cut into buckets of ``width``
consecutive ordinals: a window works inside (key, bucket), one summary row per bucket is carried
over the buckets of the key, and the carry is joined back on (key, bucket); every bucket has its
summary row, so the join is an inner one and both sides of it keep equal plans. No task sees more than
one bucket of rows or one key's bucket summaries. A null key or ordinal is an error, and ordinals must
be unique within a key.

Where ordinals lie far apart (times, ids of a larger table) such buckets would hold a row or two each. With
``sparse`` buckets follow the rows instead: the rows are range-partitioned by key and ordinal, which samples
splitters, written once with the number of their partition, and that number is the bucket. There are at
most as many summaries as partitions and keys together, and of one key at most as many as partitions. A
partition is a task and a file, so a ``width`` below ``WIDTH`` makes no more of them than shuffles have.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from gridloom.session import cut_lineage

WIDTH = 65_536
_BUCKET = "__bucket"


def _bucketed(df: DataFrame, keys: list[str], ordinal: str, width: int) -> DataFrame:
    absent = reduce(Column.__or__, [F.col(c).isNull() for c in (*keys, ordinal)])
    error = F.raise_error(F.lit(f"null in {', '.join((*keys, ordinal))}")).cast("long")
    bucket = F.when(absent, error).otherwise(F.floor(F.col(ordinal) / F.lit(float(width))))
    # Said here, the null test is part of both uses; inferred from the join, of one only.
    return df.withColumn(_BUCKET, bucket).where(F.col(_BUCKET).isNotNull())


def range_parts(rows: int, width: int, tasks: int) -> int:
    """Partitions of ``width`` rows; beyond ``tasks`` of them, of as many more as ``WIDTH`` asks for."""
    return max(1, min(-(-rows // width), max(tasks, -(-rows // WIDTH))))


def _ranged(df: DataFrame, keys: list[str], ordinal: str, width: int) -> DataFrame:
    absent = reduce(Column.__or__, [F.col(c).isNull() for c in (*keys, ordinal)])
    error = F.raise_error(F.lit(f"null in {', '.join((*keys, ordinal))}")).cast("boolean")
    checked = df.where(F.when(absent, error).otherwise(True))
    parts = range_parts(df.count(), width, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    placed = checked.repartitionByRange(parts, *keys, ordinal)
    return cut_lineage(placed.withColumn(_BUCKET, F.spark_partition_id().cast("long")), "ranged")


def _buckets(df: DataFrame, keys: list[str], ordinal: str, width: int, sparse: bool) -> DataFrame:
    return (_ranged if sparse else _bucketed)(df, keys, ordinal, width)


def _inside(keys: list[str], ordinal: str):
    return W.partitionBy(*keys, _BUCKET).orderBy(ordinal)


def _before(keys: list[str]):
    return W.partitionBy(*keys).orderBy(_BUCKET).rowsBetween(W.unboundedPreceding, -1)


def carry_forward(
    df: DataFrame, keys: list[str], ordinal: str, columns: list[str], width: int = WIDTH, sparse: bool = False
) -> DataFrame:
    """Replace each null in ``columns`` by the last value at an earlier ordinal of the key."""
    rows = _buckets(df, keys, ordinal, width, sparse)
    if set(df.columns) == {*keys, ordinal, *columns}:
        # Window and summary need the same columns, so they can share one exchange.
        rows = rows.repartition(*keys, _BUCKET)
    present = {c: F.when(F.col(c).isNotNull(), F.col(ordinal)) for c in columns}
    summary = rows.groupBy(*keys, _BUCKET).agg(
        *[F.max_by(c, present[c]).alias(f"__last_{c}") for c in columns]
    )
    carry = summary.select(
        *keys,
        _BUCKET,
        *[F.last(f"__last_{c}", True).over(_before(keys)).alias(f"__carry_{c}") for c in columns],
    )
    local = _inside(keys, ordinal).rowsBetween(W.unboundedPreceding, W.currentRow)
    filled = rows.withColumns({c: F.last(c, True).over(local) for c in columns})
    return (
        filled.join(carry, [*keys, _BUCKET])
        .withColumns({c: F.coalesce(F.col(c), F.col(f"__carry_{c}")) for c in columns})
        .select(*df.columns)
    )


def running_count(
    df: DataFrame,
    keys: list[str],
    ordinal: str,
    out: str,
    flag: Column | None = None,
    width: int = WIDTH,
    total: str | None = None,
    flagged_total: str | None = None,
    sparse: bool = False,
    along: DataFrame | None = None,
) -> DataFrame:
    """Number of rows (or of rows where ``flag`` holds) up to and including each row.

    ``total`` and ``flagged_total`` name columns for the key's counts of all and of flagged rows;
    they come from the bucket summary, without another pass. So do the columns of ``along``, a table by the
    keys: it meets the summaries, not the rows, and rows of a key that it lacks are left out.
    """
    counted = F.lit(1) if flag is None else F.when(flag, 1).otherwise(0)
    rows = _buckets(df.withColumn("__one", counted.cast("long")), keys, ordinal, width, sparse)
    summary = rows.groupBy(*keys, _BUCKET).agg(
        F.sum("__one").alias("__n"), F.count("*").alias("__rows")
    )
    whole = W.partitionBy(*keys)
    totals = {total: "__rows", flagged_total: "__n"}
    totals = {name: F.sum(source).over(whole) for name, source in totals.items() if name}
    carry = summary.select(
        *keys,
        _BUCKET,
        F.sum("__n").over(_before(keys)).alias("__carry"),
        *[column.alias(name) for name, column in totals.items()],
    )
    told = []
    if along is not None:
        told = [c for c in along.columns if c not in keys]
        carry = carry.join(along, keys)
    local = _inside(keys, ordinal).rowsBetween(W.unboundedPreceding, W.currentRow)
    return (
        rows.withColumn(out, F.sum("__one").over(local))
        .join(carry, [*keys, _BUCKET])
        .withColumn(out, F.col(out) + F.coalesce("__carry", F.lit(0)))
        .select(*[c for c in df.columns if c != out], out, *totals, *told)
    )


def previous_ordinal(
    df: DataFrame, keys: list[str], ordinal: str, out: str, width: int = WIDTH, sparse: bool = False
) -> DataFrame:
    """The ordinal of the preceding row of the key, null on its first row."""
    rows = _buckets(df, keys, ordinal, width, sparse)
    if set(df.columns) == {*keys, ordinal}:
        rows = rows.repartition(*keys, _BUCKET)
    summary = rows.groupBy(*keys, _BUCKET).agg(F.max(ordinal).alias("__max"))
    carry = summary.select(*keys, _BUCKET, F.max("__max").over(_before(keys)).alias("__carry"))
    return (
        rows.withColumn(out, F.lag(ordinal).over(_inside(keys, ordinal)))
        .join(carry, [*keys, _BUCKET])
        .withColumn(out, F.coalesce(out, "__carry"))
        .select(*df.columns, out)
    )


def number_any(df: DataFrame, id_columns: list[str], out: str, buckets: int = 65_536) -> DataFrame:
    """Dense numbers 1..n over rows with unique ``id_columns``, the same on every run.

    The order is that of hash buckets, then of the id columns: no global sort, no single task.
    """
    hashed = df.withColumn(_BUCKET, F.pmod(F.xxhash64(*id_columns), F.lit(buckets)))
    summary = hashed.groupBy(_BUCKET).agg(F.count("*").alias("__n"))
    before = W.orderBy(_BUCKET).rowsBetween(W.unboundedPreceding, -1)
    # At most ``buckets`` rows: bounded by the parameter, not by the data.
    offsets = summary.select(_BUCKET, F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__off"))
    inside = W.partitionBy(_BUCKET).orderBy(*id_columns)
    return (
        hashed.withColumn(out, F.row_number().over(inside).cast("long"))
        .join(F.broadcast(offsets), _BUCKET)
        .withColumn(out, F.col(out) + F.col("__off"))
        .drop(_BUCKET, "__off")
    )
