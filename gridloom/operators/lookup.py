"""Joins of many rows with a table that has unique keys.

A table within a counted size bound is broadcast. Beyond it, rows and table are shuffled, and only
the heavy keys (bounded in number) are salted, so that a key with a large part of all rows is shared
by many tasks while the table is not multiplied.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.session import cut_lineage

BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 64 * 1024 * 1024
HEAVY_ROWS = 1_000_000
HEAVY_KEYS = 1000
SALTS = 256


def fits_broadcast(
    df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES
) -> bool:
    """Whether rows and text bytes, counted where the data lies, stay within the bounds."""
    texts = [f.name for f in df.schema.fields if f.dataType.simpleString() == "string"]
    size = F.lit(0)
    for name in texts:
        size = size + F.coalesce(F.octet_length(name), F.lit(0))
    total = F.coalesce(F.sum(size + 16 * len(df.columns)), F.lit(0))
    rows, n_bytes = df.agg(F.count("*"), total).first()
    return rows <= max_rows and n_bytes <= max_bytes


def heavy_keys(df: DataFrame, on: list[str], heavy_rows: int = HEAVY_ROWS) -> DataFrame:
    """The keys with more than ``heavy_rows`` rows, at most the ``HEAVY_KEYS`` heaviest.

    A key beyond these holds less than a thousandth of all rows. The table is written out, so both
    sides of a join salt the same keys.
    """
    counts = df.groupBy(*on).agg(F.count("*").alias("n")).where(F.col("n") > heavy_rows)
    top = counts.orderBy(F.desc("n"), *on).limit(HEAVY_KEYS)
    return cut_lineage(top.select(*on, F.lit(True).alias("__heavy")), "heavy")


def lookup_join(
    df: DataFrame,
    lookup: DataFrame,
    on: list[str],
    spread: list[str],
    how: str = "left",
    max_rows: int = BROADCAST_ROWS,
    bound: DataFrame | None = None,
    heavy_rows: int = HEAVY_ROWS,
    no_nulls: bool = False,
) -> DataFrame:
    """Join rows with a table that has unique ``on`` keys.

    ``bound`` names a table that is at least as large and cheaper to count, such as the stored
    dictionary. ``spread`` are the columns that tell the rows of one key apart: a salt is a function
    of the row, so a lost task recomputes the same one. Rows with a null key match nothing and are
    spread too; ``no_nulls`` says that there are none. Where nothing has to be spread the join is on the keys
    alone, so later steps of the same keys need no exchange of their own.
    """
    if fits_broadcast(lookup if bound is None else bound, max_rows):
        return df.join(F.broadcast(lookup), on, how)
    heavy = heavy_keys(df, on, heavy_rows)
    if (no_nulls or how in ("inner", "left_semi")) and heavy.isEmpty():
        return df.join(lookup, on, how)
    salt = F.pmod(F.xxhash64(*spread), F.lit(SALTS)).cast("int")
    no_key = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in on])
    # At most HEAVY_KEYS rows.
    salted = df.join(F.broadcast(heavy), on, "left").withColumn(
        "__salt", F.when(no_key | F.col("__heavy"), salt).otherwise(0)
    )
    every = F.when(F.col("__heavy"), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(
        F.array(F.lit(0))
    )
    repeated = lookup.join(F.broadcast(heavy), on, "left").withColumn("__salt", F.explode(every))
    joined = salted.drop("__heavy").join(repeated.drop("__heavy"), [*on, "__salt"], how)
    return joined.drop("__salt")


def latest_per_key(entries: DataFrame, keys: list[str], order: str = "line_no") -> DataFrame:
    """One entry per key: the last one written wins."""
    rest = [c for c in entries.columns if c not in (*keys, order)]
    picked = entries.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.col(order)).alias("__e"))
    return picked.select(*keys, *[F.col(f"__e.{c}").alias(c) for c in rest])
