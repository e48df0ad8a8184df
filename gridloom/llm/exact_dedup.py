"""Exact duplicates by sorting content.

Sampled splitters range-partition the normalised texts by their first characters and, where those
agree, by a hash of the whole text; so the samples that the driver sees are short however long the
texts are. Spark's external sort then puts equal texts side by side, and the scan over neighbours
compares whole texts and keeps the smallest identifier. Texts with so many copies that a task would
feel them are found beforehand by counting hashes; a salt splits them into several runs, whose
heads, one row each, are combined afterwards.

Nulls and edge cases: a null text counts as empty; a null id is larger than every other id; of rows
that repeat an id and a text exactly one is kept; an empty table gives an empty result. Columns of
any name may be present: only the named ones are read by ``exact_groups``, and ``drop_copies``
returns the columns it was given.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from gridloom.llm.common import cut_lineage, shuffle_partitions

#: A text is hot above this many rows, or above one row in ``HOT_SHARE``, whichever is more; so
#: there are never more than ``HOT_SHARE`` hot hashes, a few MB to broadcast.
HOT_ROWS = 256
HOT_SHARE = 100_000
#: Characters by which splitters are chosen before the hash decides.
SPLITTER_CHARS = 32


def normalised(text: Column) -> Column:
    """The text with each run of ASCII white space as one space; empty for null."""
    # A single space is left alone, which spares most of the work of replacing it by itself.
    runs = "\\x20[\\x20\\x09-\\x0D]+|[\\x09-\\x0D][\\x20\\x09-\\x0D]*"
    return F.regexp_replace(F.coalesce(text, F.lit("")), runs, " ")


def hot_hashes(df: DataFrame, text: Column, hot_rows: int = HOT_ROWS) -> list[tuple[int, int]]:
    """Hashes of normalised texts that a task should not sort alone, with a number of runs."""
    least = max(hot_rows, df.count() // HOT_SHARE)
    counts = df.select(F.xxhash64(normalised(text)).alias("h")).groupBy("h").count()
    hot = counts.where(F.col("count") > least)
    return [(r[0], r[1]) for r in hot.select("h", F.ceil(F.col("count") / least)).collect()]


def _runs(rows: DataFrame, norm: Column, ident: Column, hot: list[tuple[int, int]]) -> DataFrame:
    """``rows`` sorted into runs of equal texts, with keep_id, group_size and place of the run."""
    spark, kept = rows.sparkSession, rows.columns
    rows = rows.withColumn("h", F.xxhash64(norm))
    rows = rows.withColumn("lead", F.substring(norm, 1, SPLITTER_CHARS))
    keys, in_hot = ["lead", "h"], F.lit(False)
    if hot:
        # At most HOT_SHARE rows, as each has more than a HOT_SHAREth of all rows.
        found = F.broadcast(spark.createDataFrame(hot, "h long, runs long"))
        rows = rows.join(found, "h", "left").withColumn(
            "salt", F.coalesce(F.pmod(F.xxhash64(ident), F.col("runs")), F.lit(-1))
        )
        keys, in_hot = [*keys, "salt"], F.col("salt") >= 0
    placed = rows.repartitionByRange(shuffle_partitions(spark), *keys)
    # The range partitioning already holds equal texts of a run together: no second exchange, and
    # all windows share one sort.
    by_id = W.partitionBy(*keys, norm).orderBy(ident.asc_nulls_last())
    equal = by_id.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    return placed.select(
        *kept,
        in_hot,
        F.first(ident).over(equal).alias("keep_id"),
        F.count("*").over(equal).alias("group_size"),
        F.row_number().over(by_id).alias("place"),
    ).toDF(*kept, "hot", "keep_id", "group_size", "place")


def exact_groups(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", hot_rows: int = HOT_ROWS
) -> DataFrame:
    """One row per row of ``df``: id, keep_id, group_size, kept, text_sha256."""
    text = F.col(f"`{text_col}`")
    hot = hot_hashes(df, text, hot_rows)
    rows = df.select(F.col(f"`{id_col}`").alias("id"), normalised(text).alias("norm"))
    runs = _runs(rows, F.col("norm"), F.col("id"), hot)
    runs = runs.withColumn("text_sha256", F.sha2("norm", 256)).drop("norm")
    kept = F.col("place") == 1
    if hot:
        # Short rows from here on: heads of hot runs are combined and joined back.
        runs = cut_lineage(runs, "runs")
        heads = runs.where(F.col("hot") & kept)
        totals = heads.groupBy("text_sha256").agg(
            F.min("keep_id").alias("first_id"), F.sum("group_size").alias("total")
        )
        # As many rows as hot texts, at most HOT_SHARE.
        runs = runs.join(F.broadcast(totals), "text_sha256", "left")
        kept = kept & (
            F.col("total").isNull() | F.col("keep_id").eqNullSafe(F.col("first_id"))
        )
        runs = runs.withColumn("kept", kept).withColumns(
            {
                "keep_id": F.when(F.col("total").isNull(), F.col("keep_id")).otherwise(
                    F.col("first_id")
                ),
                "group_size": F.coalesce("total", "group_size"),
            }
        )
        kept = F.col("kept")
    return runs.select(
        F.col("id").alias(id_col), "keep_id", "group_size", kept.alias("kept"), "text_sha256"
    )


def drop_copies(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", hot_rows: int = HOT_ROWS
) -> DataFrame:
    """The rows that stay, with the columns of ``df``."""
    names = {c: f"c{i}" for i, c in enumerate(df.columns)}
    rows = df.select(*[F.col(f"`{c}`").alias(a) for c, a in names.items()])
    text, ident = F.col(names[text_col]), F.col(names[id_col])
    hot = hot_hashes(rows, text, hot_rows)
    runs = _runs(rows, normalised(text), ident, hot)
    heads = runs.where(F.col("place") == 1)
    kept = heads.select(*names.values())
    if hot:
        kept = heads.where(~F.col("hot")).select(*names.values())
        first = F.min_by(F.struct(*names.values()), F.coalesce(ident, F.lit(2**63 - 1)))
        several = heads.where("hot").groupBy(F.sha2(normalised(text), 256)).agg(first.alias("r"))
        kept = kept.unionByName(several.select("r.*"))
    return kept.select(*[F.col(a).alias(c) for c, a in names.items()])
