"""Growing the dictionaries from files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.functions.text import normalize, strip
from gridloom.operators.headers import canonical_field


def file_budget(files: DataFrame, limit: int) -> DataFrame:
    """The first ``limit`` files by name."""
    return files.orderBy("path").limit(limit)


def new_headers(headers: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Header texts that the dictionary does not hold, with an empty standard."""
    found = headers.where(F.col("raw_header") != "").select(F.col("raw_header").alias("raw"))
    return (
        found.distinct()
        .join(dictionary.select("raw"), "raw", "left_anti")
        .select("raw", F.lit("").alias("standard"))
    )


def header_growth_counts(headers: DataFrame, added: DataFrame) -> DataFrame:
    """All headers found, with repeats, and how many are new."""
    both = headers.select(F.lit(1).alias("found"), F.lit(0).alias("new")).unionByName(
        added.select(F.lit(0).alias("found"), F.lit(1).alias("new"))
    )
    return both.agg(
        F.coalesce(F.sum("found"), F.lit(0)).alias("total_headers"),
        F.coalesce(F.sum("new"), F.lit(0)).alias("new_headers"),
    )


def new_values(values: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Values of canonical columns unknown to the dictionary; ``values(header, value)`` rows."""
    found = (
        values.where(F.col("value").isNotNull())
        .select(canonical_field(F.col("header")).alias("field"), strip(F.col("value")).alias("raw"))
        .where(F.col("field").isNotNull())
    )
    return (
        found.distinct()
        .join(dictionary.select("field", "raw"), ["field", "raw"], "left_anti")
        .select("field", "raw", F.lit("").alias("standard"))
    )


def merge_entries(current: DataFrame, added: DataFrame, keys: list[str]) -> DataFrame:
    """Upsert by key: an added entry replaces the current one."""
    columns = [*keys, "standard"]
    both = current.select(*columns, F.lit(0).alias("v")).unionByName(
        added.select(*columns, F.lit(1).alias("v"))
    )
    return both.groupBy(*keys).agg(F.max_by("standard", F.struct("v", "standard")).alias("standard"))


def learned_values(accepted: DataFrame) -> DataFrame:
    """Resolver answers as value entries; the learnt key is the normalized value."""
    return accepted.select(F.col("scope").alias("field"), normalize(F.col("key")).alias("raw"), "standard")


def learned_headers(accepted: DataFrame) -> DataFrame:
    return accepted.select(F.col("key").alias("raw"), "standard")
