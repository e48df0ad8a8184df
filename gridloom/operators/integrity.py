"""Keys and constraints, checked before one append."""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.operators.lookup import lookup_join
from gridloom.operators.metadata import missing_fields
from gridloom.session import cut_lineage

KEY = ["id_chronogramme", "id_inject"]


class Gate(NamedTuple):
    accepted: DataFrame
    rejected: DataFrame


def require_columns(df: DataFrame, names: list[str]) -> None:
    """The input must be a table that has the key columns."""
    if not isinstance(df, DataFrame):
        raise TypeError("a DataFrame is required")
    absent = [n for n in names if n not in df.columns]
    if absent:
        raise TypeError(f"missing columns: {', '.join(absent)}")


def not_null_violations(df: DataFrame, columns: list[str]) -> DataFrame:
    nulls = F.array_compact(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in columns]))
    return df.withColumn("null_columns", F.array_join(nulls, ", ")).where("null_columns <> ''")


def duplicate_keys(batch: DataFrame, stored: DataFrame | None = None) -> DataFrame:
    """Keys that occur twice in the batch, or in the batch and in the stored table.

    A null inject id never collides. Counts combine before the shuffle, so copies of one key do not
    meet in one task.
    """
    keys = batch.where(F.col("id_inject").isNotNull()).groupBy(*KEY).agg(F.count("*").alias("n"))
    if stored is None:
        return keys.where("n > 1")
    known = stored.select(*KEY, F.lit(1).alias("known")).distinct()
    clash = keys.join(known, KEY, "left").fillna(0, ["known"])
    return clash.where("n > 1 OR known = 1").select(*KEY, (F.col("n") + F.col("known")).alias("n"))


def orphans(batch: DataFrame, dimension: DataFrame) -> DataFrame:
    """Rows whose parent is not in the dimension."""
    parented = batch.where(F.col("id_chronogramme").isNotNull())
    known = dimension.select("id_chronogramme")
    return lookup_join(parented, known, ["id_chronogramme"], parented.columns, "left_anti")


def required_values(facts: DataFrame, required: list[str]) -> DataFrame:
    """Rows that lack a field declared as required."""
    return facts.withColumn("missing", F.array_join(missing_fields(required), ", ")).where(
        "missing <> ''"
    )


def split_required(rows: DataFrame, required: list[str]) -> tuple[DataFrame, DataFrame]:
    """The rows with all required fields, and the others with the reason."""
    lacking = required_values(rows, required)
    reason = F.concat(F.lit("missing: "), F.col("missing"))
    whole = rows.where(F.size(missing_fields(required)) == 0)
    return whole, lacking.withColumn("reason", reason).drop("missing")


def atomic_gate(
    batch: DataFrame,
    dimension: DataFrame,
    stored: DataFrame | None = None,
    unit: str = "id_chronogramme",
) -> Gate:
    """All rows of a unit (a file or a chronogram) or none.

    ``rejected`` names each refused unit with its reasons and counts.
    """
    require_columns(batch, [unit, *KEY])
    # Rows combine per (unit, parent) and per (unit, key) first: a hot parent or a key with very many
    # copies meets the other table as one row.
    parents = batch.groupBy(*dict.fromkeys([unit, "id_chronogramme"])).count()
    dup = duplicate_keys(batch, stored).select(*KEY, F.lit("duplicate key").alias("reason"), "n")
    if unit != "id_chronogramme":
        keyed = batch.where(F.col("id_inject").isNotNull()).groupBy(unit, *KEY)
        dup = keyed.agg(F.count("*").alias("n")).join(dup.drop("n"), KEY)
    parts = [
        parents.where(F.col("id_chronogramme").isNull()).select(
            unit, F.lit("null parent").alias("reason"), "count"
        ),
        orphans(parents, dimension).select(unit, F.lit("unknown parent").alias("reason"), "count"),
        dup.groupBy(unit, "reason").agg(F.sum("n").alias("count")),
    ]
    # Written once: the result, the size check and the join below all read it.
    counted = reduce(DataFrame.unionByName, parts).groupBy(unit, "reason")
    rejected = cut_lineage(counted.agg(F.sum("count").alias("n")), "rejected")
    bad = rejected.where(F.col(unit).isNotNull()).select(unit).distinct()
    parented = batch.where(F.col("id_chronogramme").isNotNull())
    accepted = lookup_join(parented, bad, [unit], parented.columns, "left_anti")
    return Gate(accepted, rejected)
