"""Suggestions for unknown headers and values.

A resolver takes ``unresolved(scope, key, raw)`` with one row per distinct key and returns
``suggestions(scope, key, standard)``. ``scope`` is ``header`` or the field of a value.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Mapping
from typing import NamedTuple

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.functions.text import normalize, normalize_py, strip
from gridloom.operators.lookup import lookup_join
from gridloom.session import cut_lineage

Resolver = Callable[[DataFrame], DataFrame]
Allowed = Mapping[str, list[str]]

HEADER = "header"
SUGGESTIONS = "scope string, key string, standard string"


class Resolved(NamedTuple):
    accepted: DataFrame
    refused: DataFrame


def allowed_list(scope: Column, allowed: Allowed) -> Column:
    """The closed list of a scope, null where it has none."""
    lists = F.lit(None).cast("array<string>")
    for name, values in allowed.items():
        lists = F.when(scope == name, F.array(*map(F.lit, values))).otherwise(lists)
    return lists


def no_resolver(unresolved: DataFrame) -> DataFrame:
    return unresolved.where("false").select("scope", "key", F.lit("").alias("standard"))


def table_resolver(reviewed: DataFrame) -> Resolver:
    """Suggestions from a reviewed table ``(scope, key, standard)``."""

    def resolve(unresolved: DataFrame) -> DataFrame:
        return unresolved.join(reviewed, ["scope", "key"]).select("scope", "key", "standard")

    return resolve


def nearest_resolver(allowed: Allowed, max_distance: int = 2) -> Resolver:
    """The allowed value with the smallest edit distance, first in the list on a tie.

    The closed lists are literals, so each key meets its own list inside one expression.
    """

    def candidates(scope: Column) -> Column:
        found = F.lit(None).cast("array<struct<pos:int,norm:string,standard:string>>")
        for name, values in allowed.items():
            entries = F.array(
                *[
                    F.struct(
                        F.lit(i).alias("pos"),
                        F.lit(normalize_py(v)).alias("norm"),
                        F.lit(v).alias("standard"),
                    )
                    for i, v in enumerate(values)
                ]
            )
            found = F.when(scope == name, entries).otherwise(found)
        return found

    def resolve(unresolved: DataFrame) -> DataFrame:
        norm = normalize(F.col("raw"))
        measured = F.transform(
            candidates(F.col("scope")),
            lambda c: F.struct(
                F.levenshtein(F.col("norm"), c["norm"]).alias("distance"),
                c["pos"].alias("pos"),
                c["standard"].alias("standard"),
            ),
        )
        best = unresolved.withColumn("norm", norm).withColumn("best", F.array_min(measured))
        return best.where(F.col("best.distance") <= max_distance).select(
            "scope", "key", F.col("best.standard").alias("standard")
        )

    return resolve


def function_resolver(suggest: Callable[[str, Iterable[str]], str], allowed: Allowed) -> Resolver:
    """Any Python callback ``(text, allowed) -> standard``, called once per distinct key."""
    lists = {name: list(values) for name, values in allowed.items()}

    def call(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            answers = [suggest(r, lists.get(s, [])) for s, r in zip(batch["scope"], batch["raw"])]
            yield pd.DataFrame({"scope": batch["scope"], "key": batch["key"], "standard": answers})

    def resolve(unresolved: DataFrame) -> DataFrame:
        return unresolved.select("scope", "key", "raw").mapInPandas(call, SUGGESTIONS)

    return resolve


def resolve_keys(
    unresolved: DataFrame, resolver: Resolver, allowed: Allowed, strict: bool = True
) -> Resolved:
    """Ask the resolver once and keep the answers; ``strict`` refuses ones outside the list.

    The answers are written out before use: a callback must not be asked again, or answer
    differently, when a later stage is recomputed.
    """
    answers = cut_lineage(
        resolver(unresolved)
        .withColumn("standard", strip(F.col("standard")))
        .groupBy("scope", "key")
        .agg(F.min("standard").alias("standard")),
        "answers",
    )
    closed = allowed_list(F.col("scope"), allowed)
    listed = F.coalesce(F.array_contains(closed, F.col("standard")), F.lit(True))
    usable = F.coalesce(F.col("standard") != "", F.lit(False)) & (listed if strict else F.lit(True))
    return Resolved(answers.where(usable), answers.where(~usable))


def attach(rows: DataFrame, accepted: DataFrame, spread: list[str]) -> DataFrame:
    """Add ``suggestion`` to rows that have ``scope`` and ``key``."""
    named = accepted.withColumnRenamed("standard", "suggestion")
    return lookup_join(rows, named, ["scope", "key"], spread)
