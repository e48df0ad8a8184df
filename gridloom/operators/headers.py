"""Header standardization on ``headers(file_id, sheet_idx, col_idx, raw_header)``."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from gridloom.functions.text import light_normalize, normalize, strip
from gridloom.model import METHOD_DICT, METHOD_RESOLVER, METHOD_RULE
from gridloom.operators.lookup import latest_per_key, lookup_join
from gridloom.operators.resolvers import HEADER, SUGGESTIONS, Resolver, attach, resolve_keys
from gridloom.session import cut_lineage

SHEET = ["file_id", "sheet_idx"]
COLUMN = [*SHEET, "col_idx"]

# Known header names and their standard fields.
KNOWN_FIELDS = {
    "Heure": "Horodatage",
    "Descriptif": "Contenu",
    "Émetteur": "Emetteur",
    "Cellule concernée": "Destinataire",
    "Canal": "Modalité",
    "Phasage": "Phase",
    "Nom de l’inject": "ID_inject",
}
UNKNOWN = "Inconnu"

# Substrings of a normalized header and the field they point to, in this order.
CANONICAL = [
    ("emetteur", "emetteur"),
    ("destinataire", "destinataire"),
    ("modalite", "modalite"),
    ("type", "type_inject"),
    ("nature", "type_inject"),
]


class Standardized(NamedTuple):
    headers: DataFrame
    learned: DataFrame
    refused: DataFrame


def _entries(dictionary: DataFrame, key: Column) -> DataFrame:
    """Unique keys; an entry whose last standard is empty counts as missing."""
    keyed = dictionary.select(key.alias("key"), "standard", "line_no")
    return latest_per_key(keyed, ["key"]).where(F.coalesce(F.col("standard"), F.lit("")) != "")


def by_exact(headers: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Lookup of the trimmed header text; ``standard`` is null on a miss."""
    keyed = headers.withColumn("key", F.coalesce(strip(F.col("raw_header")), F.lit("")))
    found = lookup_join(keyed, _entries(dictionary, F.col("raw")), ["key"], COLUMN, bound=dictionary)
    return found.select(
        *headers.columns,
        "key",
        F.when(F.col("key") == "", "").otherwise(F.col("standard")).alias("standard"),
        F.when((F.col("key") != "") & F.col("standard").isNotNull(), METHOD_DICT).alias("method"),
    )


def by_rules(headers: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Lookup of the normalized header; a miss gives an empty name and is still logged."""
    keyed = headers.withColumn("key", normalize(F.col("raw_header")))
    found = lookup_join(keyed, _entries(dictionary, normalize(F.col("raw"))), ["key"], COLUMN, bound=dictionary)
    return found.select(
        *headers.columns,
        F.when(F.col("key") == "", "").otherwise(F.coalesce("standard", F.lit(""))).alias("standard"),
        F.when(F.col("key") != "", METHOD_RULE).alias("method"),
    )


def by_known_names(headers: DataFrame, known: dict[str, str] | None = None) -> DataFrame:
    """The static table of known headers; a miss is ``Inconnu``."""
    norm = light_normalize(F.col("raw_header"))
    standard = F.lit(UNKNOWN)
    for name, field in (known or KNOWN_FIELDS).items():
        standard = F.when(norm == name.strip().lower(), field).otherwise(standard)
    return headers.withColumn("standard", standard)


def by_rename(headers: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Normalized lookup; a miss keeps the normalized header itself."""
    entries = _entries(dictionary, normalize(F.col("raw"))).withColumn(
        "standard", normalize(F.col("standard"))
    )
    keyed = headers.withColumn("key", normalize(F.col("raw_header")))
    found = lookup_join(keyed, entries, ["key"], COLUMN, bound=dictionary)
    return found.select(*headers.columns, F.coalesce("standard", "key").alias("standard"))


def canonical_field(name: Column) -> Column:
    """Target field by substring of the normalized name, null if none fits."""
    norm = normalize(name)
    field = F.lit(None).cast("string")
    for part, target in reversed(CANONICAL):
        field = F.when(F.contains(norm, F.lit(part)), target).otherwise(field)
    return field


def _first_use(rows: DataFrame, scope: list[str], order: list[str], **bounds: int) -> DataFrame:
    """Mark the first row of each key, per file or over all files.

    The minimum combines before the shuffle; a text that stands in every file is a heavy key of the join
    back and is split (see ``lookup_join``).
    """
    position = F.struct(*order)
    firsts = rows.groupBy(*scope, "key").agg(F.min(position).alias("__first"))
    firsts = cut_lineage(firsts, "first-use")
    joined = lookup_join(rows, firsts, [*scope, "key"], COLUMN, **bounds)
    return joined.withColumn("is_first", position == F.col("__first")).drop("__first")


def standardize_headers(
    headers: DataFrame,
    dictionary: DataFrame,
    fields: list[str],
    resolver: Resolver | None = None,
    policy: str = "resolve",
    strict: bool = True,
    repeat_scope: str = "file",
) -> Standardized:
    """Dictionary, then resolver for the misses.

    ``policy="rules_if_unresolved"``: a file that keeps an unresolved header takes the rule lookup
    for all its headers. The first use of a resolved header is logged with the resolver's method,
    later ones (in the file, or in all files with ``repeat_scope="all"``) as dictionary hits.
    """
    exact = by_exact(headers, dictionary)
    missing = (F.col("key") != "") & F.col("standard").isNull()
    unresolved = (
        exact.where(missing).select(F.lit(HEADER).alias("scope"), "key", F.col("key").alias("raw"))
    ).distinct()
    spark = headers.sparkSession
    if resolver is None:
        learned = refused = spark.createDataFrame([], SUGGESTIONS)
        suggested = exact.withColumns(
            {"suggestion": F.lit(None).cast("string"), "is_first": F.lit(True)}
        )
    else:
        learned, refused = resolve_keys(unresolved, resolver, {HEADER: fields}, strict)
        scoped = exact.withColumn("scope", F.lit(HEADER))
        order = ["sheet_idx", "col_idx"]
        within = SHEET[:1]
        if repeat_scope == "all":
            order, within = [*SHEET, "col_idx"], []
        suggested = _first_use(attach(scoped, learned, COLUMN), within, order)
    from_resolver = F.col("standard").isNull() & F.col("suggestion").isNotNull()
    method = F.when(from_resolver & F.col("is_first"), METHOD_RESOLVER).when(
        from_resolver, METHOD_DICT
    )
    done = suggested.select(
        *headers.columns,
        F.coalesce("standard", "suggestion").alias("standard"),
        F.coalesce(F.col("method"), method).alias("method"),
    )
    if policy == "rules_if_unresolved":
        # One row per column of a main sheet: bounded by the columns of a file.
        whole_file = W.partitionBy("file_id")
        rules = by_rules(headers, dictionary).select(
            *COLUMN, F.col("standard").alias("r_std"), F.col("method").alias("r_method")
        )
        failed = F.max(F.col("standard").isNull()).over(whole_file)
        done = (
            done.withColumn("failed", failed)
            .join(rules, COLUMN)
            .select(
                *headers.columns,
                F.when(F.col("failed"), F.col("r_std")).otherwise(F.col("standard")).alias("standard"),
                F.when(F.col("failed"), F.col("r_method")).otherwise(F.col("method")).alias("method"),
            )
        )
    else:
        logged = F.when(strip(F.col("raw_header")) != "", F.coalesce("method", F.lit(METHOD_RESOLVER)))
        done = done.withColumns(
            {"standard": F.coalesce("standard", F.lit("")), "method": logged}
        )
    return Standardized(done, learned, refused)


def header_log(standardized: DataFrame) -> DataFrame:
    """One decision per non-blank header."""
    return standardized.where(F.col("method").isNotNull()).select(
        "file_id",
        F.col("col_idx").alias("position"),
        F.lit(HEADER).alias("scope"),
        strip(F.col("raw_header")).alias("nom_original"),
        F.col("standard").alias("champ_standard"),
        F.col("method").alias("methode"),
    )


def pick_columns(standardized: DataFrame, fields: list[str]) -> DataFrame:
    """The column that feeds each field of a file: the first one with that standard name."""
    return (
        standardized.where(F.col("standard").isin(fields))
        .groupBy(*SHEET, F.col("standard").alias("field"))
        .agg(F.min("col_idx").alias("col_idx"))
    )


def dropped_columns(standardized: DataFrame, fields: list[str]) -> DataFrame:
    """Columns that reach no field, and why."""
    used = pick_columns(standardized, fields)
    reason = F.when(F.col("standard").isin(fields), "repeated").otherwise("not in schema")
    return standardized.join(used, COLUMN, "left_anti").select(
        *COLUMN, "raw_header", "standard", reason.alias("reason")
    )


def to_wide(
    long: DataFrame,
    keys: list[str],
    fields: list[str],
    presence: tuple[str, list[str]] = ("", []),
    folded: tuple[str, Column] | None = None,
) -> DataFrame:
    """Long ``(keys, field, value)`` to one column per field, in schema order.

    The list is fixed, so the plan and its schema do not depend on the data. ``presence`` is a prefix
    and fields for which a flag says whether the row has a cell of that field at all. ``folded`` names
    one more aggregate of the row's cells, see ``folded_text``.
    """
    more = [] if folded is None else [folded[1].alias(folded[0])]
    prefix, flagged = presence
    is_field = {f: F.col("field") == f for f in {*fields, *flagged}}
    return long.groupBy(*keys).agg(
        *[F.max(F.when(is_field[f], F.col("value"))).alias(f) for f in fields],
        *[F.coalesce(F.max(is_field[f]), F.lit(False)).alias(prefix + f) for f in flagged],
        *more,
    )


def folded_text(outside: Column, label: Column, separator: str = " | ") -> Column:
    """Aggregate over the cells of one row: the values where ``outside`` holds, each after its label, as
    one text in column order; empty without any. A row's cells are as many as its columns."""
    shown = F.struct("col_idx", F.concat_ws(": ", label, "value").alias("text"))
    cells = F.collect_list(F.when(outside & F.col("value").isNotNull(), shown))
    return F.array_join(F.array_sort(cells)["text"], separator)


def fold_unmapped(
    long: DataFrame, keys: list[str], fields: list[str], separator: str = " | "
) -> DataFrame:
    """Values of columns outside the schema as one text per row, in column order."""
    outside = long.where(~F.coalesce(F.col("standard").isin(fields), F.lit(False)))
    text = folded_text(F.lit(True), F.col("raw_header"), separator)
    return outside.where(F.col("value").isNotNull()).groupBy(*keys).agg(text.alias("folded"))
