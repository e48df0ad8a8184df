"""Value standardization on long ``values(file_id, row_idx, field, value)`` rows."""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.functions.text import normalize, strip
from gridloom.model import METHOD_DICT, METHOD_OK, METHOD_RESOLVER
from gridloom.operators.lookup import latest_per_key, lookup_join
from gridloom.operators.resolvers import (
    SUGGESTIONS,
    Allowed,
    Resolver,
    allowed_list,
    attach,
    resolve_keys,
)
from gridloom.session import cut_lineage

ROW = ["file_id", "row_idx"]


class Filtered(NamedTuple):
    kept: DataFrame
    rejected: DataFrame


class Standardized(NamedTuple):
    values: DataFrame
    learned: DataFrame
    refused: DataFrame


def _entries(dictionary: DataFrame, key: Column, name: str, unique: bool = False) -> DataFrame:
    keyed = dictionary.select("field", key.alias(name), "standard", "line_no")
    entries = keyed.drop("line_no") if unique else latest_per_key(keyed, ["field", name])
    return entries.where(F.coalesce(F.col("standard"), F.lit("")) != "")


def _of_fields(column: Column, fields: list[str] | None) -> Column:
    """Null outside the named fields, so that their texts are neither folded nor shuffled by value."""
    return column if fields is None else F.when(F.col("field").isin(fields), column)


def standardize_exact(
    values: DataFrame,
    dictionary: DataFrame,
    spread: list[str] | None = None,
    fields: list[str] | None = None,
) -> DataFrame:
    """Replace values found in the dictionary of their field; others and nulls stay."""
    if fields is not None and not fields:
        return values
    entries = _entries(dictionary, F.col("raw"), "key")
    sought = F.col("value").isNotNull() & F.col("field").isNotNull()
    if fields is not None:
        sought = sought & F.col("field").isin(fields)
    sought = F.coalesce(sought, F.lit(False))
    # Only what may stand in the dictionary goes to it.
    keyed = values.where(sought).withColumn("key", F.col("value"))
    found = lookup_join(keyed, entries, ["field", "key"], spread or ROW, bound=dictionary, no_nulls=True)
    found = found.withColumn("value", F.coalesce("standard", "value")).select(*values.columns)
    return found.unionByName(values.where(~sought))


def standardize_exact_wide(
    df: DataFrame,
    dictionary: DataFrame,
    fields: list[str],
    spread: list[str],
    no_nulls: bool = False,
    unique: bool = False,
) -> DataFrame:
    """The same for a wide table, one lookup per named field. ``unique`` says that no key of the dictionary repeats."""
    entries = _entries(dictionary, F.col("raw"), "raw", unique)
    for name in fields:
        per_field = entries.where(F.col("field") == name).select(
            F.col("raw").alias(name), F.col("standard").alias("__std")
        )
        df = (
            lookup_join(df, per_field, [name], spread, bound=dictionary, no_nulls=no_nulls)
            .withColumn(name, F.coalesce("__std", name))
            .drop("__std")
            .select(*df.columns)
        )
    return df


def standardize_texts(
    rows: DataFrame, dictionary: DataFrame, fields: list[str], keys: list[str], unique: bool = False
) -> DataFrame:
    """The same for rows whose ``fields`` are arrays of a row's distinct values: each gets the greatest of what its
    values become, null without any. ``rows`` is a stored table with unique ``keys``; it is read several times.

    Almost every array has one value or none, so the rows meet the dictionary as they are; the few others go
    value by value.
    """
    if not fields:
        return rows
    many = reduce(Column.__or__, [F.size(f) > 1 for f in fields])
    rest = rows.where(~many).withColumns({f: F.get(f, F.lit(0)) for f in fields})
    sought = reduce(Column.__or__, [F.col(f).isNotNull() for f in fields])
    found = standardize_exact_wide(rest.where(sought), dictionary, fields, keys, len(fields) == 1, unique)
    done = found.unionByName(rest.where(~sought))
    several = rows.where(many)
    if several.isEmpty():
        return done

    def named(field: str) -> Column:
        return F.transform(field, lambda v: F.struct(F.lit(field).alias("field"), v.alias("value")))

    each = several.select(*keys, F.inline(F.flatten(F.array(*[named(f) for f in fields]))))
    each = standardize_exact(each, dictionary, [*keys, "field"], fields)
    best = each.groupBy(*keys).agg(*[F.max(F.when(F.col("field") == f, F.col("value"))).alias(f) for f in fields])
    return done.unionByName(several.drop(*fields).join(best, keys).select(*rows.columns))


def filter_allowed(df: DataFrame, allowed: Allowed, presence: str | None = None) -> Filtered:
    """Rows whose value is allowed in every closed field, and the others with the failing fields.

    With ``presence``, a row whose flag ``<presence><field>`` is false comes from a file without that
    field and is not tested on it.
    """
    present = {f: v for f, v in allowed.items() if f in df.columns}
    good = {f: F.coalesce(F.col(f).isin(v), F.lit(False)) for f, v in present.items()}
    if presence is not None:
        good = {f: ok | ~F.col(presence + f) for f, ok in good.items()}
    every = reduce(lambda a, b: a & b, good.values(), F.lit(True))
    failing = F.array_compact(F.array(*[F.when(~ok, F.lit(f)) for f, ok in good.items()]))
    reasons = F.concat(F.lit("not allowed: "), F.array_join(failing, ", "))
    return Filtered(df.where(every), df.where(~every).withColumn("reason", reasons))


def touched_fields(dictionary: DataFrame, allowed: Allowed, fields: list[str]) -> list[str]:
    """Fields that have a dictionary or a closed list, in schema order (at most the schema's)."""
    rows = dictionary.where(F.col("field").isin(fields)).select("field").distinct().collect()
    known = {r.field for r in rows} | set(allowed)
    return [f for f in fields if f in known]


def classify(
    values: DataFrame,
    dictionary: DataFrame,
    allowed: Allowed,
    spread: list[str] | None = None,
    fields: list[str] | None = None,
) -> DataFrame:
    """``dict`` for a dictionary hit on the normalized value, ``ok`` for an allowed value.

    ``standard`` and ``method`` are null where neither applies; nulls and fields that are not named
    pass through.
    """
    text = _of_fields(F.col("value"), fields)
    texts = values.withColumns(
        {"raw": strip(text), "norm": F.when(text.isNotNull(), normalize(text))}
    )
    entries = _entries(dictionary, normalize(F.col("raw")), "norm")
    found = lookup_join(texts, entries, ["field", "norm"], spread or ROW, bound=dictionary)
    is_ok = F.array_contains(allowed_list(F.col("field"), allowed), F.col("raw"))
    return found.select(
        *values.columns,
        "raw",
        "norm",
        F.coalesce("standard", F.when(is_ok, F.col("raw"))).alias("standard"),
        F.when(F.col("standard").isNotNull(), METHOD_DICT).when(is_ok, METHOD_OK).alias("method"),
    )


def _is_open(fields: list[str] | None) -> Column:
    found = F.col("method").isNull() & F.col("value").isNotNull()
    return found if fields is None else found & F.col("field").isin(fields)


def unresolved_keys(classified: DataFrame, fields: list[str] | None = None) -> DataFrame:
    """Distinct unknown (field, normalized value) with the first raw spelling."""
    unknown = classified.where(_is_open(fields))
    return unknown.groupBy(F.col("field").alias("scope"), F.col("norm").alias("key")).agg(
        F.min_by("raw", F.struct(*ROW)).alias("raw")
    )


def standardize_values(
    values: DataFrame,
    dictionary: DataFrame,
    allowed: Allowed,
    resolver: Resolver | None = None,
    strict: bool = True,
    repeat_scope: str = "file",
    fields: list[str] | None = None,
) -> Standardized:
    """Dictionary, closed list, then resolver, asked once per distinct normalized value.

    Only ``fields`` are touched (all if none are named). The first row of a value the resolver answered is logged with its method, later rows of the
    file (of all files with ``repeat_scope="all"``) as dictionary hits. A value without an answer
    keeps its raw text and an empty standard.
    """
    classified = classify(values, dictionary, allowed, fields=fields)
    open_row = _is_open(fields)
    if resolver is None:
        spark = values.sparkSession
        learned = refused = spark.createDataFrame([], SUGGESTIONS)
        placed = classified.withColumn("suggestion", F.lit(None).cast("string"))
        repeated = F.lit(False)
    else:
        # Three steps read the classified values: the keys to ask, the first rows, the result.
        classified = cut_lineage(classified, "classified")
        learned, refused = resolve_keys(
            unresolved_keys(classified, fields), resolver, allowed, strict
        )
        keyed = classified.withColumns({"scope": F.col("field"), "key": F.col("norm")})
        suggested = attach(keyed, learned, [*ROW, "field"])
        # Only answered values need their first row; the others stay out of this aggregation.
        order, scope = (["row_idx"], ["file_id"]) if repeat_scope == "file" else (ROW, [])
        position = F.struct(*order)
        firsts = (
            suggested.where(open_row & F.col("suggestion").isNotNull())
            .groupBy(*scope, "field", "norm")
            .agg(F.min(position).alias("__first"))
        )
        firsts = cut_lineage(firsts, "firsts")
        placed = lookup_join(suggested, firsts, [*scope, "field", "norm"], ROW)
        repeated = F.col("suggestion").isNotNull() & (position != F.col("__first"))
    method = F.when(repeated, METHOD_DICT).otherwise(METHOD_RESOLVER)
    done = placed.select(
        *[F.col(c) for c in values.columns],
        "raw",
        "norm",
        F.when(open_row, F.coalesce("suggestion", F.lit(""))).otherwise(F.col("standard")).alias(
            "standard"
        ),
        F.when(open_row, method).otherwise(F.col("method")).alias("method"),
    )
    return Standardized(done, learned, refused)


def value_log(standardized: DataFrame) -> DataFrame:
    """One decision per non-null value; ``position`` tells the rows of a file apart."""
    return standardized.where(F.col("method").isNotNull()).select(
        "file_id",
        F.col("row_idx").alias("position"),
        F.col("field").alias("scope"),
        F.col("raw").alias("nom_original"),
        F.col("standard").alias("champ_standard"),
        F.col("method").alias("methode"),
    )


def summarize_log(log: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """The decision log as counts per distinct decision."""
    names = [*(keys or []), "scope", "nom_original", "champ_standard", "methode"]
    return log.groupBy(*names).agg(F.count("*").alias("n"))
