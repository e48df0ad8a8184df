"""Submission records: required fields, defaults, cleaning, names, registration."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.functions.dates import format_date, utc_text
from gridloom.functions.text import clean_ascii, safe_name
from gridloom.operators.lookup import lookup_join
from gridloom.operators.ordered import WIDTH, number_any, running_count

# Required fields of a submission, in the order of the error text.
REQUIRED = [
    "nom_chronogramme",
    "date_exercice",
    "lieu_exercice",
    "etablissement_nom",
    "etablissement_type",
    "submitter",
    "nom_fichier_excel",
]
# What an absent field becomes; the name and the date come from file and clock.
DEFAULTS = {
    "lieu_exercice": "N/A",
    "etablissement_nom": "Auto",
    "etablissement_type": "N/A",
    "submitter": "pipeline",
}
# Fields whose text is cleaned.
TEXT_FIELDS = ["nom_chronogramme", "lieu_exercice", "etablissement_nom", "etablissement_type", "submitter"]


class Checked(NamedTuple):
    valid: DataFrame
    rejected: DataFrame


def missing_fields(names: list[str]) -> Column:
    """Names of the fields that are null or empty."""
    tests = [F.when(F.coalesce(F.col(n).cast("string"), F.lit("")) == "", n) for n in names]
    return F.array_compact(F.array(*tests))


def check_required(submissions: DataFrame, required: list[str] | None = None) -> Checked:
    names = required or REQUIRED
    marked = submissions.withColumn("missing", F.array_join(missing_fields(names), ", "))
    good = F.col("missing") == ""
    reason = F.concat(F.lit("Missing required metadata fields: "), F.col("missing"))
    return Checked(
        marked.where(good).drop("missing"),
        marked.where(~good).withColumn("reason", reason).drop("missing"),
    )


def file_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def stem(path: Column) -> Column:
    return F.regexp_replace(file_name(path), r"(?<=.)\.[^.]*$", "")


def with_defaults(submissions: DataFrame, today: Column | None = None) -> DataFrame:
    """Fill absent (null) fields; the file name always comes from the path."""
    day = F.date_format(F.current_date() if today is None else today, "yyyy-MM-dd")
    filled = {name: F.coalesce(F.col(name), F.lit(value)) for name, value in DEFAULTS.items()}
    filled["nom_chronogramme"] = F.coalesce(F.col("nom_chronogramme"), stem(F.col("file_path")))
    filled["date_exercice"] = F.coalesce(F.col("date_exercice"), day)
    filled["nom_fichier_excel"] = file_name(F.col("file_path"))
    return submissions.withColumns(filled)


def clean_metadata(submissions: DataFrame, at: Column | None = None) -> DataFrame:
    """Cleaned texts, ``yyyy-MM-dd`` dates, UTC submission time and a count."""
    moment = F.current_timestamp() if at is None else at
    cleaned = {name: clean_ascii(F.col(name)) for name in TEXT_FIELDS}
    cleaned["date_exercice"] = format_date(F.col("date_exercice"))
    cleaned["fichier_source"] = clean_ascii(F.col("nom_fichier_excel"))
    stamp = utc_text(moment, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    cleaned["date_soumission"] = F.concat(stamp, F.lit("+00:00"))
    cleaned["nb_injects"] = F.coalesce(F.col("nb_injects").try_cast("long"), F.lit(0))
    return submissions.withColumns(cleaned)


def structured_name(submissions: DataFrame) -> DataFrame:
    """``Chronogramme_<establishment>_<name>_<date>`` without ending; only workbooks are taken."""
    parts = [
        F.lit("Chronogramme"),
        safe_name(F.col("etablissement_nom")),
        safe_name(F.col("nom_chronogramme")),
        format_date(F.col("date_exercice"), form_variant=True),
    ]
    return submissions.where(F.lower("file_path").endswith(".xlsx")).withColumn(
        "base_name", F.btrim(F.concat_ws("_", *parts), F.lit("_"))
    )


def unique_names(
    submissions: DataFrame,
    ordinal: str,
    existing: DataFrame | None = None,
    at: Column | None = None,
    width: int = WIDTH,
) -> DataFrame:
    """File names without collisions inside the batch or with ``existing(file_name)``.

    The first submission of a free name takes it; others get the time, from the second of these on
    also a number.
    """
    # Ordinals of submissions are times or numbers from elsewhere: they may lie far apart.
    named = running_count(
        structured_name(submissions), ["base_name"], ordinal, "rank", width=width, sparse=True
    )
    if existing is None:
        taken = named.withColumn("taken", F.lit(0))
    else:
        known = existing.select(
            F.regexp_replace("file_name", r"\.xlsx$", "").alias("base_name"), F.lit(1).alias("taken")
        ).distinct()
        taken = lookup_join(named, known, ["base_name"], [ordinal]).fillna(0, ["taken"])
    time = F.date_format(F.current_timestamp() if at is None else at, "HHmmss")
    turn = F.col("rank") + F.col("taken")
    number = F.when(turn > 2, F.concat(F.lit("_"), (turn - 1).cast("string"))).otherwise("")
    suffix = F.when(turn == 1, F.lit("")).otherwise(F.concat(F.lit("_"), time, number))
    return taken.withColumn("file_name", F.concat("base_name", suffix, F.lit(".xlsx"))).drop(
        "rank", "taken", "base_name"
    )


def assign_ids(
    submissions: DataFrame, start: int, ordinal: str | None = None, width: int = WIDTH
) -> DataFrame:
    """``id_chronogramme`` = ``start`` + 1.. , along ``ordinal`` if there is one.

    ``start`` is the largest stored id; with one writer at a time the ids never clash.
    """
    if ordinal is None:
        numbered = number_any(submissions, ["file_id"], "__n")
    else:
        numbered = running_count(
            submissions.withColumn("__all", F.lit(0)), ["__all"], ordinal, "__n", width=width, sparse=True
        ).drop("__all")
    return numbered.withColumn("id_chronogramme", F.lit(start) + F.col("__n")).drop("__n")
