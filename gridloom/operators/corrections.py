"""Manual corrections, audit tables and the establishment dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.operators.lookup import lookup_join
from gridloom.operators.ordered import number_any
from gridloom.operators.resolvers import HEADER
from gridloom.session import cut_lineage


def corrections(log: DataFrame, edited: DataFrame) -> DataFrame:
    """Decisions whose standard was changed since: old and new standard per chronogram and field.

    ``log(id_chronogramme, scope, nom_original, champ_standard)``, ``edited(field, raw, standard)``.
    """
    now = edited.where(F.col("standard") != "").groupBy(
        F.col("field").alias("scope"), F.col("raw").alias("nom_original")
    ).agg(F.sort_array(F.collect_set("standard")).alias("__new"))
    # An original that stands in every log is split between tasks.
    met = lookup_join(
        log, cut_lineage(now, "edited"), ["scope", "nom_original"], ["id_chronogramme", "champ_standard"], "inner"
    )
    other = F.filter("__new", lambda x: x != F.col("champ_standard"))
    changed = met.withColumn("new_value", F.get(other, F.lit(0))).where("new_value IS NOT NULL")
    return changed.groupBy(
        "id_chronogramme", F.col("scope").alias("field"), F.col("champ_standard").alias("old_value")
    ).agg(F.min("new_value").alias("new_value"))


def apply_corrections(
    facts: DataFrame, changed: DataFrame, fields: list[str], spread: list[str]
) -> DataFrame:
    """Rewrite old standards to new ones, only inside the chronogram concerned.

    A chronogram's corrections become one map, as large as its distinct decisions; the facts meet it in one
    join and every field is looked up within the row.
    """
    per_value = changed.where(F.col("field").isin(fields)).groupBy("id_chronogramme", "field", "old_value")
    entry = F.struct(F.struct("field", "old_value"), F.col("__new"))
    maps = per_value.agg(F.min("new_value").alias("__new")).groupBy("id_chronogramme")
    maps = cut_lineage(maps.agg(F.map_from_entries(F.collect_list(entry)).alias("__map")), "corrections")
    joined = lookup_join(facts, maps, ["id_chronogramme"], spread)
    new = {c: F.try_element_at("__map", F.struct(F.lit(c).alias("field"), F.col(c).alias("old_value"))) for c in fields}
    return joined.withColumns({c: F.coalesce(n, F.col(c)) for c, n in new.items()}).select(*facts.columns)


def control_report(log: DataFrame) -> DataFrame:
    """Headers and values by chronogram and decision."""
    kind = F.when(F.col("scope") == HEADER, "En-têtes").otherwise("Valeurs")
    return log.groupBy("id_chronogramme", kind.alias("onglet"), F.col("methode").alias("decision")).agg(
        F.count("*").alias("n"),
        F.count_if(F.coalesce(F.col("champ_standard"), F.lit("")) == "").alias("n_open"),
    )


def correspondence(log: DataFrame) -> DataFrame:
    """Distinct (scope, original, standard, source)."""
    return log.select(
        "scope",
        F.col("nom_original").alias("original"),
        F.col("champ_standard").alias("standard"),
        F.col("methode").alias("source"),
    ).distinct()


def correspondence_by_chronogram(log: DataFrame) -> DataFrame:
    """The same with the chronogram in which each was decided."""
    return log.select(
        "id_chronogramme",
        "scope",
        F.col("nom_original").alias("original"),
        F.col("champ_standard").alias("standard"),
        F.col("methode").alias("source"),
    ).distinct()


def establishments(dimension: DataFrame) -> DataFrame:
    """One row per establishment name with a number of its own."""
    unique = (
        dimension.where(F.col("etablissement_nom").isNotNull())
        .groupBy(F.col("etablissement_nom").alias("nom"))
        .agg(F.min("etablissement_type").alias("type"))
    )
    return number_any(unique, ["nom"], "id_etablissement").select("id_etablissement", "nom", "type")


def link_establishments(dimension: DataFrame, known: DataFrame) -> DataFrame:
    names = known.select("id_etablissement", F.col("nom").alias("etablissement_nom"))
    return lookup_join(dimension, names, ["etablissement_nom"], dimension.columns)
