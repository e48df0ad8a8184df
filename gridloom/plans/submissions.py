"""Registering handed-in files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.operators import metadata
from gridloom.session import cut_lineage
from gridloom.sinks.store import Store


def submit(
    store: Store,
    submissions: DataFrame,
    folder: str,
    ordinal: str,
    existing: DataFrame | None = None,
    at: Column | None = None,
    batch_id: str | None = None,
) -> DataFrame:
    """Name each workbook, append its dimension row and return ``(file_id, id_chronogramme, path)``.

    ``existing(file_name)`` lists the names that are taken in the folder. Other file types are left
    out. With a ``batch_id`` the same files get the same ids when it is handed in again.
    """
    named = metadata.unique_names(submissions, ordinal, existing, at)
    cleaned = metadata.clean_metadata(
        named.withColumn("nom_fichier_excel", F.col("file_name")), at
    )
    if batch_id is None:
        known = metadata.assign_ids(cleaned, store.last_id(), ordinal)
    else:
        known = store.ledger.with_ids(cleaned, batch_id, store.max_id(but=batch_id), ordinal)
    path = F.concat(F.lit(f"{folder.rstrip('/')}/"), "file_name")
    placed = cut_lineage(known.withColumn("path", path), "submissions")
    store.append_dimension(placed, batch_id)
    return placed.select("file_id", "id_chronogramme", "path")
