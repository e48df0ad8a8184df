"""Context columns, inject numbers and counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.functions.text import is_blank
from gridloom.operators.lookup import lookup_join
from gridloom.operators.ordered import WIDTH, running_count
from gridloom.session import cut_lineage

CONTEXT = [
    "id_chronogramme", "etablissement_nom", "etablissement_type", "nom_chronogramme", "date_exercice",
]


def add_context(df: DataFrame, submissions: DataFrame, ordinal: str = "row_idx") -> DataFrame:
    """The five context columns of the file; they replace columns of the same name."""
    own = df.select(*[c for c in df.columns if c not in CONTEXT])
    return lookup_join(
        own, submissions.select("file_id", *CONTEXT), ["file_id"], [ordinal], how="inner"
    )


def number_rows(
    df: DataFrame,
    out: str = "numero_inject",
    ordinal: str = "row_idx",
    width: int = WIDTH,
    sparse: bool = False,
) -> DataFrame:
    """1..n per file in row order; ``sparse`` for orders with wide gaps."""
    return running_count(df, ["file_id"], ordinal, out, width=width, sparse=sparse)


def fill_missing_ids(
    df: DataFrame, id_col: str = "id_inject", ordinal: str = "row_idx", width: int = WIDTH
) -> DataFrame:
    """Blank ids get 1..k in row order, others are kept."""
    blank = is_blank(F.col(id_col))
    counted = running_count(df, ["file_id"], ordinal, "__k", blank, width)
    filled = F.when(blank, F.col("__k").cast("string")).otherwise(F.col(id_col))
    return counted.withColumn(id_col, filled).select(*df.columns)


def add_counts(df: DataFrame, ordinal: str = "row_idx") -> DataFrame:
    """``nb_injects``: rows of the file, on each of its rows."""
    counts = df.groupBy("file_id").agg(F.count("*").alias("nb_injects"))
    return lookup_join(df, cut_lineage(counts, "counts"), ["file_id"], [ordinal], how="inner")


def enrich(
    df: DataFrame,
    submissions: DataFrame,
    id_col: str = "id_inject",
    ordinal: str = "row_idx",
    width: int = WIDTH,
) -> DataFrame:
    """Context, numbers and counts in one go.

    A file without any id is numbered 1..n, in ``numero_inject`` and in its id column; otherwise only
    blank ids are filled. Both need the same running count of blank ids, and the context comes with it: the rows
    are moved once.
    """
    rows = df if id_col in df.columns else df.withColumn(id_col, F.lit(None).cast("string"))
    rows = rows.select(*[c for c in rows.columns if c not in CONTEXT])
    blank = is_blank(F.col(id_col))
    context = submissions.select("file_id", *CONTEXT)
    counted = running_count(
        rows, ["file_id"], ordinal, "__k", blank, width, "nb_injects", "__n_blank", along=context
    )
    numbered = counted.withColumns(
        {
            "numero_inject": F.when(F.col("__n_blank") == F.col("nb_injects"), F.col("__k")),
            id_col: F.when(blank, F.col("__k").cast("string")).otherwise(F.col(id_col)),
        }
    )
    told = [c for c in numbered.columns if c not in ("file_id", "__k", "__n_blank", *CONTEXT)]
    return numbered.select("file_id", *told, *CONTEXT)
