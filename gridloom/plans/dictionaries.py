"""Growing the dictionaries from the cells of many files."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.model import NULL_TOKENS
from gridloom.operators import growth, headers, structure
from gridloom.operators.lookup import lookup_join
from gridloom.session import cut_lineage

SHEET = structure.SHEET
COLUMN = [*SHEET, "col_idx"]


class HeaderGrowth(NamedTuple):
    added: DataFrame
    counts: DataFrame


def within_budget(df: DataFrame, sheets: DataFrame, max_files: int | None) -> DataFrame:
    """The rows of the first ``max_files`` files by name; all rows without a budget."""
    if max_files is None:
        return df
    names = sheets.select(F.col("file_id").alias("path")).distinct()
    # Bounded by the budget itself.
    chosen = growth.file_budget(names, max_files)
    return df.join(chosen.withColumnRenamed("path", "file_id"), "file_id", "left_semi")


def _fullest(
    cells: DataFrame, sheets: DataFrame, na_tokens: Sequence[str] | None = NULL_TOKENS
) -> DataFrame:
    stats = structure.sheet_stats(cells, sheets, na_tokens=na_tokens)
    return cut_lineage(structure.main_sheet(stats, use_keywords=False), "main")


def header_growth(
    cells: DataFrame, sheets: DataFrame, dictionary: DataFrame, max_files: int | None = None
) -> HeaderGrowth:
    """Headers of each file's fullest sheet that the dictionary does not hold, and the counts."""
    cells, sheets = within_budget(cells, sheets, max_files), within_budget(sheets, sheets, max_files)
    kept = structure.keep_main(cells, _fullest(cells, sheets))
    ranges = cut_lineage(structure.header_row_by_fill(kept), "ranges")
    found = cut_lineage(structure.header_cells(kept, ranges), "headers")
    added = growth.new_headers(found, dictionary)
    return HeaderGrowth(added, growth.header_growth_counts(found, added))


def value_growth(
    cells: DataFrame,
    sheets: DataFrame,
    header_dictionary: DataFrame,
    value_dictionary: DataFrame,
    max_files: int | None = None,
    keywords: list[str] | None = None,
    na_tokens: Sequence[str] | None = NULL_TOKENS,
) -> DataFrame:
    """Values of canonical columns that the dictionary does not hold.

    Only the columns whose header leads to a canonical field meet the cells.
    """
    cells, sheets = within_budget(cells, sheets, max_files), within_budget(sheets, sheets, max_files)
    main = _fullest(cells, sheets, na_tokens)
    kept = structure.keep_main(cells, main)
    heads = structure.header_row_by_keyword(kept, main, keywords).select(*SHEET, "header_row")
    ends = main.select(
        *SHEET, F.lit(1).cast("long").alias("first_col"), F.col("max_col").alias("last_col")
    )
    ranges = cut_lineage(heads.join(ends, SHEET), "ranges")
    named = headers.by_rename(
        cut_lineage(structure.header_cells(kept, ranges), "headers"), header_dictionary
    )
    canonical = named.where(headers.canonical_field(F.col("standard")).isNotNull())
    columns = canonical.join(ranges.select(*SHEET, "header_row"), SHEET).select(
        *COLUMN, F.col("standard").alias("header"), "header_row"
    )
    shown = lookup_join(kept, cut_lineage(columns, "columns"), COLUMN, ["row_idx"], "inner")
    below = shown.where(F.col("row_idx") > F.col("header_row"))
    if na_tokens:
        below = below.where(~F.col("value").isin(list(na_tokens)))
    return growth.new_values(below.select("header", "value"), value_dictionary)
