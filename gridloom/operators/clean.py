"""Cleaning: merged-cell filling, blank rows and columns, summary rows.

The long functions work on a dense ``grid(file_id, sheet_idx, row_idx, col_idx, value)``; the
``*_wide`` ones on tables that already share their columns.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from gridloom.functions.text import is_blank, strip
from gridloom.operators.lookup import lookup_join
from gridloom.operators.ordered import WIDTH, carry_forward
from gridloom.operators.structure import BLOCK, HEAD, MAIN_SHEETS, dense_blocks
from gridloom.session import cut_lineage

SHEET = ["file_id", "sheet_idx"]
ROW = [*SHEET, "row_idx"]
COLUMN = [*SHEET, "col_idx"]

KIND = "kind"
BODY, HEADER, PHASE = 0, 1, 2

# How a summary row begins.
PARASITIC = ["total", "phase"]


def _value_or_null(col: Column) -> Column:
    return F.when(~is_blank(col), col)


def _starts_parasitic(col: Column, words: list[str]) -> Column:
    text = F.lower(strip(col))
    test = F.lit(False)
    for word in words:
        test = test | F.startswith(text, F.lit(word))
    return test


def _names_parasitic(values: Column, words: list[str] | None = None) -> Column:
    """Whether a summary word stands anywhere in the texts: one look, before each of them is trimmed."""
    text = F.lower(F.array_join(values, "\n"))
    test = F.lit(False)
    for word in words or PARASITIC:
        test = test | F.contains(text, F.lit(word))
    return F.coalesce(test, F.lit(False))


def _only_parasitic(values: Column, words: list[str] | None = None) -> Column:
    """Whether the only non-blank text starts with a summary word."""
    texts = F.filter(values, lambda v: ~is_blank(v))
    # An array of one names what is used twice, so that it is worked out once.
    only = F.exists(F.array(texts), lambda t: (F.size(t) == 1) & _starts_parasitic(F.get(t, F.lit(0)), words or PARASITIC))
    return F.coalesce(only, F.lit(False))


def fill_down(grid: DataFrame, width: int = WIDTH) -> DataFrame:
    """Each null takes the last value above it in its column."""
    return carry_forward(grid, COLUMN, "row_idx", ["value"], width)


def fill_right(grid: DataFrame) -> DataFrame:
    """Each null takes the value to its left; a window never exceeds one row's columns."""
    left = W.partitionBy(*ROW).orderBy("col_idx").rowsBetween(W.unboundedPreceding, W.currentRow)
    return grid.withColumn("value", F.last("value", True).over(left))


def blank_to_null(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    names = ["value"] if columns is None else columns
    return df.withColumns({c: _value_or_null(F.col(c)) for c in names})


def drop_empty_rows(grid: DataFrame) -> DataFrame:
    filled = F.count("value").over(W.partitionBy(*ROW))
    return blank_to_null(grid).withColumn("__n", filled).where("__n > 0").drop("__n")


def filled_columns(grid: DataFrame, skip_first: bool = True) -> DataFrame:
    """Columns with a value below the first row (in any row if there is only one).

    The grid is dense, so every column of a sheet has the same rows and one aggregation tells the
    first row's share.
    """
    per_column = grid.groupBy(*COLUMN).agg(
        F.count("*").alias("n_rows"),
        F.count("value").alias("n"),
        F.min_by(F.col("value").isNotNull().cast("int"), "row_idx").alias("in_first"),
    )
    first_counts = F.when(F.lit(skip_first) & (F.col("n_rows") > 1), F.col("in_first")).otherwise(0)
    return per_column.where(F.col("n") > first_counts).select(*COLUMN)


def drop_empty_cols(grid: DataFrame, skip_first: bool = True) -> DataFrame:
    """Drop columns without values; the grid is written once, as the count and the result read it."""
    nulled = cut_lineage(blank_to_null(grid), "grid")
    kept = cut_lineage(filled_columns(nulled, skip_first), "columns")
    return lookup_join(nulled, kept, COLUMN, ["row_idx"], "left_semi")


def drop_parasitic_rows(grid: DataFrame, words: list[str] | None = None) -> DataFrame:
    """Drop rows whose only non-blank cell starts with a summary word."""
    row = W.partitionBy(*ROW)
    shown = _value_or_null(F.col("value"))
    marked = grid.withColumns(
        {"__n": F.count(shown).over(row), "__only": F.max(shown).over(row)}
    )
    bad = (F.col("__n") == 1) & _starts_parasitic(F.col("__only"), words or PARASITIC)
    return marked.where(~F.coalesce(bad, F.lit(False))).drop("__n", "__only")


def clean_table(
    grid: DataFrame, order: str = "reference", skip_first: bool = True, width: int = WIDTH
) -> DataFrame:
    """Fill, then drop blank rows, empty columns and summary rows.

    ``order="reference"`` fills first, so rows of nulls become copies of the row above;
    ``order="clean_first"`` drops blank and summary rows before filling.
    """
    if order == "clean_first":
        kept = drop_parasitic_rows(drop_empty_rows(grid))
        filled = fill_right(fill_down(kept, width))
        return drop_empty_cols(filled, skip_first)
    filled = drop_empty_rows(fill_right(fill_down(grid, width)))
    return drop_parasitic_rows(drop_empty_cols(filled, skip_first))


def _row_marks(grid: DataFrame) -> DataFrame:
    """The grid with ``__n`` and ``__only``: a row's non-blank cells and the greatest of them."""
    row = W.partitionBy(*SHEET, BLOCK, "row_idx")
    shown = _value_or_null(F.col("value"))
    return grid.withColumns({"__n": F.count(shown).over(row), "__only": F.max(shown).over(row)})


def _body(
    cells: DataFrame, ranges: DataFrame, order: str, phases: bool, tokens: Sequence[str] | None, width: int
) -> DataFrame:
    """The dense grid in blocks as filling finds it, each row with its ``KIND``: header rows stay as they are, and so
    do phase rows if these are taken out; with ``order="clean_first"`` blank and summary rows are left out."""
    grid = dense_blocks(cells, ranges, tokens, width, heads=True)
    grid = grid.withColumn(KIND, F.when(F.col(HEAD), HEADER).otherwise(BODY)).drop(HEAD)
    body = F.col(KIND) == BODY
    lone = lambda words: F.coalesce((F.col("__n") == 1) & _starts_parasitic(F.col("__only"), words), F.lit(False))
    if phases:
        kind = F.when(body & lone(["phase"]), PHASE).otherwise(F.col(KIND))
        grid = _row_marks(grid).withColumn(KIND, kind).drop("__n", "__only")
    if order == "clean_first":
        marked = _row_marks(grid.withColumn("value", F.when(body, _value_or_null(F.col("value"))).otherwise(F.col("value"))))
        grid = marked.where(~body | ((F.col("__n") > 0) & ~lone(PARASITIC))).drop("__n", "__only")
    return grid


def phase_rows(
    cells: DataFrame, ranges: DataFrame, tokens: Sequence[str] | None = None, width: int = WIDTH
) -> DataFrame:
    """``lone_phases`` of the dense grid of the ranges."""
    return lone_phases(dense_blocks(cells, ranges, tokens, width).drop(BLOCK))


def filled_rows(
    cells: DataFrame,
    ranges: DataFrame,
    order: str = "reference",
    phases: bool = False,
    tokens: Sequence[str] | None = None,
    width: int = WIDTH,
) -> DataFrame:
    """The body of ``grid_rows`` alone."""
    found = grid_rows(cells, ranges, order, phases, tokens, width)
    return found.where(F.col(KIND) == BODY).drop(KIND)


def grid_rows(
    cells: DataFrame,
    ranges: DataFrame,
    order: str = "reference",
    phases: bool = False,
    tokens: Sequence[str] | None = None,
    width: int = WIDTH,
) -> DataFrame:
    """``(file_id, sheet_idx, row_idx, kind, cells)``: the rows that filling and blank rows leave, in one shuffle, and
    beside them, not filled, the header rows and with ``phases`` the phase rows.

    ``cells`` is an array of ``(col_idx, value)``, at most the columns of a row. A block of rows fills by itself;
    what stands above it in a sheet of several blocks comes as one row of last values per block.
    """
    rows = _body(cells, ranges, order, phases, tokens, width)
    body = F.col(KIND) == BODY
    filled_from = lambda value: F.when(body, value).otherwise(F.col("value"))
    number = lambda row: F.floor(row / F.lit(float(width)))
    tall = ranges.where(number(F.col("last_row")) > number(F.col("header_row") + 1))
    # In the order in which the dense grid comes; other rows than those of the body give nothing down.
    down = W.partitionBy(*SHEET, BLOCK, "col_idx").orderBy("row_idx")
    down = down.rowsBetween(W.unboundedPreceding, W.currentRow)
    filled = rows.withColumn("value", filled_from(F.last(F.when(body, F.col("value")), True).over(down)))
    if not tall.isEmpty():
        place = ["row_idx", "col_idx"]
        some = lookup_join(cells, tall.select(*SHEET), SHEET, place, "left_semi", max_rows=MAIN_SHEETS)
        above = _above(_body(some, tall, order, phases, tokens, width).where(body))
        at = (F.col("col_idx") - F.col("__from")).cast("int")
        filled = filled.join(above, [*SHEET, BLOCK], "left").withColumn(
            "value", filled_from(F.coalesce("value", F.get("__above", at)))
        )
    row = W.partitionBy(*SHEET, BLOCK, "row_idx")
    right = row.orderBy("col_idx").rowsBetween(W.unboundedPreceding, W.currentRow)
    filled = filled.withColumn("value", filled_from(F.last("value", True).over(right)))
    filled = filled.withColumn("value", filled_from(_value_or_null(F.col("value"))))
    packed = filled.groupBy(*SHEET, BLOCK, "row_idx", KIND).agg(
        F.collect_list(F.struct("col_idx", "value")).alias("cells"), F.count("value").alias("__n")
    )
    return packed.where("__n > 0").select(*ROW, KIND, "cells")


def heads_of(grid: DataFrame) -> DataFrame:
    """``structure.header_cells`` of the ranges that ``grid_rows`` was made of, as far as they have a body."""
    each = grid.where(F.col(KIND) == HEADER).select(*SHEET, F.inline("cells"))
    return each.where(F.col("value").isNotNull()).select(*SHEET, "col_idx", strip(F.col("value")).alias("raw_header"))


def phases_of(grid: DataFrame) -> DataFrame:
    """``phase_rows`` of the ranges that ``grid_rows`` was made of."""
    only = F.get(F.filter(F.col("cells")["value"], lambda v: ~is_blank(v)), F.lit(0))
    return grid.where(F.col(KIND) == PHASE).select(*ROW, strip(only).alias("phase"))


def _above(body: DataFrame) -> DataFrame:
    """The values that come down into each block: an array along the sheet's columns, from ``__from`` on."""
    last = body.groupBy(*COLUMN, BLOCK).agg(
        F.max_by("value", F.when(F.col("value").isNotNull(), F.col("row_idx"))).alias("last")
    )
    before = W.partitionBy(*COLUMN).orderBy(BLOCK).rowsBetween(W.unboundedPreceding, -1)
    carried = last.withColumn("value", F.last("last", True).over(before))
    # At most the columns of a row.
    held = F.array_sort(F.collect_list(F.struct("col_idx", "value"))).alias("held")
    per_block = carried.groupBy(*SHEET, BLOCK).agg(held)
    return per_block.select(
        *SHEET, BLOCK, F.col("held")[0]["col_idx"].alias("__from"), F.col("held")["value"].alias("__above")
    )


def with_columns(rows: DataFrame, columns: DataFrame, kept: DataFrame) -> DataFrame:
    """Rows of ``filled_rows`` as ``(file_id, sheet_idx, row_idx, shown)``, without summary rows.

    ``columns`` says with any number of rows per kept column what becomes of its cells; ``kept`` is a table to
    count in its place. The columns of a sheet meet its rows as one array, and all else is within the row.
    """
    told = [c for c in columns.columns if c not in COLUMN]
    # At most the columns of a sheet's row.
    entries = columns.groupBy(*COLUMN).agg(F.collect_list(F.struct(*told)).alias("entries"))
    ordered = F.array_sort(F.collect_list(F.struct("col_idx", "entries")))
    sheets = entries.groupBy(*SHEET).agg(ordered.alias("__columns"))
    sheets = sheets.select(*SHEET, F.col("__columns")["col_idx"].alias("__at"), F.col("__columns")["entries"].alias("__told"))
    joined = lookup_join(rows, sheets, SHEET, ["row_idx"], "inner", bound=kept)

    def cell(c: Column) -> Column:
        # Zero where the column is not kept.
        place = F.array_position("__at", c["col_idx"])
        found = F.when(place > 0, F.get("__told", (place - 1).cast("int")))
        fields = [c["col_idx"].alias("col_idx"), c["value"].alias("value")]
        shown = F.transform(found, lambda e: F.struct(*fields, *[e[name].alias(name) for name in told]))
        return F.coalesce(shown, F.array())

    maybe = _names_parasitic(F.col("cells")["value"])
    # As a filter on the new column the test would go below it, and the cells be looked up again for each use.
    shown = F.array(F.struct(F.flatten(F.transform("cells", cell)).alias("shown")))
    return joined.select(*ROW, F.inline(F.filter(shown, lambda s: ~(maybe & _only_parasitic(s["shown"]["value"])))))


def wide_rows(
    rows: DataFrame,
    picked: DataFrame,
    kept: DataFrame,
    fields: list[str],
    presence: tuple[str, list[str]],
    texts: list[str],
) -> DataFrame:
    """Rows of ``filled_rows`` with one column per field, without summary rows: ``to_wide`` of what ``with_columns``
    makes of them, within the row.

    ``picked`` is ``(file_id, sheet_idx, field, col_idx)``, one column per field of a sheet. The columns ``texts`` have
    all distinct values of their field in place of the greatest one, in order; only a place that was written twice
    has more than one.
    """
    prefix, flagged = presence
    place = {f: f"__{i}" for i, f in enumerate({**dict.fromkeys(fields), **dict.fromkeys(flagged)})}
    # At most the columns of a sheet's row; a column that feeds two fields counts twice, as its cells do.
    columns = kept.join(picked, [*COLUMN], "left")
    told = [F.max(F.when(F.col("field") == f, F.col("col_idx"))).alias(c) for f, c in place.items()]
    sheets = columns.groupBy(*SHEET).agg(F.collect_list("col_idx").alias("__at"), *told)
    joined = lookup_join(rows, sheets, SHEET, ["row_idx"], "inner", bound=kept)
    at, held = F.col("cells")["col_idx"], F.col("cells")["value"]

    def times(c: Column) -> Column:
        return F.array_repeat(c["value"], F.size(F.filter("__at", lambda a: a == c["col_idx"])))

    bad = _names_parasitic(held) & _only_parasitic(F.flatten(F.transform("cells", times)))
    once = F.size(F.array_distinct(at)) == F.size(at)

    def value_of(field: str) -> Column:
        own = F.col(place[field])
        found = F.array_position(at, own).cast("int")
        one = F.when(found > 0, F.get(held, found - 1))
        inside = F.filter("cells", lambda c: (c["col_idx"] == own) & c["value"].isNotNull())["value"]
        if field not in texts:
            return F.when(once, one).otherwise(F.array_max(inside))
        several = F.array_sort(F.array_distinct(inside))
        # Without such a column there is no value.
        return F.when(once, F.array_compact(F.array(one))).otherwise(F.coalesce(several, F.array()))

    return joined.where(F.arrays_overlap(at, "__at") & ~bad).select(
        *ROW,
        *[value_of(f).alias(f) for f in fields],
        *[F.coalesce(F.array_contains(at, F.col(place[f])), F.lit(False)).alias(prefix + f) for f in flagged],
    )


def carry_phase(
    rows: DataFrame, keys: list[str], ordinal: str, text: str, keep: bool = True, width: int = WIDTH
) -> DataFrame:
    """Take summary rows out of a table; with ``keep`` the rows below carry the phase's text."""
    is_phase = _starts_parasitic(F.col(text), ["phase"])
    phase = F.when(is_phase, strip(F.col(text)))
    marked = rows.withColumns({"phase_exercice": phase, "__p": F.coalesce(is_phase, F.lit(False))})
    if keep:
        marked = carry_forward(marked, keys, ordinal, ["phase_exercice"], width)
    else:
        marked = marked.withColumn("phase_exercice", F.lit(None).cast("string"))
    return marked.where("NOT __p").drop("__p")


def lone_phases(grid: DataFrame) -> DataFrame:
    """``(file_id, sheet_idx, row_idx, phase)`` of the rows whose only non-blank cell names a phase."""
    shown = _value_or_null(F.col("value"))
    per_row = grid.groupBy(*ROW).agg(F.count(shown).alias("n"), F.max(shown).alias("only"))
    named = per_row.where((F.col("n") == 1) & _starts_parasitic(F.col("only"), ["phase"]))
    return named.select(*ROW, strip(F.col("only")).alias("phase"))


def under_phases(wide: DataFrame, phases: DataFrame, field: str, width: int = WIDTH) -> DataFrame:
    """Rows whose ``field`` is null take the phase named last above them in their sheet."""
    heads = phases.withColumn("__head", F.lit(True)).withColumnRenamed("phase", "__phase")
    both = wide.withColumn("__phase", F.lit(None).cast("string")).unionByName(heads, allowMissingColumns=True)
    carried = carry_forward(both, SHEET, "row_idx", ["__phase"], width)
    rows = carried.where(F.col("__head").isNull())
    return rows.withColumn(field, F.coalesce(field, "__phase")).select(*wide.columns)


# Tables that already share their columns.


def fill_down_wide(
    df: DataFrame, keys: list[str], ordinal: str, columns: list[str], width: int = WIDTH
) -> DataFrame:
    return carry_forward(df, keys, ordinal, columns, width)


def fill_right_wide(df: DataFrame, columns: list[str]) -> DataFrame:
    """Fill each row from left to right; also the form for a single row."""
    filled = {
        name: F.coalesce(*[F.col(c) for c in reversed(columns[: i + 1])])
        for i, name in enumerate(columns)
    }
    return df.withColumns(filled)


def drop_empty_rows_wide(df: DataFrame, columns: list[str]) -> DataFrame:
    return blank_to_null(df, columns).dropna(how="all", subset=columns)


def drop_parasitic_rows_wide(
    df: DataFrame, columns: list[str], words: list[str] | None = None
) -> DataFrame:
    shown = F.array_compact(F.array(*[_value_or_null(F.col(c)) for c in columns]))
    bad = (F.size(shown) == 1) & _starts_parasitic(F.get(shown, F.lit(0)), words or PARASITIC)
    return df.where(~F.coalesce(bad, F.lit(False)))
