"""Which sheet, which rows and which columns hold the table.

Input is the sparse ``cells`` table (no row for an empty cell) and ``sheets`` (one row per sheet).
Row and column numbers start at 1.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from gridloom.functions.text import is_blank, light_normalize, normalize, strip
from gridloom.operators.lookup import fits_broadcast, lookup_join
from gridloom.operators.ordered import WIDTH, previous_ordinal
from gridloom.session import cut_lineage

# Words that mark a main sheet, and the probed corner.
SHEET_KEYWORDS = ["chronogramme", "exercice"]
PROBE_ROWS = PROBE_COLS = 5
# Words that mark a header row.
HEADER_KEYWORDS = ["emetteur", "destinataire", "modalite", "type", "nature"]
# Known header names.
KNOWN_HEADERS = [
    "Heure",
    "Descriptif",
    "Émetteur",
    "Cellule concernée",
    "Canal",
    "Phasage",
    "Nom de l’inject",
]

SHEET = ["file_id", "sheet_idx"]
#: Sheets or rows of sheets that are sent to every task, as long as their texts fit: a few slim columns each.
MAIN_SHEETS = 1_000_000
BLOCK = "__block"
HEAD = "__head"


def _filled(cells: DataFrame, na_tokens: Sequence[str] | None = None) -> DataFrame:
    filled = cells.where(F.col("value") != "")
    return filled.where(~F.col("value").isin(list(na_tokens))) if na_tokens else filled


def _any_word(col, words: list[str]):
    test = F.lit(False)
    for word in words:
        test = test | F.contains(col, F.lit(word))
    return test


def sheet_stats(
    cells: DataFrame,
    sheets: DataFrame,
    keywords: list[str] | None = None,
    na_tokens: Sequence[str] | None = None,
) -> DataFrame:
    """Filled cells, density and keyword flag per sheet; an empty sheet counts 0."""
    words = SHEET_KEYWORDS if keywords is None else keywords
    corner = (F.col("row_idx") <= PROBE_ROWS) & (F.col("col_idx") <= PROBE_COLS)
    # The corner test comes first, so the text test runs on few cells.
    in_corner = corner & (F.col("value_type") == "s") & _any_word(F.lower("value"), words)
    counts = (
        _filled(cells, na_tokens)
        .groupBy(*SHEET)
        .agg(F.count("*").alias("n_cells"), F.max(in_corner).alias("in_corner"))
    )
    area = F.col("max_row") * F.col("max_col")
    in_title = _any_word(F.lower("sheet_name"), words)
    return sheets.join(counts, SHEET, "left").select(
        *SHEET,
        "sheet_name",
        "max_row",
        "max_col",
        F.coalesce("n_cells", F.lit(0)).alias("n_cells"),
        F.coalesce(
            F.try_divide(F.coalesce("n_cells", F.lit(0)).cast("double"), area.cast("double")),
            F.lit(0.0),
        ).alias("density"),
        (F.coalesce(in_title, F.lit(False)) | F.coalesce("in_corner", F.lit(False))).alias(
            "has_keyword"
        ),
    )


def main_sheet(stats: DataFrame, use_keywords: bool = True) -> DataFrame:
    """The main sheet per file: keyword sheets first, then the fullest, then the first.

    Two nested aggregations instead of a window, so a file with very many sheets is combined
    before the shuffle. ``tie`` says that several sheets were equally good.
    """
    flag = F.col("has_keyword") if use_keywords else F.lit(False)
    shape = F.struct(*[c for c in ("sheet_idx", "sheet_name", "max_row", "max_col")])
    levels = (
        stats.withColumn("kw", flag)
        .groupBy("file_id", "kw", "n_cells")
        .agg(F.min(shape).alias("first"), F.count("*").alias("n_tied"))
    )
    best = levels.groupBy("file_id").agg(
        F.max_by(F.struct("first", "n_tied", "n_cells", "kw"), F.struct("kw", "n_cells")).alias("b")
    )
    return best.select(
        "file_id",
        "b.first.*",
        F.col("b.n_cells").alias("n_cells"),
        F.col("b.kw").alias("has_keyword"),
        (F.col("b.n_tied") > 1).alias("tie"),
    )


def tied_sheets(stats: DataFrame, main: DataFrame) -> DataFrame:
    """Every equally good sheet of the files whose choice was a tie."""
    ties = main.where("tie").select(
        "file_id", F.col("has_keyword").alias("kw"), F.col("n_cells").alias("n")
    )
    # A file whose best sheet has no keyword has no keyword sheet at all, so comparing the flag
    # is right in both modes.
    return (
        stats.join(ties, "file_id")
        .where((F.col("n_cells") == F.col("n")) & (F.col("has_keyword") | ~F.col("kw")))
        .select("file_id", "sheet_idx", "sheet_name", "max_row", "max_col")
    )


def apply_tie_choice(main: DataFrame, tied: DataFrame, choice: DataFrame) -> DataFrame:
    """Replace tied sheets by ``choice(file_id, sheet_name)``, compared without case.

    A name that matches none of the tied sheets leaves the first one in place.
    """
    named = choice.select("file_id", F.lower("sheet_name").alias("wanted"))
    shape = F.struct("sheet_idx", "sheet_name", "max_row", "max_col")
    picked = (
        tied.join(named, "file_id")
        .where(F.lower("sheet_name") == F.col("wanted"))
        .groupBy("file_id")
        .agg(F.min(shape).alias("p"))
    )
    columns = ["sheet_idx", "sheet_name", "max_row", "max_col"]
    return main.join(picked, "file_id", "left").select(
        "file_id",
        *[F.coalesce(F.col(f"p.{c}"), F.col(c)).alias(c) for c in columns],
        "n_cells",
        "has_keyword",
        "tie",
    )


def keep_main(cells: DataFrame, main: DataFrame) -> DataFrame:
    """The cells of the main sheets."""
    place = ["row_idx", "col_idx"]
    return lookup_join(cells, main.select(*SHEET), SHEET, place, "left_semi", max_rows=MAIN_SHEETS)


def near_main(cells: DataFrame, main: DataFrame) -> DataFrame:
    """``keep_main`` as far as it needs no shuffle, for steps that meet ``main`` or its ranges later: with more main
    sheets than go to every task the cells of others stay, as moving all cells for it costs more than taking them along."""
    names = main.select(*SHEET)
    return cells.join(F.broadcast(names), SHEET, "left_semi") if fits_broadcast(names, MAIN_SHEETS) else cells


def header_row_by_fill(cells: DataFrame, min_cells: int = 3) -> DataFrame:
    """First row with at least ``min_cells`` filled cells, and its first and last filled column."""
    per_row = (
        _filled(cells)
        .groupBy(*SHEET, "row_idx")
        .agg(
            F.count("*").alias("n"),
            F.min("col_idx").alias("first_col"),
            F.max("col_idx").alias("last_col"),
        )
        .where(F.col("n") >= min_cells)
    )
    first = F.min(F.struct("row_idx", "first_col", "last_col")).alias("h")
    return (
        per_row.groupBy(*SHEET)
        .agg(first)
        .select(*SHEET, F.col("h.row_idx").alias("header_row"), "h.first_col", "h.last_col")
    )


def without_header(sheets: DataFrame, ranges: DataFrame) -> DataFrame:
    """Sheets in which no header row was found."""
    return sheets.join(ranges.select(*SHEET), SHEET, "left_anti").select(
        *SHEET, F.lit("no header row").alias("reason")
    )


def _first_row(hits: DataFrame, sheets: DataFrame) -> DataFrame:
    first = hits.groupBy(*SHEET).agg(F.min("row_idx").alias("found"))
    return sheets.join(first, SHEET, "left").select(
        *SHEET,
        F.coalesce("found", F.lit(1)).cast("long").alias("header_row"),
        F.col("found").isNotNull().alias("found"),
    )


def header_row_by_keyword(
    cells: DataFrame,
    sheets: DataFrame,
    keywords: list[str] | None = None,
    min_words: int = 2,
) -> DataFrame:
    """First row in which at least ``min_words`` different keywords occur inside some cell.

    Counts keywords, not cells. Sheets without such a row get their first row.
    """
    words = HEADER_KEYWORDS if keywords is None else keywords
    norm = cells.select(*SHEET, "row_idx", normalize(F.col("value")).alias("norm"))
    candidates = norm.where(_any_word(F.col("norm"), words))
    seen = [F.max(F.contains("norm", F.lit(w)).cast("int")).alias(f"w{i}") for i, w in enumerate(words)]
    total = sum((F.col(f"w{i}") for i in range(1, len(words))), F.col("w0"))
    per_row = candidates.groupBy(*SHEET, "row_idx").agg(*seen).where(total >= min_words)
    return _first_row(per_row, sheets)


def header_row_by_name(
    cells: DataFrame, sheets: DataFrame, names: list[str] | None = None, min_cells: int = 2
) -> DataFrame:
    """First row in which at least ``min_cells`` cells are known header names.

    Names compare trimmed and without case, accents kept. Sheets without such a row get row 1.
    """
    known = [n.strip().lower() for n in (KNOWN_HEADERS if names is None else names)]
    per_row = (
        cells.where(light_normalize(F.col("value")).isin(known))
        .groupBy(*SHEET, "row_idx")
        .agg(F.count("*").alias("n"))
        .where(F.col("n") >= min_cells)
    )
    return _first_row(per_row, sheets)


def last_data_row(
    cells: DataFrame, headers: DataFrame, blank_run: int = 2, width: int = WIDTH
) -> DataFrame:
    """Last non-blank row before the first run of ``blank_run`` blank rows below the header."""
    rows = cells.where(~is_blank(F.col("value"))).select(*SHEET, "row_idx").distinct()
    linked = previous_ordinal(rows, SHEET, "row_idx", "prev", width).withColumn(
        "prev", F.coalesce("prev", F.lit(0))
    )
    gap = F.col("row_idx") - F.col("prev")
    final = rows.groupBy(*SHEET).agg(F.max("row_idx").alias("final"))
    # Only the rows after a long gap meet the headers, not every row of a hot sheet.
    before = (
        linked.where(gap > blank_run)
        .join(headers.select(*SHEET, "header_row"), SHEET)
        .where(F.col("row_idx") > F.col("header_row"))
        .withColumn("prev", F.greatest("prev", "header_row"))
        .where(gap > blank_run)
        .groupBy(*SHEET)
        .agg(F.min_by("prev", "row_idx").alias("before_gap"))
    )
    return (
        headers.join(before, SHEET, "left")
        .join(final, SHEET, "left")
        .select(
            *headers.columns,
            F.coalesce("before_gap", F.greatest("final", "header_row")).alias("last_row"),
        )
    )


def header_cells(cells: DataFrame, ranges: DataFrame) -> DataFrame:
    """Trimmed header texts of the range with their column numbers; blank cells are left out.

    The header rows alone are sent to every task as long as they fit, so only their cells are shuffled.
    """
    at = ranges.select(*SHEET, F.col("header_row").alias("row_idx"), "first_col", "last_col")
    inside = F.col("col_idx").between(F.col("first_col"), F.col("last_col"))
    row = [*SHEET, "row_idx"]
    filled = lookup_join(_filled(cells), at.select(*row), row, ["col_idx"], "left_semi", max_rows=MAIN_SHEETS)
    return (
        filled.join(at, row)
        .where(inside)
        .select(*SHEET, "col_idx", strip(F.col("value")).alias("raw_header"))
    )


def header_list(headers: DataFrame) -> DataFrame:
    """One ordered list of header texts per sheet (bounded by the columns of one row)."""
    ordered = F.array_sort(F.collect_list(F.struct("col_idx", "raw_header")))
    return headers.groupBy(*SHEET).agg(ordered["raw_header"].alias("headers"))


def dense_grid(
    cells: DataFrame,
    ranges: DataFrame,
    na_tokens: Sequence[str] | None = None,
    step: int = 4096,
) -> DataFrame:
    """Every (row, column) of the range below the header, with its value or null.

    The rows of a range are generated in two steps, blocks and then rows of a block, with a
    shuffle between, so that one very long sheet does not expand in one task.
    """
    blocks = (
        ranges.where(F.col("last_row") > F.col("header_row"))
        .withColumn("start", F.explode(F.expr(f"sequence(header_row + 1, last_row, {step}L)")))
        .repartition(*SHEET, "start")
    )
    rows = blocks.withColumn(
        "row_idx",
        F.explode(F.expr(f"sequence(start, least(start + {step - 1}L, last_row))")),
    )
    slots = rows.select(
        *SHEET, "row_idx", F.explode(F.expr("sequence(first_col, last_col)")).alias("col_idx")
    )
    values = _filled(cells, na_tokens).select(*SHEET, "row_idx", "col_idx", "value")
    return slots.join(values, [*SHEET, "row_idx", "col_idx"], "left")


def dense_blocks(
    cells: DataFrame,
    ranges: DataFrame,
    na_tokens: Sequence[str] | None = None,
    width: int = WIDTH,
    heads: bool = False,
) -> DataFrame:
    """The dense grid as ``dense_grid`` gives it, with the number of each row's block of ``width`` rows, and
    shuffled once, by sheet and block.

    Cells meet one mark per row of the range, so the empty places are made behind the shuffle. Windows over a row
    or over a column's part of a block need no other one. With ``heads`` the header row of each range comes along,
    marked in ``HEAD``; ``na_tokens`` are texts there.
    """
    block = lambda row: F.floor(row / F.lit(float(width)))
    ends = F.struct("first_col", "last_col")
    start = F.col("header_row") if heads else F.col("header_row") + 1
    blocks = ranges.where(F.col("last_row") > F.col("header_row")).select(
        *SHEET,
        ends.alias("__ends"),
        "header_row",
        start.alias("from_row"),
        "last_row",
        F.explode(F.sequence(block(start), block(F.col("last_row")))).alias(BLOCK),
    )
    first = F.greatest("from_row", F.col(BLOCK) * width)
    last = F.least("last_row", (F.col(BLOCK) + 1) * width - 1)
    marks = blocks.repartition(*SHEET, BLOCK).select(
        *SHEET, BLOCK, "header_row", F.explode(F.sequence(first, last)).alias("row_idx"), "__ends"
    )
    head = [(F.col("row_idx") == F.col("header_row")).alias(HEAD)] if heads else []
    marks = marks.select(*SHEET, BLOCK, "row_idx", "__ends", *head)
    values = _filled(cells, None if heads else na_tokens).select(
        *SHEET, block(F.col("row_idx")).alias(BLOCK), "row_idx", "col_idx", "value"
    )
    both = values.unionByName(marks, allowMissingColumns=True).repartition(*SHEET, BLOCK)
    columns = F.when(F.col("__ends").isNull(), F.array("col_idx")).otherwise(
        F.sequence(F.col("__ends.first_col"), F.col("__ends.last_col"))
    )
    placed = both.select(
        *SHEET,
        BLOCK,
        "row_idx",
        F.explode(columns).alias("col_idx"),
        "value",
        F.col("__ends").isNotNull().alias("__slot"),
        *([HEAD] if heads else []),
    )
    # Columns first: filling down goes along them and needs no sort of its own.
    here = W.partitionBy(*SHEET, BLOCK, "col_idx", "row_idx")
    seen = placed.withColumns({"__in": F.max("__slot").over(here), "__n": F.count("value").over(here)})
    is_text = F.lit(True)
    if heads:
        token = F.coalesce(F.col("value").isin(list(na_tokens or [])), F.lit(False))
        seen = seen.withColumns({HEAD: F.max(HEAD).over(here), "__na": F.count_if(token).over(here)})
        seen = seen.withColumn("__n", F.col("__n") - F.when(F.col(HEAD), 0).otherwise(F.col("__na"))).drop("__na")
        is_text = F.col(HEAD) | ~token
    kept = F.when(F.col("__slot"), F.col("__n") == 0).otherwise(is_text)
    return seen.where(F.col("__in") & kept).drop("__in", "__n", "__slot")


def drop_null_columns(grid: DataFrame) -> DataFrame:
    """Drop the columns of a grid that hold no value at all."""
    written = cut_lineage(grid, "grid")
    counts = written.groupBy(*SHEET, "col_idx").agg(F.count("value").alias("n"))
    kept = cut_lineage(counts.where("n > 0").drop("n"), "columns")
    return lookup_join(written, kept, [*SHEET, "col_idx"], ["row_idx"], "left_semi")
