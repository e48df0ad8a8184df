"""Sheets, header rows, ranges and grids."""

from pyspark.sql import functions as F

from checks.registry import query
from checks.views import GRID_SQL, HEADERS_SQL, RANGES_SQL, cells, cells_sql, norm_sql, sheets, strip_sql
from gridloom.model import NULL_TOKENS
from gridloom.operators import structure as S
from gridloom.plans.intake import Options
from gridloom.session import cut_lineage

_WORDS = ["chronogramme", "exercice", "licensed"]


def ranges(spark, sf, folder=False):
    found = S.header_row_by_fill(cells(spark, sf, folder))
    ends = sheets(spark, sf, folder).select(*S.SHEET, F.col("max_row").alias("last_row"))
    return found.join(ends, S.SHEET)


def grid(spark, sf):
    return S.dense_grid(cells(spark, sf), ranges(spark, sf))


def header_texts(spark, sf):
    # Headers and the dictionary over them both read this.
    return cut_lineage(S.header_cells(cells(spark, sf), ranges(spark, sf)))


def any_word(x, words):
    return "(" + " OR ".join(f"contains({x}, '{w}')" for w in words) + ")"


_STATS_SQL = f"""
    counts AS (
      SELECT file_id, sheet_idx, count(*) AS n,
             bool_or(row_idx <= 5 AND col_idx <= 5 AND {any_word('lower(value)', _WORDS)}) AS kw
      FROM cells GROUP BY ALL),
    stats AS (
      SELECT s.*, COALESCE(n, 0) AS n_cells, COALESCE(n, 0) / (max_row * max_col) AS density,
             COALESCE(kw, false) OR {any_word('lower(sheet_name)', _WORDS)} AS has_keyword
      FROM sheets s LEFT JOIN counts USING (file_id, sheet_idx))"""


@query(
    "sheet_stats",
    f"""WITH {cells_sql()}, {_STATS_SQL}
        SELECT file_id, sheet_idx, sheet_name, max_row, max_col, n_cells,
               round(density, 6) AS density, has_keyword FROM stats""",
)
def sheet_stats(spark, sf):
    stats = S.sheet_stats(cells(spark, sf), sheets(spark, sf), _WORDS)
    return stats.withColumn("density", F.round("density", 6))


def _main_sql(order, folder=False):
    return f"""WITH {cells_sql(folder)}, {_STATS_SQL},
        ranked AS (
          SELECT *, row_number() OVER (PARTITION BY file_id ORDER BY {order}, sheet_idx) AS rn,
                 count(*) OVER (PARTITION BY file_id, {order.replace(' DESC', '')}) AS n_tied
          FROM stats)
        SELECT file_id, sheet_idx, sheet_name, n_cells, n_tied > 1 AS tie FROM ranked WHERE rn = 1"""


@query("main_sheet", _main_sql("has_keyword DESC, n_cells DESC"))
def main_sheet(spark, sf):
    stats = S.sheet_stats(cells(spark, sf), sheets(spark, sf), _WORDS)
    return S.main_sheet(stats).select("file_id", "sheet_idx", "sheet_name", "n_cells", "tie")


@query("main_sheet_by_count", _main_sql("n_cells DESC", folder=True))
def main_sheet_by_count(spark, sf):
    stats = S.sheet_stats(cells(spark, sf, True), sheets(spark, sf, True), _WORDS)
    found = S.main_sheet(stats, use_keywords=False)
    return found.select("file_id", "sheet_idx", "sheet_name", "n_cells", "tie")


@query(
    "main_sheet_tie_choice",
    f"""WITH {cells_sql(True)}, {_STATS_SQL},
        best AS (SELECT *, max(n_cells) OVER (PARTITION BY file_id) AS top FROM stats)
        SELECT file_id, max(sheet_idx) AS sheet_idx, arg_max(sheet_name, sheet_idx) AS sheet_name
        FROM best WHERE n_cells = top GROUP BY 1""",
)
def main_sheet_tie_choice(spark, sf):
    """Ties go to the last equally full sheet: a resolver that is itself a table job."""
    stats = S.sheet_stats(cells(spark, sf, True), sheets(spark, sf, True), _WORDS)
    main = S.main_sheet(stats, use_keywords=False)
    tied = S.tied_sheets(stats.withColumn("has_keyword", F.lit(False)), main)
    choice = tied.groupBy("file_id").agg(F.max_by("sheet_name", "sheet_idx").alias("sheet_name"))
    chosen = S.apply_tie_choice(main, tied, choice)
    return chosen.select("file_id", "sheet_idx", "sheet_name")


@query(
    "header_row_by_fill",
    f"""WITH {cells_sql()}, {RANGES_SQL}
        SELECT file_id, sheet_idx, header_row, first_col, last_col FROM ranges""",
)
def header_row_by_fill(spark, sf):
    return S.header_row_by_fill(cells(spark, sf))


@query(
    "sheets_without_header",
    f"""WITH {cells_sql()}, {RANGES_SQL}
        SELECT file_id, sheet_idx, 'no header row' AS reason
        FROM sheets ANTI JOIN ranges USING (file_id, sheet_idx)""",
)
def sheets_without_header(spark, sf):
    return S.without_header(sheets(spark, sf), S.header_row_by_fill(cells(spark, sf)))


_KEYS = ["and", "tion", "ein", "the", "le"]


@query(
    "header_row_by_keyword",
    f"""WITH {cells_sql()},
        hits AS (
          SELECT file_id, sheet_idx, row_idx,
                 {' + '.join(f"max(CAST(contains({norm_sql('value')}, '{k}') AS INTEGER))" for k in _KEYS)} AS n
          FROM cells GROUP BY ALL),
        firsts AS (SELECT file_id, sheet_idx, min(row_idx) AS r FROM hits WHERE n >= 2 GROUP BY ALL)
        SELECT file_id, sheet_idx, COALESCE(r, 1) AS header_row, r IS NOT NULL AS found
        FROM sheets LEFT JOIN firsts USING (file_id, sheet_idx)""",
)
def header_row_by_keyword(spark, sf):
    return S.header_row_by_keyword(cells(spark, sf), sheets(spark, sf), _KEYS)


_NAMES = ["Of.", "THE", "Le", "de.", "and", "A", "to.", "In."]


@query(
    "header_row_by_name",
    f"""WITH {cells_sql()},
        hits AS (
          SELECT file_id, sheet_idx, row_idx, count(*) AS n FROM cells
          WHERE lower({strip_sql('value')}) IN ({', '.join(f"'{n.lower()}'" for n in _NAMES)})
          GROUP BY ALL HAVING count(*) >= 2),
        firsts AS (SELECT file_id, sheet_idx, min(row_idx) AS r FROM hits GROUP BY ALL)
        SELECT file_id, sheet_idx, COALESCE(r, 1) AS header_row, r IS NOT NULL AS found
        FROM sheets LEFT JOIN firsts USING (file_id, sheet_idx)""",
)
def header_row_by_name(spark, sf):
    return S.header_row_by_name(cells(spark, sf), sheets(spark, sf), _NAMES)


@query(
    "last_data_row",
    f"""WITH {cells_sql()},
        thinned AS (SELECT * FROM cells WHERE (row_idx + sheet_idx) % 7 NOT IN (2, 3)
                      AND (row_idx + sheet_idx) % 11 <> 5),
        per_row AS (
          SELECT file_id, sheet_idx, row_idx, count(*) AS n FROM thinned GROUP BY ALL
          HAVING count(*) >= 3),
        heads AS (SELECT file_id, sheet_idx, min(row_idx) AS header_row FROM per_row GROUP BY ALL),
        rws AS (
          SELECT DISTINCT t.file_id, t.sheet_idx, t.row_idx, h.header_row
          FROM thinned t JOIN heads h USING (file_id, sheet_idx)
          WHERE trim(t.value) <> '' AND t.row_idx > h.header_row),
        linked AS (
          SELECT *, COALESCE(lag(row_idx) OVER (PARTITION BY file_id, sheet_idx ORDER BY row_idx),
                             header_row) AS prev FROM rws),
        stops AS (
          SELECT file_id, sheet_idx, min(row_idx) FILTER (row_idx - prev > 2) AS stop
          FROM linked GROUP BY ALL)
        SELECT h.file_id, h.sheet_idx, h.header_row,
               COALESCE(max(r.row_idx), h.header_row) AS last_row
        FROM heads h LEFT JOIN stops s USING (file_id, sheet_idx)
        LEFT JOIN rws r ON r.file_id = h.file_id AND r.sheet_idx = h.sheet_idx
             AND (s.stop IS NULL OR r.row_idx < s.stop)
        GROUP BY h.file_id, h.sheet_idx, h.header_row""",
)
def last_data_row(spark, sf):
    """Lines are blanked by rule, so that runs of blank rows end many tables."""
    place = F.col("row_idx") + F.col("sheet_idx")
    thinned = cells(spark, sf).where(~(place % 7).isin(2, 3) & (place % 11 != 5))
    heads = S.header_row_by_fill(thinned).select(*S.SHEET, "header_row")
    return S.last_data_row(thinned, heads, width=16)


@query(
    "dense_grid",
    f"""WITH {cells_sql()}, {RANGES_SQL}, {GRID_SQL}
        SELECT file_id, sheet_idx, row_idx, col_idx, value FROM grid""",
)
def dense_grid(spark, sf):
    return grid(spark, sf)


@query(
    "dense_grid_null_tokens",
    f"""WITH {cells_sql()}, {RANGES_SQL}, {GRID_SQL}
        SELECT file_id, sheet_idx, row_idx, col_idx,
               CASE WHEN length(value) % 5 <> 0 THEN value END AS value FROM grid""",
)
def dense_grid_null_tokens(spark, sf):
    """Every fifth cell text is one of the tokens that count as empty, as the flow reads them."""
    source = cells(spark, sf)
    tokens = F.array(*map(F.lit, NULL_TOKENS))
    token = F.element_at(tokens, (F.length("value") % len(NULL_TOKENS) + 1).cast("int"))
    odd = source.withColumn("value", F.when(F.length("value") % 5 == 0, token).otherwise(F.col("value")))
    return S.dense_grid(odd, cut_lineage(ranges(spark, sf)), Options().na_tokens)


@query(
    "header_list",
    f"""WITH {cells_sql()}, {RANGES_SQL}, {HEADERS_SQL}
        SELECT file_id, sheet_idx, string_agg(raw_header, '|' ORDER BY col_idx) AS headers
        FROM headers GROUP BY ALL""",
)
def header_list(spark, sf):
    lists = S.header_list(header_texts(spark, sf))
    return lists.select(*S.SHEET, F.array_join("headers", "|").alias("headers"))


@query(
    "table_by_keyword",
    f"""WITH {cells_sql()},
        hits AS (
          SELECT file_id, sheet_idx, row_idx,
                 {' + '.join(f"max(CAST(contains({norm_sql('value')}, '{k}') AS INTEGER))" for k in _KEYS)} AS n
          FROM cells GROUP BY ALL),
        firsts AS (SELECT file_id, sheet_idx, min(row_idx) AS r FROM hits WHERE n >= 2 GROUP BY ALL),
        ranges AS (
          SELECT file_id, sheet_idx, COALESCE(r, 1) AS header_row, 1 AS first_col,
                 max_col AS last_col, max_row AS last_row
          FROM sheets LEFT JOIN firsts USING (file_id, sheet_idx)),
        {GRID_SQL}
        SELECT file_id, sheet_idx, col_idx, count(*) AS n_rows, count(value) AS n_values
        FROM grid GROUP BY ALL HAVING count(value) > 0""",
)
def table_by_keyword(spark, sf):
    """The keyword header row, every column of the sheet, null columns dropped."""
    source, shape = cells(spark, sf), sheets(spark, sf)
    heads = S.header_row_by_keyword(source, shape, _KEYS).drop("found")
    full = heads.join(shape, S.SHEET).select(
        *S.SHEET,
        "header_row",
        F.lit(1).cast("long").alias("first_col"),
        F.col("max_col").alias("last_col"),
        F.col("max_row").alias("last_row"),
    )
    kept = S.drop_null_columns(S.dense_grid(source, full))
    return kept.groupBy(*S.SHEET, "col_idx").agg(
        F.count("*").alias("n_rows"), F.count("value").alias("n_values")
    )
