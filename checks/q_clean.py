"""Filling, blank and summary rows, empty columns."""

from pyspark.sql import functions as F

from checks.q_structure import ranges
from checks.registry import query
from checks.views import GAPS_SQL, GRID_SQL, RANGES_SQL, cells, cells_sql, gaps, strip_sql, table
from gridloom.operators import clean as C
from gridloom.operators import structure as S

# Rows and cells are blanked by rule, and some rows become a lone summary cell.
_GRID = f"""WITH {cells_sql()}, {RANGES_SQL},
    thinned AS (
      SELECT * REPLACE (CASE WHEN (row_idx + sheet_idx) % 9 = 4 THEN ' Total' || value
                             WHEN col_idx % 5 = 3 THEN '  ' ELSE value END AS value)
      FROM cells
      WHERE CASE (row_idx + sheet_idx) % 9 WHEN 4 THEN col_idx = 1 WHEN 5 THEN false
            ELSE (row_idx * col_idx) % 3 <> 1 AND (col_idx <> 4 OR row_idx < 4) END),
    {GRID_SQL.replace('LEFT JOIN cells c', 'LEFT JOIN thinned c')}"""


def grid(spark, sf):
    place, row, col = F.col("row_idx") + F.col("sheet_idx"), F.col("row_idx"), F.col("col_idx")
    shown = (
        F.when(place % 9 == 4, col == 1)
        .when(place % 9 == 5, F.lit(False))
        .otherwise((row * col % 3 != 1) & ((col != 4) | (row < 4)))
    )
    value = (
        F.when(place % 9 == 4, F.concat(F.lit(" Total"), "value"))
        .when(col % 5 == 3, F.lit("  "))
        .otherwise(F.col("value"))
    )
    thinned = cells(spark, sf).where(shown).withColumn("value", value)
    return S.dense_grid(thinned, ranges(spark, sf))


_DOWN = """
    down AS (
      SELECT * REPLACE (last_value(value IGNORE NULLS) OVER (
        PARTITION BY file_id, sheet_idx, col_idx ORDER BY row_idx
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS value) FROM grid)"""
_RIGHT = """
    {out} AS (
      SELECT * REPLACE (last_value(value IGNORE NULLS) OVER (
        PARTITION BY file_id, sheet_idx, row_idx ORDER BY col_idx
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS value) FROM {src})"""
_COLUMNS = "file_id, sheet_idx, row_idx, col_idx, value"


def _blank(src, out):
    return f"{out} AS (SELECT * REPLACE (CASE WHEN {strip_sql('value')} <> '' THEN value END AS value) FROM {src})"


def _rows(src, out):
    return f"""{out} AS (SELECT * FROM {src} QUALIFY
        count(value) OVER (PARTITION BY file_id, sheet_idx, row_idx) > 0)"""


def _cols(src, out):
    return f"""
    {out}_first AS (SELECT file_id, sheet_idx, min(row_idx) AS r0, max(row_idx) AS r1 FROM {src} GROUP BY ALL),
    {out} AS (SELECT x.* FROM {src} x JOIN {out}_first USING (file_id, sheet_idx) QUALIFY
        count(CASE WHEN row_idx > r0 OR r0 = r1 THEN value END)
          OVER (PARTITION BY file_id, sheet_idx, col_idx) > 0)"""


def _parasitic(src, out):
    return f"""{out} AS (SELECT * FROM {src} QUALIFY NOT (
        count(value) OVER (PARTITION BY file_id, sheet_idx, row_idx) = 1
        AND regexp_matches(lower({strip_sql('max(value) OVER (PARTITION BY file_id, sheet_idx, row_idx)')}), '^(total|phase)')))"""



@query("fill_down", f"{_GRID}, {_DOWN} SELECT {_COLUMNS} FROM down")
def fill_down(spark, sf):
    return C.fill_down(grid(spark, sf), width=16)


@query("fill_right", f"{_GRID}, {_RIGHT.format(src='grid', out='filled')} SELECT {_COLUMNS} FROM filled")
def fill_right(spark, sf):
    return C.fill_right(grid(spark, sf))


_LINES_SQL = """
    lines AS (SELECT l_orderkey * 8 + l_linenumber AS pos, max(l_quantity) AS q, min(l_shipmode_) AS m
      FROM (SELECT *, l_returnflag AS l_shipmode_ FROM lineitem) GROUP BY 1),
    sparse AS (SELECT pos, CASE WHEN CAST(q AS BIGINT) % 7 = 3 THEN q END AS q,
                      CASE WHEN pos % 13 = 5 THEN m END AS m FROM lines)"""


def _sparse_lines(spark, sf):
    position = F.col("l_orderkey") * 8 + F.col("l_linenumber")
    lines = table(spark, sf, "lineitem").groupBy(position.alias("pos")).agg(
        F.max("l_quantity").alias("q"), F.min("l_returnflag").alias("m")
    )
    return lines.select(
        F.lit(1).alias("one"),
        "pos",
        F.when(F.col("q").cast("long") % 7 == 3, F.col("q")).alias("q"),
        F.when(F.col("pos") % 13 == 5, F.col("m")).alias("m"),
    )


@query(
    "fill_down_large",
    f"""WITH {_LINES_SQL}
        SELECT pos, last_value(q IGNORE NULLS) OVER w AS q, last_value(m IGNORE NULLS) OVER w AS m
        FROM sparse WINDOW w AS (ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
)
def fill_down_large(spark, sf):
    """One table as one key: no task sees more than one bucket."""
    filled = C.fill_down_wide(_sparse_lines(spark, sf), ["one"], "pos", ["q", "m"], width=4096)
    return filled.select("pos", "q", "m")


@query(
    "fill_right_wide",
    f"""WITH {GAPS_SQL}
        SELECT conv_id, turn, a, COALESCE(b, a) AS b, COALESCE(c, b, a) AS c FROM gaps""",
)
def fill_right_wide(spark, sf):
    return C.fill_right_wide(gaps(spark, sf), ["a", "b", "c"])


@query(
    "blank_to_null",
    f"""WITH {GAPS_SQL}
        SELECT conv_id, turn, CASE WHEN trim(a) <> '' THEN a END AS a,
               CASE WHEN trim(b) <> '' THEN b END AS b, CASE WHEN trim(c) <> '' THEN c END AS c
        FROM gaps""",
)
def blank_to_null(spark, sf):
    return C.blank_to_null(gaps(spark, sf), ["a", "b", "c"])


@query(
    "drop_empty_rows_wide",
    f"""WITH {GAPS_SQL}
        SELECT conv_id, turn, CASE WHEN trim(a) <> '' THEN a END AS a,
               CASE WHEN trim(b) <> '' THEN b END AS b, CASE WHEN trim(c) <> '' THEN c END AS c
        FROM gaps WHERE COALESCE(trim(a), '') || COALESCE(trim(b), '') || COALESCE(trim(c), '') <> ''""",
)
def drop_empty_rows_wide(spark, sf):
    return C.drop_empty_rows_wide(gaps(spark, sf), ["a", "b", "c"])


@query(
    "drop_parasitic_rows_wide",
    f"""WITH {GAPS_SQL}
        SELECT conv_id, turn, a, b, c FROM gaps
        WHERE NOT (COALESCE(trim(a), '') = '' AND COALESCE(trim(b), '') = ''
                   AND COALESCE(regexp_matches(lower(trim(c)), '^(total|phase)'), false))""",
)
def drop_parasitic_rows_wide(spark, sf):
    return C.drop_parasitic_rows_wide(gaps(spark, sf), ["a", "b", "c"])


@query("drop_empty_rows", f"{_GRID}, {_blank('grid', 'b')}, {_rows('b', 'kept')} SELECT {_COLUMNS} FROM kept")
def drop_empty_rows(spark, sf):
    return C.drop_empty_rows(grid(spark, sf))


@query("drop_empty_cols", f"{_GRID}, {_blank('grid', 'b')}, {_cols('b', 'kept')} SELECT {_COLUMNS} FROM kept")
def drop_empty_cols(spark, sf):
    return C.drop_empty_cols(grid(spark, sf))


@query(
    "drop_parasitic_rows",
    f"{_GRID}, {_blank('grid', 'b')}, {_parasitic('b', 'kept')} SELECT {_COLUMNS} FROM kept",
)
def drop_parasitic_rows(spark, sf):
    return C.drop_parasitic_rows(C.blank_to_null(grid(spark, sf)))


_CLEAN = f"""{_GRID}, {_DOWN}, {_RIGHT.format(src='down', out='rt')}, {_blank('rt', 'b')},
    {_rows('b', 'nonempty')}, {_cols('nonempty', 'fullcols')}"""
_PARASITIC_DEFAULT = _parasitic("fullcols", "kept")
_FIRST = f"""{_GRID}, {_blank('grid', 'b')}, {_rows('b', 'nonempty')},
    {_parasitic('nonempty', 'shown')},
    {_DOWN.replace('FROM grid', 'FROM shown')}, {_RIGHT.format(src='down', out='rt')},
    {_cols('rt', 'kept')}"""


@query("clean_table", f"{_CLEAN}, {_PARASITIC_DEFAULT} SELECT {_COLUMNS} FROM kept")
def clean_table(spark, sf):
    return C.clean_table(grid(spark, sf))


@query("clean_table_first", f"{_FIRST} SELECT {_COLUMNS} FROM kept")
def clean_table_first(spark, sf):
    return C.clean_table(grid(spark, sf), order="clean_first")


@query(
    "carry_phase",
    f"""WITH {GAPS_SQL},
        marked AS (SELECT *, lower(trim(c)) LIKE 'phase%' AS is_phase FROM gaps),
        carried AS (
          SELECT *, last_value(CASE WHEN is_phase THEN trim(c) END IGNORE NULLS) OVER (
            PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
            AS phase_exercice FROM marked)
        SELECT conv_id, turn, a, b, c, phase_exercice FROM carried
        WHERE NOT COALESCE(is_phase, false)""",
)
def carry_phase(spark, sf):
    return C.carry_phase(gaps(spark, sf), ["conv_id"], "turn", "c", width=4)


@query(
    "trimmed_tables",
    f"""WITH {cells_sql()}, {RANGES_SQL},
        nonblank AS (
          SELECT DISTINCT c.file_id, c.sheet_idx, c.row_idx, r.header_row
          FROM cells c JOIN ranges r USING (file_id, sheet_idx)
          WHERE {strip_sql('c.value')} <> '' AND c.row_idx > r.header_row),
        linked AS (
          SELECT *, COALESCE(lag(row_idx) OVER (PARTITION BY file_id, sheet_idx ORDER BY row_idx),
                             header_row) AS prev FROM nonblank),
        stops AS (SELECT file_id, sheet_idx, min(row_idx) FILTER (row_idx - prev > 2) AS stop
                  FROM linked GROUP BY ALL)
        SELECT r.file_id, r.sheet_idx, r.header_row, r.first_col, r.last_col,
               COALESCE(max(n.row_idx), r.header_row) AS last_row
        FROM ranges r LEFT JOIN stops s USING (file_id, sheet_idx)
        LEFT JOIN nonblank n ON n.file_id = r.file_id AND n.sheet_idx = r.sheet_idx
             AND (s.stop IS NULL OR n.row_idx < s.stop)
        GROUP BY r.file_id, r.sheet_idx, r.header_row, r.first_col, r.last_col""",
)
def trimmed_tables(spark, sf):
    """Header by fill, then the end of the table by blank rows."""
    source = cells(spark, sf)
    return S.last_data_row(source, S.header_row_by_fill(source))
