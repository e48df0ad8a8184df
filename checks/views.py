"""Inputs for the operators, derived from the given tables, once in Spark and once in SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.functions.text import WHITESPACE
from gridloom.model import FIELDS


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


# Cells: a document is a sheet, its lines are rows, its comma-separated tokens are cells.

_TITLE_WORD = "Exercice "


def _file_id(folder: bool) -> Column:
    if folder:
        return F.concat(F.lit("wb"), F.floor(F.col("doc_id") / 4).cast("string"))
    return F.col("source")


def _sheet_name() -> Column:
    plain = F.concat_ws("_", "lang", F.col("doc_id").cast("string"))
    titled = F.concat(F.lit(_TITLE_WORD), F.col("doc_id").cast("string"))
    return F.when(F.col("doc_id") % 50 == 7, titled).otherwise(plain)


def cells(spark: SparkSession, sf: str, folder: bool = False) -> DataFrame:
    """One workbook per source, or with ``folder`` one per four documents."""
    documents = table(spark, sf, "documents").select(
        _file_id(folder).alias("file_id"),
        F.col("doc_id").alias("sheet_idx"),
        _sheet_name().alias("sheet_name"),
        "text",
    )
    lines = documents.select(
        "file_id", "sheet_idx", "sheet_name", F.posexplode(F.split("text", "\n")).alias("r", "line")
    )
    tokens = lines.select(
        "file_id",
        "sheet_idx",
        "sheet_name",
        (F.col("r") + 1).cast("long").alias("row_idx"),
        F.posexplode(F.split("line", ",")).alias("c", "value"),
    )
    return tokens.where(F.col("value") != "").select(
        "file_id",
        "sheet_idx",
        "sheet_name",
        "row_idx",
        (F.col("c") + 1).cast("long").alias("col_idx"),
        "value",
        F.lit("s").alias("value_type"),
    )


def sheets(spark: SparkSession, sf: str, folder: bool = False) -> DataFrame:
    lines = F.split("text", "\n")
    widths = F.transform(lines, lambda line: F.size(F.split(line, ",")))
    return table(spark, sf, "documents").select(
        _file_id(folder).alias("file_id"),
        F.col("doc_id").alias("sheet_idx"),
        _sheet_name().alias("sheet_name"),
        F.size(lines).cast("long").alias("max_row"),
        F.array_max(widths).cast("long").alias("max_col"),
    )


def cells_sql(folder: bool = False) -> str:
    """CTEs ``lines``, ``cells`` and ``sheets`` (without WITH)."""
    file_id = "'wb' || CAST(doc_id // 4 AS VARCHAR)" if folder else "source"
    return f"""
    lines AS (
      SELECT {file_id} AS file_id, doc_id AS sheet_idx,
             CASE WHEN doc_id % 50 = 7 THEN '{_TITLE_WORD}' || doc_id
                  ELSE lang || '_' || doc_id END AS sheet_name,
             unnest(string_split(text, chr(10))) AS line,
             generate_subscripts(string_split(text, chr(10)), 1) AS row_idx
      FROM documents),
    tokens AS (
      SELECT file_id, sheet_idx, sheet_name, row_idx, unnest(string_split(line, ',')) AS value,
             generate_subscripts(string_split(line, ','), 1) AS col_idx
      FROM lines),
    cells AS (SELECT * FROM tokens WHERE value <> ''),
    sheets AS (
      SELECT file_id, sheet_idx, sheet_name, max(row_idx) AS max_row, max(col_idx) AS max_col
      FROM tokens GROUP BY ALL)"""


WS_SQL = " || ".join(f"chr({ord(c)})" for c in WHITESPACE)


def strip_sql(x: str) -> str:
    return f"trim({x}, {WS_SQL})"


def norm_sql(x: str) -> str:
    return f"lower(strip_accents({strip_sql(x)}))"


# Ranges by the fill rule, up to the end of the sheet; uses the CTEs of ``cells_sql``.
RANGES_SQL = """
    filled_rows AS (
      SELECT file_id, sheet_idx, row_idx, count(*) AS n, min(col_idx) AS first_col,
             max(col_idx) AS last_col
      FROM cells GROUP BY ALL HAVING count(*) >= 3),
    ranges AS (
      SELECT f.file_id, f.sheet_idx, f.row_idx AS header_row, f.first_col, f.last_col,
             s.max_row AS last_row
      FROM filled_rows f JOIN sheets s USING (file_id, sheet_idx)
      QUALIFY row_number() OVER (PARTITION BY f.file_id, f.sheet_idx ORDER BY f.row_idx) = 1)"""

GRID_SQL = """
    rws AS (SELECT r.*, unnest(generate_series(header_row + 1, last_row)) AS row_idx FROM ranges r),
    slots AS (SELECT file_id, sheet_idx, row_idx,
                     unnest(generate_series(first_col, last_col)) AS col_idx FROM rws),
    grid AS (SELECT s.file_id, s.sheet_idx, s.row_idx, s.col_idx, c.value
             FROM slots s LEFT JOIN cells c USING (file_id, sheet_idx, row_idx, col_idx))"""

HEADERS_SQL = f"""
    headers AS (
      SELECT c.file_id, c.sheet_idx, c.col_idx, {strip_sql('c.value')} AS raw_header
      FROM cells c JOIN ranges r
        ON c.file_id = r.file_id AND c.sheet_idx = r.sheet_idx AND c.row_idx = r.header_row
       AND c.col_idx BETWEEN r.first_col AND r.last_col)"""


# A header dictionary over the header texts themselves: two thirds of the texts by rule, half of
# these only in a spelling that the exact lookup misses.

def _field_of() -> Column:
    return F.element_at(F.array(*map(F.lit, FIELDS)), F.length("raw_header") % len(FIELDS) + 1)


_FIELD_OF_SQL = (
    "list_extract([" + ", ".join(f"'{f}'" for f in FIELDS) + f"], length(raw_header) % {len(FIELDS)} + 1)"
)


def header_dictionary(headers: DataFrame, exact_share: int = 3) -> DataFrame:
    kind = F.length("raw_header") % exact_share
    spelled = F.when(kind == 1, F.concat(F.lit(" "), "raw_header")).otherwise(F.col("raw_header"))
    return (
        headers.select("raw_header")
        .distinct()
        .where((kind != 2) & (F.col("raw_header") != ""))
        .select(
            spelled.alias("raw"),
            _field_of().alias("standard"),
            F.length("raw_header").cast("long").alias("line_no"),
        )
    )


def header_dictionary_sql(exact_share: int = 3) -> str:
    kind = f"length(raw_header) % {exact_share}"
    return f"""
    dict AS (
      SELECT DISTINCT CASE WHEN {kind} = 1 THEN ' ' || raw_header ELSE raw_header END AS raw,
             {_FIELD_OF_SQL} AS standard
      FROM headers WHERE {kind} <> 2 AND raw_header <> ''),
    dict_norm AS (
      SELECT {norm_sql('raw')} AS norm, arg_max(standard, length(raw)) AS standard
      FROM dict GROUP BY 1)"""


# Injects: an order is an inject of its customer's exercise.

VALUE_ENTRIES = [
    ("type_inject", "2-HIGH", "Secondaire", 1),
    ("type_inject", "1-URGENT", "Critique", 2),
    ("type_inject", "2-HIGH", "Important", 3),
    ("type_inject", "5-LOW", "Secondaire", 4),
    ("type_inject", "3-MEDIUM", "", 5),
    ("modalite", "F", "Email", 6),
    ("modalite", "O", "SMS", 7),
]
VALUE_ALLOWED = {"type_inject": ["Critique", "Important", "Secondaire"], "modalite": ["Email", "SMS", "P"]}
TYPE_SQL = """CASE o_orderpriority WHEN '1-URGENT' THEN 'Critique' WHEN '2-HIGH' THEN 'Important'
              WHEN '5-LOW' THEN 'Secondaire' ELSE o_orderpriority END"""
MODE_SQL = "CASE o_orderstatus WHEN 'F' THEN 'Email' WHEN 'O' THEN 'SMS' ELSE o_orderstatus END"


def value_dictionary(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        VALUE_ENTRIES, "field string, raw string, standard string, line_no long"
    )


def injects(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select(
        F.col("o_custkey").cast("string").alias("file_id"),
        F.col("o_custkey").alias("id_chronogramme"),
        F.col("o_orderkey").alias("row_idx"),
        F.col("o_orderkey").cast("string").alias("id_inject"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("horodatage"),
        F.col("o_orderpriority").alias("type_inject"),
        F.col("o_orderstatus").alias("modalite"),
    )


INJ_SQL = """
    inj AS (
      SELECT CAST(o_custkey AS VARCHAR) AS file_id, o_custkey AS id_chronogramme,
             o_orderkey AS row_idx, CAST(o_orderkey AS VARCHAR) AS id_inject,
             strftime(o_orderdate, '%Y-%m-%d') AS horodatage,
             o_orderpriority AS type_inject, o_orderstatus AS modalite
      FROM orders)"""


# Submissions: a customer hands in a file.


def submissions(spark: SparkSession, sf: str) -> DataFrame:
    customer = table(spark, sf, "customer")
    nation = table(spark, sf, "nation").select("n_nationkey", "n_name", "n_regionkey")
    region = table(spark, sf, "region").select("r_regionkey", "r_name")
    # 25 nations and 5 regions, whatever the scale.
    joined = customer.join(
        F.broadcast(nation), customer.c_nationkey == nation.n_nationkey
    ).join(F.broadcast(region), nation.n_regionkey == region.r_regionkey)
    key = F.col("c_custkey")
    day = F.date_add(F.lit("2024-01-01").cast("date"), (key % 366).cast("int"))
    text = (
        F.when(key % 5 == 0, F.date_format(day, "yyyy-MM-dd"))
        .when(key % 5 == 1, F.date_format(day, "dd/MM/yyyy"))
        .when(key % 5 == 2, F.date_format(day, "yyyy/MM/dd"))
        .when(key % 5 == 3, F.concat(F.lit(" "), F.date_format(day, "yyyy-M-d")))
        .otherwise(F.lit("Été 2024"))
    )
    return joined.select(
        key.cast("string").alias("file_id"),
        key.alias("ordinal"),
        F.concat(F.lit("/inbox/"), "c_name", F.when(key % 11 == 3, ".XLS").otherwise(".xlsx")).alias(
            "file_path"
        ),
        F.when(key % 7 != 2, F.concat(F.lit("  Démo n°"), (key % 40).cast("string"))).alias(
            "nom_chronogramme"
        ),
        F.when(key % 13 != 4, text).alias("date_exercice"),
        F.when(key % 17 != 5, F.col("r_name")).alias("lieu_exercice"),
        F.when(key % 19 != 6, F.concat(F.lit("Hôpital Général "), "n_name")).alias(
            "etablissement_nom"
        ),
        F.when(key % 23 != 0, F.col("c_mktsegment")).otherwise("").alias("etablissement_type"),
        F.col("c_name").alias("submitter"),
        F.lit(None).cast("string").alias("nom_fichier_excel"),
        F.when(key % 3 == 0, (key % 9).cast("string")).when(key % 3 == 1, "x").alias("nb_injects"),
    )


META_SQL = """
    meta AS (
      SELECT CAST(c_custkey AS VARCHAR) AS file_id, c_custkey AS ordinal,
             '/inbox/' || c_name || CASE WHEN c_custkey % 11 = 3 THEN '.XLS' ELSE '.xlsx' END
               AS file_path,
             CASE WHEN c_custkey % 7 <> 2 THEN '  Démo n°' || (c_custkey % 40) END
               AS nom_chronogramme,
             CASE WHEN c_custkey % 13 <> 4 THEN
               CASE c_custkey % 5 WHEN 0 THEN strftime(d, '%Y-%m-%d')
                                  WHEN 1 THEN strftime(d, '%d/%m/%Y')
                                  WHEN 2 THEN strftime(d, '%Y/%m/%d')
                                  WHEN 3 THEN ' ' || strftime(d, '%Y-%-m-%-d')
                                  ELSE 'Été 2024' END END AS date_exercice,
             CASE WHEN c_custkey % 17 <> 5 THEN r_name END AS lieu_exercice,
             CASE WHEN c_custkey % 19 <> 6 THEN 'Hôpital Général ' || n_name END
               AS etablissement_nom,
             CASE WHEN c_custkey % 23 <> 0 THEN c_mktsegment ELSE '' END AS etablissement_type,
             c_name AS submitter,
             CASE WHEN c_custkey % 3 = 0 THEN CAST(c_custkey % 9 AS VARCHAR)
                  WHEN c_custkey % 3 = 1 THEN 'x' END AS nb_injects
      FROM (SELECT *, DATE '2024-01-01' + CAST(c_custkey % 366 AS INTEGER) AS d FROM customer)
      JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""

# ``°`` has no ASCII form, so cleaning drops it.
DATE_SQL = """COALESCE(strftime(COALESCE(
      CASE WHEN regexp_full_match({t}, '[0-9]{{4}}-[0-9]{{1,2}}-[0-9]{{1,2}}') THEN try_strptime({t}, '%Y-%m-%d') END,
      CASE WHEN regexp_full_match({t}, '[0-9]{{1,2}}/[0-9]{{1,2}}/[0-9]{{4}}') THEN try_strptime({t}, '%d/%m/%Y') END,
      CASE WHEN regexp_full_match({t}, '[0-9]{{4}}/[0-9]{{1,2}}/[0-9]{{1,2}}') THEN try_strptime({t}, '%Y/%m/%d') END),
      '%Y-%m-%d'), {fallback})"""


def ascii_sql(x: str, trim: bool = True) -> str:
    text = strip_sql(x) if trim else x
    return f"regexp_replace(strip_accents({text}), '[^\\x00-\\x7F]', '', 'g')"


def date_sql(x: str, form_variant: bool = False) -> str:
    if form_variant:
        return DATE_SQL.format(t=x, fallback=safe_sql(x))
    return DATE_SQL.format(t=strip_sql(x), fallback=ascii_sql(x))


def safe_sql(x: str) -> str:
    joined = f"regexp_replace({ascii_sql(x, trim=False)}, '[^A-Za-z0-9._-]+', '_', 'g')"
    return f"COALESCE(NULLIF(lower(trim({joined}, '._-')), ''), 'chronogramme')"


# Decisions: an event is a mapping decision of its user's exercise.

_METHODS = {"click": "règle", "view": "dict", "purchase": "ok", "error": "IA", "signup": "IA"}


def decisions(spark: SparkSession, sf: str) -> DataFrame:
    method = F.lit(None).cast("string")
    for event, name in _METHODS.items():
        method = F.when(F.col("event_type") == event, name).otherwise(method)
    kind = F.when(F.col("event_id") % 3 == 0, "header").otherwise("type_inject")
    standard = F.when(F.col("event_type") != "signup", F.concat(F.lit("Std "), F.col("event_id") % 4))
    return table(spark, sf, "events").select(
        F.col("user_id").alias("id_chronogramme"),
        kind.alias("scope"),
        F.concat(F.lit("É"), "props").alias("nom_original"),
        standard.alias("champ_standard"),
        method.alias("methode"),
    )


DECISIONS_SQL = """
    mlog AS (
      SELECT user_id AS id_chronogramme,
             CASE WHEN event_id % 3 = 0 THEN 'header' ELSE 'type_inject' END AS scope,
             'É' || props AS nom_original,
             CASE WHEN event_type <> 'signup' THEN 'Std ' || (event_id % 4) END AS champ_standard,
             CASE event_type WHEN 'click' THEN 'règle' WHEN 'view' THEN 'dict'
                  WHEN 'purchase' THEN 'ok' ELSE 'IA' END AS methode
      FROM events)"""


def run_lines(spark: SparkSession, sf: str) -> DataFrame:
    """One JSON line per event: a user is a run; purchases are summaries, some lines are broken."""
    step = F.struct(
        F.when(F.col("event_id") % 4 != 1, "INSERT_METADATA").otherwise("CLEAN_DATA").alias("name"),
        F.round("value", 2).alias("duration"),
        F.when(F.col("event_id") % 5 != 2, F.col("user_id")).alias("chrono_id"),
    )
    first = F.struct(
        F.lit("SELECT_FILE").alias("name"),
        F.lit(0.5).alias("duration"),
        F.lit(None).cast("long").alias("chrono_id"),
    )
    summary = F.to_json(
        F.struct(F.lit("SUMMARY").alias("event"), F.array(first, step).alias("steps"))
    )
    other = F.to_json(F.struct(F.lit("STEP_END").alias("event"), F.lit("X").alias("step")))
    line = (
        F.when(F.col("event_type") == "purchase", summary)
        .when(F.col("event_id") % 101 == 7, "{broken")
        .otherwise(other)
    )
    return table(spark, sf, "events").select(
        F.format_string("run_%06d.log", "user_id").alias("log_name"),
        F.col("event_id").alias("ord"),
        line.alias("line"),
    )


RUNS_SQL = """
    hits AS (
      SELECT user_id, min(event_id) AS at,
             arg_min(CASE WHEN event_id % 5 <> 2 THEN user_id END, event_id) AS any_id
      FROM events WHERE event_type = 'purchase' AND event_id % 4 <> 1 GROUP BY 1),
    first_hit AS (
      SELECT e.user_id, e.event_id AS at, CASE WHEN e.event_id % 5 <> 2 THEN e.user_id END AS id
      FROM events e JOIN hits h ON e.user_id = h.user_id AND e.event_id = h.at),
    broken AS (
      SELECT user_id, min(event_id) AS broken_at FROM events
      WHERE event_type <> 'purchase' AND event_id % 101 = 7 GROUP BY 1),
    runs AS (
      SELECT printf('run_%06d.log', f.user_id) AS log_name, f.id AS chrono_id
      FROM first_hit f LEFT JOIN broken b USING (user_id)
      WHERE f.id IS NOT NULL AND (b.broken_at IS NULL OR f.at < b.broken_at))"""


# Facts with gaps, for completeness and constraints.


def facts(spark: SparkSession, sf: str) -> DataFrame:
    key = F.col("o_orderkey")
    null = F.lit(None).cast("string")
    return table(spark, sf, "orders").select(
        F.when(key % 97 != 5, F.col("o_custkey") % 200).alias("id_chronogramme"),
        F.when(key % 10 != 3, F.floor(key / 2).cast("string")).alias("id_inject"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("horodatage"),
        F.when(key % 4 != 1, F.col("o_orderpriority")).alias("description"),
        F.when(F.col("o_custkey") % 3 != 0, F.lit("")).alias("emetteur"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).alias("destinataire"),
        F.col("o_orderpriority").alias("type_inject"),
        F.col("o_orderstatus").alias("modalite"),
        F.when(key % 2 == 0, F.lit("Phase 1")).otherwise(null).alias("phase_exercice"),
        F.when(F.col("o_custkey") % 2 == 0, F.lit("x")).alias("observations"),
        F.lit("CHU").alias("etablissement_nom"),
        F.lit("Hopital").alias("etablissement_type"),
        key.alias("row_idx"),
    )


FACTS_SQL = """
    facts AS (
      SELECT CASE WHEN o_orderkey % 97 <> 5 THEN o_custkey % 200 END AS id_chronogramme,
             CASE WHEN o_orderkey % 10 <> 3 THEN CAST(o_orderkey // 2 AS VARCHAR) END AS id_inject,
             strftime(o_orderdate, '%Y-%m-%d') AS horodatage,
             CASE WHEN o_orderkey % 4 <> 1 THEN o_orderpriority END AS description,
             CASE WHEN o_custkey % 3 <> 0 THEN '' END AS emetteur,
             CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END AS destinataire,
             o_orderpriority AS type_inject, o_orderstatus AS modalite,
             CASE WHEN o_orderkey % 2 = 0 THEN 'Phase 1' END AS phase_exercice,
             CASE WHEN o_custkey % 2 = 0 THEN 'x' END AS observations,
             'CHU' AS etablissement_nom, 'Hopital' AS etablissement_type, o_orderkey AS row_idx
      FROM orders)"""


def gaps(spark: SparkSession, sf: str) -> DataFrame:
    """Conversations as a wide table with gaps, blanks and summary rows."""
    turn = F.col("turn")
    return table(spark, sf, "conversations").select(
        "conv_id",
        "turn",
        F.when(turn % 3 == 0, F.col("role")).when(turn % 3 == 1, "  ").alias("a"),
        F.when(turn % 4 < 2, F.col("text")).alias("b"),
        F.when((turn + F.col("conv_id")) % 5 == 0, F.concat(F.lit(" Phase "), turn.cast("string")))
        .when((turn + F.col("conv_id")) % 5 == 1, "TOTAL")
        .alias("c"),
    )


GAPS_SQL = """
    gaps AS (
      SELECT conv_id, turn,
             CASE turn % 3 WHEN 0 THEN role WHEN 1 THEN '  ' END AS a,
             CASE WHEN turn % 4 < 2 THEN text END AS b,
             CASE (turn + conv_id) % 5 WHEN 0 THEN ' Phase ' || turn WHEN 1 THEN 'TOTAL' END AS c
      FROM conversations)"""
