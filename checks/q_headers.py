"""Header standardization and dictionary growth."""

from pyspark.sql import functions as F

from checks.q_structure import header_texts
from checks.registry import query
from checks.views import (
    HEADERS_SQL,
    INJ_SQL,
    RANGES_SQL,
    cells,
    cells_sql,
    header_dictionary,
    header_dictionary_sql,
    injects,
    norm_sql,
    sheets,
    strip_sql,
    table,
)
from gridloom.model import FIELDS
from gridloom.operators import growth, headers as H, structure as S
from gridloom.operators.headers import KNOWN_FIELDS
from gridloom.operators.resolvers import HEADER, table_resolver
from gridloom.plans import dictionaries as plans
from gridloom.session import cut_lineage

_BASE = f"WITH {cells_sql()}, {RANGES_SQL}, {HEADERS_SQL}"
_DICT = f"{_BASE}, {header_dictionary_sql()}"
_KEYS = ["file_id", "sheet_idx", "col_idx", "raw_header"]


@query(
    "headers_exact",
    f"""{_DICT}
        SELECT h.*, CASE WHEN h.raw_header = '' THEN '' ELSE d.standard END AS standard,
               CASE WHEN h.raw_header <> '' AND d.standard IS NOT NULL THEN 'dict' END AS method
        FROM headers h LEFT JOIN dict d ON d.raw = h.raw_header""",
)
def headers_exact(spark, sf):
    found = header_texts(spark, sf)
    return H.by_exact(found, header_dictionary(found)).drop("key")


@query(
    "headers_rules",
    f"""{_DICT}
        SELECT h.*, CASE WHEN raw_header = '' THEN '' ELSE COALESCE(d.standard, '') END AS standard,
               CASE WHEN {norm_sql('raw_header')} <> '' THEN 'règle' END AS method
        FROM headers h LEFT JOIN dict_norm d ON d.norm = {norm_sql('h.raw_header')}""",
)
def headers_rules(spark, sf):
    found = header_texts(spark, sf)
    return H.by_rules(found, header_dictionary(found))


@query(
    "headers_rename",
    f"""{_DICT}
        SELECT h.*, COALESCE({norm_sql('d.standard')}, {norm_sql('h.raw_header')}) AS standard
        FROM headers h LEFT JOIN dict_norm d ON d.norm = {norm_sql('h.raw_header')}""",
)
def headers_rename(spark, sf):
    found = header_texts(spark, sf)
    return H.by_rename(found, header_dictionary(found))


# The known names occur rarely, so frequent short headers are listed next to them.
_KNOWN = {**KNOWN_FIELDS, "A": "Phase", "le.": "Contenu", "THE": "Canal", "de": "Heure", "To.": "Modalité"}


@query(
    "headers_static",
    f"""{_BASE}, known(k, v) AS (VALUES {', '.join(f"('{k.lower()}', '{v}')" for k, v in _KNOWN.items())})
        SELECT h.*, COALESCE(v, 'Inconnu') AS standard
        FROM headers h LEFT JOIN known ON k = lower({strip_sql('raw_header')})""",
)
def headers_static(spark, sf):
    return H.by_known_names(header_texts(spark, sf), _KNOWN)


_LABELS = ["Émetteur ", "DESTINATAIRE", "Modalité de ", "Type d'inject ", " Nature ", "Heure"]


@query(
    "canonical_field",
    f"""WITH named AS (
          SELECT p_partkey, list_extract([{', '.join("'" + x.replace("'", "''") + "'" for x in _LABELS)}],
                 p_partkey % 6 + 1) || p_name AS header FROM part)
        SELECT p_partkey, header,
               CASE WHEN contains(n, 'emetteur') THEN 'emetteur'
                    WHEN contains(n, 'destinataire') THEN 'destinataire'
                    WHEN contains(n, 'modalite') THEN 'modalite'
                    WHEN contains(n, 'type') OR contains(n, 'nature') THEN 'type_inject' END AS field
        FROM (SELECT *, {norm_sql('header')} AS n FROM named)""",
)
def canonical_field(spark, sf):
    labels = F.array(*map(F.lit, _LABELS))
    label = F.element_at(labels, (F.col("p_partkey") % 6 + 1).cast("int"))
    named = table(spark, sf, "part").select("p_partkey", F.concat(label, "p_name").alias("header"))
    return named.withColumn("field", H.canonical_field(F.col("header")))


def main_headers(source, shape):
    main = S.main_sheet(S.sheet_stats(source, shape))
    kept = S.keep_main(source, main)
    return S.header_cells(kept, S.header_row_by_fill(kept))


_STATS_MAIN = """
    n_of AS (SELECT file_id, sheet_idx, count(*) AS n FROM cells GROUP BY ALL),
    main AS (
      SELECT s.file_id, s.sheet_idx FROM sheets s LEFT JOIN n_of USING (file_id, sheet_idx)
      QUALIFY row_number() OVER (PARTITION BY s.file_id
        ORDER BY contains(lower(s.sheet_name), 'exercice') DESC, COALESCE(n, 0) DESC, s.sheet_idx) = 1),
    main_ranges AS (SELECT r.* FROM ranges r SEMI JOIN main USING (file_id, sheet_idx))"""
_MAIN_HEADERS = f"""WITH {cells_sql(True)}, {RANGES_SQL}, {_STATS_MAIN},
    {HEADERS_SQL.replace('JOIN ranges r', 'JOIN main_ranges r')}"""


@query(
    "headers_fallback",
    f"""{_MAIN_HEADERS}, {header_dictionary_sql(41)},
        looked AS (
          SELECT h.*, d.standard AS exact, COALESCE(n.standard, '') AS rule,
                 max(CASE WHEN d.standard IS NULL AND raw_header <> '' THEN 1 ELSE 0 END)
                   OVER (PARTITION BY file_id) AS failed
          FROM headers h LEFT JOIN dict d ON d.raw = h.raw_header
          LEFT JOIN dict_norm n ON n.norm = {norm_sql('h.raw_header')})
        SELECT file_id, sheet_idx, col_idx, raw_header,
               CASE WHEN raw_header = '' THEN '' WHEN failed = 1 THEN rule ELSE exact END AS standard,
               CASE WHEN raw_header = '' THEN NULL WHEN failed = 1 THEN 'règle' ELSE 'dict' END AS method
        FROM looked""",
)
def headers_fallback(spark, sf):
    found = cut_lineage(main_headers(cells(spark, sf, True), sheets(spark, sf, True)))
    dictionary = header_dictionary(found, 41)
    return H.standardize_headers(found, dictionary, FIELDS, policy="rules_if_unresolved").headers


@query(
    "headers_resolved",
    f"""{_MAIN_HEADERS}, {header_dictionary_sql()},
        looked AS (
          SELECT h.*, d.standard AS exact,
                 CASE WHEN length(raw_header) % 2 = 0
                      THEN list_extract([{', '.join(f"'{f}'" for f in FIELDS)}], length(raw_header) % 11 + 1) END AS answer
          FROM headers h LEFT JOIN dict d ON d.raw = h.raw_header),
        placed AS (SELECT *, row_number() OVER (PARTITION BY file_id, raw_header ORDER BY sheet_idx, col_idx) AS rn FROM looked)
        SELECT file_id, sheet_idx, col_idx, raw_header, COALESCE(exact, answer, '') AS standard,
               CASE WHEN exact IS NOT NULL THEN 'dict' WHEN answer IS NOT NULL AND rn > 1 THEN 'dict'
                    ELSE 'IA' END AS method
        FROM placed WHERE raw_header <> ''""",
)
def headers_resolved(spark, sf):
    """Misses go to a reviewed table that knows the headers of even length."""
    found = main_headers(cells(spark, sf, True), sheets(spark, sf, True))
    found = cut_lineage(found.where(F.col("raw_header") != ""))
    names = found.select("raw_header").distinct()
    field = F.element_at(F.array(*map(F.lit, FIELDS)), F.length("raw_header") % 11 + 1)
    reviewed = names.where(F.length("raw_header") % 2 == 0).select(
        F.lit(HEADER).alias("scope"), F.col("raw_header").alias("key"), field.alias("standard")
    )
    return H.standardize_headers(
        found, header_dictionary(found), FIELDS, table_resolver(reviewed)
    ).headers


@query(
    "header_log",
    f"""{_DICT}
        SELECT COALESCE(d.standard, '') AS champ_standard, 'règle' AS methode, count(*) AS n
        FROM headers h LEFT JOIN dict_norm d ON d.norm = {norm_sql('h.raw_header')}
        WHERE {norm_sql('h.raw_header')} <> '' GROUP BY ALL""",
)
def header_log(spark, sf):
    found = header_texts(spark, sf)
    log = H.header_log(H.by_rules(found, header_dictionary(found)))
    return log.groupBy("champ_standard", "methode").agg(F.count("*").alias("n"))


@query(
    "dropped_columns",
    f"""{_DICT}
        , named AS (SELECT h.*, COALESCE(d.standard, '') AS standard
                    FROM headers h LEFT JOIN dict_norm d ON d.norm = {norm_sql('h.raw_header')})
        SELECT *, CASE WHEN standard = '' THEN 'not in schema' ELSE 'repeated' END AS reason FROM named
        QUALIFY standard = '' OR row_number() OVER (
          PARTITION BY file_id, sheet_idx, standard ORDER BY col_idx) > 1""",
)
def dropped_columns(spark, sf):
    found = header_texts(spark, sf)
    return H.dropped_columns(H.by_rules(found, header_dictionary(found)).drop("method"), FIELDS)


_PIVOT = ["id_inject", "horodatage", "type_inject", "modalite", "observations"]


@query(
    "headers_pivot",
    f"""WITH {INJ_SQL}, long AS (
          SELECT file_id, row_idx, field, value FROM inj
          UNPIVOT (value FOR field IN (id_inject, horodatage, type_inject, modalite)))
        SELECT file_id, row_idx, {', '.join(f"max(CASE WHEN field = '{f}' THEN value END) AS {f}" for f in _PIVOT)}
        FROM long GROUP BY ALL""",
)
def headers_pivot(spark, sf):
    wide = injects(spark, sf)
    long = wide.unpivot(["file_id", "row_idx"], _PIVOT[:4], "field", "value")
    return H.to_wide(long, ["file_id", "row_idx"], _PIVOT)


@query(
    "fold_observations",
    f"""{_DICT}, named AS (
          SELECT h.*, COALESCE(d.standard, '') AS standard
          FROM headers h LEFT JOIN dict_norm d ON d.norm = {norm_sql('h.raw_header')})
        SELECT c.file_id, c.sheet_idx, c.row_idx,
               string_agg(n.raw_header || ': ' || c.value, ' | ' ORDER BY c.col_idx) AS folded
        FROM cells c JOIN named n USING (file_id, sheet_idx, col_idx) WHERE n.standard = ''
        GROUP BY ALL""",
)
def fold_observations(spark, sf):
    found = header_texts(spark, sf)
    named = H.by_rules(found, header_dictionary(found)).drop("method")
    long = cells(spark, sf).join(named, ["file_id", "sheet_idx", "col_idx"])
    return H.fold_unmapped(long, ["file_id", "sheet_idx", "row_idx"], FIELDS)


@query(
    "new_headers",
    f"""{_DICT}
        SELECT DISTINCT raw_header AS raw, '' AS standard
        FROM headers ANTI JOIN dict ON dict.raw = headers.raw_header WHERE raw_header <> ''""",
)
def new_headers(spark, sf):
    found = header_texts(spark, sf)
    return growth.new_headers(found, header_dictionary(found))


@query(
    "new_header_counts",
    f"""{_DICT}
        SELECT count(*) AS total_headers,
               count(DISTINCT CASE WHEN d.raw IS NULL AND raw_header <> '' THEN raw_header END) AS new_headers
        FROM headers h LEFT JOIN dict d ON d.raw = h.raw_header""",
)
def new_header_counts(spark, sf):
    found = header_texts(spark, sf)
    return growth.header_growth_counts(found, growth.new_headers(found, header_dictionary(found)))


@query(
    "new_values",
    """WITH v AS (
         SELECT 'emetteur' AS field, p_brand AS raw FROM part
         UNION SELECT 'type_inject', p_name FROM part
         UNION SELECT 'type_inject', p_type FROM part)
       SELECT field, raw, '' AS standard FROM v
       WHERE NOT (field = 'type_inject' AND raw IN (SELECT p_name FROM part WHERE p_size % 7 = 0))""",
)
def new_values(spark, sf):
    part = table(spark, sf, "part")
    wide = part.select(
        F.concat(F.lit(" "), "p_brand").alias("Émetteur principal"),
        F.col("p_name").alias("Type d'inject"),
        F.concat("p_type", F.lit("  ")).alias("NATURE"),
        F.col("p_size").cast("string").alias("Heure"),
    )
    long = wide.unpivot([], list(wide.columns), "header", "value")
    known = part.where(F.col("p_size") % 7 == 0).select(
        F.lit("type_inject").alias("field"), F.col("p_name").alias("raw")
    )
    return growth.new_values(long, known.distinct())


@query(
    "merged_dictionary",
    """SELECT p_name AS raw, CASE WHEN max(p_size) > 45 THEN 'size ' || max(p_size)
              ELSE max(p_brand) END AS standard FROM part GROUP BY 1""",
)
def merged_dictionary(spark, sf):
    """Learnt answers replace the entries of the same key."""
    part = table(spark, sf, "part")
    per_name = part.groupBy(F.col("p_name").alias("raw")).agg(
        F.max("p_brand").alias("brand"), F.max("p_size").alias("size")
    )
    current = per_name.select("raw", F.col("brand").alias("standard"))
    learnt = per_name.where("size > 45").select("raw", F.concat(F.lit("size "), "size").alias("standard"))
    return growth.merge_entries(current, learnt, ["raw"])


_BY_COUNT = _STATS_MAIN.replace("contains(lower(s.sheet_name), 'exercice') DESC, ", "")
_GROWN = f"""WITH {cells_sql(True)}, {RANGES_SQL}, {_BY_COUNT},
    {HEADERS_SQL.replace('JOIN ranges r', 'JOIN main_ranges r')}, {header_dictionary_sql()}"""


@query(
    "header_growth",
    f"""{_GROWN}
        SELECT DISTINCT raw_header AS raw, '' AS standard
        FROM headers ANTI JOIN dict ON dict.raw = headers.raw_header WHERE raw_header <> ''""",
)
def header_growth(spark, sf):
    """From cells to new dictionary lines, over every file."""
    source, shape = cut_lineage(cells(spark, sf, True)), cut_lineage(sheets(spark, sf, True))
    stats = S.sheet_stats(source, shape)
    kept = S.keep_main(source, cut_lineage(S.main_sheet(stats, use_keywords=False)))
    found = S.header_cells(kept, S.header_row_by_fill(kept))
    known = cut_lineage(header_dictionary(found))
    return plans.header_growth(source, shape, known, max_files=None).added


_WORDS = ["and", "tion", "ein", "the", "le"]
_CANON = ["emetteur", "destinataire", "modalite", "type_inject"]


@query(
    "value_growth",
    f"""WITH {cells_sql(True)}, {RANGES_SQL}, {_BY_COUNT},
        hits AS (
          SELECT file_id, sheet_idx, row_idx,
                 {' + '.join(f"max(CAST(contains({norm_sql('value')}, '{k}') AS INTEGER))" for k in _WORDS)} AS n
          FROM cells GROUP BY ALL),
        heads AS (
          SELECT m.file_id, m.sheet_idx, COALESCE(min(row_idx), 1) AS header_row
          FROM main m LEFT JOIN hits h ON h.file_id = m.file_id AND h.sheet_idx = m.sheet_idx AND n >= 2
          GROUP BY ALL),
        headers AS (
          SELECT c.file_id, c.sheet_idx, c.col_idx, h.header_row, {strip_sql('c.value')} AS raw_header
          FROM cells c JOIN heads h ON c.file_id = h.file_id AND c.sheet_idx = h.sheet_idx
           AND c.row_idx = h.header_row),
        {header_dictionary_sql()},
        named AS (
          SELECT h.*, COALESCE({norm_sql('d.standard')}, {norm_sql('h.raw_header')}) AS standard
          FROM headers h LEFT JOIN dict_norm d ON d.norm = {norm_sql('h.raw_header')})
        SELECT DISTINCT CASE WHEN contains(n.standard, 'type') THEN 'type_inject' ELSE n.standard END
                 AS field, {strip_sql('c.value')} AS raw, '' AS standard
        FROM cells c JOIN named n USING (file_id, sheet_idx, col_idx)
        WHERE n.standard IN ('etablissement_type', {', '.join(f"'{c}'" for c in _CANON)})
          AND c.row_idx > n.header_row
          AND length({strip_sql('c.value')}) % 3 <> 0""",
)
def value_growth(spark, sf):
    """Values below headers that lead to a canonical field; every third is known already."""
    source, shape = cut_lineage(cells(spark, sf, True)), cut_lineage(sheets(spark, sf, True))
    main = cut_lineage(S.main_sheet(S.sheet_stats(source, shape), use_keywords=False))
    kept = S.keep_main(source, main)
    heads = S.header_row_by_keyword(kept, main, _WORDS).select(*S.SHEET, "header_row")
    full = heads.withColumns({"first_col": F.lit(1), "last_col": F.lit(1_000_000)})
    known_headers = cut_lineage(header_dictionary(S.header_cells(kept, full)))
    texts = source.select(F.trim("value").alias("raw")).distinct().where(F.length("raw") % 3 == 0)
    known = texts.select(F.explode(F.array(*map(F.lit, _CANON))).alias("field"), "raw")
    return plans.value_growth(source, shape, known_headers, known, None, _WORDS)
