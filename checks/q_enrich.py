"""Context, numbering, submissions and constraints."""

from pyspark.sql import functions as F

from checks.registry import query
from checks.views import (
    FACTS_SQL,
    INJ_SQL,
    META_SQL,
    ascii_sql,
    date_sql,
    facts,
    injects,
    safe_sql,
    submissions,
    table,
)
from gridloom.operators import corrections, enrich as E, integrity as I, metadata as M
from gridloom.plans.submissions import submit
from gridloom.session import cut_lineage, scratch_path
from gridloom.sinks.store import Store

_MOMENT = "2024-05-06 07:08:09"


def _moment():
    return F.lit(_MOMENT).cast("timestamp")


def _context(spark, sf):
    meta = submissions(spark, sf)
    return meta.select(
        "file_id",
        F.col("ordinal").alias("id_chronogramme"),
        "etablissement_nom",
        "etablissement_type",
        "nom_chronogramme",
        "date_exercice",
    )


_CONTEXT = "m.ordinal AS id_chronogramme, m.etablissement_nom, m.etablissement_type, m.nom_chronogramme, m.date_exercice"


@query(
    "add_context",
    f"""WITH {INJ_SQL}, {META_SQL}
        SELECT i.file_id, i.row_idx, i.id_inject, i.type_inject, {_CONTEXT}
        FROM inj i JOIN meta m USING (file_id)""",
)
def add_context(spark, sf):
    rows = injects(spark, sf).select("file_id", "row_idx", "id_inject", "type_inject")
    return E.add_context(rows, _context(spark, sf))


@query(
    "number_rows",
    f"""WITH {INJ_SQL}
        SELECT file_id, row_idx, row_number() OVER (PARTITION BY file_id ORDER BY row_idx)
                 AS numero_inject FROM inj""",
)
def number_rows(spark, sf):
    return E.number_rows(injects(spark, sf).select("file_id", "row_idx"))


@query(
    "number_rows_large",
    """SELECT l_orderkey * 8 + l_linenumber AS row_idx, row_number() OVER (ORDER BY 1) AS numero_inject
       FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)""".replace(
        "ORDER BY 1", "ORDER BY l_orderkey * 8 + l_linenumber"
    ),
)
def number_rows_large(spark, sf):
    """One file that holds every row."""
    position = F.col("l_orderkey") * 8 + F.col("l_linenumber")
    rows = table(spark, sf, "lineitem").select(position.alias("row_idx")).distinct()
    one_file = rows.select(F.lit("all").alias("file_id"), "row_idx")
    return E.number_rows(one_file, width=4096).select("row_idx", "numero_inject")


_FAR = "l_orderkey * 1000003 + l_linenumber * 7919"


@query(
    "number_rows_sparse",
    f"""SELECT file_id, row_idx, row_number() OVER (PARTITION BY file_id ORDER BY row_idx) AS numero_inject
        FROM (SELECT DISTINCT CASE WHEN l_orderkey % 3 = 0 THEN 'all' ELSE l_returnflag END AS file_id,
                     {_FAR} AS row_idx FROM lineitem)""",
)
def number_rows_sparse(spark, sf):
    """Ordinals a million apart, a third of all rows in one file."""
    file_id = F.when(F.col("l_orderkey") % 3 == 0, "all").otherwise(F.col("l_returnflag"))
    rows = table(spark, sf, "lineitem").select(file_id.alias("file_id"), F.expr(_FAR).alias("row_idx"))
    numbered = E.number_rows(rows.distinct(), width=4096, sparse=True)
    return numbered.select("file_id", "row_idx", "numero_inject")


def _sparse_ids(spark, sf):
    """Customers divisible by 3 have no ids at all; the others miss some."""
    key = F.col("row_idx")
    kept = (F.col("id_chronogramme") % 3 != 0) & (key % 4 != 1)
    blank = F.when(key % 2 == 0, F.lit("  "))
    return injects(spark, sf).select(
        "file_id", "row_idx", F.when(kept, F.col("id_inject")).otherwise(blank).alias("id_inject")
    )


_SPARSE = f"""{INJ_SQL}, sparse AS (
      SELECT file_id, row_idx, CASE WHEN id_chronogramme % 3 <> 0 AND row_idx % 4 <> 1 THEN id_inject
               WHEN row_idx % 2 = 0 THEN '  ' END AS id_inject FROM inj),
    marked AS (SELECT *, COALESCE(trim(id_inject), '') = '' AS blank FROM sparse),
    counted AS (
      SELECT *, sum(CAST(blank AS INTEGER)) OVER (PARTITION BY file_id ORDER BY row_idx) AS k,
             min(CAST(blank AS INTEGER)) OVER (PARTITION BY file_id) = 1 AS all_blank,
             count(*) OVER (PARTITION BY file_id) AS nb_injects FROM marked)"""


@query(
    "fill_missing_ids",
    f"""WITH {_SPARSE} SELECT file_id, row_idx,
          CASE WHEN blank THEN CAST(k AS VARCHAR) ELSE id_inject END AS id_inject FROM counted""",
)
def fill_missing_ids(spark, sf):
    return E.fill_missing_ids(_sparse_ids(spark, sf), width=64)


@query("row_counts", f"WITH {INJ_SQL} SELECT file_id, row_idx, count(*) OVER (PARTITION BY file_id) AS nb_injects FROM inj")
def row_counts(spark, sf):
    return E.add_counts(injects(spark, sf).select("file_id", "row_idx"))


@query(
    "enrich",
    f"""WITH {_SPARSE}, {META_SQL}
        SELECT c.file_id, c.row_idx, CASE WHEN blank THEN CAST(k AS VARCHAR) ELSE id_inject END AS id_inject,
               CAST(CASE WHEN all_blank THEN k END AS BIGINT) AS numero_inject, c.nb_injects, {_CONTEXT}
        FROM counted c JOIN meta m USING (file_id)""",
)
def enrich(spark, sf):
    return E.enrich(_sparse_ids(spark, sf), _context(spark, sf), width=64)


# Submissions

_REQ = [f"CASE WHEN COALESCE({n}, '') = '' THEN '{n}' END" for n in M.REQUIRED if n != "nom_fichier_excel"]


@query(
    "required_fields",
    f"""WITH {META_SQL}
        SELECT file_id, 'Missing required metadata fields: '
               || concat_ws(', ', {', '.join(_REQ)}, 'nom_fichier_excel') AS reason
        FROM meta""",
)
def required_fields(spark, sf):
    return M.check_required(submissions(spark, sf)).rejected.select("file_id", "reason")


_DEFAULTS_SQL = f"""{META_SQL}, filled AS (
      SELECT file_id, ordinal, file_path,
             COALESCE(nom_chronogramme, regexp_replace(string_split(file_path, '/')[-1], '\\.[^.]*$', ''))
               AS nom_chronogramme,
             COALESCE(date_exercice, '2024-05-06') AS date_exercice,
             COALESCE(lieu_exercice, 'N/A') AS lieu_exercice,
             COALESCE(etablissement_nom, 'Auto') AS etablissement_nom,
             COALESCE(etablissement_type, 'N/A') AS etablissement_type,
             COALESCE(submitter, 'pipeline') AS submitter,
             string_split(file_path, '/')[-1] AS nom_fichier_excel, nb_injects FROM meta)"""


@query("metadata_defaults", f"WITH {_DEFAULTS_SQL} SELECT * FROM filled")
def metadata_defaults(spark, sf):
    return M.with_defaults(submissions(spark, sf), _moment().cast("date"))


_CLEAN_SQL = f"""{_DEFAULTS_SQL}, cleaned AS (
      SELECT file_id, ordinal, {ascii_sql('nom_chronogramme')} AS nom_chronogramme,
             {date_sql('date_exercice')} AS date_exercice, {ascii_sql('lieu_exercice')} AS lieu_exercice,
             {ascii_sql('etablissement_nom')} AS etablissement_nom,
             {ascii_sql('etablissement_type')} AS etablissement_type, {ascii_sql('submitter')} AS submitter,
             {ascii_sql('nom_fichier_excel')} AS fichier_source,
             '2024-05-06T07:08:09.000000+00:00' AS date_soumission,
             COALESCE(TRY_CAST(nb_injects AS BIGINT), 0) AS nb_injects
      FROM filled WHERE etablissement_type <> '')"""
_CLEANED = [
    "nom_chronogramme", "date_exercice", "lieu_exercice", "etablissement_nom", "etablissement_type",
    "submitter", "fichier_source", "date_soumission", "nb_injects",
]


@query(
    "register_submissions",
    f"""WITH {_CLEAN_SQL}
        SELECT 100 + row_number() OVER (ORDER BY ordinal) AS id_chronogramme, {', '.join(_CLEANED)}
        FROM cleaned""",
)
def register_submissions(spark, sf):
    """Defaults, check, cleaning and ids after the largest stored one (here 100)."""
    filled = M.with_defaults(submissions(spark, sf), _moment().cast("date"))
    cleaned = M.clean_metadata(M.check_required(filled).valid, _moment())
    return M.assign_ids(cleaned, 100, "ordinal", width=64).select("id_chronogramme", *_CLEANED)


@query(
    "assigned_ids",
    f"""WITH {META_SQL} SELECT count(*) AS n, count(*) AS n_ids, 8 AS first_id, count(*) + 7 AS last_id FROM meta""",
)
def assigned_ids(spark, sf):
    """Without an order to follow: dense, unique, the same on every run."""
    numbered = M.assign_ids(submissions(spark, sf), 7)
    ids = F.col("id_chronogramme")
    return numbered.agg(
        F.count("*").alias("n"),
        F.count_distinct(ids).alias("n_ids"),
        F.min(ids).alias("first_id"),
        F.max(ids).alias("last_id"),
    )


_NAMED_SQL = f"""{META_SQL}, named AS (
      SELECT file_id, ordinal, trim('Chronogramme_' || {safe_sql('etablissement_nom')} || '_'
               || {safe_sql('nom_chronogramme')} || '_' || {date_sql('date_exercice', True)}, '_') AS base
      FROM (SELECT file_id, ordinal, file_path, COALESCE(etablissement_nom, '') AS etablissement_nom,
                   COALESCE(nom_chronogramme, '') AS nom_chronogramme,
                   COALESCE(date_exercice, '') AS date_exercice FROM meta)
      WHERE lower(file_path) LIKE '%.xlsx')"""


@query(
    "structured_names",
    f"""WITH {_NAMED_SQL},
        ranked AS (
          SELECT *, row_number() OVER (PARTITION BY base ORDER BY ordinal)
                 + CAST(base LIKE '%nation_3_%' AS INTEGER) AS turn FROM named)
        SELECT file_id, base || CASE WHEN turn = 1 THEN '' WHEN turn = 2 THEN '_070809'
                                     ELSE '_070809_' || (turn - 1) END || '.xlsx' AS file_name
        FROM ranked""",
)
def structured_names(spark, sf):
    """Names taken inside the batch, and every name of one nation taken before."""
    meta = submissions(spark, sf)
    taken = M.structured_name(meta).where(F.contains("base_name", F.lit("nation_3_")))
    existing = taken.select(F.concat("base_name", F.lit(".xlsx")).alias("file_name"))
    named = M.unique_names(meta, "ordinal", existing, _moment(), width=64)
    return named.select("file_id", "file_name")


@query(
    "submit_files",
    f"""WITH {_NAMED_SQL},
        ranked AS (SELECT *, row_number() OVER (PARTITION BY base ORDER BY ordinal) AS turn FROM named)
        SELECT row_number() OVER (ORDER BY ordinal) AS id_chronogramme,
               base || CASE WHEN turn = 1 THEN '' WHEN turn = 2 THEN '_070809'
                            ELSE '_070809_' || (turn - 1) END || '.xlsx' AS fichier_source
        FROM ranked""",
)
def submit_files(spark, sf):
    """Naming and registration in one go, read back from the stored dimension."""
    store = Store(spark, scratch_path(spark, "submit"))
    store.create()
    submit(store, submissions(spark, sf), "/inbox", "ordinal", at=_moment())
    return store.dimension().select("id_chronogramme", "fichier_source")


# Constraints


@query(
    "not_null_violations",
    f"""WITH {FACTS_SQL} SELECT row_idx, 'id_chronogramme' AS null_columns FROM facts
        WHERE id_chronogramme IS NULL""",
)
def not_null_violations(spark, sf):
    found = I.not_null_violations(facts(spark, sf), ["id_chronogramme", "type_inject"])
    return found.select("row_idx", "null_columns")


def _split_facts(spark, sf):
    rows = facts(spark, sf)
    return rows.where(F.col("row_idx") % 3 != 0), rows.where(F.col("row_idx") % 3 == 0)


@query(
    "duplicate_keys",
    f"""WITH {FACTS_SQL},
        b AS (SELECT id_chronogramme, id_inject, count(*) AS n FROM facts
              WHERE row_idx % 3 <> 0 AND id_inject IS NOT NULL GROUP BY ALL),
        s AS (SELECT DISTINCT id_chronogramme, id_inject, 1 AS known FROM facts WHERE row_idx % 3 = 0)
        SELECT id_chronogramme, id_inject, n + COALESCE(known, 0) AS n
        FROM b LEFT JOIN s USING (id_chronogramme, id_inject) WHERE n > 1 OR known = 1""",
)
def duplicate_keys(spark, sf):
    batch, stored = _split_facts(spark, sf)
    return I.duplicate_keys(batch, stored)


def _parents(spark, sf):
    customer = table(spark, sf, "customer")
    return customer.where(F.col("c_custkey") % 10 != 4).select(F.col("c_custkey").alias("id_chronogramme"))


@query(
    "orphan_rows",
    f"""WITH {FACTS_SQL} SELECT row_idx, id_chronogramme FROM facts
        WHERE id_chronogramme IS NOT NULL
          AND id_chronogramme NOT IN (SELECT c_custkey FROM customer WHERE c_custkey % 10 <> 4)""",
)
def orphan_rows(spark, sf):
    return I.orphans(facts(spark, sf), _parents(spark, sf)).select("row_idx", "id_chronogramme")


_GATE = f"""{FACTS_SQL},
    batch AS (SELECT row_idx // 8 AS file_id, * FROM facts WHERE row_idx % 3 <> 0),
    stored AS (SELECT DISTINCT id_chronogramme, id_inject FROM facts WHERE row_idx % 3 = 0),
    dup AS (
      SELECT id_chronogramme, id_inject FROM batch
      WHERE id_inject IS NOT NULL AND id_chronogramme IS NOT NULL GROUP BY ALL
      HAVING count(*) > 1 OR (id_chronogramme, id_inject) IN (SELECT (id_chronogramme, id_inject) FROM stored
                                WHERE id_inject IS NOT NULL AND id_chronogramme IS NOT NULL)),
    bad AS (
      SELECT file_id, 'null parent' AS reason FROM batch WHERE id_chronogramme IS NULL
      UNION ALL SELECT file_id, 'unknown parent' FROM batch
        WHERE id_chronogramme NOT IN (SELECT c_custkey FROM customer WHERE c_custkey % 10 <> 4)
      UNION ALL SELECT file_id, 'duplicate key' FROM batch JOIN dup USING (id_chronogramme, id_inject))"""


def _gate(spark, sf):
    batch, stored = _split_facts(spark, sf)
    files = batch.withColumn("file_id", F.floor(F.col("row_idx") / 8))
    return I.atomic_gate(files, _parents(spark, sf), stored, unit="file_id")


@query(
    "atomic_accept",
    f"WITH {_GATE} SELECT file_id, row_idx FROM batch WHERE file_id NOT IN (SELECT file_id FROM bad)",
)
def atomic_accept(spark, sf):
    return _gate(spark, sf).accepted.select("file_id", "row_idx")


@query("atomic_reject", f"WITH {_GATE} SELECT file_id, reason, count(*) AS n FROM bad GROUP BY ALL")
def atomic_reject(spark, sf):
    return _gate(spark, sf).rejected


@query(
    "required_facts",
    f"""WITH {FACTS_SQL} SELECT row_idx, 'id_inject' || CASE WHEN description IS NULL THEN ', description'
          ELSE '' END AS missing FROM facts WHERE id_inject IS NULL
        UNION ALL SELECT row_idx, 'description' FROM facts WHERE id_inject IS NOT NULL AND description IS NULL""",
)
def required_facts(spark, sf):
    found = I.required_values(facts(spark, sf), ["id_inject", "type_inject", "description"])
    return found.select("row_idx", "missing")


# Corrections and the establishment dimension


@query(
    "apply_corrections",
    """SELECT o_custkey AS id_chronogramme, o_orderkey AS row_idx,
              CASE WHEN o_orderpriority = '1-URGENT' AND o_custkey % 2 = 0 THEN 'Vital'
                   WHEN o_orderpriority = '5-LOW' AND o_custkey % 5 = 0 THEN 'Mineur'
                   ELSE o_orderpriority END AS type_inject,
              CASE WHEN o_orderstatus = 'F' AND o_custkey % 3 = 0 THEN 'Radio' ELSE o_orderstatus END
                AS modalite
       FROM orders""",
)
def apply_corrections(spark, sf):
    """Every customer logged its decisions; an edited dictionary changes some of them."""
    rows = injects(spark, sf).select("id_chronogramme", "row_idx", "type_inject", "modalite")
    logged = [
        ("type_inject", "urgent", "1-URGENT", 2),
        ("type_inject", "low", "5-LOW", 5),
        ("type_inject", "high", "2-HIGH", 1),
        ("modalite", "fax", "F", 3),
    ]
    names = ["scope", "nom_original", "champ_standard", "every"]
    decisions = F.array(*[F.struct(*[F.lit(v).alias(n) for n, v in zip(names, d)]) for d in logged])
    key = F.col("c_custkey")
    log = table(spark, sf, "customer").select(
        key.alias("id_chronogramme"),
        F.inline(F.filter(decisions, lambda d: key % d["every"] == 0)),
    )
    edited = spark.createDataFrame(
        [
            ("type_inject", "urgent", "Vital"),
            ("type_inject", "low", "Mineur"),
            ("type_inject", "high", "2-HIGH"),
            ("modalite", "fax", "Radio"),
        ],
        "field string, raw string, standard string",
    )
    changed = corrections.corrections(log, edited)
    return corrections.apply_corrections(rows, changed, ["type_inject", "modalite"], ["row_idx"])


@query(
    "establishments",
    f"""WITH {META_SQL},
        e AS (SELECT etablissement_nom AS nom, min(etablissement_type) AS type FROM meta
              WHERE etablissement_nom IS NOT NULL GROUP BY 1)
        SELECT m.file_id, e.nom, e.type FROM meta m LEFT JOIN e ON e.nom = m.etablissement_nom""",
)
def establishments(spark, sf):
    """Numbers have no meaning of their own, so the link is shown by the row it leads to."""
    meta = submissions(spark, sf)
    known = cut_lineage(corrections.establishments(meta))
    linked = corrections.link_establishments(meta, known).select("file_id", "id_etablissement")
    return linked.join(known, "id_etablissement", "left").select("file_id", "nom", "type")
