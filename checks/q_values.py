"""Value standardization."""

from pyspark.sql import functions as F

from checks.registry import query
from checks.views import (
    INJ_SQL,
    MODE_SQL,
    TYPE_SQL,
    VALUE_ALLOWED,
    injects,
    norm_sql,
    table,
    value_dictionary,
)
from gridloom.functions import normalize
from gridloom.operators import values as V
from gridloom.operators.resolvers import (
    function_resolver,
    nearest_resolver,
    resolve_keys,
    table_resolver,
)

_EXACT = f"""SELECT o_custkey AS id_chronogramme, CAST(o_orderkey AS VARCHAR) AS id_inject,
                    {TYPE_SQL} AS type_inject, {MODE_SQL} AS modalite FROM orders"""
_TYPES = "('Critique', 'Important', 'Secondaire')"


def _exact(spark, sf):
    wide = V.standardize_exact_wide(
        injects(spark, sf), value_dictionary(spark), ["type_inject", "modalite"], ["row_idx"]
    )
    return wide.select("id_chronogramme", "id_inject", "type_inject", "modalite")


@query("values_exact", _EXACT)
def values_exact(spark, sf):
    return _exact(spark, sf)


@query("values_allowed", f"SELECT * FROM ({_EXACT}) WHERE type_inject IN {_TYPES}")
def values_allowed(spark, sf):
    return V.filter_allowed(_exact(spark, sf), VALUE_ALLOWED).kept


@query(
    "values_rejected",
    f"SELECT *, 'not allowed: type_inject' AS reason FROM ({_EXACT}) WHERE type_inject NOT IN {_TYPES}",
)
def values_rejected(spark, sf):
    return V.filter_allowed(_exact(spark, sf), VALUE_ALLOWED).rejected


def _spelled():
    priority = F.col("type_inject")
    return (
        F.when(F.col("row_idx") % 4 == 0, F.concat(F.lit("  "), F.lower(priority)))
        .when(F.col("row_idx") % 4 == 1, "Important")
        .when(F.col("row_idx") % 4 == 2, priority)
    )


_LONG_SQL = f"""{INJ_SQL},
    long AS (
      SELECT file_id, row_idx, 'type_inject' AS field,
             CASE row_idx % 4 WHEN 0 THEN '  ' || lower(type_inject) WHEN 1 THEN 'Important'
                  WHEN 2 THEN type_inject END AS value FROM inj
      UNION ALL SELECT file_id, row_idx, 'modalite', modalite FROM inj),
    dict(field, norm, standard) AS (VALUES ('type_inject', '1-urgent', 'Critique'),
      ('type_inject', '2-high', 'Important'), ('type_inject', '5-low', 'Secondaire'),
      ('modalite', 'f', 'Email'), ('modalite', 'o', 'SMS')),
    looked AS (
      SELECT l.*, trim(value) AS raw, {norm_sql('value')} AS norm, d.standard AS hit,
             CASE WHEN field = 'type_inject' THEN trim(value) IN {_TYPES}
                  ELSE trim(value) IN ('Email', 'SMS', 'P') END AS is_ok
      FROM long l LEFT JOIN dict d ON d.field = l.field AND d.norm = {norm_sql('l.value')})"""
_LONG_SQL = _LONG_SQL.replace("CASE WHEN field =", "CASE WHEN l.field =")


def _long(spark, sf):
    wide = injects(spark, sf).withColumn("type_inject", _spelled())
    return wide.unpivot(["file_id", "row_idx"], ["type_inject", "modalite"], "field", "value")


@query(
    "values_classified",
    f"""WITH {_LONG_SQL}
        SELECT file_id, row_idx, field, value, raw, norm,
               COALESCE(hit, CASE WHEN is_ok THEN raw END) AS standard,
               CASE WHEN hit IS NOT NULL THEN 'dict' WHEN is_ok THEN 'ok' END AS method
        FROM looked""",
)
def values_classified(spark, sf):
    return V.classify(_long(spark, sf), value_dictionary(spark), VALUE_ALLOWED)


@query(
    "values_method_log",
    f"""WITH {_LONG_SQL},
        answered AS (
          SELECT *, hit IS NULL AND NOT COALESCE(is_ok, false) AND value IS NOT NULL AS is_open,
                 CASE WHEN norm = '3-medium' THEN 'Important' END AS answer,
                 row_number() OVER (PARTITION BY file_id, field, norm ORDER BY row_idx) AS rn
          FROM looked)
        SELECT file_id, row_idx AS position, field AS scope, raw AS nom_original,
               CASE WHEN is_open THEN COALESCE(answer, '') ELSE COALESCE(hit, raw) END AS champ_standard,
               CASE WHEN is_open AND answer IS NOT NULL AND rn > 1 THEN 'dict' WHEN is_open THEN 'IA'
                    WHEN hit IS NOT NULL THEN 'dict' ELSE 'ok' END AS methode
        FROM answered WHERE value IS NOT NULL""",
)
def values_method_log(spark, sf):
    """The reviewed table knows one of the two open priorities; its other answer is not allowed."""
    reviewed = spark.createDataFrame(
        [("type_inject", "3-medium", "Important"), ("type_inject", "4-not specified", "Autre")],
        "scope string, key string, standard string",
    )
    done = V.standardize_values(
        _long(spark, sf), value_dictionary(spark), VALUE_ALLOWED, table_resolver(reviewed)
    )
    return V.value_log(done.values)


@query(
    "values_log_summary",
    f"""WITH {_LONG_SQL}
        SELECT field AS scope, raw AS nom_original, COALESCE(hit, CASE WHEN is_ok THEN raw END, '')
                 AS champ_standard,
               CASE WHEN hit IS NOT NULL THEN 'dict' WHEN is_ok THEN 'ok' ELSE 'IA' END AS methode,
               count(*) AS n
        FROM looked WHERE value IS NOT NULL GROUP BY ALL""",
)
def values_log_summary(spark, sf):
    done = V.standardize_values(_long(spark, sf), value_dictionary(spark), VALUE_ALLOWED)
    return V.summarize_log(V.value_log(done.values))


_NAMES = ["Small rings", "red gadgets", "big widget", "Blue bolt", "éclair"]


@query(
    "values_resolved_nearest",
    f"""WITH names AS (SELECT DISTINCT p_name AS raw, {norm_sql('p_name')} AS key FROM part),
        listed(pos, standard) AS (VALUES {', '.join(f"({i}, '{n}')" for i, n in enumerate(_NAMES))}),
        pairs AS (SELECT key, standard, pos, levenshtein(key, {norm_sql('standard')}) AS d
                  FROM names, listed)
        SELECT 'name' AS scope, key, standard FROM pairs WHERE d <= 4
        QUALIFY row_number() OVER (PARTITION BY key ORDER BY d, pos) = 1""",
)
def values_resolved_nearest(spark, sf):
    unresolved = table(spark, sf, "part").groupBy(normalize(F.col("p_name")).alias("key")).agg(
        F.min("p_name").alias("raw")
    )
    scoped = unresolved.select(F.lit("name").alias("scope"), "key", "raw")
    allowed = {"name": _NAMES}
    return resolve_keys(scoped, nearest_resolver(allowed, 4), allowed).accepted


def _suggest(text, allowed):
    choices = list(allowed)
    return choices[len(text) % len(choices)] if len(text) % 3 else "Autre"


@query(
    "values_resolved_callback",
    f"""WITH names AS (SELECT DISTINCT p_name AS raw FROM part)
        SELECT 'name' AS scope, {norm_sql('raw')} AS key,
               CASE WHEN length(raw) % 3 <> 0
                    THEN list_extract([{', '.join(f"'{n}'" for n in _NAMES)}], length(raw) % 5 + 1)
                    ELSE 'Autre' END AS standard,
               length(raw) % 3 <> 0 AS accepted FROM names""",
)
def values_resolved_callback(spark, sf):
    """A Python callback, asked once per distinct key; answers outside the list are refused."""
    unresolved = table(spark, sf, "part").groupBy(normalize(F.col("p_name")).alias("key")).agg(
        F.min("p_name").alias("raw")
    )
    scoped = unresolved.select(F.lit("name").alias("scope"), "key", "raw")
    allowed = {"name": _NAMES}
    done = resolve_keys(scoped, function_resolver(_suggest, allowed), allowed)
    return done.accepted.withColumn("accepted", F.lit(True)).unionByName(
        done.refused.withColumn("accepted", F.lit(False))
    )
