"""Logs, rates, alerts and reports."""

from pyspark.sql import functions as F

from checks.registry import query
from checks.views import DECISIONS_SQL, FACTS_SQL, RUNS_SQL, decisions, facts, norm_sql, run_lines, table
from gridloom.operators import corrections, kpi as K
from gridloom.sinks.store import log_rows
from gridloom.sources.records import parse_run_lines, steps_of, submissions_from_text

_AT = "2024-05-06 07:08:09"


@query("run_ids", f"WITH {RUNS_SQL} SELECT * FROM runs")
def run_ids(spark, sf):
    return K.run_ids(parse_run_lines(run_lines(spark, sf)))


@query(
    "run_summary",
    """WITH s AS (
         SELECT printf('run_%06d.log', user_id) AS run_id, event_id, round(value, 2) AS d,
                CASE WHEN event_id % 4 <> 1 THEN 'INSERT_METADATA' ELSE 'CLEAN_DATA' END AS name
         FROM events WHERE event_type = 'purchase')
       SELECT run_id, 'SUCCES' AS status, round(sum(d + 0.5), 4) AS total_duration,
              2 * count(*) AS n_steps, count(*) FILTER (name = 'CLEAN_DATA') AS n_clean
       FROM s GROUP BY 1""",
)
def run_summary(spark, sf):
    done = K.run_summary(steps_of(parse_run_lines(run_lines(spark, sf))))
    cleaning = F.filter("steps", lambda s: s["name"] == "CLEAN_DATA")
    return done.select(
        "run_id",
        "status",
        F.round("total_duration", 4).alias("total_duration"),
        F.size("steps").cast("long").alias("n_steps"),
        F.size(cleaning).cast("long").alias("n_clean"),
    )


_RATES_SQL = f"""{DECISIONS_SQL}, rates AS (
      SELECT id_chronogramme AS chrono_id, count(*) AS total,
             count(*) FILTER (methode = 'règle') / count(*) AS auto_rate,
             count(*) FILTER (methode = 'IA') / count(*) AS ia_rate,
             count(*) FILTER (methode = 'dict') / count(*) AS dict_rate,
             count(*) FILTER (methode = 'ok') / count(*) AS ok_rate,
             count(*) FILTER (COALESCE(champ_standard, '') = '') / count(*) AS unresolved_rate
      FROM mlog GROUP BY 1)"""
_RATES = ["auto_rate", "ia_rate", "dict_rate", "ok_rate", "unresolved_rate"]


@query(
    "method_rates",
    f"WITH {_RATES_SQL} SELECT chrono_id, total, {', '.join(f'round({r}, 6) AS {r}' for r in _RATES)} FROM rates",
)
def method_rates(spark, sf):
    done = K.method_rates(decisions(spark, sf))
    return done.select("chrono_id", "total", *[F.round(r, 6).alias(r) for r in _RATES])


_COMPLETE_SQL = f"""{FACTS_SQL}, complete AS (
      SELECT id_chronogramme AS chrono_id,
             ({' + '.join(f'count({c})' for c in K.COUNTED)}) / (count(*) * 11) AS completeness
      FROM facts GROUP BY 1)"""


@query(
    "completeness",
    f"WITH {_COMPLETE_SQL} SELECT chrono_id, round(completeness, 6) AS completeness FROM complete",
)
def completeness(spark, sf):
    done = K.completeness(facts(spark, sf))
    return done.select("chrono_id", F.round("completeness", 6).alias("completeness"))


_ALERT = """CASE WHEN ia_rate > 0.6 OR unresolved_rate > 0.2 OR completeness < 0.7 THEN '🔴'
                 WHEN ia_rate > 0.4 OR unresolved_rate > 0.1 OR completeness < 0.9 THEN '⚠'
                 ELSE '' END"""


@query(
    "alerts",
    f"""WITH r AS (
          SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity,
                 l_discount * 10 AS ia_rate, l_tax * 2.5 AS unresolved_rate,
                 0.6 + l_quantity / 100 AS completeness FROM lineitem)
        SELECT round(ia_rate, 3) AS ia, round(unresolved_rate, 3) AS unresolved,
               round(completeness, 3) AS complete, {_ALERT} AS alert, count(*) AS n
        FROM r GROUP BY ALL""",
)
def alerts(spark, sf):
    """The three rates come from line figures, so every side of every limit occurs."""
    rates = table(spark, sf, "lineitem").select(
        (F.col("l_discount") * 10).alias("ia_rate"),
        (F.col("l_tax") * 2.5).alias("unresolved_rate"),
        (F.lit(0.6) + F.col("l_quantity") / 100).alias("completeness"),
    )
    sign = K.alert(F.col("ia_rate"), F.col("unresolved_rate"), F.col("completeness"))
    return rates.groupBy(
        F.round("ia_rate", 3).alias("ia"),
        F.round("unresolved_rate", 3).alias("unresolved"),
        F.round("completeness", 3).alias("complete"),
        sign.alias("alert"),
    ).agg(F.count("*").alias("n"))


_KPI_SQL = f"""WITH {RUNS_SQL}, {_RATES_SQL}, {_COMPLETE_SQL},
    joined AS (
      SELECT log_name, chrono_id, COALESCE(auto_rate, 0) AS auto_rate, COALESCE(ia_rate, 0) AS ia_rate,
             COALESCE(unresolved_rate, 0) AS unresolved_rate, COALESCE(completeness, 0) AS completeness
      FROM runs LEFT JOIN rates USING (chrono_id) LEFT JOIN complete USING (chrono_id))"""


def _kpi(spark, sf):
    records = parse_run_lines(run_lines(spark, sf))
    return K.kpi(K.run_ids(records), decisions(spark, sf), facts(spark, sf))


@query(
    "kpi_report",
    f"""{_KPI_SQL} SELECT log_name, chrono_id, round(auto_rate, 6) AS auto_rate,
          round(ia_rate, 6) AS ia_rate, round(unresolved_rate, 6) AS unresolved_rate,
          round(completeness, 6) AS completeness, {_ALERT} AS alert FROM joined""",
)
def kpi_report(spark, sf):
    done = _kpi(spark, sf)
    return done.select("log_name", "chrono_id", *[F.round(n, 6).alias(n) for n in _SHOWN], "alert")


_SHOWN = ["auto_rate", "ia_rate", "unresolved_rate", "completeness"]
_PCTS = " || ' | ' || ".join(
    f"printf('%.1f%%', floor(round({n}, 9) * 1000 + 0.5) / 10)" for n in _SHOWN
)


@query(
    "report_lines",
    f"""{_KPI_SQL} SELECT 1 AS part, log_name,
               '| ' || log_name || ' | ' || chrono_id || ' | ' || {_PCTS} || ' | ' || {_ALERT} || ' |' AS line
        FROM joined
        UNION ALL VALUES (0, '0', '{K.REPORT_HEAD[0]}'), (0, '1', '{K.REPORT_HEAD[1]}')""",
)
def report_lines(spark, sf):
    done = _kpi(spark, sf)
    # Rates are cut to nine digits first: halves must fall the same way on both sides.
    return K.report_lines(done.withColumns({n: F.round(n, 9) for n in _SHOWN}))


@query(
    "mapping_log",
    f"""WITH {DECISIONS_SQL}
        SELECT id_chronogramme, scope, nom_original, champ_standard,
               {norm_sql('nom_original')} AS original_norm,
               COALESCE({norm_sql('champ_standard')}, '') AS standard_norm, methode,
               '2024-05-06T07:08:09Z' AS horodatage, count(*) AS n FROM mlog GROUP BY ALL""",
)
def mapping_log(spark, sf):
    rows = log_rows(decisions(spark, sf), F.lit(_AT).cast("timestamp"))
    return rows.groupBy(*rows.columns).agg(F.count("*").alias("n"))


@query(
    "control_report",
    f"""WITH {DECISIONS_SQL}
        SELECT id_chronogramme, CASE WHEN scope = 'header' THEN 'En-têtes' ELSE 'Valeurs' END AS onglet,
               methode AS decision, count(*) AS n,
               count(*) FILTER (COALESCE(champ_standard, '') = '') AS n_open
        FROM mlog GROUP BY ALL""",
)
def control_report(spark, sf):
    return corrections.control_report(decisions(spark, sf))


@query(
    "correspondence",
    f"""WITH {DECISIONS_SQL}
        SELECT DISTINCT scope, nom_original AS original, champ_standard AS standard, methode AS source
        FROM mlog""",
)
def correspondence(spark, sf):
    return corrections.correspondence(decisions(spark, sf))


@query(
    "correspondence_ids",
    f"""WITH {DECISIONS_SQL}
        SELECT DISTINCT id_chronogramme, scope, nom_original AS original, champ_standard AS standard,
               methode AS source FROM mlog""",
)
def correspondence_ids(spark, sf):
    return corrections.correspondence_by_chronogram(decisions(spark, sf))


@query(
    "batch_outcome",
    """SELECT c_name || '.xlsx' AS file_name, max(o_custkey) AS chrono_id,
              CASE WHEN max(o_custkey) IS NULL THEN 'ERROR' ELSE 'OK' END AS status
       FROM customer LEFT JOIN orders ON o_custkey = c_custkey AND o_orderstatus = 'P' GROUP BY c_name""",
)
def batch_outcome(spark, sf):
    """Customers hand in files; those with a pending order were loaded."""
    customer, orders = table(spark, sf, "customer"), table(spark, sf, "orders")
    name = F.concat("c_name", F.lit(".xlsx"))
    pending = orders.where(F.col("o_orderstatus") == "P").select("o_custkey").distinct()
    loaded = customer.join(pending, customer.c_custkey == pending.o_custkey).select(
        F.col("c_custkey").alias("id_chronogramme"), name.alias("fichier_source")
    )
    return K.batch_outcome(customer.select(name.alias("file_name")), loaded)


@query(
    "submissions_from_json",
    """SELECT CAST(event_id AS VARCHAR) AS file_id, event_type AS nom_chronogramme,
              CAST(user_id AS VARCHAR) AS submitter, NULL AS lieu_exercice FROM events""",
)
def submissions_from_json(spark, sf):
    events = table(spark, sf, "events")
    record = F.struct(
        F.col("event_type").alias("nom_chronogramme"), F.col("user_id").alias("submitter")
    )
    texts = events.select(F.col("event_id").cast("string").alias("file_id"), F.to_json(record).alias("meta"))
    return submissions_from_text(texts).select(
        "file_id", "nom_chronogramme", "submitter", "lieu_exercice"
    )
