"""Quality indicators per run."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.functions.rates import format_pct, rate
from gridloom.model import FACT, METHOD_DICT, METHOD_OK, METHOD_RESOLVER, METHOD_RULE

TECHNICAL = ["id_inject_global", "id_chronogramme"]
COUNTED = [c for c in FACT.names if c not in TECHNICAL]

# Alert signs and report header.
RED, YELLOW = "🔴", "⚠"
REPORT_HEAD = [
    "| run log | id | auto | ia | non résolu | complétude | alerte |",
    "|---------|----|------|----|------------|------------|--------|",
]


@dataclass(frozen=True)
class Thresholds:
    """Levels that must be passed, not reached."""

    # The default levels.
    red_resolver: float = 0.6
    red_unresolved: float = 0.2
    red_completeness: float = 0.7
    yellow_resolver: float = 0.4
    yellow_unresolved: float = 0.1
    yellow_completeness: float = 0.9


def run_ids(records: DataFrame) -> DataFrame:
    """The id each run log reports: first summary with an INSERT_METADATA step.

    ``records(log_name, ord, event, steps, corrupt)``. A broken line before that record, or an id
    that is not a number, leaves the run without id; such runs are dropped.
    """
    steps = F.filter("steps", lambda s: s["name"] == "INSERT_METADATA")
    hit = (F.col("event") == "SUMMARY") & (F.size(steps) > 0)
    per_log = records.groupBy("log_name").agg(
        F.min_by(F.get(steps, F.lit(0))["chrono_id"], F.when(hit, F.col("ord"))).alias("text"),
        F.min(F.when(hit, F.col("ord"))).alias("at"),
        F.min(F.when(F.col("corrupt").isNotNull(), F.col("ord"))).alias("broken_at"),
    )
    sound = F.col("broken_at").isNull() | (F.col("at") < F.col("broken_at"))
    return (
        per_log.where(sound)
        .select("log_name", F.col("text").try_cast("long").alias("chrono_id"))
        .where(F.col("chrono_id").isNotNull())
    )


def stored_ids(records: DataFrame) -> DataFrame:
    """The ids that a batch stored, one ``STORED`` record each."""
    steps = records.where(F.col("event") == "STORED").select("log_name", F.inline("steps"))
    ids = steps.where(F.col("name") == "INSERT_METADATA").select(
        "log_name", F.col("chrono_id").try_cast("long").alias("chrono_id")
    )
    return ids.where(F.col("chrono_id").isNotNull()).distinct()


METHOD_COUNTS = ["total", "n_rule", "n_resolver", "n_dict", "n_ok", "n_open"]
FACT_COUNTS = ["n_rows", "n_filled"]


def method_counts(log: DataFrame) -> DataFrame:
    """Entries by method, and open ones, per chronogram: counts of parts of a log add up."""
    method = F.col("methode")
    open_entry = F.coalesce(F.col("champ_standard"), F.lit("")) == ""
    return log.groupBy("id_chronogramme").agg(
        F.count("*").alias("total"),
        F.count_if(method == METHOD_RULE).alias("n_rule"),
        F.count_if(method == METHOD_RESOLVER).alias("n_resolver"),
        F.count_if(method == METHOD_DICT).alias("n_dict"),
        F.count_if(method == METHOD_OK).alias("n_ok"),
        F.count_if(open_entry).alias("n_open"),
    )


def fact_counts(facts: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Rows and filled cells of the counted columns per chronogram: counts of parts add up."""
    names = columns or COUNTED
    filled = sum((F.count(c) for c in names[1:]), F.count(names[0]))
    return facts.groupBy("id_chronogramme").agg(F.count("*").alias("n_rows"), filled.alias("n_filled"))


def summed(counts: DataFrame, names: list[str]) -> DataFrame:
    """Counts of several parts as one row per chronogram."""
    return counts.groupBy("id_chronogramme").agg(*[F.sum(c).alias(c) for c in names])


def method_rates(log: DataFrame) -> DataFrame:
    """Shares of the methods and of unresolved entries per chronogram."""
    return rates_of_counts(method_counts(log))


def rates_of_counts(counts: DataFrame) -> DataFrame:
    total = F.col("total")
    return counts.select(
        F.col("id_chronogramme").alias("chrono_id"),
        "total",
        rate(F.col("n_rule"), total).alias("auto_rate"),
        rate(F.col("n_resolver"), total).alias("ia_rate"),
        rate(F.col("n_dict"), total).alias("dict_rate"),
        rate(F.col("n_ok"), total).alias("ok_rate"),
        rate(F.col("n_open"), total).alias("unresolved_rate"),
    )


def completeness(facts: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Filled cells over all cells of the counted columns, per chronogram."""
    return completeness_of_counts(fact_counts(facts, columns), len(columns or COUNTED))


def completeness_of_counts(counts: DataFrame, n_columns: int = len(COUNTED)) -> DataFrame:
    cells = F.col("n_rows") * F.lit(n_columns)
    return counts.select(
        F.col("id_chronogramme").alias("chrono_id"),
        rate(F.col("n_filled"), cells).alias("completeness"),
    )


def alert(
    resolver: Column, unresolved: Column, complete: Column, limits: Thresholds = Thresholds()
) -> Column:
    red = (
        (resolver > limits.red_resolver)
        | (unresolved > limits.red_unresolved)
        | (complete < limits.red_completeness)
    )
    yellow = (
        (resolver > limits.yellow_resolver)
        | (unresolved > limits.yellow_unresolved)
        | (complete < limits.yellow_completeness)
    )
    return F.when(red, RED).when(yellow, YELLOW).otherwise("")


def kpi(
    runs: DataFrame, log: DataFrame, facts: DataFrame, limits: Thresholds = Thresholds()
) -> DataFrame:
    """One record per run log: two aggregations and two joins by id."""
    return kpi_of_counts(runs, method_counts(log), fact_counts(facts), limits)


def kpi_of_counts(
    runs: DataFrame, methods: DataFrame, filled: DataFrame, limits: Thresholds = Thresholds()
) -> DataFrame:
    """The same from counts that were kept with each batch: no log entry and no fact is read."""
    zero = F.lit(0.0)
    joined = runs.join(rates_of_counts(methods), "chrono_id", "left").join(
        completeness_of_counts(filled), "chrono_id", "left"
    )
    rates = ["auto_rate", "ia_rate", "unresolved_rate", "completeness"]
    filled = joined.select("log_name", "chrono_id", *[F.coalesce(r, zero).alias(r) for r in rates])
    sign = alert(F.col("ia_rate"), F.col("unresolved_rate"), F.col("completeness"), limits)
    return filled.withColumn("alert", sign)


def report_lines(table: DataFrame) -> DataFrame:
    """The markdown lines in log name order: ``(part, log_name, line)`` sorts to the report."""
    cells = [F.col("log_name"), F.col("chrono_id").cast("string")]
    for name in ["auto_rate", "ia_rate", "unresolved_rate", "completeness"]:
        cells.append(format_pct(F.col(name)))
    cells.append(F.col("alert"))
    line = F.concat(F.lit("| "), F.concat_ws(" | ", *cells), F.lit(" |"))
    body = table.select(F.lit(1).alias("part"), "log_name", line.alias("line"))
    head = table.sparkSession.createDataFrame(
        [(0, str(i), text) for i, text in enumerate(REPORT_HEAD)],
        "part int, log_name string, line string",
    )
    return head.unionByName(body)


def run_summary(steps: DataFrame) -> DataFrame:
    """Duration, number of steps and status per run from ``steps(run_id, ord, step, duration, error)``.

    A run has a handful of steps, so the list per run is bounded.
    """
    ordered = F.array_sort(F.collect_list(F.struct("ord", "step", "duration")))
    failed = F.bool_or(F.col("error").isNotNull())
    return steps.groupBy("run_id").agg(
        F.when(failed, "ECHEC").otherwise("SUCCES").alias("status"),
        F.sum("duration").alias("total_duration"),
        F.transform(ordered, lambda s: F.struct(s["step"].alias("name"), s["duration"])).alias("steps"),
    )


def batch_outcome(files: DataFrame, dimension: DataFrame) -> DataFrame:
    """Per input file its id and ``OK``, or ``ERROR``; one bad file does not stop the others."""
    loaded = dimension.groupBy(F.col("fichier_source").alias("file_name")).agg(
        F.max("id_chronogramme").alias("chrono_id")
    )
    status = F.when(F.col("chrono_id").isNotNull(), "OK").otherwise("ERROR")
    return (
        files.select("file_name")
        .join(loaded, "file_name", "left")
        .select("file_name", "chrono_id", status.alias("status"))
    )


def file_outcome(files: DataFrame, passed: DataFrame, refused: DataFrame) -> DataFrame:
    """Per ``files(file_id, file_name)`` its id and ``OK``, or ``ERROR`` with the reasons.

    A file is told by its id, whatever its name looks like once stored. A file has few reasons.
    """
    reasons = refused.groupBy("file_id").agg(
        F.array_join(F.array_sort(F.collect_set("reason")), "; ").alias("reason")
    )
    ids = passed.select("file_id", F.col("id_chronogramme").alias("chrono_id"))
    status = F.when(F.col("chrono_id").isNotNull(), "OK").otherwise("ERROR")
    joined = files.join(ids, "file_id", "left").join(reasons, "file_id", "left")
    return joined.select("file_id", "file_name", "chrono_id", status.alias("status"), "reason")
