"""The indicator job over run logs, mapping log and facts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gridloom.operators.kpi import Thresholds, kpi_of_counts, run_ids, stored_ids
from gridloom.sinks.report import write_report
from gridloom.sinks.store import Store
from gridloom.sources.records import run_records


def monitor(
    spark: SparkSession,
    store: Store,
    log_folder: str,
    report_path: str | None = None,
    limits: Thresholds = Thresholds(),
) -> DataFrame:
    """One record per run log and id in name order; written as a report if a path is given.

    The counts were added up batch by batch as they were stored; history is not read again.
    """
    records = run_records(spark, log_folder)
    runs = run_ids(records).unionByName(stored_ids(records))
    table = kpi_of_counts(runs, store.method_counts(), store.fact_counts(), limits)
    if report_path:
        write_report(table, report_path)
    return table.orderBy("log_name", "chrono_id")
