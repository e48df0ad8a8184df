"""Run logs and submissions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.model import RUN_RECORD, SUBMISSION
from gridloom.operators.metadata import file_name


def parse_run_lines(lines: DataFrame) -> DataFrame:
    """JSON lines ``(log_name, ord, line)`` to records; ``corrupt`` holds a line that is no JSON."""
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "corrupt"}
    record = F.from_json("line", RUN_RECORD, options)
    return lines.select("log_name", "ord", record.alias("r")).select("log_name", "ord", "r.*")


def run_lines(spark: SparkSession, folder: str, pattern: str = "run_*.log") -> DataFrame:
    """Lines of the run logs, files or folders of part files; ``ord`` follows the lines."""
    read = spark.read.text(f"{folder}/{pattern}")
    order = F.struct(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"),
    )
    return read.select(
        F.regexp_extract(F.col("_metadata.file_path"), r"(run_[^/]*\.log)", 1).alias("log_name"),
        order.alias("ord"),
        F.col("value").alias("line"),
    )


def run_records(spark: SparkSession, folder: str, pattern: str = "run_*.log") -> DataFrame:
    return parse_run_lines(run_lines(spark, folder, pattern))


def steps_of(records: DataFrame) -> DataFrame:
    """One row per step of every summary."""
    exploded = records.where(F.col("event") == "SUMMARY").select(
        F.col("log_name").alias("run_id"), F.posexplode("steps").alias("ord", "s")
    )
    return exploded.select(
        "run_id",
        F.col("ord").cast("long").alias("ord"),
        F.col("s.name").alias("step"),
        F.col("s.duration").alias("duration"),
        F.col("s.error").alias("error"),
    )


def submissions_from_json(spark: SparkSession, path: str) -> DataFrame:
    """One record per JSON file (or per element of a JSON array)."""
    read = spark.read.schema(SUBMISSION).option("multiLine", True).json(path)
    return read.withColumn("source_name", file_name(F.col("_metadata.file_path")))


def submissions_from_text(texts: DataFrame) -> DataFrame:
    """Records given as JSON text in a column ``meta``, next to their ``file_id``."""
    record = F.from_json("meta", SUBMISSION)
    return texts.select("file_id", record.alias("r")).select("file_id", "r.*")
