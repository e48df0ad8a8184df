"""Versioned parquet tables: a new version is a new folder, valid once Spark has committed it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from gridloom.session import PACKED
from gridloom.sources.paths import child_names, exists


class SnapshotTable:
    """``<path>/v=<n>``; readers take the highest committed version. One writer at a time."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema

    def version(self) -> int:
        numbers = [n[2:] for n in child_names(self.spark, self.path) if n.startswith("v=")]
        done = [int(n) for n in numbers if exists(self.spark, f"{self.path}/v={n}/_SUCCESS")]
        return max(done, default=0)

    def read(self) -> DataFrame:
        version = self.version()
        if not version:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(f"{self.path}/v={version}")

    def write(self, df: DataFrame, version: int | None = None) -> int:
        """Write all rows as the next (or the given) version; a rerun replaces its own version."""
        number = version or self.version() + 1
        rows = df.select(*self.schema.names).write.mode("overwrite").option("compression", PACKED)
        rows.parquet(f"{self.path}/v={number}")
        return number
