"""Session settings and lineage cutting."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}
#: How scratch tables and what is kept for later batches are compressed.
PACKED = "zstd"


def build_session(app: str = "gridloom", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def _named_dir(spark: SparkSession) -> str | None:
    return spark.conf.get("spark.checkpoint.dir", None)


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder; a private one only where none is named (tests)."""
    context = spark.sparkContext
    named = _named_dir(spark)
    if named:
        return named.rstrip("/")
    if context.getCheckpointDir() is None:
        if not context.master.startswith("local"):
            raise ValueError("name a shared folder in spark.checkpoint.dir")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="gridloom-"))
    # Spark puts a folder of its own below the one it was given.
    return context.getCheckpointDir().rsplit("/", 1)[0]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder."""
    return f"{shared_dir(spark)}/gridloom/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame, name: str = "table") -> DataFrame:
    """Write ``df`` once as a table in the shared folder and go on from there.

    Later plans read the same rows again, whatever executors are lost, and know the table's size. It is read
    a few times at most, so it is packed more closely than by Spark's default. The folder's clean-up is the cluster's.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", PACKED).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
