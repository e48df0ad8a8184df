"""Dictionaries and the target schema from CSV, YAML and JSON files.

CSV columns are taken by position. ``line_no`` orders the entries by file, block and line, whatever
order the blocks are read in.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.functions.text import normalize
from gridloom.model import TargetSchema
from gridloom.operators.lookup import latest_per_key
from gridloom.sources.paths import exists, is_empty_file

_ORDER = "struct<path:string,block:bigint,line:bigint>"


def _read_csv(spark, path: str, columns: list[str], header: bool) -> DataFrame:
    schema = ", ".join(f"{c} string" for c in columns)
    if not exists(spark, path) or is_empty_file(spark, path):
        return spark.createDataFrame([], f"{schema}, line_no {_ORDER}")

    def read(encoding: str) -> DataFrame:
        # Header texts may hold line breaks, hence multiLine.
        reader = spark.read.schema(schema).options(
            header=header, multiLine=True, escape='"', encoding=encoding
        )
        order = F.struct(
            F.col("_metadata.file_path").alias("path"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("line"),
        )
        return reader.csv(path).select(*columns, order.cast(_ORDER).alias("line_no"))

    table = read("UTF-8")

    def marks(rows: DataFrame, mark: str) -> DataFrame:
        n = F.regexp_count(F.concat_ws("", *columns), F.lit(mark))
        return rows.groupBy("line_no.path").agg(F.sum(n).alias("n"))

    # Bytes that are no UTF-8 come back as replacement characters: such files are read as Latin-1. One that
    # stands in the file itself shows there as the Latin-1 reading of its three bytes, and is no such byte.
    suspects = marks(table, "�").where("n > 0")
    if suspects.isEmpty():
        return table
    own = marks(read("ISO-8859-1"), "ï¿½").withColumnRenamed("n", "own")
    others = suspects.join(own, "path").where("n > own").select("path")
    if others.isEmpty():
        return table

    def of(rows: DataFrame, how: str) -> DataFrame:
        placed = rows.withColumn("path", F.col("line_no.path"))
        return placed.join(others, "path", how).drop("path")

    return of(table, "left_anti").unionByName(of(read("ISO-8859-1"), "left_semi"))


def header_dictionary(spark: SparkSession, path: str) -> DataFrame:
    """``(raw, standard, line_no)`` with the texts as they stand."""
    return _read_csv(spark, path, ["raw", "standard"], header=True)


def header_dictionary_by_norm(spark: SparkSession, path: str) -> DataFrame:
    """``(norm, standard)``: normalized keys, the last duplicate wins."""
    table = header_dictionary(spark, path)
    keyed = table.select(normalize(F.col("raw")).alias("norm"), "standard", "line_no")
    return latest_per_key(keyed, ["norm"])


def header_dictionary_all_norm(spark: SparkSession, path: str) -> DataFrame:
    """``(norm, standard)`` with keys and standards normalized."""
    table = header_dictionary_by_norm(spark, path)
    return table.withColumn("standard", normalize(F.col("standard")))


def value_dictionary(spark: SparkSession, path: str) -> DataFrame:
    """``(field, raw, standard, line_no)``; a missing file is an empty dictionary."""
    return _read_csv(spark, path, ["field", "raw", "standard"], header=True)


def pair_dictionary(spark: SparkSession, path: str) -> DataFrame:
    """``(raw, standard)`` from a file without header; lines with one column give nothing."""
    table = _read_csv(spark, path, ["raw", "standard"], header=False)
    return latest_per_key(table.where(F.col("standard").isNotNull()), ["raw"])


def _entries(maps: DataFrame) -> DataFrame:
    """``m map<field, map<raw, standard>>`` to one row per entry."""
    return (
        maps.select(F.explode("m").alias("field", "entries"))
        .select("field", F.posexplode("entries").alias("line_no", "raw", "standard"))
        .select("field", "raw", "standard", F.col("line_no").cast("long").alias("line_no"))
    )


def value_dictionary_json(spark: SparkSession, path: str) -> DataFrame:
    """Nested ``{field: {raw: standard}}`` from JSON, one object per line."""
    text = spark.read.text(path)
    nested = F.from_json("value", "map<string,map<string,string>>")
    return _entries(text.select(nested.alias("m")))


def _load_yaml(spark: SparkSession, path: str):
    try:
        import yaml
    except ImportError as error:
        raise ImportError("PyYAML is needed for YAML files; JSON works without it") from error
    if not exists(spark, path):
        return {}
    # A hand-edited settings file; it configures the plan, so the driver has to read it.
    return yaml.safe_load(spark.read.text(path, wholetext=True).first().value) or {}


def value_dictionary_yaml(spark: SparkSession, path: str) -> DataFrame:
    """Nested ``field: {raw: standard}`` from YAML."""
    data = _load_yaml(spark, path)
    nested = {str(f): {str(k): str(v) for k, v in (m or {}).items()} for f, m in data.items()}
    return _entries(spark.createDataFrame([(nested,)], "m map<string,map<string,string>>"))


def target_schema(spark: SparkSession, path: str) -> TargetSchema:
    """Field names, required fields and closed lists from the schema file."""
    fields = [f for f in _load_yaml(spark, path).get("fields", []) if f.get("name")]
    return TargetSchema(
        fields=[str(f["name"]) for f in fields],
        required=[str(f["name"]) for f in fields if f.get("required")],
        allowed={str(f["name"]): [str(v) for v in f["values"]] for f in fields if f.get("values")},
    )
