"""File system checks through Hadoop, so that any cluster store works."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()), jvm_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = _fs(spark, path)
    return fs.exists(target)


def is_empty_file(spark: SparkSession, path: str) -> bool:
    fs, target = _fs(spark, path)
    status = fs.getFileStatus(target)
    return status.isFile() and status.getLen() == 0


def make_dir(spark: SparkSession, path: str) -> None:
    fs, target = _fs(spark, path)
    fs.mkdirs(target)


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names directly under a folder; empty if it does not exist."""
    fs, target = _fs(spark, path)
    if not fs.exists(target):
        return []
    return [status.getPath().getName() for status in fs.listStatus(target)]


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of the engine's own, if it is there."""
    fs, target = _fs(spark, path)
    fs.delete(target, True)


def file_system(uri: str):
    """The file system of a URI or plain path, and the path in it; for tasks, which have no session."""
    from pyarrow import fs

    if uri.startswith("file:/"):
        uri = uri.removeprefix("file:")
        uri = "/" + uri.lstrip("/")
    if "://" in uri:
        return fs.FileSystem.from_uri(uri)
    return fs.LocalFileSystem(), uri
