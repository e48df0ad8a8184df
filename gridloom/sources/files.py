"""Input files as ``files(path, modificationTime, length)``."""

from __future__ import annotations

import os
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.operators.metadata import file_name
from gridloom.sources.paths import file_system

#: Names that go on at once from the task that lists a folder; files and bytes that a task holds when it reads.
NAMES, FILES, BYTES = 10_000, 1_000, 16 * 1024 * 1024


def scan_workbooks(spark: SparkSession, folder: str) -> DataFrame:
    """Every workbook of a folder, with its content."""
    return spark.read.format("binaryFile").option("pathGlobFilter", "*.xlsx").load(folder)


def _below(folder: str) -> Iterator[str]:
    """Files below a folder as paths from there. Names that begin with ``_`` or ``.`` are passed over, as Spark does.

    A local folder is read name by name; of other file systems one folder's list is held at a time.
    """
    from pyarrow import fs

    system, top = file_system(folder)
    local, waiting = isinstance(system, fs.LocalFileSystem), [""]
    while waiting:
        inside = waiting.pop()
        place = f"{top}/{inside}".rstrip("/")
        if local:
            with os.scandir(place) as found:
                named = ((entry.name, entry.is_dir()) for entry in found)
                yield from _files_of(named, inside, waiting)
        else:
            found = system.get_file_info(fs.FileSelector(place))
            yield from _files_of(((i.base_name, i.type == fs.FileType.Directory) for i in found), inside, waiting)


def _files_of(named: Iterator[tuple[str, bool]], inside: str, waiting: list[str]) -> Iterator[str]:
    for name, is_folder in named:
        if name[0] in "_.":
            continue
        if is_folder:
            waiting.append(f"{inside}{name}/")
        else:
            yield inside + name


def _names(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    paths = []
    for batch in batches:
        for folder in batch["folder"]:
            for name in _below(folder):
                paths.append(f"{folder.rstrip('/')}/{name}")
                if len(paths) >= NAMES:
                    yield pd.DataFrame({"path": paths})
                    paths = []
    if paths:
        yield pd.DataFrame({"path": paths})


def _contents(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    paths, texts, held = [], [], 0
    for batch in batches:
        for path in batch["path"]:
            system, place = file_system(path)
            with system.open_input_stream(place) as source:
                texts.append(source.read())
            paths.append(path)
            held += len(texts[-1])
            if len(paths) >= FILES or held >= BYTES:
                yield pd.DataFrame({"path": paths, "content": texts})
                paths, texts, held = [], [], 0
    if paths:
        yield pd.DataFrame({"path": paths, "content": texts})


def read_folders(spark: SparkSession, folders: list[str]) -> DataFrame:
    """``(path, content)`` of every file below some folders, for folders of very many small files.

    Spark's own reader lists them on the driver and plans a part for every few; here a task lists a folder, and its
    names go to as many tasks as shuffles have, so the driver sees none.
    """
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    named = spark.createDataFrame([(f,) for f in folders], "folder string").repartition(len(folders), "folder")
    paths = named.mapInPandas(_names, "path string").repartition(tasks, "path")
    return paths.mapInPandas(_contents, "path string, content binary")


def list_files(files: DataFrame) -> DataFrame:
    """All workbooks in name order; the content is never read."""
    return (
        files.where(F.endswith("path", F.lit(".xlsx")))
        .select("path", file_name(F.col("path")).alias("file_name"), "modificationTime")
        .orderBy("path")
    )


def latest_file(files: DataFrame) -> DataFrame:
    """The workbook changed last: a top-1, without a full sort."""
    found = files.where(F.endswith("path", F.lit(".xlsx")))
    return (
        found.select("path", "modificationTime")
        .orderBy(F.desc("modificationTime"), "path")
        .limit(1)
    )


def require_latest(files: DataFrame) -> str:
    row = latest_file(files).first()
    if row is None:
        raise FileNotFoundError("no workbook found")
    return row.path
