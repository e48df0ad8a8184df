"""Folders of very many files: names go from task to task, the driver lists none."""

import pytest

from checks import catalog
from gridloom.sources import files
from gridloom.sources.files import read_folders


def test_files_below_folders(spark, tmp_path):
    for place, text in (("in/a.xlsx", "a"), ("in/deep/er/b.xlsx", "é"), ("out/c", ""), ("in/_no", "x"), ("in/.no", "x"),
                        ("in/_skipped/d", "x")):
        (tmp_path / place).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / place).write_text(text)
    # A folder's URI is as good as its path.
    found = read_folders(spark, [f"{tmp_path}/in", f"file:{tmp_path}/out/"]).collect()
    assert {r.path: bytes(r.content).decode() for r in found} == {
        f"{tmp_path}/in/a.xlsx": "a", f"{tmp_path}/in/deep/er/b.xlsx": "é", f"file:{tmp_path}/out/c": "",
    }
    # As Spark's own reader finds them.
    own = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(f"{tmp_path}/in")
    assert sorted(r.path.removeprefix("file:") for r in own.collect()) == sorted(
        r.path for r in found if r.path[0] == "/"
    )
    with pytest.raises(Exception, match="No such file"):
        read_folders(spark, [f"{tmp_path}/absent"]).collect()


def test_names_and_contents_come_in_parts(tmp_path, monkeypatch):
    import pandas as pd

    monkeypatch.setattr(files, "NAMES", 4)
    monkeypatch.setattr(files, "BYTES", 3)
    for i in range(10):
        (tmp_path / str(i)).write_text("ab")
    parts = list(files._names(iter([pd.DataFrame({"folder": [str(tmp_path)]})])))
    assert [len(p) for p in parts] == [4, 4, 2]
    assert [len(p) for p in files._contents(iter(parts))] == [2] * 5


def test_the_archive_is_read_by_tasks(spark, tmp_path):
    rows = [(k, f"Customer {k}") for k in range(1, 41)]
    customers = spark.createDataFrame(rows, "c_custkey long, c_name string")
    customers.write.parquet(f"{tmp_path}/customer.parquet")
    found = catalog.QUERIES["flow_archive"](spark, str(tmp_path))
    # Spark's own reader holds every file's status on the driver.
    assert "binaryFile" not in found._jdf.queryExecution().toString()
    assert found.inputFiles() == []
    moved = "c{}_{}_20240506_070809.xlsx"
    assert sorted(tuple(r) for r in found.collect()) == sorted(
        (f"c{k}.xlsx", "inbox", n) if k % 10 == 0 else (moved.format(k, k + 1), "archive", n) for k, n in rows
    )
