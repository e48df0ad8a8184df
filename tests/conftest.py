import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from gridloom.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests", "local[8]", **{"spark.sql.shuffle.partitions": "4", "spark.driver.memory": "4g"}
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def rows():
    """Sorted rows of a frame as tuples, for chosen columns."""

    def collect(df, *columns):
        picked = df.select(*columns) if columns else df
        found = [tuple(r) for r in picked.collect()]
        return sorted(found, key=lambda r: tuple((v is not None, str(v)) for v in r))

    return collect


def grid_of(spark, table, file_id="f"):
    """A dense grid from a list of rows."""
    cells = [
        (file_id, 1, r, c, value)
        for r, row in enumerate(table, 1)
        for c, value in enumerate(row, 1)
    ]
    return spark.createDataFrame(
        cells, "file_id string, sheet_idx long, row_idx long, col_idx long, value string"
    )


def table_of(grid):
    """A grid back to a list of rows."""
    found = {}
    for r in grid.collect():
        found.setdefault(r.row_idx, {})[r.col_idx] = r.value
    return [[row[c] for c in sorted(row)] for _, row in sorted(found.items())]


def cells_of(spark, sheets):
    """Cells and sheets from ``{(file, index, name): rows}``; empty texts give no cell."""
    cells, shapes = [], []
    for (file_id, index, name), table in sheets.items():
        shapes.append((file_id, index, name, len(table), max([len(r) for r in table], default=0)))
        for r, row in enumerate(table, 1):
            for c, value in enumerate(row, 1):
                if value not in (None, ""):
                    cells.append((file_id, index, name, r, c, value, "s"))
    return (
        spark.createDataFrame(
            cells,
            "file_id string, sheet_idx long, sheet_name string, row_idx long, col_idx long, "
            "value string, value_type string",
        ),
        spark.createDataFrame(
            shapes, "file_id string, sheet_idx long, sheet_name string, max_row long, max_col long"
        ),
    )
