import random

import pytest
from pyspark.sql import functions as F

from conftest import grid_of, table_of
from gridloom.operators import clean as C
from gridloom.operators import structure as S


def test_clean_table_drops_summary_blank_and_empty(spark):
    table = [
        ["H1", "H2", "Empty"], ["val1", "val2", ""], ["TOTAL", "", ""], ["phase 1", "", ""],
        [None, None, None],
    ]
    # Blank texts are no nulls, so filling leaves them; the null row becomes a copy of the row above.
    assert table_of(C.clean_table(grid_of(spark, table))) == [["H1", "H2"], ["val1", "val2"]]


def test_single_row_is_filled_to_the_right(spark):
    assert table_of(C.fill_right(grid_of(spark, [["val1", None]]))) == [["val1", "val1"]]
    wide = spark.createDataFrame([("val1", None)], "A string, B string")
    assert tuple(C.fill_right_wide(wide, ["A", "B"]).first()) == ("val1", "val1")


def test_fill_order_decides_what_stays(spark):
    table = [["a", "b"], ["1", "2"], [None, None], ["TOTAL", None], ["3", "4"]]
    kept = table_of(C.clean_table(grid_of(spark, table)))
    assert kept == [["a", "b"], ["1", "2"], ["1", "2"], ["TOTAL", "2"], ["3", "4"]]
    first = table_of(C.clean_table(grid_of(spark, table), order="clean_first"))
    assert first == [["a", "b"], ["1", "2"], ["3", "4"]]


def test_column_with_a_value_only_in_the_first_row(spark):
    grid = grid_of(spark, [["a", "b"], ["c", ""]])
    assert table_of(C.drop_empty_cols(grid)) == [["a"], ["c"]]
    assert table_of(C.drop_empty_cols(grid, skip_first=False)) == [["a", "b"], ["c", None]]
    assert table_of(C.drop_empty_cols(grid_of(spark, [["a", ""]]))) == [["a"]]


def test_summary_rows_need_to_be_alone(spark):
    table = [["Total", "x"], [" TOTALEMENT vide", ""], ["Phase 2", None], ["x", ""], ["", ""]]
    assert table_of(C.drop_parasitic_rows(grid_of(spark, table))) == [["Total", "x"], ["x", ""], ["", ""]]
    wide = spark.createDataFrame(table, "a string, b string")
    assert [tuple(r) for r in C.drop_parasitic_rows_wide(wide, ["a", "b"]).collect()] == [
        ("Total", "x"), ("x", ""), ("", ""),
    ]


def test_files_do_not_mix(spark):
    grid = grid_of(spark, [["a", None], [None, None]], "f").unionByName(
        grid_of(spark, [[None, "z"], [None, None]], "g")
    )
    filled = C.fill_down(grid, width=1)
    assert table_of(filled.where("file_id = 'g'")) == [[None, "z"], [None, "z"]]


def test_kept_and_dropped_rows_make_the_whole(spark):
    table = [["a", ""], ["total", ""], ["", ""], ["phase", None], ["b", "c"]]
    grid = C.blank_to_null(grid_of(spark, table))
    kept = C.drop_parasitic_rows(grid)
    gone = grid.exceptAll(kept).select("row_idx").distinct().collect()
    assert sorted(r.row_idx for r in gone) == [2, 4]


def test_carry_phase_keeps_the_text_on_the_rows_below(spark):
    rows = [("f", 1, "x"), ("f", 2, "Phase 1"), ("f", 3, "y"), ("f", 4, "z"), ("g", 5, "w")]
    frame = spark.createDataFrame(rows, "f string, o long, t string")
    kept = C.carry_phase(frame, ["f"], "o", "t", width=2).orderBy("o").collect()
    assert [(r.t, r.phase_exercice) for r in kept] == [
        ("x", None), ("y", "Phase 1"), ("z", "Phase 1"), ("w", None),
    ]
    dropped = C.carry_phase(frame, ["f"], "o", "t", keep=False).collect()
    assert all(r.phase_exercice is None for r in dropped) and len(dropped) == 4


def odd_cells(spark, seed):
    """Sheets with gaps, blanks, phase and summary rows; one place is written twice, some lie outside."""
    rng = random.Random(seed)
    texts = ["a", "b", " ", "Phase 1", " total x", "c"]
    rows, ranges = [], []
    for sheet, (height, first, last) in enumerate([(23, 2, 4), (3, 1, 1), (9, 1, 3), (1, 1, 2)]):
        places = [(r, c) for r in range(1, height + 3) for c in range(1, last + 2) if rng.random() < 0.35]
        rows += [("f", sheet, r, c, rng.choice(texts)) for r, c in places]
        ranges.append(("f", sheet, 1, first, last, height))
    rows.append(next(r for r in rows if r[1] == 0 and r[2] > 1 and 2 <= r[3] <= 4))
    cells = spark.createDataFrame(rows, "file_id string, sheet_idx long, row_idx long, col_idx long, value string")
    kind = "file_id string, sheet_idx long, header_row long, first_col long, last_col long, last_row long"
    return cells, spark.createDataFrame(ranges, kind)


@pytest.mark.parametrize("seed, order, phased", [(1, "reference", False), (2, "clean_first", True), (3, "reference", True)])
def test_filled_rows_equal_the_steps_one_by_one(spark, rows, seed, order, phased):
    cells, ranges = odd_cells(spark, seed)
    grid = S.dense_grid(cells, ranges, ["c"])
    if phased:
        phases = C.lone_phases(grid)
        assert rows(C.phase_rows(cells, ranges, ["c"], 4)) == rows(phases)
        grid = grid.join(phases.select(*C.ROW), C.ROW, "left_anti")
    if order == "clean_first":
        grid = C.drop_parasitic_rows(C.drop_empty_rows(grid))
    want = C.drop_empty_rows(C.fill_right(C.fill_down(grid)))
    found = C.filled_rows(cells, ranges, order, phased, ["c"], width=4)
    each = found.select(*C.ROW, F.inline("cells"))
    assert rows(each) == rows(want, *each.columns)
    # The columns with their fields, one of them for two fields, and rows that only summarize.
    columns = want.select(*C.COLUMN).distinct().where("col_idx != 3")
    told = columns.withColumn("field", F.concat(F.lit("x"), F.col("col_idx").cast("string")))
    told = told.unionByName(columns.where("col_idx = 2").withColumn("field", F.lit("y")))
    shown = C.with_columns(found, told, columns).select(*C.ROW, F.inline("shown"))
    plain = C.drop_parasitic_rows(want.join(told, C.COLUMN))
    assert rows(shown) == rows(plain, *shown.columns)


def test_filling_a_grid_shuffles_it_once(spark):
    cells, ranges = odd_cells(spark, 4)
    low = ranges.where("last_row < 20")
    plan = C.filled_rows(cells, low, tokens=["c"])._jdf.queryExecution().executedPlan().toString()
    initial = plan.split("Initial Plan")[-1]
    # The marks of the blocks, then cells and marks together.
    assert initial.count("Exchange hashpartitioning") <= 2
    assert "SortMergeJoin" not in initial


@pytest.mark.parametrize("order", ["reference", "clean_first"])
def test_header_and_phase_rows_come_with_the_grid(spark, rows, order):
    """One shuffle of the cells gives all three; "c" counts as empty below the header, not in it."""
    cells, ranges = odd_cells(spark, 3)
    more = [("f", 4, 5, c, t) for c, t in ((1, "c"), (1, "b"), (2, " x "), (4, "out"))]
    more += [("f", 4, 6, 1, "c"), ("f", 4, 6, 1, "a"), ("f", 4, 7, 3, "Phase 2")]
    cells = cells.unionByName(spark.createDataFrame(more, cells.schema))
    ranges = ranges.unionByName(spark.createDataFrame([("f", 4, 5, 1, 3, 7)], ranges.schema))
    grid = C.grid_rows(cells, ranges, order, True, ["c"], width=3)
    heads = S.header_cells(cells, ranges.where("last_row > header_row"))
    assert rows(C.heads_of(grid)) == rows(heads) and heads.where("raw_header = 'c'").count() >= 1
    assert rows(C.phases_of(grid)) == rows(C.phase_rows(cells, ranges, ["c"], 3))
    low = C.grid_rows(cells, ranges.where("last_row < 20"), order, True, ["c"])
    initial = low._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]
    assert initial.count("Exchange hashpartitioning") <= 2 and "Join" not in initial
