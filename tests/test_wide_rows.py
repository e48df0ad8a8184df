"""Rows stay rows between the grid and the dictionary; large tables of sheets move no cells for their choice."""

import pytest
from pyspark.sql import functions as F

from checks import q_flow
from gridloom.operators import clean as C
from gridloom.operators import headers as H
from gridloom.operators import structure as S
from gridloom.operators import values as V
from gridloom.plans.intake import Options
from test_clean import odd_cells

FIELDS = ["a", "b", "c", "d"]


@pytest.mark.parametrize("seed, order", [(1, "reference"), (2, "clean_first"), (5, "reference")])
def test_wide_rows_equal_cells_that_become_rows_again(spark, rows, seed, order):
    cells, ranges = odd_cells(spark, seed)
    # A place of another text beside the one that is there.
    cells = cells.unionByName(cells.where("sheet_idx = 0 AND row_idx = 4").withColumn("value", F.lit("zz")))
    filled = C.filled_rows(cells, ranges, order, width=4).localCheckpoint()
    kept = filled.select(*C.ROW, F.inline("cells")).where("value IS NOT NULL AND col_idx != 3").select(*C.COLUMN).distinct()
    # The second column feeds two fields in one sheet, the fourth none, and "c" has none.
    told = spark.createDataFrame(
        [(0, "a", 2), (0, "b", 2), (1, "a", 1), (2, "d", 1), (2, "b", 2), (3, "d", 2)], "sheet_idx long, field string, col_idx long"
    )
    picked = kept.join(told, ["sheet_idx", "col_idx"]).select(*C.SHEET, "field", "col_idx")
    long = C.with_columns(filled, kept.join(picked, C.COLUMN, "left"), kept).select(*C.ROW, F.inline("shown"))
    want = H.to_wide(long, C.ROW, FIELDS, ("has_", ["a", "c"]))
    found = C.wide_rows(filled, picked, kept, FIELDS, ("has_", ["a", "c"]), [])
    assert found.columns == want.columns and rows(found) == rows(want) and found.count() > 5
    # With all values of a field the greatest one is the last.
    listed = C.wide_rows(filled, picked, kept, FIELDS, ("has_", ["a", "c"]), ["a", "c"])
    last = listed.withColumns({f: F.try_element_at(f, F.lit(-1)) for f in ("a", "c")})
    assert rows(last) == rows(want)
    if order == "reference":
        assert listed.where("size(a) > 1").count() > 0


def test_rows_meet_the_dictionary_as_they_are(spark, rows):
    """Several values of a place, none at all, and two fields: what the cells one by one become."""
    held = [(1, ["x"], [], "r"), (2, [], ["y"], None), (3, ["x", "zz"], ["y"], "s"), (4, [], [], "t"), (5, ["q"], ["q"], "u")]
    arrays = spark.createDataFrame(held, "row_idx long, a array<string>, b array<string>, c string")
    entries = spark.createDataFrame(
        [("a", "x", "zzz", 0), ("b", "y", "Y", 0), ("a", "y", "no", 0), ("b", "x", "no", 0), ("a", "q", "", 0)],
        "field string, raw string, standard string, line_no long",
    )
    for unique in (False, True):
        done = V.standardize_texts(arrays, entries, ["a", "b"], ["row_idx"], unique)
        assert rows(done) == [(1, "zzz", None, "r"), (2, None, "Y", None), (3, "zzz", "Y", "s"), (4, None, None, "t"),
                              (5, "q", "q", "u")]
    assert V.standardize_texts(arrays, entries, [], ["row_idx"]) is arrays
    values = spark.createDataFrame([("f", 1, "a", "x")], "file_id string, row_idx long, field string, value string")
    assert V.standardize_exact(values, entries, fields=[]) is values
    # Unique keys need no aggregation of the dictionary.
    plan = V._entries(entries, F.col("raw"), "key", True)._jdf.queryExecution().executedPlan().toString()
    assert "Aggregate" not in plan and "Exchange" not in plan


@pytest.fixture
def documents(spark, tmp_path):
    """Workbooks of four sheets, the fullest of which is the main one; two texts of one document in the last."""
    table = "type,b b,cc c,dddd\nx,1,,p\n,2,y,\ntotal,,,\nphase 1,,,\nu,,w,\n\n\nlate,l,l,l"
    texts = [table if k % 4 == 2 else f"a{k},b,c\n1,2,3" for k in range(12)] + [table.replace("x,1", "other,7")]
    frame = [(min(k, 10) if k == 12 else k, t, "fr", f"s{k % 3}") for k, t in enumerate(texts)]
    docs = spark.createDataFrame(frame, "doc_id long, text string, lang string, source string")
    docs.coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    return str(tmp_path)


@pytest.mark.parametrize("trim", [False, True])
def test_more_main_sheets_than_go_to_every_task(spark, rows, documents, monkeypatch, trim):
    def stored():
        return rows(q_flow._plan(spark, documents, Options(trim_bottom=trim)).rows)

    want = stored()
    assert len(want) > 3
    monkeypatch.setattr(S, "MAIN_SHEETS", 0)
    assert stored() == want
    cells, main = spark.range(9).selectExpr("'f' AS file_id", "id AS sheet_idx"), spark.range(3).selectExpr("'f' AS file_id", "id AS sheet_idx")
    # All cells were moved for this choice before.
    assert S.near_main(cells, main) is cells
    monkeypatch.setattr(S, "MAIN_SHEETS", 10)
    assert S.near_main(cells, main).count() == 3


def test_filling_down_takes_the_order_of_the_grid(spark):
    """One sort by column for the dense grid and for filling down; there were two."""
    cells, ranges = odd_cells(spark, 4)
    plan = C.filled_rows(cells, ranges.where("last_row < 20"))._jdf.queryExecution().executedPlan().toString()
    initial = plan.split("Initial Plan")[-1]
    assert initial.count("Sort [") == 2
