from conftest import cells_of
from gridloom.operators import structure as S


def main_of(spark, sheets, **options):
    cells, shapes = cells_of(spark, sheets)
    return S.main_sheet(S.sheet_stats(cells, shapes), **options).collect()


def test_titled_sheet_wins_over_a_fuller_one(spark):
    sheets = {
        ("f", 1, "Notes"): [["a", "b", "c"], ["d", "e", "f"]],
        ("f", 2, "CHRONOGRAMME 1"): [["x"]],
    }
    assert [(r.sheet_idx, r.tie) for r in main_of(spark, sheets)] == [(2, False)]
    assert [r.sheet_idx for r in main_of(spark, sheets, use_keywords=False)] == [1]


def test_keyword_in_the_corner_only(spark):
    far = [[""] * 6 for _ in range(6)]
    far[5][5] = "exercice"
    near = [["", "Fiche Exercice : XY"]]
    sheets = {("f", 1, "A"): [*far, ["p", "q", "r"]], ("f", 2, "B"): near}
    assert main_of(spark, sheets)[0].sheet_idx == 2


def test_number_cells_give_no_keyword(spark):
    cells, shapes = cells_of(spark, {("f", 1, "A"): [["exercice"]]})
    from pyspark.sql import functions as F

    numbers = cells.withColumn("value_type", F.lit("n"))
    assert not S.sheet_stats(numbers, shapes).first().has_keyword


def test_fullest_sheet_and_ties(spark):
    same = [["a", "b"], ["c", "d"]]
    sheets = {
        ("f", 1, "A"): [["a"]], ("f", 2, "B"): same, ("f", 3, "C"): [["a", "b"]],
        ("g", 1, "A"): same, ("g", 2, "A copy"): same,
    }
    found = {r.file_id: (r.sheet_idx, r.tie) for r in main_of(spark, sheets)}
    assert found == {"f": (2, False), "g": (1, True)}


def test_tie_choice_by_name(spark):
    same = [["a", "b"]]
    cells, shapes = cells_of(spark, {("g", 1, "A"): same, ("g", 2, "Plan"): same, ("h", 1, "A"): same})
    stats = S.sheet_stats(cells, shapes)
    main = S.main_sheet(stats)
    tied = S.tied_sheets(stats, main)
    assert sorted((r.file_id, r.sheet_idx) for r in tied.collect()) == [("g", 1), ("g", 2)]
    for wanted, index in [("PLAN", 2), ("nothing", 1)]:
        choice = spark.createDataFrame([("g", wanted)], "file_id string, sheet_name string")
        chosen = {r.file_id: r.sheet_idx for r in S.apply_tie_choice(main, tied, choice).collect()}
        assert chosen == {"g": index, "h": 1}


def test_empty_workbook_keeps_its_first_sheet(spark):
    found = main_of(spark, {("f", 1, "A"): [], ("f", 2, "B"): []})
    assert [(r.sheet_idx, r.n_cells) for r in found] == [(1, 0)]


def test_header_row_and_columns(spark):
    sheets = {
        ("f", 1, "A"): [["title"], [], ["", "Heure", "", "Contenu", "Canal"], ["", "T0", "x", "y", "z"]],
        ("g", 1, "A"): [["a", "b"], ["c"]],
    }
    cells, shapes = cells_of(spark, sheets)
    ranges = S.header_row_by_fill(cells)
    assert [tuple(r) for r in ranges.collect()] == [("f", 1, 3, 2, 5)]
    assert [r.file_id for r in S.without_header(shapes, ranges).collect()] == ["g"]
    texts = S.header_list(S.header_cells(cells, ranges)).first().headers
    assert texts == ["Heure", "Contenu", "Canal"]


def test_header_row_by_keyword_counts_words_not_cells(spark):
    sheets = {
        ("f", 1, "A"): [["Émetteur", "emetteur"], ["type et nature", ""], ["Modalité", "Type"]],
        ("g", 1, "A"): [["x"], ["y"]],
    }
    cells, shapes = cells_of(spark, sheets)
    found = {r.file_id: (r.header_row, r.found) for r in S.header_row_by_keyword(cells, shapes).collect()}
    assert found == {"f": (2, True), "g": (1, False)}


FLOOD = [
    ["", "Crue du canal"],
    ["révisé en mars", ""],
    ["", ""],
    ["Heure", "Descriptif", "Canal"],
    ["8 h", "La digue cède", "radio"],
    ["9 h", "Le pont est fermé", "affiche"],
    ["10 h", "Retour au calme", "radio"],
    ["", "", ""],
    ["", "", ""],
]


def test_known_names_and_last_row(spark):
    cells, shapes = cells_of(spark, {("f", 1, "A"): [*FLOOD, ["signature"]]})
    heads = S.header_row_by_name(cells, shapes)
    assert heads.first().header_row == 4
    assert S.last_data_row(cells, heads, width=2).first().last_row == 7


def test_last_row_cases(spark):
    def last(table, header=1, **options):
        cells, shapes = cells_of(spark, {("f", 1, "A"): table})
        heads = shapes.selectExpr("file_id", "sheet_idx", f"{header}L AS header_row")
        return S.last_data_row(cells, heads, **options).first().last_row

    assert last([["h"], ["a"], [""], ["b"]]) == 4  # a single blank row is no end
    assert last([["h"], ["a"], [""], ["  "], ["b"]]) == 2  # white space counts as blank
    assert last([["h"], [""], [""], ["b"]]) == 1  # nothing before the run
    assert last([["h"]]) == 1
    assert last([["t"], [""], [""], ["h"], ["a"]], header=4) == 5  # gaps above do not count


def test_dense_grid_in_small_steps(spark):
    table = [["h1", "h2", "h3"], ["a", "", "c"], ["", "", ""], ["", "N/A", "x"]]
    cells, shapes = cells_of(spark, {("f", 1, "A"): table})
    ranges = S.header_row_by_fill(cells).join(
        shapes.selectExpr("file_id", "sheet_idx", "max_row AS last_row"), ["file_id", "sheet_idx"]
    )
    from conftest import table_of

    assert table_of(S.dense_grid(cells, ranges, step=1)) == [
        ["a", None, "c"], [None, None, None], [None, "N/A", "x"],
    ]
    tokens = table_of(S.dense_grid(cells, ranges, na_tokens=["N/A"]))
    assert tokens[2] == [None, None, "x"]
    assert table_of(S.drop_null_columns(S.dense_grid(cells, ranges, ["N/A"])))[0] == ["a", "c"]
