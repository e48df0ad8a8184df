"""Forms for sparse orders, hot keys and archives give the plain results."""

import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from conftest import cells_of
from gridloom.model import NULL_TOKENS
from gridloom.operators import corrections, headers
from gridloom.operators.enrich import number_rows
from gridloom.operators.ordered import (
    _BUCKET,
    WIDTH,
    _ranged,
    carry_forward,
    previous_ordinal,
    range_parts,
    running_count,
)
from gridloom.plans.intake import Options, plan_intake
from gridloom.sinks.archive import ABSENT, MOVED, Archive
from test_flow import GOOD, HEAD, run, stores


def far_apart(seed, n=300):
    rng = random.Random(seed)
    places = rng.sample(range(10**15), n)
    return [(rng.choice("aab"), o, rng.choice([None, 1, 2, 3])) for o in places]


@pytest.mark.parametrize("seed, width", [(1, 7), (2, 100), (3, 10_000)])
def test_sparse_orders_equal_single_windows(spark, seed, width):
    table = far_apart(seed)
    pdf = pd.DataFrame(table, columns=["k", "o", "v"], dtype=object).sort_values("o")
    frame = spark.createDataFrame(table, "k string, o long, v int")
    filled = carry_forward(frame, ["k"], "o", ["v"], width, sparse=True).orderBy("o").collect()
    want = pdf.groupby("k")["v"].ffill()
    assert [r.v for r in filled] == [None if pd.isna(x) else int(x) for x in want]
    counted = running_count(frame, ["k"], "o", "n", F.col("v").isNull(), width, total="t", sparse=True)
    rows = counted.orderBy("o").collect()
    assert [r.n for r in rows] == list(pdf["v"].isna().astype(int).groupby(pdf["k"]).cumsum())
    assert [r.t for r in rows] == list(pdf.groupby("k")["o"].transform("size"))
    linked = previous_ordinal(frame, ["k"], "o", "p", width, sparse=True).orderBy("o").collect()
    assert [r.p for r in linked] == [None if pd.isna(x) else int(x) for x in pdf.groupby("k")["o"].shift()]


def test_sparse_buckets_are_few(spark):
    frame = spark.range(5000).select(F.lit("all").alias("k"), (F.col("id") * 10**9).alias("o"))
    buckets = _ranged(frame, ["k"], "o", 1000).groupBy("k", _BUCKET).count().collect()
    # By value there would be 5000.
    assert 2 <= len(buckets) <= 5 and sum(r["count"] for r in buckets) == 5000
    numbered = number_rows(frame.withColumnsRenamed({"k": "file_id", "o": "row_idx"}), width=1000, sparse=True)
    assert numbered.agg(F.max("numero_inject"), F.countDistinct("numero_inject")).first()[:2] == (5000, 5000)


def test_small_width_makes_no_more_ranges_than_a_shuffle(spark):
    """A range is a task and a file: with a row or two in each, their number was that of the rows."""
    frame = spark.range(600).select(F.lit("all").alias("k"), (F.col("id") * 10**9).alias("o"))
    placed = _ranged(frame, ["k"], "o", 2)
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert 2 <= placed.select(_BUCKET).distinct().count() <= tasks
    assert [range_parts(rows, 64, 200) for rows in (0, 65, 900_000, 10**9)] == [1, 2, 200, -(-(10**9) // WIDTH)]
    counted = running_count(frame, ["k"], "o", "n", width=2, sparse=True)
    assert [r.n for r in counted.orderBy("o").collect()] == list(range(1, 601))


def test_sparse_order_refuses_nulls(spark):
    frame = spark.createDataFrame([("a", 1), (None, 2)], "k string, o long")
    with pytest.raises(Exception, match="null in k, o"):
        running_count(frame, ["k"], "o", "n", sparse=True).collect()


@pytest.mark.parametrize("bounds", [{}, {"max_rows": 0, "heavy_rows": 20}])
@pytest.mark.parametrize("scope", [[], ["file_id"]])
def test_first_use_of_a_header_in_every_file(spark, bounds, scope):
    rows = [(f"f{i:03}", 1, c, key) for i in range(60) for c, key in ((1, "hot"), (2, f"k{i % 9}"), (3, "hot"))]
    frame = spark.createDataFrame(rows, "file_id string, sheet_idx long, col_idx long, key string")
    order = ["sheet_idx", "col_idx"] if scope else ["file_id", "sheet_idx", "col_idx"]
    found = headers._first_use(frame, scope, order, **bounds).collect()
    seen = set()
    want = {}
    for f, s, c, key in sorted(rows):
        mark = (f, key) if scope else key
        want[f, c] = mark not in seen
        seen.add(mark)
    assert {(r.file_id, r.col_idx): r.is_first for r in found} == want


def test_hot_header_is_split(spark):
    """Beyond the broadcast bound the join back has a salt beside the text."""
    rows = [(f"f{i:03}", 1, 1, "hot") for i in range(60)]
    frame = spark.createDataFrame(rows, "file_id string, sheet_idx long, col_idx long, key string")
    marked = headers._first_use(frame, [], ["file_id"], max_rows=0, heavy_rows=20)
    assert "__salt" in marked._jdf.queryExecution().optimizedPlan().toString()
    assert marked.where("is_first").count() == 1


def test_corrections_in_one_join(spark):
    facts = spark.createDataFrame(
        [(1, 1, "a", "x"), (1, 2, "b", None), (2, 3, "a", "x"), (3, 4, None, "y")],
        "id_chronogramme long, row_idx long, type_inject string, modalite string",
    )
    changed = spark.createDataFrame(
        [(1, "type_inject", "a", "A"), (1, "modalite", "x", "X"), (2, "modalite", "a", "no"), (3, "other", "y", "no")],
        "id_chronogramme long, field string, old_value string, new_value string",
    )
    done = corrections.apply_corrections(facts, changed, ["type_inject", "modalite"], ["row_idx"])
    assert sorted((r.row_idx, r.type_inject, r.modalite) for r in done.collect()) == [
        (1, "A", "X"), (2, "b", None), (3, "a", "x"), (4, None, "y"),
    ]
    assert done._jdf.queryExecution().optimizedPlan().toString().count("Join") == 1


def test_changed_standards(spark):
    log = "id_chronogramme long, scope string, nom_original string, champ_standard string"
    rows = [(1, "t", "u", "old"), (2, "t", "u", "new"), (3, "t", "w", "old"), (1, "t", "u", "old")]
    edited = spark.createDataFrame([("t", "u", "new"), ("t", "w", "")], "field string, raw string, standard string")
    found = corrections.corrections(spark.createDataFrame(rows, log), edited).collect()
    assert [tuple(r) for r in found] == [(1, "t", "old", "new")]


# Options of the flow


def test_tokens_count_as_empty(spark, tmp_path):
    sheet = [HEAD, ["T0", "N/A", "Majeur"], ["NULL", "y", "Majeur"], ["n/a", "nan", "#N/A"]]
    parts = stores(spark, tmp_path / "a")
    run(spark, parts, {("a", 1, "S"): sheet}, ["a"])
    # Filled from above, and where nothing is above from the left; the last row is a copy of its upper one.
    rows = sorted((r.horodatage, r.description) for r in parts[0].facts().collect())
    assert rows == [("T0", "T0"), ("T0", "y"), ("T0", "y")]
    plain = stores(spark, tmp_path / "b")
    run(spark, plain, {("a", 1, "S"): sheet[:3]}, ["a"], na_tokens=None)
    assert sorted(r.description for r in plain[0].facts().collect()) == ["N/A", "y"]
    assert "NULL" in NULL_TOKENS


def test_tie_choice_in_the_flow(spark, tmp_path):
    cells, shapes = cells_of(spark, {("a", 1, "One"): GOOD, ("a", 2, "Two"): GOOD, ("b", 1, "Only"): GOOD})
    meta = spark.createDataFrame(
        [(f, i, "e", "t", f, "2024-01-01") for i, f in enumerate("ab", 1)],
        "file_id string, id_chronogramme long, etablissement_nom string, etablissement_type string, "
        "nom_chronogramme string, date_exercice string",
    )
    heads = spark.createDataFrame([("Horodatage", "horodatage", 0)], "raw string, standard string, line_no long")
    values = spark.createDataFrame([], "field string, raw string, standard string, line_no long")
    asked = []

    def last(tied):
        asked.append(sorted((r.file_id, r.sheet_name) for r in tied.collect()))
        return tied.groupBy("file_id").agg(F.max("sheet_name").alias("sheet_name"))

    def sheets_of(**options):
        rows = plan_intake(cells, shapes, meta, heads, values, Options(**options)).rows
        return sorted({(r.file_id, r.sheet_idx) for r in rows.collect()})

    assert sheets_of() == [("a", 1), ("b", 1)]
    assert sheets_of(tie_choice=last) == [("a", 2), ("b", 1)]
    assert asked == [[("a", "One"), ("a", "Two")]]


# The archive


def test_archive_moves_once(spark, tmp_path):
    inbox = tmp_path / "in"
    inbox.mkdir()
    for name in "abc":
        (inbox / f"{name}.xlsx").write_text(name)
    rows = [(f"file:{inbox}/a.xlsx", 7, "OK"), (f"{inbox}/b.xlsx", 8, "OK"), (f"{inbox}/c.xlsx", None, "ERROR"),
            (f"{inbox}/gone.xlsx", 9, "OK")]
    files = spark.createDataFrame(rows, "file_id string, chrono_id long, status string")
    archive = Archive(spark, str(tmp_path / "store"), str(tmp_path / "old"))
    assert archive.files().count() == 0 and archive.waiting() == []
    moment = F.lit("2024-05-06 07:08:09").cast("timestamp")
    archive.plan(files, "b1", moment)
    assert archive.waiting() == ["b1"] and (inbox / "a.xlsx").exists()
    # A task that was lost after its move: the file is at its target already.
    (tmp_path / "old").mkdir()
    (inbox / "b.xlsx").rename(tmp_path / "old" / "b_8_20240506_070809.xlsx")
    for _ in range(2):
        archive.plan(files, "b1")
        archive.move("b1")
        states = sorted((r.path.rsplit("/", 1)[1], r.state) for r in archive.files().collect())
        assert states == [("a.xlsx", MOVED), ("b.xlsx", MOVED), ("gone.xlsx", ABSENT)]
    assert archive.waiting() == []
    assert sorted(p.name for p in (tmp_path / "old").iterdir() if p.suffix == ".xlsx") == [
        "a_7_20240506_070809.xlsx", "b_8_20240506_070809.xlsx",
    ]
    assert [p.name for p in inbox.iterdir()] == ["c.xlsx"]


def test_archive_moves_in_many_tasks(spark, tmp_path):
    rows = [(f"{tmp_path}/in/{i}.xlsx", i, "OK") for i in range(40)]
    (tmp_path / "in").mkdir()
    for path, i, _ in rows:
        (tmp_path / "in" / f"{i}.xlsx").write_text(str(i))
    archive = Archive(spark, str(tmp_path / "store"), str(tmp_path / "old"))
    archive.plan(spark.createDataFrame(rows, "file_id string, chrono_id long, status string"), "b1")
    archive.move("b1")
    done = archive.files()
    assert done.where(F.col("state") == MOVED).count() == 40
    # One file of rows per task that had any; these few bytes were one task before.
    assert done.select(F.input_file_name()).distinct().count() > 1


def test_streamed_intake_archives_finished_batches(spark, tmp_path):
    from checks.q_io import workbook_bytes
    from gridloom.streaming.intake import archive_rest, intake_files
    from gridloom.streaming.new_files import process_new_files
    from test_flow import SCHEMA

    parts = stores(spark, tmp_path)
    inbox = tmp_path / "in"
    inbox.mkdir()
    grid = {r: dict(enumerate(line, 1)) for r, line in enumerate(GOOD, 1)}
    archive = Archive(spark, parts[0].base, str(tmp_path / "old"))
    handle = intake_files(*parts, "inbox", Options(schema=SCHEMA), archive=archive)
    for name in "ab":
        (inbox / f"{name}.xlsx").write_bytes(workbook_bytes({"S": grid}))
        process_new_files(spark, str(inbox), handle, str(tmp_path / "cp"))
    # The first batch went when the second came; that one may still be repeated.
    assert [p.name for p in inbox.iterdir() if p.suffix == ".xlsx"] == ["b.xlsx"]
    archive_rest(archive)
    assert not [p for p in inbox.iterdir() if p.suffix == ".xlsx"]
    assert {r.state for r in archive.files().collect()} == {MOVED}
    assert parts[0].dimension().count() == 2
