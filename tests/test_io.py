import io
import json
import zipfile
from pathlib import Path
from unittest import mock

import pandas as pd
import pytest
from pyspark.sql import functions as F

from checks.q_io import _write_logs, workbook_bytes
from gridloom.model import DIMENSION, FACT
from gridloom.operators.resolvers import table_resolver
from gridloom.session import cut_lineage, shared_dir
from gridloom.sinks.archive import archive_name
from gridloom.sinks.dictionaries import HEADER_KEYS, VALUE_KEYS, DictionaryStore
from gridloom.sinks.store import Store
from gridloom.sources import dictionaries as D
from gridloom.sources import workbooks
from gridloom.sources.files import latest_file, list_files, require_latest, scan_workbooks
from gridloom.sources.records import run_lines, submissions_from_json
from gridloom.sources.workbooks import load_workbooks
from gridloom.streaming.new_files import append_once, grow_dictionary, process_new_files


def pairs(frame, *columns):
    return sorted(tuple(r) for r in frame.select(*columns).collect())


def test_workbooks_to_cells(spark, tmp_path):
    grid = {1: {1: "Heure", 3: "été <&>"}, 4: {2: "T0", 28: "far"}}
    (tmp_path / "a.xlsx").write_bytes(workbook_bytes({"Feuille 1": grid, "vide": {}}))
    (tmp_path / "b.xlsx").write_bytes(b"no workbook")
    (tmp_path / "c.txt").write_text("x")
    found = load_workbooks(scan_workbooks(spark, str(tmp_path)))
    assert pairs(found.cells, "sheet_name", "row_idx", "col_idx", "value", "value_type") == [
        ("Feuille 1", 1, 1, "Heure", "s"), ("Feuille 1", 1, 3, "été <&>", "s"),
        ("Feuille 1", 4, 2, "T0", "s"), ("Feuille 1", 4, 28, "far", "s"),
    ]
    assert pairs(found.sheets, "sheet_idx", "sheet_name", "max_row", "max_col") == [
        (1, "Feuille 1", 4, 28), (2, "vide", 0, 0),
    ]
    rejected = found.rejected.collect()
    assert [r.file_id.rsplit("/", 1)[1] for r in rejected] == ["b.xlsx"] and "BadZipFile" in rejected[0].reason


def test_cell_types(spark, tmp_path):
    import io
    import zipfile

    main = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
    sheet = (
        f'<worksheet xmlns="{main}"><sheetData><row r="2">'
        '<c r="A2"><v>3</v></c><c r="B2"><v>2.5</v></c><c r="C2" t="b"><v>1</v></c>'
        '<c r="D2" s="1"><v>45292</v></c><c r="E2" s="2"><v>0.5</v></c>'
        '<c r="F2" t="str"><f>A2</f><v>cached</v></c><c r="G2"><f>A2</f></c><c r="H2" s="3"><v>7</v></c>'
        "</row></sheetData></worksheet>"
    )
    styles = (
        f'<styleSheet xmlns="{main}"><numFmts><numFmt numFmtId="164" formatCode="hh:mm"/>'
        '<numFmt numFmtId="165" formatCode="0.0 &quot;days&quot;"/></numFmts>'
        '<cellXfs><xf numFmtId="0"/><xf numFmtId="14"/><xf numFmtId="164"/><xf numFmtId="165"/></cellXfs></styleSheet>'
    )
    buffer = io.BytesIO(workbook_bytes({"S": {}}))
    with zipfile.ZipFile(buffer) as book:
        kept = {n: book.read(n) for n in book.namelist() if "sheet1" not in n}
    with zipfile.ZipFile(tmp_path / "t.xlsx", "w") as book:
        for name, content in kept.items():
            book.writestr(name, content)
        book.writestr("xl/worksheets/sheet1.xml", sheet)
        book.writestr("xl/styles.xml", styles)
    found = load_workbooks(scan_workbooks(spark, str(tmp_path)))
    assert [(r.value, r.value_type) for r in found.cells.orderBy("col_idx").collect()] == [
        ("3", "n"), ("2.5", "n"), ("True", "b"), ("2024-01-01 00:00:00", "d"), ("12:00:00", "d"),
        ("cached", "s"), ("7", "n"),
    ]
    assert found.sheets.first().max_col == 8


def test_file_lists(spark, tmp_path):
    import os

    for i, name in enumerate(["b.xlsx", "a.xlsx", "c.csv"]):
        (tmp_path / name).write_text("x")
        os.utime(tmp_path / name, (1_700_000_000 + i, 1_700_000_000 + i))
    files = spark.read.format("binaryFile").load(str(tmp_path))
    assert [r.file_name for r in list_files(files).collect()] == ["a.xlsx", "b.xlsx"]
    assert latest_file(files).first().path.endswith("a.xlsx")
    plan = list_files(files)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<path:string,modificationTime:timestamp>" in plan
    with pytest.raises(FileNotFoundError):
        require_latest(files.where("false"))


def test_csv_dictionaries(spark, tmp_path):
    path = tmp_path / "headers.csv"
    path.write_text('En-tête,Standard\nÉté,a\n"x, ""y""\nz",b\nÉté,c\nvide,\n', encoding="utf-8")
    table = D.header_dictionary(spark, str(path))
    assert [(r.raw, r.standard) for r in table.orderBy("line_no").collect()] == [
        ("Été", "a"), ('x, "y"\nz', "b"), ("Été", "c"), ("vide", None),
    ]
    assert ("ete", "c") in pairs(D.header_dictionary_by_norm(spark, str(path)), "norm", "standard")
    assert D.header_dictionary(spark, str(tmp_path / "none.csv")).count() == 0
    (tmp_path / "empty.csv").write_text("")
    assert D.value_dictionary(spark, str(tmp_path / "empty.csv")).count() == 0


def test_latin_1_is_read_again(spark, tmp_path):
    path = tmp_path / "old.csv"
    path.write_bytes("a,b\nÉmetteur,emetteur\n".encode("latin-1"))
    assert pairs(D.header_dictionary(spark, str(path)), "raw", "standard") == [("Émetteur", "emetteur")]


def test_pair_dictionary(spark, tmp_path):
    (tmp_path / "p.csv").write_text("a,1\nb,2\na,3\n")
    assert pairs(D.pair_dictionary(spark, str(tmp_path / "p.csv")), "raw", "standard") == [("a", "3"), ("b", "2")]
    (tmp_path / "one.csv").write_text("a\nb\n")
    assert D.pair_dictionary(spark, str(tmp_path / "one.csv")).count() == 0


def test_nested_dictionaries_and_schema(spark, tmp_path):
    nested = {"type_inject": {"Majeur": "Critique"}, "modalite": {"courriel": "Email"}}
    want = [("modalite", "courriel", "Email"), ("type_inject", "Majeur", "Critique")]
    (tmp_path / "v.json").write_text(json.dumps(nested))
    assert pairs(D.value_dictionary_json(spark, str(tmp_path / "v.json")), "field", "raw", "standard") == want
    pytest.importorskip("yaml")
    (tmp_path / "v.yaml").write_text("type_inject:\n  Majeur: Critique\nmodalite:\n  courriel: Email\nvide:\n")
    assert pairs(D.value_dictionary_yaml(spark, str(tmp_path / "v.yaml")), "field", "raw", "standard") == want
    (tmp_path / "s.yaml").write_text(
        "fields:\n  - name: id_inject\n    required: true\n  - name: type_inject\n    values: [Critique, 2]\n  - type: string\n"
    )
    schema = D.target_schema(spark, str(tmp_path / "s.yaml"))
    assert (schema.fields, schema.required) == (["id_inject", "type_inject"], ["id_inject"])
    assert schema.allowed == {"type_inject": ["Critique", "2"]}
    assert D.target_schema(spark, str(tmp_path / "none.yaml")).fields == []


def test_submissions_from_files(spark, tmp_path):
    (tmp_path / "m.json").write_text('{\n "nom_chronogramme": "Test", "nb_injects": 3\n}')
    row = submissions_from_json(spark, str(tmp_path)).first()
    assert (row.nom_chronogramme, row.nb_injects, row.source_name) == ("Test", "3", "m.json")


def test_archive_names(spark):
    row = spark.range(1).select(
        archive_name(F.lit("/in/a.b.xlsx"), F.lit(3), F.lit("2024-05-06 07:08:09").cast("timestamp")).alias("x"),
        archive_name(F.lit("s.xlsx"), F.lit(None), F.lit("2024-05-06 07:08:09").cast("timestamp")).alias("y"),
    ).first()
    assert (row.x, row.y) == ("a.b_3_20240506_070809.xlsx", "s_20240506_070809.xlsx")


def store_of(spark, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    store.create()
    store.create()
    return store


def test_store_appends_and_counts(spark, tmp_path):
    store = store_of(spark, tmp_path)
    assert store.dimension().columns == DIMENSION.names and store.facts().count() == 0
    assert store.max_id() == 0
    rows = spark.createDataFrame(
        [(1, i, f"T{i}") for i in range(1, 6)], "id_chronogramme long, id_inject int, horodatage string"
    )
    store.append_dimension(spark.createDataFrame([(1, "Test")], "id_chronogramme long, nom_chronogramme string"))
    store.append_facts(rows, "b1")
    store.append_facts(rows, "b1")
    other = rows.withColumn("id_chronogramme", F.lit(2001).cast("long"))
    store.append_facts(other, "b2")
    facts = store.facts()
    assert facts.drop("batch_id", "id_bucket").columns == FACT.names
    assert sorted(r.id_inject_global for r in facts.collect()) == list(range(1, 11))
    assert {r.description for r in facts.collect()} == {None}
    store.update_counts()
    row = store.dimension().first()
    assert (row.nom_chronogramme, row.nb_injects, store.max_id()) == ("Test", 5, 1)
    plan = store.facts(2001)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(id_bucket" in plan and "EqualTo(id_chronogramme,2001)" in plan
    assert store.facts(2001).count() == 5
    store.append_facts(rows.where("false"), "b3")
    assert store.facts().count() == 10


def test_log_keeps_raw_and_normalized(spark, tmp_path):
    store = store_of(spark, tmp_path)
    rows = spark.createDataFrame(
        [(10, "header", "Élevé ", "Contenu", "IA")],
        "id_chronogramme long, scope string, nom_original string, champ_standard string, methode string",
    )
    store.append_log(rows, "b1")
    row = store.mapping_log().first()
    assert (row.nom_original, row.original_norm, row.standard_norm) == ("Élevé ", "eleve", "contenu")
    assert row.horodatage.endswith("Z")


def test_dictionary_versions(spark, tmp_path):
    store = DictionaryStore(spark, str(tmp_path / "d"), HEADER_KEYS)
    assert store.read().count() == 0
    entries = spark.createDataFrame([("a", "x")], "raw string, standard string")
    assert store.add(entries) == 1
    assert store.add(entries.where("false")) == 1
    assert store.add(spark.createDataFrame([("a", "y"), ("b", "z")], "raw string, standard string")) == 2
    assert pairs(store.read(), "raw", "standard") == [("a", "y"), ("b", "z")]
    (tmp_path / "d" / "v=3").mkdir()
    assert store.table.version() == 2  # not committed


def test_lineage_goes_to_the_shared_folder(spark):
    cut = cut_lineage(spark.range(5).withColumn("x", F.lit("a")))
    assert cut.count() == 5
    assert all(shared_dir(spark) in f for f in cut.inputFiles())


def test_a_local_session_without_shared_folder_makes_one(spark, monkeypatch):
    from gridloom import session

    monkeypatch.setattr(session, "_named_dir", lambda spark: None)
    cut = session.cut_lineage(spark.range(3))
    assert cut.count() == 3 and "/gridloom/" in cut.inputFiles()[0]
    assert session.shared_dir(spark) == session.shared_dir(spark)


def test_stream_sees_each_file_once(spark, tmp_path):
    source, seen = tmp_path / "in", []
    frame = spark.range(3).select(F.col("id").cast("string").alias("file_id"))

    def handle(batch, batch_id):
        seen.append(sorted(r.file_id for r in batch.collect()))

    for wave in (frame.where("file_id < 2"), frame.where("file_id = 2")):
        wave.coalesce(1).write.mode("append").parquet(str(source))
        process_new_files(
            spark, str(source), handle, str(tmp_path / "cp"), "file_id string", "parquet", str(tmp_path / "arc")
        )
    assert seen == [["0", "1"], ["2"]]


def test_stream_reads_workbooks(spark, tmp_path):
    source, seen = tmp_path / "in", []
    source.mkdir()
    (source / "a.xlsx").write_bytes(workbook_bytes({"S": {1: {1: "x"}}}))

    def handle(batch, batch_id):
        seen.extend(r.value for r in load_workbooks(batch).cells.collect())

    for _ in range(2):
        process_new_files(spark, str(source), handle, str(tmp_path / "cp"))
    assert seen == ["x"]


def test_two_streams_keep_their_facts(spark, tmp_path):
    facts = store_of(spark, tmp_path)
    schema = "id_chronogramme long, id_inject string"
    append_once(facts, "north")(spark.createDataFrame([(1, "a")], schema), 0)
    append_once(facts, "south")(spark.createDataFrame([(2, "a")], schema), 0)
    assert pairs(facts.facts(), "id_chronogramme", "id_inject") == [(1, "a"), (2, "a")]


def test_a_replacement_character_of_the_file_itself_is_no_broken_byte(spark, tmp_path):
    folder = tmp_path / "marks"
    folder.mkdir()
    (folder / "a.csv").write_bytes("raw,standard\nÉmetteur \ufffd,emetteur\n".encode())
    (folder / "b.csv").write_bytes("raw,standard\nModalité,modalite\n".encode("latin-1"))
    found = {r.raw for r in D.header_dictionary(spark, str(folder)).collect()}
    assert found == {"Émetteur \ufffd", "Modalité"}


def test_encoding_is_told_per_file(spark, tmp_path):
    folder = tmp_path / "dict"
    folder.mkdir()
    (folder / "a.csv").write_bytes("raw,standard\nÉmetteur,emetteur\n".encode())
    (folder / "b.csv").write_bytes("raw,standard\nModalité,modalite\n".encode("latin-1"))
    found = D.header_dictionary(spark, str(folder))
    assert pairs(found, "raw") == [("Modalité",), ("Émetteur",)]


def test_late_epoch_and_readings(spark, tmp_path):
    import io
    import zipfile

    main = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
    cells = '<c r="A1" t="s"><v>0</v></c><c r="B1" s="1"><v>1</v></c>'
    changed = {
        "xl/worksheets/sheet1.xml": f'<worksheet xmlns="{main}"><sheetData><row r="1">{cells}</row></sheetData></worksheet>',
        "xl/sharedStrings.xml": f'<sst xmlns="{main}"><si><r><t>ba</t></r><r><t>se</t></r><rPh sb="0" eb="1"><t>PHON</t></rPh></si></sst>',
        "xl/styles.xml": f'<styleSheet xmlns="{main}"><cellXfs><xf numFmtId="0"/><xf numFmtId="14"/></cellXfs></styleSheet>',
    }
    with zipfile.ZipFile(io.BytesIO(workbook_bytes({"S": {}}))) as book:
        parts = {n: book.read(n).decode() for n in book.namelist()} | changed
    parts["xl/workbook.xml"] = parts["xl/workbook.xml"].replace("<sheets>", '<workbookPr date1904="1"/><sheets>')
    with zipfile.ZipFile(tmp_path / "a.xlsx", "w") as book:
        for name, text in parts.items():
            book.writestr(name, text)
    found = load_workbooks(scan_workbooks(spark, str(tmp_path))).cells
    assert pairs(found, "col_idx", "value") == [(1, "base"), (2, "1904-01-02 00:00:00")]


def test_repeated_batches_change_nothing(spark, tmp_path):
    store = DictionaryStore(spark, str(tmp_path / "d"), VALUE_KEYS)
    reviewed = spark.createDataFrame([("c", "a", "Std")], "scope string, key string, standard string")
    values = spark.createDataFrame(
        [("f", 1, "c", "A"), ("f", 2, "c", "q")], "file_id string, row_idx long, field string, value string"
    )
    handle = grow_dictionary(store, table_resolver(reviewed), {})
    handle(values, 0)
    handle(values, 0)
    assert store.table.version() == 1
    facts = store_of(spark, tmp_path)
    rows = spark.createDataFrame([(1, "a"), (1, "a"), (1, None)], "id_chronogramme long, id_inject string")
    append = append_once(facts, "inbox")
    append(rows, 0)
    append(rows, 0)
    append(rows.where("id_inject = 'a'"), 1)
    assert pairs(facts.facts().fillna("-"), "id_chronogramme", "id_inject") == [(1, "-"), (1, "a")]


def test_a_run_log_is_one_file_whose_lines_may_come_in_several_batches(spark, tmp_path):
    name = {n: f"{tmp_path}/logs/run_{n}.log" for n in "ab"}
    rows = [(name["a"], "1"), (name["a"], "2"), (name["a"], "3"), (name["b"], "4")]
    batches = [pd.DataFrame(part, columns=["path", "line"]) for part in (rows[:1], rows[1:2], rows[2:])]
    assert {p for out in _write_logs(iter(batches)) for p in out["path"]} == set(name.values())
    assert {n: Path(p).read_text() for n, p in name.items()} == {"a": "1\n2\n3\n", "b": "4\n"}
    read = run_lines(spark, f"{tmp_path}/logs")
    found = [(r.log_name, r.line) for r in read.orderBy("log_name", "ord").collect()]
    assert found == [("run_a.log", "1"), ("run_a.log", "2"), ("run_a.log", "3"), ("run_b.log", "4")]


def test_a_dictionary_starts_once(spark, tmp_path):
    store = DictionaryStore(spark, f"{tmp_path}/d", HEADER_KEYS)
    entries = spark.createDataFrame([("a", "x"), ("b", "y")], "raw string, standard string")
    assert store.start(entries) == 1 and store.read().count() == 2
    with pytest.raises(ValueError, match="has entries"):
        store.start(entries)
    store.add(spark.createDataFrame([("a", "z")], "raw string, standard string"))
    assert {r.raw: r.standard for r in store.read().collect()} == {"a": "z", "b": "y"}


def test_scratch_tables_are_packed(spark):
    """Half of what the flow writes are such tables."""
    text = spark.range(20_000).select(F.concat(F.lit("ligne "), F.sha1(F.col("id").cast("string"))).alias("t"))
    assert all(".zstd." in f for f in cut_lineage(text, "packed").inputFiles())


def test_rows_and_cells_without_references():
    """Rows count on from the last one that says its number, cells from the last one of their row."""
    main = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
    texts = f'<sst xmlns="{main}"><si><t>a</t></si><si><r><t>b</t></r><r><t>c</t></r><rPh><t>no</t></rPh></si><si><t/></si></sst>'
    cell = '<c{} t="s"><v>{}</v></c>'
    rows_of = [("", [("", 0), ("", 1)]), (' r="7"', [(' r="AB7"', 1), ("", 0)]), ("", [(' r="C8"', 0), ("", 2)])]
    body = "".join(f"<row{r}>{''.join(cell.format(*c) for c in cells)}</row>" for r, cells in rows_of)
    sheet = f'<worksheet xmlns="{main}"><sheetData>{body}</sheetData></worksheet>'
    plain, odd = workbook_bytes({"S": {1: {1: "x"}}}), io.BytesIO()
    with zipfile.ZipFile(io.BytesIO(plain)) as book, zipfile.ZipFile(odd, "w") as out:
        for name in book.namelist():
            new = {"xl/sharedStrings.xml": texts, "xl/worksheets/sheet1.xml": sheet}.get(name, book.read(name))
            out.writestr(name, new)
    seen = []
    starts = workbooks.ET.iterparse

    def counted(*args):
        for found in starts(*args):
            seen.append(found)
            yield found

    with mock.patch.object(workbooks.ET, "iterparse", counted):
        found = [r[3:6] for r in workbooks._read("odd", odd.getvalue())]
    assert found == [(1, 1, "a"), (1, 2, "bc"), (7, 28, "bc"), (7, 29, "a"), (8, 3, "a"), (8, 29, None)]
    # One event per element: six cells with a value each, three rows, the sheet and its data.
    assert len(seen) == 6 * 2 + 3 + 2
