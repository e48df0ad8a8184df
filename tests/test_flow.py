import pytest

from conftest import cells_of
from gridloom.model import TargetSchema
from gridloom.operators.resolvers import table_resolver
from gridloom.plans.intake import Options, plan_intake, run_intake
from gridloom.plans.monitoring import monitor
from gridloom.sinks.dictionaries import HEADER_KEYS, VALUE_KEYS, DictionaryStore
from gridloom.sinks.store import Store

SCHEMA = TargetSchema(allowed={"type_inject": ["Critique", "Important"]})
HEADERS = [("Horodatage", "horodatage"), ("Descriptif", "description"), ("Type d'inject", "type_inject")]


def stores(spark, base):
    store = Store(spark, f"{base}/store")
    store.create()
    headers = DictionaryStore(spark, f"{base}/headers", HEADER_KEYS)
    headers.add(spark.createDataFrame(HEADERS, "raw string, standard string"))
    values = DictionaryStore(spark, f"{base}/values", VALUE_KEYS)
    values.add(
        spark.createDataFrame(
            [("type_inject", "Majeur", "Critique")], "field string, raw string, standard string"
        )
    )
    return store, headers, values


def submissions(spark, *names):
    fields = ["nom_chronogramme", "date_exercice", "lieu_exercice", "etablissement_nom"]
    fields += ["etablissement_type", "submitter", "nom_fichier_excel", "nb_injects"]
    schema = "file_id string, file_path string, " + ", ".join(f"{f} string" for f in fields)
    return spark.createDataFrame([(n, f"/in/{n}.xlsx", *[None] * 8) for n in names], schema)


def run(spark, parts, sheets, names, batch="b1", **options):
    cells, shapes = cells_of(spark, sheets)
    return run_intake(
        spark, *parts, cells, shapes, submissions(spark, *names), batch, Options(schema=SCHEMA, **options)
    )


HEAD = ["Horodatage", "Descriptif", "Type d'inject"]


def test_one_row_goes_through(spark, tmp_path):
    parts = stores(spark, tmp_path)
    # One data row: it is the first and the last, so every column stays.
    done = run(spark, parts, {("a", 1, "Sheet1"): [HEAD, ["T0", "Test", "Majeur"]]}, ["a"])
    row = parts[0].facts().first()
    assert (row.horodatage, row.description, row.type_inject, row.id_inject) == ("T0", "Test", "Critique", "1")
    parent = parts[0].dimension().first()
    assert parent.id_chronogramme == row.id_chronogramme == 1
    assert (parent.nom_chronogramme, parent.etablissement_nom, parent.nb_injects) == ("a", "Auto", 1)
    assert [(r.file_name, r.status) for r in done.outcome.collect()] == [("a.xlsx", "OK")]
    methods = {r.nom_original: (r.champ_standard, r.methode) for r in parts[0].mapping_log().collect()}
    assert methods["Type d'inject"] == ("type_inject", "dict")


def test_a_bad_file_does_not_stop_the_others(spark, tmp_path):
    parts = stores(spark, tmp_path)
    table = [HEAD, ["T0", "x", "Majeur"], ["T1", "y", "Important"], ["T2", "z", "Mineur"], ["TOTAL", "", ""]]
    sheets = {("a", 1, "S"): table, ("b", 1, "S"): [["just", "two"]], ("c", 1, "S"): table}
    done = run(spark, parts, sheets, ["a", "b", "c"])
    assert {r.file_name: r.status for r in done.outcome.collect()} == {
        "a.xlsx": "OK", "b.xlsx": "ERROR", "c.xlsx": "OK",
    }
    assert [(r.file_id, r.reason) for r in done.rejected.collect()] == [("b", "no header row")]
    facts = parts[0].facts().collect()
    assert len(facts) == 4 and len({r.id_chronogramme for r in facts}) == 2
    assert {(r.nom_chronogramme, r.nb_injects) for r in parts[0].dimension().collect()} == {("a", 2), ("c", 2)}
    # Ids go on after the stored ones.
    run(spark, parts, {("d", 1, "S"): table}, ["d"], batch="b2")
    ids = sorted(r.id_chronogramme for r in parts[0].dimension().collect())
    assert len(ids) == 3 and len(set(ids)) == 3
    assert sorted(r.id_inject_global for r in parts[0].facts().collect()) == list(range(1, 7))
    table = monitor(spark, parts[0], f"{tmp_path}/store/run_logs", str(tmp_path / "report"))
    assert sorted((r.log_name, r.chrono_id) for r in table.collect()) == sorted(
        ("run_b2.log" if i == ids[-1] else "run_b1.log", i) for i in ids
    )
    assert all(0 < r.completeness <= 1 for r in table.collect())


GOOD = [HEAD, ["T0", "x", "Majeur"], ["T1", "y", "Important"]]


def state(store):
    facts = sorted(tuple(r) for r in store.facts().drop("batch_id").fillna("-").collect())
    parents = sorted((r.id_chronogramme, r.fichier_source, r.nb_injects) for r in store.dimension().collect())
    log = sorted((r.id_chronogramme, r.scope, r.nom_original) for r in store.mapping_log().collect())
    return facts, parents, log


def test_every_file_has_an_outcome(spark, tmp_path):
    parts = stores(spark, tmp_path)
    cells, shapes = cells_of(spark, {("Été", 1, "S"): GOOD, ("/in/new.xlsx", 1, "S"): GOOD})
    broken = spark.createDataFrame([("bad.xlsx", "BadZipFile")], "file_id string, reason string")
    done = run_intake(
        spark, *parts, cells, shapes, submissions(spark, "Été", "gone"), "b1", Options(schema=SCHEMA),
        unreadable=broken,
    )
    assert {(r.file_name, r.status, r.reason) for r in done.outcome.collect()} == {
        ("Été.xlsx", "OK", None), ("new.xlsx", "OK", None),
        ("gone.xlsx", "ERROR", "no sheet"), ("bad.xlsx", "ERROR", "BadZipFile"),
    }
    assert {(r.nom_chronogramme, r.nb_injects) for r in parts[0].dimension().collect()} == {("Ete", 2), ("new", 2)}


def test_a_repeated_batch_replaces_itself(spark, tmp_path):
    parts = stores(spark, tmp_path)
    sheets = {("a", 1, "S"): GOOD, ("b", 1, "S"): GOOD}
    run(spark, parts, sheets, ["a", "b"])
    once = state(parts[0])
    run(spark, parts, sheets, ["a", "b"])
    assert state(parts[0]) == once and len(once[1]) == 2


def test_a_broken_run_shows_nothing_and_leaves_a_log(spark, tmp_path):
    parts = stores(spark, tmp_path)
    run(spark, parts, {("a", 1, "S"): GOOD}, ["a"])
    before = state(parts[0])

    class Broken(Store):
        def append_dimension(self, rows, batch_id=None):
            raise OSError("no space")

    broken = (Broken(spark, parts[0].base), *parts[1:])
    with pytest.raises(OSError):
        run(spark, broken, {("b", 1, "S"): GOOD}, ["b"], batch="b2")
    assert state(parts[0]) == before
    log = spark.read.text(f"{tmp_path}/store/run_logs/run_b2.log")
    assert log.where("value LIKE '%ECHEC%' AND value LIKE '%no space%'").count() == 1
    run(spark, parts, {("b", 1, "S"): GOOD}, ["b"], batch="b2")
    assert len(state(parts[0])[1]) == 2


def test_file_without_the_closed_field_is_not_filtered(spark, tmp_path):
    parts = stores(spark, tmp_path)
    sheet = [["Horodatage", "Descriptif", "Autre"], ["T0", "x", "q"], ["T1", "y", "r"]]
    run(spark, parts, {("a", 1, "S"): sheet}, ["a"])
    assert sorted(r.horodatage for r in parts[0].facts().collect()) == ["T0", "T1"]


def test_resolvers_teach_both_dictionaries(spark, tmp_path):
    parts = stores(spark, tmp_path)
    schema = "scope string, key string, standard string"
    head = table_resolver(spark.createDataFrame([("header", "Quand", "horodatage")], schema))
    value = table_resolver(spark.createDataFrame([("type_inject", "eleve", "Important")], schema))
    sheet = [["Quand", "Descriptif", "Type d'inject"], ["T0", "x", "Élevé"], ["T1", "y", "majeur"], ["T2", "z", "Élevé"]]
    run(
        spark, parts, {("a", 1, "S"): sheet}, ["a"],
        value_mode="normalized", header_resolver=head, value_resolver=value, header_policy="resolve",
    )
    assert sorted((r.horodatage, r.type_inject) for r in parts[0].facts().collect()) == [
        ("T0", "Important"), ("T1", "Critique"), ("T2", "Important"),
    ]
    assert ("Quand", "horodatage") in {(r.raw, r.standard) for r in parts[1].read().collect()}
    assert ("eleve", "Important") in {(r.raw, r.standard) for r in parts[2].read().collect()}
    methods = sorted(r.methode for r in parts[0].mapping_log().where("scope = 'type_inject'").collect())
    assert methods == ["IA", "dict", "dict"]


def test_bottom_can_be_trimmed_at_blank_rows(spark, tmp_path):
    parts = stores(spark, tmp_path)
    sheet = [HEAD, ["T0", "x", "Majeur"], ["T1", "y", "Majeur"], ["", "", ""], ["", "", ""], ["note", "n", "Majeur"]]
    run(spark, parts, {("a", 1, "S"): sheet}, ["a"], trim_bottom=True)
    assert parts[0].facts().count() == 2


def test_dictionaries_grow_from_cells(spark):
    from gridloom.plans.dictionaries import header_growth, value_growth

    sheet = [["Emetteur", "Destinataire", "Type d'inject", "Modalite"], ["A", "X", "Maj", "SMS"], ["B", "Y", "Min", "Mail"]]
    more = [["Heure", "Canal", "Emetteur"], ["1", "2", "C"]]
    cells, shapes = cells_of(spark, {("a", 1, "S"): sheet, ("b", 1, "S"): more})
    no_headers = spark.createDataFrame([("x", "", 1)], "raw string, standard string, line_no long")
    no_values = spark.createDataFrame([("x", "")], "field string, raw string")
    first = value_growth(cells, shapes, no_headers, no_values, max_files=1).collect()
    assert len(first) == 8 and {r.standard for r in first} == {""}
    counts = {f: sum(r.field == f for r in first) for f in {r.field for r in first}}
    assert counts == {"emetteur": 2, "destinataire": 2, "type_inject": 2, "modalite": 2}
    # The second file has only one keyword, so its first row is the header all the same.
    assert value_growth(cells, shapes, no_headers, no_values, max_files=None).count() == 9
    known = spark.createDataFrame([("Emetteur", "", 1)], "raw string, standard string, line_no long")
    grown = header_growth(cells, shapes, known)
    assert sorted(r.raw for r in grown.added.collect()) == [
        "Canal", "Destinataire", "Heure", "Modalite", "Type d'inject",
    ]
    assert tuple(grown.counts.first()) == (7, 5)


def test_submissions_are_named_and_registered(spark, tmp_path):
    from gridloom.plans.submissions import submit

    store, _, _ = stores(spark, tmp_path)
    table = [(1, "f", "/depot/u.xlsx", "Port à l'Est", "Feu 1/2", "24/12/2023"), (2, "g", "v.ods", "p", "q", "r")]
    columns = "ordinal long, file_id string, file_path string, etablissement_nom string, nom_chronogramme string, date_exercice string"
    rows = spark.createDataFrame(table, columns).selectExpr(
        "*", "'quai' AS lieu_exercice", "'port' AS etablissement_type", "'e' AS submitter", "'7' AS nb_injects"
    )
    done = [tuple(r) for r in submit(store, rows, "/data/inbox", "ordinal").collect()]
    assert done == [("f", 1, "/data/inbox/Chronogramme_port_a_l_est_feu_1_2_2023-12-24.xlsx")]
    row = store.dimension().first()
    assert (row.id_chronogramme, row.nom_chronogramme, row.nb_injects) == (1, "Feu 1/2", 7)
    assert row.fichier_source.endswith("feu_1_2_2023-12-24.xlsx")


def plan_rows(spark, table, **options):
    cells, shapes = cells_of(spark, {("a", 1, "S"): table})
    known = spark.createDataFrame(
        [(*pair, n) for n, pair in enumerate(HEADERS)], "raw string, standard string, line_no long"
    )
    none = spark.createDataFrame([], "field string, raw string, standard string, line_no long")
    parents = "id_chronogramme long, file_id string, nom_chronogramme string, date_exercice string"
    parents = spark.createDataFrame(
        [(1, "a", "A", None, None, None)], f"{parents}, etablissement_nom string, etablissement_type string"
    )
    return plan_intake(cells, shapes, parents, known, none, Options(schema=SCHEMA, **options))


def test_phases_are_carried_to_the_rows_below(spark):
    bare = [
        [*HEAD, "Salle"],
        ["T0", "x", "Critique", "s"],
        [" Phase 1 ", "", "", ""],
        ["T1", "y", "Critique", "s"],
        ["T2", "z", "Critique", "s"],
        ["", "phase 2", "", ""],
        ["T3", "w", "Critique", "s"],
        ["Total", "", "", ""],
    ]
    kept = plan_rows(spark, bare, phase_into="phase_exercice", clean_order="clean_first").rows
    assert {r.horodatage: r.phase_exercice for r in kept.collect()} == {
        "T0": None, "T1": "Phase 1", "T2": "Phase 1", "T3": "phase 2",
    }
    dropped = plan_rows(spark, bare, clean_order="clean_first").rows.collect()
    assert {r.phase_exercice for r in dropped} == {None} and len(dropped) == 4


def test_columns_outside_the_schema_are_folded(spark):
    table = [
        [*HEAD, "Salle", "Étage"],
        ["T0", "x", "Critique", "s1", "2"],
        ["T1", "y", "Critique", "s2", "3"],
    ]
    rows = plan_rows(spark, table, fold_into="observations").rows.collect()
    assert {r.horodatage: r.observations for r in rows} == {
        "T0": "Salle: s1 | Étage: 2", "T1": "Salle: s2 | Étage: 3",
    }
    assert {r.observations for r in plan_rows(spark, table).rows.collect()} == {None}
    with pytest.raises(ValueError):
        Options(schema=SCHEMA, fold_into="nowhere")


def test_rows_that_lack_a_required_field_are_refused(spark):
    table = [["Horodatage", "Descriptif", "Salle"], ["T0", "x", "s"], ["T1", "y", "s"]]
    # Without a column of the closed field its list is not tested, but the field is still required.
    done = plan_rows(spark, table, refuse_incomplete=True)
    assert [(r.row_idx, r.reason) for r in done.rejected_rows.orderBy("row_idx").collect()] == [
        (2, "missing: type_inject"), (3, "missing: type_inject"),
    ]
    assert done.rows.count() == 0 and plan_rows(spark, table).rows.count() == 2
