import pytest
from pyspark.sql import functions as F

from gridloom.operators import corrections, enrich as E, integrity as I, metadata as M

CONTEXT = (
    "file_id string, id_chronogramme long, etablissement_nom string, etablissement_type string, "
    "nom_chronogramme string, date_exercice string"
)
AT = "2024-05-06 07:08:09"


def moment():
    return F.lit(AT).cast("timestamp")


def submissions(spark):
    return spark.createDataFrame([("f", 1, "Lycée", "École", "Crue", "2023-11-30")], CONTEXT)


def test_files_without_ids_are_numbered(spark):
    rows = spark.createDataFrame([("f", 2, "A"), ("f", 5, "B")], "file_id string, row_idx long, Contenu string")
    done = E.enrich(rows, submissions(spark)).orderBy("row_idx").collect()
    assert [(r.numero_inject, r.id_inject, r.nb_injects) for r in done] == [(1, "1", 2), (2, "2", 2)]
    assert {(r.id_chronogramme, r.etablissement_nom, r.nom_chronogramme) for r in done} == {(1, "Lycée", "Crue")}


@pytest.mark.parametrize("width", [1, 100])
def test_blank_ids_are_filled_in_row_order(spark, width):
    ids = ["A", None, "", "B"]
    rows = spark.createDataFrame(
        [("f", i, v) for i, v in enumerate(ids)], "file_id string, row_idx long, id_inject string"
    )
    done = E.enrich(rows, submissions(spark), width=width).orderBy("row_idx").collect()
    assert [r.id_inject for r in done] == ["A", "1", "2", "B"]
    assert {(r.numero_inject, r.nb_injects) for r in done} == {(None, 4)}


def metadata_of(spark, **changes):
    record = {
        "file_id": "f",
        "ordinal": 1,
        "file_path": "/depot/crue v.2.xlsx",
        "nom_chronogramme": "Crue du canal",
        "date_exercice": "2023-11-30",
        "lieu_exercice": "Nantes",
        "etablissement_nom": "Lycée",
        "etablissement_type": "École",
        "submitter": "equipe",
        "nom_fichier_excel": None,
        "nb_injects": "41",
        **changes,
    }
    schema = ", ".join(f"{k} {'long' if k == 'ordinal' else 'string'}" for k in record)
    return spark.createDataFrame([tuple(record.values())], schema)


def test_metadata_is_checked_cleaned_and_numbered(spark):
    filled = M.with_defaults(metadata_of(spark, lieu_exercice=" Besançon  ", date_exercice="3/4/2023"))
    row = M.assign_ids(M.clean_metadata(M.check_required(filled).valid, moment()), 7, "ordinal").first()
    assert row.id_chronogramme == 8
    assert (row.nom_chronogramme, row.date_exercice, row.lieu_exercice, row.nb_injects) == (
        "Crue du canal", "2023-04-03", "Besancon", 41,
    )
    assert row.fichier_source == "crue v.2.xlsx"
    assert row.date_soumission.startswith("2024-05-06T07:08:09")


def test_missing_fields_are_named_in_order(spark):
    done = M.check_required(metadata_of(spark, submitter=None, lieu_exercice="", nom_fichier_excel="x"))
    assert done.valid.count() == 0
    assert done.rejected.first().reason == "Missing required metadata fields: lieu_exercice, submitter"


def test_defaults(spark):
    absent = dict.fromkeys(
        ["nom_chronogramme", "date_exercice", "lieu_exercice", "etablissement_nom", "etablissement_type", "submitter"]
    )
    row = M.with_defaults(metadata_of(spark, **absent), moment().cast("date")).first()
    assert row.nom_chronogramme == "crue v.2"
    assert (row.date_exercice, row.lieu_exercice, row.etablissement_nom, row.submitter) == (
        "2024-05-06", "N/A", "Auto", "pipeline",
    )


def names_of(spark, table, existing=()):
    rows = spark.createDataFrame(
        [(i, *r) for i, r in enumerate(table)],
        "ordinal long, file_path string, etablissement_nom string, nom_chronogramme string, date_exercice string",
    )
    taken = spark.createDataFrame([(e,) for e in existing], "file_name string")
    named = M.unique_names(rows, "ordinal", taken, moment(), width=1)
    return [r.file_name for r in named.orderBy("ordinal").collect()]


def test_structured_names(spark):
    table = [
        ("u.xlsx", "Lycée Ampère", "Gaz été", "2023-12-24"),
        ("v.XLSX", "Port à l'Est", "Feu 1/2", "24/12/2023"),
        ("w.ods", "p", "q", "r"),
    ]
    assert names_of(spark, table) == [
        "Chronogramme_lycee_ampere_gaz_ete_2023-12-24.xlsx",
        "Chronogramme_port_a_l_est_feu_1_2_2023-12-24.xlsx",
    ]


def test_name_collisions(spark):
    same = [("a.xlsx", "x", "y", "2024-01-01")] * 3
    base = "Chronogramme_x_y_2024-01-01"
    assert names_of(spark, same) == [f"{base}.xlsx", f"{base}_070809.xlsx", f"{base}_070809_2.xlsx"]
    assert names_of(spark, same[:2], [f"{base}.xlsx"]) == [f"{base}_070809.xlsx", f"{base}_070809_2.xlsx"]


FACTS = "file_id string, id_chronogramme long, id_inject string"


def test_duplicates_orphans_and_nulls(spark):
    table = [("f", 1, "a"), ("f", 1, "a"), ("f", 1, None), ("f", 1, None), ("g", 9, "b"), ("h", None, "c"), ("k", 1, "d")]
    batch = spark.createDataFrame(table, FACTS)
    dimension = spark.createDataFrame([(1,)], "id_chronogramme long")
    assert [tuple(r) for r in I.duplicate_keys(batch).collect()] == [(1, "a", 2)]
    assert [r.file_id for r in I.orphans(batch, dimension).collect()] == ["g"]
    assert [r.null_columns for r in I.not_null_violations(batch, ["id_chronogramme"]).collect()] == ["id_chronogramme"]
    gate = I.atomic_gate(batch, dimension, unit="file_id")
    assert [r.file_id for r in gate.accepted.collect()] == ["k"]
    assert sorted((r.file_id, r.reason, r.n) for r in gate.rejected.collect()) == [
        ("f", "duplicate key", 2), ("g", "unknown parent", 1), ("h", "null parent", 1),
    ]
    stored = spark.createDataFrame([(1, "d")], "id_chronogramme long, id_inject string")
    assert I.atomic_gate(batch, dimension, stored, unit="file_id").accepted.count() == 0


def test_gate_by_chronogram(spark):
    batch = spark.createDataFrame([("f", 1, "a"), ("f", 2, "a"), ("f", 2, "a"), ("f", None, "x")], FACTS)
    dimension = spark.createDataFrame([(1,), (2,)], "id_chronogramme long")
    gate = I.atomic_gate(batch, dimension)
    assert [r.id_chronogramme for r in gate.accepted.collect()] == [1]


def test_input_must_be_a_table(spark):
    with pytest.raises(TypeError):
        I.require_columns([1, 2], ["id_chronogramme"])
    with pytest.raises(TypeError):
        I.require_columns(spark.range(1), ["id_chronogramme"])


def test_required_values(spark):
    rows = spark.createDataFrame([("a", "Critique"), ("", None)], "id_inject string, type_inject string")
    found = I.required_values(rows, ["id_inject", "type_inject"]).collect()
    assert [r.missing for r in found] == ["id_inject, type_inject"]


def test_corrections_stay_inside_their_chronogram(spark):
    facts = spark.createDataFrame([(1, "Police"), (2, "Police"), (1, "SDIS")], "id_chronogramme long, emetteur string")
    log = spark.createDataFrame(
        [(1, "emetteur", "PC", "Police"), (2, "emetteur", "PO", "Police"), (1, "emetteur", "S", "SDIS")],
        "id_chronogramme long, scope string, nom_original string, champ_standard string",
    )
    edited = spark.createDataFrame(
        [("emetteur", "PC", "Poste de Commandement"), ("emetteur", "S", "SDIS"), ("emetteur", "PO", "")],
        "field string, raw string, standard string",
    )
    changed = corrections.corrections(log, edited)
    done = corrections.apply_corrections(facts, changed, ["emetteur"], ["id_chronogramme"])
    assert sorted(tuple(r) for r in done.collect()) == [
        (1, "Poste de Commandement"), (1, "SDIS"), (2, "Police"),
    ]


def test_establishments_are_unique(spark):
    dimension = spark.createDataFrame(
        [(1, "CHU", "b"), (2, "CHU", "a"), (3, "X", None), (4, None, "c")],
        "id_chronogramme long, etablissement_nom string, etablissement_type string",
    )
    known = corrections.establishments(dimension)
    assert sorted((r.nom, r.type) for r in known.collect()) == [("CHU", "a"), ("X", None)]
    linked = corrections.link_establishments(dimension, known)
    ids = {r.id_chronogramme: r.id_etablissement for r in linked.collect()}
    assert ids[1] == ids[2] != ids[3] and ids[4] is None


def test_context_meets_the_summaries_not_the_rows(spark):
    """Rows are moved once, for their numbers; those of a file without a submission are left out."""
    known = submissions(spark)
    name = known.first().file_id
    rows = spark.createDataFrame([(name, 1, None), (name, 9, "x"), ("nobody", 1, "y")], "file_id string, row_idx long, id_inject string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        done = E.enrich(rows, known, width=4)
        plan = done._jdf.queryExecution().executedPlan().toString()
        found = {r.row_idx: (r.id_inject, r.nb_injects, r.nom_chronogramme) for r in done.collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    title = known.first().nom_chronogramme
    assert found == {1: ("1", 2, title), 9: ("x", 2, title)}
    # Rows by bucket; summaries by bucket, by file and by bucket again; the submissions by file.
    assert plan.count("Exchange hashpartitioning") <= 5
    again = E.add_context(rows, known)
    assert sorted(done.columns) == sorted({*again.columns, "numero_inject", "nb_injects"})
