import pytest
from pyspark.sql import functions as F

from gridloom.model import FIELDS
from gridloom.operators import growth, headers as H, values as V
from gridloom.operators.resolvers import (
    function_resolver,
    nearest_resolver,
    no_resolver,
    resolve_keys,
    table_resolver,
)


def headers_of(spark, names, file_id="f"):
    return spark.createDataFrame(
        [(file_id, 1, i, n) for i, n in enumerate(names, 1)],
        "file_id string, sheet_idx long, col_idx long, raw_header string",
    )


def dictionary(spark, pairs):
    return spark.createDataFrame(
        [(a, b, i) for i, (a, b) in enumerate(pairs)], "raw string, standard string, line_no long"
    )


def value_dictionary(spark, triples):
    return spark.createDataFrame(
        [(f, a, b, i) for i, (f, a, b) in enumerate(triples)],
        "field string, raw string, standard string, line_no long",
    )


def values_of(spark, field, values, file_id="f"):
    return spark.createDataFrame(
        [(file_id, i, field, v) for i, v in enumerate(values, 1)],
        "file_id string, row_idx long, field string, value string",
    )


def names(frame, column="standard"):
    return [r[column] for r in frame.orderBy("file_id", "col_idx").collect()]


def test_dictionary_before_resolver(spark):
    fields = ["Contenu", "Destinataire", "Modalité"]
    asked = spark.sparkContext.accumulator(0)

    def suggest(text, allowed):
        asked.add(1)
        assert text == "Destinataires" and list(allowed) == fields
        return "Destinataire"

    found = headers_of(spark, ["Descriptif", " Destinataires ", "", "Destinataires"])
    done = H.standardize_headers(
        found,
        dictionary(spark, [("Descriptif", "Contenu")]),
        fields,
        function_resolver(suggest, {"header": fields}),
    )
    assert names(done.headers) == ["Contenu", "Destinataire", "", "Destinataire"]
    assert names(done.headers, "method") == ["dict", "IA", None, "dict"]
    assert asked.value == 1
    learned = growth.learned_headers(done.learned).collect()
    assert [tuple(r) for r in learned] == [("Destinataires", "Destinataire")]
    assert H.header_log(done.headers).count() == 3


def test_rules_ignore_case_and_log_misses(spark):
    entries = dictionary(spark, [("Été", "saison"), ("Quai NORD", "lieu")])
    done = H.by_rules(headers_of(spark, ["ETE", "quai nord", "grue"]), entries)
    assert names(done) == ["saison", "lieu", ""]
    assert names(done, "method") == ["règle"] * 3


def test_empty_standard_is_a_miss_and_last_duplicate_wins(spark):
    entries = dictionary(spark, [("a", "x"), ("a", ""), ("b", "y"), ("b", "z"), ("c", None)])
    assert names(H.by_exact(headers_of(spark, ["a", "b", "c"]), entries)) == [None, "z", None]


def test_one_unresolved_header_sends_the_file_to_the_rules(spark):
    entries = dictionary(spark, [("Heure", "horodatage"), (" Canal ", "modalite")])
    found = headers_of(spark, ["Heure", "CANAL", "autre"], "f").unionByName(
        headers_of(spark, ["Heure"], "g")
    )
    done = H.standardize_headers(found, entries, FIELDS, policy="rules_if_unresolved").headers
    assert names(done) == ["horodatage", "modalite", "", "horodatage"]
    assert names(done, "method") == ["règle", "règle", "règle", "dict"]


def test_repeated_answers_over_files(spark):
    reviewed = spark.createDataFrame(
        [("header", "x", "Contenu")], "scope string, key string, standard string"
    )
    found = headers_of(spark, ["x", "x"], "f").unionByName(headers_of(spark, ["x"], "g"))
    empty = dictionary(spark, [("other", "y")])
    per_file = H.standardize_headers(found, empty, ["Contenu"], table_resolver(reviewed))
    assert names(per_file.headers, "method") == ["IA", "dict", "IA"]
    overall = H.standardize_headers(
        found, empty, ["Contenu"], table_resolver(reviewed), repeat_scope="all"
    )
    assert names(overall.headers, "method") == ["IA", "dict", "dict"]


def test_static_rename_and_canonical(spark):
    found = headers_of(spark, ["Heure", "Descriptif", "Émetteur", "Cellule concernée", "Canal", ""])
    assert names(H.by_known_names(found)) == [
        "Horodatage", "Contenu", "Emetteur", "Destinataire", "Modalité", "Inconnu",
    ]
    renamed = H.by_rename(headers_of(spark, ["HEURE", "Été"]), dictionary(spark, [("heure", "Début")]))
    assert names(renamed) == ["debut", "ete"]
    texts = ["Émetteur du type", "Destinataire", "Modalité", "Nature", "type", "x", None]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    fields = [r.f for r in frame.select("i", H.canonical_field(F.col("t")).alias("f")).orderBy("i").collect()]
    assert fields == ["emetteur", "destinataire", "modalite", "type_inject", "type_inject", None, None]


def test_first_column_feeds_a_field(spark):
    named = headers_of(spark, ["a", "b", "c", "d"]).withColumn(
        "standard", F.element_at(F.array(*map(F.lit, ["description", "description", "IGNORE", ""])), F.col("col_idx").cast("int"))
    )
    picked = H.pick_columns(named, FIELDS).collect()
    assert [(r.field, r.col_idx) for r in picked] == [("description", 1)]
    dropped = {r.raw_header: r.reason for r in H.dropped_columns(named, FIELDS).collect()}
    assert dropped == {"b": "repeated", "c": "not in schema", "d": "not in schema"}


def test_pivot_columns_do_not_depend_on_the_data(spark):
    long = spark.createDataFrame(
        [("f", 1, "modalite", "SMS"), ("f", 1, None, "lost"), ("f", 2, None, "x")],
        "file_id string, row_idx long, field string, value string",
    )
    wide = H.to_wide(long, ["file_id", "row_idx"], FIELDS, ("has_", ["modalite"]))
    assert wide.columns == ["file_id", "row_idx", *FIELDS, "has_modalite"]
    found = {r.row_idx: (r.modalite, r.has_modalite) for r in wide.collect()}
    assert found == {1: ("SMS", True), 2: (None, False)}


ALLOWED = {"type_inject": ["Critique", "Important", "Secondaire"], "modalite": ["Email", "SMS"]}


def test_value_flow_with_resolver(spark):
    asked = spark.sparkContext.accumulator(0)

    def suggest(text, allowed):
        asked.add(1)
        return "Important"

    entries = value_dictionary(
        spark, [("type_inject", "majeur", "Critique"), ("modalite", "courriel", "Email")]
    )
    both = values_of(spark, "type_inject", ["Majeur", "Critique", "Élevé", "ELEVE", None]).unionByName(
        values_of(spark, "modalite", ["SMS", "Courriel", "SMS"])
    )
    done = V.standardize_values(both, entries, ALLOWED, function_resolver(suggest, ALLOWED))
    found = {(r.field, r.row_idx): (r.standard, r.method) for r in done.values.collect()}
    assert [found["type_inject", i] for i in range(1, 6)] == [
        ("Critique", "dict"), ("Critique", "ok"), ("Important", "IA"), ("Important", "dict"), (None, None),
    ]
    assert [found["modalite", i][0] for i in range(1, 4)] == ["SMS", "Email", "SMS"]
    assert asked.value == 1
    assert [tuple(r) for r in growth.learned_values(done.learned).collect()] == [
        ("type_inject", "eleve", "Important")
    ]
    assert V.value_log(done.values).count() == 7


def test_standardizing_twice_changes_nothing(spark):
    entries = value_dictionary(spark, [("type_inject", "majeur", "Critique")])
    first = V.standardize_values(
        values_of(spark, "type_inject", ["Majeur", "Important"]), entries, ALLOWED
    ).values
    again = first.select("file_id", "row_idx", "field", F.col("standard").alias("value"))
    second = V.standardize_values(again, entries, ALLOWED).values
    assert [r.standard for r in second.orderBy("row_idx").collect()] == ["Critique", "Important"]


def test_answers_outside_the_list_are_refused(spark):
    unresolved = spark.createDataFrame(
        [("type_inject", "grave", "Grave"), ("libre", "x", "X"), ("type_inject", "y", "y")],
        "scope string, key string, raw string",
    )
    answers = {"Grave": "Autre", "X": "Libre", "y": " Critique "}
    ask = function_resolver(lambda text, allowed: answers[text], ALLOWED)
    strict = resolve_keys(unresolved, ask, ALLOWED)
    assert sorted(tuple(r) for r in strict.accepted.collect()) == [
        ("libre", "x", "Libre"), ("type_inject", "y", "Critique"),
    ]
    assert [r.key for r in strict.refused.collect()] == ["grave"]
    assert resolve_keys(unresolved, ask, ALLOWED, strict=False).accepted.count() == 3
    assert resolve_keys(unresolved, no_resolver, ALLOWED).accepted.count() == 0


def test_nearest_takes_the_first_of_equal_distance(spark):
    unresolved = spark.createDataFrame(
        [("m", "emial", "Emial"), ("m", "sns", "SNS"), ("m", "telegramme", "Télégramme"), ("n", "sms", "SMS")],
        "scope string, key string, raw string",
    )
    near = nearest_resolver({"m": ["Email", "SMS", "Sos"]}, 2)
    found = {(r.scope, r.key): r.standard for r in near(unresolved).collect()}
    assert found == {("m", "emial"): "Email", ("m", "sns"): "SMS"}


def test_exact_replacement_is_not_chained(spark):
    entries = value_dictionary(
        spark, [("c", "a", "b"), ("c", "b", "z"), ("c", "b", "c"), ("other", "a", "q"), ("c", "n", "")]
    )
    done = V.standardize_exact(values_of(spark, "c", ["a", "b", "n", None, "A"]), entries)
    assert [r.value for r in done.orderBy("row_idx").collect()] == ["b", "c", "n", None, "A"]
    wide = spark.createDataFrame([(1, "a"), (2, None)], "i int, c string")
    assert [r.c for r in V.standardize_exact_wide(wide, entries, ["c"], ["i"]).orderBy("i").collect()] == ["b", None]


def test_allowed_filter_splits_all_rows(spark):
    table = [("Critique", "SMS"), ("Critique", "Fax"), (None, "SMS"), ("x", "y")]
    frame = spark.createDataFrame(table, "type_inject string, modalite string")
    kept, rejected = V.filter_allowed(frame, ALLOWED)
    assert kept.count() + rejected.count() == len(table)
    assert sorted(r.reason for r in rejected.collect()) == [
        "not allowed: modalite", "not allowed: type_inject", "not allowed: type_inject, modalite",
    ]
    flagged = frame.withColumns({"has_type_inject": F.lit(False), "has_modalite": F.lit(True)})
    assert V.filter_allowed(flagged, ALLOWED, "has_").kept.count() == 2


def test_only_fields_with_entries_or_lists_are_touched(spark):
    entries = value_dictionary(spark, [("modalite", "a", "b"), ("unknown", "a", "b")])
    allowed = {"type_inject": ["Critique"]}
    assert V.touched_fields(entries, allowed, FIELDS) == ["type_inject", "modalite"]
    both = values_of(spark, "description", ["free"]).unionByName(values_of(spark, "modalite", ["q"]))
    done = V.standardize_values(both, entries, allowed, fields=["type_inject", "modalite"]).values
    assert {r.field: r.method for r in done.collect()} == {"description": None, "modalite": "IA"}


def test_new_values_of_canonical_columns(spark):
    table = [("A", "X", "Maj", "SMS"), ("B", "Y", "Min", "Mail")]
    columns = ["Emetteur", "Destinataire", "Type d'inject", "Modalite"]
    wide = spark.createDataFrame(table, columns)
    long = wide.unpivot([], columns, "header", "value")
    empty = spark.createDataFrame([], "field string, raw string, standard string")
    added = growth.new_values(long, empty).collect()
    assert len(added) == 8
    counts = {f: sum(r.field == f for r in added) for f in {r.field for r in added}}
    assert counts == {"emetteur": 2, "destinataire": 2, "type_inject": 2, "modalite": 2}
    known = spark.createDataFrame([("emetteur", "A")], "field string, raw string")
    assert growth.new_values(long, known).count() == 7


def test_new_headers_and_counts(spark):
    first = [f"h{i}" for i in range(12)]
    second = [f"h{i}" for i in range(10, 21)]
    found = headers_of(spark, first, "f").unionByName(headers_of(spark, second, "g"))
    added = growth.new_headers(found, dictionary(spark, [("h0", "")]))
    counts = growth.header_growth_counts(found, added).first()
    assert (counts.total_headers, counts.new_headers) == (23, 20)


@pytest.mark.parametrize("limit, want", [(2, ["a", "b"]), (9, ["a", "b", "c"])])
def test_file_budget(spark, limit, want):
    files = spark.createDataFrame([("c",), ("a",), ("b",)], "path string")
    assert [r.path for r in growth.file_budget(files, limit).collect()] == want


def test_merge_prefers_the_added_entry(spark):
    current = spark.createDataFrame([("a", ""), ("b", "x")], "raw string, standard string")
    added = spark.createDataFrame([("a", "new"), ("c", "y")], "raw string, standard string")
    merged = growth.merge_entries(current, added, ["raw"])
    assert {r.raw: r.standard for r in merged.collect()} == {"a": "new", "b": "x", "c": "y"}


def test_no_row_at_a_time_python_in_value_plans(spark):
    entries = value_dictionary(spark, [("type_inject", "majeur", "Critique")])
    done = V.classify(values_of(spark, "type_inject", ["Élevé"]), entries, ALLOWED)
    plan = done._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Python" not in plan
