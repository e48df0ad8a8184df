"""What a batch leaves behind: ids, ranges, key filters, counts, staged entries."""

import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from gridloom.operators.kpi import fact_counts, method_counts
from gridloom.plans.submissions import submit
from gridloom.sinks.dictionaries import HEADER_KEYS, DictionaryStore
from gridloom.sinks.key_filter import may_hold, words_of
from gridloom.sinks.ledger import PARENT, Ledger
from gridloom.sinks.store import Store
from gridloom.sources.paths import remove
from gridloom.streaming.new_files import append_once
from test_flow import GOOD, run, state, stores

FACTS = "id_chronogramme long, id_inject string, horodatage string"


def store_of(spark, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    store.create()
    return store


def facts_of(spark, chrono, n, first=0):
    return spark.createDataFrame([(chrono, str(i), f"T{i}") for i in range(first, first + n)], FACTS)


def spoil(folder):
    """Make the data files of a folder unreadable."""
    found = list(Path(folder).rglob("*.parquet"))
    assert found
    for path in found:
        path.write_bytes(b"spoilt")
        path.with_name(f".{path.name}.crc").unlink(missing_ok=True)


# Ids


def test_files_keep_their_ids(spark, tmp_path):
    ledger = Ledger(spark, str(tmp_path))
    files = spark.createDataFrame([(f"f{i}",) for i in range(5)], "file_id string")

    def ids(batch, rows, after=0):
        return {r.file_id: r.id_chronogramme for r in ledger.with_ids(rows, batch, after).collect()}

    first = ids("b1", files)
    assert sorted(first.values()) == [1, 2, 3, 4, 5]
    second = ids("b2", files)
    assert sorted(second.values()) == [6, 7, 8, 9, 10]
    assert ids("b1", files) == first and ids("b2", files) == second
    # Files that come later get new numbers, the others keep theirs.
    more = files.unionByName(spark.createDataFrame([("g",)], "file_id string"))
    assert ids("b1", more) == first | {"g": 11}
    assert ids("b1", files.where("file_id < 'f2'")) == {k: v for k, v in first.items() if k < "f2"}
    assert ids("b3", files.where("false")) == {}
    assert ids("b4", files.where("file_id = 'f0'"), after=100) == {"f0": 101}


def test_a_range_without_ids_is_not_given_again(spark, tmp_path):
    """A batch that broke off between both writes: its numbers stay unused."""
    ledger = Ledger(spark, str(tmp_path))
    ledger._after("b1", 3, 0)
    files = spark.createDataFrame([("a",)], "file_id string")
    assert ledger.with_ids(files, "b2").first().id_chronogramme == 4
    assert ledger.with_ids(files, "b1").first().id_chronogramme == 5
    assert ledger.last(PARENT) == 5


def test_replayed_flow_keeps_ids(spark, tmp_path):
    parts = stores(spark, tmp_path)
    one = {("a", 1, "S"): GOOD, ("b", 1, "S"): GOOD}
    run(spark, parts, one, ["a", "b"], batch="b1")
    run(spark, parts, {("c", 1, "S"): GOOD}, ["c"], batch="b2")
    before = state(parts[0])
    run(spark, parts, one, ["a", "b"], batch="b1")
    assert state(parts[0]) == before


def test_submissions_keep_ids_by_batch(spark, tmp_path):
    store = store_of(spark, tmp_path)
    table = [(i, f"f{i}", f"/depot/{i}.xlsx", "Port", f"n{i}", "24/12/2023") for i in (1, 2)]
    columns = "ordinal long, file_id string, file_path string, etablissement_nom string, nom_chronogramme string, date_exercice string"
    rows = spark.createDataFrame(table, columns).selectExpr(
        "*", "'quai' AS lieu_exercice", "'port' AS etablissement_type", "'e' AS submitter", "'7' AS nb_injects"
    )

    def ids(part, batch):
        return {r.file_id: r.id_chronogramme for r in submit(store, part, "/in", "ordinal", batch_id=batch).collect()}

    assert ids(rows.where("ordinal = 2"), "m1") == {"f2": 1}
    assert ids(rows, "m2") == {"f1": 2, "f2": 3}
    assert ids(rows.where("ordinal = 2"), "m1") == {"f2": 1}
    assert store.dimension().count() == 3
    # Without a batch ids go on after all that were given.
    assert ids(rows.where("ordinal = 1"), None) == {"f1": 4}


def test_global_ids_need_no_stored_fact(spark, tmp_path):
    store = store_of(spark, tmp_path)
    store.append_facts(facts_of(spark, 1, 5), "b1")
    spoil(f"{store.base}/facts/batch_id=b1")
    store.append_facts(facts_of(spark, 2, 4), "b2")
    store.append_facts(facts_of(spark, 2, 4), "b2")

    def own():
        return sorted(r.id_inject_global for r in store.facts().where("batch_id = 'b2'").collect())

    assert own() == [6, 7, 8, 9]
    # A batch that grows takes a range beyond all others.
    store.append_facts(facts_of(spark, 3, 2), "b3")
    store.append_facts(facts_of(spark, 2, 6), "b2")
    assert own() == list(range(12, 18))


def test_stores_without_ranges_go_on(spark, tmp_path):
    """Facts that lie there from before ranges, filters and counts were kept."""
    store = store_of(spark, tmp_path)
    store.append_facts(facts_of(spark, 1, 5), "b1")
    for name in ("ranges", "key_filter", "fact_counts"):
        remove(spark, f"{store.base}/{name}")
    store.append_facts(facts_of(spark, 2, 2), "b2")
    assert sorted(r.id_inject_global for r in store.facts().collect()) == list(range(1, 8))
    assert store.facts_like(facts_of(spark, 1, 1)).count() == 5
    counts = {r.id_chronogramme: (r.n_rows, r.n_filled) for r in store.fact_counts().collect()}
    assert counts == {1: (5, 10), 2: (2, 4)}


# Key filters


@pytest.mark.parametrize("n", [1, 70, 3000])
def test_filters_miss_no_key(spark, n):
    rng = random.Random(n)
    rows = [(rng.randrange(3), i % 7, str(rng.randrange(10**9))) for i in range(n)] + [(0, None, "x"), (0, 1, None)]
    held = spark.createDataFrame(rows, "id_bucket long, a long, b string")
    words = words_of(held, ["a", "b"]).withColumn("batch_id", F.lit("b1"))
    found = may_hold(held, words, ["a", "b"]).collect()
    assert {r.id_bucket for r in found} == {k for k, a, b in rows if a is not None and b is not None}
    # Each stored key passes alone; of others few do.
    some = [r for r in rows if None not in r][:20]
    for row in some:
        one = spark.createDataFrame([row], held.schema)
        assert [tuple(r) for r in may_hold(one, words, ["a", "b"]).collect()] == [("b1", row[0])] or n > 70
        if n > 70:
            break


def test_few_new_keys_pass(spark):
    held = spark.range(20_000).selectExpr("0L AS id_bucket", "id AS a", "'k' AS b")
    words = words_of(held, ["a", "b"]).withColumn("batch_id", F.lit("b1")).cache()
    passed = sum(
        may_hold(held.where(f"a = {i}").withColumn("b", F.lit("new")), words, ["a", "b"]).count() for i in range(12)
    )
    assert passed <= 2


def test_only_folders_that_may_match_are_read(spark, tmp_path):
    store = store_of(spark, tmp_path)
    store.append_facts(facts_of(spark, 5, 40).unionByName(facts_of(spark, 5005, 40)), "b1")
    store.append_facts(facts_of(spark, 5, 40, first=100), "b2")
    keys = facts_of(spark, 5005, 3, first=38)
    likely = store.facts_like(keys)
    assert likely.select("batch_id").distinct().count() == 1
    plan = likely._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "id_bucket" in plan.split("PartitionFilters: [")[1].split("]")[0]
    # The other folders could not even be read.
    spoil(f"{store.base}/facts/batch_id=b1/id_bucket=0")
    spoil(f"{store.base}/facts/batch_id=b2")
    append_once(store, "s")(keys, 0)
    new = store.facts().where("batch_id = 's-0'").collect()
    assert [(r.id_chronogramme, r.id_inject) for r in new] == [(5005, "40")]
    assert store.facts_like(facts_of(spark, 5, 0)).count() == 0


# Counts


def test_counts_add_up_without_history(spark, tmp_path):
    store = store_of(spark, tmp_path)
    log = "id_chronogramme long, scope string, nom_original string, champ_standard string, methode string"
    store.append_facts(facts_of(spark, 1, 5), "b1")
    store.append_facts(facts_of(spark, 1, 3, first=50).withColumn("horodatage", F.lit(None).cast("string")), "b2")
    store.append_log(spark.createDataFrame([(1, "h", "A", "x", "dict"), (1, "h", "B", "", "IA")], log), "b1")
    store.append_log(spark.createDataFrame([(1, "h", "C", "y", "règle"), (2, "h", "D", None, "ok")], log), "b2")
    whole = sorted(map(tuple, fact_counts(store.facts()).collect()))
    entries = sorted(map(tuple, method_counts(store.mapping_log()).collect()))
    for name in ("facts", "mapping_log"):
        for batch in ("b1", "b2"):
            spoil(f"{store.base}/{name}/batch_id={batch}")
    assert sorted(map(tuple, store.fact_counts().collect())) == whole == [(1, 8, 13)]
    assert sorted(map(tuple, store.method_counts().collect())) == entries
    # A batch under way is not counted.
    store.begin("b2")
    assert sorted(map(tuple, store.fact_counts().collect())) == [(1, 5, 10)]


# Staged entries


def entries(spark, *rows):
    return spark.createDataFrame(list(rows), "raw string, standard string")


def test_staged_entries_wait_for_their_batch(spark, tmp_path):
    words = DictionaryStore(spark, str(tmp_path / "d"), HEADER_KEYS)
    words.add(entries(spark, ("a", "1")))
    words.stage(entries(spark, ("a", "2"), ("b", "3")), "b1")

    def seen(hidden=None):
        return sorted((r.raw, r.standard) for r in words.read(hidden).collect())

    assert seen() == seen(["b1"]) == [("a", "1")]
    assert seen([]) == [("a", "2"), ("b", "3")]
    words.settle(["b1"])
    assert words.staged() == {"b1"} and words.table.version() == 1
    words.settle([])
    words.settle([])
    assert seen() == [("a", "2"), ("b", "3")] and words.staged() == set() and words.table.version() == 2


def test_a_broken_run_teaches_nothing(spark, tmp_path):
    from gridloom.operators.resolvers import table_resolver

    parts = stores(spark, tmp_path)
    answers = spark.createDataFrame([("header", "Quand", "horodatage")], "scope string, key string, standard string")
    options = {"header_resolver": table_resolver(answers), "header_policy": "resolve"}
    sheet = {("a", 1, "S"): [["Quand", "Descriptif", "Type d'inject"], ["T0", "x", "Majeur"], ["T1", "y", "Majeur"]]}

    class Broken(Store):
        def append_dimension(self, rows, batch_id=None):
            raise OSError("no space")

    def taught():
        return "Quand" in {r.raw for r in parts[1].read(parts[0].open_batches()).collect()}

    with pytest.raises(OSError):
        run(spark, (Broken(spark, parts[0].base), *parts[1:]), sheet, ["a"], **options)
    assert not taught()
    run(spark, parts, sheet, ["a"], **options)
    assert taught() and parts[1].staged() == set()
    assert {r.id_chronogramme for r in parts[0].dimension().collect()} == {1}


# The streamed intake


def test_streamed_workbooks(spark, tmp_path):
    from checks.q_io import workbook_bytes
    from gridloom.plans.intake import Options
    from gridloom.streaming.intake import intake_files
    from gridloom.streaming.new_files import process_new_files
    from test_flow import SCHEMA

    parts = stores(spark, tmp_path)
    inbox = tmp_path / "in"
    inbox.mkdir()
    grid = {r: dict(enumerate(line, 1)) for r, line in enumerate(GOOD, 1)}
    (inbox / "a.xlsx").write_bytes(workbook_bytes({"S": grid}))
    (inbox / "bad.xlsx").write_bytes(b"no workbook")
    results = []
    handle = intake_files(*parts, "inbox", Options(schema=SCHEMA), done=results.append)

    def twice(files, batch_id):
        handle(files, batch_id)
        handle(files, batch_id)

    for _ in range(2):
        process_new_files(spark, str(inbox), twice, str(tmp_path / "cp"))
    assert len(results) == 2
    assert {(r.file_name, r.status) for r in results[0].outcome.collect()} == {("a.xlsx", "OK"), ("bad.xlsx", "ERROR")}
    assert [(r.nom_chronogramme, r.nb_injects) for r in parts[0].dimension().collect()] == [("a", 2)]
    assert sorted(r.id_inject_global for r in parts[0].facts().collect()) == [1, 2]


