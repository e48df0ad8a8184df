import json

import pytest
from pyspark.sql import functions as F

from gridloom.operators import kpi as K
from gridloom.sinks.report import RunRecorder, write_report
from gridloom.sources.records import parse_run_lines, run_records, steps_of

RED, YELLOW = K.RED, K.YELLOW


@pytest.mark.parametrize(
    "resolver, unresolved, complete, sign",
    [
        (0.4, 0.1, 0.9, ""),
        (0.6, 0.2, 0.7, YELLOW),
        (0.41, 0.0, 1.0, YELLOW),
        (0.0, 0.11, 1.0, YELLOW),
        (0.0, 0.0, 0.89, YELLOW),
        (0.61, 0.0, 1.0, RED),
        (0.0, 0.21, 1.0, RED),
        (0.0, 0.0, 0.69, RED),
    ],
)
def test_limits_must_be_passed(spark, resolver, unresolved, complete, sign):
    found = spark.range(1).select(K.alert(*map(F.lit, (resolver, unresolved, complete))).alias("a"))
    assert found.first().a == sign


def test_limits_are_parameters(spark):
    strict = K.Thresholds(yellow_resolver=0.0)
    found = spark.range(1).select(K.alert(F.lit(0.1), F.lit(0.0), F.lit(1.0), strict).alias("a"))
    assert found.first().a == YELLOW


def log_of(spark, table):
    return spark.createDataFrame(table, "id_chronogramme long, methode string, champ_standard string")


def test_method_rates(spark):
    table = [(1, "règle", "a"), (1, "IA", ""), (1, "dict", None), (1, "ok", "b")]
    row = K.method_rates(log_of(spark, table)).first()
    assert (row.auto_rate, row.ia_rate, row.dict_rate, row.ok_rate, row.unresolved_rate) == (
        0.25, 0.25, 0.25, 0.25, 0.5,
    )


def test_empty_text_counts_as_filled(spark):
    columns = {c: F.lit(None).cast("string") for c in K.COUNTED}
    facts = spark.range(2).select(F.lit(1).cast("long").alias("id_chronogramme"), "id").withColumns(
        {**columns, "emetteur": F.lit(""), "id_inject": F.when(F.col("id") == 0, "x")}
    )
    assert len(K.COUNTED) == 11
    assert K.completeness(facts).first().completeness == pytest.approx(3 / 22)


def summary(*steps):
    return json.dumps({"event": "SUMMARY", "steps": list(steps)})


META = {"name": "INSERT_METADATA", "duration": 1.0, "chrono_id": 7}


def test_run_ids(spark):
    logs = {
        "run_a.log": ['{"event": "STEP_START"}', summary({"name": "X", "duration": 1.0}), summary(META)],
        "run_b.log": ["{broken", summary(META)],
        "run_c.log": [summary({**META, "chrono_id": None}), summary(META)],
        "run_d.log": [summary({**META, "chrono_id": "12"}), "{broken"],
        "run_e.log": ['{"event": "STEP_END"}'],
        "run_f.log": [summary({**META, "chrono_id": "abc"})],
    }
    lines = [(n, i, text) for n, texts in logs.items() for i, text in enumerate(texts)]
    frame = spark.createDataFrame(lines, "log_name string, ord long, line string")
    found = {r.log_name: r.chrono_id for r in K.run_ids(parse_run_lines(frame)).collect()}
    assert found == {"run_a.log": 7, "run_d.log": 12}


def test_kpi_and_report(spark, tmp_path):
    runs = spark.createDataFrame([("run_b.log", 2), ("run_a.log", 1)], "log_name string, chrono_id long")
    log = log_of(spark, [(1, "règle", "a"), (1, "règle", "b")])
    facts = spark.createDataFrame([(1,)], "id_chronogramme long").withColumns(
        {c: F.lit("x") for c in K.COUNTED}
    )
    table = K.kpi(runs, log, facts)
    found = {r.log_name: tuple(r)[2:] for r in table.collect()}
    assert found == {"run_a.log": (1.0, 0.0, 0.0, 1.0, ""), "run_b.log": (0.0, 0.0, 0.0, 0.0, RED)}
    write_report(table, str(tmp_path / "report"))
    parts = sorted((tmp_path / "report").glob("part-*"))
    lines = "".join(p.read_text(encoding="utf-8") for p in parts).splitlines()
    assert lines == [
        *K.REPORT_HEAD,
        "| run_a.log | 1 | 100.0% | 0.0% | 0.0% | 100.0% |  |",
        f"| run_b.log | 2 | 0.0% | 0.0% | 0.0% | 0.0% | {RED} |",
    ]


def test_recorder_writes_what_the_monitor_reads(spark, tmp_path):
    recorder = RunRecorder("t1")
    with recorder.step("INSERT_METADATA") as metrics:
        metrics["chrono_id"] = 5
    with recorder.step("CLEAN_DATA") as metrics:
        seen = recorder.observe(spark.range(12), "clean")
        assert seen.count() == 12
        metrics["rows"] = recorder.rows("clean")
    recorder.write(spark, str(tmp_path))
    records = run_records(spark, str(tmp_path))
    assert [tuple(r) for r in K.run_ids(records).collect()] == [("run_t1.log", 5)]
    events = [r.event for r in records.orderBy("ord").collect()]
    assert events[0] == "STEP_START" and events[-1] == "SUMMARY"
    row = K.run_summary(steps_of(records)).first()
    assert row.status == "SUCCES" and [s.name for s in row.steps] == ["INSERT_METADATA", "CLEAN_DATA"]
    assert recorder.steps[1]["rows"] == 12


def test_failed_step_fails_the_run(spark):
    recorder = RunRecorder("t2")
    with pytest.raises(ValueError):
        with recorder.step("X"):
            raise ValueError("no header row")
    assert recorder.summary()["status"] == "ECHEC"
    assert recorder.steps[0]["error"] == "no header row"


def test_batch_outcome(spark):
    files = spark.createDataFrame([("a.xlsx",), ("b.xlsx",)], "file_name string")
    dimension = spark.createDataFrame([(42, "a.xlsx")], "id_chronogramme long, fichier_source string")
    found = sorted(tuple(r) for r in K.batch_outcome(files, dimension).collect())
    assert found == [("a.xlsx", 42, "OK"), ("b.xlsx", None, "ERROR")]
