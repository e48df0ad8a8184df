import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gridloom.operators import lookup
from gridloom.operators.lookup import fits_broadcast, latest_per_key, lookup_join
from gridloom.operators.ordered import carry_forward, number_any, previous_ordinal, running_count

values = st.lists(
    st.tuples(st.sampled_from("ab"), st.one_of(st.none(), st.integers(0, 9))), min_size=1, max_size=60
)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(values, st.integers(1, 70))
def test_bucketed_forms_equal_single_windows(spark, pairs, width):
    table = [(k, i, v) for i, (k, v) in enumerate(pairs)]
    pdf = pd.DataFrame(table, columns=["k", "o", "v"], dtype=object)
    frame = spark.createDataFrame(table, "k string, o long, v int")
    filled = carry_forward(frame, ["k"], "o", ["v"], width)
    want = pdf.assign(v=pdf.groupby("k")["v"].ffill())
    got = filled.orderBy("o").toPandas()
    assert [None if pd.isna(x) else int(x) for x in got["v"]] == [
        None if pd.isna(x) else int(x) for x in want["v"]
    ]

    counted = running_count(
        frame, ["k"], "o", "n", F.col("v").isNull(), width, total="t", flagged_total="nt"
    ).orderBy("o").collect()
    nulls = pdf["v"].isna().astype(int)
    assert [r.n for r in counted] == list(nulls.groupby(pdf["k"]).cumsum())
    assert [r.t for r in counted] == list(pdf.groupby("k")["o"].transform("size"))
    assert [r.nt for r in counted] == list(nulls.groupby(pdf["k"]).transform("sum"))

    linked = previous_ordinal(frame, ["k"], "o", "p", width).orderBy("o").collect()
    before = pdf.groupby("k")["o"].shift()
    assert [r.p for r in linked] == [None if pd.isna(x) else int(x) for x in before]


def test_number_any_is_dense_and_stable(spark):
    frame = spark.range(500).select(F.concat(F.lit("x"), "id").alias("name"))
    first = {r.name: r.n for r in number_any(frame, ["name"], "n", 16).collect()}
    again = {r.name: r.n for r in number_any(frame.repartition(7), ["name"], "n", 16).collect()}
    assert sorted(first.values()) == list(range(1, 501))
    assert first == again


def test_lookup_join_is_the_same_on_both_paths(spark):
    hot = spark.range(3000).select(
        "id", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 50)).alias("key")
    )
    entries = spark.range(50).select(F.concat(F.lit("k"), "id").alias("key"), F.col("id").alias("v"))
    entries = entries.unionByName(spark.createDataFrame([("hot", -1)], "key string, v long"))
    hot = hot.unionByName(spark.range(3000, 3400).select("id", F.lit(None).cast("string").alias("key")))
    assert fits_broadcast(entries) and not fits_broadcast(entries, 3)
    assert not fits_broadcast(entries, max_bytes=10)
    assert {r.key for r in lookup.heavy_keys(hot.where("key IS NOT NULL"), ["key"], 200).collect()} == {"hot"}
    for how in ("left", "inner", "left_semi", "left_anti"):
        some = entries.where("v < 20")
        small = lookup_join(hot, some, ["key"], ["id"], how)
        salted = lookup_join(hot, some, ["key"], ["id"], how, max_rows=3, heavy_rows=200)
        assert "__salt" in salted._jdf.queryExecution().optimizedPlan().toString()
        assert small.exceptAll(salted).count() == salted.exceptAll(small).count() == 0


def test_only_heavy_keys_are_repeated(spark):
    rows = spark.range(1000).select("id", F.when(F.col("id") < 600, -1).otherwise(F.col("id")).alias("k"))
    table = rows.select("k").distinct().withColumn("v", F.lit(1))
    joined = lookup_join(rows, table, ["k"], ["id"], max_rows=3, heavy_rows=100)
    per_task = joined.withColumn("t", F.spark_partition_id())
    assert joined.count() == 1000
    joined.sparkSession.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        spread = per_task.where("k = -1").select("t").distinct().count()
    finally:
        joined.sparkSession.conf.set("spark.sql.adaptive.enabled", "true")
    assert spread > 1


def test_last_duplicate_wins(spark):
    table = [("a", "x", 1), ("a", "y", 2), ("b", "z", 3)]
    entries = spark.createDataFrame(table, "raw string, standard string, line_no long")
    found = {r.raw: r.standard for r in latest_per_key(entries, ["raw"]).collect()}
    assert found == {"a": "y", "b": "z"}


@pytest.mark.parametrize("function", [carry_forward, previous_ordinal])
def test_no_window_spans_a_whole_key(spark, function):
    frame = spark.range(1000).select(F.lit("k").alias("k"), F.col("id").alias("o"), F.lit(1).alias("v"))
    last = ["v"] if function is carry_forward else "p"
    plan = function(frame, ["k"], "o", last, 100)._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.split("\n") if "Window [" in line]
    # One window inside buckets, one over bucket summaries.
    assert len(windows) == 2
    assert sum("__bucket" in w.split("windowspecdefinition(")[1].split("ASC")[0] for w in windows) == 2


def test_null_ordinals_are_an_error(spark):
    from gridloom.operators import metadata

    rows = spark.createDataFrame([("a", 1), ("b", None)], "file_id string, ordinal long")
    with pytest.raises(Exception, match="null in"):
        metadata.assign_ids(rows, 0, "ordinal").collect()
