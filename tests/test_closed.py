"""Nothing is lost or accepted in silence: gates, appends, keys, stages, partitions."""

import pytest
from pyspark.sql import functions as F

from driftloom.operators import gates, logstate
from driftloom.operators.metrics import regression_metrics
from driftloom.sources import tables


def test_unpredicted_and_nan_rows_fail_gates(spark):
    rows = [("a", 1.0, 1.0), ("a", 2.0, 2.0), ("b", 1.0, 1.0), ("b", 2.0, None), ("b", 3.0, 3.0), ("c", 1.0, None), ("c", 2.0, None), ("d", 1.0, float("nan")), ("d", 2.0, 2.0)]
    df = spark.createDataFrame(rows, "g string, label double, prediction double")
    metrics = regression_metrics(df, group_cols=["g"], metrics=["r2"])
    got = {r["g"]: r["passed"] for r in gates.threshold_gate(metrics, {"r2": 0.65}, ["g"]).collect()}
    assert got == {"a": True, "b": False, "c": False, "d": False}
    base = metrics.withColumn("value", F.lit(0.9))
    assert {r["g"]: r["passed"] for r in gates.baseline_gate(metrics, base, ["g"]).collect()} == got
    loss = gates.performance_degradation(metrics, base, ["g"]).collect()
    assert {r["g"]: r["is_degraded"] for r in loss} == {k: not v for k, v in got.items()}
    counts = regression_metrics(df, group_cols=["g"], metrics=["n_rows", "n_unpredicted"]).collect()
    assert {(r["g"], r["metric"]): r["value"] for r in counts if r["g"] in "bc"} == {("b", "n_rows"): 3, ("b", "n_unpredicted"): 1, ("c", "n_rows"): 2, ("c", "n_unpredicted"): 2}


def test_append_refuses_unknown_columns(spark):
    tables.append_rows(spark.range(2), "closed_log")
    with pytest.raises(ValueError, match="extra"):
        tables.append_rows(spark.range(1).withColumn("extra", F.lit(1)), "closed_log")
    assert spark.table("closed_log").count() == 2
    spark.sql("DROP TABLE closed_log")


def test_location_of_a_table_with_a_location_column(spark):
    spark.range(1).select("id", F.lit("x").alias("Location")).write.saveAsTable("closed_place")
    assert tables.table_location(spark, "closed_place").endswith("closed_place")
    spark.sql("DROP TABLE closed_place")


def test_two_new_rows_with_one_key_need_an_order(spark):
    new = spark.createDataFrame([(1, "a"), (1, "b")], "k int, v string")
    with pytest.raises(Exception, match="several new rows"):
        tables.newest_rows(new, ["k"]).collect()
    assert tables.newest_rows(new, ["k"], ["v"]).first()["v"] == "b"


def test_partitioned_upsert_reads_touched_partitions_only(spark):
    old = spark.createDataFrame([(i, f"p{i % 4}", i) for i in range(40)] + [(90, None, 9)], "k int, part string, v int")
    tables.write_table(old, "closed_parts", partition_by=["part"])
    plans = []
    real = tables.replace_rows

    def watched(affected, newest, keys):
        plans.append(affected._jdf.queryExecution().executedPlan().toString())
        return real(affected, newest, keys)

    tables.replace_rows = watched
    try:
        tables.upsert_table(spark.createDataFrame([(1, "p1", -1), (91, None, -2)], "k int, part string, v int"), "closed_parts", ["k", "part"], partition_col="part")
    finally:
        tables.replace_rows = real
    assert "PartitionFilters: [" in plans[0] and "PartitionFilters: []" not in plans[0]
    got = {(r["k"], r["part"]): r["v"] for r in spark.table("closed_parts").collect()}
    assert len(got) == 42 and got[(1, "p1")] == -1 and got[(91, None)] == -2 and got[(90, None)] == 9
    spark.sql("DROP TABLE closed_parts")


def test_unknown_stages_are_refused(spark):
    log = spark.createDataFrame([("m", 1, 1, "Live")], "model string, version int, at int, stage string")
    with pytest.raises(Exception, match="unknown stage Live"):
        logstate.fold_stages(log, ["model"], ["version"], ["at"]).collect()
