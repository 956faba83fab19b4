import pytest
from pyspark.sql import functions as F

from driftloom.operators import gates, logstate, metrics
from driftloom.plans.validation import retrain_run, validate_run


def values(long):
    return {r.metric: r.value for r in long.collect()}


def pairs(spark, y, p):
    return spark.createDataFrame(list(zip(y, p)), "label double, prediction double")


def test_regression_metrics(spark):
    df = pairs(spark, [3.0, 5.0, 2.0, 7.0], [2.5, 5.0, 4.0, 8.0])
    got = values(metrics.regression_metrics(df, metrics=["mse", "mae", "rmse", "r2", "mape"]))
    expected = {"mse": 1.3125, "mae": 0.875, "rmse": 1.145644, "r2": 0.644068, "mape": 0.327381}
    assert {k: round(v, 6) for k, v in got.items()} == expected
    assert set(values(metrics.regression_metrics(df, prefix="val_"))) == {"val_mse", "val_mae", "val_rmse", "val_r2"}


def test_r2_of_a_constant_label_and_of_one_row(spark):
    assert values(metrics.regression_metrics(pairs(spark, [5.0, 5.0], [4.0, 5.0])))["r2"] == 0.0
    assert values(metrics.regression_metrics(pairs(spark, [5.0, 5.0], [5.0, 5.0])))["r2"] == 1.0
    assert values(metrics.regression_metrics(pairs(spark, [5.0], [5.0])))["r2"] is None


def test_r2_survives_a_large_offset(spark):
    y = [1e9 + v for v in (3.0, 5.0, 2.0, 7.0)]
    p = [1e9 + v for v in (2.5, 5.0, 4.0, 8.0)]
    assert values(metrics.regression_metrics(pairs(spark, y, p)))["r2"] == pytest.approx(0.644068, abs=1e-6)


CLASSES = [(1, 1), (1, 0), (0, 0), (0, 1), (1, 1)]


def test_classification_metrics(spark):
    df = spark.createDataFrame(CLASSES, "label int, prediction int")
    assert {k: round(v, 6) for k, v in values(metrics.binary_metrics(df)).items()} == {
        "accuracy": 0.6, "precision": 0.666667, "recall": 0.666667, "f1": 0.666667,
    }
    assert {k: round(v, 6) for k, v in values(metrics.weighted_metrics(df)).items()} == {
        "accuracy": 0.6, "precision": 0.6, "recall": 0.6, "f1": 0.6,
    }
    assert {(r.label, r.prediction): r.n for r in metrics.confusion(df).collect()}[(1, 1)] == 2


def test_undefined_ratios_are_zero(spark):
    df = spark.createDataFrame([(1, 0), (1, 0)], "label int, prediction int")
    assert set(values(metrics.binary_metrics(df)).values()) == {0.0}
    assert set(values(metrics.weighted_metrics(df)).values()) == {0.0}


def test_baselines(spark):
    train = spark.createDataFrame([("a", "x", 1.0), ("a", "y", 3.0), ("b", "y", 5.0), ("b", "y", 7.0), ("b", "x", 9.0)], "g string, c string, y double")
    assert {r.g: r.naive_prediction for r in metrics.mean_baseline(train, "y", ["g"]).collect()} == {"a": 2.0, "b": 7.0}
    assert {r.g: r.naive_prediction for r in metrics.majority_baseline(train, "c", ["g"]).collect()} == {"a": "x", "b": "y"}
    test = spark.createDataFrame([("a", 1.5), ("b", None), ("b", 2.0)], "g string, prev double")
    based = metrics.baseline_predictions(test, metrics.mean_baseline(train, "y", ["g"]), ["g"], "prev")
    assert sorted((r.g, r.baseline, r.baseline_source) for r in based.collect()) == [
        ("a", 1.5, "previous_model"), ("b", 7.0, "naive_baseline"), ("b", 7.0, "naive_baseline"),
    ]


def test_numeric_metric_filter(spark):
    df = spark.createDataFrame([("a", "1.5"), ("b", "text"), ("c", None), ("d", "3")], "metric string, value string")
    assert values(metrics.numeric_metrics(df)) == {"a": 1.5, "d": 3.0}


def long(spark, *rows):
    return spark.createDataFrame([tuple(r) for r in rows], "seg string, metric string, value double")


def test_default_thresholds():
    assert gates.default_thresholds() == {"r2": 0.65, "mape": 0.15}
    assert gates.default_thresholds("classification") == {"accuracy": 0.7, "precision": 0.7, "recall": 0.7, "f1": 0.7}
    assert gates.default_thresholds("regression", {"r2": 0.1}) == {"r2": 0.1}


def test_threshold_gate(spark):
    m = long(spark, ("a", "r2", 0.65), ("a", "mape", 0.2), ("b", "r2", 0.1), ("c", "mape", None))
    got = {(r.seg, r.metric): r.passed for r in gates.threshold_gate(m, gates.default_thresholds(), ["seg"]).collect()}
    assert got == {
        ("a", "r2"): True, ("a", "mape"): False, ("b", "r2"): False, ("b", "mape"): True, ("c", "r2"): True, ("c", "mape"): False,
    }


def test_baseline_gate_and_delta(spark):
    new = long(spark, ("a", "r2", 0.5), ("a", "mape", 0.2), ("a", "rmse", 3.0), ("a", "f1", 0.9), ("a", "mae", 1.0))
    base = long(spark, ("a", "r2", 0.4), ("a", "mape", 0.1), ("a", "rmse", 3.0), ("a", "mae", 0.0))
    got = {r.metric: (r.passed, r.delta and round(r.delta, 6)) for r in gates.baseline_gate(new, base, ["seg"]).collect()}
    assert got == {"r2": (True, 0.25), "mape": (False, -1.0), "rmse": (True, 0.0), "f1": (True, None), "mae": (False, None)}


def test_verdict_two_ways(spark):
    new = long(spark, ("a", "r2", 0.7), ("a", "mape", 0.2), ("b", "r2", 0.9), ("b", "mape", 0.1), ("c", "r2", 0.8))
    base = long(spark, ("a", "r2", 0.9), ("b", "r2", 0.8), ("b", "mape", 0.1))
    keys, limits = ["seg"], gates.default_thresholds()
    joined = gates.verdict(gates.threshold_gate(new, limits, keys), gates.baseline_gate(new, base, keys), keys)
    compared = gates.baseline_gate(new, base, keys).select("seg", "metric", "value", "baseline_value")
    fused = gates.verdict_of(compared, limits, keys)
    assert sorted(joined.collect()) == sorted(fused.collect())
    got = {r.seg: r for r in fused.collect()}
    assert (got["a"].validation_passed, got["a"].failed_thresholds, got["a"].failed_baseline) == (False, ["mape"], ["r2"])
    assert got["b"].validation_passed and got["c"].validation_passed


def test_retrain_decision(spark):
    champion = spark.createDataFrame([("a", True), ("b", False), ("c", False)], "seg string, validation_passed boolean")
    challenger = spark.createDataFrame([("a", True), ("b", True), ("c", False), ("d", True)], "seg string, validation_passed boolean")
    got = {r.seg: r.decision for r in gates.retrain_decision(champion, challenger, ["seg"]).collect()}
    assert got == {"a": "keep", "b": "promote", "c": "reject", "d": "promote"}


def test_degradation(spark):
    now = long(spark, ("a", "rmse", 12.0), ("a", "r2", 0.75), ("a", "mae", 1.0), ("a", "f1", 1.0))
    base = long(spark, ("a", "rmse", 10.0), ("a", "r2", 0.80), ("a", "mae", 0.0))
    table = gates.performance_degradation(now, base, ["seg"])
    got = {r.metric: (r.degradation and round(r.degradation, 6), r.is_degraded) for r in table.collect()}
    assert got == {"rmse": (0.2, True), "r2": (0.0625, False), "mae": (None, False)}
    (summary,) = gates.degradation_summary(table, ["seg"]).collect()
    assert (summary.degradation_detected, summary.degraded_metrics) == (True, ["rmse"])


def test_validate_and_retrain_runs(spark):
    rows = [("good", float(i), float(i), 5.0) for i in range(1, 11)] + [("bad", float(i), 5.0, float(i)) for i in range(1, 11)]
    scored = spark.createDataFrame(rows, "seg string, label double, prediction double, previous double")
    first = {r.seg: r for r in validate_run(scored, "label", "prediction", ["seg"], train=scored).collect()}
    assert first["good"].validation_passed and first["good"].baseline_source == "naive_baseline"
    assert not first["bad"].validation_passed and first["bad"].failed_thresholds == ["mape", "r2"]
    again = {r.seg: r for r in validate_run(scored, "label", "prediction", ["seg"], previous="previous").collect()}
    assert again["bad"].failed_baseline == ["mape", "r2"] and again["bad"].baseline_source == "previous_model"
    decisions = {r.seg: r.decision for r in retrain_run(scored, "label", "previous", "prediction", scored, ["seg"]).collect()}
    assert decisions == {"good": "promote", "bad": "keep"}
    with pytest.raises(ValueError, match="train rows"):
        validate_run(scored, "label")


def test_a_verdict_carries_its_evidence(spark):
    compared = spark.createDataFrame(
        [("a", "r2", 0.7, 0.9, "naive_baseline"), ("a", "mape", float("nan"), None, "naive_baseline"), ("a", "mae", 1.0, 2.0, "naive_baseline")],
        "seg string, metric string, value double, baseline_value double, baseline_source string",
    )
    (row,) = gates.verdict_of(compared, {"r2": 0.65, "mape": 0.15}, ["seg"], evidence=True).collect()
    got = {e.metric: (e.threshold, e.baseline_value, e.threshold_ok, e.baseline_ok) for e in row.evidence}
    assert got == {"mae": (None, 2.0, True, True), "mape": (0.15, None, False, True), "r2": (0.65, 0.9, True, False)}
    assert row.baseline_source == "naive_baseline" and not row.validation_passed


def test_promotion_rows_fold_into_the_next_stages(spark):
    decisions = spark.createDataFrame(
        [("a", "promote"), ("b", "keep"), ("c", "promote"), (None, "promote"), ("d", "reject")], "model string, decision string"
    )
    current = spark.createDataFrame(
        [("a", 1, "Archived"), ("a", 2, "Production"), ("a", 3, "Staging"), ("b", 1, "Production"), (None, 7, "Production"), ("d", 1, "None")],
        "model string, version int, current_stage string",
    )
    rows = logstate.promotion_records(decisions, current, ["model"])
    got = {(r.model, r.version, r.stage, r.step) for r in rows.collect()}
    assert got == {
        ("a", 2, "Archived", 1), ("a", 4, "Production", 2), ("c", 1, "Production", 2), (None, 7, "Archived", 1), (None, 8, "Production", 2),
    }
    log = current.withColumnRenamed("current_stage", "stage").withColumn("step", F.lit(0)).unionByName(rows)
    folded = {(r.model, r.version): r.current_stage for r in logstate.fold_stages(log, ["model"], ["version"], ["step"]).collect()}
    assert folded[("a", 2)] == "Archived" and folded[("a", 4)] == "Production" and folded[("a", 3)] == "Staging"
    assert folded[("b", 1)] == "Production" and folded[(None, 8)] == "Production"
    assert logstate.promotion_records(decisions.filter("false"), current, ["model"]).count() == 0
