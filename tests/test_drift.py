import itertools
import math
import random
from datetime import datetime
from decimal import Decimal

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from driftloom.functions.pvalues import chi_square_tail, exact_ks_tail
from driftloom.operators import drift as dr
from driftloom.functions.cells import part_of, parts_of
from driftloom.operators.ordering import quantiles
from driftloom.operators.predictions import distribution_summary, iqr_outliers, prediction_monitor
from driftloom.operators.profile import profile, shape
from driftloom.operators.reports import monitoring_report, monitoring_rows
from driftloom.plans.monitoring import monitor_run, samples_by_date


def frame(spark, reference, current, kind="double"):
    rows = [(v, True) for v in reference] + [(v, False) for v in current]
    return spark.createDataFrame(rows, f"x {kind}, ref boolean").repartition(3)


def drift(spark, reference, current, kind="double", **options):
    df = frame(spark, reference, current, kind)
    (row,) = dr.feature_drift(df, F.col("ref"), ~F.col("ref"), ["x"], **options).collect()
    return row


def statistic(a, b):
    points = np.unique(np.concatenate([a, b]))
    share = lambda s: np.searchsorted(np.sort(s), points, side="right") / len(s)
    return float(np.max(np.abs(share(a) - share(b))))


def test_ks_small_sample_is_exact(spark):
    row = drift(spark, [1.0, 2.0, 3.0], [4.0, 5.0, 6.0], method="exact")
    assert (row.statistic, row.p_method, row.drift_detected) == (1.0, "exact", False)
    assert row.p_value == pytest.approx(0.1)


def test_exact_tail_against_enumeration():
    for n, m in [(3, 3), (4, 4), (2, 5), (5, 3), (4, 6)]:
        gaps = []
        for chosen in itertools.combinations(range(n + m), n):
            picked = set(chosen)
            i = j = 0
            worst = 0.0
            for step in range(n + m):
                i, j = (i + 1, j) if step in picked else (i, j + 1)
                worst = max(worst, abs(i / n - j / m))
            gaps.append(worst)
        for d in sorted(set(gaps)):
            share = sum(g >= d - 1e-12 for g in gaps) / len(gaps)
            assert exact_ks_tail(d, n, m) == pytest.approx(share)
    assert exact_ks_tail(0.0, 3, 4) == 1.0


def test_exact_and_limiting_tails_meet_for_larger_samples(spark):
    rng = random.Random(3)
    a, b = [rng.gauss(0, 1) for _ in range(900)], [rng.gauss(0.08, 1) for _ in range(1100)]
    exact, series = drift(spark, a, b, method="exact"), drift(spark, a, b, method="asymptotic")
    assert (exact.p_method, series.p_method) == ("exact", "asymptotic")
    assert exact.statistic == series.statistic == pytest.approx(statistic(a, b))
    assert exact.p_value == pytest.approx(series.p_value, rel=0.1)


numbers = st.one_of(
    st.floats(allow_nan=False, allow_infinity=True, width=64),
    st.integers(-3, 3).map(float),
    st.floats(1e15, 1e15 + 50, width=64),
)


@settings(max_examples=6, deadline=None)
@given(st.lists(numbers, min_size=1, max_size=40), st.lists(numbers, min_size=1, max_size=40))
def test_ks_statistic_for_any_values(spark, a, b):
    forward, backward = drift(spark, a, b), drift(spark, b, a)
    assert forward.statistic == pytest.approx(statistic(np.array(a), np.array(b)), abs=1e-12)
    assert forward.statistic == pytest.approx(backward.statistic) and 0 <= forward.p_value <= 1


def test_nulls_and_nan_are_left_out_per_feature(spark):
    row = drift(spark, [1.0, None, 2.0, float("nan"), 3.0], [None, 4.0, 5.0, 6.0])
    assert (row.n_ref, row.n_cur, row.statistic) == (3, 3, 1.0)


@pytest.mark.parametrize("scale", [1, 10])
def test_chi_square_rescales_the_reference(spark, scale):
    count = lambda **n: [k for k, v in n.items() for _ in range(v)]
    row = drift(spark, count(a=25 * scale, b=25 * scale, c=50 * scale), count(a=30, b=20, c=50), "string")
    assert row.kind == "chi_square" and row.statistic == pytest.approx(2.0)
    assert row.p_value == pytest.approx(0.367879, abs=1e-6) and not row.drift_detected


def test_chi_square_edges(spark):
    unseen = drift(spark, ["a", "b"], ["a", "c"], "string")
    assert math.isinf(unseen.statistic) and unseen.p_value == 0.0 and unseen.drift_detected
    single = drift(spark, ["a", "a"], ["a"], "string")
    assert single.p_value is None and not single.drift_detected and single.status == "ok"


def test_chi_square_tail():
    assert chi_square_tail(2.0, 2) == pytest.approx(math.exp(-1))
    for x in (0.1, 1.0, 3.84, 20.0):
        assert chi_square_tail(x, 1) == pytest.approx(math.erfc(math.sqrt(x / 2)))
        assert chi_square_tail(x, 3) == pytest.approx(math.erfc(math.sqrt(x / 2)) + math.sqrt(2 * x / math.pi) * math.exp(-x / 2))
        assert chi_square_tail(x, 4) == pytest.approx(math.exp(-x / 2) * (1 + x / 2))
    assert chi_square_tail(0.0, 5) == 1.0 and chi_square_tail(float("inf"), 5) == 0.0
    assert chi_square_tail(1_000_000.0, 1_000_000) == pytest.approx(0.5, abs=1e-3)


def test_types_decide_the_test(spark):
    df = spark.createDataFrame(
        [(1, True, Decimal("1.5"), "a", datetime(2024, 1, 1), True), (2, False, Decimal("2.5"), "b", datetime(2024, 1, 2), False)],
        "i int, b boolean, d decimal(5,2), s string, t timestamp, ref boolean",
    )
    rows = dr.feature_drift(df, F.col("ref"), ~F.col("ref"), ["i", "b", "d", "s", "t"]).collect()
    assert {r.feature: r.kind for r in rows} == {"i": "ks", "b": "ks", "d": "ks", "s": "chi_square", "t": "chi_square"}


def test_missing_and_empty_features(spark):
    reference = spark.createDataFrame([("g", 1.0, None, "a", 5.0)], "seg string, x double, y double, s string, only double")
    current = spark.createDataFrame([("g", 2.0, 1.0, "a")], "seg string, x double, y double, s string")
    rows = {r.feature: r for r in dr.feature_drift_between(reference, current, ["x", "y", "s", "only", "none"], ["seg"]).collect()}
    assert {f: r.status for f, r in rows.items()} == {"x": "ok", "y": "empty", "s": "ok", "only": "missing", "none": "missing"}
    assert rows["y"].statistic is None and rows["y"].p_value is None and not rows["y"].drift_detected
    assert all(r.seg == "g" for r in rows.values())
    with pytest.raises(ValueError, match="none of the features"):
        dr.feature_drift_between(reference, current, ["none"])


def test_overlapping_samples_and_segments(spark):
    rows = [(seg, float(i), seg == "moved" and i >= 80) for seg in ("moved", "still") for i in range(100)]
    rows += [("still", float(i), True) for i in range(100)]
    df = spark.createDataFrame(rows, "seg string, x double, recent boolean")
    tested = dr.feature_drift(df, F.lit(True), F.col("recent"), ["x"], ["seg"])
    got = {r.seg: r for r in tested.collect()}
    assert (got["moved"].n_ref, got["moved"].n_cur, got["moved"].drift_detected) == (100, 20, True)
    assert (got["still"].n_ref, got["still"].n_cur, got["still"].drift_detected) == (200, 100, False)
    summary = {r.seg: (r.drift_detected, r.drifted_features) for r in dr.drift_summary(tested, ["seg"]).collect()}
    assert summary == {"moved": (True, ["x"]), "still": (False, [])}


@settings(max_examples=6, deadline=None)
@given(st.lists(st.one_of(st.integers(-5, 5).map(float), st.floats(-1e6, 1e6), st.floats(1e15, 1e15 + 9)), min_size=1, max_size=60))
def test_quantiles_match_numpy(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x double").repartition(3)
    (row,) = quantiles(df, "x", {"low": 0.25, "mid": 0.5, "high": 0.75, "all": 1.0}).collect()
    assert list(row) == pytest.approx(list(np.quantile(values, [0.25, 0.5, 0.75, 1.0])), rel=1e-12, abs=1e-9)


def test_two_far_clusters(spark):
    rng = np.random.default_rng(1)
    values = np.concatenate((rng.uniform(0, 100, 3000), 1e9 + rng.uniform(0, 100, 3000)))
    df = spark.createDataFrame([(float(v),) for v in values], "x double").repartition(3)
    probs = {"low": 0.1, "mid": 0.5, "high": 0.9}
    (row,) = quantiles(df, "x", probs).collect()
    assert list(row) == pytest.approx(list(np.quantile(values, list(probs.values()))), rel=1e-12)
    a, b = values[::2].tolist(), (values[1::2] + 3.0).tolist()
    assert drift(spark, a, b).statistic == pytest.approx(statistic(np.array(a), np.array(b)), abs=1e-12)


def test_parts_keep_a_far_cluster_from_meeting_in_one_task(spark):
    rows = spark.range(100_000).select((F.lit(1e9) + F.col("id") / 1000.0).alias("v"))
    low, high = F.lit(1e9), F.lit(1e9 + 99.999)
    placed = rows.select("v", part_of(F.col("v"), low, high, parts_of(F.lit(100_000), low, high)).alias("part"))
    sizes = placed.groupBy("part").agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("low"), F.max("v").alias("high")).orderBy("part").collect()
    assert len(sizes) == 80 and max(r.n for r in sizes) < 2_000
    assert all(a.high < b.low for a, b in zip(sizes, sizes[1:]))


def test_quantiles_per_group_with_a_null_group(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0), (None, 7.0), ("b", None)], "g string, x double")
    assert {r.g: r.mid for r in quantiles(df, "x", {"mid": 0.5}, ["g"]).collect()} == {"a": 1.5, None: 7.0}


def test_iqr_outliers(spark):
    df = spark.createDataFrame([(v,) for v in (1.0, 2.0, 3.0, 4.0, 100.0)], "x double")
    (row,) = iqr_outliers(df, "x").collect()
    assert row.asDict() == {
        "q1": 2.0, "q3": 4.0, "lower_bound": -1.0, "upper_bound": 7.0, "outlier_count": 1, "outlier_rate": 0.2, "anomaly_detected": True,
    }
    (empty,) = iqr_outliers(df.filter("x < 0"), "x").collect()
    assert empty.outlier_rate is None and not empty.anomaly_detected


def test_prediction_monitor(spark):
    df = frame(spark, [float(i) for i in range(50)], [float(i) + 40 for i in range(50)]).withColumnRenamed("x", "prediction")
    (compared,) = prediction_monitor(df, is_ref=F.col("ref"), is_cur=~F.col("ref")).collect()
    assert (compared["mean"], compared.median, compared.statistic, compared.anomaly_detected) == (64.5, 64.5, 0.8, True)
    (alone,) = prediction_monitor(df.filter("ref")).collect()
    assert (alone.outlier_count, alone.anomaly_detected, round(alone.std, 6)) == (0, False, 14.57738)
    assert distribution_summary(df, "prediction", ["ref"]).count() == 2


def flags(spark, drifted, degraded, anomalous):
    d = spark.createDataFrame([(drifted, ["x", "y"] if drifted else [])], "drift_detected boolean, drifted_features array<string>")
    p = spark.createDataFrame([(degraded, ["rmse"] if degraded else [])], "degradation_detected boolean, degraded_metrics array<string>")
    a = spark.createDataFrame([(anomalous,)], "anomaly_detected boolean")
    return monitoring_report(d, p, a)


def test_report(spark):
    (row,) = flags(spark, True, True, True).collect()
    assert row.overall_status == "critical"
    assert [(a.type, a.severity) for a in row.alerts] == [
        ("data_drift", "warning"), ("performance_degradation", "critical"), ("prediction_anomaly", "warning"),
    ]
    assert row.alerts[0].message == "Data drift detected in 2 features"
    assert row.alerts[1].message == "Performance degradation in 1 metrics"
    assert [flags(spark, *f).first().overall_status for f in ((False, False, True), (True, False, False), (False, False, False))] == [
        "warning", "warning", "healthy",
    ]
    flat = monitoring_rows(flags(spark, True, False, False), "model", 3, at=datetime(2024, 1, 1)).first()
    assert (flat.model_name, flat.model_version, flat.drifted_features) == ("model", 3, "x,y")
    assert flat.alerts == '[{"type":"data_drift","severity":"warning","message":"Data drift detected in 2 features"}]'


def test_monitor_run_with_and_without_label(spark):
    rows = [(datetime(2024, 1, 1 + i % 28), float(i % 28), float(i % 28), float(i % 28) * (1 if i % 28 < 20 else 3)) for i in range(280)]
    df = spark.createDataFrame(rows, "semana timestamp, x double, label double, prediction double")
    is_ref, is_cur = samples_by_date(days=7, as_of="2024-01-28", exclude_current=True)
    full = monitor_run(df, ["x"], is_ref, is_cur, "label").first()
    assert full.overall_status == "critical" and full.drifted_features == ["x"] and full.anomaly_detected
    blind = monitor_run(df.drop("label"), ["x"], is_ref, is_cur, "label").first()
    assert blind.overall_status == "warning" and not blind.degradation_detected


def test_profile(spark):
    df = spark.createDataFrame([(1, "a"), (None, "b"), (3, "a")], "n int, s string")
    got = {r.column_name: r for r in profile(df).collect()}
    assert (got["n"].n_rows, got["n"].n_nulls, got["n"].min_value, got["n"].max_value) == (3, 1, "1", "3")
    assert (got["s"].data_type, got["s"].n_distinct_approx) == ("string", 2)
    assert shape(df).first().asDict() == {"n_rows": 3, "n_columns": 2}
