"""What rests on counts: one-pass drift cells, quantile sketches, recorded periods, absent labels and baselines."""

import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from driftloom.functions.pvalues import chi_square_tail, exact_ks_tail
from driftloom.operators import drift as dr
from driftloom.operators import ordering
from driftloom.operators import sketches as sk
from driftloom.operators.metrics import binary_metrics, n_unlabelled, weighted_metrics
from driftloom.operators.ordering import quantiles
from driftloom.operators.predictions import distribution_summary, iqr_outliers
from driftloom.plans.history import monitor_periods, record_periods
from driftloom.plans.monitoring import monitor_run
from driftloom.plans.validation import retrain_run, validate_run


def values_at(seed, n=300):
    """Values at several scales: a cluster far from 0, one around it, ties and extremes."""
    rng = random.Random(seed)
    near = [rng.choice([1.7e9 + rng.random(), 1.7e9 + rng.randint(0, 9), rng.gauss(0, 1), 5.0, -1e-9, 0.0]) for _ in range(n)]
    return near + [1e300, -1e300, float("inf"), float("-inf")]


@pytest.mark.parametrize("heavy", [1, 1 << 20])
def test_one_pass_cells_are_exact(spark, monkeypatch, heavy):
    """Also where cells count as heavy and are cut into parts first."""
    monkeypatch.setattr(dr, "HEAVY_CELL", heavy)
    monkeypatch.setattr(ordering, "HEAVY_CELL", heavy)
    for seed in (1, 2):
        a, b = values_at(seed), values_at(seed + 10)[: 200 + 40 * seed]
        rows = [("g", v, True) for v in a] + [("g", v, False) for v in b] + [("g", None, True), ("void", None, False)]
        df = spark.createDataFrame(rows, "g string, x double, ref boolean").repartition(4)
        got = {r["g"]: r for r in dr.feature_drift(df, F.col("ref"), ~F.col("ref"), ["x"], ["g"]).collect()}
        points = np.unique(np.concatenate([a, b]))
        share = lambda s: np.searchsorted(np.sort(s), points, side="right") / len(s)
        assert got["g"]["statistic"] == pytest.approx(np.max(np.abs(share(a) - share(b))), abs=1e-12)
        assert (got["g"]["n_ref"], got["g"]["n_cur"], got["void"]["status"]) == (len(a), len(b), "empty")
        inner = sorted(v for v in a if abs(v) < 1e299)
        finite = spark.createDataFrame([(v,) for v in inner], "x double").repartition(3)
        probs = {"p10": 0.1, "p25": 0.25, "p50": 0.5, "p99": 0.99}
        found = quantiles(finite, "x", probs).first().asDict()
        assert found == pytest.approx({k: float(np.quantile(inner, p)) for k, p in probs.items()}, rel=1e-12, abs=1e-12)
        q1, q3 = np.quantile(inner, 0.25), np.quantile(inner, 0.75)
        lower, upper = q1 - 0.2 * (q3 - q1), q3 + 0.2 * (q3 - q1)
        outside = iqr_outliers(finite, "x", fence=0.2).first()
        assert outside["outlier_count"] == sum(v < lower or v > upper for v in inner)
        summary = distribution_summary(finite, "x").first()
        assert summary["mean"] == pytest.approx(np.mean(inner)) and summary["std"] == pytest.approx(np.std(inner, ddof=1))


def scans(df):
    return df._jdf.queryExecution().executedPlan().toString().count("FileScan parquet")


def test_rows_are_read_twice_at_most(spark, monkeypatch, tmp_path):
    rng = random.Random(4)
    rows = [(float(rng.gauss(0, 1)), rng.choice("ab"), rng.random() < 0.5) for _ in range(500)]
    spark.createDataFrame(rows, "x double, s string, ref boolean").write.parquet(str(tmp_path / "raw"))
    raw = spark.read.parquet(str(tmp_path / "raw"))
    plans = []
    settle = dr.settle
    monkeypatch.setattr(dr, "settle", lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString()) or settle(df))
    dr.feature_drift(raw, F.col("ref"), ~F.col("ref"), ["x", "s"]).collect()
    assert sum("/raw" in p for p in plans) <= 2


def test_sketches_keep_their_word(spark):
    rng = random.Random(5)
    values = [rng.choice([rng.gauss(0, 1), 3.0, 1e6 * rng.random()]) for _ in range(20_000)]
    df = spark.createDataFrame([("ab"[i % 2], i % 7, v) for i, v in enumerate(values)], "g string, day int, x double").repartition(6)
    probs = {"low": 0.1, "mid": 0.5, "high": 0.9}
    whole = sk.sketched_quantiles(df, "x", probs, ["g"], 0.02)
    merged = sk.read_quantiles(sk.merge_sketches(sk.sketch_values(df, "x", ["g", "day"], 0.02), ["g"], 0.02), probs, ["g"])
    for found in (whole, merged, quantiles(df, "x", probs, ["g"], accuracy=0.02)):
        for r in found.collect():
            own = np.sort([v for i, v in enumerate(values) if "ab"[i % 2] == r["g"]])
            for name, p in probs.items():
                assert np.searchsorted(own, r[name], "left") / len(own) <= p + 0.02 and np.searchsorted(own, r[name], "right") / len(own) >= p - 0.02
    few, many = (sk.sketch_values(spark.range(n).select(F.col("id").alias("x")), "x").select(F.length("sketch")).first()[0] for n in (20_000, 400_000))
    assert many < 2 * few
    assert sk.sketch_values(df.limit(0), "x").count() == 0 and sk.sketched_quantiles(df.withColumn("x", F.lit(None)), "x", probs, ["g"]).count() == 0
    with pytest.raises(ValueError, match="finer"):
        sk.size_for(1e-6)


def scored(spark):
    rng = random.Random(6)
    rows = []
    for i in range(600):
        day, g = f"2024-01-{1 + i % 20:02d}", rng.choice(["u", "v", None])
        y = None if i % 50 == 0 else rng.gauss(10, 3)
        late = i % 20 > 14
        rows.append((day, g, float(rng.randint(0, 6) + (2 if late and g == "u" else 0)), rng.choice("ab"), y, (y or 1.0) + rng.gauss(0, 4 if late and g == "u" else 1)))
    return spark.createDataFrame(rows, "day string, g string, x double, s string, y double, prediction double")


def test_recorded_periods_say_what_all_rows_say(spark, tmp_path):
    rows, folder = scored(spark), str(tmp_path / "kept")
    day = F.col("day")
    for some in (rows.filter(day < "2024-01-12"), rows.filter(day >= "2024-01-12"), rows.filter(day == "2024-01-05")):
        record_periods(some, folder, day, ["x", "s"], "y", group_cols=["g"])
    for exclude in (False, True):
        is_cur = day >= "2024-01-16"
        want = monitor_run(rows, ["x", "s"], ~is_cur if exclude else F.lit(True), is_cur, "y", group_cols=["g"])
        got = monitor_periods(spark, folder, "2024-01-16", group_cols=["g"], exclude_current=exclude)
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert len({r["overall_status"] for r in want.collect()}) > 1
    # A new day is recorded from its rows alone.
    more = rows.filter(day == "2024-01-20").withColumn("day", F.lit("2024-01-21"))
    record_periods(more, folder, F.col("day"), ["x", "s"], "y", group_cols=["g"])
    both = rows.unionByName(more)
    want = monitor_run(both, ["x", "s"], F.lit(True), day >= "2024-01-16", "y", group_cols=["g"])
    assert sorted(map(str, monitor_periods(spark, folder, "2024-01-16", group_cols=["g"]).collect())) == sorted(map(str, want.collect()))


def test_rows_without_a_label_are_in_no_metric(spark):
    df = spark.createDataFrame([(1, 1), (0, 0), (None, 1), (None, None), (1, None)], "label int, prediction int")
    for measure in (binary_metrics, weighted_metrics):
        got = {r["metric"]: r["value"] for r in measure(df.filter("label IS NULL OR prediction IS NOT NULL")).collect()}
        assert got == {m: 1.0 for m in ("accuracy", "precision", "recall", "f1")}
        assert {r["metric"]: r["value"] for r in measure(df).collect()}["accuracy"] == pytest.approx(2 / 3)
    assert tuple(n_unlabelled(df).first()) == (5, 2)


def test_a_segment_without_training_rows_has_no_baseline(spark):
    rows = [(g, float(i), float(i)) for g in "ab" for i in range(10)]
    df = spark.createDataFrame(rows, "g string, y double, prediction double")
    verdicts = {r["g"]: r for r in validate_run(df, "y", group_cols=["g"], train=df.filter("g = 'a'")).collect()}
    assert all(r["validation_passed"] for r in verdicts.values())
    assert (verdicts["a"]["baseline_source"], verdicts["b"]["baseline_source"]) == ("naive_baseline", None)
    assert {e["baseline_value"] for e in verdicts["b"]["evidence"]} == {None}
    holes = df.withColumn("prediction", F.when(F.col("y") != 3, F.col("prediction")))
    assert not any(r["validation_passed"] for r in validate_run(holes, "y", group_cols=["g"], train=df.filter("g = 'a'")).collect())
    decided = retrain_run(df.withColumn("old", F.lit(4.5)), "y", "old", "prediction", df.filter("g = 'a'"), ["g"])
    assert {r["g"]: r["decision"] for r in decided.collect()} == {"a": "promote", "b": "promote"}


def test_exact_tail_of_large_samples():
    begun = time.process_time()
    p = exact_ks_tail(0.0175, 10_000, 9_999)
    assert time.process_time() - begun < 1.5 and p == pytest.approx(0.0919, abs=0.001)
    assert exact_ks_tail(1.0, 5, 5) == pytest.approx(2 / 252) and exact_ks_tail(1.0, 40, 50) < 1e-20


def test_chi_square_tail_always_ends():
    assert chi_square_tail(1e308, 4) == 0.0 and np.isnan(chi_square_tail(float("nan"), 4))
    assert chi_square_tail(2e7, 2e7) == pytest.approx(0.5, abs=1e-3)
