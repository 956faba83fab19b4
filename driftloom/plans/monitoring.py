"""The monitoring run: drift, predictions, performance and report from one scored frame."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftloom.functions.attach import attach
from driftloom.functions.naming import WEEK
from driftloom.operators.drift import P_CUTOFF, drift_summary, feature_drift
from driftloom.operators.gates import DEGRADATION_CUTOFF, degradation_of, degradation_summary
from driftloom.operators.metrics import MONITORING_METRICS, binary_metrics, regression_metrics, side_by_side
from driftloom.operators.predictions import prediction_monitor
from driftloom.operators.reports import monitoring_report
from driftloom.operators.scoring import Model, as_model
from driftloom.sources.scratch import settle


def samples_by_date(date_col: str = WEEK, days: int = 28, as_of: object = None, exclude_current: bool = False) -> tuple[Column, Column]:
    """Conditions for the reference (all rows) and the current sample (the last `days` days).

    By default the reference contains the current rows; `exclude_current` keeps them apart.
    """
    anchor = F.current_date() if as_of is None else F.lit(as_of).cast("date")
    is_cur = F.coalesce(F.col(date_col) >= F.date_sub(anchor, days), F.lit(False))
    return (~is_cur if exclude_current else F.lit(True)), is_cur


def performance_metrics(
    df: DataFrame, label: str, prediction: str, group_cols: Sequence[str] = (), model_type: str = "regression"
) -> DataFrame:
    """The metrics watched in production."""
    if model_type == "classification":
        return binary_metrics(df, label, prediction, group_cols)
    return regression_metrics(df, label, prediction, group_cols, MONITORING_METRICS)


def compare_samples(
    scored: DataFrame,
    label: str,
    prediction: str,
    is_ref: Column,
    is_cur: Column,
    group_cols: Sequence[str] = (),
    model_type: str = "regression",
) -> DataFrame:
    """Metrics of both samples side by side (`current`, `baseline`), measured in one pass.

    A row in both samples is listed once for each.
    """
    samples = F.array_compact(F.array(F.when(is_ref, F.lit("baseline")), F.when(is_cur, F.lit("current"))))
    listed = scored.select(*group_cols, label, prediction, F.explode(samples).alias("__sample"))
    measured = performance_metrics(listed, label, prediction, [*group_cols, "__sample"], model_type)
    both = side_by_side(measured, "__sample", {"current": "current", "baseline": "baseline"}, group_cols)
    return both.filter("current IS NOT NULL AND baseline IS NOT NULL")


def monitor_run(
    scored: DataFrame,
    features: Sequence[str],
    is_ref: Column | None,
    is_cur: Column,
    label: str | None = None,
    prediction: str = "prediction",
    group_cols: Sequence[str] = (),
    model_type: str = "regression",
    p_cutoff: float = P_CUTOFF,
    degradation_cutoff: float = DEGRADATION_CUTOFF,
    method: str = "asymptotic",
    statistics: bool = False,
) -> DataFrame:
    """One report row per segment. Performance is looked at only when the label is in the frame.

    The predictions are tested along with the features. Without a reference sample (`is_ref`
    None) nothing can have drifted, and the share of outliers among the current predictions tells
    whether they are anomalous. With `statistics` the report carries `prediction_statistics` of
    the current predictions: mean, std, min, max, median, outlier_count and outlier_rate.
    """
    keys = list(group_cols)
    current = scored.filter(is_cur)
    if is_ref is None:
        alone = settle(prediction_monitor(current, prediction, keys))
        drift = alone.select(
            *keys, F.lit(False).alias("drift_detected"), F.array().cast("array<string>").alias("drifted_features"), "anomaly_detected"
        )
        report = monitoring_report(drift, None, None, keys)
    else:
        watched = [c for c in features if c != prediction]
        tests = feature_drift(scored, is_ref, is_cur, [*watched, prediction], keys, p_cutoff, method)
        drift = drift_summary(tests, keys, prediction)
        performance = None
        if label is not None and label in scored.columns:
            compared = compare_samples(scored, label, prediction, is_ref, is_cur, keys, model_type)
            performance = degradation_summary(degradation_of(compared, keys, degradation_cutoff), keys)
        report = monitoring_report(drift, performance, None, keys)
        alone = settle(prediction_monitor(current, prediction, keys)) if statistics else None
    if not statistics:
        return report
    told = F.struct("mean", "std", "min", "max", "median", "outlier_count", "outlier_rate").alias("prediction_statistics")
    return attach(report, alone.select(*keys, told), keys)


def monitor_model(
    df: DataFrame,
    model: Model | DataFrame,
    features: Sequence[str],
    is_ref: Column | None,
    is_cur: Column,
    group_cols: Sequence[str] = (),
    **settings: object,
) -> DataFrame:
    """`monitor_run` for a model of any kind on rows that are not scored yet."""
    scored = as_model(model, features, group_cols).score(df, "prediction")
    return monitor_run(scored, features, is_ref, is_cur, group_cols=group_cols, **settings)
