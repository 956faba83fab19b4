"""Validating a scored model against thresholds and a baseline, and deciding on retraining."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftloom.operators.gates import default_thresholds, retrain_decision, verdict_of
from driftloom.operators.scoring import Model, as_model
from driftloom.operators.metrics import (
    VALIDATION_METRICS,
    baseline_predictions,
    majority_baseline,
    mean_baseline,
    regression_metrics,
    weighted_metrics,
)


def validation_metrics(
    df: DataFrame, label: str, prediction: str, group_cols: Sequence[str] = (), model_type: str = "regression"
) -> DataFrame:
    """The metrics the gates look at, for either kind of model."""
    if model_type == "classification":
        return weighted_metrics(df, label, prediction, group_cols)
    return regression_metrics(df, label, prediction, group_cols, VALIDATION_METRICS)


def naive_baseline(train: DataFrame, label: str, group_cols: Sequence[str] = (), model_type: str = "regression") -> DataFrame:
    """The majority label or the mean label of the training rows, by kind of model."""
    return (majority_baseline if model_type == "classification" else mean_baseline)(train, label, group_cols)


def compare_with_baseline(
    scored: DataFrame,
    label: str,
    prediction: str = "prediction",
    group_cols: Sequence[str] = (),
    model_type: str = "regression",
    train: DataFrame | None = None,
    previous: str | None = None,
    naive: DataFrame | None = None,
) -> DataFrame:
    """Per segment and metric: the candidate's `value`, the `baseline_value` and its `baseline_source`.

    Every row is listed once as candidate and once as baseline, so one pass measures both.
    `naive` may hold the naive predictions of `train` when they are known already. A segment
    without training rows has no naive prediction and so no baseline: its `baseline_value` and
    `baseline_source` are null, which the gates let pass.
    """
    keys = list(group_cols)
    if train is not None and naive is None:
        naive = naive_baseline(train, label, keys, model_type)
    if naive is None and previous is None:
        raise ValueError("train rows are required when there is no previous prediction to compare with")
    if naive is None:
        based = scored.select("*", F.col(previous).alias("baseline"), F.lit("previous_model").alias("baseline_source"))
    else:
        based = baseline_predictions(scored, naive, keys, previous)
    offered = F.struct(F.col("baseline_source").alias("__role"), F.col("baseline").alias("__p"))
    # A previous model that left a row out is measured as it is; a naive value is there for a whole segment or not at all.
    present = F.col("baseline").isNotNull() | (F.col("baseline_source") == "previous_model")
    roles = F.array(F.struct(F.lit("candidate").alias("__role"), F.col(prediction).alias("__p")), F.when(present, offered))
    listed = based.select(*keys, label, F.inline(F.array_compact(roles)))
    measured = validation_metrics(listed, label, "__p", [*keys, "__role"], model_type)
    is_candidate = F.col("__role") == "candidate"
    return measured.groupBy(*keys, "metric").agg(
        F.max(F.when(is_candidate, F.col("value"))).alias("value"),
        F.max(F.when(~is_candidate, F.col("value"))).alias("baseline_value"),
        F.max(F.when(~is_candidate, F.col("__role"))).alias("baseline_source"),
    )


def validate_run(
    scored: DataFrame,
    label: str,
    prediction: str = "prediction",
    group_cols: Sequence[str] = (),
    model_type: str = "regression",
    thresholds: Mapping[str, float] | None = None,
    train: DataFrame | None = None,
    previous: str | None = None,
    naive: DataFrame | None = None,
    evidence: bool = True,
) -> DataFrame:
    """One verdict row per segment for the scored test rows, with the values it rests on as `evidence`.

    The baseline is the previous model's prediction column where given and complete, otherwise
    the mean or majority label of `train`, which is then required.
    """
    compared = compare_with_baseline(scored, label, prediction, group_cols, model_type, train, previous, naive)
    return verdict_of(compared, default_thresholds(model_type, thresholds), group_cols, evidence)


def validate_model(
    test: DataFrame,
    model: Model | DataFrame,
    label: str,
    features: Sequence[str] = (),
    group_cols: Sequence[str] = (),
    previous: Model | DataFrame | None = None,
    **settings: object,
) -> DataFrame:
    """`validate_run` for a model of any kind, and a previous one of any kind, on rows that are not scored yet.

    `features` are only needed for coefficient tables and bare `spark.ml` models.
    """
    scored = as_model(model, features, group_cols).score(test, "prediction")
    if previous is not None:
        scored = as_model(previous, features, group_cols).score(scored, "previous_prediction")
        settings["previous"] = "previous_prediction"
    return validate_run(scored, label, "prediction", group_cols, **settings)


def retrain_models(
    test: DataFrame,
    champion: Model | DataFrame,
    challenger: Model | DataFrame,
    label: str,
    train: DataFrame,
    group_cols: Sequence[str],
    features: Sequence[str] = (),
    **settings: object,
) -> DataFrame:
    """`retrain_run` for two models of any kinds on rows that are not scored yet."""
    scored = as_model(champion, features, group_cols).score(test, "champion")
    both = as_model(challenger, features, group_cols).score(scored, "challenger")
    return retrain_run(both, label, "champion", "challenger", train, group_cols, **settings)


def retrain_run(
    scored: DataFrame,
    label: str,
    champion: str,
    challenger: str,
    train: DataFrame,
    group_cols: Sequence[str],
    model_type: str = "regression",
    thresholds: Mapping[str, float] | None = None,
) -> DataFrame:
    """Keep, promote or reject per segment, from the predictions of both models on the same rows.

    The champion is held against the naive baseline and the challenger against the champion, so
    that neither is compared with itself.
    """
    naive = naive_baseline(train, label, group_cols, model_type)
    held = validate_run(scored, label, champion, group_cols, model_type, thresholds, naive=naive, evidence=False)
    offered = validate_run(scored, label, challenger, group_cols, model_type, thresholds, previous=champion, naive=naive, evidence=False)
    return retrain_decision(held, offered, group_cols)
