"""Regression and classification metrics as one-pass aggregates, per segment."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftloom.functions.attach import attach
from driftloom.sources.scratch import settle

# Metric names per report, and the floor below which |y| is not divided by.
TRAINING_METRICS = ("mse", "mae", "rmse", "r2")
VALIDATION_METRICS = ("r2", "mape")
MONITORING_METRICS = ("rmse", "mae", "r2")
CLASSIFICATION_METRICS = ("accuracy", "precision", "recall", "f1")
MAPE_FLOOR = 2.220446049250313e-16


def to_long(wide: DataFrame, metrics: Sequence[str], group_cols: Sequence[str] = ()) -> DataFrame:
    """One row per group and metric."""
    return wide.unpivot(list(group_cols), list(metrics), "metric", "value")


def regression_metrics(
    df: DataFrame,
    label: str = "label",
    prediction: str = "prediction",
    group_cols: Sequence[str] = (),
    metrics: Sequence[str] = TRAINING_METRICS,
    prefix: str = "",
) -> DataFrame:
    """Long table of regression metrics from a single pass.

    The total sum of squares comes from the population variance, which Spark keeps as merged
    central moments, so no second pass over the rows is needed. A constant label gives r2 of 1
    if every prediction is right and 0 otherwise; a single row gives no r2.

    Rows without a label are not measured. A group in which a labelled row has no prediction is
    not measurable either: its metrics are NaN, which no gate accepts. `n_rows` and
    `n_unpredicted` may be asked for among the metrics.
    """
    y, p = F.col(label).cast("double"), F.col(prediction).cast("double")
    error = y - p
    sums = df.filter(y.isNotNull()).groupBy(*group_cols).agg(
        F.count(F.lit(1)).alias("__n"),
        F.count_if(p.isNull()).alias("__unpredicted"),
        F.avg(error * error).alias("mse"),
        F.avg(F.abs(error)).alias("mae"),
        F.avg(F.abs(error) / F.greatest(F.abs(y), F.lit(MAPE_FLOOR))).alias("mape"),
        F.var_pop(y).alias("__spread"),
    )
    r2 = (
        F.when(F.col("__n") < 2, F.lit(None).cast("double"))
        .when(F.col("__spread") > 0, 1 - F.try_divide(F.col("mse"), F.col("__spread")))
        .when(F.col("mse") == 0, F.lit(1.0))
        .otherwise(F.lit(0.0))
    )
    wide = sums.select("*", F.sqrt("mse").alias("rmse"), r2.alias("r2"))
    counts = {"n_rows": F.col("__n").cast("double"), "n_unpredicted": F.col("__unpredicted").cast("double")}

    def measured(metric: str) -> Column:
        whole = F.when(F.col("__unpredicted") > 0, F.lit(float("nan"))).otherwise(F.col(metric)) if metric not in counts else counts[metric]
        return whole.alias(prefix + metric)

    named = wide.select(*group_cols, *[measured(m) for m in metrics])
    return to_long(named, [prefix + m for m in metrics], group_cols)


def _ratio(top: Column, bottom: Column) -> Column:
    return F.coalesce(F.try_divide(top.cast("double"), bottom), F.lit(0.0))


def confusion(df: DataFrame, label: str = "label", prediction: str = "prediction", group_cols: Sequence[str] = ()) -> DataFrame:
    """Counts of (label, prediction) pairs, rows without a label among them."""
    return df.groupBy(*group_cols, label, prediction).agg(F.count(F.lit(1)).alias("n"))


def binary_metrics(
    df: DataFrame, label: str = "label", prediction: str = "prediction", group_cols: Sequence[str] = (), positive: object = 1
) -> DataFrame:
    """Accuracy, and precision, recall and f1 of the positive class; 0 where undefined.

    Rows without a label are not measured, as in `regression_metrics`; a labelled row without a
    prediction is a wrong one. `n_unlabelled` tells how many rows were left out.
    """
    df = df.filter(F.col(label).isNotNull())
    is_true, is_pred = F.col(label) == F.lit(positive), F.col(prediction) == F.lit(positive)
    counts = df.groupBy(*group_cols).agg(
        F.count(F.lit(1)).alias("__n"),
        F.count_if(F.col(label) == F.col(prediction)).alias("__right"),
        F.count_if(is_true & is_pred).alias("__tp"),
        F.count_if(is_true).alias("__true"),
        F.count_if(is_pred).alias("__pred"),
    )
    wide = counts.select(
        *group_cols,
        _ratio(F.col("__right"), F.col("__n")).alias("accuracy"),
        _ratio(F.col("__tp"), F.col("__pred")).alias("precision"),
        _ratio(F.col("__tp"), F.col("__true")).alias("recall"),
        _ratio(2 * F.col("__tp"), F.col("__true") + F.col("__pred")).alias("f1"),
    )
    return to_long(wide, CLASSIFICATION_METRICS, group_cols)


def weighted_metrics(
    df: DataFrame, label: str = "label", prediction: str = "prediction", group_cols: Sequence[str] = ()
) -> DataFrame:
    """Accuracy, and per-class precision, recall and f1 averaged by true-class support.

    Rows are folded to confusion cells first; each cell then counts once for its true class and
    once for its predicted class, so class totals come from grouping alone. Rows without a label
    are not measured; a labelled row without a prediction is a wrong one.
    """
    keys = list(group_cols)
    cells = confusion(df.filter(F.col(label).isNotNull()), label, prediction, keys)
    hit = F.when(F.col(label) == F.col(prediction), F.col("n")).otherwise(0)
    as_true = F.struct(F.col(label).alias("__class"), F.col("n").alias("__true"), F.lit(0).cast("bigint").alias("__pred"), hit.alias("__tp"))
    as_pred = F.struct(
        F.col(prediction).alias("__class"),
        F.lit(0).cast("bigint").alias("__true"),
        F.col("n").alias("__pred"),
        F.lit(0).cast("bigint").alias("__tp"),
    )
    classes = (
        cells.select(*keys, F.inline(F.array(as_true, as_pred)))
        .groupBy(*keys, "__class")
        .agg(F.sum("__true").alias("__true"), F.sum("__pred").alias("__pred"), F.sum("__tp").alias("__tp"))
    )
    support = F.col("__true")
    wide = classes.groupBy(*keys).agg(
        _ratio(F.sum("__tp"), F.sum(support)).alias("accuracy"),
        _ratio(F.sum(support * _ratio(F.col("__tp"), F.col("__pred"))), F.sum(support)).alias("precision"),
        _ratio(F.sum(support * _ratio(F.col("__tp"), support)), F.sum(support)).alias("recall"),
        _ratio(F.sum(support * _ratio(2 * F.col("__tp"), support + F.col("__pred"))), F.sum(support)).alias("f1"),
    )
    return to_long(wide, CLASSIFICATION_METRICS, keys)


def n_unlabelled(df: DataFrame, label: str = "label", group_cols: Sequence[str] = ()) -> DataFrame:
    """Per group: rows, and rows without a label, which no metric counts."""
    return df.groupBy(*group_cols).agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col(label).isNull()).alias("n_unlabelled"))


def mean_baseline(train: DataFrame, label: str, group_cols: Sequence[str] = ()) -> DataFrame:
    """The constant prediction: mean label of the training rows."""
    return settle(train.groupBy(*group_cols).agg(F.avg(F.col(label).cast("double")).alias("naive_prediction")))


def majority_baseline(train: DataFrame, label: str, group_cols: Sequence[str] = ()) -> DataFrame:
    """The most frequent label of the training rows; ties go to the smallest label."""
    counts = train.filter(F.col(label).isNotNull()).groupBy(*group_cols, label).agg(F.count(F.lit(1)).alias("__n"))
    best = F.min(F.struct((-F.col("__n")).alias("__rank"), F.col(label).alias("__label")))
    picked = counts.groupBy(*group_cols).agg(best.alias("__best"))
    return settle(picked.select(*group_cols, F.col("__best.__label").alias("naive_prediction")))


def side_by_side(long: DataFrame, role_col: str, names: Mapping[str, str], group_cols: Sequence[str] = ()) -> DataFrame:
    """Long metrics of several roles with one value column per role: `names` maps role to column.

    A pivot of the few metric rows, so that comparing roles needs neither a join nor a second
    pass over the rows the metrics came from.
    """
    return long.groupBy(*group_cols, "metric").agg(
        *[F.max(F.when(F.col(role_col) == role, F.col("value"))).alias(column) for role, column in names.items()]
    )


def baseline_predictions(
    test: DataFrame, naive: DataFrame, group_cols: Sequence[str] = (), previous: str | None = None
) -> DataFrame:
    """Baseline column for the test rows: the previous model's prediction, else the naive one.

    `naive` comes from `mean_baseline` or `majority_baseline`. A group falls back to the naive
    value as a whole when the previous model left any of its rows without a prediction.
    """
    keys = list(group_cols)
    if previous is None:
        return attach(test, naive, keys).select(
            *test.columns, F.col("naive_prediction").alias("baseline"), F.lit("naive_baseline").alias("baseline_source")
        )
    complete = settle(test.groupBy(*keys).agg(F.bool_and(F.col(previous).isNotNull()).alias("__complete")))
    joined = attach(attach(test, complete, keys), naive, keys)
    usable = F.col("__complete")
    return joined.select(
        *test.columns,
        F.when(usable, F.col(previous)).otherwise(F.col("naive_prediction")).alias("baseline"),
        F.when(usable, F.lit("previous_model")).otherwise(F.lit("naive_baseline")).alias("baseline_source"),
    )


def numeric_metrics(metrics: DataFrame, value_col: str = "value") -> DataFrame:
    """Rows of a long table whose value reads as a number, with that value as a double."""
    number = F.col(value_col).try_cast("double")
    return metrics.withColumn(value_col, number).filter(F.col(value_col).isNotNull())
