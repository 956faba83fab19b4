"""Watching the distribution of one value column, typically a model's predictions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftloom.functions.attach import attach
from driftloom.operators.drift import P_CUTOFF, ks_test
from driftloom.operators.ordering import quantiles, value_cells
from driftloom.sources.scratch import settle

# Fences at 1.5 interquartile ranges, and the outlier share that is an anomaly.
FENCE = 1.5
OUTLIER_CUTOFF = 0.05


def distribution_summary(
    df: DataFrame, value_col: str, group_cols: Sequence[str] = (), accuracy: float | None = None, cells: tuple[DataFrame, DataFrame] | None = None
) -> DataFrame:
    """Mean, sample standard deviation, extremes and median per group; the median is exact unless an `accuracy` is given."""
    keys = list(group_cols)
    cells = value_cells(df, value_col, keys) if cells is None else cells
    n = F.when(F.col("__cell").isNotNull(), F.col("__n"))
    means = settle(
        cells[1].groupBy(*keys).agg(
            F.sum(n).alias("__size"), F.try_divide(F.sum(n * F.col("__mean")), F.sum(n)).alias("mean"), F.min("__low").alias("min"), F.max("__high").alias("max")
        )
    )
    apart = F.col("__mean") - F.col("mean")
    spread = F.sqrt(F.sum(n * (F.col("__var") + apart * apart)) / F.nullif(F.max("__size") - 1, F.lit(0)))
    stds = attach(cells[1], means.select(*keys, "mean", "__size"), keys).groupBy(*keys).agg(spread.alias("std"))
    moments = attach(means, stds, keys).select(*keys, "mean", "std", "min", "max")
    return attach(moments, quantiles(df, value_col, {"median": 0.5}, keys, accuracy, cells), keys)


def iqr_outliers(
    df: DataFrame,
    value_col: str,
    group_cols: Sequence[str] = (),
    fence: float = FENCE,
    cutoff: float = OUTLIER_CUTOFF,
    accuracy: float | None = None,
    cells: tuple[DataFrame, DataFrame] | None = None,
) -> DataFrame:
    """Quartiles, values strictly outside the fences, their share, and whether that is an anomaly.

    The counts per cell that gave the quartiles also tell how many values lie outside; only the
    rows of cells that a fence runs through are looked at again. A group without values has nulls
    and no anomaly.
    """
    keys = list(group_cols)
    placed, counts = value_cells(df, value_col, keys) if cells is None else cells
    quartiles = quantiles(df, value_col, {"q1": 0.25, "q3": 0.75}, keys, accuracy, (placed, counts))
    spread = F.col("q3") - F.col("q1")
    fences = settle(
        quartiles.select(
            "*", (F.col("q1") - fence * spread).alias("lower_bound"), (F.col("q3") + fence * spread).alias("upper_bound")
        )
    )
    lower, upper = F.col("lower_bound"), F.col("upper_bound")
    fenced = attach(counts.filter("__cell IS NOT NULL"), fences, keys)
    crossed = ((F.col("__low") < lower) & (F.col("__high") >= lower)) | ((F.col("__low") <= upper) & (F.col("__high") > upper))
    whole = fenced.groupBy(*keys).agg(
        F.sum("__n").alias("__n"), F.sum(F.when(~crossed & ((F.col("__high") < lower) | (F.col("__low") > upper)), F.col("__n")).otherwise(0)).alias("__out")
    )
    open_cells = settle(fenced.filter(crossed).select(*keys, "__cell", "lower_bound", "upper_bound"))
    outside = (F.col("__v") < lower) | (F.col("__v") > upper)
    rows = attach(placed, open_cells, [*keys, "__cell"], how="inner").groupBy(*keys).agg(F.count_if(outside).alias("__more"))
    per_group = counts.groupBy(*keys).agg(F.sum("__n").alias("__rows"))
    counted = attach(attach(attach(per_group, fences, keys), whole, keys), rows, keys).select(
        *keys,
        "q1",
        "q3",
        "lower_bound",
        "upper_bound",
        (F.coalesce("__out", F.lit(0)) + F.coalesce("__more", F.lit(0))).alias("outlier_count"),
        F.col("__n"),
    )
    rated = counted.select(*[c for c in counted.columns if c != "__n"], F.try_divide(F.col("outlier_count").cast("double"), F.col("__n")).alias("outlier_rate"))
    return rated.select("*", F.coalesce(F.col("outlier_rate") > cutoff, F.lit(False)).alias("anomaly_detected"))


def prediction_monitor(
    df: DataFrame,
    prediction: str = "prediction",
    group_cols: Sequence[str] = (),
    is_ref: Column | None = None,
    is_cur: Column | None = None,
    cutoff: float = P_CUTOFF,
    method: str = "asymptotic",
    accuracy: float | None = None,
) -> DataFrame:
    """Summary of the current predictions and whether they look anomalous.

    With a reference sample the two are compared by the Kolmogorov-Smirnov test; without one
    the share of outliers decides.
    """
    keys = list(group_cols)
    current = df if is_cur is None else df.filter(is_cur)
    cells = value_cells(current, prediction, keys)
    summary = distribution_summary(current, prediction, keys, accuracy, cells)
    if is_ref is None:
        outliers = iqr_outliers(current, prediction, keys, accuracy=accuracy, cells=cells).select(*keys, "outlier_rate", "outlier_count", "anomaly_detected")
        return attach(summary, outliers, keys)
    sampled = F.lit(True) if is_cur is None else is_cur
    tested = ks_test(df, [prediction], is_ref, sampled, keys, method).select(
        *keys, "statistic", "p_value", F.coalesce(F.col("p_value") < cutoff, F.lit(False)).alias("anomaly_detected")
    )
    return attach(summary, tested, keys)
