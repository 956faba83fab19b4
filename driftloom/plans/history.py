"""Monitoring that reads every period of live data once.

Each period (a day, a week) leaves counts in a folder: how often every value of every watched
column occurs per segment, and the sums its error metrics are made of. A report merges the
counts of the periods it is about, so history is never read again as rows, and it says exactly
what `monitor_run` would say of all the rows. Counts of one value add up and sums merge, so
recording a period again, late or alone gives the same folder: its partition is replaced.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from driftloom.functions.attach import attach
from driftloom.operators.drift import P_CUTOFF, drift_of_counts, drift_summary, is_numeric, listed_rows
from driftloom.operators.gates import DEGRADATION_CUTOFF, degradation_of, degradation_summary
from driftloom.operators.metrics import MONITORING_METRICS, side_by_side, to_long
from driftloom.operators.reports import monitoring_report

PERIOD = "period"


def count_values(df: DataFrame, features: Sequence[str], group_cols: Sequence[str] = (), digits: int | None = None) -> DataFrame:
    """How often each value occurs: group, `feature`, `kind`, `number` or `text`, `n`. Missing values are counted as neither.

    With `digits` numbers are rounded first, which bounds how many there are; distributions are
    then compared at that resolution.
    """
    listed = listed_rows(df, features, F.lit(True), F.lit(False), group_cols)
    kinds = F.create_map(*[F.lit(x) for c in features for x in (c, "number" if is_numeric(df.schema[c].dataType) else "category")])
    number = F.col("number") if digits is None else F.round("number", digits)
    return listed.groupBy(*group_cols, "feature", kinds[F.col("feature")].alias("kind"), number.alias("number"), "text").agg(F.sum("ref").alias("n"))


def count_errors(df: DataFrame, label: str, prediction: str = "prediction", group_cols: Sequence[str] = ()) -> DataFrame:
    """What the regression metrics are made of, per group: `n`, `n_unpredicted`, summed errors, mean and spread of the label."""
    y, p = F.col(label).cast("double"), F.col(prediction).cast("double")
    return df.filter(y.isNotNull()).groupBy(*group_cols).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(p.isNull()).alias("n_unpredicted"),
        F.sum((y - p) * (y - p)).alias("squared"),
        F.sum(F.abs(y - p)).alias("absolute"),
        F.avg(y).alias("mean"),
        (F.var_pop(y) * F.count(F.lit(1))).alias("spread"),
    )


def merge_errors(errors: DataFrame, group_cols: Sequence[str] = (), metrics: Sequence[str] = MONITORING_METRICS) -> DataFrame:
    """Long regression metrics of the rows behind several `count_errors`, as `regression_metrics` gives them."""
    keys = list(group_cols)
    means = errors.groupBy(*keys).agg((F.sum(F.col("n") * F.col("mean")) / F.sum("n")).alias("__mean"))
    apart = F.col("mean") - F.col("__mean")
    sums = attach(errors, means, keys).groupBy(*keys).agg(
        F.sum("n").alias("__n"),
        F.sum("n_unpredicted").alias("__unpredicted"),
        (F.sum("squared") / F.sum("n")).alias("mse"),
        (F.sum("absolute") / F.sum("n")).alias("mae"),
        (F.sum(F.col("spread") + F.col("n") * apart * apart) / F.sum("n")).alias("__spread"),
    )
    r2 = (
        F.when(F.col("__n") < 2, F.lit(None).cast("double"))
        .when(F.col("__spread") > 0, 1 - F.try_divide(F.col("mse"), F.col("__spread")))
        .when(F.col("mse") == 0, F.lit(1.0))
        .otherwise(F.lit(0.0))
    )
    wide = sums.filter("__n > 0").select("*", F.sqrt("mse").alias("rmse"), r2.alias("r2"))
    whole = {m: F.when(F.col("__unpredicted") > 0, F.lit(float("nan"))).otherwise(F.col(m)).alias(m) for m in metrics}
    return to_long(wide.select(*keys, *whole.values()), list(metrics), keys)


def record_periods(
    scored: DataFrame,
    folder: str,
    period: Column,
    features: Sequence[str],
    label: str | None = None,
    prediction: str = "prediction",
    group_cols: Sequence[str] = (),
    digits: int | None = None,
) -> None:
    """Count the rows of one or several periods and put the counts into the folder.

    Only the given rows are read. A period that is there already is replaced as a whole, so give
    all of its rows; other periods are not touched.
    """
    rows = scored.withColumn(PERIOD, period.cast("string"))
    watched = [*dict.fromkeys([*[c for c in features if c != prediction], prediction])]
    parts = {"values": count_values(rows, watched, [*group_cols, PERIOD], digits)}
    if label is not None:
        parts["errors"] = count_errors(rows, label, prediction, [*group_cols, PERIOD])
    for name, counted in parts.items():
        writer = counted.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy(PERIOD).parquet(f"{folder}/{name}")


def read_periods(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """The recorded `values` or `errors`, with their `period` as text."""
    return spark.read.option("basePath", f"{folder}/{name}").parquet(f"{folder}/{name}").withColumn(PERIOD, F.col(PERIOD).cast("string"))


def monitor_periods(
    spark: SparkSession,
    folder: str,
    current_from: str,
    performance: bool = True,
    prediction: str = "prediction",
    group_cols: Sequence[str] = (),
    exclude_current: bool = False,
    p_cutoff: float = P_CUTOFF,
    degradation_cutoff: float = DEGRADATION_CUTOFF,
    method: str = "asymptotic",
) -> DataFrame:
    """The report of `monitor_run` from recorded counts: periods from `current_from` on against all (or all earlier) ones.

    Periods are compared as text, as dates written year first are.
    """
    keys = list(group_cols)
    is_cur = F.col(PERIOD) >= current_from
    is_ref = ~is_cur if exclude_current else F.lit(True)
    values = read_periods(spark, folder, "values")
    kinds = {r["feature"]: r["kind"] for r in values.select("feature", "kind").distinct().collect()}
    counts = [F.when(x, F.col("n")).otherwise(0).alias(c) for x, c in ((is_ref, "ref"), (is_cur, "cur"))]
    listed = values.select(*keys, "feature", "number", "text", *counts)
    numeric, categorical = (sorted(f for f, k in kinds.items() if k == kind) for kind in ("number", "category"))
    drift = drift_summary(drift_of_counts(listed, numeric, categorical, keys, p_cutoff, method), keys, prediction)
    loss = None
    if performance:
        errors = read_periods(spark, folder, "errors")
        samples = F.array_compact(F.array(F.when(is_ref, F.lit("baseline")), F.when(is_cur, F.lit("current"))))
        measured = merge_errors(errors.withColumn("__sample", F.explode(samples)), [*keys, "__sample"])
        both = side_by_side(measured, "__sample", {"current": "current", "baseline": "baseline"}, keys)
        compared = both.filter("current IS NOT NULL AND baseline IS NOT NULL")
        loss = degradation_summary(degradation_of(compared, keys, degradation_cutoff), keys)
    return monitoring_report(drift, loss, None, keys)
