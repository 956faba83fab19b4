"""Gates over long metrics tables: thresholds, baselines, verdicts and degradation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftloom.functions.attach import attach

# Default gates per kind of model, metrics where less is better, and the cutoff
# for a relative loss of performance.
DEFAULT_THRESHOLDS = {
    "classification": {"accuracy": 0.7, "precision": 0.7, "recall": 0.7, "f1": 0.7},
    "regression": {"r2": 0.65, "mape": 0.15},
}
LOWER_BETTER = ("mae", "mape", "mse", "rmse")
DEGRADATION_CUTOFF = 0.1


def default_thresholds(model_type: str = "regression", configured: Mapping[str, float] | None = None) -> dict[str, float]:
    """Configured gates, or the defaults of the model type when none are given."""
    return dict(configured or DEFAULT_THRESHOLDS[model_type])


def _lower_better(metric: Column) -> Column:
    return metric.isin(*LOWER_BETTER)


def _at_least_as_good(metric: Column, value: Column, bound: Column) -> Column:
    """Whether a value meets its bound; NaN on either side does not, though Spark orders it above every number."""
    no_number = F.isnan(value) | F.isnan(bound)
    return F.when(no_number, F.lit(False)).when(_lower_better(metric), value <= bound).otherwise(value >= bound)


def threshold_gate(metrics: DataFrame, thresholds: Mapping[str, float], group_cols: Sequence[str] = ()) -> DataFrame:
    """One row per segment and threshold; a metric the segment lacks passes.

    The segment's gated metrics are pivoted beside each other in one aggregate, then listed
    against the handful of thresholds, so nothing is joined.
    """
    names = list(thresholds)
    wide = metrics.groupBy(*group_cols).agg(
        *[F.max(F.when(F.col("metric") == n, F.struct("value"))).alias(f"__m{i}") for i, n in enumerate(names)]
    )
    checks = F.array(
        *[
            F.struct(
                F.lit(n).alias("metric"),
                F.lit(float(thresholds[n])).alias("threshold"),
                F.col(f"__m{i}")["value"].alias("value"),
                F.col(f"__m{i}").isNull().alias("__absent"),
            )
            for i, n in enumerate(names)
        ]
    )
    listed = wide.select(*group_cols, F.inline(checks))
    passed = F.when(F.col("__absent"), F.lit(True)).otherwise(
        F.coalesce(_at_least_as_good(F.col("metric"), F.col("value"), F.col("threshold")), F.lit(False))
    )
    return listed.select(*group_cols, "metric", "value", "threshold", passed.alias("passed"))


def baseline_gate(metrics: DataFrame, baseline: DataFrame, group_cols: Sequence[str] = ()) -> DataFrame:
    """One row per segment and metric with the baseline's value, verdict and relative delta.

    A metric without a baseline passes and has no delta; nor has one whose baseline is 0. The
    delta is positive when the candidate is better, whatever the metric's direction or sign.
    """
    keys = [*group_cols, "metric"]
    return gate_compared(attach(metrics, baseline.select(*keys, F.col("value").alias("baseline_value")), keys), group_cols)


def gate_compared(compared: DataFrame, group_cols: Sequence[str] = ()) -> DataFrame:
    """`baseline_gate` for a frame that already holds `value` and `baseline_value` side by side."""
    metric, new, base = F.col("metric"), F.col("value"), F.col("baseline_value")
    gain = F.when(_lower_better(metric), base - new).otherwise(new - base)
    return compared.select(
        *group_cols,
        "metric",
        "value",
        "baseline_value",
        F.try_divide(gain, F.abs(base)).alias("delta"),
        _meets(metric, new, base).alias("passed"),
    )


def _meets(metric: Column, value: Column, bound: Column) -> Column:
    """Whether a value passes its bound; a metric without a bound passes."""
    return F.when(bound.isNull(), F.lit(True)).otherwise(F.coalesce(_at_least_as_good(metric, value, bound), F.lit(False)))


def failed_names(passed: Column, name: Column) -> Column:
    """Aggregate: sorted names of the failed checks (there are only as many as metrics)."""
    return F.sort_array(F.collect_list(F.when(~passed, name)))


def verdict(threshold_checks: DataFrame, baseline_checks: DataFrame, group_cols: Sequence[str] = ()) -> DataFrame:
    """Per segment: both gates, what failed in each, and whether the model is accepted."""
    tagged = threshold_checks.select(*group_cols, F.lit("threshold").alias("gate"), "metric", "passed").unionByName(
        baseline_checks.select(*group_cols, F.lit("baseline").alias("gate"), "metric", "passed")
    )
    passed = F.col("passed")

    def gate_passed(gate: str) -> Column:
        return F.coalesce(F.bool_and(F.when(F.col("gate") == gate, passed)), F.lit(True))

    def gate_failed(gate: str) -> Column:
        return failed_names(passed | (F.col("gate") != gate), F.col("metric"))

    return tagged.groupBy(*group_cols).agg(
        (gate_passed("threshold") & gate_passed("baseline")).alias("validation_passed"),
        gate_passed("threshold").alias("threshold_passed"),
        gate_passed("baseline").alias("baseline_passed"),
        gate_failed("threshold").alias("failed_thresholds"),
        gate_failed("baseline").alias("failed_baseline"),
    )


def verdict_of(
    compared: DataFrame, thresholds: Mapping[str, float], group_cols: Sequence[str] = (), evidence: bool = False
) -> DataFrame:
    """`verdict` straight from a frame with `value` and `baseline_value` side by side.

    Both gates are conditions on the same metric rows, so one small aggregate decides. A
    `baseline_source` of `compared` is kept. With `evidence` the measured values, thresholds,
    baselines and both checks are kept as an array with one entry per metric, sorted by metric.
    """
    metric, value = F.col("metric"), F.col("value")
    bound = F.coalesce(*[F.when(metric == n, F.lit(float(t))) for n, t in thresholds.items()], F.lit(None).cast("double"))
    source = [c for c in ("baseline_source",) if c in compared.columns]
    checked = compared.select(
        *group_cols,
        "metric",
        "value",
        bound.alias("threshold"),
        "baseline_value",
        _meets(metric, value, bound).alias("threshold_ok"),
        _meets(metric, value, F.col("baseline_value")).alias("baseline_ok"),
        *source,
    )
    listed = F.struct("metric", "value", "threshold", "baseline_value", "threshold_ok", "baseline_ok")
    return checked.groupBy(*group_cols).agg(
        F.bool_and(F.col("threshold_ok") & F.col("baseline_ok")).alias("validation_passed"),
        F.bool_and("threshold_ok").alias("threshold_passed"),
        F.bool_and("baseline_ok").alias("baseline_passed"),
        failed_names(F.col("threshold_ok"), metric).alias("failed_thresholds"),
        failed_names(F.col("baseline_ok"), metric).alias("failed_baseline"),
        *[F.max(c).alias(c) for c in source],
        *([F.sort_array(F.collect_list(listed)).alias("evidence")] if evidence else []),
    )


def retrain_decision(champion: DataFrame, challenger: DataFrame, group_cols: Sequence[str]) -> DataFrame:
    """Per segment: keep the champion, promote the challenger, or reject it.

    Both inputs are verdicts. A segment without a champion counts as one whose champion failed.
    """
    keys = list(group_cols)
    tagged = champion.select(*keys, F.lit("champion").alias("role"), "validation_passed").unionByName(
        challenger.select(*keys, F.lit("challenger").alias("role"), "validation_passed")
    )

    def passed(role: str) -> Column:
        return F.coalesce(F.bool_or(F.when(F.col("role") == role, F.col("validation_passed"))), F.lit(False))

    both = tagged.groupBy(*keys).agg(passed("champion").alias("champion_passed"), passed("challenger").alias("challenger_passed"))
    decision = F.when(F.col("champion_passed"), "keep").when(F.col("challenger_passed"), "promote").otherwise("reject")
    return both.select("*", decision.alias("decision"))


def performance_degradation(
    current: DataFrame, baseline: DataFrame, group_cols: Sequence[str] = (), cutoff: float = DEGRADATION_CUTOFF
) -> DataFrame:
    """Relative loss against the baseline for the metrics both sides have."""
    keys = [*group_cols, "metric"]
    joined = attach(
        current.select(*keys, F.col("value").alias("current")),
        baseline.select(*keys, F.col("value").alias("baseline")),
        keys,
        how="inner",
    )
    return degradation_of(joined, group_cols, cutoff)


def degradation_of(compared: DataFrame, group_cols: Sequence[str] = (), cutoff: float = DEGRADATION_CUTOFF) -> DataFrame:
    """`performance_degradation` for a frame that already holds `current` and `baseline` side by side.

    A current value of NaN (as of a model that left rows without a prediction) is degraded. A
    baseline of NaN tells nothing, and nothing is degraded against it.
    """
    now, base = F.col("current"), F.col("baseline")
    loss = F.try_divide(F.when(_lower_better(F.col("metric")), now - base).otherwise(base - now), F.abs(base))
    return compared.select(*group_cols, "metric", "current", "baseline", loss.alias("degradation")).withColumn(
        "is_degraded",
        F.when(F.isnan("current"), F.lit(True))
        .when(F.isnan("baseline"), F.lit(False))
        .otherwise(F.coalesce(F.col("degradation") > cutoff, F.lit(False))),
    )


def degradation_summary(degradation: DataFrame, group_cols: Sequence[str] = ()) -> DataFrame:
    """Per segment: is any metric degraded, and which."""
    return degradation.groupBy(*group_cols).agg(
        F.coalesce(F.bool_or("is_degraded"), F.lit(False)).alias("degradation_detected"),
        failed_names(~F.col("is_degraded"), F.col("metric")).alias("degraded_metrics"),
    )
