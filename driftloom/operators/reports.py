"""The monitoring report: alerts and an overall status per segment."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftloom.functions.attach import attach


def _alert(kind: str, severity: str, message):
    return F.struct(F.lit(kind).alias("type"), F.lit(severity).alias("severity"), message.alias("message"))


def monitoring_report(
    drift: DataFrame,
    performance: DataFrame | None = None,
    predictions: DataFrame | None = None,
    group_cols: Sequence[str] = (),
) -> DataFrame:
    """Combine per-segment summaries into alerts (data drift, performance, predictions) and a status.

    Inputs are a drift summary, a degradation summary and a prediction monitor; the last two may
    be left out, and the drift summary may carry `anomaly_detected` itself. A segment is critical when performance degraded, else a warning with any alert.
    """
    keys = list(group_cols)
    carried = ["anomaly_detected"] if predictions is None and "anomaly_detected" in drift.columns else []
    joined = drift.select(*keys, "drift_detected", "drifted_features", *carried)
    nothing = F.array().cast("array<string>")
    if performance is not None:
        joined = attach(joined, performance.select(*keys, "degradation_detected", "degraded_metrics"), keys)
    else:
        joined = joined.select("*", F.lit(False).alias("degradation_detected"), nothing.alias("degraded_metrics"))
    if predictions is not None:
        joined = attach(joined, predictions.select(*keys, "anomaly_detected"), keys)
    elif not carried:
        joined = joined.select("*", F.lit(False).alias("anomaly_detected"))
    drifted, degraded, anomalous = (
        F.coalesce(F.col(c), F.lit(False)) for c in ("drift_detected", "degradation_detected", "anomaly_detected")
    )
    alerts = F.array_compact(
        F.array(
            F.when(
                drifted,
                _alert("data_drift", "warning", F.format_string("Data drift detected in %d features", F.size("drifted_features"))),
            ),
            F.when(
                degraded,
                _alert(
                    "performance_degradation",
                    "critical",
                    F.format_string("Performance degradation in %d metrics", F.size("degraded_metrics")),
                ),
            ),
            F.when(
                anomalous,
                _alert("prediction_anomaly", "warning", F.lit("Anomaly detected in prediction distribution")),
            ),
        )
    )
    status = F.when(degraded, "critical").when(drifted | anomalous, "warning").otherwise("healthy")
    return joined.select(
        *keys,
        status.alias("overall_status"),
        drifted.alias("drift_detected"),
        "drifted_features",
        degraded.alias("degradation_detected"),
        F.coalesce("degraded_metrics", nothing).alias("degraded_metrics"),
        anomalous.alias("anomaly_detected"),
        alerts.alias("alerts"),
    )


def monitoring_rows(
    report: DataFrame, model_name: str, model_version: int, group_cols: Sequence[str] = (), at: object = None
) -> DataFrame:
    """Flat rows for the results table: names as a comma list, alerts as JSON text."""
    stamp = F.current_timestamp() if at is None else F.lit(at).cast("timestamp")
    return report.select(
        F.lit(model_name).alias("model_name"),
        F.lit(model_version).cast("int").alias("model_version"),
        *group_cols,
        stamp.alias("monitoring_timestamp"),
        "overall_status",
        F.col("drift_detected").cast("boolean").alias("drift_detected"),
        F.array_join("drifted_features", ",").alias("drifted_features"),
        F.to_json("alerts").alias("alerts"),
    )
