"""Drift, predictions, degradation and the monitoring report."""

from __future__ import annotations

from pyspark.sql import functions as F

from driftloom.catalogue.common import Query, chi_square_sql, ks_sql, metrics_sql, r, rounded, table
from driftloom.functions.attach import attach
from driftloom.operators.drift import chi_square_test, drift_summary, feature_drift, ks_test
from driftloom.operators.gates import degradation_of
from driftloom.operators.models import fit_single_feature, score_linear
from driftloom.operators.ordering import quantiles
from driftloom.operators.predictions import distribution_summary, iqr_outliers, prediction_monitor
from driftloom.operators.sketches import merge_sketches, read_quantiles, sketch_values
from driftloom.plans.history import monitor_periods, record_periods
from driftloom.plans.monitoring import compare_samples, monitor_run, samples_by_date
from driftloom.sources.scratch import fresh_path, settle

TEST_COLUMNS = ["feature", "kind", "n_ref", "n_cur", "statistic", "p_value"]


MID_JANUARY, SHIP_CUT = "2024-01-16", "1999-01-01"


def _event_samples():
    is_ref = F.col("ts") < F.lit(MID_JANUARY).cast("timestamp_ntz")
    return is_ref, ~is_ref


def _ship_samples():
    is_ref = F.col("l_shipdate") < F.lit(SHIP_CUT).cast("timestamp_ntz")
    return is_ref, ~is_ref


def ks_drift_events(spark, sf_dir):
    tested = ks_test(table(spark, sf_dir, "events"), ["value"], *_event_samples(), ["event_type"], method="asymptotic")
    return rounded(tested.select("event_type", *TEST_COLUMNS), 8, "statistic", "p_value")


def ks_exact_events(spark, sf_dir):
    """The exact distribution over all interleavings."""
    tested = ks_test(table(spark, sf_dir, "events"), ["value"], *_event_samples(), ["event_type"], method="exact")
    return rounded(tested.select("event_type", *TEST_COLUMNS, "p_method"), 8, "statistic", "p_value")


def ks_drift_multi_lineitem(spark, sf_dir):
    features = ["l_quantity", "l_extendedprice", "l_discount"]
    tested = ks_test(table(spark, sf_dir, "lineitem"), features, *_ship_samples(), ["l_linestatus"], method="asymptotic")
    return rounded(tested.select("l_linestatus", *TEST_COLUMNS), 8, "statistic", "p_value")


def chi_square_drift_events(spark, sf_dir):
    tested = chi_square_test(table(spark, sf_dir, "events"), ["event_type"], *_event_samples())
    return rounded(tested.select(*TEST_COLUMNS), 6, "statistic", "p_value")


MIXED = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag"]


def _drift_lineitem(spark, sf_dir):
    return feature_drift(table(spark, sf_dir, "lineitem"), *_ship_samples(), MIXED, ["l_linestatus"], method="asymptotic")


def feature_drift_lineitem(spark, sf_dir):
    drift = _drift_lineitem(spark, sf_dir).select("l_linestatus", *TEST_COLUMNS, "drift_detected", "status")
    return rounded(drift, 6, "statistic", "p_value")


def drift_summary_lineitem(spark, sf_dir):
    summary = drift_summary(_drift_lineitem(spark, sf_dir), ["l_linestatus"])
    return summary.select("l_linestatus", "drift_detected", F.array_join("drifted_features", ",").alias("drifted_features"))


def prediction_stats_events(spark, sf_dir):
    summary = distribution_summary(table(spark, sf_dir, "events"), "value", ["event_type"])
    return rounded(summary, 6, "mean", "std", "min", "max", "median")


def iqr_outliers_events(spark, sf_dir):
    outliers = iqr_outliers(table(spark, sf_dir, "events"), "value", ["event_type"])
    return rounded(outliers, 6, "q1", "q3", "lower_bound", "upper_bound", "outlier_rate")


def iqr_outliers_lineitem(spark, sf_dir):
    outliers = iqr_outliers(table(spark, sf_dir, "lineitem"), "l_extendedprice")
    return rounded(outliers, 6, "q1", "q3", "lower_bound", "upper_bound", "outlier_rate")


def approx_quartiles_lineitem(spark, sf_dir):
    """Sketched quartiles of each day's part merged, and whether their exact ranks are within the stated error."""
    lines = table(spark, sf_dir, "lineitem").select("l_returnflag", "l_linestatus", "l_extendedprice")
    probs, accuracy = {"q1": 0.25, "median": 0.5, "q3": 0.75}, 0.02
    parts = sketch_values(lines, "l_extendedprice", ["l_returnflag", "l_linestatus"], accuracy)
    found = settle(read_quantiles(merge_sketches(parts, ["l_returnflag"], accuracy), probs, ["l_returnflag"]))
    beside = attach(lines, found, ["l_returnflag"])
    ranks = [
        F.struct(
            F.lit(name).alias("name"),
            (F.count_if(F.col("l_extendedprice") < F.col(name)) / F.count(F.lit(1)) <= p + accuracy).alias("not_above"),
            (F.count_if(F.col("l_extendedprice") <= F.col(name)) / F.count(F.lit(1)) >= p - accuracy).alias("not_below"),
        ).alias(f"__{name}")
        for name, p in probs.items()
    ]
    held = beside.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n"), *ranks)
    return held.select("l_returnflag", "n", F.inline(F.array(*[f"__{n}" for n in probs])))


def approx_median_events(spark, sf_dir):
    """A coarse median through the accuracy flag of the summary, as a test of whether it is near the exact one."""
    summary = distribution_summary(table(spark, sf_dir, "events"), "value", ["event_type"], accuracy=0.05)
    exact = quantiles(table(spark, sf_dir, "events"), "value", {"low": 0.44, "high": 0.56}, ["event_type"])
    near = attach(summary, exact, ["event_type"])
    return near.select("event_type", F.col("median").between(F.col("low"), F.col("high")).alias("within"))


def prediction_drift_events(spark, sf_dir):
    watched = prediction_monitor(table(spark, sf_dir, "events"), "value", ["event_type"], *_event_samples(), method="asymptotic")
    return rounded(watched, 6, "mean", "std", "min", "max", "median", "statistic", "p_value")


AS_OF, DAYS = "2001-11-04", 400
REPORT_FEATURES = ["l_quantity", "l_discount", "l_linestatus"]


def scored_lineitem(spark, sf_dir):
    """Line rows with the prediction of a line fitted per return flag on everything but the last period."""
    lines = table(spark, sf_dir, "lineitem").select(
        "l_returnflag", "l_linestatus", "l_quantity", "l_discount", "l_extendedprice", "l_shipdate"
    )
    _, is_cur = samples_by_date("l_shipdate", DAYS, AS_OF)
    fitted = fit_single_feature(lines.filter(~is_cur), ["l_quantity"], "l_extendedprice", ["l_returnflag"])
    return score_linear(lines, fitted, ["l_quantity"], ["l_returnflag"])


def degradation_lineitem(spark, sf_dir):
    scored = scored_lineitem(spark, sf_dir)
    is_ref, is_cur = samples_by_date("l_shipdate", DAYS, AS_OF)
    compared = compare_samples(scored, "l_extendedprice", "prediction", is_ref, is_cur, ["l_returnflag"])
    return rounded(degradation_of(compared, ["l_returnflag"]), 4, "current", "baseline", "degradation")


def report_lineitem(spark, sf_dir):
    is_ref, is_cur = samples_by_date("l_shipdate", DAYS, AS_OF)
    return monitor_run(
        scored_lineitem(spark, sf_dir),
        REPORT_FEATURES,
        is_ref,
        is_cur,
        "l_extendedprice",
        group_cols=["l_returnflag"],
        method="asymptotic",
    )


def monitoring_report_lineitem(spark, sf_dir):
    return flat_report(report_lineitem(spark, sf_dir))


def prediction_report_lineitem(spark, sf_dir):
    """Monitoring without a reference sample: statistics of the current predictions, and outliers in place of drift."""
    _, is_cur = samples_by_date("l_shipdate", DAYS, AS_OF)
    lines = table(spark, sf_dir, "lineitem").withColumn("prediction", F.col("l_extendedprice") * F.col("l_tax"))
    report = monitor_run(lines, [], None, is_cur, group_cols=["l_returnflag"], statistics=True)
    flat = report.select("l_returnflag", "overall_status", "drift_detected", "anomaly_detected", "prediction_statistics.*")
    return rounded(flat, 6, "mean", "std", "min", "max", "median", "outlier_rate")


def history_report_lineitem(spark, sf_dir):
    """The report from counts that every year has left; the last year is recorded later than the others, one twice."""
    lines = table(spark, sf_dir, "lineitem").select("l_returnflag", "l_linestatus", "l_quantity", "l_discount", "l_extendedprice", "l_shipdate")
    fitted = fit_single_feature(lines.filter(F.year("l_shipdate") < 2001), ["l_quantity"], "l_extendedprice", ["l_returnflag"])
    scored = score_linear(lines, fitted, ["l_quantity"], ["l_returnflag"])
    folder, year = fresh_path(spark, "history"), F.year("l_shipdate")
    for part in (scored.filter(year < 2001), scored.filter(year == 2001), scored.filter(year == 1999)):
        record_periods(part, folder, F.trunc("l_shipdate", "year"), REPORT_FEATURES, "l_extendedprice", group_cols=["l_returnflag"])
    return flat_report(monitor_periods(spark, folder, "2001-01-01", group_cols=["l_returnflag"]))


def flat_report(report):
    return report.select(
        "l_returnflag",
        "overall_status",
        "drift_detected",
        F.array_join("drifted_features", ",").alias("drifted_features"),
        "degradation_detected",
        F.array_join("degraded_metrics", ",").alias("degraded_metrics"),
        "anomaly_detected",
        F.array_join(F.transform("alerts", lambda a: F.concat_ws(":", a["type"], a["severity"], a["message"])), ";").alias("alerts"),
    )


E_REF, E_CUR = f"ts < TIMESTAMP '{MID_JANUARY}'", f"ts >= TIMESTAMP '{MID_JANUARY}'"
L_REF, L_CUR = f"l_shipdate < TIMESTAMP '{SHIP_CUT}'", f"l_shipdate >= TIMESTAMP '{SHIP_CUT}'"


def _tests(digits: int) -> str:
    return f"feature, kind, n_ref, n_cur, {r('statistic', digits, 'statistic')}, {r('p_value', digits, 'p_value')}"


DRIFT = f"""drift AS (SELECT * FROM {ks_sql('lineitem', ['l_linestatus'], MIXED[:-1], L_REF, L_CUR)}
  UNION ALL SELECT * FROM {chi_square_sql('lineitem', ['l_linestatus'], 'l_returnflag', L_REF, L_CUR, 2)})"""
FENCES = """q AS (SELECT {keys} quantile_cont({v}, 0.25) AS q1, quantile_cont({v}, 0.75) AS q3 FROM {t} GROUP BY ALL),
f AS (SELECT *, q1 - 1.5 * (q3 - q1) AS lower_bound, q3 + 1.5 * (q3 - q1) AS upper_bound FROM q),
o AS (SELECT {keys} any_value(q1) AS q1, any_value(q3) AS q3, any_value(lower_bound) AS lower_bound, any_value(upper_bound) AS upper_bound,
  count(*) FILTER ({v} < lower_bound OR {v} > upper_bound) AS outlier_count, count(*) AS n FROM {t} {join} GROUP BY ALL)"""


def _outliers_sql(t: str, v: str, key: str | None) -> str:
    fences = FENCES.format(t=t, v=v, keys=f"{key}," if key else "", join=f"JOIN f USING ({key})" if key else ", f")
    columns = ", ".join(r(c, 6, c) for c in ("q1", "q3", "lower_bound", "upper_bound"))
    return f"""WITH {fences} SELECT {f'{key}, ' if key else ''}{columns}, outlier_count,
      {r('outlier_count::DOUBLE / n', 6, 'outlier_rate')}, outlier_count::DOUBLE / n > 0.05 AS anomaly_detected FROM o"""


MOMENTS = ", ".join(
    r(e, 6, n)
    for e, n in (("avg(value)", "mean"), ("stddev_samp(value)", "std"), ("min(value)", "min"), ("max(value)", "max"), ("median(value)", "median"))
)
# The chance of having touched the region beyond the statistic, along the anti-diagonals of the lattice of interleavings.
KS_EXACT_SQL = f"""WITH RECURSIVE d AS {ks_sql('events', ['event_type'], ['value'], E_REF, E_CUR)},
z AS (SELECT *, least(n_ref, n_cur) AS n, greatest(n_ref, n_cur) AS m, lcm(n_ref, n_cur) AS step FROM d),
walk AS (SELECT event_type, n, m, step // n AS pi, step // m AS pj, round(statistic * step)::BIGINT AS h, 0::BIGINT AS s,
    list_transform(range(n + 1), lambda i: 0.0::DOUBLE) AS t FROM z
  UNION ALL SELECT event_type, n, m, pi, pj, h, s + 1, list_transform(range(n + 1), lambda i:
    CASE WHEN i > s + 1 OR s + 1 - i > m THEN 0.0::DOUBLE WHEN abs(i * pi - (s + 1 - i) * pj) >= h THEN 1.0::DOUBLE
    ELSE (i * coalesce(t[i], 0) + (s + 1 - i) * t[i + 1]) / (s + 1) END) FROM walk WHERE s < n + m)
SELECT event_type, feature, kind, n_ref, n_cur, {r('statistic', 8, 'statistic')}, {r('t[z.n + 1]', 8, 'p_value')}, 'exact' AS p_method
FROM z JOIN walk USING (event_type) WHERE s = z.n + z.m"""
R_CUR = f"l_shipdate >= DATE '{AS_OF}' - INTERVAL {DAYS} DAY"
def _scored_sql(current: str) -> str:
    return f"""f AS (SELECT l_returnflag, regr_intercept(l_extendedprice, l_quantity) AS b, regr_slope(l_extendedprice, l_quantity) AS w
  FROM lineitem WHERE NOT ({current}) GROUP BY 1),
s AS (SELECT l_returnflag, l_linestatus, l_quantity, l_discount, l_shipdate, l_extendedprice AS y, b + w * l_quantity AS prediction
  FROM lineitem JOIN f USING (l_returnflag)),
s_cur AS (SELECT * FROM s WHERE {current}),
cur AS {metrics_sql('s_cur', 'y', 'prediction', ['l_returnflag'], ['rmse', 'mae', 'r2'])},
ref AS {metrics_sql('s', 'y', 'prediction', ['l_returnflag'], ['rmse', 'mae', 'r2'])},
deg AS (SELECT l_returnflag, metric, cur.value AS current, ref.value AS baseline,
  (CASE WHEN metric = 'r2' THEN ref.value - cur.value ELSE cur.value - ref.value END) / nullif(abs(ref.value), 0) AS degradation
  FROM cur JOIN ref USING (l_returnflag, metric))"""

# One degree of freedom: the tail is erfc(sqrt(x / 2)), approximated here by a rational form
# (Abramowitz and Stegun 7.1.26), far more exact than a comparison with the cutoff needs.
_X = "sqrt(statistic / 2)"
_T = f"(1 / (1 + 0.3275911 * {_X}))"
ERFC = f"""({_T} * (0.254829592 + {_T} * (-0.284496736 + {_T} * (1.421413741 + {_T} * (-1.453152027 + {_T} * 1.061405429))))
  * exp(-statistic / 2))"""
def _report_sql(current: str) -> str:
    return f"""tests AS (SELECT l_returnflag, feature, p_value FROM {ks_sql('s', ['l_returnflag'], ['l_quantity', 'l_discount'], 'TRUE', current)}
  UNION ALL SELECT l_returnflag, feature, {ERFC} FROM {chi_square_sql('s', ['l_returnflag'], 'l_linestatus', 'TRUE', current, 2)}),
dr AS (SELECT l_returnflag, bool_or(p_value < 0.05) AS drift_detected, count(*) FILTER (p_value < 0.05) AS nd,
  coalesce(string_agg(CASE WHEN p_value < 0.05 THEN feature END, ',' ORDER BY feature), '') AS drifted_features FROM tests GROUP BY 1),
dg AS (SELECT l_returnflag, coalesce(bool_or(degradation > 0.1), FALSE) AS degradation_detected, count(*) FILTER (degradation > 0.1) AS ng,
  coalesce(string_agg(CASE WHEN degradation > 0.1 THEN metric END, ',' ORDER BY metric), '') AS degraded_metrics FROM deg GROUP BY 1),
pr AS (SELECT l_returnflag, p_value < 0.05 AS anomaly_detected FROM {ks_sql('s', ['l_returnflag'], ['prediction'], 'TRUE', current)})"""

def _whole_report_sql(current: str) -> str:
    return f"""WITH {_scored_sql(current)}, {_report_sql(current)}
    SELECT l_returnflag, CASE WHEN degradation_detected THEN 'critical' WHEN drift_detected OR anomaly_detected THEN 'warning' ELSE 'healthy' END AS overall_status,
      drift_detected, drifted_features, degradation_detected, degraded_metrics, anomaly_detected,
      concat_ws(';', CASE WHEN drift_detected THEN 'data_drift:warning:Data drift detected in ' || nd || ' features' END,
        CASE WHEN degradation_detected THEN 'performance_degradation:critical:Performance degradation in ' || ng || ' metrics' END,
        CASE WHEN anomaly_detected THEN 'prediction_anomaly:warning:Anomaly detected in prediction distribution' END) AS alerts
    FROM dr JOIN dg USING (l_returnflag) JOIN pr USING (l_returnflag)"""


QUERIES: dict[str, Query] = {
    "ks_drift_events": (
        ks_drift_events,
        f"SELECT event_type, {_tests(8)} FROM {ks_sql('events', ['event_type'], ['value'], E_REF, E_CUR)}",
    ),
    "ks_exact_events": (ks_exact_events, KS_EXACT_SQL),
    "ks_drift_multi_lineitem": (
        ks_drift_multi_lineitem,
        f"""SELECT l_linestatus, {_tests(8)}
        FROM {ks_sql('lineitem', ['l_linestatus'], ['l_quantity', 'l_extendedprice', 'l_discount'], L_REF, L_CUR)}""",
    ),
    "chi_square_drift_events": (
        chi_square_drift_events,
        f"SELECT {_tests(6)} FROM {chi_square_sql('events', [], 'event_type', E_REF, E_CUR, 4)}",
    ),
    "feature_drift_lineitem": (
        feature_drift_lineitem,
        f"WITH {DRIFT} SELECT l_linestatus, {_tests(6)}, p_value < 0.05 AS drift_detected, 'ok' AS status FROM drift",
    ),
    "drift_summary_lineitem": (
        drift_summary_lineitem,
        f"""WITH {DRIFT} SELECT l_linestatus, bool_or(p_value < 0.05) AS drift_detected,
        coalesce(string_agg(CASE WHEN p_value < 0.05 THEN feature END, ',' ORDER BY feature), '') AS drifted_features FROM drift GROUP BY 1""",
    ),
    "prediction_stats_events": (prediction_stats_events, f"SELECT event_type, {MOMENTS} FROM events GROUP BY 1"),
    "iqr_outliers_events": (iqr_outliers_events, _outliers_sql("events", "value", "event_type")),
    "iqr_outliers_lineitem": (iqr_outliers_lineitem, _outliers_sql("lineitem", "l_extendedprice", None)),
    "prediction_drift_events": (
        prediction_drift_events,
        f"""WITH k AS {ks_sql('events', ['event_type'], ['value'], E_REF, E_CUR)},
        m AS (SELECT event_type, {MOMENTS} FROM events WHERE {E_CUR} GROUP BY 1)
        SELECT m.*, {r('statistic', 6, 'statistic')}, {r('p_value', 6, 'p_value')}, p_value < 0.05 AS anomaly_detected
        FROM m JOIN k USING (event_type)""",
    ),
    "approx_quartiles_lineitem": (
        approx_quartiles_lineitem,
        """SELECT l_returnflag, count(*) AS n, name, TRUE AS not_above, TRUE AS not_below
        FROM lineitem, (SELECT unnest(['q1', 'median', 'q3']) AS name) GROUP BY l_returnflag, name""",
    ),
    "approx_median_events": (approx_median_events, "SELECT DISTINCT event_type, TRUE AS within FROM events"),
    "prediction_report_lineitem": (
        prediction_report_lineitem,
        f"""WITH x AS (SELECT l_returnflag, l_extendedprice * l_tax AS value FROM lineitem WHERE {R_CUR}),
        q AS (SELECT l_returnflag, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM x GROUP BY 1),
        o AS (SELECT l_returnflag, {MOMENTS}, count(*) FILTER (value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1)) AS outlier_count,
          count(*) AS n FROM x JOIN q USING (l_returnflag) GROUP BY 1)
        SELECT l_returnflag, CASE WHEN outlier_count::DOUBLE / n > 0.05 THEN 'warning' ELSE 'healthy' END AS overall_status, FALSE AS drift_detected,
          outlier_count::DOUBLE / n > 0.05 AS anomaly_detected, mean, std, min, max, median, outlier_count,
          {r('outlier_count::DOUBLE / n', 6, 'outlier_rate')} FROM o""",
    ),
    "history_report_lineitem": (history_report_lineitem, _whole_report_sql("l_shipdate >= TIMESTAMP '2001-01-01'")),
    "degradation_lineitem": (
        degradation_lineitem,
        f"""WITH {_scored_sql(R_CUR)} SELECT l_returnflag, metric, {r('current', 4, 'current')}, {r('baseline', 4, 'baseline')},
        {r('degradation', 4, 'degradation')}, coalesce(degradation > 0.1, FALSE) AS is_degraded FROM deg""",
    ),
    "monitoring_report_lineitem": (
        monitoring_report_lineitem,
        _whole_report_sql(R_CUR),
    ),
}
