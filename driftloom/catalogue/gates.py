"""Gates, verdicts and retraining decisions."""

from __future__ import annotations

from functools import reduce

from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from driftloom.catalogue.common import Query, metrics_sql, r, rounded
from driftloom.catalogue.fits import GUESS, SPLIT_LINES, split_lineitem, status_guess, weighted_sql
from driftloom.operators.gates import gate_compared, threshold_gate
from driftloom.operators.models import coef, fit_single_feature, score_linear
from driftloom.operators.scoring import LinearTable, PythonModel, spark_candidate
from driftloom.plans.validation import compare_with_baseline, retrain_run, validate_model, validate_run, validation_metrics

SEGMENT = ["l_returnflag", "l_linestatus"]
# Gates loose enough for some segments to pass and others to fail; f1 is not a regression metric.
GATES = {"r2": -0.0005, "mape": 1.8, "f1": 0.5}
LABEL, SLOPE = "l_extendedprice", "l_quantity"


def _scored(spark, sf_dir):
    rows = split_lineitem(spark, sf_dir, *SEGMENT, SLOPE, LABEL)
    train, test = rows.filter("split = 'train'"), rows.filter("split = 'test'")
    return train, score_linear(test, fit_single_feature(train, [SLOPE], LABEL, SEGMENT), [SLOPE], SEGMENT)


def _compared(spark, sf_dir):
    train, scored = _scored(spark, sf_dir)
    return compare_with_baseline(scored, LABEL, "prediction", SEGMENT, train=train)


def threshold_gate_lineitem(spark, sf_dir):
    _, scored = _scored(spark, sf_dir)
    return rounded(threshold_gate(validation_metrics(scored, LABEL, "prediction", SEGMENT), GATES, SEGMENT), 8, "value")


def _broken_gate(spark, sf_dir, prediction):
    """The threshold gate when the model fails on some rows of the segments with status O."""
    _, scored = _scored(spark, sf_dir)
    hit = (F.col("l_linestatus") == "O") & (F.col(SLOPE) == 7)
    broken = scored.withColumn("prediction", F.when(hit, F.lit(prediction).cast("double")).otherwise(F.col("prediction")))
    return rounded(threshold_gate(validation_metrics(broken, LABEL, "prediction", SEGMENT), GATES, SEGMENT), 8, "value")


def gate_unpredicted_lineitem(spark, sf_dir):
    return _broken_gate(spark, sf_dir, None)


def gate_nan_lineitem(spark, sf_dir):
    return _broken_gate(spark, sf_dir, float("nan"))


def baseline_gate_lineitem(spark, sf_dir):
    gated = gate_compared(_compared(spark, sf_dir), SEGMENT)
    return rounded(gated.drop("delta"), 8, "value", "baseline_value")


def metric_delta_lineitem(spark, sf_dir):
    gated = gate_compared(_compared(spark, sf_dir), SEGMENT)
    return rounded(gated.select(*SEGMENT, "metric", "delta"), 6, "delta")


def _flat(df, *lists):
    return df.select(*[F.array_join(c, ",").alias(c) if c in lists else F.col(c) for c in df.columns])


def validation_verdict_lineitem(spark, sf_dir):
    train, scored = _scored(spark, sf_dir)
    verdicts = validate_run(scored, LABEL, "prediction", SEGMENT, thresholds=GATES, train=train, evidence=False)
    return _flat(verdicts, "failed_thresholds", "failed_baseline")


def validation_untrained_lineitem(spark, sf_dir):
    """Returned goods have no training rows, so no baseline holds them back."""
    train, scored = _scored(spark, sf_dir)
    known = train.filter("l_returnflag <> 'R'")
    return _flat(validate_run(scored, LABEL, "prediction", SEGMENT, thresholds=GATES, train=known, evidence=False), "failed_thresholds", "failed_baseline")


def retrain_untrained_lineitem(spark, sf_dir):
    train, scored = _scored(spark, sf_dir)
    both = scored.withColumn("champion", F.lit(53000.0))
    return retrain_run(both, LABEL, "champion", "prediction", train.filter("l_returnflag <> 'R'"), SEGMENT, thresholds=GATES)


def any_model_verdict_lineitem(spark, sf_dir):
    """The same line as a coefficient table, a `spark.ml` model and a Python one: three verdicts per segment."""
    rows = split_lineitem(spark, sf_dir, *SEGMENT, SLOPE, LABEL)
    train, test = rows.filter("split = 'train'"), rows.filter("split = 'test'")
    line = fit_single_feature(train, [SLOPE], LABEL)
    b, w = line.select("intercept", coef(SLOPE)).first()
    models = {
        "table": LinearTable(line, (SLOPE,)),
        "spark_ml": spark_candidate(LinearRegression(solver="normal"))(train, [SLOPE], LABEL),
        "python": PythonModel(lambda: (b, w), lambda model, batch: model[0] + model[1] * batch.column(SLOPE).to_numpy(), (SLOPE,)),
    }
    verdicts = [
        validate_model(test, model, LABEL, (SLOPE,), SEGMENT, train=train, thresholds=GATES, evidence=False).withColumn("model", F.lit(name))
        for name, model in models.items()
    ]
    return _flat(reduce(lambda x, y: x.unionByName(y), verdicts), "failed_thresholds", "failed_baseline")


def verdict_evidence_lineitem(spark, sf_dir):
    """What the verdicts rest on, one row per segment and metric."""
    train, scored = _scored(spark, sf_dir)
    verdicts = validate_run(scored, LABEL, "prediction", SEGMENT, thresholds=GATES, train=train)
    return rounded(verdicts.select(*SEGMENT, F.inline("evidence")), 8, "value", "baseline_value")


def classification_verdict_orders(spark, sf_dir):
    rows = status_guess(spark, sf_dir)
    verdicts = validate_run(rows, "o_orderstatus", "guess", ["o_orderpriority"], "classification", train=rows, evidence=False)
    return _flat(verdicts, "failed_thresholds", "failed_baseline")


def retrain_decision_lineitem(spark, sf_dir):
    """The champion is one flat price for all; the challenger is the fitted line."""
    train, scored = _scored(spark, sf_dir)
    both = scored.withColumn("champion", F.lit(53000.0))
    return retrain_run(both, LABEL, "champion", "prediction", train, SEGMENT, thresholds=GATES)


TESTED = f"""x AS ({SPLIT_LINES}), f AS (SELECT l_returnflag, l_linestatus, regr_intercept(l_extendedprice, l_quantity) AS b,
  regr_slope(l_extendedprice, l_quantity) AS w, avg(l_extendedprice) AS naive FROM x WHERE split = 'train' GROUP BY 1, 2),
s AS (SELECT x.l_returnflag, x.l_linestatus, l_extendedprice AS y, b + w * l_quantity AS p, naive AS q, 53000.0::DOUBLE AS c
  FROM x JOIN f USING (l_returnflag, l_linestatus) WHERE split = 'test')"""
KEYS = "l_returnflag, l_linestatus"


def _pass(value: str, bound: str) -> str:
    return f"(CASE WHEN metric IN ('mae', 'mape', 'mse', 'rmse') THEN {value} <= {bound} ELSE {value} >= {bound} END)"


def _metrics(p: str) -> str:
    return metrics_sql("s", "y", p, SEGMENT, ["r2", "mape"])


COMPARED = f"""cand AS {_metrics('p')}, base AS {_metrics('q')},
cmp AS (SELECT cand.*, base.value AS baseline_value FROM cand LEFT JOIN base USING ({KEYS}, metric))"""
# Where there is no baseline the candidate is put in its place, which always passes.
UNTRAINED = f"""cand AS {_metrics('p')}, base AS {_metrics('q')},
cmp AS (SELECT cand.*, CASE WHEN l_returnflag = 'R' THEN cand.value ELSE base.value END AS baseline_value
  FROM cand LEFT JOIN base USING ({KEYS}, metric))"""
BOUNDS = "bounds AS (SELECT * FROM (VALUES " + ", ".join(f"('{m}', {v}::DOUBLE)" for m, v in GATES.items()) + ") AS g(metric, threshold))"


def _gate_sql(metrics: str, name: str) -> str:
    return f"""{name} AS (SELECT k.l_returnflag, k.l_linestatus, g.metric, m.value, g.threshold,
      coalesce({_pass('m.value', 'g.threshold').replace('metric IN', 'g.metric IN')}, TRUE) AS passed
      FROM (SELECT DISTINCT {KEYS} FROM {metrics}) k CROSS JOIN bounds g
      LEFT JOIN {metrics} m ON m.l_returnflag = k.l_returnflag AND m.l_linestatus = k.l_linestatus AND m.metric = g.metric)"""


def _failed(column: str) -> str:
    return f"coalesce(string_agg(CASE WHEN NOT {column} THEN metric END, ',' ORDER BY metric), '')"


def _verdict_sql(checks: str, compared: str, keys: str) -> str:
    return f"""(SELECT {keys}, t.ok AS threshold_passed, b.ok AS baseline_passed, t.ok AND b.ok AS validation_passed,
      t.failed AS failed_thresholds, b.failed AS failed_baseline
      FROM (SELECT {keys}, bool_and(passed) AS ok, {_failed('passed')} AS failed FROM {checks} GROUP BY ALL) t
      JOIN (SELECT {keys}, bool_and({_pass('value', 'baseline_value')}) AS ok,
        {_failed(_pass('value', 'baseline_value'))} AS failed FROM {compared} GROUP BY ALL) b USING ({keys}))"""


BROKEN_SQL = f"""WITH {TESTED}, {COMPARED}, {BOUNDS}, {_gate_sql('cand', 'gated')}
SELECT {KEYS}, metric, CASE WHEN l_linestatus = 'O' AND metric <> 'f1' THEN 'NaN'::DOUBLE ELSE round(value, 8) + 0.0::DOUBLE END AS value,
  threshold, passed AND (l_linestatus <> 'O' OR metric = 'f1') AS passed FROM gated"""

QUERIES: dict[str, Query] = {
    "gate_unpredicted_lineitem": (gate_unpredicted_lineitem, BROKEN_SQL),
    "gate_nan_lineitem": (gate_nan_lineitem, BROKEN_SQL),
    "threshold_gate_lineitem": (
        threshold_gate_lineitem,
        f"""WITH {TESTED}, {COMPARED}, {BOUNDS}, {_gate_sql('cand', 'gated')}
        SELECT {KEYS}, metric, {r('value', 8, 'value')}, threshold, passed FROM gated""",
    ),
    "baseline_gate_lineitem": (
        baseline_gate_lineitem,
        f"""WITH {TESTED}, {COMPARED} SELECT {KEYS}, metric, {r('value', 8, 'value')}, {r('baseline_value', 8, 'baseline_value')},
        {_pass('value', 'baseline_value')} AS passed FROM cmp""",
    ),
    "metric_delta_lineitem": (
        metric_delta_lineitem,
        f"""WITH {TESTED}, {COMPARED} SELECT {KEYS}, metric, {r('''(CASE WHEN metric = 'mape' THEN baseline_value - value
        ELSE value - baseline_value END) / nullif(abs(baseline_value), 0)''', 6, 'delta')} FROM cmp""",
    ),
    "validation_verdict_lineitem": (
        validation_verdict_lineitem,
        f"""WITH {TESTED}, {COMPARED}, {BOUNDS}, {_gate_sql('cand', 'gated')}
        SELECT *, 'naive_baseline' AS baseline_source FROM {_verdict_sql('gated', 'cmp', KEYS)}""",
    ),
    "validation_untrained_lineitem": (
        validation_untrained_lineitem,
        f"""WITH {TESTED}, {UNTRAINED}, {BOUNDS}, {_gate_sql('cand', 'gated')}
        SELECT *, CASE WHEN l_returnflag <> 'R' THEN 'naive_baseline' END AS baseline_source FROM {_verdict_sql('gated', 'cmp', KEYS)}""",
    ),
    "retrain_untrained_lineitem": (
        retrain_untrained_lineitem,
        f"""WITH {TESTED}, {BOUNDS}, {UNTRAINED}, champ AS {_metrics('c')},
        cmp1 AS (SELECT champ.*, CASE WHEN l_returnflag = 'R' THEN champ.value ELSE base.value END AS baseline_value
          FROM champ LEFT JOIN base USING ({KEYS}, metric)),
        cmp2 AS (SELECT cand.*, champ.value AS baseline_value FROM cand LEFT JOIN champ USING ({KEYS}, metric)),
        {_gate_sql('champ', 'gate1')}, {_gate_sql('cand', 'gate2')},
        v AS (SELECT {KEYS}, a.validation_passed AS champion_passed, b.validation_passed AS challenger_passed
          FROM {_verdict_sql('gate1', 'cmp1', KEYS)} a JOIN {_verdict_sql('gate2', 'cmp2', KEYS)} b USING ({KEYS}))
        SELECT *, CASE WHEN champion_passed THEN 'keep' WHEN challenger_passed THEN 'promote' ELSE 'reject' END AS decision FROM v""",
    ),
    "any_model_verdict_lineitem": (
        any_model_verdict_lineitem,
        f"""WITH x AS ({SPLIT_LINES}), g AS (SELECT regr_intercept(l_extendedprice, l_quantity) AS b, regr_slope(l_extendedprice, l_quantity) AS w
          FROM x WHERE split = 'train'),
        f AS (SELECT l_returnflag, l_linestatus, avg(l_extendedprice) AS naive FROM x WHERE split = 'train' GROUP BY 1, 2),
        s AS (SELECT x.l_returnflag, x.l_linestatus, l_extendedprice AS y, b + w * l_quantity AS p, naive AS q
          FROM x JOIN f USING (l_returnflag, l_linestatus), g WHERE split = 'test'),
        {COMPARED}, {BOUNDS}, {_gate_sql('cand', 'gated')}
        SELECT *, 'naive_baseline' AS baseline_source FROM {_verdict_sql('gated', 'cmp', KEYS)},
        (SELECT unnest(['table', 'spark_ml', 'python']) AS model)""",
    ),
    "verdict_evidence_lineitem": (
        verdict_evidence_lineitem,
        f"""WITH {TESTED}, {COMPARED}, {BOUNDS} SELECT {KEYS}, metric, {r('value', 8, 'value')}, threshold,
        {r('baseline_value', 8, 'baseline_value')}, coalesce({_pass('value', 'threshold')}, threshold IS NULL) AS threshold_ok,
        {_pass('value', 'baseline_value')} AS baseline_ok FROM cmp LEFT JOIN bounds USING (metric)""",
    ),
    "classification_verdict_orders": (
        classification_verdict_orders,
        f"""WITH c AS (SELECT o_orderpriority, o_orderstatus, count(*) AS n FROM orders GROUP BY 1, 2),
        n AS (SELECT o_orderpriority, o_orderstatus AS q FROM c QUALIFY row_number() OVER (PARTITION BY o_orderpriority ORDER BY n DESC, o_orderstatus) = 1),
        s AS (SELECT o_orderpriority, o_orderstatus AS y, {GUESS} AS p, q FROM orders JOIN n USING (o_orderpriority)),
        cand AS {weighted_sql('s', 'y', 'p', ['o_orderpriority'])}, base AS {weighted_sql('s', 'y', 'q', ['o_orderpriority'])},
        cmp AS (SELECT cand.*, base.value AS baseline_value FROM cand LEFT JOIN base USING (o_orderpriority, metric)),
        gated AS (SELECT cand.*, value >= 0.7 AS passed FROM cand)
        SELECT *, 'naive_baseline' AS baseline_source FROM {_verdict_sql('gated', 'cmp', 'o_orderpriority')}""",
    ),
    "retrain_decision_lineitem": (
        retrain_decision_lineitem,
        f"""WITH {TESTED}, {BOUNDS}, cand AS {_metrics('p')}, base AS {_metrics('q')}, champ AS {_metrics('c')},
        cmp1 AS (SELECT champ.*, base.value AS baseline_value FROM champ LEFT JOIN base USING ({KEYS}, metric)),
        cmp2 AS (SELECT cand.*, champ.value AS baseline_value FROM cand LEFT JOIN champ USING ({KEYS}, metric)),
        {_gate_sql('champ', 'gate1')}, {_gate_sql('cand', 'gate2')},
        v AS (SELECT {KEYS}, a.validation_passed AS champion_passed, b.validation_passed AS challenger_passed
          FROM {_verdict_sql('gate1', 'cmp1', KEYS)} a JOIN {_verdict_sql('gate2', 'cmp2', KEYS)} b USING ({KEYS}))
        SELECT *, CASE WHEN champion_passed THEN 'keep' WHEN challenger_passed THEN 'promote' ELSE 'reject' END AS decision FROM v""",
    ),
}
