"""Splits, scaling, fits, scoring and metrics."""

from __future__ import annotations

from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from driftloom.catalogue.common import Query, hash_share_sql, metrics_sql, r, rounded, table
from driftloom.catalogue.rollups import daily_orders
from driftloom.operators.metrics import (
    baseline_predictions,
    binary_metrics,
    confusion,
    majority_baseline,
    mean_baseline,
    n_unlabelled,
    numeric_metrics,
    regression_metrics,
    weighted_metrics,
)
from driftloom.operators.models import (
    best_candidates,
    coef,
    fit_candidates,
    fit_least_squares,
    fit_passive_aggressive,
    fit_scaled,
    fit_single_feature,
    least_squares_table,
    score_linear,
    training_metrics,
)
from driftloom.operators.scaling import scaler_fit, standardise
from driftloom.operators.scoring import LinearTable, PythonModel, spark_candidate
from driftloom.operators.splits import except_rows, hash_split, temporal_split
from driftloom.plans.training import passive_aggressive_candidate, prepare_training, train_run

ALL_METRICS = ["mse", "mae", "rmse", "r2", "mape"]
ROW = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]


def temporal_split_orders(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return temporal_split(orders, ["o_orderdate", "o_orderkey"]).select("o_orderkey", "split")


def temporal_split_by_priority_orders(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderpriority", "o_orderkey", "o_orderdate")
    return temporal_split(orders, ["o_orderdate", "o_orderkey"], group_cols=["o_orderpriority"]).select("o_orderkey", "split")


def hash_split_orders(spark, sf_dir):
    return hash_split(table(spark, sf_dir, "orders").select("o_orderkey"), ["o_orderkey"])


def _flags(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    columns = ["l_returnflag", "l_linestatus", "l_quantity", "l_discount"]
    return lines.select(*columns), lines.filter(F.col("l_shipdate") < F.lit("1995-06-01").cast("timestamp_ntz")).select(*columns)


def except_split_lineitem(spark, sf_dir):
    return except_rows(*_flags(spark, sf_dir))


def except_all_lineitem(spark, sf_dir):
    return except_rows(*_flags(spark, sf_dir), keep_duplicates=True)


def split_lineitem(spark, sf_dir, *columns):
    """Line rows with a key-hash split column, the input of most fits here."""
    return hash_split(table(spark, sf_dir, "lineitem").select("l_orderkey", *columns), ["l_orderkey"])


def scale_lineitem(spark, sf_dir):
    features = ["l_quantity", "l_extendedprice"]
    rows = split_lineitem(spark, sf_dir, *[c for c in ROW if c != "l_orderkey"], *features)
    scaler = scaler_fit(rows.filter("split = 'train'"), features)
    return rounded(standardise(rows, scaler, features).select(*ROW, *features, "split"), 6, *features)


def _line_fit(rows):
    return fit_single_feature(rows, ["l_quantity"], "l_extendedprice", ["l_returnflag"])


def ols_by_group_lineitem(spark, sf_dir):
    table_ = _line_fit(table(spark, sf_dir, "lineitem"))
    return rounded(rounded(table_, 4, "intercept", coef("l_quantity")), 8, "fit_r2")


def regression_metrics_lineitem(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select("l_returnflag", "l_quantity", "l_extendedprice")
    scored = score_linear(rows, _line_fit(rows), ["l_quantity"], ["l_returnflag"])
    long = regression_metrics(scored, "l_extendedprice", "prediction", ["l_returnflag"], ALL_METRICS)
    return long.select("l_returnflag", "metric", F.format_number("value", 4).alias("value"))


def training_metrics_lineitem(spark, sf_dir):
    rows = split_lineitem(spark, sf_dir, "l_returnflag", "l_quantity", "l_extendedprice")
    fitted = _line_fit(rows.filter("split = 'train'"))
    long = training_metrics(rows, fitted, ["l_quantity"], "l_extendedprice", ["l_returnflag"])
    return long.select("l_returnflag", "metric", F.format_number("value", 4).alias("value"))


MANY = ["l_quantity", "l_discount", "l_tax"]


def multi_feature_fit_lineitem(spark, sf_dir):
    fitted = fit_least_squares(table(spark, sf_dir, "lineitem"), MANY, "l_extendedprice")
    return rounded(fitted, 2, "intercept", *[coef(c) for c in MANY])


def slopes_sql(keys: str = "", source: str = "lineitem") -> str:
    """Relations `s` and `f` with ordinary least squares on three features (b1, b2, b3, b0) by Cramer's rule, per group of `keys`."""
    s = lambda a, b: f"covar_pop({a}, {b})"
    names = {1: "l_quantity", 2: "l_discount", 3: "l_tax", "y": "l_extendedprice"}
    sums = [f"{s(names[i], names[j])} AS s{i}{j}" for i in (1, 2, 3) for j in (1, 2, 3, "y")]
    means = [f"avg({v}) AS m{k}" for k, v in names.items()] + ["count(*) AS n_rows", "var_pop(l_extendedprice) AS syy"]

    def det(columns):
        (a, b, c), (d, e, f), (g, h, i) = [[f"s{row}{col}" for col in columns] for row in (1, 2, 3)]
        return f"({a}*({e}*{i}-{f}*{h}) - {b}*({d}*{i}-{f}*{g}) + {c}*({d}*{h}-{e}*{g}))"

    full = det([1, 2, 3])
    slopes = [det([("y" if col == k else col) for col in (1, 2, 3)]) + f" / {full} AS b{k}" for k in (1, 2, 3)]
    head, tail = (f"{keys}, ", f" GROUP BY {keys}") if keys else ("", "")
    return f"""s AS (SELECT {head}{', '.join(sums + means)} FROM {source}{tail}),
    f AS (SELECT *, my - b1*m1 - b2*m2 - b3*m3 AS b0 FROM (SELECT *, {', '.join(slopes)} FROM s))"""


def _many_sql() -> str:
    out = [r(f"b{k}", 2, coef(c)) for k, c in enumerate(MANY, 1)] + [r("b0", 2, "intercept")]
    return f"WITH {slopes_sql()} SELECT {', '.join(out)} FROM f"


def grouped_fit_lineitem(spark, sf_dir):
    """Three features per segment, with what the fit rests on."""
    fitted = least_squares_table(table(spark, sf_dir, "lineitem"), MANY, "l_extendedprice", ["l_returnflag", "l_linestatus"])
    return rounded(rounded(fitted, 2, "intercept", *[coef(c) for c in MANY]), 8, "fit_r2")


def ml_score_lineitem(spark, sf_dir):
    """A fitted `spark.ml` regression behind the model contract."""
    lines = table(spark, sf_dir, "lineitem").select(*ROW, *MANY, "l_extendedprice")
    model = spark_candidate(LinearRegression(solver="normal"))(lines, MANY, "l_extendedprice")
    return rounded(model.score(lines).select(*ROW, "prediction"), 2, "prediction")


def python_score_lineitem(spark, sf_dir):
    """A Python model that workers load once, behind the same contract; rows with a null feature stay."""
    rates = {"base": 900.0, "step": 12.5}

    def predict(model, batch):
        quantity, discount = (batch.column(c).to_numpy() for c in ("l_quantity", "l_discount"))
        return model["base"] * quantity * (1 - discount) + model["step"]

    lines = table(spark, sf_dir, "lineitem").select(*ROW, "l_quantity", "l_discount")
    known = lines.withColumn("l_discount", F.when(F.col("l_quantity") != 7, F.col("l_discount")))
    model = PythonModel(lambda: rates, predict, ("l_quantity", "l_discount"))
    return rounded(model.score(known).select(*ROW, "prediction"), 4, "prediction")


def _few(df, features, label, group_cols=()):
    """A line on quantity alone, in vain for returned goods."""
    fitted = fit_single_feature(df, ["l_quantity"], label, group_cols)
    hit = F.col("l_returnflag") == "R"
    kept = fitted.select(*group_cols, F.when(~hit, F.col("intercept")).alias("intercept"), coef("l_quantity"))
    return LinearTable(kept, ("l_quantity",), tuple(group_cols))


def best_candidate_lineitem(spark, sf_dir):
    """The best candidate of every segment, one of them failing in one segment."""
    rows = split_lineitem(spark, sf_dir, "l_returnflag", *MANY, "l_extendedprice")
    candidates = {"line": _few, "plane": fit_least_squares}
    _, results = fit_candidates(rows, candidates, MANY, "l_extendedprice", ["l_returnflag"])
    return rounded(best_candidates(results, ["l_returnflag"]), 4, "val_rmse")


def batch_score_lineitem(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select(*ROW, "l_returnflag", "l_quantity", "l_extendedprice")
    scored = score_linear(rows, _line_fit(rows), ["l_quantity"], ["l_returnflag"])
    return rounded(scored.select(*ROW, "l_returnflag", "prediction"), 4, "prediction")


def pa_fit_by_series_lineitem(spark, sf_dir):
    daily = table(spark, sf_dir, "lineitem")
    prepared = prepare_training(daily, ["l_quantity"], ["l_returnflag"], "l_shipdate")
    fitted, _ = train_run(
        prepared, "l_quantity_mes", {"passive_aggressive": passive_aggressive_candidate()}, ["l_returnflag"]
    )
    return fitted["passive_aggressive"]


def pa_fit_global_lineitem(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem")

    def fit(df, features, label, group_cols=()):
        return fit_passive_aggressive(df, features, label, group_cols, ROW)

    return fit_scaled(fit)(rows, MANY, "l_extendedprice", ())


def multi_candidate_fit_orders(spark, sf_dir):
    prepared = prepare_training(daily_orders(spark, sf_dir), ["entrada"])

    def one_feature_only(df, features, label, group_cols=()):
        return fit_single_feature(df, features, label, group_cols)

    candidates = {
        "passive_aggressive": passive_aggressive_candidate(),
        "least_squares": fit_least_squares,
        "single_feature": one_feature_only,
    }
    return train_run(prepared, "entrada_mes", candidates)[1]


def mean_baseline_orders(spark, sf_dir):
    rows = hash_split(table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice"), ["o_orderkey"])
    naive = mean_baseline(rows.filter("split = 'train'"), "o_totalprice", ["o_orderpriority"])
    based = baseline_predictions(rows.filter("split = 'test'"), naive, ["o_orderpriority"])
    long = regression_metrics(based, "o_totalprice", "baseline", ["o_orderpriority"], ["r2", "mape"])
    return rounded(long, 6, "value")


def majority_baseline_orders(spark, sf_dir):
    rows = hash_split(table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", "o_orderstatus"), ["o_orderkey"])
    return majority_baseline(rows.filter("split = 'train'"), "o_orderstatus", ["o_orderpriority"])


def baseline_source_orders(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select("o_orderpriority", "o_totalprice", "o_orderstatus")
    known = rows.withColumn("previous", F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_totalprice") * 0.9))
    naive = mean_baseline(rows, "o_totalprice", ["o_orderpriority"])
    based = baseline_predictions(known, naive, ["o_orderpriority"], previous="previous")
    folded = based.groupBy("o_orderpriority", "baseline_source").agg(
        F.count(F.lit(1)).alias("n"), F.avg("baseline").alias("mean_baseline")
    )
    return rounded(folded, 4, "mean_baseline")


def binary_metrics_labels(spark, sf_dir):
    return rounded(binary_metrics(table(spark, sf_dir, "labels"), "quality", "toxic"), 8, "value")


def _partly_labelled(spark, sf_dir):
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic")
    return labels.withColumn("quality", F.when(F.col("doc_id") % 7 != 0, F.col("quality")))


def unlabelled_binary_labels(spark, sf_dir):
    """Rows without a label are in no metric."""
    return rounded(binary_metrics(_partly_labelled(spark, sf_dir), "quality", "toxic"), 8, "value")


def unlabelled_weighted_labels(spark, sf_dir):
    return rounded(weighted_metrics(_partly_labelled(spark, sf_dir), "quality", "toxic"), 8, "value")


def n_unlabelled_labels(spark, sf_dir):
    return n_unlabelled(_partly_labelled(spark, sf_dir), "quality", ["toxic"])


def confusion_labels(spark, sf_dir):
    return confusion(table(spark, sf_dir, "labels"), "quality", "toxic")


def status_guess(spark, sf_dir):
    """Order status beside a guess that depends on price and priority, as a stand-in for a classifier."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", "o_orderstatus", "o_totalprice")
    guess = F.when(F.col("o_totalprice") < 150000, "F").when(F.col("o_totalprice") < 300000, "O").otherwise("P")
    return orders.withColumn("guess", guess)


def weighted_metrics_orders(spark, sf_dir):
    return rounded(weighted_metrics(status_guess(spark, sf_dir), "o_orderstatus", "guess", ["o_orderpriority"]), 8, "value")


def numeric_metric_filter_events(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    named = events.select(
        "event_id",
        F.inline(
            F.array(
                F.struct(F.lit("props").alias("metric"), F.col("props").alias("value")),
                F.struct(F.lit("k").alias("metric"), F.regexp_extract("props", "([0-9]+)", 1).alias("value")),
                F.struct(F.lit("type").alias("metric"), F.col("event_type").alias("value")),
                F.struct(F.lit("value").alias("metric"), F.col("value").cast("string").alias("value")),
            )
        ),
    )
    return numeric_metrics(named)


GUESS = "CASE WHEN o_totalprice < 150000 THEN 'F' WHEN o_totalprice < 300000 THEN 'O' ELSE 'P' END"
FIT = """f AS (SELECT l_returnflag, regr_intercept(l_extendedprice, l_quantity) AS b, regr_slope(l_extendedprice, l_quantity) AS w,
  regr_r2(l_extendedprice, l_quantity) AS r2 FROM lineitem GROUP BY 1)"""
SPLIT_LINES = f"SELECT *, CASE WHEN {hash_share_sql('l_orderkey')} < 0.8 THEN 'train' ELSE 'test' END AS split FROM lineitem"
SPLIT_ORDERS = f"SELECT *, CASE WHEN {hash_share_sql('o_orderkey')} < 0.8 THEN 'train' ELSE 'test' END AS split FROM orders"
FORMAT = "format('{:,.4f}', value) AS value"


def weighted_sql(source: str, y: str, p: str, keys: list[str]) -> str:
    """Weighted classification metrics in long form, as a SELECT."""
    by = "".join(f"{k}, " for k in keys)
    on = " AND ".join(f"x.{k} = z.{k}" for k in keys) + (" AND " if keys else "")
    group = f"GROUP BY {', '.join('t.' + k for k in keys)}" if keys else ""
    tby = "".join(f"t.{k}, " for k in keys)
    each = " UNION ALL ".join(f"SELECT {by}'{m}' AS metric, {m} AS value FROM wide" for m in ("accuracy", "precision", "recall", "f1"))
    return f"""(
      WITH t0 AS (SELECT {by}{y} AS cls, count(*) AS n_true, count(*) FILTER ({y} = {p}) AS tp FROM {source} GROUP BY ALL),
      p0 AS (SELECT {by}{p} AS cls, count(*) AS n_pred FROM {source} GROUP BY ALL),
      t AS (SELECT x.*, coalesce(z.n_pred, 0) AS n_pred FROM t0 x LEFT JOIN p0 z ON {on}x.cls = z.cls),
      wide AS (SELECT {tby}sum(tp)::DOUBLE / sum(n_true) AS accuracy,
        sum(n_true * CASE WHEN n_pred = 0 THEN 0 ELSE tp::DOUBLE / n_pred END) / sum(n_true) AS precision,
        sum(n_true * (tp::DOUBLE / n_true)) / sum(n_true) AS recall,
        sum(n_true * (2.0 * tp / (n_true + n_pred))) / sum(n_true) AS f1 FROM t {group})
      {each})"""


QUERIES: dict[str, Query] = {
    "temporal_split_orders": (
        temporal_split_orders,
        """SELECT o_orderkey, CASE WHEN row_number() OVER (ORDER BY o_orderdate, o_orderkey) <= floor(0.8::DOUBLE * count(*) OVER ())
        THEN 'train' ELSE 'test' END AS split FROM orders""",
    ),
    "temporal_split_by_priority_orders": (
        temporal_split_by_priority_orders,
        """SELECT o_orderkey, CASE WHEN row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderdate, o_orderkey)
        <= floor(0.8::DOUBLE * count(*) OVER (PARTITION BY o_orderpriority)) THEN 'train' ELSE 'test' END AS split FROM orders""",
    ),
    "hash_split_orders": (hash_split_orders, f"SELECT o_orderkey, split FROM ({SPLIT_ORDERS})"),
    "except_split_lineitem": (
        except_split_lineitem,
        """SELECT l_returnflag, l_linestatus, l_quantity, l_discount FROM lineitem EXCEPT
        SELECT l_returnflag, l_linestatus, l_quantity, l_discount FROM lineitem WHERE l_shipdate < TIMESTAMP '1995-06-01'""",
    ),
    "except_all_lineitem": (
        except_all_lineitem,
        """SELECT l_returnflag, l_linestatus, l_quantity, l_discount FROM lineitem EXCEPT ALL
        SELECT l_returnflag, l_linestatus, l_quantity, l_discount FROM lineitem WHERE l_shipdate < TIMESTAMP '1995-06-01'""",
    ),
    "scale_lineitem": (
        scale_lineitem,
        f"""WITH x AS ({SPLIT_LINES}), s AS (SELECT avg(l_quantity) AS mq, stddev_pop(l_quantity) AS sq, avg(l_extendedprice) AS me,
        stddev_pop(l_extendedprice) AS se FROM x WHERE split = 'train')
        SELECT {', '.join(ROW)}, {r('(l_quantity - mq) / sq', 6, 'l_quantity')}, {r('(l_extendedprice - me) / se', 6, 'l_extendedprice')},
        split FROM x, s""",
    ),
    "ols_by_group_lineitem": (
        ols_by_group_lineitem,
        f"WITH {FIT} SELECT l_returnflag, {r('b', 4, 'intercept')}, {r('w', 4, 'coef_l_quantity')}, {r('r2', 8, 'fit_r2')} FROM f",
    ),
    "regression_metrics_lineitem": (
        regression_metrics_lineitem,
        f"""WITH {FIT}, s AS (SELECT l.l_returnflag, l_extendedprice AS y, b + w * l_quantity AS p FROM lineitem l JOIN f USING (l_returnflag))
        SELECT l_returnflag, metric, {FORMAT} FROM {metrics_sql('s', 'y', 'p', ['l_returnflag'], ALL_METRICS)}""",
    ),
    "training_metrics_lineitem": (
        training_metrics_lineitem,
        f"""WITH x AS ({SPLIT_LINES}), f AS (SELECT l_returnflag, regr_intercept(l_extendedprice, l_quantity) AS b,
          regr_slope(l_extendedprice, l_quantity) AS w FROM x WHERE split = 'train' GROUP BY 1),
        s AS (SELECT l_returnflag, split, l_extendedprice AS y, b + w * l_quantity AS p FROM x JOIN f USING (l_returnflag))
        SELECT l_returnflag, CASE WHEN split = 'train' THEN 'train_' ELSE 'val_' END || metric AS metric, {FORMAT}
        FROM {metrics_sql('s', 'y', 'p', ['l_returnflag', 'split'], ['mse', 'mae', 'rmse', 'r2'])}""",
    ),
    "multi_feature_fit_lineitem": (multi_feature_fit_lineitem, _many_sql()),
    "grouped_fit_lineitem": (
        grouped_fit_lineitem,
        f"""WITH {slopes_sql("l_returnflag, l_linestatus")} SELECT l_returnflag, l_linestatus, n_rows, 3::BIGINT AS rank,
        {', '.join([r(f"b{k}", 2, coef(c)) for k, c in enumerate(MANY, 1)] + [r("b0", 2, "intercept")])},
        {r("(b1 * s1y + b2 * s2y + b3 * s3y) / syy", 8, "fit_r2")} FROM f""",
    ),
    "ml_score_lineitem": (
        ml_score_lineitem,
        f"""WITH {slopes_sql()} SELECT {', '.join(ROW)}, {r("b0 + b1 * l_quantity + b2 * l_discount + b3 * l_tax", 2, "prediction")} FROM lineitem, f""",
    ),
    "python_score_lineitem": (
        python_score_lineitem,
        f"""SELECT {', '.join(ROW)}, {r("CASE WHEN l_quantity <> 7 THEN 900.0::DOUBLE * l_quantity * (1 - l_discount) + 12.5::DOUBLE END", 4, "prediction")}
        FROM lineitem""",
    ),
    "best_candidate_lineitem": (
        best_candidate_lineitem,
        f"""WITH x AS ({SPLIT_LINES}), t AS (SELECT * FROM x WHERE split = 'train'), {slopes_sql("l_returnflag", "t")},
        l AS (SELECT l_returnflag, regr_intercept(l_extendedprice, l_quantity) AS b, regr_slope(l_extendedprice, l_quantity) AS w FROM t GROUP BY 1),
        e AS (SELECT x.l_returnflag, sqrt(avg(pow(l_extendedprice - b - w * l_quantity, 2))) AS line,
          sqrt(avg(pow(l_extendedprice - b0 - b1 * l_quantity - b2 * l_discount - b3 * l_tax, 2))) AS plane
          FROM x JOIN f USING (l_returnflag) JOIN l USING (l_returnflag) WHERE split = 'test' GROUP BY 1),
        c AS (SELECT *, l_returnflag <> 'R' AND line <= plane AS first FROM e)
        SELECT l_returnflag, CASE WHEN first THEN 'line' ELSE 'plane' END AS best, {r("CASE WHEN first THEN line ELSE plane END", 4, "val_rmse")},
        CASE WHEN l_returnflag = 'R' THEN 1 ELSE 2 END::BIGINT AS n_ok, CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END::BIGINT AS n_failed FROM c""",
    ),
    "batch_score_lineitem": (
        batch_score_lineitem,
        f"""WITH {FIT} SELECT {', '.join(ROW)}, l_returnflag, {r('b + w * l_quantity', 4, 'prediction')}
        FROM lineitem JOIN f USING (l_returnflag)""",
    ),
    "pa_fit_by_series_lineitem": (pa_fit_by_series_lineitem, None),
    "pa_fit_global_lineitem": (pa_fit_global_lineitem, None),
    "multi_candidate_fit_orders": (multi_candidate_fit_orders, None),
    "mean_baseline_orders": (
        mean_baseline_orders,
        f"""WITH x AS ({SPLIT_ORDERS}), n AS (SELECT o_orderpriority, avg(o_totalprice) AS p FROM x WHERE split = 'train' GROUP BY 1),
        s AS (SELECT x.o_orderpriority, o_totalprice AS y, p FROM x JOIN n USING (o_orderpriority) WHERE split = 'test')
        SELECT o_orderpriority, metric, {r('value', 6, 'value')} FROM {metrics_sql('s', 'y', 'p', ['o_orderpriority'], ['r2', 'mape'])}""",
    ),
    "majority_baseline_orders": (
        majority_baseline_orders,
        f"""WITH x AS ({SPLIT_ORDERS}), c AS (SELECT o_orderpriority, o_orderstatus, count(*) AS n FROM x WHERE split = 'train' GROUP BY 1, 2)
        SELECT o_orderpriority, o_orderstatus AS naive_prediction FROM c
        QUALIFY row_number() OVER (PARTITION BY o_orderpriority ORDER BY n DESC, o_orderstatus) = 1""",
    ),
    "baseline_source_orders": (
        baseline_source_orders,
        f"""SELECT o_orderpriority, CASE WHEN o_orderpriority = '5-LOW' THEN 'naive_baseline' ELSE 'previous_model' END AS baseline_source,
        count(*) AS n, {r("avg(CASE WHEN o_orderpriority = '5-LOW' THEN o_totalprice ELSE o_totalprice * 0.9::DOUBLE END)", 4, 'mean_baseline')}
        FROM orders GROUP BY 1, 2""",
    ),
    "binary_metrics_labels": (
        binary_metrics_labels,
        """WITH c AS (SELECT count(*)::DOUBLE AS n, count(*) FILTER (quality = toxic) AS ok, count(*) FILTER (quality = 1 AND toxic = 1) AS tp,
          count(*) FILTER (quality = 1) AS t, count(*) FILTER (toxic = 1) AS p FROM labels)
        SELECT 'accuracy' AS metric, round(ok / n, 8) AS value FROM c
        UNION ALL SELECT 'precision', coalesce(round(tp::DOUBLE / nullif(p, 0), 8), 0) FROM c
        UNION ALL SELECT 'recall', coalesce(round(tp::DOUBLE / nullif(t, 0), 8), 0) FROM c
        UNION ALL SELECT 'f1', coalesce(round(2.0::DOUBLE * tp / nullif(t + p, 0), 8), 0) FROM c""",
    ),
    "unlabelled_binary_labels": (
        unlabelled_binary_labels,
        """WITH c AS (SELECT count(*)::DOUBLE AS n, count(*) FILTER (quality = toxic) AS ok, count(*) FILTER (quality = 1 AND toxic = 1) AS tp,
          count(*) FILTER (quality = 1) AS t, count(*) FILTER (toxic = 1) AS p FROM labels WHERE doc_id % 7 <> 0)
        SELECT 'accuracy' AS metric, round(ok / n, 8) AS value FROM c
        UNION ALL SELECT 'precision', coalesce(round(tp::DOUBLE / nullif(p, 0), 8), 0) FROM c
        UNION ALL SELECT 'recall', coalesce(round(tp::DOUBLE / nullif(t, 0), 8), 0) FROM c
        UNION ALL SELECT 'f1', coalesce(round(2.0::DOUBLE * tp / nullif(t + p, 0), 8), 0) FROM c""",
    ),
    "unlabelled_weighted_labels": (
        unlabelled_weighted_labels,
        f"""WITH s AS (SELECT quality AS y, toxic AS p FROM labels WHERE doc_id % 7 <> 0)
        SELECT metric, {r('value', 8, 'value')} FROM {weighted_sql('s', 'y', 'p', [])}""",
    ),
    "n_unlabelled_labels": (
        n_unlabelled_labels,
        "SELECT toxic, count(*) AS n_rows, count(*) FILTER (doc_id % 7 = 0 OR quality IS NULL) AS n_unlabelled FROM labels GROUP BY 1",
    ),
    "confusion_labels": (confusion_labels, "SELECT quality, toxic, count(*) AS n FROM labels GROUP BY 1, 2"),
    "weighted_metrics_orders": (
        weighted_metrics_orders,
        f"""WITH s AS (SELECT o_orderpriority, o_orderstatus AS y, {GUESS} AS p FROM orders)
        SELECT o_orderpriority, metric, {r('value', 8, 'value')} FROM {weighted_sql('s', 'y', 'p', ['o_orderpriority'])}""",
    ),
    "numeric_metric_filter_events": (
        numeric_metric_filter_events,
        """WITH m AS (SELECT event_id, 'props' AS metric, props AS value FROM events
          UNION ALL SELECT event_id, 'k', regexp_extract(props, '([0-9]+)', 1) FROM events
          UNION ALL SELECT event_id, 'type', event_type FROM events
          UNION ALL SELECT event_id, 'value', CAST(value AS VARCHAR) FROM events)
        SELECT event_id, metric, TRY_CAST(value AS DOUBLE) AS value FROM m WHERE TRY_CAST(value AS DOUBLE) IS NOT NULL""",
    ),
}
