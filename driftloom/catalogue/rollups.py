"""Rollups, lags and the feature build."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftloom.catalogue.common import Query, r, rounded, table
from driftloom.functions.naming import month_lag, month_total, week_lag, week_total
from driftloom.operators.features import (
    add_monthly_lags,
    add_monthly_lags_by_row,
    add_weekly_lags,
    build_features,
    fill_missing_weeks,
    join_month_totals,
    monthly_rollup,
    recent_window,
    weekly_rollup,
)
from driftloom.operators.profile import profile, shape

MONEY = 2


def daily_orders(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "orders").select(F.col("o_orderdate").alias("data"), F.col("o_totalprice").alias("entrada"))


def _money(df: DataFrame, *value_cols: str) -> DataFrame:
    names = [c for c in df.columns if any(c.startswith((week_total(v), month_total(v))) for v in value_cols)]
    return rounded(df, MONEY, *names)


DAILY = "d AS (SELECT CAST(o_orderdate AS DATE) AS data, o_totalprice AS entrada FROM orders)"
WEEKS = "w AS (SELECT CAST(date_trunc('week', data) AS TIMESTAMP) AS semana, sum(entrada) AS entrada_semana FROM d GROUP BY 1)"
MONTHS = "m AS (SELECT CAST(date_trunc('month', data) AS TIMESTAMP) AS mes, sum(entrada) AS entrada_mes FROM d GROUP BY 1)"
JOINED = """j AS (SELECT m0.mes, m0.semana, m0.entrada_semana, m.entrada_mes
  FROM (SELECT *, CAST(date_trunc('month', semana) AS TIMESTAMP) AS mes FROM w) m0 LEFT JOIN m ON m.mes = m0.mes)"""
MONTH_LAGS = "ml AS (SELECT m.*, " + ", ".join(
    f"(SELECT p.entrada_mes FROM m p WHERE p.mes = m.mes - INTERVAL {k} MONTH) AS entrada_mes_lag{k}m" for k in (1, 2, 3)
) + " FROM m)"


def _lags(column: str, order: str, names, part: str = "") -> str:
    return ", ".join(r(f"lag({column}, {k}) OVER ({part} ORDER BY {order})", MONEY, names(k)) for k in (1, 2, 3))


W_LAGS = _lags("entrada_semana", "semana", lambda k: week_lag("entrada", k))


def weekly_rollup_orders(spark, sf_dir):
    return _money(weekly_rollup(daily_orders(spark, sf_dir), ["entrada"]), "entrada")


def monthly_rollup_orders(spark, sf_dir):
    return _money(monthly_rollup(daily_orders(spark, sf_dir), ["entrada"]), "entrada")


def week_month_join_orders(spark, sf_dir):
    daily = daily_orders(spark, sf_dir)
    return _money(join_month_totals(weekly_rollup(daily, ["entrada"]), monthly_rollup(daily, ["entrada"])), "entrada")


def weekly_lags_orders(spark, sf_dir):
    return _money(add_weekly_lags(weekly_rollup(daily_orders(spark, sf_dir), ["entrada"]), ["entrada"]), "entrada")


def weekly_lags_gapfilled_events(spark, sf_dir):
    keys = ["user_id", "event_type"]
    weekly = weekly_rollup(table(spark, sf_dir, "events"), ["value"], keys, "ts")
    return _money(add_weekly_lags(fill_missing_weeks(weekly, keys), ["value"], keys), "value")


def monthly_lags_calendar_orders(spark, sf_dir):
    return _money(add_monthly_lags(monthly_rollup(daily_orders(spark, sf_dir), ["entrada"]), ["entrada"]), "entrada")


def monthly_lags_row_orders(spark, sf_dir):
    daily = daily_orders(spark, sf_dir)
    joined = join_month_totals(weekly_rollup(daily, ["entrada"]), monthly_rollup(daily, ["entrada"]))
    return _money(add_monthly_lags_by_row(joined, ["entrada"]), "entrada")


def feature_build_orders(spark, sf_dir):
    return _money(build_features(daily_orders(spark, sf_dir), ["entrada"], drop_incomplete=True), "entrada")


def feature_build_by_flag_lineitem(spark, sf_dir):
    daily = table(spark, sf_dir, "lineitem")
    values = ["l_quantity", "l_extendedprice"]
    return _money(build_features(daily, values, ["l_returnflag"], "l_shipdate", monthly_lags="row"), *values)


def _by_flag_sql() -> str:
    values = ["l_quantity", "l_extendedprice"]
    sums = lambda grain: ", ".join(f"sum({v}) AS {v}_{grain}" for v in values)
    out = [r(f"{v}_{g}", MONEY, f"{v}_{g}") for v in values for g in ("semana", "mes")]
    part = "PARTITION BY l_returnflag"
    out += [_lags(f"{v}_semana", "semana", lambda k, v=v: week_lag(v, k), part) for v in values]
    out += [_lags(f"{v}_mes", "semana", lambda k, v=v: month_lag(v, k), part) for v in values]
    return f"""WITH w AS (SELECT l_returnflag, CAST(date_trunc('week', l_shipdate) AS TIMESTAMP) AS semana, {sums('semana')} FROM lineitem GROUP BY 1, 2),
      m AS (SELECT l_returnflag, CAST(date_trunc('month', l_shipdate) AS TIMESTAMP) AS mes, {sums('mes')} FROM lineitem GROUP BY 1, 2),
      j AS (SELECT w.*, CAST(date_trunc('month', semana) AS TIMESTAMP) AS mes, m.* EXCLUDE (l_returnflag, mes) FROM w
        LEFT JOIN m ON m.l_returnflag = w.l_returnflag AND m.mes = CAST(date_trunc('month', semana) AS TIMESTAMP))
      SELECT l_returnflag, mes, semana, {', '.join(out)} FROM j"""


def recent_window_lineitem(spark, sf_dir):
    recent = recent_window(table(spark, sf_dir, "lineitem"), "l_shipdate", 28, "2001-11-04")
    return recent.select("l_orderkey", "l_partkey", "l_linenumber", "l_shipdate", "l_quantity")


def profile_customer(spark, sf_dir):
    return profile(table(spark, sf_dir, "customer")).select("column_name", "n_rows", "n_nulls", "min_value", "max_value")


def shape_lineitem(spark, sf_dir):
    return shape(table(spark, sf_dir, "lineitem"))


CUSTOMER = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]
QUERIES: dict[str, Query] = {
    "weekly_rollup_orders": (
        weekly_rollup_orders,
        f"WITH {DAILY}, {WEEKS} SELECT semana, {r('entrada_semana', MONEY, 'entrada_semana')} FROM w",
    ),
    "monthly_rollup_orders": (
        monthly_rollup_orders,
        f"WITH {DAILY}, {MONTHS} SELECT mes, {r('entrada_mes', MONEY, 'entrada_mes')} FROM m",
    ),
    "week_month_join_orders": (
        week_month_join_orders,
        f"""WITH {DAILY}, {WEEKS}, {MONTHS}, {JOINED}
        SELECT mes, semana, {r('entrada_semana', MONEY, 'entrada_semana')}, {r('entrada_mes', MONEY, 'entrada_mes')} FROM j""",
    ),
    "weekly_lags_orders": (
        weekly_lags_orders,
        f"WITH {DAILY}, {WEEKS} SELECT semana, {r('entrada_semana', MONEY, 'entrada_semana')}, {W_LAGS} FROM w",
    ),
    "weekly_lags_gapfilled_events": (
        weekly_lags_gapfilled_events,
        f"""WITH w AS (SELECT user_id, event_type, CAST(date_trunc('week', ts) AS TIMESTAMP) AS semana, sum(value) AS v FROM events GROUP BY ALL),
        b AS (SELECT user_id, event_type, min(semana) AS lo, max(semana) AS hi FROM w GROUP BY ALL),
        g AS (SELECT user_id, event_type, unnest(generate_series(lo, hi, INTERVAL 7 DAY)) AS semana FROM b),
        f AS (SELECT g.*, w.v FROM g LEFT JOIN w USING (user_id, event_type, semana))
        SELECT user_id, event_type, semana, {r('v', MONEY, 'value_semana')},
          {_lags('v', 'semana', lambda k: week_lag('value', k), 'PARTITION BY user_id, event_type')} FROM f""",
    ),
    "monthly_lags_calendar_orders": (
        monthly_lags_calendar_orders,
        f"""WITH {DAILY}, {MONTHS}, {MONTH_LAGS} SELECT mes, {r('entrada_mes', MONEY, 'entrada_mes')},
        {', '.join(r(month_lag('entrada', k), MONEY, month_lag('entrada', k)) for k in (1, 2, 3))} FROM ml""",
    ),
    "monthly_lags_row_orders": (
        monthly_lags_row_orders,
        f"""WITH {DAILY}, {WEEKS}, {MONTHS}, {JOINED}
        SELECT mes, semana, {r('entrada_semana', MONEY, 'entrada_semana')}, {r('entrada_mes', MONEY, 'entrada_mes')},
        {_lags('entrada_mes', 'mes, semana', lambda k: month_lag('entrada', k))} FROM j""",
    ),
    "feature_build_orders": (
        feature_build_orders,
        f"""WITH {DAILY}, {WEEKS}, {MONTHS}, {MONTH_LAGS}, {JOINED},
        x AS (SELECT j.mes, semana, {r('entrada_semana', MONEY, 'entrada_semana')}, {r('j.entrada_mes', MONEY, 'entrada_mes')}, {W_LAGS},
          {', '.join(r(month_lag('entrada', k), MONEY, month_lag('entrada', k)) for k in (1, 2, 3))}
          FROM j LEFT JOIN ml ON ml.mes = j.mes)
        SELECT * FROM x WHERE entrada_mes IS NOT NULL AND entrada_semana IS NOT NULL AND entrada_semana_lag3w IS NOT NULL
          AND entrada_semana_lag2w IS NOT NULL AND entrada_semana_lag1w IS NOT NULL
          AND entrada_mes_lag1m IS NOT NULL AND entrada_mes_lag2m IS NOT NULL AND entrada_mes_lag3m IS NOT NULL""",
    ),
    "feature_build_by_flag_lineitem": (feature_build_by_flag_lineitem, _by_flag_sql()),
    "recent_window_lineitem": (
        recent_window_lineitem,
        """SELECT l_orderkey, l_partkey, l_linenumber, l_shipdate, l_quantity FROM lineitem
        WHERE l_shipdate >= DATE '2001-11-04' - INTERVAL 28 DAY""",
    ),
    "profile_customer": (
        profile_customer,
        " UNION ALL ".join(
            f"""SELECT '{c}' AS column_name, count(*) AS n_rows, count(*) FILTER ({c} IS NULL) AS n_nulls,
            CAST(min({c}) AS VARCHAR) AS min_value, CAST(max({c}) AS VARCHAR) AS max_value FROM customer"""
            for c in CUSTOMER
        ),
    ),
    "shape_lineitem": (shape_lineitem, "SELECT count(*) AS n_rows, CAST(11 AS INTEGER) AS n_columns FROM lineitem"),
}
