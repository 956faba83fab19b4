from datetime import date, datetime
from decimal import Decimal

import pytest
from conftest import by
from pyspark.sql import functions as F

from driftloom.operators import features as ft


def daily(spark, *rows):
    return spark.createDataFrame([(date.fromisoformat(d), v) for d, v in rows], "data date, entrada int")


def test_rollups_and_join(spark):
    df = daily(spark, ("2024-01-31", 10), ("2024-02-01", 20), ("2024-02-05", 5))
    weekly, monthly = ft.weekly_rollup(df, ["entrada"]), ft.monthly_rollup(df, ["entrada"])
    joined = by(ft.join_month_totals(weekly, monthly), "semana")
    assert [(r["semana"], r["entrada_semana"], r["entrada_mes"]) for r in joined] == [
        (datetime(2024, 1, 29), 30, 10),
        (datetime(2024, 2, 5), 5, 25),
    ]
    assert joined[0]["mes"] == datetime(2024, 1, 1)


def test_week_starting_in_a_month_without_rows_has_no_month_total(spark):
    (row,) = ft.build_features(daily(spark, ("2024-09-01", 7)), ["entrada"]).collect()
    assert (row.semana, row.mes, row.entrada_semana, row.entrada_mes) == (datetime(2024, 8, 26), datetime(2024, 8, 1), 7, None)


def test_lags_by_row_and_on_the_calendar(spark):
    df = daily(spark, ("2024-01-01", 10), ("2024-01-08", 20), ("2024-01-22", 40))
    weekly = ft.weekly_rollup(df, ["entrada"])
    by_row = by(ft.add_weekly_lags(weekly, ["entrada"]), "semana")
    assert [r["entrada_semana_lag1w"] for r in by_row] == [None, 10, 20]
    filled = by(ft.add_weekly_lags(ft.fill_missing_weeks(weekly), ["entrada"]), "semana")
    assert [r["entrada_semana"] for r in filled] == [10, 20, None, 40]
    assert [r["entrada_semana_lag1w"] for r in filled] == [None, 10, 20, None]


def test_monthly_lags_follow_the_calendar_over_a_missing_month(spark):
    df = daily(spark, ("2024-01-08", 1), ("2024-03-04", 4))
    rows = by(ft.build_features(df, ["entrada"]), "semana")
    assert [(r["entrada_mes"], r["entrada_mes_lag1m"], r["entrada_mes_lag2m"]) for r in rows] == [(1, None, None), (4, None, 1)]


def composed(df, values, groups, mode):
    weekly, monthly = ft.weekly_rollup(df, values, groups), ft.monthly_rollup(df, values, groups)
    if mode == "calendar":
        monthly = ft.add_monthly_lags(monthly, values, groups)
    joined = ft.add_weekly_lags(ft.join_month_totals(weekly, monthly, groups), values, groups)
    return joined if mode == "calendar" else ft.add_monthly_lags_by_row(joined, values, groups)


@pytest.mark.parametrize("mode", ["calendar", "row"])
@pytest.mark.parametrize("groups", [[], ["event_type"]])
def test_single_scan_build_equals_the_separate_steps(spark, small, mode, groups):
    events = spark.read.parquet(f"{small}/lineitem.parquet").select(
        F.col("l_shipdate").alias("data"), F.col("l_returnflag").alias("event_type"), F.col("l_quantity").cast("int").alias("q")
    )
    events = events.unionByName(spark.createDataFrame([("A", 5)], "event_type string, q int").withColumn("data", F.lit(None).cast("timestamp_ntz")))
    built = ft.build_features(events.repartition(7), ["q"], groups, monthly_lags=mode)
    expected = composed(events, ["q"], groups, mode).select(*built.columns)
    assert sorted(map(repr, built.collect())) == sorted(map(repr, expected.collect()))


def test_build_reads_the_source_once_and_only_what_it_needs(spark, small):
    lines = spark.read.parquet(f"{small}/lineitem.parquet")
    plan = ft.build_features(lines, ["l_quantity"], ["l_returnflag"], "l_shipdate")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1
    assert "ReadSchema: struct<l_quantity:double,l_returnflag:string,l_shipdate:timestamp_ntz>" in plan
    assert plan.count("Exchange") == 2
    assert "Join" not in plan


def test_sum_types_are_kept(spark):
    df = spark.createDataFrame([(date(2024, 1, 1), Decimal("1.10"))], "data date, v decimal(10,2)")
    built = ft.build_features(df, ["v"])
    assert built.schema["v_semana"].dataType.simpleString() == "decimal(20,2)"
    assert built.schema["v_mes"].dataType.simpleString() == "decimal(20,2)"


def test_incomplete_rows_include_nan(spark):
    df = spark.createDataFrame([(1.0, 2.0), (float("nan"), 1.0), (None, 1.0)], "a double, b double")
    assert ft.drop_incomplete_rows(df).count() == 1
    assert ft.fill_missing_values(df, {"a": 0.0}).filter("a = 0").count() == 2


def test_feature_columns_leave_out_target_and_periods(spark):
    built = ft.build_features(daily(spark, ("2024-01-01", 1)), ["entrada"])
    assert "entrada_mes" not in ft.feature_columns(built, "entrada_mes")
    assert not {"semana", "mes"} & set(ft.feature_columns(built, "entrada_mes"))


def test_recent_window_reaches_the_scan(spark, small):
    lines = spark.read.parquet(f"{small}/lineitem.parquet")
    plan = ft.recent_window(lines, "l_shipdate", 28, "2001-11-04")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(l_shipdate), GreaterThanOrEqual(l_shipdate,2001-10-07T00:00)]" in plan
    assert ft.recent_window(lines, "l_shipdate").count() == 0


def test_unknown_mode_is_refused(spark):
    with pytest.raises(ValueError, match="monthly_lags"):
        ft.build_features(daily(spark, ("2024-01-01", 1)), ["entrada"], monthly_lags="weekly")
