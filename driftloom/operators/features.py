"""Daily rows to weekly features: rollups, month totals and lags."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from driftloom.functions.naming import DATE, MONTH, WEEK, month_lag, month_total, week_lag, week_total

LAGS = (1, 2, 3)


def week_of(date: Column) -> Column:
    """Monday of the ISO week, as a timestamp."""
    return F.date_trunc("week", F.to_date(date))


def month_of(date: Column) -> Column:
    """First of the month, as a timestamp."""
    return F.date_trunc("month", F.to_date(date))


def month_number(month: Column) -> Column:
    """Months counted on one axis, so that k months back is a plain difference."""
    return F.year(month) * 12 + F.month(month)


def weekly_rollup(df: DataFrame, value_cols: Sequence[str], group_cols: Sequence[str] = (), date_col: str = DATE) -> DataFrame:
    """Sum every value column per group and ISO week."""
    keyed = df.select(*group_cols, week_of(F.col(date_col)).alias(WEEK), *value_cols)
    return keyed.groupBy(*group_cols, WEEK).agg(*[F.sum(c).alias(week_total(c)) for c in value_cols])


def monthly_rollup(df: DataFrame, value_cols: Sequence[str], group_cols: Sequence[str] = (), date_col: str = DATE) -> DataFrame:
    """Sum every value column per group and calendar month."""
    keyed = df.select(*group_cols, month_of(F.col(date_col)).alias(MONTH), *value_cols)
    return keyed.groupBy(*group_cols, MONTH).agg(*[F.sum(c).alias(month_total(c)) for c in value_cols])


def join_month_totals(weekly: DataFrame, monthly: DataFrame, group_cols: Sequence[str] = ()) -> DataFrame:
    """Give each week the totals of the month its Monday falls in; the month leads the columns."""
    keyed = weekly.withColumn(MONTH, month_of(F.col(WEEK)))
    joined = keyed.join(monthly, [*group_cols, MONTH], "left")
    rest = [c for c in joined.columns if c not in {*group_cols, MONTH}]
    return joined.select(*group_cols, MONTH, *rest)


def add_weekly_lags(weekly: DataFrame, value_cols: Sequence[str], group_cols: Sequence[str] = (), lags: Sequence[int] = LAGS) -> DataFrame:
    """Lag the weekly totals by row, so a missing week is stepped over.

    The frame is at week grain, so one partition holds at most a calendar's worth of rows.
    """
    w = Window.partitionBy(*group_cols).orderBy(WEEK)
    return weekly.select(
        "*", *[F.lag(week_total(c), k).over(w).alias(week_lag(c, k)) for c in value_cols for k in lags]
    )


def add_monthly_lags_by_row(weekly: DataFrame, value_cols: Sequence[str], group_cols: Sequence[str] = (), lags: Sequence[int] = LAGS) -> DataFrame:
    """Lag the month totals over the weekly rows, ties inside a month broken by week."""
    w = Window.partitionBy(*group_cols).orderBy(MONTH, WEEK)
    return weekly.select(
        "*", *[F.lag(month_total(c), k).over(w).alias(month_lag(c, k)) for c in value_cols for k in lags]
    )


def add_monthly_lags(monthly: DataFrame, value_cols: Sequence[str], group_cols: Sequence[str] = (), lags: Sequence[int] = LAGS) -> DataFrame:
    """Totals exactly k calendar months back, on the monthly frame; null where that month has none."""
    w = Window.partitionBy(*group_cols).orderBy(month_number(F.col(MONTH)))
    return monthly.select(
        "*",
        *[F.max(month_total(c)).over(w.rangeBetween(-k, -k)).alias(month_lag(c, k)) for c in value_cols for k in lags],
    )


def fill_missing_weeks(weekly: DataFrame, group_cols: Sequence[str] = ()) -> DataFrame:
    """Insert the weeks a series skips, with null totals, so that lags follow the calendar.

    Each row emits itself and the empty weeks up to the next one: no calendar is joined.
    """
    w = Window.partitionBy(*group_cols).orderBy(WEEK)
    following = F.lead(WEEK).over(w)
    last = F.coalesce(following - F.expr("INTERVAL 7 DAYS"), F.col(WEEK))
    spread = weekly.select("*", last.alias("__last")).select(
        "*", F.posexplode_outer(F.sequence(WEEK, "__last", F.expr("INTERVAL 7 DAYS"))).alias("__step", "__week")
    )
    own = F.coalesce(F.col("__step"), F.lit(0)) == 0
    kept = [c for c in weekly.columns if c not in {*group_cols, WEEK}]
    return spread.select(*group_cols, F.col("__week").alias(WEEK), *[F.when(own, F.col(c)).alias(c) for c in kept])


def build_features(
    df: DataFrame,
    value_cols: Sequence[str],
    group_cols: Sequence[str] = (),
    date_col: str = DATE,
    monthly_lags: str = "calendar",
    lags: Sequence[int] = LAGS,
    drop_incomplete: bool = False,
) -> DataFrame:
    """The whole feature frame from one scan of the daily rows.

    Joining two rollups would read the source twice. Instead the rows are summed once per
    (group, week, month of the day), which has at most two rows per series and week; each of
    those is then stacked as a week part and a month part, and both totals come from a second,
    small aggregate. All later steps are partitioned by the group and share one exchange.

    `monthly_lags="calendar"` takes the total exactly k months back; `"row"` lags over weekly
    rows, so lag 1 is mostly the same month again.
    """
    if monthly_lags not in ("calendar", "row"):
        raise ValueError(f"monthly_lags must be 'calendar' or 'row', not {monthly_lags!r}")
    base = (
        df.select(*group_cols, week_of(F.col(date_col)).alias(WEEK), month_of(F.col(date_col)).alias("__day_month"), *value_cols)
        .groupBy(*group_cols, WEEK, "__day_month")
        .agg(*[F.sum(c).alias(c) for c in value_cols])
    )
    types = {c: base.schema[c].dataType for c in value_cols}
    if group_cols:
        base = base.repartition(*group_cols)

    week_part = F.struct(month_of(F.col(WEEK)).alias(MONTH), F.col(WEEK).alias("__part_week"), F.lit(True).alias("__is_week"))
    month_part = F.struct(
        F.col("__day_month").alias(MONTH), F.lit(None).cast("timestamp").alias("__part_week"), F.lit(False).alias("__is_week")
    )
    parts = (
        base.select(*group_cols, *value_cols, F.inline(F.array(week_part, month_part)))
        .groupBy(*group_cols, MONTH, "__part_week", "__is_week")
        .agg(*[F.sum(c).cast(types[c]).alias(c) for c in value_cols])
    )

    by_month = Window.partitionBy(*group_cols).orderBy(month_number(F.col(MONTH)))

    def months_back(c: str, k: int) -> Column:
        total = F.when(~F.col("__is_week") & F.col(MONTH).isNotNull(), F.col(c))
        return F.max(total).over(by_month.rangeBetween(-k, -k))

    month_cols = [months_back(c, 0).alias(month_total(c)) for c in value_cols]
    if monthly_lags == "calendar":
        month_cols += [months_back(c, k).alias(month_lag(c, k)) for c in value_cols for k in lags]
    weekly = parts.select("*", *month_cols).filter("__is_week")
    weekly = weekly.select(
        *[c for c in weekly.columns if c not in {*value_cols, "__part_week", "__is_week"}],
        F.col("__part_week").alias(WEEK),
        *[F.col(c).alias(week_total(c)) for c in value_cols],
    )
    # A week's month follows its Monday, so ordering by week also orders by (month, week).
    features = add_weekly_lags(weekly, value_cols, group_cols, lags)
    if monthly_lags == "row":
        w = Window.partitionBy(*group_cols).orderBy(WEEK)
        features = features.select(
            "*", *[F.lag(month_total(c), k).over(w).alias(month_lag(c, k)) for c in value_cols for k in lags]
        )
    features = features.select(
        *group_cols,
        MONTH,
        WEEK,
        *[week_total(c) for c in value_cols],
        *[month_total(c) for c in value_cols],
        *[week_lag(c, k) for c in value_cols for k in lags],
        *[month_lag(c, k) for c in value_cols for k in lags],
    )
    return drop_incomplete_rows(features) if drop_incomplete else features


def drop_incomplete_rows(df: DataFrame) -> DataFrame:
    """Keep rows without any null or NaN."""
    return df.dropna("any")


def fill_missing_values(df: DataFrame, values: dict[str, object]) -> DataFrame:
    """Replace nulls column by column."""
    return df.fillna(values)


def feature_columns(df: DataFrame, target: str, group_cols: Sequence[str] = ()) -> list[str]:
    """Every column that is neither target, period key nor group key."""
    return [c for c in df.columns if c not in {target, WEEK, MONTH, *group_cols}]


def recent_window(df: DataFrame, date_col: str = WEEK, days: int = 28, as_of: object = None) -> DataFrame:
    """Rows dated within `days` before `as_of` (default today).

    The bound folds to a literal and the column is left bare, so the filter reaches the scan.
    """
    anchor = F.current_date() if as_of is None else F.lit(as_of).cast("date")
    return df.filter(F.col(date_col) >= F.date_sub(anchor, days))
