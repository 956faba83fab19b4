"""Quantile sketches: mergeable, of bounded size, with a stated error of rank.

A sketch is a binary column holding a KLL sketch (Karnin, Lang and Liberty 2016), made by Spark's
own aggregate. Its size depends on the accuracy alone, not on the number of rows, and sketches of
parts merge into the sketch of the whole, so they can be kept per day and combined later.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The sketch's published error of rank is 2.296 / k^0.9021 for its size k (at 99 %), k being 8 to 65535.
ERROR_FACTOR, ERROR_POWER = 2.296, 0.9021
LEAST_K, MOST_K = 8, 65_535


def clean_double(value: Column) -> Column:
    """The value as a double, with NaN turned into null."""
    number = value.cast("double")
    return F.when(~F.isnan(number), number)


def size_for(accuracy: float) -> int:
    """The sketch size for which a rank is off by more than `accuracy` (a share of the rows) in practice never.

    Half the accuracy is asked of the published 99 % error, so that the stated bound lies at about
    five of its standard deviations.
    """
    if not 0 < accuracy < 1:
        raise ValueError("accuracy is a share of the rows, between 0 and 1")
    k = math.ceil((2 * ERROR_FACTOR / accuracy) ** (1 / ERROR_POWER))
    if k > MOST_K:
        raise ValueError(f"an accuracy of {accuracy} is finer than sketches allow; leave it out for exact quantiles")
    return max(LEAST_K, k)


def sketch_values(df: DataFrame, value_col: str, group_cols: Sequence[str] = (), accuracy: float = 0.01, name: str = "sketch") -> DataFrame:
    """One sketch per group; nulls and NaN are left out, and a group without any value gives no row."""
    values = df.select(*group_cols, clean_double(F.col(value_col)).alias("__v")).filter("__v IS NOT NULL")
    made = values.groupBy(*group_cols).agg(F.count(F.lit(1)).alias("__n"), F.kll_sketch_agg_double("__v", size_for(accuracy)).alias(name))
    return made.filter("__n > 0").drop("__n")


def merge_sketches(sketches: DataFrame, group_cols: Sequence[str] = (), accuracy: float = 0.01, name: str = "sketch") -> DataFrame:
    """The sketches of each group's rows as one, as exact as one sketch of all its values."""
    merged = sketches.filter(F.col(name).isNotNull()).groupBy(*group_cols).agg(
        F.count(F.lit(1)).alias("__n"), F.kll_merge_agg_double(name, size_for(accuracy)).alias(name)
    )
    return merged.filter("__n > 0").drop("__n")


def read_quantiles(sketches: DataFrame, probs: dict[str, float], group_cols: Sequence[str] = (), name: str = "sketch") -> DataFrame:
    """One column per name in `probs`, read off the sketches: values that occurred, not interpolated ones."""
    asked = [F.kll_sketch_get_quantile_double(name, F.lit(float(p))).alias(c) for c, p in probs.items()]
    return sketches.select(*group_cols, *asked)


def sketched_quantiles(
    df: DataFrame, value_col: str, probs: dict[str, float], group_cols: Sequence[str] = (), accuracy: float = 0.01
) -> DataFrame:
    """Quantiles whose rank is off by at most `accuracy`, in one pass and in memory that does not grow with the rows."""
    return read_quantiles(sketch_values(df, value_col, group_cols, accuracy), probs, group_cols)
