"""Standardisation with statistics taken from the training rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftloom.functions.attach import attach
from driftloom.sources.scratch import settle


def scaler_fit(df: DataFrame, features: Sequence[str], group_cols: Sequence[str] = ()) -> DataFrame:
    """Mean and population standard deviation of every feature, one aggregate for all of them."""
    stats = []
    for c in features:
        stats += [F.avg(F.col(c).cast("double")).alias(f"{c}__mean"), F.stddev_pop(F.col(c).cast("double")).alias(f"{c}__std")]
    return settle(df.groupBy(*group_cols).agg(*stats))


def standardise(df: DataFrame, scaler: DataFrame, features: Sequence[str], group_cols: Sequence[str] = ()) -> DataFrame:
    """(x - mean) / std in place; a constant feature is only centred."""
    joined = attach(df, scaler, group_cols)

    def scaled(c: str):
        std = F.when(F.col(f"{c}__std") == 0, F.lit(1.0)).otherwise(F.col(f"{c}__std"))
        return ((F.col(c).cast("double") - F.col(f"{c}__mean")) / std).alias(c)

    return joined.select(*[scaled(c) if c in features else F.col(c) for c in df.columns])
