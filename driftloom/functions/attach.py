"""Put one-row-per-group statistics beside the rows they describe."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def same_keys(left: Sequence[str], right: Sequence[str]) -> Column:
    """Null-safe equality of two key lists, so a null group stays a group."""
    return reduce(lambda a, b: a & b, (F.col(x).eqNullSafe(F.col(y)) for x, y in zip(left, right)))


def attach(df: DataFrame, stats: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Join `stats` (one row per key) to `df`, keeping the key columns of `df`.

    No broadcast hint is given, since the number of groups is not bounded. Operators that put
    statistics beside raw rows settle them first: the optimizer then sees their true size,
    broadcasts them below its threshold, and otherwise shuffles and splits a hot key at run
    time. Without keys `stats` is a single row and is read as a scalar subquery.
    """
    values = [c for c in stats.columns if c not in keys]
    if not keys:
        row = stats.select(F.struct(*values).alias("row")).scalar()
        held = df.select("*", row.alias("__stats"))
        return held.select(*df.columns, *[F.col("__stats")[c].alias(c) for c in values])
    hidden = [f"__key_{k}" for k in keys]
    right = stats.select(*[F.col(k).alias(h) for k, h in zip(keys, hidden)], *values)
    return df.join(right, same_keys(keys, hidden), how).drop(*hidden)
