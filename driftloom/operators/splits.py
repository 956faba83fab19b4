"""Train and test parts, marked in a column or produced by set difference."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftloom.functions.attach import attach
from driftloom.functions.naming import WEEK
from driftloom.operators.ordering import key_at_share
from driftloom.sources.scratch import settle

# Multiplicative hashing (Knuth): a prime modulus, the 32-bit golden-ratio multiplier, 2^32.
PRIME = 2147483647
MULTIPLIER = 2654435761
SPAN = 4294967296


def temporal_split(
    df: DataFrame,
    order_cols: Sequence[str] = (WEEK,),
    train_share: float = 0.8,
    group_cols: Sequence[str] = (),
    most: int | None = None,
) -> DataFrame:
    """Mark each group's first int(train_share * n) rows as train, the rest as test.

    The rows themselves are not shuffled: the sort key of the last training row is found from
    counts (one row per group) and every row is compared with it. `order_cols` must identify a
    row within its group, otherwise rows tied with that last key all count as training rows.
    """
    last = settle(key_at_share(df, order_cols, train_share, group_cols, most))
    marked = attach(df, last, group_cols)
    split = F.when(F.struct(*order_cols) <= F.col("last_key"), F.lit("train")).otherwise(F.lit("test"))
    return marked.select(*df.columns, split.alias("split"))


def hash_share(key: Column) -> Column:
    """A number in [0, 1) that depends on an integral key alone."""
    return F.pmod(F.pmod(key.cast("bigint"), F.lit(PRIME)) * F.lit(MULTIPLIER), F.lit(SPAN)) / F.lit(float(SPAN))


def hash_split(df: DataFrame, key_cols: Sequence[str], train_share: float = 0.8) -> DataFrame:
    """Random-like split decided by the row's key, so it does not depend on the data's layout."""
    only_key = len(key_cols) == 1 and df.schema[key_cols[0]].dataType.typeName() in ("integer", "long")
    key = F.col(key_cols[0]) if only_key else F.xxhash64(*key_cols)
    split = F.when(hash_share(key) < train_share, F.lit("train")).otherwise(F.lit("test"))
    return df.select("*", split.alias("split"))


def random_split(df: DataFrame, train_share: float = 0.8, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """Spark's own random split; the parts depend on how the input is partitioned."""
    train, test = df.randomSplit([train_share, 1.0 - train_share], seed=seed)
    return train, test


def except_rows(df: DataFrame, other: DataFrame, keep_duplicates: bool = False) -> DataFrame:
    """Rows of `df` not in `other`: a set by default, a bag with `keep_duplicates`.

    Both sides are made distinct first, so a heavily repeated row is folded before the shuffle.
    """
    if keep_duplicates:
        return df.exceptAll(other)
    return df.distinct().subtract(other.distinct())
