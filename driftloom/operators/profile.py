"""A one-pass look at a dataset."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row per column: type, rows, nulls, approximate distinct count and extremes as text.

    Everything is computed in a single aggregate; only the one-row result is turned on its side.
    """
    names = list(columns or df.columns)
    aggregates = [F.count(F.lit(1)).alias("__rows")]
    for i, c in enumerate(names):
        aggregates += [
            F.count_if(F.col(c).isNull()).alias(f"__nulls{i}"),
            F.approx_count_distinct(c).alias(f"__distinct{i}"),
            F.min(c).cast("string").alias(f"__min{i}"),
            F.max(c).cast("string").alias(f"__max{i}"),
        ]
    rows = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.lit(df.schema[c].dataType.simpleString()).alias("data_type"),
            F.col("__rows").alias("n_rows"),
            F.col(f"__nulls{i}").alias("n_nulls"),
            F.col(f"__distinct{i}").alias("n_distinct_approx"),
            F.col(f"__min{i}").alias("min_value"),
            F.col(f"__max{i}").alias("max_value"),
        )
        for i, c in enumerate(names)
    ]
    return df.agg(*aggregates).select(F.inline(F.array(*rows)))


def shape(df: DataFrame) -> DataFrame:
    """Row and column count."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select("n_rows", F.lit(len(df.columns)).alias("n_columns"))
