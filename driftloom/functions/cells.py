"""Order-preserving cells: how a long ordering is cut into many tasks.

A running sum over all values of one feature would sort that feature in a single task. The
operators here first sum inside *cells* (contiguous stretches of the value axis) and then
across cells. A cell number is a monotone function of the value alone, so every evaluation
of it agrees, and a lost task can be rerun on its own.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ln of the smallest positive double is -744.44, so folds shifted by this stay positive.
FOLD_SHIFT = 746
FAR_CELL = 1 << 40
#: Cells per e-fold of distance from 0: a cell spans a thousandth of its values' size.
PER_FOLD = 1024
#: A cell with more values than this is cut into parts before its values are looked at one by one.
HEAVY_CELL = 1 << 20


def parts_of(n: Column, low: Column, high: Column) -> Column:
    """Parts to cut a cell of n values from `low` to `high` into; one where the values cannot be told apart by distance.

    Values close together for their size fall into one cell. Cut evenly between the smallest and the
    largest value it holds, it is spread like the rest.
    """
    width = high - low
    wanted = F.greatest(F.lit(1), F.ceil(F.sqrt(n.cast("double")) / 4)).cast("bigint")
    return F.when((width > 0) & (width < F.lit(float("inf"))), wanted).otherwise(F.lit(1).cast("bigint"))


def part_of(value: Column, low: Column, high: Column, parts: Column) -> Column:
    """Number of the part that holds a value, from 0; monotone in the value."""
    share = (value - low) / F.nullif(high - low, F.lit(0.0))
    return F.when(parts > 1, F.least(F.floor(share * parts).cast("bigint"), parts - 1)).otherwise(F.lit(0).cast("bigint"))


def cell_of(value: Column, per_fold: int = PER_FOLD) -> Column:
    """Cell number of a double: logarithmic in its distance from 0, on both sides; null for null.

    It depends on the value alone, so rows are counted per cell in the first pass over them.
    Logarithmic spacing keeps outliers from flattening the bulk into one cell. Values that are
    close together for their size (large ids, epoch numbers) share a cell, which is cut into
    parts between its smallest and largest value when it is looked into.
    """
    fold = F.floor((F.ln(F.abs(value)) + FOLD_SHIFT) * per_fold).cast("bigint") + 1
    side = F.when(value > 0, F.lit(1)).otherwise(F.lit(-1))
    return (
        F.when(value.isNull(), F.lit(None).cast("bigint"))
        .when(value == 0, F.lit(0).cast("bigint"))
        .when(F.abs(value) == F.lit(float("inf")), side * F.lit(FAR_CELL))
        .otherwise(side * fold)
    )
