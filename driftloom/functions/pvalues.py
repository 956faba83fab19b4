"""p-values of the drift tests, evaluated on one row per tested feature."""

from __future__ import annotations

import itertools
import math

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import DoubleType

# The alternating series stops after this many terms and is 1 below this argument.
SERIES_TERMS = 100
SERIES_FLOOR = 0.2


def ks_series(lam: Column) -> Column:
    """Kolmogorov's limiting tail probability, as a native expression."""
    terms = F.aggregate(
        F.sequence(F.lit(1), F.lit(SERIES_TERMS)),
        F.lit(0.0),
        lambda acc, k: acc + F.when(k % 2 == 1, F.lit(1.0)).otherwise(F.lit(-1.0)) * F.exp(-2.0 * k * k * lam * lam),
    )
    tail = F.greatest(F.lit(0.0), F.least(F.lit(1.0), 2.0 * terms))
    return F.when(lam.isNull(), F.lit(None).cast("double")).when(lam < SERIES_FLOOR, F.lit(1.0)).otherwise(tail)


def ks_p_asymptotic(statistic: Column, n_ref: Column, n_cur: Column) -> Column:
    """Large-sample p-value of the two-sample statistic."""
    n, m = n_ref.cast("double"), n_cur.cast("double")
    return ks_series(statistic * F.sqrt(F.try_divide(n * m, n + m)))


def exact_ks_tail(statistic: float, n: int, m: int) -> float:
    """P(D >= statistic) under equal distributions, over all interleavings (Hodges 1958).

    A lattice path from (0, 0) to (n, m) is an interleaving. The chance of having touched the
    region |i/n - j/m| >= statistic is carried along the anti-diagonals i + j = s. In that region
    it is 1, so only the band of points between its two halves is computed: the work grows with
    the statistic times n * m, and a statistic small enough to be in doubt leaves a narrow band.
    """
    if n > m:
        n, m = m, n
    step = math.lcm(n, m)
    per_i, per_j = step // n, step // m
    height = round(statistic * step)
    if height <= 0:
        return 1.0
    i = np.arange(n + 1, dtype=np.float64)
    touched = np.ones(n + 2)  # the chance for i is at i + 1
    touched[1] = 0.0
    low, high = 0, 0  # what the last anti-diagonal computed; all else is 1
    for s in range(1, n + m + 1):
        lo = max(0, s - m, (s * per_j - height) // (per_i + per_j) + 1)
        hi = min(n, s, -((-s * per_j - height) // (per_i + per_j)) - 1)
        at = i[lo : hi + 1]
        here = (at * touched[lo : hi + 1] + (s - at) * touched[lo + 1 : hi + 2]) / s
        touched[low + 1 : high + 2] = 1.0
        touched[lo + 1 : hi + 2] = here
        low, high = lo, hi
    return float(min(1.0, max(0.0, touched[n + 1])))


@pandas_udf(DoubleType())
def ks_p_exact(statistic: pd.Series, n_ref: pd.Series, n_cur: pd.Series) -> pd.Series:
    """Exact p-value; null where a sample is empty. The work grows with the product of the samples' sizes."""
    return pd.Series(
        [
            exact_ks_tail(float(d), int(n), int(m))
            if pd.notna(d) and n > 0 and m > 0
            else None
            for d, n, m in zip(statistic, n_ref, n_cur)
        ],
        dtype="float64",
    )


def chi_square_tail(x: float, df: float) -> float:
    """Upper tail of the chi-square distribution: the regularized incomplete gamma function.

    A power series below the mean and a continued fraction above it, as in the textbooks. Both
    run until a term no longer changes the sum: the fraction needs about as many steps as the
    root of `df`, and there is no limit to stop it short of that.
    """
    if math.isinf(x):
        return 0.0
    a, z = df / 2.0, x / 2.0
    if z <= 0:
        return 1.0
    scale = math.exp(a * math.log(z) - z - math.lgamma(a))
    if scale == 0:
        return 1.0 if z < a else 0.0
    if z < a + 1:
        term = total = 1.0 / a
        k = a
        while abs(term) > abs(total) * 1e-16:
            k += 1
            term *= z / k
            total += term
        return max(0.0, 1.0 - total * scale)
    tiny = 1e-300
    b = z + 1 - a
    c, d = 1 / tiny, 1 / b
    value = d
    for k in itertools.count(1):
        an = -k * (k - a)
        b += 2
        d = an * d + b
        d = 1 / (d if abs(d) > tiny else tiny)
        c = b + an / c
        c = c if abs(c) > tiny else tiny
        delta = d * c
        value *= delta
        if not abs(delta - 1) >= 1e-15:  # settled, or no number any more
            break
    return value * scale


@pandas_udf(DoubleType())
def chi_square_p(statistic: pd.Series, df: pd.Series) -> pd.Series:
    """p-value of a chi-square statistic; null without a degree of freedom."""
    return pd.Series(
        [chi_square_tail(float(x), float(k)) if pd.notna(x) and pd.notna(k) and k > 0 else None for x, k in zip(statistic, df)],
        dtype="float64",
    )
