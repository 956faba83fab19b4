"""From daily rows to fitted candidates and their metrics."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftloom.functions.naming import WEEK
from driftloom.operators.features import build_features, drop_incomplete_rows, feature_columns
from driftloom.operators.models import Fit, fit_candidates, fit_passive_aggressive, fit_scaled
from driftloom.operators.scoring import Model
from driftloom.operators.splits import temporal_split
from driftloom.sources.scratch import settle


def prepare_training(
    daily: DataFrame,
    value_cols: Sequence[str],
    group_cols: Sequence[str] = (),
    date_col: str = "data",
    train_share: float = 0.8,
    monthly_lags: str = "calendar",
) -> DataFrame:
    """Complete feature rows with a temporal `split` column.

    The feature frame is stored first: fitting, scaling and metrics all read it again, and the
    daily rows should be read once.
    """
    features = settle(drop_incomplete_rows(build_features(daily, value_cols, group_cols, date_col, monthly_lags)))
    return temporal_split(features, [WEEK], train_share, group_cols)


def passive_aggressive_candidate(key_cols: Sequence[str] = (WEEK,), method: str = "sequential", **settings: object) -> Fit:
    """The default candidate: standardised features, passive-aggressive fit.

    It is sequential, since a weekly series is as short as the calendar.
    """

    def fit(df: DataFrame, features: Sequence[str], label: str, group_cols: Sequence[str] = ()) -> DataFrame:
        return fit_passive_aggressive(df, features, label, group_cols, key_cols, method=method, **settings)

    return fit_scaled(fit)


def train_run(
    prepared: DataFrame,
    target: str,
    candidates: Mapping[str, Fit] | None = None,
    group_cols: Sequence[str] = (),
) -> tuple[dict[str, DataFrame | Model], DataFrame]:
    """Fit the candidates on a prepared frame; see `fit_candidates`. A candidate may return any kind of model."""
    features = [c for c in feature_columns(prepared, target, group_cols) if c != "split"]
    chosen = candidates or {"passive_aggressive": passive_aggressive_candidate()}
    return fit_candidates(prepared, chosen, features, target, group_cols)
