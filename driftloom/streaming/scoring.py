"""Scoring rows as they arrive, by the model that scores batches."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from driftloom.operators.scoring import Model, as_model


def score_stream(
    rows: DataFrame,
    model: Model | DataFrame,
    features: Sequence[str],
    path: str,
    checkpoint: str,
    group_cols: Sequence[str] = (),
    trigger: dict | None = None,
) -> StreamingQuery:
    """Append predictions of any kind of model for a streaming frame to Parquet files, exactly once per row."""
    scored = as_model(model, features, group_cols).score(rows)
    return (
        scored.writeStream.outputMode("append")
        .format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
