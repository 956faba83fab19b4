"""Weekly totals over arriving rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from driftloom.functions.naming import WEEK, week_total
from driftloom.operators.logstate import latest_records

# Windows are counted from 1970-01-01, a Thursday; the first Monday is four days later.
MONDAY = "4 days"
BATCH = "batch_id"


def rollup_stream(
    rows: DataFrame,
    value_cols: Sequence[str],
    time_col: str,
    path: str,
    checkpoint: str,
    group_cols: Sequence[str] = (),
    lateness: str | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Keep the weekly sums of a stream in a log of updates under `path`.

    Every micro-batch writes the weeks it changed into its own folder, so a repeated batch
    replaces itself. A row counts however late it comes: state is one row per group and week, and
    is kept. Only a caller who gives `lateness` has weeks closed that long after they end, and
    later rows for them left out.
    """
    timed = rows.withColumn("__ts", F.col(time_col).cast("timestamp"))
    timed = timed if lateness is None else timed.withWatermark("__ts", lateness)
    weekly = (
        timed.groupBy(*group_cols, F.window("__ts", "7 days", "7 days", MONDAY).alias("__window"))
        .agg(*[F.sum(c).alias(week_total(c)) for c in value_cols])
        .select(*group_cols, F.col("__window.start").alias(WEEK), *[week_total(c) for c in value_cols])
    )

    def write_updates(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/{BATCH}={batch_id}")

    return (
        weekly.writeStream.outputMode("update")
        .foreachBatch(write_updates)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def read_rollup(spark: SparkSession, path: str, group_cols: Sequence[str] = ()) -> DataFrame:
    """The newest total of every week in the log of updates."""
    return latest_records(spark.read.parquet(path), [*group_cols, WEEK], [BATCH]).drop(BATCH)
