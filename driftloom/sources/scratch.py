"""Intermediate results in the folder the cluster shares."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch_dir(spark: SparkSession) -> str:
    """The session's checkpoint folder (`spark.checkpoint.dir`).

    Where none is set, it is a folder in the warehouse. On a cluster that must not be a local
    path (Spark's default is one), since its executors would not see each other's files.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(configured)
        return configured.rstrip("/")
    warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    if not spark.sparkContext.master.startswith("local") and ("://" not in warehouse or warehouse.startswith("file:")):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    chosen = f"{warehouse}/_driftloom_scratch"
    spark.sparkContext.setCheckpointDir(chosen)
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path under the scratch folder that nothing has written to yet."""
    return f"{scratch_dir(spark)}/{label}-{uuid.uuid4().hex}"


def settle(df: DataFrame) -> DataFrame:
    """Compute now and read back from Parquet in the shared folder.

    Besides cutting the lineage this tells the optimizer the frame's true size: a later join
    with large rows broadcasts it when its files are below the broadcast threshold and shuffles
    otherwise, instead of shuffling the rows before finding out.
    """
    path = fresh_path(df.sparkSession, "settled")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def settle_partitioned(df: DataFrame) -> DataFrame:
    """Compute now into a checkpoint, which remembers how its rows are partitioned."""
    scratch_dir(df.sparkSession)
    return df.checkpoint(eager=True)
