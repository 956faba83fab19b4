"""Files as sources and sinks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# Text formats would otherwise cut timestamps to milliseconds.
FULL_TIME = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def _with_times(fmt: str, options: dict[str, str]) -> dict[str, str]:
    return FULL_TIME | options if fmt in ("csv", "json") else options


def read_files(
    spark: SparkSession, path: str, fmt: str = "parquet", schema: T.StructType | str | None = None, **options: str
) -> DataFrame:
    """Parquet, ORC, CSV or JSON files. Text formats need a schema, so that nothing is inferred."""
    if schema is None and fmt in ("csv", "json"):
        raise ValueError(f"{fmt} files are read with an explicit schema")
    reader = spark.read.format(fmt).options(**_with_times(fmt, options))
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path)


def write_files(
    df: DataFrame, path: str, fmt: str = "parquet", mode: str = "errorifexists", partition_by: Sequence[str] = (), **options: str
) -> None:
    df.write.format(fmt).mode(mode).partitionBy(*partition_by).options(**_with_times(fmt, options)).save(path)
