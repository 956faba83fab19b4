"""A keyed table in hash buckets: a merge rewrites the buckets it touches and commits once.

The folder holds data and versions. A version is a small Parquet table that lists, for every
bucket of the keys' hash, the folder with that bucket's rows, and carries the table's settings.
It counts once its write has finished, and the highest one that counts is the table. A merge
writes the touched buckets beside the old ones and then a version that names the new folders for
them and the old ones for the rest. Whatever fails before that leaves the old version as it was,
readers keep the version they began with, and of two writers at once the later one gets an error.
"""

from __future__ import annotations

import json
import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftloom.sources.scratch import settle
from driftloom.sources.tables import newest_rows, replace_rows

BUCKET = "__bucket"
_VERSION = "bucket int, path string, settings string"


@dataclass(frozen=True)
class Version:
    """One state of the table: its number, settings, and each bucket's folder (buckets without rows have none)."""

    number: int
    keys: tuple[str, ...]
    buckets: int
    schema: T.StructType
    paths: dict[int, str]

    def settings(self) -> str:
        return json.dumps({"keys": list(self.keys), "buckets": self.buckets, "schema": self.schema.json()})


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    """The bucket of a row, from its keys alone; nulls have theirs."""
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def latest_version(spark: SparkSession, folder: str) -> Version | None:
    """The newest version whose write has finished; None where there is no table."""
    paths = spark._jvm.org.apache.hadoop.fs
    top = paths.Path(f"{folder}/versions")
    files = top.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(top):
        return None
    numbers = [int(m[1]) for s in files.listStatus(top) if (m := re.search(r"/v(\d+)$", s.getPath().toString()))]
    for number in sorted(numbers, reverse=True):
        place = f"{folder}/versions/v{number:09d}"
        if files.exists(paths.Path(f"{place}/_SUCCESS")):
            rows = spark.read.schema(_VERSION).parquet(place).collect()
            said = json.loads(rows[0]["settings"])
            schema = T.StructType.fromJson(json.loads(said["schema"]))
            return Version(number, tuple(said["keys"]), said["buckets"], schema, {r["bucket"]: r["path"] for r in rows if r["path"]})
    return None


def read_buckets(spark: SparkSession, folder: str, version: Version | None = None) -> DataFrame:
    """The table's rows, or those of an earlier version."""
    version = version or latest_version(spark, folder)
    if version is None:
        raise ValueError(f"there is no table at {folder}")
    return _rows_of(spark, version, list(version.paths))


def _rows_of(spark: SparkSession, version: Version, wanted: Sequence[int]) -> DataFrame:
    paths = [version.paths[b] for b in wanted if b in version.paths]
    if not paths:
        return spark.createDataFrame([], version.schema)
    return spark.read.schema(version.schema).parquet(*paths)


def _commit(spark: SparkSession, folder: str, version: Version) -> Version:
    rows = [(b, version.paths.get(b), version.settings()) for b in sorted({*version.paths, 0})]
    spark.createDataFrame(rows, _VERSION).coalesce(1).write.mode("errorifexists").parquet(f"{folder}/versions/v{version.number:09d}")
    return version


def _write(rows: DataFrame, folder: str, number: int, keys: Sequence[str], buckets: int) -> str:
    """Write rows into one folder per bucket; large buckets become several files."""
    place = f"{folder}/data/v{number:09d}"
    dealt = rows.withColumn(BUCKET, bucket_of(keys, buckets)).hint("rebalance", BUCKET)
    dealt.write.mode("overwrite").partitionBy(BUCKET).parquet(place)
    return place


def create_buckets(df: DataFrame, folder: str, keys: Sequence[str], buckets: int = 256, order_cols: Sequence[str] = ()) -> Version:
    """A new table of the rows, one per key (the last in `order_cols`). The number of buckets stays; about as many as a merge may rewrite GBs is a good one."""
    spark = df.sparkSession
    if latest_version(spark, folder) is not None:
        raise ValueError(f"there is a table at {folder} already")
    rows = settle(newest_rows(df, keys, order_cols))
    place = _write(rows, folder, 1, keys, buckets)
    held = [r[0] for r in rows.select(bucket_of(keys, buckets)).distinct().collect()]
    return _commit(spark, folder, Version(1, tuple(keys), buckets, df.schema, {b: f"{place}/{BUCKET}={b}" for b in held}))


def upsert_buckets(df: DataFrame, folder: str, order_cols: Sequence[str] = ()) -> Version:
    """Merge rows by key, reading and rewriting only the buckets that they fall into.

    Of several rows with one key the last in `order_cols` counts. Columns the table lacks are
    added, and null in the rows that are not rewritten; columns the rows lack become null. A
    merge of no rows changes nothing.
    """
    spark = df.sparkSession
    version = latest_version(spark, folder)
    if version is None:
        raise ValueError(f"there is no table at {folder}")
    kinds = {f.name: f.dataType for f in version.schema.fields}
    df = df.select(*[F.col(c).cast(kinds[c]) if c in kinds else F.col(c) for c in df.columns])  # the same key has the same hash
    newest = settle(newest_rows(df, version.keys, order_cols))
    touched = sorted(r[0] for r in newest.select(bucket_of(version.keys, version.buckets)).distinct().collect())
    if not touched:
        return version
    schema = T.StructType([*version.schema.fields, *[f for f in df.schema.fields if f.name not in version.schema.names]])
    merged = replace_rows(_rows_of(spark, version, touched), newest, version.keys)
    typed = merged.select(*[(F.col(f.name) if f.name in merged.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields])
    place = _write(typed, folder, version.number + 1, version.keys, version.buckets)
    paths = version.paths | {b: f"{place}/{BUCKET}={b}" for b in touched}
    return _commit(spark, folder, Version(version.number + 1, version.keys, version.buckets, schema, paths))
