"""Tables: read, create, keyed upsert and append."""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftloom.functions.attach import same_keys
from driftloom.functions.naming import table_name
from driftloom.operators.logstate import latest_records
from driftloom.sources.scratch import fresh_path, settle

DEFAULT_FORMAT = "parquet"


def from_sql(spark: SparkSession, query: str) -> DataFrame:
    """The result of any SQL text as a frame."""
    return spark.sql(query)


def read_table(spark: SparkSession, name: str | Sequence[str]) -> DataFrame:
    """A table by its name, or by the parts of its name, as every function here takes it."""
    return spark.table(table_name(name))


def _sql_text(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def write_table(
    df: DataFrame,
    name: str | Sequence[str],
    mode: str = "overwrite",
    description: str = "",
    fmt: str = DEFAULT_FORMAT,
    partition_by: Sequence[str] = (),
    path: str | None = None,
) -> None:
    """Create or overwrite a table, its schema included, and comment it if asked to."""
    name = table_name(name)
    writer = df.write.format(fmt).mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)
    if description:
        df.sparkSession.sql(f"COMMENT ON TABLE {name} IS {_sql_text(description)}")


def merge_rows(old: DataFrame, new: DataFrame, keys: Sequence[str], order_cols: Sequence[str] = ()) -> DataFrame:
    """`old` with the rows of `new` put in place by key; columns either side lacks become null.

    Of several new rows with one key the last in `order_cols` wins.
    """
    return replace_rows(old, newest_rows(new, keys, order_cols), keys)


def newest_rows(new: DataFrame, keys: Sequence[str], order_cols: Sequence[str] = ()) -> DataFrame:
    """One row per key: the last in `order_cols`; without those, a key that occurs twice is an error."""
    if order_cols:
        return latest_records(new, keys, order_cols)
    rest = [c for c in new.columns if c not in keys]
    rows = new.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"), *[F.first(c).alias(c) for c in rest])
    single = F.assert_true(F.col("__n") == 1, F.lit("several new rows have one key: give order_cols")).isNull()
    return rows.filter(single).select(*new.columns)


def replace_rows(old: DataFrame, newest: DataFrame, keys: Sequence[str]) -> DataFrame:
    """`merge_rows` for new rows that are already unique by key."""
    hidden = [f"__key_{k}" for k in keys]
    replaced = newest.select(*[F.col(k).alias(h) for k, h in zip(keys, hidden)])
    kept = old.join(replaced, same_keys(keys, hidden), "left_anti")
    return kept.unionByName(newest, allowMissingColumns=True)


def table_location(spark: SparkSession, name: str | Sequence[str]) -> str:
    """The table's folder, from the catalog's own record and not by a row's name, which a column may bear."""
    return json.loads(spark.sql(f"DESCRIBE TABLE EXTENDED {table_name(name)} AS JSON").first()[0])["location"]


def upsert_table(
    df: DataFrame,
    name: str | Sequence[str],
    keys: Sequence[str],
    order_cols: Sequence[str] = (),
    partition_col: str | None = None,
    overwrite: bool = False,
    fmt: str = DEFAULT_FORMAT,
) -> None:
    """Keyed merge into a table; `overwrite=True` replaces the whole table instead.

    The merged rows are written once, to a new folder beside the current one, and the table is
    then pointed at it: readers never see a half-written table, and the plan never overwrites
    what it reads. For a table partitioned by `partition_col` (which must be one of the keys)
    only the partitions that occur in `df` are read and rewritten.
    """
    spark, name = df.sparkSession, table_name(name)
    if overwrite or not spark.catalog.tableExists(name):
        rows = df if overwrite else newest_rows(df, keys, order_cols)
        write_table(rows, name, fmt=fmt, partition_by=[partition_col] if partition_col else [])
        return
    old = spark.table(name)
    added = [f for f in df.schema.fields if f.name not in old.columns]
    # Stored first, so that a small change is broadcast and the old rows are not shuffled for it.
    newest = settle(newest_rows(df, keys, order_cols))
    if partition_col is None:
        base = table_location(spark, name).rstrip("/")
        base = re.sub(r"__v_[0-9a-f]{32}$", "", base)
        target = f"{base}__v_{uuid.uuid4().hex}"
        replace_rows(old, newest, keys).write.format(fmt).save(target)
        _add_columns(spark, name, added)
        spark.sql(f"ALTER TABLE {name} SET LOCATION {_sql_text(target)}")
    else:
        if partition_col not in keys:
            raise ValueError(f"partition column {partition_col!r} must be one of the keys")
        # One literal per partition of the change, so that the scan lists and reads those folders only.
        touched = [r[0] for r in newest.select(partition_col).distinct().collect()]
        listed = F.col(partition_col).isin([v for v in touched if v is not None])
        affected = old.filter(listed | F.col(partition_col).isNull() if None in touched else listed)
        staged = fresh_path(spark, "upsert")
        replace_rows(affected, newest, keys).write.format(fmt).save(staged)
        _add_columns(spark, name, added)
        merged = spark.read.format(fmt).load(staged).select(*spark.table(name).columns)
        with _dynamic_overwrite(spark):
            merged.write.insertInto(name, overwrite=True)
    spark.catalog.refreshTable(name)


@contextmanager
def _dynamic_overwrite(spark: SparkSession) -> Iterator[None]:
    """Overwrite only the partitions written to; inserts obey the session, not a writer option."""
    setting = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "dynamic")
    try:
        yield
    finally:
        spark.conf.set(setting, before)


def _add_columns(spark: SparkSession, name: str, fields: Sequence) -> None:
    if fields:
        listed = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({listed})")
        spark.catalog.refreshTable(name)


def append_rows(df: DataFrame, name: str | Sequence[str], fmt: str = DEFAULT_FORMAT, path: str | None = None) -> None:
    """Append rows to a results table, creating it on first use; columns are matched by name.

    A column that the table lacks is an error, since its values would be lost.
    """
    spark, name = df.sparkSession, table_name(name)
    if spark.catalog.tableExists(name):
        unknown = sorted(set(df.columns) - set(spark.table(name).columns))
        if unknown:
            raise ValueError(f"{name} has no column {', '.join(unknown)}")
        df = df.select(*[F.col(f.name).cast(f.dataType) for f in spark.table(name).schema.fields])
    write_table(df, name, mode="append", fmt=fmt, path=path)
