import uuid
from datetime import datetime

import pytest
from conftest import by
from pyspark.sql import functions as F

from driftloom.functions.naming import qualified
from driftloom.operators import logstate as lg
from driftloom.sources import files, scratch, tables
from driftloom.streaming.rollup import read_rollup, rollup_stream


def name():
    return f"t_{uuid.uuid4().hex}"


def rows(spark, *values):
    return spark.createDataFrame(list(values), "id int, part string, v int, step int")


def test_overwrite_replaces_the_schema_and_keeps_the_comment(spark):
    t = name()
    tables.write_table(spark.range(3), t, description="it's a \\ test")
    assert tables.read_table(spark, t).count() == 3
    comment = spark.sql(f"DESCRIBE TABLE EXTENDED {t}").filter("col_name = 'Comment'").first().data_type
    assert comment == "it's a \\ test"
    tables.write_table(spark.createDataFrame([("x",)], "s string"), t)
    assert tables.from_sql(spark, f"SELECT * FROM {t}").collect() == [("x",)]


@pytest.mark.parametrize("partition_col", [None, "part"])
def test_upsert_is_a_keyed_merge_and_repeats_safely(spark, partition_col):
    t = name()
    keys = ["id"] if partition_col is None else ["id", "part"]
    tables.upsert_table(rows(spark, (1, "a", 10, 1), (2, "a", 20, 1), (3, "b", 30, 1)), t, keys, ["step"], partition_col)
    change = rows(spark, (2, "a", 21, 1), (2, "a", 22, 2), (4, "c", 40, 1), (None, "a", 0, 1))
    for _ in range(2):
        tables.upsert_table(change, t, keys, ["step"], partition_col)
        got = sorted((str(r.id), r.part, r.v) for r in tables.read_table(spark, t).collect())
        assert got == [("1", "a", 10), ("2", "a", 22), ("3", "b", 30), ("4", "c", 40), ("None", "a", 0)]


@pytest.mark.parametrize("partition_col", [None, "part"])
def test_upsert_takes_new_columns(spark, partition_col):
    t = name()
    keys = ["id"] if partition_col is None else ["id", "part"]
    tables.upsert_table(rows(spark, (1, "a", 10, 1), (3, "b", 30, 1)), t, keys, (), partition_col)
    tables.upsert_table(rows(spark, (1, "a", 11, 1)).withColumn("extra", F.lit("new")), t, keys, (), partition_col)
    got = {r["id"]: (r["v"], r["extra"]) for r in by(tables.read_table(spark, t), "id")}
    assert got == {1: (11, "new"), 3: (30, None)}


def test_upsert_can_overwrite_and_checks_its_partition(spark):
    t = name()
    tables.upsert_table(rows(spark, (1, "a", 10, 1)), t, ["id"])
    tables.upsert_table(rows(spark, (2, "a", 10, 1)), t, ["id"], overwrite=True)
    assert [r.id for r in spark.table(t).collect()] == [2]
    with pytest.raises(ValueError, match="one of the keys"):
        tables.upsert_table(rows(spark, (2, "a", 10, 1)), t, ["id"], partition_col="part")


def test_append_matches_columns_by_name(spark):
    t = name()
    tables.append_rows(spark.createDataFrame([(1, "a")], "x int, y string"), t)
    tables.append_rows(spark.createDataFrame([("b", 2)], "y string, x int"), t)
    assert sorted(map(tuple, spark.table(t).collect())) == [(1, "a"), (2, "b")]


def test_files(spark):
    df = spark.createDataFrame([(1, datetime(2024, 1, 1, 1, 2, 3, 456789))], "a int, t timestamp")
    for fmt in ("parquet", "orc", "csv", "json"):
        path = scratch.fresh_path(spark, fmt)
        files.write_files(df, path, fmt)
        assert files.read_files(spark, path, fmt, df.schema).collect() == df.collect()
    with pytest.raises(ValueError, match="explicit schema"):
        files.read_files(spark, path, "json")


def test_names():
    assert qualified("cat", "sch", "ta`ble") == "`cat`.`sch`.`ta``ble`"
    assert qualified("", "t") == "`t`"


def test_scratch_follows_the_session(spark):
    assert scratch.scratch_dir(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")
    settled = scratch.settle(spark.range(5))
    assert settled.count() == 5 and "FileScan" in settled._jdf.queryExecution().executedPlan().toString()


LOG = [
    ("m", 1, "Staging", 1, 1), ("m", 1, "Production", 2, 2), ("m", 2, "Staging", 3, 3),
    ("m", 2, "Production", 4, 4), ("m", 2, "None", 5, 5), ("m", 3, "Staging", 6, 6), ("n", 1, "Production", 1, 7),
]


def log(spark):
    return spark.createDataFrame(LOG, "model string, version int, stage string, ts int, id int").repartition(3)


def stages(df):
    return {(r.model, r.version): r.current_stage for r in df.collect()}


def test_stage_fold(spark):
    plain = lg.fold_stages(log(spark), ["model"], ["version"], ["ts", "id"])
    assert stages(plain) == {("m", 1): "Production", ("m", 2): "None", ("m", 3): "Staging", ("n", 1): "Production"}
    # Version 2 passed through Production and so archived version 1, though it left again.
    archiving = lg.fold_stages(log(spark), ["model"], ["version"], ["ts", "id"], archive_existing=True)
    assert stages(archiving) == {("m", 1): "Archived", ("m", 2): "None", ("m", 3): "Staging", ("n", 1): "Production"}
    by_row = lg.fold_stages(log(spark), ["model"], ["version"], ["ts", "id"], archive_existing=F.col("id") == 99)
    assert stages(by_row) == stages(plain)


def test_stage_names():
    assert lg.check_stage("Production") == "Production"
    with pytest.raises(ValueError, match="unknown stage"):
        lg.check_stage("Live")


def test_latest_and_newest(spark):
    latest = lg.latest_records(log(spark), ["model"], ["ts", "id"])
    assert {r.model: r.id for r in latest.collect()} == {"m": 6, "n": 7} and latest.columns == log(spark).columns
    assert lg.latest_in_stage(log(spark), ["model"], ["ts", "id"], "stage", ["Archived"]).count() == 0
    staged = lg.latest_in_stage(log(spark), ["model"], ["ts", "id"], "stage")
    assert [(r.model, r.version) for r in staged.collect()] == [("m", 2)]
    assert sorted((r.model, r.id, r["rank"]) for r in lg.newest_n(log(spark), ["model"], ["ts", "id"], 2).collect()) == [("m", 5, 2), ("m", 6, 1), ("n", 7, 1)]
    assert [(r.model, r.id) for r in lg.nth_newest(log(spark), ["model"], ["ts", "id"], 2).collect()] == [("m", 5)]
    plan = lg.newest_n(log(spark), ["model"], ["ts", "id"], 2)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_deletes_and_attributes(spark):
    kept = lg.without_deleted(log(spark), ["model", "version"], ["ts", "id"], F.col("stage") == "None")
    assert sorted((r.model, r.version) for r in kept.collect()) == [("m", 1), ("m", 3), ("n", 1)]
    tags = spark.createDataFrame([("e", "k", "1", 1), ("e", "k", "2", 2), ("e", "l", "3", 1), ("e", "", "x", 9), ("e", None, "x", 9)], "e string, tag string, value string, ts int")
    long = lg.fold_attributes(tags, ["e"], ["ts"])
    assert sorted(map(tuple, long.collect())) == [("e", "k", "2"), ("e", "l", "3")]
    assert lg.attribute_map(long, ["e"]).first().attributes == {"k": "2", "l": "3"}


def test_versions_continue(spark, small):
    old = spark.createDataFrame([("a", 4), ("b", 1)], "model string, version int")
    new = spark.createDataFrame([("a", 20), ("a", 10), ("c", 5)], "model string, ts int")
    got = lg.append_versions(old, new, ["model"], ["ts"])
    assert sorted((r.model, r.ts, r.version) for r in got.collect()) == [("a", 10, 5), ("a", 20, 6), ("c", 5, 1)]


def test_streamed_rollup_over_several_batches(spark, small):
    events = spark.read.parquet(f"{small}/events.parquet").select("ts", "event_type", "value")
    source = scratch.fresh_path(spark, "arriving")
    path, progress = scratch.fresh_path(spark, "weekly"), scratch.fresh_path(spark, "progress")
    for early in (True, False):
        before = F.col("ts") < F.lit("2024-01-17").cast("timestamp_ntz")
        events.filter(before if early else ~before).write.mode("append").parquet(source)
        arriving = spark.readStream.schema(events.schema).parquet(source)
        rollup_stream(arriving, ["value"], "ts", path, progress, ["event_type"]).awaitTermination()
    weekly = read_rollup(spark, path, ["event_type"]).select("event_type", "semana", F.round("value_semana", 2))
    expected = events.groupBy("event_type", F.date_trunc("week", "ts").alias("semana")).agg(F.round(F.sum("value"), 2))
    assert sorted(weekly.collect()) == sorted(expected.collect())
