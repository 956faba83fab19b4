import pytest
from pyspark.sql import functions as F

from driftloom.functions.naming import table_name
from driftloom.sources import buckets as bk
from driftloom.sources import tables


def rows(spark, pairs):
    return spark.createDataFrame(pairs, "k long, g string, v int")


def held(df):
    return sorted(map(str, map(tuple, df.collect())))


def test_merge_rewrites_touched_buckets_only(spark, tmp_path):
    folder = str(tmp_path / "t")
    first = bk.create_buckets(rows(spark, [(i, "a", i) for i in range(200)] + [(None, None, 7)]), folder, ["k", "g"], 16)
    change = spark.createDataFrame([(3, "a", -3), (900, "a", 9)], "k int, g string, v int")  # narrower keys hash alike
    second = bk.upsert_buckets(change, folder)
    moved = {b for b in second.paths if second.paths[b] != first.paths.get(b)}
    assert second.number == 2 and 1 <= len(moved) <= 2 and len(second.paths) >= 15
    got = {(r["k"], r["g"]): r["v"] for r in bk.read_buckets(spark, folder).collect()}
    assert len(got) == 202 and got[(3, "a")] == -3 and got[(900, "a")] == 9 and got[(None, None)] == 7
    old = bk.read_buckets(spark, folder, first)
    assert old.count() == 201 and old.filter("v < 0").count() == 0
    plan = bk._rows_of(spark, second, sorted(moved))._jdf.queryExecution().executedPlan().toString()
    assert f"{len(moved)} paths" in plan
    third = bk.upsert_buckets(rows(spark, [(None, None, 8)]), folder)
    assert sorted(r["v"] for r in bk.read_buckets(spark, folder, third).filter("k IS NULL").collect()) == [8]
    assert bk.upsert_buckets(change.limit(0), folder) == third


def test_a_failed_merge_leaves_the_old_version(spark, tmp_path, monkeypatch):
    folder = str(tmp_path / "t")
    version = bk.create_buckets(rows(spark, [(1, "a", 1), (2, "a", 2)]), folder, ["k"], 4)
    bad = rows(spark, [(1, "a", 5)]).withColumn("v", F.raise_error(F.lit("broken")).cast("int"))
    with pytest.raises(Exception, match="broken"):
        bk.upsert_buckets(bad, folder)
    monkeypatch.setattr(bk, "_commit", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        bk.upsert_buckets(rows(spark, [(1, "a", 6)]), folder)
    monkeypatch.undo()
    assert bk.latest_version(spark, folder) == version and held(bk.read_buckets(spark, folder)) == held(rows(spark, [(1, "a", 1), (2, "a", 2)]))
    bk.upsert_buckets(rows(spark, [(1, "a", 7)]), folder)
    with pytest.raises(Exception, match="(?i)exists"):  # a second writer that began at the same version
        bk._commit(spark, folder, bk.Version(2, ("k",), 4, version.schema, version.paths))
    assert held(bk.read_buckets(spark, folder)) == held(rows(spark, [(1, "a", 7), (2, "a", 2)]))


def test_columns_orders_and_empty_tables(spark, tmp_path):
    folder = str(tmp_path / "t")
    bk.create_buckets(rows(spark, []), folder, ["k"], 8)
    assert bk.read_buckets(spark, folder).count() == 0
    with pytest.raises(ValueError, match="already"):
        bk.create_buckets(rows(spark, []), folder, ["k"])
    with pytest.raises(ValueError, match="no table"):
        bk.read_buckets(spark, str(tmp_path / "none"))
    with pytest.raises(Exception, match="several new rows"):
        bk.upsert_buckets(rows(spark, [(1, "a", 1), (1, "a", 2)]), folder)
    bk.upsert_buckets(rows(spark, [(1, "a", 1), (1, "b", 2), (2, "c", 3)]), folder, ["v"])
    bk.upsert_buckets(spark.createDataFrame([(2, "new")], "k long, note string"), folder)
    got = {r["k"]: (r["g"], r["v"], r["note"]) for r in bk.read_buckets(spark, folder).collect()}
    assert got == {1: ("b", 2, None), 2: (None, None, "new")}


def test_tables_take_the_parts_of_a_name(spark):
    assert table_name("a.b") == "a.b" and table_name(["", "default", "odd`name"]) == "`default`.`odd``name`"
    place = ["spark_catalog", "default", "parts_of_a_name"]
    tables.write_table(spark.range(3), place, description="it's")
    tables.upsert_table(spark.range(2, 5), place, ["id"])
    tables.append_rows(spark.range(9, 10), place)
    assert sorted(r["id"] for r in tables.read_table(spark, place).collect()) == [0, 1, 2, 3, 4, 9]
    assert "parts_of_a_name" in tables.table_location(spark, place)
    spark.sql(f"DROP TABLE {table_name(place)}")
