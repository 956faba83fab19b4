import random
from collections import defaultdict
from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from conftest import by
from pyspark.sql import Window
from pyspark.sql import functions as F

from driftloom.operators.ordering import Cells, number_rows
from driftloom.operators.scaling import scaler_fit, standardise
from driftloom.operators.splits import except_rows, hash_split, random_split, temporal_split


def orders(spark, small):
    return spark.read.parquet(f"{small}/orders.parquet").select("o_orderkey", "o_orderdate", "o_orderpriority")


@pytest.mark.parametrize("share", [0.0, 0.5, 0.8, 1.0])
def test_temporal_split_takes_exactly_the_first_rows(spark, small, share):
    marked = temporal_split(orders(spark, small).repartition(5), ["o_orderdate", "o_orderkey"], share, ["o_orderpriority"])
    groups = defaultdict(list)
    for r in marked.collect():
        groups[r.o_orderpriority].append(((r.o_orderdate, r.o_orderkey), r.split))
    assert sum(map(len, groups.values())) == orders(spark, small).count()
    for rows in groups.values():
        rows.sort()
        taken = int(len(rows) * share)
        assert [s for _, s in rows] == ["train"] * taken + ["test"] * (len(rows) - taken)


def test_temporal_split_with_one_hot_group_and_dates(spark):
    rows = [("hot", date(2024, 1, 1) + timedelta(days=i % 50), i) for i in range(1000)] + [("cold", date(2024, 1, 1), 0), (None, date(2024, 1, 1), 0)]
    marked = temporal_split(spark.createDataFrame(rows, "g string, d date, id int"), ["d", "id"], 0.8, ["g"])
    counts = {(r.g, r.split): r["count"] for r in marked.groupBy("g", "split").count().collect()}
    assert counts == {("hot", "train"): 800, ("hot", "test"): 200, ("cold", "test"): 1, (None, "test"): 1}


def test_rows_are_not_shuffled_for_a_temporal_split(spark, small):
    marked = temporal_split(orders(spark, small), ["o_orderdate", "o_orderkey"], 0.8, ["o_orderpriority"])
    plan = marked._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan


def test_hash_split_does_not_depend_on_layout(spark, small):
    rows = orders(spark, small).select("o_orderkey")
    one, other = (sorted(hash_split(rows.repartition(n), ["o_orderkey"]).collect()) for n in (1, 7))
    assert one == other
    share = sum(r.split == "train" for r in one) / len(one)
    assert 0.75 < share < 0.85
    text = hash_split(orders(spark, small), ["o_orderpriority", "o_orderkey"])
    assert {r.split for r in text.select("split").distinct().collect()} == {"train", "test"}


def test_random_split_covers_all_rows(spark, small):
    train, test = random_split(orders(spark, small))
    assert train.count() + test.count() == orders(spark, small).count()


def test_except_rows(spark):
    df = spark.createDataFrame([(1,), (1,), (2,), (3,), (None,)], "a int")
    other = spark.createDataFrame([(1,), (3,)], "a int")
    assert sorted(str(r.a) for r in except_rows(df, other).collect()) == ["2", "None"]
    assert sorted(str(r.a) for r in except_rows(df, other, keep_duplicates=True).collect()) == ["1", "2", "None"]


def test_row_numbers_match_a_window(spark, small):
    events = spark.read.parquet(f"{small}/events.parquet")
    everyone = by(number_rows(events, ["ts", "event_id"]), "event_id")
    assert sorted(r["row_number"] for r in everyone) == list(range(1, len(everyone) + 1))
    ordered = sorted(everyone, key=lambda r: (r["ts"], r["event_id"]))
    assert [r["row_number"] for r in ordered] == list(range(1, len(everyone) + 1))
    by_text = sorted(by(number_rows(events, ["props", "event_id"]), "event_id"), key=lambda r: r["row_number"])
    assert [(r["props"], r["event_id"]) for r in by_text] == sorted((r["props"], r["event_id"]) for r in by_text)
    with pytest.raises(TypeError, match="order"):
        number_rows(events.withColumn("m", F.create_map("props", "value")), ["m"])


KINDS = {
    "bigint": lambda r: r.choice([None, 0, 5, 5, r.randint(-(2**63), 2**63 - 1), r.randint(0, 40)]),
    "date": lambda r: r.choice([None, date(2024, 1, 1), date(2024, 1, 1) + timedelta(days=r.randint(0, 3))]),
    "timestamp_ntz": lambda r: datetime(2024, 1, 1) + timedelta(microseconds=r.choice([0, 1, r.randint(0, 10**6), r.randint(0, 10**12)])),
    "decimal(12,3)": lambda r: r.choice([None, Decimal("1.001"), Decimal(r.randint(-500, 500)) / 8]),
    "double": lambda r: r.choice([None, 0.0, -1e300, 1e-300, r.random(), r.random() * 1e6, float("inf"), float("-inf"), 1.7e9 + r.random()]),
    "string": lambda r: r.choice([None, "", "é", "same prefix that is longer than twenty-eight bytes" + r.choice("abc"), str(r.random())]),
    "boolean": lambda r: r.choice([None, True, False]),
}


@pytest.mark.parametrize("kind", sorted(KINDS))
@pytest.mark.parametrize("most", [5, 60])
def test_cells_follow_counts(spark, kind, most):
    """Row numbers and cuts equal a plain window's, however small cells must be."""
    rng = random.Random(kind)
    rows = [(rng.choice(["hot", "hot", "hot", "cold", None]), KINDS[kind](rng), i) for i in range(400)]
    df = spark.createDataFrame(rows, f"g string, k {kind}, id int").repartition(4)
    window = Window.partitionBy("g").orderBy("k", "id")
    want = sorted(map(str, df.withColumn("n", F.row_number().over(window).cast("bigint")).collect()))
    assert sorted(map(str, number_rows(df, ["k", "id"], ["g"], "n", most).collect())) == want
    total = Window.partitionBy("g")
    cut = F.when(F.row_number().over(window) <= F.floor(F.count(F.lit(1)).over(total) * 0.7), "train").otherwise("test")
    got = sorted(map(str, temporal_split(df, ["k", "id"], 0.7, ["g"], most).collect()))
    assert got == sorted(map(str, df.withColumn("split", cut).collect()))


def test_one_day_is_split_among_tasks(spark):
    """All rows share a date; the second ordering column cuts them, and no cell holds more than it may."""
    day = spark.range(20_000).select(F.lit(date(2024, 1, 1)).alias("d"), (F.col("id") * 7919 % 20_011).alias("k"))
    cells = Cells(day, ["d", "k"], (), most=500)
    sizes = cells.place(day).groupBy("__path").count()
    assert sizes.agg(F.max("count")).first()[0] <= 500 and sizes.count() >= 40
    numbered = number_rows(day, ["d", "k"], most=500)
    assert numbered.withColumn("want", F.row_number().over(Window.orderBy("d", "k"))).filter("row_number <> want").count() == 0
    marked = temporal_split(day, ["d", "k"], 0.8, most=500)
    assert marked.filter("split = 'train'").count() == 16_000


def test_tied_rows_are_numbered_by_content(spark):
    df = spark.createDataFrame([(1, i % 50) for i in range(300)], "k int, v int")
    one, other = (sorted(map(tuple, number_rows(df.repartition(n), ["k"], most=10).collect())) for n in (1, 6))
    assert one == other and [r[2] for r in sorted(one, key=lambda r: r[2])] == list(range(1, 301))
    assert number_rows(df.limit(0), ["k"], most=10).count() == 0


def test_scaler_uses_population_deviation_and_spares_constants(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (4.0, 5.0)], "a double, b double")
    scaled = by(standardise(df, scaler_fit(df, ["a", "b"]), ["a", "b"]), "a")
    deviation = (14 / 9) ** 0.5
    assert [round(r["a"], 9) for r in sorted(scaled, key=lambda r: r["a"])] == [round((v - 7 / 3) / deviation, 9) for v in (1, 2, 4)]
    assert {r["b"] for r in scaled} == {0.0}


def test_scaler_per_group(spark):
    df = spark.createDataFrame([("x", 1.0), ("x", 3.0), (None, 10.0), (None, 14.0)], "g string, a double")
    scaled = standardise(df, scaler_fit(df, ["a"], ["g"]), ["a"], ["g"])
    assert sorted(r.a for r in scaled.collect()) == [-1.0, -1.0, 1.0, 1.0]
    assert scaled.filter(F.col("g").isNull()).count() == 2
