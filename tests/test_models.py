import numpy as np
import pytest
from pyspark.sql import functions as F

from driftloom.operators import models as mo
from driftloom.operators.scaling import scaler_fit, standardise
from driftloom.plans.training import passive_aggressive_candidate, prepare_training, train_run

FEATURES = ["a", "b"]


def plane(spark, n=400, groups=("u", "v")):
    rng = np.random.default_rng(0)
    rows = []
    for k, g in enumerate(groups):
        for i in range(n):
            a, b = rng.normal(size=2)
            rows.append((g, i, float(a), float(b), float((k + 1) * a - 2 * b + 3)))
    return spark.createDataFrame(rows, "g string, id int, a double, b double, y double")


def worst(df, table, groups):
    scored = mo.score_linear(df, table, FEATURES, groups)
    return scored.agg(F.max(F.abs(F.col("y") - F.col("prediction")))).first()[0]


def test_passive_aggressive_fits_a_plane_within_epsilon(spark):
    df = plane(spark)
    table = mo.fit_passive_aggressive(df, FEATURES, "y", ["g"], ["id"], tolerance=0.0, patience=50, max_iter=300, method="sequential")
    assert worst(df, table, ["g"]) <= 0.0101
    assert {r.shards for r in table.collect()} == {1}


def test_passive_aggressive_does_not_depend_on_layout(spark):
    df = plane(spark, 60)
    fits = [
        sorted(mo.fit_passive_aggressive(df.repartition(n), FEATURES, "y", ["g"], ["id"], max_iter=20, method="sequential").collect()) for n in (1, 5)
    ]
    assert fits[0] == fits[1]


def test_large_group_is_sharded_and_small_one_is_not(spark):
    df = plane(spark, 400, ("big",)).unionByName(plane(spark, 40, ("small",)))
    table = mo.fit_passive_aggressive(df, FEATURES, "y", ["g"], ["id"], rows_per_shard=50, rounds=6)
    got = {r.g: r for r in table.collect()}
    assert got["big"].shards == 8 and got["small"].shards == 1
    for g, slope in (("big", 1.0), ("small", 1.0)):
        assert got[g].coef_a == pytest.approx(slope, abs=0.05) and got[g].coef_b == pytest.approx(-2.0, abs=0.05)
    again = mo.fit_passive_aggressive(df.repartition(3), FEATURES, "y", ["g"], ["id"], rows_per_shard=50, rounds=6)
    for row in again.collect():
        assert list(row)[1:4] == pytest.approx(list(got[row.g])[1:4], rel=1e-9)


def test_averaged_fit_is_the_same_with_and_without_broadcast(spark):
    df = plane(spark, 200)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    fits = []
    try:
        for threshold, n in ((before, 1), ("-1", 1), ("-1", 7)):
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
            table = mo.fit_passive_aggressive(df.repartition(n), FEATURES, "y", ["g"], ["id"], rows_per_shard=50, rounds=3)
            fits.append({r.g: list(r)[1:4] for r in table.collect()})
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    for other in fits[1:]:
        for g, row in fits[0].items():
            assert other[g] == pytest.approx(row, rel=1e-9)


def test_method_is_the_callers_choice(spark):
    df = plane(spark, 20, ("u",))
    with pytest.raises(ValueError, match="key_cols"):
        mo.fit_passive_aggressive(df, FEATURES, "y")
    with pytest.raises(ValueError, match="method"):
        mo.fit_passive_aggressive(df, FEATURES, "y", key_cols=["id"], method="whole")


def test_one_global_model(spark):
    df = plane(spark, 300, ("u",))
    table = mo.fit_passive_aggressive(df, FEATURES, "y", key_cols=["id"], rows_per_shard=100, rounds=5)
    assert table.count() == 1 and worst(df, table, []) < 0.2


def test_rounds_read_blocks_and_pass_every_row_in_order(spark, monkeypatch):
    """What a round reads is stored in blocks, not row by row; the fit is that of plain passes over the shards' rows in turn."""
    df = plane(spark, 900, ("u",)).withColumn("y", F.col("y") * F.when(F.col("id") % 7 == 0, 40.0).otherwise(1.0))
    stored, store = [], mo.settle_partitioned
    monkeypatch.setattr(mo, "settle_partitioned", lambda frame: stored.append(store(frame)) or stored[-1])
    monkeypatch.setattr(mo, "BLOCK_BYTES", 8 * 3 * 20, raising=False)
    for shards in (3, 12):
        table = mo.fit_passive_aggressive(df.repartition(4), FEATURES, "y", key_cols=["id"], rows_per_shard=900 // shards, rounds=3, tolerance=-1e9)
        hashed = df.select(F.pmod(F.xxhash64("id"), F.lit(shards)).alias("shard"), F.xxhash64(F.lit(mo.SEED), "id").alias("mixed"), *FEATURES, "y")
        rows = np.array([tuple(map(float, r[2:])) + (r.shard,) for r in sorted(hashed.collect(), key=lambda r: (r.shard, r.mixed))])
        weights = np.zeros(3)
        for _ in range(3):
            total = np.zeros(3)
            for shard in range(shards):
                now, own = weights.copy(), rows[rows[:, 3] == shard]
                for a, b, y, _ in own:
                    error = y - (now @ (a, b, 1.0))
                    step = min(mo.AGGRESSIVENESS, max(0.0, abs(error) - mo.EPSILON) / (a * a + b * b + 1.0))
                    now += np.copysign(step, error) * np.array((a, b, 1.0))
                total += len(own) * now
            weights = total / len(rows)
        got = table.first()
        assert [got.coef_a, got.coef_b, got.intercept] == pytest.approx(weights.tolist(), rel=1e-9) and got.shards == shards
    assert all(frame.count() < 900 / 8 for frame in stored)


def test_blocks_abreast_are_passed_like_one_by_one():
    rng = np.random.default_rng(3)
    blocks = [rng.normal(size=(n, 3)) * (1, 1, 50 if n % 2 else 1) for n in (40, 3, 25, 41, 90, 1, 33, 12, 60, 8, 27)]
    blocks[2][4, 0] = np.inf
    for some in (blocks, [x for x in blocks if np.isfinite(x).all()], blocks[3:6]):
        w, b = rng.normal(size=(len(some), 2)), rng.normal(size=len(some))
        one = [(own := w[i].copy(), *mo.passive_aggressive_pass(x[:, :-1], x[:, -1], own, float(b[i]), np.arange(len(x)), 0.9, 0.01)) for i, x in enumerate(some)]
        lost = mo.passes_abreast(some, w, b, 0.9, 0.01)
        for i, (own, intercept, loss) in enumerate(one):
            assert [*w[i], b[i], lost[i]] == pytest.approx([*own, intercept, loss], rel=1e-9, nan_ok=True)


def test_pass_moves_no_further_than_allowed():
    w = np.zeros(1)
    b, lost = mo.passive_aggressive_pass(np.array([[1.0]]), np.array([100.0]), w, 0.0, np.array([0]), 0.9, 0.01)
    assert (w[0], b, lost) == (0.9, 0.9, pytest.approx(99.99))
    b, lost = mo.passive_aggressive_pass(np.array([[0.0]]), np.array([5.0]), w, 0.0, np.array([0]), 0.9, 0.01)
    assert (w[0], b) == (0.9, 0.9)
    b, lost = mo.passive_aggressive_pass(np.array([[0.1]]), np.array([1.5]), w, b, np.array([0]), 0.9, 0.01)
    assert abs(1.5 - (0.1 * w[0] + b)) <= 0.0100001


def test_least_squares_and_single_feature(spark):
    df = plane(spark, 100, ("u",))
    table = mo.fit_least_squares(df, FEATURES, "y")
    assert list(table.first()) == pytest.approx([3.0, 1.0, -2.0])
    line = spark.createDataFrame([("x", 1.0, 5.0), ("x", 2.0, 7.0), ("z", 1.0, 1.0), ("z", 3.0, 1.0)], "g string, a double, y double")
    got = {r.g: (r.intercept, r.coef_a) for r in mo.fit_single_feature(line, ["a"], "y", ["g"]).collect()}
    assert got["x"] == pytest.approx((3.0, 2.0)) and got["z"] == pytest.approx((1.0, 0.0))


def test_folded_scaler_scores_raw_rows_alike(spark):
    df = plane(spark, 50, ("u", "v")).withColumn("a", F.col("a") * 100 + 7)
    scaler = scaler_fit(df, FEATURES, ["g"])
    scaled = standardise(df, scaler, FEATURES, ["g"])
    table = mo.fit_passive_aggressive(scaled, FEATURES, "y", ["g"], ["id"], max_iter=30, method="sequential")
    inside = mo.score_linear(scaled, table, FEATURES, ["g"]).select("g", "id", F.round("prediction", 6))
    outside = mo.score_linear(df, mo.fold_scaler(table, scaler, FEATURES, ["g"]), FEATURES, ["g"]).select("g", "id", F.round("prediction", 6))
    assert sorted(inside.collect()) == sorted(outside.collect())


def test_scoring_stays_in_the_jvm_and_does_not_shuffle_rows(spark, small):
    lines = spark.read.parquet(f"{small}/lineitem.parquet")
    table = mo.fit_single_feature(lines, ["l_quantity"], "l_extendedprice", ["l_returnflag"])
    plan = mo.score_linear(lines, table, ["l_quantity"], ["l_returnflag"])._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "BroadcastHashJoin" in plan and "hashpartitioning" not in plan


def test_failing_candidate_does_not_stop_the_rest(spark):
    df = plane(spark, 60, ("u",)).withColumn("split", F.when(F.col("id") < 48, "train").otherwise("test"))

    def broken(*_):
        raise RuntimeError("no luck")

    fitted, results = mo.fit_candidates(df, {"broken": broken, "ols": mo.fit_least_squares}, FEATURES, "y")
    assert list(fitted) == ["ols"]
    rows = results.collect()
    assert [(r.status, r.error) for r in rows if r.candidate == "broken"] == [("failed", "no luck")]
    metrics = {r.metric: r.value for r in rows if r.candidate == "ols"}
    assert set(metrics) == {f"{s}_{m}" for s in ("train", "val") for m in ("mse", "mae", "rmse", "r2")}
    assert metrics["val_r2"] == pytest.approx(1.0)


def test_training_run_on_features(spark, small):
    orders = spark.read.parquet(f"{small}/orders.parquet").select(F.col("o_orderdate").alias("data"), F.col("o_totalprice").alias("v"))
    prepared = prepare_training(orders, ["v"])
    assert prepared.filter("split = 'train'").count() == int(prepared.count() * 0.8)
    fitted, results = train_run(prepared, "v_mes", {"pa": passive_aggressive_candidate(max_iter=20)})
    assert results.filter("status = 'ok'").count() == 8 and "coef_v_semana" in fitted["pa"].columns


def test_grouped_least_squares_defines_every_rank(spark):
    rng = np.random.default_rng(2)
    rows = [("plane", float(a), float(b), float(1e6 + 5 * a - b)) for a, b in rng.normal(size=(200, 2))]
    rows += [("twins", float(a), float(2 * a + 1), float(3 * a)) for a in rng.normal(size=50)]
    rows += [("still", 4.0, float(b), float(7 - b)) for b in rng.normal(size=50)] + [("one", 1.0, 2.0, 3.0), ("flat", 1.0, 1.0, 5.0), ("flat", 2.0, 3.0, 5.0)]
    rows += [("plane", None, 1.0, 1.0), ("plane", 1.0, float("nan"), 1.0), ("none", None, 1.0, 1.0), (None, 1.0, 0.0, 2.0), (None, 2.0, 1.0, 3.0)]
    df = spark.createDataFrame(rows, "g string, a double, b double, y double").repartition(5)
    got = {r["g"]: r for r in mo.least_squares_table(df, FEATURES, "y", ["g"]).collect()}
    assert set(got) == {"plane", "twins", "still", "one", "flat", None}
    assert list(got["plane"])[1:4] == pytest.approx([1e6, 5.0, -1.0]) and got["plane"]["rank"] == 2 and got["plane"]["n_rows"] == 200
    t = got["twins"]  # y = 3a, shared by a and b = 2a + 1 on equal standardised terms
    assert (t["coef_a"], t["coef_b"], t["rank"]) == (pytest.approx(1.5), pytest.approx(0.75), 1) and t["intercept"] == pytest.approx(-0.75)
    assert got["still"]["coef_a"] == 0 and got["still"]["coef_b"] == pytest.approx(-1.0) and got["still"]["rank"] == 1
    assert list(got["one"])[1:4] == [3.0, 0.0, 0.0] and got["one"]["rank"] == 0 and got["one"]["fit_r2"] is None
    assert got["flat"]["intercept"] == pytest.approx(5.0) and got["flat"]["fit_r2"] is None
    assert mo.least_squares_table(df.limit(0), FEATURES, "y", ["g"]).count() == 0
    wide = [f"x{i}" for i in range(24)]
    x = rng.normal(size=(300, 24))
    many = spark.createDataFrame([(*map(float, v), float(v @ np.arange(24) + 2)) for v in x], ", ".join(f"{c} double" for c in wide) + ", y double")
    assert list(mo.fit_least_squares(many, wide, "y").first()) == pytest.approx([2.0, *range(24)], abs=1e-8)


def test_a_segment_that_fails_leaves_the_others(spark):
    df = plane(spark, 60, ("u", "v", "w")).withColumn("split", F.when(F.col("id") < 48, "train").otherwise("test"))
    df = df.filter("NOT (g = 'w' AND split = 'train')")  # nothing to train on

    def breaks_v(rows, features, label, groups=()):
        return mo.fit_least_squares(rows, features, label, groups).withColumn("intercept", F.when(F.col("g") != "v", F.col("intercept")).otherwise(float("nan")))

    def broken(*_):
        raise RuntimeError("no luck")

    fitted, results = mo.fit_candidates(df, {"broken": broken, "nan": breaks_v, "ols": mo.fit_least_squares}, FEATURES, "y", ["g"])
    assert set(fitted) == {"nan", "ols"}
    status = {(r["candidate"], r["g"]): (r["status"], r["error"]) for r in results.collect()}
    assert {g: status[("broken", g)] for g in "uvw"} == {g: ("failed", "no luck") for g in "uvw"}
    assert status[("nan", "u")] == ("ok", None) and status[("nan", "v")][0] == "failed" and status[("ols", "w")][0] == "failed"
    best = {r["g"]: (r["best"], r["n_ok"], r["n_failed"]) for r in mo.best_candidates(results, ["g"]).collect()}
    assert best["v"] == ("ols", 1, 2) and best["w"] == (None, 0, 3) and best["u"][1:] == (2, 1)
