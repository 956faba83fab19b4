import numpy as np
import pytest
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.regression import DecisionTreeRegressor, LinearRegression
from pyspark.sql import functions as F

from driftloom.operators import scoring as sc
from driftloom.operators.models import fit_candidates, fit_least_squares
from driftloom.plans.monitoring import monitor_model
from driftloom.plans.validation import retrain_models, validate_model
from driftloom.streaming.scoring import score_stream

FEATURES = ("a", "b")


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(3)
    body = [(i, "uv"[i % 2], float(a), float(b), float(2 * a - b + 1)) for i, (a, b) in enumerate(rng.normal(size=(300, 2)))]
    body += [(900, "u", None, 1.0, 5.0), (901, "v", 1.0, None, 5.0), (901, "v", 1.0, None, 5.0), (902, None, 1.0, 1.0, None)]
    columns = "id int, g string, a double, b double, y double"
    # Columns named like those that scoring uses inside.
    return spark.createDataFrame(body, columns).withColumns({"features": F.lit("x"), "__row": F.lit(1), "rawPrediction": F.lit(2)}).repartition(4)


def kinds(rows):
    known = rows.dropna(subset=["a", "b", "y"])
    line = fit_least_squares(known, list(FEATURES), "y")
    return {
        "table": sc.LinearTable(line, FEATURES),
        "spark": sc.spark_candidate(LinearRegression(solver="normal"))(rows, list(FEATURES), "y"),
        "python": sc.PythonModel(
            lambda: np.array([2.0, -1.0]), lambda w, batch: np.column_stack([batch.column(c).to_numpy() for c in FEATURES]) @ w + 1, FEATURES
        ),
    }


def test_all_kinds_give_one_shape(spark, rows):
    for name, model in kinds(rows).items():
        assert isinstance(model, sc.Model)
        scored = model.score(rows, "out")
        assert scored.columns == [*rows.columns, "out"] and scored.schema["out"].dataType.typeName() == "double"
        got = scored.collect()
        assert len(got) == rows.count(), name
        for r in got:
            want = None if r["a"] is None or r["b"] is None else 2 * r["a"] - r["b"] + 1
            assert r["out"] == (want if want is None else pytest.approx(want, abs=1e-6)), name
            assert (r["features"], r["__row"], r["rawPrediction"]) == ("x", 1, 2)
        assert model.score(rows.limit(0)).count() == 0


def test_trees_and_classes(spark, rows):
    tree = sc.spark_candidate(DecisionTreeRegressor(maxDepth=2))(rows, list(FEATURES), "y")
    assert tree.score(rows).filter("prediction IS NULL").count() == 3
    flagged = rows.withColumn("positive", F.col("y") > 1)
    classes = sc.spark_candidate(DecisionTreeClassifier(maxDepth=6))(flagged.withColumn("positive", F.col("positive").cast("int")), list(FEATURES), "positive")
    assert classes.score(rows).dropna(subset=["y", "prediction"]).filter((F.col("prediction") == 1) == (F.col("y") > 1)).count() > 285
    words = sc.PythonModel(lambda: None, lambda _, batch: ["high" if v > 0 else "low" for v in batch.column("a").to_pylist()], ("a",), "string")
    assert {r["prediction"] for r in words.score(rows).collect()} == {"high", "low", None}


def test_models_are_told_apart_and_checked(spark, rows):
    with pytest.raises(TypeError, match="cannot score"):
        sc.as_model(object(), FEATURES)
    short = sc.PythonModel(lambda: None, lambda _, batch: [1.0], FEATURES)
    with pytest.raises(Exception, match="predictions for"):
        short.score(rows).collect()
    one, other = (sc.PythonModel(lambda v=v: v, lambda m, batch: [m] * batch.num_rows, ("a",)) for v in (1.0, 2.0))
    both = other.score(one.score(rows, "one"), "other").dropna(subset=["one"])
    assert {(r["one"], r["other"]) for r in both.collect()} == {(1.0, 2.0)}


def test_a_python_model_is_loaded_once_in_a_worker():
    calls = []
    load = lambda: calls.append(1) or "m"
    assert [sc.loaded("t", load) for _ in range(3)] == ["m"] * 3 and len(calls) == 1
    assert sc.loaded("other", lambda: "n") == "n"


def test_every_kind_goes_through_training_validation_and_monitoring(spark, rows):
    known = rows.dropna(subset=["a", "b", "y"]).withColumn("split", F.when(F.col("id") < 240, "train").otherwise("test"))
    train, test = known.filter("split = 'train'"), known.filter("split = 'test'")
    models = kinds(rows)
    fitted, results = fit_candidates(known, {n: (lambda *_, m=m: m) for n, m in models.items()}, list(FEATURES), "y", ["g"])
    assert set(fitted) == set(models) and results.filter("status <> 'ok'").count() == 0
    assert results.filter("metric = 'val_rmse' AND value > 1e-6").count() == 0
    for model in models.values():
        verdicts = validate_model(test, model, "y", FEATURES, ["g"], train=train, thresholds={"r2": 0.9}).collect()
        assert {(r["g"], r["validation_passed"]) for r in verdicts} == {("u", True), ("v", True)}
        report = monitor_model(known, model, FEATURES, F.lit(True), F.col("id") >= 150, ["g"], label="y").collect()
        assert {r["g"] for r in report} == {"u", "v"}
    poor = sc.PythonModel(lambda: 0.0, lambda m, batch: [m] * batch.num_rows, FEATURES)
    decided = retrain_models(test, poor, models["spark"], "y", train, ["g"], thresholds={"r2": 0.9}).collect()
    assert {r["decision"] for r in decided} == {"promote"}
    against = validate_model(test, poor, "y", FEATURES, ["g"], previous=models["table"], train=train, thresholds={"r2": -9.0}).collect()
    assert {(r["baseline_source"], r["baseline_passed"]) for r in against} == {("previous_model", False)}


def test_streams_equal_batches_for_every_kind(spark, rows, tmp_path):
    plain = rows.select("id", "g", "a", "b", "y")
    plain.write.parquet(str(tmp_path / "in"))
    for name, model in kinds(rows).items():
        stream = spark.readStream.schema(plain.schema).parquet(str(tmp_path / "in"))
        score_stream(stream, model, FEATURES, str(tmp_path / f"out-{name}"), str(tmp_path / f"check-{name}")).awaitTermination()
        got, want = (sorted(map(str, df.select("id", F.round("prediction", 6)).collect())) for df in (spark.read.parquet(str(tmp_path / f"out-{name}")), model.score(plain)))
        assert got == want
