"""Scoring with any model: one contract for coefficient tables, Spark's own models and Python ones.

A model is anything with `features` and `score(df, name)`; scoring returns the frame's rows and
columns and one more, the prediction. All kinds agree on the edges: no row is lost, and a row
with a null feature has a null prediction. They work on batch and streaming frames alike.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field
from typing import Any, Protocol, runtime_checkable

import pyarrow as pa
from pyspark.ml import Transformer
from pyspark.ml.base import Estimator
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftloom.functions.attach import attach


@runtime_checkable
class Model(Protocol):
    """What training returns and validation, monitoring and streaming take."""

    features: Sequence[str]

    def score(self, df: DataFrame, name: str = "prediction") -> DataFrame: ...


def coef(feature: str) -> str:
    return f"coef_{feature}"


def score_linear(
    df: DataFrame, coefficients: DataFrame, features: Sequence[str], group_cols: Sequence[str] = (), name: str = "prediction"
) -> DataFrame:
    """Predictions as one native expression: intercept plus the weighted features."""
    table = coefficients.select(*group_cols, F.col("intercept").alias("__b"), *[F.col(coef(c)).alias(f"__w_{c}") for c in features])
    joined = attach(df, table, group_cols)
    total = F.col("__b")
    for c in features:
        total = total + F.col(f"__w_{c}") * F.col(c).cast("double")
    return joined.select(*df.columns, total.alias(name))


def _whole(features: Sequence[str]) -> Column:
    """Whether a row has all of the features."""
    held = F.lit(True)
    for c in features:
        held = held & F.col(c).isNotNull()
    return held


@dataclass(frozen=True)
class LinearTable:
    """Coefficients per group as a table, scored in the JVM; a group without coefficients has null predictions."""

    coefficients: DataFrame
    features: Sequence[str]
    group_cols: Sequence[str] = ()

    def score(self, df: DataFrame, name: str = "prediction") -> DataFrame:
        return score_linear(df, self.coefficients, self.features, self.group_cols, name)


@dataclass(frozen=True)
class SparkModel:
    """A fitted `spark.ml` model or pipeline that reads a vector column; its prediction column is taken over.

    Null features are put in as 0 and the row's prediction made null afterwards, so the model's
    own handling of invalid rows never drops one. `output` may name another of its columns.
    """

    transformer: Transformer
    features: Sequence[str]
    vector_col: str = "features"
    output: str = "prediction"

    def score(self, df: DataFrame, name: str = "prediction") -> DataFrame:
        hidden = {c: f"__own_{i}" for i, c in enumerate(df.columns)}
        filled = [F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in self.features]
        posed = df.select(
            F.struct(*[F.col(c).alias(hidden[c]) for c in df.columns]).alias("__row"),
            _whole(self.features).alias("__whole"),
            array_to_vector(F.array(*filled)).alias(self.vector_col),
        )
        answered = self.transformer.transform(posed)
        return answered.select(
            *[F.col("__row")[hidden[c]].alias(c) for c in df.columns], F.when(F.col("__whole"), F.col(self.output)).alias(name)
        )


_LOADED: dict[str, Any] = {}


def loaded(token: str, load: Callable[[], Any]) -> Any:
    """What `load` gives, called once in each Python worker: the next batches and tasks there find it again."""
    if token not in _LOADED:
        _LOADED.clear()  # one model at a time: a worker does not gather all it ever scored with
        _LOADED[token] = load()
    return _LOADED[token]


@dataclass(frozen=True)
class PythonModel:
    """Any Python model: `load` brings it to a worker, `predict(model, batch)` gives an array for an Arrow batch of the features.

    The batch has the features as columns, without the rows that lack one; the array must have a
    value for every row of it. `kind` is the prediction's type. `load` should read the model from
    where all workers can, since what it captures itself is sent with every task.
    """

    load: Callable[[], Any]
    predict: Callable[[Any, pa.RecordBatch], Any]
    features: Sequence[str]
    kind: str = "double"
    token: str = field(default_factory=lambda: uuid.uuid4().hex)

    def score(self, df: DataFrame, name: str = "prediction") -> DataFrame:
        load, predict, features, token = self.load, self.predict, list(self.features), self.token
        shape = T._parse_datatype_string(self.kind)
        arrow = {"double": pa.float64(), "float": pa.float32(), "string": pa.string()}.get(shape.typeName(), pa.int64())
        kept = list(df.columns)

        def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                whole = batch.column("__whole")
                asked = batch.select(features).filter(whole)
                answer = predict(loaded(token, load), asked) if asked.num_rows else []
                given = pa.array(answer, arrow)
                if len(given) != asked.num_rows:
                    raise ValueError(f"the model gave {len(given)} predictions for {asked.num_rows} rows")
                # Rows without a whole set of features point nowhere, which take() turns into null.
                place = pa.compute.cumulative_sum(whole.cast(pa.int64()))
                place = pa.compute.if_else(whole, pa.compute.subtract(place, 1), pa.scalar(None, pa.int64()))
                yield pa.record_batch([*batch.select(kept).columns, given.take(place)], names=[*kept, name])

        marked = df.withColumn("__whole", _whole(features))
        schema = T.StructType([*df.schema.fields, T.StructField(name, shape)])
        return marked.mapInArrow(score, schema)


def as_model(fitted: Model | DataFrame, features: Sequence[str], group_cols: Sequence[str] = ()) -> Model:
    """A model as it is; a coefficient table as a `LinearTable`; a fitted `spark.ml` transformer as a `SparkModel`."""
    if isinstance(fitted, DataFrame):
        return LinearTable(fitted, tuple(features), tuple(group_cols))
    if isinstance(fitted, Transformer):
        return SparkModel(fitted, tuple(features))
    if not isinstance(fitted, Model):
        raise TypeError(f"{type(fitted).__name__} cannot score: it has no features and score()")
    return fitted


def spark_candidate(estimator: Estimator) -> Callable[..., SparkModel]:
    """A candidate for training that fits any `spark.ml` estimator to the features, one model for all segments.

    Rows without a label or with a null feature are left out of the fit. The estimator's vector
    and label columns are used, whatever they are called.
    """

    def fit(df: DataFrame, features: Sequence[str], label: str, group_cols: Sequence[str] = ()) -> SparkModel:
        vector, target = estimator.getOrDefault("featuresCol"), estimator.getOrDefault("labelCol")
        # One array, not a column each: the optimizer's constraints on many renamed columns multiply.
        typed = df.select(F.array(*[F.col(c).cast("double") for c in features]).alias("__x"), F.col(label).cast("double").alias(target))
        whole = typed.filter(F.col(target).isNotNull() & ~F.exists("__x", lambda v: v.isNull()))
        posed = whole.select(array_to_vector("__x").alias(vector), target)
        return SparkModel(estimator.fit(posed), tuple(features), vector, estimator.getOrDefault("predictionCol"))

    return fit
