"""Linear models fitted by Spark jobs and kept as tables of coefficients.

A coefficient table has one row per group (one row in all without groups) with `intercept` and
one `coef_<feature>` column per feature. Every fit returns a settled table.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from math import copysign, sumprod

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftloom.functions.attach import attach
from driftloom.operators.metrics import TRAINING_METRICS, regression_metrics
from driftloom.operators.sketches import clean_double
from driftloom.operators.scoring import Model, as_model, coef, score_linear
from driftloom.operators.scaling import scaler_fit, standardise
from driftloom.sources.scratch import settle, settle_partitioned

# Settings of the passive-aggressive regressor.
AGGRESSIVENESS = 0.9
EPSILON = 0.01
MAX_ITER = 8000
SEED = 882
TOLERANCE = 1e-3
PATIENCE = 5

# How small a direction counts as none, and the numbers a task holds before it passes its sums on.
RANK_TOLERANCE = 1e-10
HELD_SUMS = 1 << 22
# The bytes of a block of training rows; a block is one row to Spark.
BLOCK_BYTES = 1 << 16
# Blocks of different shards that are passed over side by side: fewer are passed over one by one, more in turns.
FEWEST_ABREAST = 8
MOST_ABREAST = 256

Fit = Callable[[DataFrame, Sequence[str], str, Sequence[str]], "DataFrame | Model"]

__all__ = ["coef", "score_linear"]  # kept here for their callers


def fold_scaler(coefficients: DataFrame, scaler: DataFrame, features: Sequence[str], group_cols: Sequence[str] = ()) -> DataFrame:
    """Coefficients fitted on standardised features, rewritten for the raw ones.

    The scaler then is part of the model and cannot be applied twice or forgotten.
    """
    joined = attach(coefficients, scaler, group_cols)

    def slope(c: str):
        std = F.when(F.col(f"{c}__std") == 0, F.lit(1.0)).otherwise(F.col(f"{c}__std"))
        return F.col(coef(c)) / std

    shift = F.col("intercept")
    for c in features:
        shift = shift - slope(c) * F.col(f"{c}__mean")
    replaced = {coef(c): slope(c) for c in features} | {"intercept": shift}
    return settle(joined.select(*[replaced.get(c, F.col(c)).alias(c) for c in coefficients.columns]))


def fit_single_feature(df: DataFrame, features: Sequence[str], label: str, group_cols: Sequence[str] = ()) -> DataFrame:
    """Least squares on one feature, per group, from built-in aggregates; also gives r2."""
    (feature,) = features
    y, x = F.col(label).cast("double"), F.col(feature).cast("double")
    return settle(
        df.groupBy(*group_cols).agg(
            F.regr_intercept(y, x).alias("intercept"), F.regr_slope(y, x).alias(coef(feature)), F.regr_r2(y, x).alias("fit_r2")
        )
    )


def least_squares_table(df: DataFrame, features: Sequence[str], label: str, group_cols: Sequence[str] = ()) -> DataFrame:
    """Least squares on many features, per group: coefficients, `n_rows`, `rank` and `fit_r2`.

    A first pass finds each group's means. In a second every task sums the products of the
    distances from them, as an array per group, and the arrays are added up, so a group's rows
    never meet in a task and no digits are lost to large values. Each group's normal equations
    are then solved from its one row. Rows with a null or NaN in a feature or the label are left
    out.

    Where features depend on each other, the solution of least norm on the standardised features
    is taken: twins share a slope, a constant feature has slope 0. `rank` counts the directions
    that were fitted. A group without rows gives no row.
    """
    features, keys = list(features), list(group_cols)
    columns, size = [*features, label], len(features)
    # One array, not a column each: the optimizer's constraints on many renamed columns multiply.
    typed = df.select(*keys, F.array(*[clean_double(F.col(c)) for c in columns]).alias("__row"))
    clean = typed.filter(~F.exists("__row", lambda v: v.isNull()))
    # One row per group with a number that stands for its keys; fixed once it is written.
    means = clean.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"), F.array(*[F.avg(F.get("__row", F.lit(i))) for i in range(size + 1)]).alias("__means"))
    groups = settle(means.filter("n_rows > 0").withColumn("__group", F.monotonically_increasing_id()))
    upper = np.triu_indices(size + 1)

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            group = batch.column("__group").to_numpy()
            centre = batch.column("__means").flatten().to_numpy().reshape(-1, size + 1)
            apart = batch.column("__row").flatten().to_numpy().reshape(-1, size + 1) - centre
            order = np.argsort(group, kind="stable")
            cut = np.flatnonzero(np.diff(group[order])) + 1
            for some in np.split(order, cut):
                total = (apart[some].T @ apart[some])[upper]
                held[int(group[some[0]])] = held.get(int(group[some[0]]), 0.0) + total
            if len(held) * len(upper[0]) > HELD_SUMS:
                yield pack(held)
                held = {}
        if held:
            yield pack(held)

    def pack(held: dict[int, np.ndarray]) -> pa.RecordBatch:
        listed = pa.array(list(held.values()), pa.list_(pa.float64()))
        return pa.record_batch([pa.array(list(held), pa.int64()), listed], names=["__group", "__sums"])

    rows = attach(clean, groups.select(*keys, "__group", "__means"), keys).select("__group", "__means", "__row")
    parts = rows.mapInArrow(products, "__group long, __sums array<double>")
    merged = parts.select("__group", F.posexplode("__sums").alias("__at", "__sum")).groupBy("__group", "__at").agg(F.sum("__sum").alias("__sum"))
    listed = merged.groupBy("__group").agg(F.sort_array(F.collect_list(F.struct("__at", "__sum"))).alias("__sums"))
    posed = attach(groups, listed.select("__group", F.col("__sums.__sum").alias("__sums")), ["__group"])
    names = ["intercept", *[coef(c) for c in features]]
    tail = [T.StructField(n, T.DoubleType()) for n in (*names, "fit_r2")] + [T.StructField("rank", T.LongType())]
    schema = T.StructType([*[df.schema[k] for k in keys], T.StructField("n_rows", T.LongType()), *tail])

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for n, centre, sums in zip(*(batch.column(c).to_pylist() for c in ("n_rows", "__means", "__sums"))):
                full = np.zeros((size + 1, size + 1))
                full[upper] = np.array(sums) / n
                found.append(solve_normal(np.array(centre), full + np.triu(full, 1).T))
            rows = [pa.array([f[i] for f in found], pa.float64()) for i in range(size + 2)]
            rank = pa.array([f[-1] for f in found], pa.int64())
            yield pa.record_batch([*batch.select([*keys, "n_rows"]).columns, *rows, rank], names=schema.names)

    solved = posed.select(*keys, "n_rows", "__means", "__sums").mapInArrow(solve, schema)
    return settle(solved).select(*keys, *names, "n_rows", "rank", "fit_r2")


def solve_normal(means: np.ndarray, spreads: np.ndarray) -> tuple[float, ...]:
    """Intercept, slopes, r2 (None for a constant label) and rank from means and covariances, the label's last."""
    size = len(means) - 1
    scale = np.sqrt(np.maximum(np.diag(spreads), 0.0))
    # A feature whose deviation is lost in the rounding of its mean is constant.
    live = scale[:size] > 1e-12 * np.maximum(1e-300, np.abs(means[:size]))
    unit = np.where(live, scale[:size], 1.0)
    inner = np.where(np.outer(live, live), spreads[:size, :size] / np.outer(unit, unit), 0.0)
    aim = np.where(live, spreads[:size, size] / unit, 0.0)
    values, vectors = np.linalg.eigh(inner) if size else (np.zeros(0), np.zeros((0, 0)))
    good = values > RANK_TOLERANCE * max(1.0, size)
    slopes = vectors[:, good] @ ((vectors[:, good].T @ aim) / values[good]) / unit
    spread = spreads[size, size]
    r2 = float(np.clip(slopes @ spreads[:size, size] / spread, 0.0, 1.0)) if spread > 0 else None
    return (float(means[size] - slopes @ means[:size]), *map(float, slopes), r2, int(good.sum()))


def fit_least_squares(df: DataFrame, features: Sequence[str], label: str, group_cols: Sequence[str] = ()) -> DataFrame:
    """Least squares on many features, per group or over the whole frame; see `least_squares_table`."""
    table = least_squares_table(df, features, label, group_cols)
    return table.select(*group_cols, "intercept", *[coef(c) for c in features])


def passive_aggressive_pass(
    x: np.ndarray, y: np.ndarray, w: np.ndarray, b: float, order: np.ndarray, aggressiveness: float, epsilon: float
) -> tuple[float, float]:
    """One online pass over the rows in the given order; changes `w`, returns (intercept, summed loss).

    A row within epsilon of its prediction changes nothing; otherwise the weights move just far
    enough to fit it, by at most `aggressiveness` (PA-I, Crammer et al. 2006). The intercept is
    the weight of a constant feature, so a step never overshoots the row it is made for.
    """
    squared = np.einsum("ij,ij->i", x, x) + 1.0
    lost, now = 0.0, w.tolist()
    # On a few numbers at a time Python's own are several times faster than arrays.
    for row, target, square in zip(x[order].tolist(), y[order].tolist(), squared[order].tolist()):
        error = target - (sumprod(row, now) + b)
        loss = abs(error) - epsilon
        if loss > 0:
            lost += loss
            step = copysign(min(aggressiveness, loss / square), error)
            now = [v + step * c for v, c in zip(now, row)]
            b += step
    w[:] = now
    return b, lost


def passes_abreast(blocks: Sequence[np.ndarray], w: np.ndarray, b: np.ndarray, aggressiveness: float, epsilon: float) -> np.ndarray:
    """`passive_aggressive_pass` over each of several blocks (label last, a row of `w` and of `b` each); changes both, returns summed losses.

    The blocks' rows at one place are taken together, as long as enough blocks have one; what is
    left of the longest blocks, and any with numbers too large to square, is passed over block by block.
    """
    size, lengths = w.shape[1], np.array([len(x) for x in blocks])
    order = np.argsort(-lengths, kind="stable")
    lost, done = np.zeros(len(blocks)), 0
    if len(blocks) >= FEWEST_ABREAST:
        done = int(lengths[order[FEWEST_ABREAST - 1]])
        x = np.zeros((done, len(blocks), size + 1))
        for k, i in enumerate(order.tolist()):
            x[: lengths[i], k] = blocks[i][:done]
        y, x[..., -1] = x[..., -1].copy(), 1.0
        squared = np.einsum("ijk,ijk->ij", x, x)
        both = np.column_stack([w, b])[order]
        if np.isfinite(squared).all() and np.isfinite(both).all() and np.isfinite(y).all():
            active = np.searchsorted(-lengths[order], -np.arange(done), "left").tolist()
            losses = np.zeros((done, len(blocks)))
            for i, n in enumerate(active):
                row, now, loss = x[i, :n], both[:n], losses[i, :n]
                error = y[i, :n] - np.einsum("ij,ij->i", row, now)
                np.subtract(np.abs(error), epsilon, out=loss)
                np.maximum(loss, 0.0, out=loss)
                step = np.minimum(aggressiveness, loss / squared[i, :n])
                now += np.copysign(step, error)[:, None] * row
            w[order], b[order], lost[order] = both[:, :-1], both[:, -1], losses.sum(axis=0)
        else:
            done = 0
    for i in np.flatnonzero(lengths > done).tolist():
        x, y = blocks[i][done:, :-1], blocks[i][done:, -1]
        b[i], more = passive_aggressive_pass(x, y, w[i], float(b[i]), np.arange(len(y)), aggressiveness, epsilon)
        lost[i] += more
    return lost


def fit_passive_aggressive(
    df: DataFrame,
    features: Sequence[str],
    label: str,
    group_cols: Sequence[str] = (),
    key_cols: Sequence[str] = (),
    aggressiveness: float = AGGRESSIVENESS,
    epsilon: float = EPSILON,
    max_iter: int = MAX_ITER,
    seed: int = SEED,
    tolerance: float = TOLERANCE,
    patience: int = PATIENCE,
    rows_per_shard: int = 50_000,
    rounds: int = 10,
    method: str = "averaged",
) -> DataFrame:
    """Passive-aggressive regression per group, by one of two methods, each the same at every group size.

    `"averaged"` cuts every group into shards of about `rows_per_shard` rows by the hash of
    `key_cols`, which must tell a group's rows apart: every round each shard makes one pass from
    the group's current weights, streaming its rows, and the shards' weights are averaged by
    size (iterative parameter mixing, McDonald et al. 2010), until no group's mean loss falls by
    `tolerance` or `rounds` have been made. The rows are shuffled and sorted once and stored in
    blocks, so that a round costs Spark little more than reading them. `"sequential"` makes up to `max_iter` passes over a
    whole group in one task, until `patience` of them bring nothing; it is for groups known to
    be small, such as weekly series. `shards` in the result is 1 there. Rows are ordered by
    `key_cols` before a seeded shuffle, so the result does not depend on the data's layout.
    """
    if method not in ("averaged", "sequential"):
        raise ValueError(f"method must be 'averaged' or 'sequential', not {method!r}")
    if method == "averaged" and not key_cols:
        raise ValueError("the averaged method needs key_cols that tell the rows of a group apart")
    keys, by = list(group_cols), list(key_cols) or list(features)
    numbers = [f"__x_{c}" for c in features]
    extra = [f"__k{i}" for i in range(len(by))]
    coefs = [coef(c) for c in features]
    clean = df.select(
        *keys,
        *[F.col(c).alias(k) for c, k in zip(by, extra)],
        *[F.col(c).cast("double").alias(n) for c, n in zip(features, numbers)],
        F.col(label).cast("double").alias("__y"),
    ).dropna(subset=[*numbers, "__y"])
    # One row per group with a number that stands for its keys; fixed once it is written.
    shards = F.lit(1) if method == "sequential" else F.ceil(F.count(F.lit(1)) / rows_per_shard).cast("int")
    sizes = clean.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"), shards.alias("shards")).filter("__n > 0").drop("__n")
    groups = settle(sizes.withColumn("__group", F.monotonically_increasing_id()))
    placed = attach(clean, groups, keys)
    fit_type = T.StructType(
        [T.StructField("__group", T.LongType())]
        + [T.StructField(n, T.DoubleType()) for n in ("intercept", *coefs, "__loss")]
        + [T.StructField("__rows", T.LongType())]
    )

    def fit_row(group: int, w: np.ndarray, b: float, lost: float, rows: int) -> pd.DataFrame:
        return pd.DataFrame([[group, b, *w, lost, rows]], columns=fit_type.names)

    def whole_fit(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(extra, kind="stable")
        x, y = group[numbers].to_numpy(float), group["__y"].to_numpy(float)
        rng = np.random.default_rng(seed)
        w, b = np.zeros(len(numbers)), 0.0
        best, idle, lost = np.inf, 0, 0.0
        for _ in range(max_iter):
            b, lost = passive_aggressive_pass(x, y, w, b, rng.permutation(len(y)), aggressiveness, epsilon)
            idle = idle + 1 if lost > best - tolerance * len(y) else 0
            best = min(best, lost)
            if idle >= patience:
                break
        return fit_row(group["__group"].iloc[0], w, b, lost, len(y))

    block_rows = max(1, BLOCK_BYTES // (8 * (len(numbers) + 1)))

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Blocks of the rows, which come shard by shard and in order; a shard's blocks are numbered."""
        current, number = None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            group, unit = batch.column("__group").to_numpy(), batch.column("__shard").to_numpy()
            rows = np.column_stack([batch.column(c).to_numpy() for c in (*numbers, "__y")])
            new = np.flatnonzero((np.diff(group) != 0) | (np.diff(unit) != 0)) + 1
            packed = []
            for a, b in zip([0, *new.tolist()], [*new.tolist(), len(rows)]):
                if (group[a], unit[a]) != current:
                    current, number = (group[a], unit[a]), 0
                for at in range(a, b, block_rows):
                    packed.append((group[a], unit[a], number, rows[at : min(at + block_rows, b)].tobytes()))
                    number += 1
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.binary())
            yield pa.record_batch([pa.array(v, k) for v, k in zip(zip(*packed), kinds)], names=["__group", "__shard", "__number", "__block"])

    def shard_passes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """One pass per shard over a partition whose blocks come by their numbers, so that those of many shards lie side by side."""
        place: dict[tuple[int, int], int] = {}
        w, b, lost, rows = np.zeros((0, len(numbers))), np.zeros(0), np.zeros(0), np.zeros(0, np.int64)
        for batch in batches:
            units = list(zip(batch.column("__group").to_pylist(), batch.column("__shard").to_pylist()))
            new = []
            for i, unit in enumerate(units):
                if unit not in place:
                    place[unit] = len(place)
                    new.append(i)
            if new:
                begun = batch.take(pa.array(new))
                w = np.concatenate([w, np.column_stack([begun.column(c).to_numpy() for c in coefs])])
                b = np.concatenate([b, begun.column("intercept").to_numpy()])
                lost, rows = (np.concatenate([v, np.zeros(len(new), v.dtype)]) for v in (lost, rows))
            at, number = np.array([place[unit] for unit in units], np.int64), batch.column("__number").to_numpy()
            cut = np.flatnonzero(np.diff(number)) + 1
            for first, last in zip([0, *cut.tolist()], [*cut.tolist(), len(at)]):
                for i in range(first, last, MOST_ABREAST):
                    own = at[i : min(i + MOST_ABREAST, last)]
                    some = [np.frombuffer(v.as_buffer()).reshape(-1, len(numbers) + 1) for v in batch.column("__block").slice(i, len(own))]
                    own_w, own_b = w[own], b[own]
                    lost[own] += passes_abreast(some, own_w, own_b, aggressiveness, epsilon)
                    w[own], b[own] = own_w, own_b
                    rows[own] += [len(x) for x in some]
        if place:
            group = pa.array([unit[0] for unit in place], pa.int64())
            yield pa.record_batch([group, pa.array(b), *map(pa.array, w.T.copy()), pa.array(lost), pa.array(rows)], names=fit_type.names)

    if method == "sequential":
        fitted = placed.groupBy("__group").applyInPandas(whole_fit, fit_type).select("__group", "intercept", *coefs)
    else:
        # Divided into shards, put in a seeded order and stored once, in blocks; every round streams them back.
        shard = F.pmod(F.xxhash64(*extra), F.col("shards")).cast("int")
        ordered = (
            placed.withColumn("__shard", shard)
            .withColumn("__mixed", F.xxhash64(F.lit(seed), *extra))
            .repartition("__group", "__shard")
            .sortWithinPartitions("__group", "__shard", "__mixed", *extra)
            .select("__group", "__shard", *numbers, "__y")
        )
        packed = ordered.mapInArrow(blocks, "__group long, __shard int, __number long, __block binary")
        shard_blocks = settle_partitioned(packed.repartition("__group", "__shard"))
        zeros = [F.lit(0.0).alias(c) for c in ("intercept", *coefs)]
        weights = groups.select("__group", "shards", *zeros, F.lit(float("inf")).alias("__loss"))
        for _ in range(rounds):
            # One row of weights per shard: where they are too many to broadcast, the join moves shards, not whole groups.
            units = weights.select("*", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)).alias("__shard")).drop("shards", "__loss")
            ready = attach(shard_blocks, units, ["__group", "__shard"]).sortWithinPartitions("__number", "__group", "__shard")
            passed = ready.select("__group", "__shard", "__number", "__block", "intercept", *coefs).mapInArrow(shard_passes, fit_type)
            mixed = [(F.sum(F.col(c) * F.col("__rows")) / F.sum("__rows")).alias(c) for c in ("intercept", *coefs)]
            mean_loss = (F.sum("__loss") / F.sum("__rows")).alias("__loss")
            previous = weights.select("__group", "shards", F.col("__loss").alias("__previous"))
            new = attach(passed.groupBy("__group").agg(*mixed, mean_loss), previous, ["__group"])
            stepped = settle(new)
            weights = stepped.select("__group", "shards", "intercept", *coefs, "__loss")
            if stepped.filter(F.col("__previous") - F.col("__loss") > tolerance).isEmpty():
                break
        fitted = weights.select("__group", "intercept", *coefs)
    return settle(attach(fitted, groups, ["__group"], how="inner").select(*keys, "intercept", *coefs, "shards"))


def fit_scaled(fit: Fit) -> Fit:
    """The same fit on features standardised by the training rows, folded back to raw features."""

    def fitted(df: DataFrame, features: Sequence[str], label: str, group_cols: Sequence[str] = ()) -> DataFrame:
        scaler = scaler_fit(df, features, group_cols)
        table = fit(standardise(df, scaler, features, group_cols), features, label, group_cols)
        return fold_scaler(table, scaler, features, group_cols)

    return fitted


def training_metrics(
    df: DataFrame,
    fitted: DataFrame | Model,
    features: Sequence[str],
    label: str,
    group_cols: Sequence[str] = (),
    split_col: str = "split",
    metrics: Sequence[str] = TRAINING_METRICS,
) -> DataFrame:
    """Metrics of the train and test rows in one pass, named `train_...` and `val_...`, for any kind of model."""
    rows = df.select(*dict.fromkeys([*group_cols, *features, label, split_col]))
    scored = as_model(fitted, features, group_cols).score(rows)
    long = regression_metrics(scored, label, "prediction", [*group_cols, split_col], metrics)
    prefix = F.when(F.col(split_col) == "train", "train_").otherwise("val_")
    return long.select(*group_cols, F.concat(prefix, F.col("metric")).alias("metric"), "value")


def fit_candidates(
    df: DataFrame,
    candidates: Mapping[str, Fit],
    features: Sequence[str],
    label: str,
    group_cols: Sequence[str] = (),
    split_col: str = "split",
) -> tuple[dict[str, DataFrame | Model], DataFrame]:
    """Fit every candidate on the train rows; a failing one is recorded and does not stop the rest.

    Returns what the candidates that succeeded returned (coefficient tables or models) and a
    result table with, per candidate and segment, a status, an error if any, and the train and
    validation metrics. A candidate fails for one segment alone where it has no finite training
    error there: too few rows, a fit that ran away, or none. Its other segments stay `ok`.
    """
    fitted: dict[str, DataFrame | Model] = {}
    results: list[DataFrame] = []
    train = df.filter(F.col(split_col) == "train")
    segments = settle(df.select(*group_cols).distinct()) if group_cols else None
    shape = [df.schema[k] for k in group_cols]
    tail = T.StructType([*shape, T.StructField("metric", T.StringType()), T.StructField("value", T.DoubleType())])
    for name, fit in candidates.items():
        try:
            table = fit(train, features, label, group_cols)
            rows = settle(training_metrics(df, table, features, label, group_cols, split_col))
            fitted[name] = table
            results.append(_with_status(rows, name, segments, group_cols))
        except Exception as problem:
            error = str(problem).splitlines()[0] if str(problem) else type(problem).__name__
            none = segments if segments is not None else df.sparkSession.range(1).select()
            empty = none.select(*group_cols, F.lit(None).cast("string").alias("metric"), F.lit(None).cast("double").alias("value"))
            results.append(
                empty.select(F.lit(name).alias("candidate"), F.lit("failed").alias("status"), F.lit(error).alias("error"), *[f.name for f in tail.fields])
            )
    table = results[0]
    for more in results[1:]:
        table = table.unionByName(more)
    return fitted, table


def _with_status(rows: DataFrame, name: str, segments: DataFrame | None, group_cols: Sequence[str]) -> DataFrame:
    """A candidate's metrics with a status per segment; a segment that has none, or no finite training error, failed."""
    error = F.max(F.when(F.col("metric") == "train_rmse", F.col("value")))
    judged = settle(rows.groupBy(*group_cols).agg((error.isNotNull() & ~F.isnan(error) & (error < float("inf"))).alias("__fine"), F.lit(True).alias("__seen")))
    listed = rows if segments is None else attach(segments, rows, group_cols)
    known = attach(listed, judged, group_cols)
    fine = F.coalesce("__fine", F.lit(False))
    said = F.when(fine, F.lit(None)).when(F.col("__seen").isNull(), F.lit("no rows to measure")).otherwise(F.lit("no finite training error"))
    return known.select(
        F.lit(name).alias("candidate"), F.when(fine, "ok").otherwise("failed").alias("status"), said.alias("error"), *group_cols, "metric", "value"
    )


def best_candidates(results: DataFrame, group_cols: Sequence[str] = (), metric: str = "val_rmse", lower_better: bool = True) -> DataFrame:
    """Per segment: the candidate with the best value of `metric` among those that did not fail there.

    `n_ok` and `n_failed` count candidates; ties go to the first name. A segment in which all
    failed, or none has a finite value, has a null `best`.
    """
    value = F.when((F.col("status") == "ok") & (F.col("metric") == metric) & ~F.isnan("value"), F.col("value"))
    rank = F.struct((value if lower_better else -value).alias("rank"), F.col("candidate").alias("candidate"), value.alias("value"))
    per_candidate = results.groupBy(*group_cols, "candidate").agg(
        F.max("status").alias("status"), F.min(F.when(value.isNotNull(), rank)).alias("__best")
    )
    return per_candidate.groupBy(*group_cols).agg(
        F.min("__best")["candidate"].alias("best"),
        F.min("__best")["value"].alias(metric),
        F.count_if(F.col("status") == "ok").alias("n_ok"),
        F.count_if(F.col("status") == "failed").alias("n_failed"),
    )
