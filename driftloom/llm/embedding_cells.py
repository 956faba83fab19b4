"""Embedding near-duplicates: spherical k-means cells and blocked cosine products.

Vectors of one label are linked where their cosine reaches the threshold. Centroids are fitted
by spherical k-means on a bounded sample; every vector is a member of the cell of its nearest
centroid, and a visitor of every cell that could hold a vector linked to it: unit vectors u and
v with cosine >= t are at most d = sqrt(2 - 2t) apart, so if v's cell is c and u's is h, then
u . (h - c) <= d |h - c|. Whoever breaks this for c need not visit it. No linked pair is lost,
whatever the centroids; they only decide how much is compared.

Equal vectors of a label are compared once and counted with their number. A cell's members and
visitors are dealt into slices of bounded size, and each pair of slices is one block, a single
matrix product. From each block come each visitor's number of links, and links that join what
was found, at most one per vector, not all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftloom.llm.bktree import merge
from driftloom.llm.common import group_starts, need, runs_of
from driftloom.llm.components import components
from driftloom.sources.scratch import settle

THRESHOLD = 0.98
CELL_TARGET = 2048
MOST_CELLS = 4096
#: Bounds of the sample that centroids are fitted on, and rounds of the fit.
SAMPLE_PER_CELL, LEAST_SAMPLE, ROUNDS = 64, 4096, 8
SLICE_SIZE = 1024


def unit_rows(column: pa.Array) -> tuple[np.ndarray, list[int]]:
    """Unit vectors as doubles, and the rows they come from; null, empty, zero, or not finite in any component gives none.

    Vectors of another length than the batch's first are returned too, by the caller's grouping by length.
    """
    lists = column.cast(pa.list_(pa.float64()))
    flat = lists.flatten()
    lengths = np.diff(lists.offsets.to_numpy())
    start = lists.offsets.to_numpy()[:-1] - lists.offsets.to_numpy()[0]
    values = flat.fill_null(np.nan).to_numpy(zero_copy_only=False)
    return values, list(zip(start.tolist(), (start + lengths).tolist()))


def _units(column: pa.Array) -> list[bytes | None]:
    values, spans = unit_rows(column)
    out: list[bytes | None] = []
    valid = column.is_valid().to_numpy(zero_copy_only=False)
    for ok, (a, b) in zip(valid.tolist(), spans):
        v = values[a:b]
        largest = np.abs(v).max() if ok and b > a else 0.0
        if not ok or not largest > 0 or not np.isfinite(v).all():
            out.append(None)
            continue
        v = v / largest  # keeps squares of very large or small components in range
        out.append((v / np.sqrt(v @ v)).tobytes())
    return out


def spherical_kmeans(units: np.ndarray, k: int, rounds: int = ROUNDS) -> np.ndarray:
    """k unit centroids: farthest-first is not needed, an even pick of the ordered sample is the start."""
    centres = units[np.linspace(0, len(units) - 1, k).astype(int)].copy()
    for _ in range(rounds):
        home = (units @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, home, units)
        size = np.linalg.norm(sums, axis=1)
        good = size > 1e-12
        centres[good] = sums[good] / size[good, None]
    return centres


def _distinct_units(vectors: DataFrame, label_col: str, vector_col: str, id_col: str) -> DataFrame:
    """One row per label and distinct vector: `rep` (a number of its own), `n` rows, `first` (smallest id), `dim`, `unit`."""
    grouped = vectors.filter(F.col(label_col).isNotNull() & F.col(vector_col).isNotNull()).groupBy(
        F.col(label_col).alias("label"), F.col(vector_col).alias("vector")
    ).agg(F.min(id_col).alias("first"), F.count(F.lit(1)).alias("n"))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            units = pa.array(_units(batch.column("vector")), pa.binary())
            kept = batch.append_column("unit", units).filter(units.is_valid())
            dim = pa.compute.divide(pa.compute.binary_length(kept.column("unit")), 8).cast(pa.int32())
            yield pa.record_batch([*(kept.column(c) for c in ("label", "vector", "first", "n", "unit")), dim], names=["label", "vector", "first", "n", "unit", "dim"])

    schema = grouped.schema.simpleString()[7:-1] + ",unit:binary,dim:int"
    return grouped.mapInArrow(scan, schema).withColumn("rep", F.monotonically_increasing_id())


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(x.as_py() for x in column), np.float64).reshape(-1, dim)


def _centroids(units: DataFrame, dim: int, k: int) -> np.ndarray:
    sample = units.filter(F.col("dim") == dim).orderBy(F.xxhash64("unit")).limit(max(LEAST_SAMPLE, SAMPLE_PER_CELL * k)).select("unit").collect()
    rows = np.frombuffer(b"".join(bytes(r["unit"]) for r in sample), np.float64).reshape(-1, dim)
    return spherical_kmeans(rows, min(k, len(rows)))


def linked_vectors(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    threshold: float = THRESHOLD,
    cell_target: int = CELL_TARGET,
    slice_size: int = SLICE_SIZE,
) -> DataFrame:
    """vec_id, n_links, component_id, kept: one row per input row.

    A null label, and a vector that is null, empty, zero, or has a null or non-finite component,
    has no links and is a component of its own. Vectors of different length are not linked. Rows
    that share an id are vectors of their own, and `kept` is true for each whose id is its
    component's smallest; a null id gives a null component and is not kept, unless links join it
    to others. An empty table gives an empty result. Other columns are not read.
    """
    need(vectors, id_col, vector_col, label_col)
    slim = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("vector"), F.col(label_col).alias("label"))
    reps = settle(_distinct_units(slim, "label", "vector", "vec_id"))
    dims = [r["dim"] for r in reps.select("dim").distinct().orderBy("dim").collect()]
    per_label = reps.groupBy("dim", "label").count().groupBy("dim").agg(F.max("count").alias("most")).collect()
    centres = {r["dim"]: _centroids(reps, r["dim"], min(MOST_CELLS, -(-r["most"] // cell_target))) for r in per_label if r["dim"] in dims}
    shared = vectors.sparkSession.sparkContext.broadcast(centres)
    reach = np.sqrt(2 - 2 * threshold)

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dim in np.unique(batch.column("dim").to_numpy()).tolist():
                part = batch.filter(pa.compute.equal(batch.column("dim"), dim))
                c = shared.value[dim]
                near = _matrix(part.column("unit"), dim) @ c.T
                home = near.argmax(axis=1)
                apart = np.sqrt(np.maximum(0.0, 2 - 2 * (c @ c.T)))
                goes = near[np.arange(len(home)), home][:, None] - near <= reach * apart[home] + 1e-9
                goes[np.arange(len(home)), home] = True
                row, cell = np.nonzero(goes)
                out = part.take(pa.array(row))
                columns = [pa.array(cell.astype(np.int32)), pa.array(cell != home[row]), *(out.column(x) for x in ("rep", "n", "label", "dim", "unit"))]
                yield pa.record_batch(columns, names=["cell", "visits", "rep", "n", "label", "dim", "unit"])

    label_type = reps.schema["label"].dataType.simpleString()
    places = reps.select("rep", "n", "label", "dim", "unit").mapInArrow(visit, f"cell int, visits boolean, rep long, n long, label {label_type}, dim int, unit binary")
    # Members and visitors per cell decide its slices; every row asks, members also answer.
    keys = ["label", "dim", "cell"]
    sizes = settle(places.groupBy(*keys).agg(F.count(F.when(~F.col("visits"), 1)).alias("members"), F.count(F.lit(1)).alias("askers")).filter("members > 0"))
    slices = lambda n: F.greatest(F.lit(1), F.ceil(F.col(n) / slice_size)).cast("int")
    dealt = places.join(sizes.withColumns({"m": slices("members"), "q": slices("askers")}).drop("members", "askers"), keys)
    own = lambda n: F.pmod(F.xxhash64("rep"), F.col(n)).cast("int")
    asks = F.transform(F.sequence(F.lit(0), F.col("m") - 1), lambda j: F.struct((j * F.col("q") + own("q")).alias("block"), F.lit(True).alias("asks")))
    answers = F.transform(F.sequence(F.lit(0), F.col("q") - 1), lambda j: F.struct((own("m") * F.col("q") + j).alias("block"), F.lit(False).alias("asks")))
    blocks = dealt.select(*keys, "rep", "n", "unit", F.explode(F.when(F.col("visits"), asks).otherwise(F.concat(asks, answers))).alias("to"))
    blocks = blocks.select(F.xxhash64(*keys, "to.block").alias("block"), *keys, "to.asks", "rep", "n", "unit", F.col("to.block").alias("number"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in runs_of(batches, "block"):
            block, role = table.column("block").to_numpy(), table.column("asks").to_numpy()
            rep, n, dims_ = (table.column(c).to_numpy() for c in ("rep", "n", "dim"))
            border = group_starts(block)
            for a, b in zip(border[:-1].tolist(), border[1:].tolist()):
                ask, answer = np.flatnonzero(role[a:b]) + a, np.flatnonzero(~role[a:b]) + a
                if not len(ask) or not len(answer):
                    continue
                units = table.column("unit").combine_chunks()
                x, y = _matrix(units.take(pa.array(ask)), int(dims_[a])), _matrix(units.take(pa.array(answer)), int(dims_[a]))
                close = x @ y.T >= threshold
                counts = close @ n[answer]
                u, v = np.nonzero(close)
                names = np.unique(np.concatenate((rep[ask], rep[answer])))
                label = np.arange(len(names))
                merge(label, np.searchsorted(names, rep[ask[u]]), np.searchsorted(names, rep[answer[v]]))
                hit = np.flatnonzero(counts)
                root = names[label[np.searchsorted(names, rep[ask[hit]])]]
                answered = np.flatnonzero(close.any(axis=0))
                yield pa.record_batch(
                    [
                        pa.array(np.concatenate((rep[ask[hit]], rep[answer[answered]]))),
                        pa.array(np.concatenate((counts[hit], np.zeros(len(answered), np.int64))).astype(np.int64)),
                        pa.array(np.concatenate((root, names[label[np.searchsorted(names, rep[answer[answered]])]]))),
                    ],
                    names=["rep", "links", "root"],
                )

    ordered = blocks.repartition("block").sortWithinPartitions("block")
    found = settle(ordered.mapInArrow(compare, "rep long, links long, root long"))
    counted = found.groupBy("rep").agg((F.sum("links") - 1).alias("n_links"))
    linked = components(found.select(F.col("rep").alias("a"), F.col("root").alias("b")))
    facts = reps.select("rep", "label", "vector", "first").join(counted, "rep", "left").join(linked, F.col("rep") == F.col("node"), "left")
    facts = facts.select("label", "vector", "first", "n_links", F.coalesce("component", "rep").alias("root"))
    smallest = facts.groupBy("root").agg(F.min("first").alias("component_id"))
    named = settle(facts.join(smallest, "root").select(F.col("label").alias("k_label"), F.col("vector").alias("k_vector"), "n_links", "component_id"))
    joined = slim.join(named, (F.col("label") == F.col("k_label")) & (F.col("vector") == F.col("k_vector")), "left")
    component = F.when(F.col("n_links").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    rows = joined.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"))
    return rows.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
