"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import sys
from collections.abc import Callable, Hashable, Iterator
from contextlib import contextmanager
from types import ModuleType
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

#: Texts are worked on in slices of about this many bytes, so that a task's memory does not follow the batch size.
SLICE_BYTES = 2 << 20

# Byte translations. All keep a text's length, so offsets into the result are offsets into the original.
_AZ = {c: c + 32 for c in range(0x41, 0x5B)}
LOWER_AND_BLANKS = bytes(_AZ.get(c, 0x20 if 9 <= c <= 13 else c) for c in range(256))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def need(df: DataFrame, *columns: str) -> None:
    """Refuse a frame that lacks a column, by name."""
    lacking = [c for c in columns if c not in df.columns]
    if lacking:
        raise ValueError(f"no column {', '.join(lacking)} among {', '.join(df.columns)}")


def text_bytes(column: pa.Array) -> tuple[bytes, np.ndarray]:
    """All texts of a column in one buffer, and the n + 1 offsets between them; null counts as empty."""
    column = column.fill_null("").cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    if data is None or not len(column):
        return b"", np.zeros(len(column) + 1, np.int64)
    return data[int(offsets[0]) : int(offsets[-1])].to_pybytes(), offsets - offsets[0]


def give_back() -> None:
    """Return freed memory to the system: a Python worker counts against its executor's limit, also while it is idle."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def kept_by_worker(name: str, version: Hashable, make: Callable[[], Any]) -> Any:
    """What `make` returns, made once per Python worker and version; the last version is kept.

    This package's functions travel with every task, and with them their modules' globals. What is to
    outlast a task is held by a module that does not travel.
    """
    held = vars(sys.modules.setdefault("_kept_by_worker", ModuleType("_kept_by_worker")))
    if name not in held or held[name][0] != version:
        held.pop(name, None)
        held[name] = version, make()
    return held[name][1]


@contextmanager
def sent_in(spark: SparkSession, most: int) -> Iterator[None]:
    """What is computed inside goes to Python in batches of about `most` bytes, unless the session has them smaller.

    A batch is held by the executor and by its worker at once, and Spark's own bound is many times a slice.
    """
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    if int(spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(before)) <= most:
        yield
        return
    spark.conf.set(key, str(most))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def sliced(batches: Iterator[pa.RecordBatch], text: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about `most` bytes of the text column; a longer text is a batch of its own."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pa.compute.binary_length(batch.column(text)).fill_null(0).to_numpy(zero_copy_only=False)
        cut = np.flatnonzero(np.diff(np.cumsum(sizes.astype(np.int64)) // most)) + 1
        for a, b in zip([0, *cut.tolist()], [*cut.tolist(), batch.num_rows]):
            yield batch.slice(a, b - a)
        give_back()


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of bytes other than blank (0x20), none running over the end of a text."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    word = data != 0x20
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    before = np.empty(n, bool)
    before[0], before[1:] = False, word[:-1]
    after = np.empty(n, bool)
    after[-1], after[:-1] = False, word[1:]
    starts = np.flatnonzero(word & (~before | edge[:-1]))
    ends = np.flatnonzero(word & (~after | edge[1:])) + 1
    return starts, ends


def runs_of(batches: Iterator[pa.RecordBatch], *keys: str) -> Iterator[pa.Table]:
    """Whole groups from rows that come sorted by the keys, also where a group spans batches.

    Yields tables that hold one or more complete groups.
    """
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        last = [batch.column(k)[-1] for k in keys]
        same = np.ones(batch.num_rows, bool)
        for k, v in zip(keys, last):
            same &= pa.compute.equal(batch.column(k), v).fill_null(False).to_numpy(zero_copy_only=False)
        head = int(np.argmax(same))
        if head == 0 and held and all(h == v for h, v in zip((held[-1].column(k)[-1] for k in keys), last)):
            held.append(batch)
            continue
        done = [*held, batch.slice(0, head)]
        if sum(b.num_rows for b in done):
            yield pa.Table.from_batches(done)
        give_back()
        held = [batch.slice(head)]
    if held:
        yield pa.Table.from_batches(held)
    give_back()


def group_starts(*columns: np.ndarray) -> np.ndarray:
    """Borders of runs of equal rows in sorted arrays: first positions, and the length at the end."""
    n = len(columns[0])
    new = np.ones(n, bool)
    if n:
        new[1:] = False
        for c in columns:
            new[1:] |= c[1:] != c[:-1]
    return np.append(np.flatnonzero(new), n)


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices start, start + 1, ... of every run, one run after the other."""
    total = int(lengths.sum())
    before = np.cumsum(lengths) - lengths
    return np.arange(total) + np.repeat(starts - before, lengths)


def fresh_name(df: DataFrame, name: str) -> str:
    """The name, with underscores after it as long as the frame has such a column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name
