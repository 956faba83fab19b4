"""SimHash near-duplicates, linked by BK-trees.

A text's fingerprint has a bit set where over half of its shingles' XXH64 hashes have it. Texts
whose fingerprints differ in at most `radius` bits are linked, and components are told by their
smallest document id.

Distinct fingerprints only are compared. A fingerprint of 64 bits is cut into `radius + agree`
blocks; two within the radius agree in at least `agree` of them, so every choice of `agree`
blocks, with their bits, is a shard, and any linked pair shares one. Each shard's BK-tree is
built in one task and asked for the shard's own fingerprints. A shard of more than `slice_size`
is dealt into slices, each slice's tree sent to every other slice's queries. `agree` follows
from the number of distinct fingerprints and changes the work only. From each tree come links
that join what it found, at most one per fingerprint, not all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftloom.llm.bktree import linked_within
from driftloom.llm.common import group_starts, need, runs_of, sliced
from driftloom.llm.components import components
from driftloom.sources.scratch import settle

SHINGLE = 4
RADIUS = 4
SEED = 42
#: A shard of more fingerprints than this is dealt into slices.
SLICE_SIZE = 1024
#: The number of agreeing blocks is chosen so that shards of random fingerprints would hold about this many.
SHARD_TARGET = 64
MOST_AGREE = 3


def fingerprint(text: str | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """The fingerprint as an unsigned number; 0 without any word."""
    words = text.encode().lower().split() if text else []
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    k = min(shingle, len(words))
    starts, ends = starts[: len(words) - k + 1], ends[k - 1 :]
    set_ = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for i in range(0, len(starts), 1 << 15):
        some = zip(starts[i : i + (1 << 15)].tolist(), ends[i : i + (1 << 15)].tolist())
        hashes = np.array([digest(joined[a:b], seed) for a, b in some], "<u8")
        set_ += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int32)
    return int(np.packbits(2 * set_ > len(starts), bitorder="little").view("<u8")[0])


def _with_bits(slim: DataFrame, shingle: int) -> DataFrame:
    """The frame with `bits`, the fingerprint of its `text` as a signed long, in place of the text."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "text"):
            bits = np.fromiter((fingerprint(t, shingle) for t in batch.column("text").to_pylist()), np.uint64, batch.num_rows)
            kept = [c for c in batch.schema.names if c != "text"]
            yield pa.record_batch([*[batch.column(c) for c in kept], pa.array(bits.view(np.int64))], names=[*kept, "bits"])

    fields = [f for f in slim.schema.fields if f.name != "text"]
    return slim.mapInArrow(scan, T.StructType([*fields, T.StructField("bits", T.LongType())]))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """`doc_id` and `bits` (the fingerprint as a signed long) of every row."""
    need(docs, id_col, text_col)
    return _with_bits(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")), shingle)


def _shards(distinct: DataFrame, radius: int, agree: int) -> DataFrame:
    """`shard` and `bits`: each fingerprint once for every choice of blocks."""
    n = radius + agree
    border = [64 * i // n for i in range(n + 1)]
    keys = []
    for which in combinations(range(n), agree):
        mask = sum(((1 << (border[i + 1] - border[i])) - 1) << border[i] for i in which)
        signed = mask - (1 << 64) if mask >> 63 else mask
        keys.append(F.xxhash64(F.lit(len(keys)), F.col("bits").bitwiseAND(F.lit(signed))))
    return distinct.select(F.explode(F.array(*keys)).alias("shard"), "bits")


def fingerprint_links(distinct: DataFrame, radius: int = RADIUS, slice_size: int = SLICE_SIZE, agree: int | None = None) -> DataFrame:
    """Links `a`, `b` between distinct fingerprints whose components are those of all pairs within the radius."""
    if agree is None:
        n = distinct.count()
        fits = [k for k in range(1, MOST_AGREE + 1) if n / 2.0 ** (64 * k / (radius + k)) <= SHARD_TARGET]
        agree = fits[0] if fits else MOST_AGREE
    rows = _shards(distinct, radius, agree)
    sizes = settle(rows.groupBy("shard").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"))
    slices = F.ceil(F.col("n") / slice_size).cast("int")
    placed = rows.join(sizes, "shard").select("shard", "bits", slices.alias("slices"), F.pmod(F.xxhash64("bits", F.lit(1)), slices).cast("int").alias("own"))
    # Slice i holds the tree of cell (i, j) for every j >= i, and asks in cell (j, i) for every j < i.
    tree = F.transform(F.sequence(F.col("own"), F.col("slices") - 1), lambda j: F.struct((F.col("own") * F.col("slices") + j).alias("cell"), F.lit(False).alias("asks")))
    asks = F.transform(F.sequence(F.lit(0), F.col("own")), lambda j: F.struct((j * F.col("slices") + F.col("own")).alias("cell"), F.lit(True).alias("asks")))
    asks = F.filter(asks, lambda c: c["cell"] != F.col("own") * F.col("slices") + F.col("own"))
    cells = placed.select("shard", "bits", F.explode(F.concat(tree, asks)).alias("to")).select("shard", "to.cell", "to.asks", "bits")

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in runs_of(batches, "shard", "cell"):
            shard, cell, role = (table.column(c).to_numpy() for c in ("shard", "cell", "asks"))
            bits = table.column("bits").to_numpy().view(np.uint64)
            border = group_starts(shard, cell)
            found = []
            for a, b in zip(border[:-1].tolist(), border[1:].tolist()):
                own, query = bits[a:b], role[a:b]
                if query.any():
                    if query.all():
                        continue
                    found.append(linked_within(own[~query], radius, own[query]))
                elif b - a == 2:
                    if int(own[0] ^ own[1]).bit_count() <= radius:
                        found.append((own[1:], own[:1]))
                elif b - a > 2:
                    found.append(linked_within(own, radius))
            if found:
                yield pa.record_batch([pa.array(np.concatenate(x).view(np.int64)) for x in zip(*found)], names=["a", "b"])

    dealt = cells.repartition("shard", "cell").sortWithinPartitions("shard", "cell")
    return dealt.mapInArrow(link, "a long, b long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id of every row.

    component_id is the smallest id reachable by links, itself included. Null and empty texts
    have fingerprint zero, and are linked like any other. Rows that share an id are rows of their
    own with that id; a null id is the smallest, and component_id is then null where all of a
    component's ids are, else its smallest id. Other columns are not read.
    """
    rows = settle(fingerprints(docs, id_col, text_col, shingle))
    distinct = settle(rows.groupBy("bits").agg(F.min("doc_id").alias("first")))
    member = _with_roots(distinct, radius)
    smallest = member.groupBy("root").agg(F.min("first").alias("component_id"))
    named = settle(member.join(smallest, "root").select(F.col("bits").alias("key"), "component_id"))
    joined = rows.join(named, rows["bits"] == named["key"])
    return joined.select("doc_id", F.lower(F.lpad(F.hex("bits"), 16, "0")).alias("fingerprint"), "component_id")


def _with_roots(distinct: DataFrame, radius: int) -> DataFrame:
    """Distinct `bits`, and what else the frame has, with the `root` of their component."""
    found = components(fingerprint_links(distinct.select("bits"), radius))
    return distinct.join(found, distinct["bits"] == found["node"], "left").select(*distinct.columns, F.coalesce("component", "bits").alias("root"))


def keep_one_of_each(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, radius: int = RADIUS
) -> DataFrame:
    """One row of each component: the one with the smallest id, rows without an id last.

    Rows that share the id are told apart by a hash of their text, and repeated rows, with id and
    text the same, by a hash of all their columns; of wholly equal rows one is kept. An empty
    frame gives an empty one; columns stay as they are.
    """
    need(docs, id_col, text_col)
    taken = {c.lower() for c in docs.columns}
    key, tie = (next(n for n in (x + "_" * i for i in range(99)) if n not in taken) for x in ("llm_key", "llm_tie"))
    hashes = [F.xxhash64(F.col(id_col), F.col(text_col)).alias(key), F.xxhash64(F.lit("tie"), F.col(text_col)).alias(tie)]
    slim = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"), hashes[0].alias("key"), hashes[1].alias("tie"))
    rows = settle(_with_bits(slim, shingle))
    first = F.min(F.struct(F.col("id").isNull().alias("without"), "id", "tie", "key")).alias("first")
    member = _with_roots(settle(rows.groupBy("bits").agg(first)), radius)
    leaders = settle(member.groupBy("root").agg(F.min("first").alias("first")).select("first.id", "first.tie", "first.key"))
    same = (F.col(key) == F.col("__key")) & (F.col(tie) == F.col("__tie"))
    chosen = leaders.select(F.col("key").alias("__key"), F.col("tie").alias("__tie"))
    kept = docs.select("*", *hashes).join(chosen, same, "left_semi")
    # The join has brought equal keys together; of each row's repetitions the first stays.
    hashed = [c for c in docs.columns if not isinstance(docs.schema[c].dataType, (T.MapType, T.VariantType))]
    order = Window.partitionBy(key, tie).orderBy(F.xxhash64(*hashed))
    return kept.withColumn("__nth", F.row_number().over(order)).filter("__nth = 1").select(*docs.columns)
