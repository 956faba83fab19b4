"""Token-id output: whole texts as ids in Simple-8b files, in ascending document order.

`write_token_files` deals documents out by ranges of their id, encodes each range in order and
writes it as files of bounded size into the shared folder. A file's name is new for each attempt
of a task, and the manifest, a Parquet table, lists the files of the attempts that counted, so
a lost executor or a second attempt leaves no doubt about what belongs to the output. Where a
document starts among all ids follows from the manifest: the ids of earlier files, and of
earlier documents in the same file. `read_token_files` reads only the manifest and the files.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from driftloom.llm.common import give_back, kept_by_worker, need, sent_in, sliced
from driftloom.llm.simple8b import pack_file, unpack_file
from driftloom.llm.words import WordEncoder
from driftloom.sources.scratch import fresh_path

END_ID = 1
#: A file is closed when it holds this many ids.
IDS_PER_FILE = 2 << 20
MANIFEST = "part int, number int, path string, n_docs long, n_ids long, n_bytes long"
#: Hadoop's schemes of file systems that Arrow can write to, and its names for them.
SCHEMES = {"file": "file", "hdfs": "hdfs", "viewfs": "viewfs", "s3": "s3", "s3a": "s3", "gs": "gs", "abfs": "abfs", "abfss": "abfss"}
#: A reading task takes files with about this many ids.
IDS_PER_TASK = 16 << 20
#: Texts are encoded in slices of about this many bytes, and Spark sends them to Python in batches of about `SENT_BYTES`.
ENCODED_BYTES = 512 << 10
SENT_BYTES = 4 << 20


def encoder(path: str) -> WordEncoder:
    """One encoder per Python worker, with the words of its earlier tasks; a new one for another vocabulary file."""
    file = os.stat(path)
    return kept_by_worker("word encoder", (path, file.st_mtime_ns, file.st_size), lambda: WordEncoder(path))


def with_end(ids: np.ndarray, sizes: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """The end id put after each document's ids."""
    out = np.full(len(ids) + len(sizes), end_id, np.uint32)
    last = np.cumsum(sizes + 1) - 1
    inner = np.ones(len(out), bool)
    inner[last] = False
    out[inner] = ids
    return out, sizes + 1


def shared_folder(spark: SparkSession, folder: str) -> str:
    """The folder with the scheme of the cluster's file system, as executors need it; an error where files cannot be written to it.

    A path without a scheme belongs to the default file system, as for Spark itself.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    whole = path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString().rstrip("/")
    scheme, _, rest = whole.partition(":")
    if scheme not in SCHEMES:
        raise ValueError(f"token files cannot be written to {scheme}: folders; give one of {', '.join(SCHEMES)}")
    return f"{SCHEMES[scheme]}:{rest if rest.startswith('//') else '//' + rest}"


def _file_system(folder: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(folder)


def write_token_files(
    docs: DataFrame,
    tokenizer_path: str,
    folder: str | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    end_id: int = END_ID,
    ids_per_file: int = IDS_PER_FILE,
) -> DataFrame:
    """Encode every whole text and write the ids; returns the manifest.

    A null or empty text has the end id alone. Rows are ordered by id, nulls first; rows that
    share an id are ordered by a hash of their text, and equal rows are each written. An empty
    table gives an empty manifest. Other columns are not read.
    """
    need(docs, id_col, text_col)
    spark = docs.sparkSession
    folder = shared_folder(spark, folder or fresh_path(spark, "tokens"))
    slim = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    placed = slim.withColumn("tie", F.xxhash64("text")).repartitionByRange("id", "tie").sortWithinPartitions("id", "tie")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, place = _file_system(folder)
        files.create_dir(place, recursive=True)
        encode, part, number = encoder(tokenizer_path).encode, TaskContext.get().partitionId(), 0
        held: list[tuple[np.ndarray, ...]] = []

        def close() -> pa.RecordBatch:
            nonlocal number
            doc_ids, nulls, sizes, ids = (np.concatenate(x) for x in zip(*held))
            held.clear()
            name = f"part-{part:06d}-{number:04d}-{uuid.uuid4().hex}.s8b"
            data = pack_file(doc_ids, nulls, sizes, ids)
            with files.open_output_stream(f"{place}/{name}") as out:
                out.write(data)
            row = [part, number, f"{folder}/{name}", len(doc_ids), len(ids), len(data)]
            number += 1
            kinds = (pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int64())
            return pa.record_batch([pa.array([v], k) for v, k in zip(row, kinds)], names=["part", "number", "path", "n_docs", "n_ids", "n_bytes"])

        for batch in sliced(batches, "text", ENCODED_BYTES):
            ids, sizes = with_end(*encode(batch.column("text")), end_id)
            key = batch.column("id")
            keys, nulls, last = key.fill_null(0).to_numpy(), key.is_null().to_numpy(zero_copy_only=False).astype(np.int64), np.cumsum(sizes)
            for a, b in _pieces(sizes, ids_per_file):
                held.append((keys[a:b], nulls[a:b], sizes[a:b], ids[last[a] - sizes[a] : last[b - 1]]))
                if sum(len(x[3]) for x in held) >= ids_per_file:
                    yield close()
        if held:
            yield close()

    path = fresh_path(spark, "token-manifest")
    with sent_in(spark, SENT_BYTES):
        placed.select("id", "text").mapInArrow(write, MANIFEST).write.parquet(path)
    return spark.read.schema(MANIFEST).parquet(path)


def read_token_files(manifest: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Documents from the files: id, `start` (ids before it), `n_tokens`, and `ids` as little-endian 32-bit numbers."""
    spark = manifest.sparkSession
    # First over the parts, of which there are as many as tasks wrote, then over the files of each.
    parts = manifest.groupBy("part").agg(F.sum("n_ids").alias("of_part"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    begun = parts.select("part", F.coalesce(F.sum("of_part").over(earlier), F.lit(0)).alias("of_earlier"))
    order = Window.partitionBy("part").orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    inside = manifest.select("part", "path", F.coalesce(F.sum("n_ids").over(order), F.lit(0)).alias("inside"))
    files = inside.join(begun, "part").select("path", (F.col("of_earlier") + F.col("inside")).alias("before"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, before in zip(batch.column("path").to_pylist(), batch.column("before").to_pylist()):
                files, place = _file_system(path)
                with files.open_input_file(place) as source:
                    doc_ids, nulls, sizes, ids = unpack_file(source.read())
                last = np.cumsum(sizes)
                ids = ids.astype("<u4")
                for a, b in _pieces(sizes):
                    first = int(last[a] - sizes[a])
                    ends = (4 * (last[a:b] - first)).astype(np.int64)
                    data = pa.py_buffer(ids[first : int(last[b - 1])].tobytes())
                    held = pa.Array.from_buffers(pa.large_binary(), b - a, [None, pa.py_buffer(np.concatenate(([0], ends)).tobytes()), data])
                    columns = [pa.array(doc_ids[a:b], mask=nulls[a:b] > 0), pa.array(before + last[a:b] - sizes[a:b]), pa.array(sizes[a:b]), held.cast(pa.binary())]
                    yield pa.record_batch(columns, names=[id_col, "start", "n_tokens", "ids"])
                give_back()

    size = manifest.agg(F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("n_ids"), F.lit(0)).alias("ids")).first()
    spread = max(1, min(size["files"], max(8 * spark.sparkContext.defaultParallelism, -(-size["ids"] // IDS_PER_TASK))))
    return files.repartition(spread).mapInArrow(read, f"{id_col} long, start long, n_tokens long, ids binary")


def _pieces(sizes: np.ndarray, most: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Runs of documents of about `most` ids."""
    cut = np.flatnonzero(np.diff(np.cumsum(sizes) // most)) + 1
    ends = [*cut.tolist(), len(sizes)]
    yield from ((a, b) for a, b in zip([0, *ends[:-1]], ends) if b > a)


def token_digests(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """Write, read back, and digest: doc_id, start, n_tokens, ids_crc32."""
    rows = read_token_files(write_token_files(docs, tokenizer_path))
    return rows.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
