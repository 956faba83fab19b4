"""Word windows that occur earlier in a corpus, for any window length and any way of comparing.

Candidates come from minimisers. Of the grams (runs of `gram` words) in a window, the one with
the smallest hash is the window's anchor; equal windows have equal anchors, at equal places. So

1. every text's anchors are hashed, about 2 in (window - gram + 2) words, and those whose gram
   occurs once in the corpus are dropped: their windows occur once too;
2. around each anchor left, the windows that it is the anchor of are cut out as one region, and
   regions of one gram meet in one group; a gram with more than `hot` occurrences is dealt out
   by single windows instead. Each task sends equal regions once for every `HELD_BYTES` it holds,
   and of equal regions that meet only the first is kept while they stream by. So a group has no
   more than `hot` regions, or one distinct window, however often a passage occurs;
3. an engine reads each group and says which windows are new, i.e. have no equal before them;
4. of a text's windows with a repeated anchor, those not new are repeats.

Corpus order is (document id, hash of the text, place). Texts cross the network compressed.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftloom.functions.attach import same_keys
from driftloom.llm.common import give_back, need, runs_of, sliced, text_bytes, word_bounds
from driftloom.llm.words import mixed, piece_hashes
from driftloom.sources.scratch import settle

BLANKS = bytes(0x20 if 9 <= c <= 13 else c for c in range(256))
#: Regions that a task holds back to send equal ones once, in bytes.
HELD_BYTES = 16 << 20

#: Regions of one group in corpus order, as (words, place of the anchor) -> for each, a mask of its new windows.
Engine = Callable[[list[tuple[list[bytes], int]]], list[np.ndarray]]


def window_anchors(data: np.ndarray, offsets: np.ndarray, window: int, gram: int):
    """Of texts whose blanks are 0x20: word starts and ends, each word's text, and for each window its first word,
    its anchor's first word, and the anchor's hash."""
    starts, ends = word_bounds(data, offsets)
    own = np.searchsorted(offsets, starts, "right") - 1
    n = len(starts)
    if n < window:
        none = np.zeros(0, np.int64)
        return starts, ends, own, none, none, np.zeros(0, np.uint64)
    word, _ = piece_hashes(data.tobytes(), starts, ends)
    value = np.zeros(n - gram + 1, np.uint64)
    for j in range(gram):
        value = value * np.uint64(0x9E3779B97F4A7C15) + word[j : n - gram + 1 + j]
    value = mixed(value)
    # Place of the smallest of `width` neighbours (the first among equals), by doubling.
    width, place, reach = window - gram + 1, np.arange(len(value)), 1
    while reach < width:
        step = min(reach, width - reach)
        a, b = place[: len(place) - step], place[step:]
        place = np.where(value[b] < value[a], b, a)
        reach += step
    at = np.flatnonzero(own[: n - window + 1] == own[window - 1 :])
    anchor = place[at]
    return starts, ends, own, at, anchor, value[anchor]


def _coded(column: pa.Array) -> tuple[bytes, np.ndarray, np.ndarray]:
    raw, offsets = text_bytes(column)
    data = raw.translate(BLANKS)
    return data, np.frombuffer(data, np.uint8), offsets


def _zipped(docs: DataFrame) -> DataFrame:
    """id, tie and the compressed text."""

    def squeeze(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=3)
        for batch in sliced(batches, "text"):
            packed = [None if t is None else packer.compress(t.encode()) for t in batch.column("text").to_pylist()]
            yield pa.record_batch([batch.column("id"), batch.column("tie"), pa.array(packed, pa.binary())], names=["id", "tie", "packed"])

    return docs.mapInArrow(squeeze, "id long, tie long, packed binary")


def _opened(batch: pa.RecordBatch, most: int = 1 << 20) -> Iterator[tuple[pa.RecordBatch, pa.Array]]:
    """Rows with their texts, as bytes that are UTF-8, about `most` bytes at a time."""
    opener = zstandard.ZstdDecompressor()
    texts, size, first = [], 0, 0
    for i, packed in enumerate(batch.column("packed")):
        texts.append(opener.decompress(packed.as_py()) if packed.is_valid else b"")
        size += len(texts[-1])
        if size >= most or i + 1 == batch.num_rows:
            yield batch.slice(first, i + 1 - first), pa.array(texts, pa.large_binary()).cast(pa.large_string())
            texts, size, first = [], 0, i + 1
    give_back()


def _marked(column, rows: pa.Array) -> list[np.ndarray]:
    return [np.zeros(0, np.int64) if x is None else np.array(x, np.int64) for x in column.to_pylist()]


def repeated_anchors(docs: DataFrame, window: int, gram: int, hot: int) -> DataFrame:
    """id, tie, and `marks`: twice the anchor's first word, plus 1 for hot grams, of every anchor whose gram occurs again."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "text"):
            _, data, offsets = _coded(batch.column("text"))
            starts, _, own, at, anchor, value = window_anchors(data, offsets, window, gram)
            if not len(at):
                continue
            new = np.concatenate(([True], anchor[1:] != anchor[:-1]))
            anchor, value = anchor[new], value[new]
            base = np.searchsorted(own, np.arange(batch.num_rows))
            row = own[anchor]
            columns = [pa.array(value.view(np.int64)), batch.column("id").take(pa.array(row)), batch.column("tie").take(pa.array(row)), pa.array((anchor - base[row]).astype(np.int32))]
            yield pa.record_batch(columns, names=["gram", "id", "tie", "at"])

    rows = settle(docs.mapInArrow(scan, "gram long, id long, tie long, at int"))
    # Written, so that the join below has plain exchanges on both sides and can split a very frequent gram.
    again = settle(rows.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(F.col("gram").alias("again"), (F.col("n") > hot).cast("int").alias("hot")))
    found = rows.join(again, rows["gram"] == again["again"])
    return settle(found.groupBy("id", "tie").agg(F.array_distinct(F.collect_list(F.col("at") * 2 + F.col("hot"))).alias("marks")))


def _regions(docs: DataFrame, marks: DataFrame, window: int, gram: int) -> DataFrame:
    """key, id, tie, start, anchor, words: of each distinct region in a task the first in corpus order."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, tuple] = {}
        size = 0

        def flush() -> pa.RecordBatch:
            rows = list(held.values())
            held.clear()
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary())
            return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=["key", "id", "tie", "start", "anchor", "words"])

        for batch in batches:
            for rows, texts in _opened(batch):
                buffer, data, offsets = _coded(texts)
                starts, ends, own, at, anchor, value = window_anchors(data, offsets, window, gram)
                if not len(at):
                    continue
                base = np.searchsorted(own, np.arange(rows.num_rows + 1))
                marked = np.zeros(len(starts) + 1, np.int8)
                for i, m in enumerate(_marked(rows.column("marks"), rows)):
                    marked[base[i] + m // 2] = np.maximum(marked[base[i] + m // 2], 1 + m % 2)
                state = marked[anchor]
                # Neighbouring windows of one anchor are one region; those of a hot gram each stand alone.
                border = np.concatenate(([True], (anchor[1:] != anchor[:-1]) | (at[1:] != at[:-1] + 1) | (state[1:] == 2)))
                head = np.flatnonzero(border & (state > 0))
                edges = np.append(np.flatnonzero(border), len(at))
                tail = edges[np.searchsorted(edges, head, "right")] - 1
                a, b = at[head], at[tail] + window
                words = [buffer[x:y] for x, y in zip(starts.tolist(), ends.tolist())]
                ids, ties = rows.column("id").to_pylist(), rows.column("tie").to_pylist()
                row = own[a]
                for d, i, j, k, s, v in zip(row.tolist(), a.tolist(), b.tolist(), anchor[head].tolist(), state[head].tolist(), value[head].view(np.int64).tolist()):
                    content = b" ".join(words[i:j])
                    digest = xxhash.xxh3_128_digest(content)
                    place = ((ids[d] is not None, ids[d] or 0), ties[d], i - int(base[d]))
                    known = held.get(digest)
                    if known is None:
                        size += len(content) + 200
                    elif known[6] <= place:
                        continue
                    key = v if s == 1 else int.from_bytes(digest[:8], "little", signed=True)
                    held[digest] = (key, ids[d], ties[d], place[2], k - i, content, place)
                if size > HELD_BYTES:
                    yield flush()
                    size = 0
        if held:
            yield flush()

    wanted = marks.select(F.col("id").alias("m_id"), F.col("tie").alias("m_tie"), "marks")
    joined = _zipped(docs).join(wanted, same_keys(["id", "tie"], ["m_id", "m_tie"])).select("id", "tie", "packed", "marks")
    return joined.mapInArrow(cut, "key long, id long, tie long, start int, anchor int, words binary")


def _first_of_equals(batches: Iterator[pa.RecordBatch], *columns: str) -> Iterator[pa.RecordBatch]:
    """Rows that differ from the row before them in one of the columns."""
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        same = np.ones(batch.num_rows, bool)
        for name in columns:
            column = batch.column(name)
            same[1:] &= pa.compute.equal(column[1:], column[:-1]).to_numpy(zero_copy_only=False)
        values = [batch.column(name) for name in columns]
        same[0] = last is not None and all(a == v[0] for a, v in zip(last, values))
        last = [v[-1] for v in values]
        yield batch.filter(pa.array(~same))


def _new_windows(regions: DataFrame, window: int, engine: Engine) -> DataFrame:
    """id, tie and `fresh`: pairs of first word and number of windows that are new, flattened."""

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in runs_of(_first_of_equals(batches, "key", "words", "anchor"), "key"):
            table = table.sort_by([("key", "ascending"), ("known", "ascending"), ("id", "ascending"), ("tie", "ascending"), ("start", "ascending")])
            key = table.column("key").to_numpy()
            border = np.append(np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))), len(key)).tolist()
            place, words = table.column("anchor").to_pylist(), table.column("words").to_pylist()
            start = table.column("start").to_numpy()
            row, first, count = [], [], []
            for a, b in zip(border[:-1], border[1:]):
                if b - a == 1:
                    row.append(a)
                    first.append(0)
                    count.append(words[a].count(b" ") + 2 - window)
                    continue
                for i, new in enumerate(engine([(words[i].split(b" "), place[i]) for i in range(a, b)]), a):
                    edge = np.flatnonzero(np.diff(np.concatenate(([0], new, [0])))).reshape(-1, 2)
                    row += [i] * len(edge)
                    first += edge[:, 0].tolist()
                    count += (edge[:, 1] - edge[:, 0]).tolist()
            at = pa.array(row, pa.int64())
            columns = [table.column(c).combine_chunks().take(at) for c in ("id", "tie")]
            columns += [pa.array(start[row] + np.array(first, np.int32), pa.int32()), pa.array(count, pa.int32())]
            yield pa.record_batch(columns, names=["id", "tie", "first", "count"])

    # Equal regions next to each other, the first in corpus order before the others; null ids come first.
    ordered = regions.withColumn("known", F.col("id").isNotNull().cast("int")).repartition("key").sortWithinPartitions("key", "words", "anchor", "id", "tie", "start")
    found = ordered.mapInArrow(judge, "id long, tie long, first int, count int")
    return found.groupBy("id", "tie").agg(F.collect_list(F.struct("first", "count")).alias("fresh"))


def find_repeats(docs: DataFrame, window: int, gram: int, engine: Engine, hot: int, finish: Callable, schema: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every row's text with the words that repeats cover, given to `finish`.

    `finish(id, words, covered)` gets a row's id, its words as bytes and a mask of the words in
    windows that occur earlier, and returns the rows to put out, as tuples of `schema`.
    """
    need(docs, id_col, text_col)
    slim = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).withColumn("tie", F.xxhash64("text"))
    marks = repeated_anchors(slim, window, gram, hot)
    fresh = _new_windows(_regions(slim, marks, window, gram), window, engine)
    fresh = fresh.select(F.col("id").alias("f_id"), F.col("tie").alias("f_tie"), "fresh")
    known = settle(marks.join(fresh, same_keys(["id", "tie"], ["f_id", "f_tie"]), "left").select(F.col("id").alias("m_id"), F.col("tie").alias("m_tie"), "marks", "fresh"))
    joined = _zipped(slim).join(known, same_keys(["id", "tie"], ["m_id", "m_tie"]), "left").select("id", "packed", "marks", "fresh")

    def cover(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, texts in _opened(batch):
                buffer, data, offsets = _coded(texts)
                starts, ends, own, at, anchor, _ = window_anchors(data, offsets, window, gram)
                base = np.searchsorted(own, np.arange(rows.num_rows + 1))
                marked = np.zeros(len(starts) + 1, bool)
                new = np.zeros(len(starts) + 1, np.int32)
                for i, m in enumerate(_marked(rows.column("marks"), rows)):
                    marked[base[i] + m // 2] = True
                for i, f in enumerate(rows.column("fresh").to_pylist()):
                    if f:
                        first = np.array([x["first"] for x in f]) + base[i]
                        np.add.at(new, first, 1)
                        np.add.at(new, first + np.array([x["count"] for x in f]), -1)
                again = at[marked[anchor] & (np.cumsum(new)[at] == 0)] if len(at) else at
                hit = np.zeros(len(starts) + 1, np.int32)
                np.add.at(hit, again, 1)
                np.add.at(hit, again + window, -1)
                covered = np.cumsum(hit)[:-1] > 0
                words = [buffer[x:y] for x, y in zip(starts.tolist(), ends.tolist())]
                out = []
                for i, doc in enumerate(rows.column("id").to_pylist()):
                    out += finish(doc, words[base[i] : base[i + 1]], covered[base[i] : base[i + 1]])
                if out:
                    yield pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in out], arrow)

    kinds = {"long": pa.int64(), "string": pa.string()}
    names = [p.split()[0] for p in schema.split(",")]
    arrow = pa.schema([(p.split()[0], kinds[p.split()[1]]) for p in schema.split(",")])
    return joined.mapInArrow(cover, schema)
