"""Benchmark decontamination with an Aho-Corasick automaton over the benchmark's word windows.

Texts and items are normalised alike: A-Z lower-cased, words are runs of digits, letters and
bytes outside ASCII. A window is `window` consecutive words of an item, or the whole item where
it has fewer. One automaton holds all windows; each text is scanned by it once, and the matches
are mapped back to word numbers and to character offsets of the original text.

The automaton is built in the Python workers from a broadcast list of windows. A list is at most
`block_bytes` long; a larger benchmark is cut into several lists, which scan in turn, each
adding to what the ones before found. Nothing is shuffled.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftloom.llm.common import fresh_name, need, ragged, sliced, text_bytes, word_bounds

WINDOW = 13
#: Contaminated from one hit word in this many.
ONE_IN = 20
BLOCK_BYTES = 2 << 20
WORDS = bytes(c + 32 if 0x41 <= c <= 0x5A else c if c >= 0x80 or 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A else 0x20 for c in range(256))
SPAN = "struct<first_word:bigint,last_word:bigint,start:bigint,stop:bigint>"
FOUND = f"struct<n_words:bigint,n_hit:bigint,items:array<string>,spans:array<{SPAN}>>"
_AUTOMATA: dict = {}


def item_windows(items: DataFrame, item_col: str = "item_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """Distinct windows as `words` with the sorted ids of their items.

    Items without words have none. The windows of an item without an id hit like any others;
    only the list of ids cannot name it.
    """
    need(items, item_col, text_col)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple[str, bytes]] = []
            for item, text in zip(batch.column("item").to_pylist(), batch.column("text").to_pylist()):
                words = text.encode().translate(WORDS).split()
                size = min(window, len(words))
                out += [(item, b" ".join(words[i : i + size])) for i in range(len(words) - size + 1) if size]
            yield pa.record_batch([pa.array([x for x, _ in out], pa.string()), pa.array([w for _, w in out], pa.binary())], names=["item", "words"])

    slim = items.select(F.col(item_col).cast("string").alias("item"), F.col(text_col).alias("text")).filter("text IS NOT NULL")
    cuts = slim.mapInArrow(cut, "item string, words binary")
    return cuts.groupBy("words").agg(F.array_sort(F.collect_set("item")).alias("items"))


def window_blocks(windows: DataFrame, block_bytes: int = BLOCK_BYTES) -> Iterator[list[tuple[bytes, list[str]]]]:
    """The windows in lists of about `block_bytes`, one on the driver at a time."""
    size = F.length("words") + F.coalesce(F.aggregate("items", F.lit(0), lambda n, x: n + F.length(x) + 8), F.lit(0))
    total = windows.agg(F.sum(size)).first()[0] or 0
    n = -(-total // block_bytes)
    for k in range(n):
        rows = windows.filter(F.pmod(F.xxhash64("words"), F.lit(n)) == k).collect()
        if rows:
            yield sorted((bytes(r.words), list(r["items"])) for r in rows)


def _automaton(broadcast):
    """The block's automaton, built once in a Python worker; and its windows' word counts, byte lengths and items."""
    key, windows = broadcast.value
    if key not in _AUTOMATA:
        import ahocorasick

        tree = ahocorasick.Automaton()
        for k, (words, _) in enumerate(windows):
            tree.add_word((words + b" ").decode("latin-1"), k)
        tree.make_automaton()
        sizes = np.array([w.count(b" ") + 1 for w, _ in windows])
        _AUTOMATA.clear()
        _AUTOMATA[key] = tree, sizes, np.array([len(w) + 1 for w, _ in windows]), windows
    return _AUTOMATA[key]


def _scan(column: pa.Array, earlier: list[dict] | None, broadcast) -> list[dict]:
    """One block's findings for a slice of texts, joined with those of earlier blocks."""
    raw, offsets = text_bytes(column)
    data = np.frombuffer(raw.translate(WORDS), np.uint8)
    starts, ends = word_bounds(data, offsets)
    own = np.searchsorted(offsets, starts, "right") - 1
    n_words = np.bincount(own, minlength=len(column))
    out = earlier or [{"n_words": n, "n_hit": 0, "items": [], "spans": []} for n in n_words.tolist()]
    if broadcast is None or not len(starts):
        return out
    tree, sizes, lengths, windows = _automaton(broadcast)
    flat = data[np.minimum(ragged(starts, ends - starts + 1), len(data) - 1)]
    blank = np.cumsum(ends - starts + 1) - 1
    flat[blank] = 0x20
    found = np.array(list(tree.iter(flat.tobytes().decode("latin-1"))), np.int64).reshape(-1, 2)
    last, which = np.searchsorted(blank, found[:, 0]), found[:, 1]
    first = last - sizes[which] + 1
    whole = first >= 0
    first, last, which, at = first[whole], last[whole], which[whole], found[whole, 0]
    whole = (own[first] == own[last]) & (blank[first] - (ends - starts)[first] == at - lengths[which] + 1)
    first, last, which = first[whole], last[whole], which[whole]
    base = np.concatenate(([0], np.cumsum(n_words)))
    for doc in np.unique(own[first]).tolist():
        mine = own[first] == doc
        before = out[doc]
        items = set(before["items"]).union(*(windows[k][1] for k in np.unique(which[mine]).tolist()))
        hit = np.zeros(int(n_words[doc]) + 1, np.int64)
        np.add.at(hit, first[mine] - base[doc], 1)
        np.add.at(hit, last[mine] - base[doc] + 1, -1)
        hit = np.cumsum(hit)[:-1] > 0
        for s in before["spans"]:
            hit[s["first_word"] : s["last_word"] + 1] = True
        edge = np.flatnonzero(np.diff(np.concatenate(([False], hit, [False])).astype(np.int8))).reshape(-1, 2)
        char = np.cumsum((np.frombuffer(raw, np.uint8)[offsets[doc] : offsets[doc + 1]] & 0xC0) != 0x80)
        where = lambda byte, doc=doc, char=char: int(char[byte - offsets[doc] - 1]) if byte > offsets[doc] else 0
        spans = [
            {"first_word": a, "last_word": b - 1, "start": where(starts[base[doc] + a]), "stop": where(ends[base[doc] + b - 1])}
            for a, b in edge.tolist()
        ]
        out[doc] = {"n_words": before["n_words"], "n_hit": int(hit.sum()), "items": sorted(items), "spans": spans}
    return out


def find_contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    block_bytes: int = BLOCK_BYTES,
) -> tuple[DataFrame, str]:
    """The documents with one more column, and its name: words, hit words, items found, and the hit spans.

    Spans count words and characters of the original text, `stop` and not `last_word` being
    exclusive. Every row is kept, repeated rows each for themselves; a null or empty text has
    no words; with no benchmark rows nothing is hit. The new column is called `contamination`,
    with underscores after it where the frame has one of that name.
    """
    need(docs, text_col)
    name = fresh_name(docs, "contamination")
    kind = T._parse_datatype_string(FOUND)
    context = docs.sparkSession.sparkContext
    blocks = [context.broadcast((uuid.uuid4().hex, x)) for x in window_blocks(item_windows(benchmark, item_col, item_text_col, window), block_bytes)] or [None]
    span = pa.struct([(x, pa.int64()) for x in ("first_word", "last_word", "start", "stop")])
    arrow = pa.struct([("n_words", pa.int64()), ("n_hit", pa.int64()), ("items", pa.list_(pa.string())), ("spans", pa.list_(span))])
    marked = docs
    for block in blocks:

        def scan(batches: Iterator[pa.RecordBatch], block=block) -> Iterator[pa.RecordBatch]:
            for batch in sliced(batches, text_col):
                known = name in batch.schema.names
                rows = _scan(batch.column(text_col), batch.column(name).to_pylist() if known else None, block)
                kept = [c for c in batch.schema.names if c != name]
                yield pa.record_batch([*[batch.column(c) for c in kept], pa.array(rows, arrow)], names=[*kept, name])

        marked = marked.mapInArrow(scan, T.StructType([*docs.schema.fields, T.StructField(name, kind)]))
    return marked, name


def is_contaminated(found: Column, one_in: int = ONE_IN) -> Column:
    """At least one hit word, and at least one in `one_in` words."""
    return (found["n_hit"] > 0) & (F.lit(one_in) * found["n_hit"] >= found["n_words"])


def contamination_report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated: one row per document."""
    marked, name = find_contamination(docs.select("doc_id", "text"), benchmark)
    found = F.col(name)
    return marked.select(
        "doc_id",
        found["n_words"].alias("n_words"),
        found["n_hit"].alias("n_hit"),
        F.size(found["items"]).cast("long").alias("n_items"),
        F.sha2(F.array_join(found["items"], ",").cast("binary"), 256).alias("items_sha256"),
        is_contaminated(found).alias("contaminated"),
    )


def without_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that are not contaminated, with their own columns."""
    marked, name = find_contamination(docs, benchmark)
    return marked.filter(~is_contaminated(F.col(name))).select(*docs.columns)
