"""Periodic runs of words, from maximal pairs in the LCP-interval tree of each text.

A run is a stretch of consecutive words that repeats with smallest period q and that no
neighbouring word extends; it counts from `least_words` words and `least_exponent` periods on.

A run of period q and length L is two occurrences, q words apart, of the same L - q words, whose
words before and after differ: a maximal pair. Pairs are read off the suffix array: suffixes are
sorted by prefix doubling, and the intervals of suffixes that share their first words are visited
bottom-up. Every interval holds its suffixes as class lists, a class being the word to the left,
laid out in one order of position; when intervals meet, the smaller lists are put into the
largest, and each place is compared with its neighbours of another child and another class.
Looking at neighbours is enough: an occurrence in between would give the pair's words a shorter
period, and then the stretch has that period too and belongs to that pair. For the same reason
the distance of such a pair is the smallest period, and nothing is extended afterwards.

Texts are sorted together in slices, so the work is array operations except for the tree, which
only holds suffixes that share enough words with another one. A text is never split.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftloom.llm.common import fresh_name, need, ragged, sliced

LEAST_WORDS = 6
LEAST_EXPONENT = 4
_RUN = "struct<start:bigint,length:bigint,period:bigint>"
_FOUND = f"struct<n_words:bigint,runs:array<{_RUN}>,strongest:{_RUN},collapsed:string>"


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The runs of bytes outside blanks (0x20, 0x09-0x0D) of all texts, and the borders of the texts among them. Null has none."""
    lists = pc.ascii_split_whitespace(texts.cast(pa.string()).fill_null(""))
    flat = lists.flatten()
    real = pc.greater(pc.binary_length(flat), 0)
    borders = lists.offsets.to_numpy() - lists.offsets[0].as_py()
    upto = np.concatenate(([0], np.cumsum(real.to_numpy(zero_copy_only=False))))
    return flat.filter(real), upto[borders]


def suffix_ranks(codes: np.ndarray, borders: np.ndarray) -> list[np.ndarray]:
    """Prefix doubling: entry k ranks every suffix by its first 2^k words within its text; in the last, all ranks differ.

    A rank is the place of the first suffix of its group in the order so far. A suffix that ends
    before 2^k words comes before the others of its group and is alone.
    """
    n = len(codes)
    sizes = np.diff(borders)
    stop = np.repeat(borders[1:], sizes)
    rank = np.zeros(n, np.int64)
    text = np.repeat(np.arange(len(sizes)), sizes)
    tied, second = np.arange(n), text * (int(codes.max(initial=0)) + 1) + codes
    levels, step = [], 0
    while True:
        key = second if not step else rank[tied] * (n + 1) + second
        order = np.argsort(key, kind="stable")
        key, tied = key[order], tied[order]
        head = rank[tied]
        new = np.ones(len(tied), bool)
        new[1:] = key[1:] != key[:-1]
        old = np.ones(len(tied), bool)
        old[1:] = head[1:] != head[:-1]
        at = np.arange(len(tied))
        first_new, first_old = np.maximum.accumulate(np.where(new, at, 0)), np.maximum.accumulate(np.where(old, at, 0))
        rank[tied] = head + first_new - first_old
        levels.append(rank.astype(np.int32) if n < 1 << 31 else rank.copy())
        alone = new & np.append(new[1:], True)
        tied = np.sort(tied[~alone])
        if not len(tied):
            return levels
        step = step * 2 or 1
        ahead = tied + step
        inside = ahead < stop[tied]
        second = np.where(inside, rank[np.minimum(ahead, n - 1)] + 1, 0)


def shared_words(levels: list[np.ndarray], borders: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Number of words that the suffixes at a and b have in common from their start on."""
    stop = np.repeat(borders[1:], np.diff(borders))
    stop_a, stop_b = stop[a], stop[b]
    common = np.zeros(len(a), np.int64)
    last = len(stop) - 1
    for k in range(len(levels) - 1, -1, -1):
        i, j = a + common, b + common
        same = (i < stop_a) & (j < stop_b) & (levels[k][np.minimum(i, last)] == levels[k][np.minimum(j, last)])
        common[same] += 1 << k
    return common


def _join_children(words: int, children: list[list[int]], left: list[int], fits, found: list[tuple[int, int, int]]) -> list[int]:
    """The class lists of an interval from those of its children, in order of position; notes its pairs."""
    children.sort(key=len, reverse=True)
    home = children[0]
    put = {}
    for k, places in enumerate(children[1:], 1):
        for place in places:
            put[place] = k
            insort(home, place)
    for place, k in put.items():
        at = bisect_left(home, place)
        if at + 1 < len(home):
            after = home[at + 1]
            if put.get(after, 0) != k and fits(words, after - place) and left[place] != left[after]:
                found.append((place, words + after - place, after - place))
        if at:
            before = home[at - 1]
            if before not in put and fits(words, place - before) and left[place] != left[before]:
                found.append((before, words + place - before, place - before))
    return home


def maximal_pairs(
    codes: np.ndarray, borders: np.ndarray, least_words: int = LEAST_WORDS, least_exponent: int = LEAST_EXPONENT
) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run of all texts, places counted over all of them."""
    if least_exponent < 3:
        raise ValueError("neighbours in a class list are enough from three periods on")
    if not len(codes):
        return []
    levels = suffix_ranks(codes, borders)
    order = np.empty(len(codes), np.int64)
    order[levels[-1]] = np.arange(len(codes))
    # A pair of period q shares at least (least_exponent - 1) * q words, and least_words - q.
    fewest = max(1, -(-least_words * (least_exponent - 1) // least_exponent))
    common = np.zeros(len(codes), np.int64)
    coarse = min(len(levels) - 1, fewest.bit_length() - 1)
    near = np.flatnonzero(levels[coarse][order[1:]] == levels[coarse][order[:-1]])
    common[near] = shared_words(levels, borders, order[near], order[near + 1])
    inside = common >= fewest
    used = inside.copy()
    used[1:] |= inside[:-1]
    left = np.full(len(codes), -1, np.int64)
    left[1:] = codes[:-1]
    left[borders[:-1][np.diff(borders) > 0]] = -1

    def fits(words: int, gap: int) -> bool:
        return gap * (least_exponent - 1) <= words and words + gap >= least_words

    found: list[tuple[int, int, int]] = []
    words_left = left.tolist()
    stack: list[tuple[int, list[list[int]]]] = []
    for place, words in zip(order[used].tolist(), np.where(inside, common, 0)[used].tolist()):
        below = [place]
        while stack and stack[-1][0] > words:
            held, children = stack.pop()
            children.append(below)
            below = _join_children(held, children, words_left, fits, found)
        if not words:
            continue
        if stack and stack[-1][0] == words:
            stack[-1][1].append(below)
        else:
            stack.append((words, [below]))
    return found


def _text_runs(texts: pa.Array, least_words: int, least_exponent: int) -> pa.StructArray:
    """What `with_runs` adds, for a batch of texts."""
    words, borders = split_words(texts)
    coded = words.dictionary_encode()
    codes = coded.indices.to_numpy().astype(np.int64)
    pairs = np.array(maximal_pairs(codes, borders, least_words, least_exponent), np.int64).reshape(-1, 3)
    pairs = pairs[np.lexsort((pairs[:, 2], pairs[:, 0]))]
    start, length, period = pairs.T
    text = np.searchsorted(borders, start, side="right") - 1
    own = start - borders[text]
    repeated = np.zeros(len(codes) + 1, np.int64)
    np.add.at(repeated, start + period, 1)
    np.add.at(repeated, start + length, -1)
    kept = np.flatnonzero(np.cumsum(repeated[:-1]) == 0)
    spoken = coded.dictionary.take(coded.indices.take(pa.array(kept)))
    collapsed = pc.binary_join(pa.ListArray.from_arrays(np.searchsorted(kept, borders).astype(np.int32), spoken), " ")
    run = [pa.field(c, pa.int64()) for c in ("start", "length", "period")]
    runs = pa.ListArray.from_arrays(
        np.searchsorted(text, np.arange(len(texts) + 1)).astype(np.int32),
        pa.StructArray.from_arrays([pa.array(own), pa.array(length), pa.array(period)], fields=run),
    )
    best: list[dict | None] = [None] * len(texts)
    for k, s, n, q in zip(text.tolist(), own.tolist(), length.tolist(), period.tolist()):
        held = best[k]
        if held is None or n * held["period"] > held["length"] * q:  # in order of start, then period: ties stay
            best[k] = {"start": s, "length": n, "period": q}
    strongest = pa.array(best, pa.struct(run))
    return pa.StructArray.from_arrays([pa.array(np.diff(borders)), runs, strongest, collapsed], names=["n_words", "runs", "strongest", "collapsed"])


def with_runs(
    docs: DataFrame, text_col: str = "text", least_words: int = LEAST_WORDS, least_exponent: int = LEAST_EXPONENT
) -> tuple[DataFrame, str]:
    """The documents with one more column, and its name: a struct of what their whole texts hold.

    `n_words`; `runs`, by start and then period; `strongest`, the run with the greatest length
    in periods (ties: smallest start, then period; null without a run); `collapsed`, the words
    joined by one blank, without those that a run repeats after its first period.

    A null or empty text has no words, no runs and an empty `collapsed`. Rows stay as they are,
    repeated ones and ones without an id too; the column is called `periodic`, with underscores
    after it where the frame has one of that name. An empty frame gives an empty one.
    """
    need(docs, text_col)
    name = fresh_name(docs, "periodic")

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, text_col):
            found = _text_runs(batch.column(text_col), least_words, least_exponent)
            yield pa.record_batch([*batch.columns, found], names=[*batch.schema.names, name])

    schema = T.StructType([*docs.schema.fields, T.StructField(name, T._parse_datatype_string(_FOUND))])
    return docs.mapInArrow(find, schema), name


def plant_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Id and text, one text in ten (by the crc32 of its id) made periodic from one of its words on.

    With h the crc32 and g = h / 10 rounded down: where 10 divides h, each word from number
    a = g % n on becomes word a + (i - a) % p, p = 1 + (n - a) / (3 + g % 8) rounded down. Such a
    text's words are joined by one blank. A null id, a null text and one without words stay.
    """
    need(docs, id_col, text_col)
    h = F.crc32(F.col(id_col).cast("string").cast("binary"))
    words = F.regexp_extract_all(F.col(text_col), F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    chosen = docs.select(F.col(id_col).alias(id_col), F.col(text_col).alias("text"), h.alias("__h"))
    picked = chosen.select(id_col, "text", F.floor(F.col("__h") / 10).alias("__g"), F.when(F.col("__h") % 10 == 0, words).alias("__w"))
    measured = picked.withColumn("__a", F.when(F.size("__w") > 0, F.col("__g") % F.size("__w")))
    period = 1 + F.floor((F.size("__w") - F.col("__a")) / (3 + F.col("__g") % 8))
    placed = measured.withColumn("__p", period)

    def word(i):
        at = F.when(i < F.col("__a"), i).otherwise(F.col("__a") + (i - F.col("__a")) % F.col("__p"))
        return F.col("__w")[at.cast("int")]

    turned = F.array_join(F.transform(F.sequence(F.lit(0), F.size("__w") - 1), word), " ")
    return placed.select(id_col, F.when(F.col("__a").isNotNull(), turned).otherwise(F.col("text")).alias("text"))


def periodic_report(docs: DataFrame) -> DataFrame:
    """doc_id, n_runs, the strongest run (start, length, period, exponent_milli; null without one) and two digests per document.

    Of the texts that `plant_runs` makes. `runs_sha256` is of every run's `start,length,period`
    and a line feed, `collapsed_sha256` of the collapsed text; both are of an empty text where
    there is nothing. Cases as in `with_runs`.
    """
    found, name = with_runs(plant_runs(docs))
    best = F.col(name)["strongest"]
    listed = F.transform(F.col(name)["runs"], lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n")))
    return found.select(
        "doc_id",
        F.size(F.col(name)["runs"]).cast("long").alias("n_runs"),
        best["start"].alias("start"),
        best["length"].alias("length"),
        best["period"].alias("period"),
        F.floor(F.lit(1000) * best["length"] / best["period"]).alias("exponent_milli"),
        F.sha2(F.array_join(listed, ""), 256).alias("runs_sha256"),
        F.sha2(F.col(name)["collapsed"], 256).alias("collapsed_sha256"),
    )
