"""Simple-8b: unsigned integers packed into 64-bit words, and the file layout that holds them.

A word's upper four bits select how many values of how many bits its lower sixty hold. Values of
more than sixty bits are escapes: their word holds a place in a list of raw values. Values are
cut into blocks of `BLOCK`; the index gives every block's first word, so blocks decode on their
own and all words of a file decode with array operations.

A file is little-endian: a header of eight 64-bit numbers (magic, documents, values, words,
escapes, block size, crc32 of what follows, zero), then document ids, flags of null ids,
values per document, first word of each block (and the number of words), words, escapes.
"""

from __future__ import annotations

import zlib

import numpy as np

MAGIC = 0x31_42_38_53_4C_44_4B_54
BLOCK = 4096
# How many values a selector packs, and of how many bits. Selector 0 is an escape.
COUNT = np.array([1, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1], np.int64)
BITS = np.array([60, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60], np.uint64)
PAD = 64
BLOCKS_AT_ONCE = 256
_WIDTH = np.frexp(np.arange(1 << 16, dtype=np.float64))[1].clip(1).astype(np.uint8)


def _widths(values: np.ndarray) -> np.ndarray:
    """Bits that each value needs, at least one."""
    if values.max(initial=0) < len(_WIDTH):
        return _WIDTH[values]
    low, high = values & np.uint64(0xFFFFFFFF), values >> np.uint64(32)
    bits = lambda x: np.frexp(x.astype(np.float64))[1]
    return np.maximum(1, np.where(high > 0, 32 + bits(high), bits(low))).astype(np.uint8)


def _selectors(widths: np.ndarray) -> np.ndarray:
    """For each place the selector that packs the most values from there on; the last PAD columns are padding."""
    long = widths.shape[1]
    at_most = {1: widths}
    for p in (1, 2, 4, 8, 16):
        m = at_most[p].copy()
        np.maximum(m[:, : long - p], m[:, p:], out=m[:, : long - p])
        at_most[2 * p] = m
    chosen = np.where(widths > 60, 0, 14).astype(np.uint8)
    for k in range(13, 0, -1):
        n, p = int(COUNT[k]), 1 << (int(COUNT[k]).bit_length() - 1)
        m = at_most[p].copy()
        if n > p:
            np.maximum(m[:, : long - (n - p)], m[:, n - p :], out=m[:, : long - (n - p)])
        chosen[m <= BITS[k]] = k
    return chosen


def encode(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words, first word of each block (and their number), and raw escaped values."""
    values = np.asarray(values)
    n_blocks = -(-len(values) // BLOCK)
    words, counts, escapes = [], [], []
    n_escapes = 0
    for first in range(0, n_blocks, BLOCKS_AT_ONCE):
        part = np.ascontiguousarray(values[first * BLOCK : (first + BLOCKS_AT_ONCE) * BLOCK], np.uint64)
        nb = -(-len(part) // BLOCK)
        room = np.zeros((nb, BLOCK + PAD), np.uint64)
        flat = room.reshape(-1)
        filled = np.zeros(nb * BLOCK, np.uint64)
        filled[: len(part)] = part
        room[:, :BLOCK] = filled.reshape(nb, BLOCK)
        del filled
        size = np.minimum(BLOCK, len(part) - np.arange(nb) * BLOCK)
        chosen = _selectors(_widths(room))
        # All blocks step from word to word together.
        at, rows, steps = np.zeros(nb, np.int64), np.arange(nb), []
        while (open_ := at < size).any():
            pick = chosen[rows, np.minimum(at, BLOCK)]
            steps.append(np.where(open_, at * 16 + pick, -1))
            at = np.where(open_, at + COUNT[pick], at)
        seen = np.array(steps).T
        block, _ = np.nonzero(seen >= 0)
        packed = seen[seen >= 0]
        place, pick = packed // 16, packed % 16
        out = pick.astype(np.uint64) << np.uint64(60)
        for k in np.unique(pick):
            mine = np.flatnonzero(pick == k)
            if k == 0:
                raw = room[block[mine], place[mine]]
                out[mine] |= np.arange(n_escapes, n_escapes + len(raw), dtype=np.uint64)
                escapes.append(raw)
                n_escapes += len(raw)
                continue
            at = block[mine] * (BLOCK + PAD) + place[mine]
            held = flat[at]
            for j in range(1, COUNT[k]):
                held |= flat[at + j] << (BITS[k] * np.uint64(j))
            out[mine] |= held
        words.append(out)
        counts.append(np.bincount(block, minlength=nb))
    none = np.zeros(0, np.uint64)
    offsets = np.concatenate(([0], np.cumsum(np.concatenate(counts)))) if counts else np.zeros(1, np.int64)
    return np.concatenate(words or [none]), offsets.astype(np.int64), np.concatenate(escapes or [none])


def decode(words: np.ndarray, offsets: np.ndarray, escapes: np.ndarray, n: int, block: int = BLOCK) -> np.ndarray:
    """The values again, all words of a few hundred blocks at once."""
    out = np.zeros(n, np.uint64)
    for first in range(0, len(offsets) - 1, BLOCKS_AT_ONCE):
        own = offsets[first : first + BLOCKS_AT_ONCE + 1]
        some = out[first * block : (first + BLOCKS_AT_ONCE) * block]
        some[:] = _decoded(words[own[0] : own[-1]], own - own[0], escapes, len(some), block)
    return out


def _decoded(words: np.ndarray, offsets: np.ndarray, escapes: np.ndarray, n: int, block: int) -> np.ndarray:
    out = np.zeros(n, np.uint64)
    if not n:
        return out
    pick = (words >> np.uint64(60)).astype(np.int64)
    held = COUNT[pick]
    before = np.concatenate(([0], np.cumsum(held)))
    own = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    place = own * block + before[:-1] - before[offsets[:-1]][own]
    end = np.minimum((own + 1) * block, n)
    low = words & np.uint64((1 << 60) - 1)
    for k in np.unique(pick):
        mine = np.flatnonzero(pick == k)
        if k == 0:
            out[place[mine]] = escapes[low[mine].astype(np.int64)]
            continue
        step = np.arange(COUNT[k])
        got = (low[mine][:, None] >> (BITS[k] * step.astype(np.uint64))) & np.uint64((1 << int(BITS[k])) - 1)
        to = place[mine][:, None] + step
        inside = to < end[mine][:, None]
        out[to[inside]] = got[inside]
    return out


def pack_file(doc_ids: np.ndarray, null_ids: np.ndarray, sizes: np.ndarray, values: np.ndarray) -> bytes:
    words, offsets, escapes = encode(values)
    body = b"".join(
        x.astype(kind).tobytes()
        for x, kind in ((doc_ids, "<i8"), (null_ids, "<i8"), (sizes, "<i8"), (offsets, "<i8"), (words, "<u8"), (escapes, "<u8"))
    )
    head = np.array([MAGIC, len(doc_ids), len(values), len(words), len(escapes), BLOCK, zlib.crc32(body), 0], "<u8")
    return head.tobytes() + body


def unpack_file(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Document ids, flags of null ids, values per document, values; raises where the file is damaged."""
    head = np.frombuffer(data, "<u8", 8)
    docs, n, n_words, n_escapes, block = (int(x) for x in head[1:6])
    if int(head[0]) != MAGIC or zlib.crc32(data[64:]) != int(head[6]):
        raise ValueError("not a whole token file")
    numbers = np.frombuffer(data, "<i8", 3 * docs, 64)
    at = 64 + 24 * docs
    n_blocks = -(-n // block)
    offsets = np.frombuffer(data, "<i8", n_blocks + 1, at)
    at += 8 * (n_blocks + 1)
    words = np.frombuffer(data, "<u8", n_words, at)
    escapes = np.frombuffer(data, "<u8", n_escapes, at + 8 * n_words)
    ids, nulls, sizes = numbers.reshape(3, docs) if docs else (numbers,) * 3
    return ids, nulls, sizes, decode(words, offsets, escapes, n, block)
