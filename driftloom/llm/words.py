"""Encoding texts by their distinct words, for tokenizers that never join across white space."""

from __future__ import annotations

import json
import os
import re
from itertools import chain
from unicodedata import is_normalized

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc

from driftloom.llm.common import LOWER_AND_BLANKS, ragged, text_bytes, word_bounds

#: Words whose ids a Python worker keeps; when there are more, those met in one slice of texts only are forgotten.
KEPT_WORDS = 400_000
#: As many ids are kept for each of these words, taken together.
IDS_PER_WORD = 32
#: The first code point after the Latin letters that every Unicode version knows alike.
BEYOND_LATIN = 0x250
_LATIN = "".join(c for c in map(chr, range(BEYOND_LATIN)) if c.isalpha() and c == c.lower() and is_normalized("NFC", c))
#: Composed lower-case Latin letters, then ASCII marks: two pieces, which neither normalizer nor splitting changes. No apostrophe: some are pieces with letters.
_MARKS = "!-&(-/:-@\\[-`{-~"
PIECES = re.compile(f"([{_LATIN}]+)([{_MARKS}]*)")
#: The first byte of U+00C0 to U+00FF in UTF-8. Kinds of bytes: a-z or that one, marks, and after it the second byte of small and of capital letters.
LATIN_1 = 0xC3
_LETTER = np.array([0x61 <= c <= 0x7A or c == LATIN_1 for c in range(256)])
_MARK = np.array([bool(re.match(f"[{_MARKS}]", chr(c))) for c in range(256)])
_SMALL = np.array([0x80 <= c < 0xC0 and chr(c + 0x40) in _LATIN for c in range(256)])
_CAPITAL = np.array([0x80 <= c < 0xA0 and chr(c + 0x40).lower() != chr(c + 0x40) for c in range(256)])
#: The characters that stand for bytes in byte-level vocabularies, as UTF-16; a blank stays a blank.
_SHOWN = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
_CHARACTER = np.zeros(256, "<u2")
_CHARACTER[_SHOWN + sorted(set(range(256)) - set(_SHOWN))] = _SHOWN + list(range(0x100, 0x200 - len(_SHOWN)))
_CHARACTER[0x20] = 0x20
#: Pieces up to this length are hashed eight bytes at a time.
LONG_PIECE = 64
_FIRST_BYTES = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
_rng = np.random.default_rng(0x5EED)
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_PLACE = _rng.integers(1, 1 << 63, 1 << 12, dtype=np.uint64) | np.uint64(1)


def word_hashes(flat: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of words that follow one another in a buffer (multilinear in bytes and length), and a check: length, first and last byte."""
    if not len(lengths):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    last = np.cumsum(lengths)
    first = last - lengths
    place = np.arange(len(flat), dtype=np.int32)
    place -= np.repeat(first.astype(np.int32), lengths)
    if lengths.max() <= len(_PLACE):
        value = _PLACE[place]
    else:
        value = _PLACE[place & 0xFFF]
        value += (place >> 12).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    value *= _BYTE[flat]
    hashes = np.add.reduceat(value, first) + lengths.astype(np.uint64) * _BYTE[0]
    return hashes, (lengths << 16) | (flat[first].astype(np.int64) << 8) | flat[last - 1]


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def piece_hashes(buffer: bytes, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of pieces of a buffer, eight bytes at a time, and a check: length, first and last byte.

    Pieces of more than `LONG_PIECE` bytes have the hash of `word_hashes`.
    """
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    data, size = np.frombuffer(buffer, np.uint8), ends - starts
    eight = np.ndarray((len(buffer),), "<u8", buffer + bytes(8), strides=(1,))
    hashes = mixed(size.astype(np.uint64) ^ mixed(eight[starts] & _FIRST_BYTES[np.minimum(size, 8)]))
    for done in range(8, LONG_PIECE, 8):
        more = np.flatnonzero((size > done) & (size <= LONG_PIECE))
        if not len(more):
            break
        hashes[more] = mixed(hashes[more] ^ (eight[starts[more] + done] & _FIRST_BYTES[np.minimum(size[more] - done, 8)]))
    long = np.flatnonzero(size > LONG_PIECE)
    if len(long):
        hashes[long] = word_hashes(data[ragged(starts[long], size[long])], size[long])[0]
    return hashes, (size << 16) | (data[starts].astype(np.int64) << 8) | data[ends - 1]


def joins_no_words(path: str) -> bool:
    """Whether a tokenizer file is of the kind that can be encoded word by word: BPE with word ends, lower-casing, dropping blanks."""
    with open(path, encoding="utf-8") as source:
        described = json.load(source)
    model, normal, split = (described.get(k) or {} for k in ("model", "normalizer", "pre_tokenizer"))
    if model.get("type", "BPE") != "BPE" or model.get("end_of_word_suffix") != "</w>" or model.get("continuing_subword_prefix"):
        return False
    steps = normal.get("normalizers", [normal])
    whole = json.dumps(split)
    return any(s.get("type") == "Lowercase" for s in steps) and "Removed" in whole and all(
        s.get("type") in ("Lowercase", "NFC", "Replace") for s in steps
    )


def _spaced(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The bytes of words of a buffer, a blank after each."""
    sizes = ends - starts + 1
    text = data[np.minimum(ragged(starts, sizes), len(data) - 1)]
    text[np.cumsum(sizes) - 1] = 0x20
    return text


def _byte_level(text: np.ndarray) -> str:
    """The text in which a byte-level vocabulary spells these bytes."""
    return _CHARACTER[text].tobytes().decode("utf-16-le")


class HashedNumbers:
    """Numbers from 0 on under distinct 64-bit hashes, put and found many at a time: open addressing, at most half full."""

    def __init__(self, room: int = 1 << 12):
        self._empty(room)

    def _empty(self, room: int) -> None:
        self.hash, self.number, self.n = np.zeros(room, np.uint64), np.full(room, -1, np.int32), 0

    def _places(self, hashes: np.ndarray) -> np.ndarray:
        return (hashes & np.uint64(len(self.hash) - 1)).astype(np.int64)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """The number under each hash, or -1."""
        at = self._places(hashes)
        found = self.number[at].astype(np.int64)
        left = np.flatnonzero((found >= 0) & (self.hash[at] != hashes))
        while len(left):
            next_ = at[left] = (at[left] + 1) % len(self.hash)
            found[left] = self.number[next_]
            left = left[(found[left] >= 0) & (self.hash[next_] != hashes[left])]
        return found

    def put(self, hashes: np.ndarray, numbers: np.ndarray) -> None:
        """Distinct numbers under distinct hashes that are not there yet."""
        room = len(self.hash)
        while 2 * (self.n + len(hashes)) > room:
            room *= 2
        if room > len(self.hash):
            held = self.held()
            self._empty(room)
            self.put(*held)
        self.n += len(hashes)
        at = self._places(hashes)
        while len(hashes):
            free = self.number[at] < 0
            self.number[at[free]] = numbers[free]
            # Of several that meet in one free place, the last one has it.
            done = free & (self.number[at] == numbers)
            self.hash[at[done]] = hashes[done]
            hashes, numbers, at = hashes[~done], numbers[~done], (at[~done] + 1) % room

    def held(self) -> tuple[np.ndarray, np.ndarray]:
        """All hashes and their numbers."""
        full = np.flatnonzero(self.number >= 0)
        return self.hash[full], self.number[full].astype(np.int64)


def _letters_before_marks(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which words are small letters a-z or of Latin-1, then marks or nothing; and where those words' marks start (their end, if none)."""
    size = ends - starts
    first = np.cumsum(size) - size
    some = data[ragged(starts, size)]
    mark, letter = _MARK[some], _LETTER[some]
    letter[1:] |= (some[:-1] == LATIN_1) & _SMALL[some[1:]]
    wrong = ~(letter | mark)
    wrong[1:] |= mark[:-1] & letter[1:]
    wrong[first] = ~letter[first]
    easy = ~np.logical_or.reduceat(wrong, first) if len(first) else np.zeros(0, bool)
    return easy, ends - (np.add.reduceat(mark, first, dtype=np.int64) if len(first) else size)


class WordEncoder:
    """Ids of whole texts from the ids of their words; of files that do not allow it (`joins_no_words`), by encoding whole texts.

    For BPE files with word ends that drop white space: a text's ids are those of its blank-separated
    pieces, one after the other, and lower case is folded by the tokenizer itself. Each distinct piece
    is encoded once. Texts that hold the start of a special token (`<|`) are encoded whole. Equal
    pieces are found by a 64-bit hash; pieces with one hash that differ in length, first or last byte raise an error.
    """

    def __init__(self, path: str, kept: int = KEPT_WORDS):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, pre_tokenizers

        self.whole = Tokenizer.from_file(path)
        self.by_words = joins_no_words(path)
        # The same model without normalizer and splitting, for words that those leave as they are, given in byte-level characters.
        self.plain = Tokenizer.from_file(path)
        self.plain.normalizer = None
        self.plain.pre_tokenizer = pre_tokenizers.CharDelimiterSplit(" ")
        self.kept = kept
        vocab = self.whole.get_vocab()
        self.ends = np.zeros(max(vocab.values()) + 1, bool)
        self.ends[[i for w, i in vocab.items() if w.endswith("</w>")]] = True
        self._clear()

    def _clear(self) -> None:
        # Entry of a word by its hash; its check is kept with the entry.
        self.known = HashedNumbers()
        self.flat = np.zeros(1 << 16, np.uint32)
        self.start = np.zeros(1 << 12, np.int64)
        self.size = np.zeros(1 << 12, np.int64)
        self.uses = np.zeros(1 << 12, np.int32)
        self.check = np.zeros(1 << 12, np.int64)
        self.n_flat = self.n_known = 0

    def _forget(self) -> None:
        """Keep the words met in the most slices, half of `kept` and of their ids at most, and none met in a single one."""
        keys, entry = self.known.held()
        often = np.flatnonzero(self.uses[entry] > 1)
        often = often[np.argsort(-self.uses[entry[often]], kind="stable")[: self.kept // 2]]
        often = np.sort(often[np.cumsum(self.size[entry[often]]) <= self.kept * IDS_PER_WORD // 2])
        entry = entry[often]
        sizes, uses, check = self.size[entry], self.uses[entry], self.check[entry]
        ids = self.flat[ragged(self.start[entry], sizes)]
        self._clear()
        self._add(ids, sizes)
        self.uses[: len(uses)] = uses // 2 + 1
        self.check[: len(check)] = check
        self.known.put(keys[often], np.arange(len(often)))

    def _add(self, ids: np.ndarray, sizes: np.ndarray) -> int:
        """Append the ids of several entries; returns the first one's number."""
        while self.n_flat + len(ids) > len(self.flat):
            self.flat = np.resize(self.flat, 2 * len(self.flat))
        while self.n_known + len(sizes) > len(self.start):
            self.start, self.size, self.uses, self.check = (np.resize(x, 2 * len(x)) for x in (self.start, self.size, self.uses, self.check))
        first = self.n_known
        self.flat[self.n_flat : self.n_flat + len(ids)] = ids
        self.start[first : first + len(sizes)] = self.n_flat + np.cumsum(sizes) - sizes
        self.size[first : first + len(sizes)] = sizes
        self.uses[first : first + len(sizes)] = 0
        self.n_flat += len(ids)
        self.n_known += len(sizes)
        return first

    def _learn(self, buffer: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Encode words not seen before; returns their entries.

        Letters, or letters before marks, are joined by blanks and told apart again by the ids that
        end a piece; Latin ones that are lower case and composed already need neither normalizer
        nor splitting. Anything else is encoded by itself.
        """
        entry = np.zeros(len(starts), np.int64)
        data = np.frombuffer(buffer, np.uint8)
        other: list[tuple[int, str]] = []

        def joined(tokenizer, numbers: np.ndarray, text: str, counts: np.ndarray) -> bool:
            ids = np.array(tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)
            last = np.flatnonzero(self.ends[ids]) + 1
            if len(last) != counts.sum():  # a letter that folds to more than letters; never to fewer words
                return False
            last = last[np.cumsum(counts) - 1]
            entry[numbers] = self._add(ids, np.diff(last, prepend=0)) + np.arange(len(numbers))
            return True

        easy, cut = _letters_before_marks(data, starts, ends)
        # The pieces of easy words: one each, or the letters and the marks.
        numbers, cut = np.flatnonzero(easy), cut[easy]
        counts = 1 + (cut < ends[easy])
        at = np.cumsum(counts) - counts
        piece, until = np.repeat(starts[easy], counts), np.repeat(ends[easy], counts)
        two = np.flatnonzero(counts == 2)
        until[at[two]], piece[at[two] + 1] = cut[two], cut[two]
        at = np.append(at, len(piece))
        for k in range(0, len(numbers), 256):
            some, a, b = numbers[k : k + 256], at[k], at[min(k + 256, len(numbers))]
            if not joined(self.plain, some, _byte_level(_spaced(data, piece[a:b], until[a:b])), counts[k : k + 256]):
                other += [(i, buffer[a:b].decode()) for i, a, b in zip(some.tolist(), starts[some].tolist(), ends[some].tolist())]

        latin, letters = ([], [], []), ([], [], [])  # numbers, texts, counts of pieces
        rest = np.flatnonzero(~easy)
        texts = _spaced(data, starts[rest], ends[rest]).tobytes().decode().split(" ")[:-1]
        for i, text, found in zip(rest.tolist(), texts, map(PIECES.fullmatch, texts)):
            if found:
                kind, after = latin, found[2]
                text = f"{found[1]} {after}" if after else text
            else:
                kind, after = letters, text[-1] in ",."
                if not (text[:-1] if after else text).isalpha():
                    other.append((i, text))
                    continue
            kind[0].append(i)
            kind[1].append(text)
            kind[2].append(2 if after else 1)
        for tokenizer, words in ((self.plain, latin), (self.whole, letters)):
            for k in range(0, len(words[0]), 256):
                numbers, texts, counts = (held[k : k + 256] for held in words)
                text = " ".join(texts)
                if tokenizer is self.plain:
                    text = _byte_level(np.frombuffer(text.encode(), np.uint8))
                if not joined(tokenizer, np.array(numbers), text, np.array(counts)):
                    other += [(i, t.replace(" ", "")) for i, t in zip(numbers, texts)]
        for k in range(0, len(other), 4096):
            numbers, texts = zip(*other[k : k + 4096])
            coded = [x.ids for x in self.whole.encode_batch_fast(list(texts), add_special_tokens=False)]
            sizes = np.array([len(x) for x in coded], np.int64)
            ids = np.fromiter((y for x in coded for y in x), np.uint32, int(sizes.sum()))
            entry[list(numbers)] = self._add(ids, sizes) + np.arange(len(numbers))
        return entry

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids, one text after the other, and the number of ids of each text; null counts as empty."""
        try:
            return self._encode(column)
        except BaseException:
            # The encoder outlasts a task that fails; words it may have half added must not.
            self._clear()
            raise

    def _encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        if not self.by_words:
            coded = [x.ids for x in self.whole.encode_batch_fast(column.fill_null("").to_pylist(), add_special_tokens=False)]
            sizes = np.fromiter(map(len, coded), np.int64, len(coded))
            return np.fromiter(chain.from_iterable(coded), np.uint32, int(sizes.sum())), sizes
        if self.n_known > self.kept or self.n_flat > self.kept * IDS_PER_WORD:
            self._forget()
        raw, offsets = text_bytes(column)
        buffer = bytearray(raw.translate(LOWER_AND_BLANKS))
        data = np.frombuffer(buffer, np.uint8)
        after = np.flatnonzero(data[:-1] == LATIN_1) + 1
        data[after[_CAPITAL[data[after]]]] += 0x20
        starts, ends = word_bounds(data, offsets)
        # A comma or full stop after a small letter, before a blank, is a piece of its own.
        tail = data[ends - 1] if len(ends) else data[:0]
        split = np.flatnonzero((ends - starts > 1) & ((tail == 0x2C) | (tail == 0x2E)))
        stop = ends[split] - 2
        split = split[((data[stop] >= 0x61) & (data[stop] <= 0x7A)) | (_SMALL[data[stop]] & (data[stop - 1] == LATIN_1))]
        more = np.ones(len(starts), np.int64)
        more[split] = 2
        mark, stop = np.cumsum(more)[split] - 1, ends[split] - 1
        starts, ends = np.repeat(starts, more), np.repeat(ends, more)
        starts[mark], ends[mark - 1] = stop, stop
        h, check = piece_hashes(buffer, starts, ends)
        border = np.searchsorted(starts, offsets)
        special = pc.match_substring(column.fill_null(""), "<|").to_numpy(zero_copy_only=False)
        if special.any():
            own = np.repeat(np.arange(len(column)), np.diff(border))
            keep = ~special[own]
            starts, ends, own, h, check = starts[keep], ends[keep], own[keep], h[keep], check[keep]
        entry = self.known.find(h)
        new = np.flatnonzero(entry < 0)
        if len(new):
            codes, distinct = pd.factorize(h[new])
            first = np.zeros(len(distinct), np.int64)
            first[codes[::-1]] = new[::-1]
            met = self._learn(buffer, starts[first], ends[first])
            self.check[met] = check[first]
            self.known.put(distinct, met)
            entry[new] = met[codes]
        if (check != self.check[entry]).any():
            raise ValueError("two different words have one hash")
        # Once for each word, however often it occurs here.
        self.uses[entry] += 1
        n_known, n_flat = self.n_known, self.n_flat
        if special.any():
            which = np.flatnonzero(special)
            coded = [self.whole.encode(column[int(i)].as_py(), add_special_tokens=False).ids for i in which]
            sizes = np.array([len(x) for x in coded], np.int64)
            at = self._add(np.array([y for x in coded for y in x], np.uint32), sizes)
            own, entry = np.concatenate((own, which)), np.concatenate((entry, at + np.arange(len(which))))
            order = np.argsort(own, kind="stable")
            own, entry = own[order], entry[order]
            border = np.searchsorted(own, np.arange(len(column) + 1))
        sizes = self.size[entry]
        ids = self.flat[ragged(self.start[entry], sizes)]
        # Texts encoded whole are not kept.
        self.n_known, self.n_flat = n_known, n_flat
        return ids, np.diff(np.append(0, np.cumsum(sizes))[border])
