"""Substring dedup with suffix automata.

The reference shards are the regions of the corpus whose anchor occurs again (see `repeats`),
one shard for each anchor gram, and one for each window of a very frequent gram. A shard's
suffix automaton grows in corpus order: each region is streamed through the automaton of those
before it, giving at each word the length of the longest earlier match that ends there (the
matching statistics). A window whose last word has a match at least as long as the window is a
repeat; a region with a window that is new is then added.

Automata are not broadcast: all shards together grow with the corpus, so no bound on their size
could be shown. Each meets the regions that can match it in one task instead.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame

from driftloom.llm.repeats import find_repeats

WINDOW = 20
GRAM = 5
#: A gram with more occurrences is dealt out by single windows.
HOT = 256


class SuffixAutomaton:
    """Suffix automaton of several word sequences."""

    def __init__(self) -> None:
        self.next: list[dict[bytes, int]] = [{}]
        self.link = [-1]
        self.length = [0]

    def _state(self, length: int, edges: dict[bytes, int], link: int) -> int:
        self.next.append(edges)
        self.link.append(link)
        self.length.append(length)
        return len(self.link) - 1

    def _split(self, state: int, word: bytes, target: int) -> int:
        """A state for the short words of `target` that `state` reaches with `word`."""
        copy = self._state(self.length[state] + 1, dict(self.next[target]), self.link[target])
        self.link[target] = copy
        while state >= 0 and self.next[state].get(word) == target:
            self.next[state][word] = copy
            state = self.link[state]
        return copy

    def add(self, words: list[bytes]) -> None:
        last = 0
        for word in words:
            target = self.next[last].get(word)
            if target is not None:  # an earlier sequence has this step
                last = target if self.length[target] == self.length[last] + 1 else self._split(last, word, target)
                continue
            state, at = self._state(self.length[last] + 1, {}, 0), last
            while at >= 0 and word not in self.next[at]:
                self.next[at][word] = state
                at = self.link[at]
            if at >= 0:
                target = self.next[at][word]
                self.link[state] = target if self.length[target] == self.length[at] + 1 else self._split(at, word, target)
            last = state

    def statistics(self, words: list[bytes]) -> np.ndarray:
        """For each word the length of the longest match of the words up to it."""
        out, state, size = np.zeros(len(words), np.int64), 0, 0
        for i, word in enumerate(words):
            while state and word not in self.next[state]:
                state = self.link[state]
                size = self.length[state]
            if word in self.next[state]:
                state, size = self.next[state][word], size + 1
            out[i] = size
        return out


def judge(regions: list[tuple[list[bytes], int]], window: int = WINDOW) -> list[np.ndarray]:
    """For each region in corpus order a mask of its windows that no region before it has."""
    automaton, out = SuffixAutomaton(), []
    for words, _ in regions:
        new = automaton.statistics(words)[window - 1 :] < window
        out.append(new)
        if new.any():
            automaton.add(words)
    return out


def without_repeats(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, hot: int = HOT) -> DataFrame:
    """doc_id, n_words, n_removed, kept (the words left, joined by a blank): one row per row.

    A word goes where a window that covers it occurs earlier in the corpus, in a smaller doc_id
    or earlier in the same document; windows are judged on the input. Null and empty texts have
    no words and keep none; a text shorter than a window keeps all. Rows that share a doc_id
    come in the order of a hash of their text, equal rows being one place in the corpus, each
    with the same result; a null doc_id comes first. Other columns are not read.
    """

    def finish(doc, words, covered):
        kept = b" ".join(w for w, c in zip(words, covered.tolist()) if not c)
        return [(doc, len(words), int(covered.sum()), kept.decode())]

    return find_repeats(docs, window, gram, lambda regions: judge(regions, window), hot, finish, "doc_id long, n_words long, n_removed long, kept string")


def repeats_report(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256: one row per document."""

    def finish(doc, words, covered):
        kept = b" ".join(w for w, c in zip(words, covered.tolist()) if not c)
        return [(doc, len(words), int(covered.sum()), hashlib.sha256(kept).hexdigest())]

    return find_repeats(docs, WINDOW, GRAM, judge, HOT, finish, "doc_id long, n_words long, n_removed long, kept_sha256 string")
