"""Repeated passages by sparse suffix arrays.

Only suffixes that start at minimiser positions are kept (see `repeats`): any passage of
`PASSAGE` words that occurs twice has a minimiser at the same place in both. Suffixes with one
first gram meet in one group, are sorted by their words, and compared with their neighbours,
which gives the words they share to the right; two suffixes further apart share the least of
what lies between them. Each match is then extended to the left, and is a repeat where left and
right together reach the passage length.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from driftloom.llm.repeats import find_repeats

PASSAGE = 50
GRAM = 8
#: A gram with more occurrences is dealt out by single passages, so a group's suffixes stay few.
HOT = 64


def _shared(a: list[bytes], b: list[bytes]) -> int:
    """Number of equal words at the start of two lists."""
    n = 0
    for x, y in zip(a, b):
        if x != y:
            break
        n += 1
    return n


def judge(regions: list[tuple[list[bytes], int]], passage: int = PASSAGE) -> list[np.ndarray]:
    """For each region in corpus order a mask of its passages that no region before it has."""
    out = [np.ones(len(words) - passage + 1, bool) for words, _ in regions]
    right = [words[at:] for words, at in regions]
    left = [words[:at][::-1] for words, at in regions]
    order = sorted(range(len(regions)), key=lambda i: right[i])
    neighbour = [_shared(right[i], right[j]) for i, j in zip(order, order[1:])]
    for k, i in enumerate(order):
        for step in (1, -1):
            shared, j = len(right[i]), k
            while 0 <= j + step < len(order):
                shared = min(shared, neighbour[j if step == 1 else j - 1])
                j += step
                other = order[j]
                if shared + min(len(left[i]), passage) < passage:
                    break  # even the whole left side does not make a passage, nor will it further on
                if other > i:
                    continue  # later in the corpus
                back = _shared(left[i], left[other])
                if back + shared >= passage:
                    at = regions[i][1]
                    out[i][at - back : at + shared - passage + 1] = False
    return out


def repeated_passages(docs: DataFrame, passage: int = PASSAGE, gram: int = GRAM, hot: int = HOT) -> DataFrame:
    """doc_id, first_word, n_words, passage: each stretch of a text that repeats an earlier part of the corpus.

    A stretch is a maximal run of words in passages of `passage` words that occur earlier, in a
    smaller doc_id or earlier in the same document. A text without any has no row, so null,
    empty and short texts have none. Words are runs of anything but ASCII white space. Rows that
    share a doc_id come in the order of a hash of their text, equal rows being one place in the
    corpus, each with the same result; a null doc_id comes first. Other columns are not read.
    """

    def finish(doc, words, covered):
        edge = np.flatnonzero(np.diff(np.concatenate(([0], covered, [0])))).reshape(-1, 2)
        return [(doc, a, b - a, b" ".join(words[a:b]).decode()) for a, b in edge.tolist()]

    return find_repeats(docs, passage, gram, lambda regions: judge(regions, passage), hot, finish, "doc_id long, first_word long, n_words long, passage string")
