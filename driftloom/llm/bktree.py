"""BK-trees over 64-bit fingerprints, and the components of a set within a Hamming radius."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

#: A subtree of at most this many fingerprints is a list.
LEAF = 24


def distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b)


class BKTree:
    """Children of a node are keyed by their distance to its pivot; a subtree hangs on one edge.

    Nodes are (pivot's place, edges) with edges from distance to node; a leaf is an array of places.
    """

    def __init__(self, values: np.ndarray):
        self.values = values
        self.root = self._build(np.arange(len(values)))

    def _build(self, places: np.ndarray):
        root: dict = {}
        stack = [(root, 0, places)]
        while stack:
            parent, edge, own = stack.pop()
            if len(own) <= LEAF:
                parent[edge] = own
                continue
            far = distance(self.values[own[1:]], self.values[own[0]])
            edges: dict = {}
            parent[edge] = (int(own[0]), edges)
            order = np.argsort(far, kind="stable")
            cut = np.flatnonzero(np.diff(far[order])) + 1
            for child in np.split(order, cut):
                if len(child):
                    stack.append((edges, int(far[child[0]]), own[1:][child]))
        return root[0]

    def near(self, queries: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Places of queries and of fingerprints within the radius; only edges within the radius are followed."""
        stack = [(self.root, np.arange(len(queries)))]
        while stack:
            node, asked = stack.pop()
            if isinstance(node, np.ndarray):
                close = distance(queries[asked][:, None], self.values[node][None, :]) <= radius
                q, v = np.nonzero(close)
                if len(q):
                    yield asked[q], node[v]
                continue
            pivot, edges = node
            far = distance(queries[asked], self.values[pivot]).astype(np.int64)
            hit = asked[far <= radius]
            if len(hit):
                yield hit, np.full(len(hit), pivot)
            for edge, child in edges.items():
                go = np.abs(far - edge) <= radius
                if go.any():
                    stack.append((child, asked[go]))


def merge(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Give the ends of every link one label, the smallest place they reach; `label` is changed."""
    while True:
        la, lb = label[a], label[b]
        differ = la != lb
        if not differ.any():
            return
        a, b, la, lb = a[differ], b[differ], la[differ], lb[differ]
        low, high = np.minimum(la, lb), np.maximum(la, lb)
        np.minimum.at(label, high, low)
        while (label != label[label]).any():
            label[:] = label[label]


def linked_within(values: np.ndarray, radius: int, queries: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of fingerprints that join what lies within the radius: a value and the smallest place's value of its component.

    Among `values`, or between `queries` and `values` where queries are given. At most one pair
    per fingerprint comes out, however many lie close together.
    """
    tree = BKTree(values)
    asked = values if queries is None else queries
    shift = 0 if queries is None else len(values)
    every = values if queries is None else np.concatenate((values, queries))
    label = np.arange(len(every))
    for q, v in tree.near(asked, radius):
        merge(label, q + shift, v)
    moved = np.flatnonzero(label != np.arange(len(every)))
    return every[moved], every[label[moved]]
