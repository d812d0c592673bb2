"""Forest of random-projection trees and its search through one priority queue.

Small numpy helpers used inside Spark tasks by :mod:`neighbours` and
:mod:`clusters`.  Vectors are unit length, so hyperplanes pass between two
sampled points.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Tree:
    normals: np.ndarray  # (nodes, d) float32
    offsets: np.ndarray  # (nodes,)
    children: np.ndarray  # (nodes, 2); ~leaf where negative
    leaves: int


def grow(points: np.ndarray, leaf_points: int, rng: np.random.Generator) -> Tree:
    """One tree over ``points``; nodes of at most ``leaf_points`` become leaves."""
    normals, offsets, children = [], [], []
    leaves = 0
    stack = [(np.arange(len(points)), -1, 0)]
    while stack:
        rows, parent, side = stack.pop()
        split = _split(points[rows], rng) if len(rows) > leaf_points else None
        if split is None:
            node, leaves = ~leaves, leaves + 1
        else:
            node = len(normals)
            normal, offset, right = split
            normals.append(normal), offsets.append(offset), children.append([0, 0])
            stack += [(rows[~right], node, 0), (rows[right], node, 1)]
        if parent >= 0:
            children[parent][side] = node
    d = points.shape[1]
    return Tree(np.array(normals, np.float32).reshape(-1, d), np.array(offsets, np.float32), np.array(children, np.int32).reshape(-1, 2), leaves)


def _split(x: np.ndarray, rng: np.random.Generator):
    for attempt in range(4):
        i, j = rng.integers(len(x), size=2)
        normal = x[i] - x[j]
        size = np.linalg.norm(normal)
        if size < 1e-6:
            continue
        normal = normal / size
        at = x @ normal
        offset = np.float32(0.5 * (at[i] + at[j])) if attempt < 3 else np.float32(np.median(at))
        right = at > offset
        if 0.1 < right.mean() < 0.9:
            return normal, offset, right
    return (normal, offset, right) if size >= 1e-6 and 0 < right.sum() < len(x) else None


def _descend(tree: Tree, x: np.ndarray, rows: np.ndarray, node: np.ndarray, leaf: np.ndarray, aside=None) -> None:
    """Move ``rows`` of ``x`` from ``node`` to their leaves; ``aside(rows, far node, margin)`` gets what is passed by."""
    while len(rows):
        down = node < 0
        leaf[rows[down]] = ~node[down]
        rows, node = rows[~down], node[~down]
        if not len(rows):
            return
        margin = np.einsum("ij,ij->i", x[rows], tree.normals[node]) - tree.offsets[node]
        side = (margin > 0).astype(int)
        if aside is not None:
            aside(rows, tree.children[node, 1 - side], np.abs(margin))
        node = tree.children[node, side]


def _depth(tree: Tree) -> int:
    level = np.zeros(len(tree.normals), int)
    for node, pair in enumerate(tree.children):  # parents come before their children
        level[pair[pair >= 0]] = level[node] + 1
    return int(level.max(initial=0)) + 1


def leaf_of(tree: Tree, x: np.ndarray) -> np.ndarray:
    leaf = np.zeros(len(x), np.int32)
    if len(tree.normals):
        _descend(tree, x, np.arange(len(x)), np.zeros(len(x), np.int32), leaf)
    return leaf


def search(forest: list[Tree], x: np.ndarray, leaves: int) -> tuple[np.ndarray, np.ndarray]:
    """For each row the ``leaves`` best leaves over all trees: (tree, leaf), each (rows, leaves), -1 if fewer.

    One queue per row is shared by all trees.  It starts with every root; the
    entry that lies least far on the wrong side of its hyperplanes (by the sum of
    the squared distances) is taken next, followed down to a leaf, and the
    siblings passed by are queued.  All rows of the batch advance together.
    """
    n = len(x)
    every = np.arange(n)
    out_tree, out_leaf = np.full((n, leaves), -1, np.int32), np.full((n, leaves), -1, np.int32)
    if not n:
        return out_tree, out_leaf
    width = len(forest) + leaves * max(map(_depth, forest))
    cost = np.full((n, width), np.inf, np.float32)
    node, of = np.zeros((n, width), np.int32), np.zeros((n, width), np.int16)
    used = np.zeros(n, int)

    def push(rows, tree, nodes, costs):
        at = used[rows]
        cost[rows, at], node[rows, at], of[rows, at] = costs, nodes, tree
        used[rows] += 1

    for t, tree in enumerate(forest):
        push(every, t, np.full(n, 0 if len(tree.normals) else ~0), np.full(n, -1.0 + t * 1e-6, np.float32))
    for k in range(leaves):
        best = cost[:, : used.max()].argmin(1)
        price = cost[every, best]
        open_ = np.isfinite(price)
        cost[every, best] = np.inf
        for t, tree in enumerate(forest):
            rows = np.flatnonzero(open_ & (of[every, best] == t))
            if not len(rows):
                continue
            paid = np.full(n, 0, np.float32)
            paid[rows] = np.maximum(price[rows], 0)
            leaf = np.full(n, -1, np.int32)
            _descend(tree, x, rows, node[rows, best[rows]], leaf, lambda r, far, m, t=t, paid=paid: push(r, t, far, paid[r] + m * m))
            out_tree[rows, k], out_leaf[rows, k] = t, leaf[rows]
    return out_tree, out_leaf
