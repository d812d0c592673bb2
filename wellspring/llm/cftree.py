"""Cluster-feature trees and Ward agglomeration of their leaves: numpy helpers inside Spark tasks."""

from __future__ import annotations

import numpy as np

FAN = 32


class _Node:
    __slots__ = ("leaf", "k", "n", "ss", "ls", "mean", "sq", "child")

    def __init__(self, d: int, leaf: bool):
        self.leaf, self.k = leaf, 0
        self.n, self.ss, self.sq = np.zeros(FAN + 1), np.zeros(FAN + 1), np.zeros(FAN + 1)
        self.ls, self.mean = np.zeros((FAN + 1, d)), np.zeros((FAN + 1, d))
        self.child: list[_Node] = []

    def put(self, i: int, n: float, ls: np.ndarray, ss: float) -> None:
        self.n[i], self.ls[i], self.ss[i] = n, ls, ss
        self.mean[i] = m = ls / n
        self.sq[i] = m @ m

    def add(self, n: float, ls: np.ndarray, ss: float, child=None) -> None:
        self.put(self.k, n, ls, ss)
        self.k += 1
        if child is not None:
            self.child.append(child)

    def total(self):
        k = self.k
        return self.n[:k].sum(), self.ls[:k].sum(0), self.ss[:k].sum()

    def split(self, d: int) -> tuple[_Node, _Node]:
        k = self.k
        m = self.mean[:k]
        far = self.sq[:k, None] + self.sq[None, :k] - 2 * m @ m.T
        a, b = divmod(int(far.argmax()), k)
        parts = _Node(d, self.leaf), _Node(d, self.leaf)
        side = (far[b] < far[a]).astype(int)
        side[a], side[b] = 0, 1
        for want in (0, 1):  # neither half may stay full
            if (side == want).sum() > FAN:
                mine = np.flatnonzero(side == want)
                side[mine[-1] if mine[-1] not in (a, b) else mine[-2]] = 1 - want
        for i in range(k):
            parts[side[i]].add(self.n[i], self.ls[i], self.ss[i], None if self.leaf else self.child[i])
        return parts


class CFTree:
    """Leaves are cluster features (count, linear sum, square sum); never more than ``most`` of them.

    An entry joins its nearest leaf if the joint radius stays within the
    threshold.  When the leaves grow too many the threshold is raised and the
    leaves are inserted anew, so trees of any inputs can be merged.
    """

    def __init__(self, d: int, radius: float, most: int):
        self.d, self.radius, self.most = d, radius, most
        self._clear()

    def _clear(self) -> None:
        self.root, self.leaves = _Node(self.d, True), 0

    def insert(self, n: float, ls: np.ndarray, ss: float) -> None:
        x = ls / n
        path = []
        node = self.root
        while True:
            k = node.k
            i = int((node.sq[:k] - 2 * (node.mean[:k] @ x)).argmin()) if k else -1
            if node.leaf:
                break
            path.append((node, i))
            node = node.child[i]
        if i >= 0:
            total, joint, squares = node.n[i] + n, node.ls[i] + ls, node.ss[i] + ss
            if squares / total - (joint @ joint) / total**2 <= self.radius**2:
                node.put(i, total, joint, squares)
                for up, j in path:
                    up.put(j, up.n[j] + n, up.ls[j] + ls, up.ss[j] + ss)
                return
        node.add(n, ls, ss)
        self.leaves += 1
        for up, j in path:
            up.put(j, up.n[j] + n, up.ls[j] + ls, up.ss[j] + ss)
        while node.k > FAN:
            a, b = node.split(self.d)
            if not path:
                self.root = _Node(self.d, False)
                self.root.add(*a.total(), a), self.root.add(*b.total(), b)
                break
            up, j = path.pop()
            up.put(j, *a.total())
            up.child[j] = a
            up.add(*b.total(), b)
            node = up
        if self.leaves > self.most:
            self.coarsen()

    def insert_rows(self, x: np.ndarray, chunk: int = 512) -> None:
        """Rows of ``x`` one after the other, those of a chunk that their nearest leaves can take together at once."""
        for lo in range(0, len(x), chunk):
            part = x[lo : lo + chunk]
            rest = np.arange(len(part))
            if self.leaves >= FAN:
                nodes = self._leaf_nodes()
                n, ls, ss = (np.concatenate([getattr(v, name)[: v.k] for v in nodes]) for name in ("n", "ls", "ss"))
                mean, sq = (np.concatenate([getattr(v, name)[: v.k] for v in nodes]) for name in ("mean", "sq"))
                near = (sq[None] - 2 * part @ mean.T).argmin(1)
                more = np.bincount(near, minlength=len(n))
                at, of = np.unique(near, return_inverse=True)
                total, joint, squares = n[at] + more[at], ls[at].copy(), ss[at].copy()
                np.add.at(joint, of, part)
                np.add.at(squares, of, (part * part).sum(1))
                fits = squares / total - (joint * joint).sum(1) / total**2 <= self.radius**2
                if fits.any():
                    first = np.cumsum([0] + [v.k for v in nodes])
                    owner = np.searchsorted(first, at, "right") - 1
                    for k in np.flatnonzero(fits):
                        nodes[owner[k]].put(int(at[k] - first[owner[k]]), total[k], joint[k], squares[k])
                    self._resum(self.root)
                    rest = np.flatnonzero(~fits[of])
            for i in rest:
                self.insert(1.0, part[i], float(part[i] @ part[i]))

    def _leaf_nodes(self) -> list[_Node]:
        out, stack = [], [self.root]
        while stack:
            node = stack.pop()
            if node.leaf:
                out.append(node)
            else:
                stack += node.child[::-1]
        return out

    def _resum(self, node: _Node) -> None:
        if not node.leaf:
            for i, child in enumerate(node.child):
                self._resum(child)
                node.put(i, *child.total())

    def coarsen(self) -> None:
        n, ls, ss = self.features()
        while True:
            # radii of joining each leaf with its nearest of a stretch tell how far to go
            mean = ls / n[:, None]
            step = max(1, len(n) // 256)
            some = mean[::step]
            gap = (mean**2).sum(1)[None] + (some**2).sum(1)[:, None] - 2 * some @ mean.T
            gap[np.arange(len(some)), np.arange(len(some)) * step] = np.inf
            j = gap.argmin(1)
            a = np.arange(len(some)) * step
            total, joint = n[a] + n[j], ls[a] + ls[j]
            radius = np.sqrt(np.maximum((ss[a] + ss[j]) / total - (joint**2).sum(1) / total**2, 0))
            self.radius = max(self.radius * 1.01, float(np.median(radius)))
            self._clear()
            keep, self.most = self.most, 1 << 60
            for i in np.argsort(-n, kind="stable"):
                self.insert(n[i], ls[i], ss[i])
            self.most = keep
            if self.leaves <= 0.7 * self.most:
                return
            n, ls, ss = self.features()

    def features(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        nodes = self._leaf_nodes()
        return tuple(np.concatenate([getattr(v, name)[: v.k] for v in nodes]) for name in ("n", "ls", "ss"))


def merges_of(n: np.ndarray, ls: np.ndarray) -> list[tuple[float, int, int]]:
    """Ward's merges (height, leaf of one side, leaf of the other) from low to high, by the nearest-neighbour chain."""
    k = len(n)
    size, mean = n.astype(float).copy(), ls / n[:, None]
    live = np.ones(k, bool)
    sq = (mean**2).sum(1)
    merges, chain = [], []
    left = k
    while left > 1:
        if not chain:
            chain.append(int(np.flatnonzero(live)[0]))
        while True:
            i = chain[-1]
            d = (sq + sq[i] - 2 * mean @ mean[i]) * size * size[i] / (size + size[i])
            d[~live] = np.inf
            d[i] = np.inf
            j = int(d.argmin())
            if len(chain) > 1 and d[chain[-2]] <= d[j]:
                break
            chain.append(j)
        j = chain[-2]
        merges.append((d[j], i, j))
        total = size[i] + size[j]
        mean[j] = (mean[i] * size[i] + mean[j] * size[j]) / total
        size[j], live[i] = total, False
        sq[j] = mean[j] @ mean[j]
        chain = chain[:-2]
        left -= 1
    return sorted(merges, key=lambda m: m[0])


def _root(label: np.ndarray, i: int) -> int:
    while label[i] != i:
        label[i] = label[label[i]]
        i = label[i]
    return i


def _numbered(label: np.ndarray) -> np.ndarray:
    return np.unique([_root(label, i) for i in range(len(label))], return_inverse=True)[1]


def ward(n: np.ndarray, ls: np.ndarray, clusters: int) -> np.ndarray:
    """Labels of the leaves after Ward agglomeration down to ``clusters``."""
    label = np.arange(len(n))
    for _, i, j in merges_of(n, ls)[: max(0, len(n) - clusters)]:
        label[_root(label, i)] = _root(label, j)
    return _numbered(label)


def pair_cosine(n: np.ndarray, ls: np.ndarray) -> np.ndarray:
    """Mean cosine over the pairs of clusters of ``n`` unit vectors with sums ``ls``; 1 for a single vector."""
    square = (ls * ls).sum(-1)
    return np.where(n > 1, (square - n) / np.maximum(n * (n - 1), 1), 1.0)


def ward_mutual(n: np.ndarray, ls: np.ndarray, least: float) -> np.ndarray:
    """Labels after Ward agglomeration of unit vectors, cut where the mean cosine over a cluster's pairs would fall below ``least``.

    Leaves without any leaf of cosine ``least`` stay alone without being agglomerated.
    """
    label = np.arange(len(n))
    if len(n) < 2:
        return label
    unit = ls / np.maximum(np.linalg.norm(ls, axis=1, keepdims=True), 1e-300)
    near = np.zeros(len(n), bool)
    for lo in range(0, len(n), 1_024):
        s = unit[lo : lo + 1_024] @ unit.T
        s[np.arange(len(s)), lo + np.arange(len(s))] = -1
        near[lo : lo + 1_024] = s.max(1) >= least
    some = np.flatnonzero(near)
    if not len(some):
        return label
    count, total, closed = n.astype(float).copy(), ls.copy(), np.zeros(len(n), bool)
    for _, i, j in merges_of(n[some], ls[some]):
        a, b = _root(label, some[i]), _root(label, some[j])
        size, joint = count[a] + count[b], total[a] + total[b]
        if closed[a] or closed[b] or pair_cosine(size, joint) < least:
            closed[a] = closed[b] = True
            continue
        label[a] = b
        count[b], total[b] = size, joint
    return _numbered(label)
