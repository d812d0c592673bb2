"""Most similar vectors for every vector (cosine).

A forest of random-projection trees is fitted on a bounded sample; every vector
is indexed in one leaf of every tree.  A query walks all trees through one
shared priority queue, and the candidates in the leaves it reaches are reranked
by their exact cosine.  Spark moves vectors to ranges of leaves as codes of one
byte per dimension, each with the length of its rounding error, so that a code's
cosine bounds the exact one; only candidates that the bounds leave open are
joined with their whole vectors.  Vectors that point in exactly the same
direction are one class and are indexed once.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wellspring.llm.forest import Tree, grow, leaf_of, search
from wellspring.session import cut


@dataclass(frozen=True)
class ForestPlan:
    """Leaves of about ``leaf_rows`` rows; ``probes`` leaves are searched per query, over all trees.

    With ``growth`` more leaves are searched in larger collections: ``probes``
    times (rows / 100,000) to the power of ``growth``.  A growth below 1 lets the
    share of the rows that a query is compared with fall as rows are added.
    """

    trees: int = 8
    leaf_rows: int = 512
    probes: int = 16
    growth: float = 0.0
    sample_rows: int = 50_000  # bound of the sample that places the hyperplanes
    least_points: int = 8  # sampled points per leaf at least
    block: int = 8_192  # indexed rows of a leaf in one task; fuller leaves are salted
    range_rows: int = 4_096  # rows of the neighbouring leaves that one task holds
    seed: int = 7

    def leaves_for(self, rows: int) -> int:
        return max(self.trees, round(self.probes * (max(rows, 1) / 100_000) ** self.growth))


def is_usable(vector: Column, dims: int) -> Column:
    """``dims`` finite values, not all zero."""
    finite = F.forall(vector, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return F.coalesce((F.size(vector) == dims) & finite & F.exists(vector, lambda v: v != 0), F.lit(False))


def unit_vectors(df: DataFrame, row_id: str, vector: str, dims: int) -> DataFrame:
    """``id, vec``: usable vectors at length one, as packed float32.

    Null, short, non-finite and zero vectors are left out.
    """

    def pack(batches):
        for b in batches:
            flat = np.asarray(b.column("v").flatten().to_numpy(zero_copy_only=False), np.float64).reshape(-1, dims)
            flat = flat / np.abs(flat).max(1, keepdims=True) if len(flat) else flat
            unit = (flat / np.linalg.norm(flat, axis=1, keepdims=True)).astype(np.float32) + np.float32(0)
            yield pa.RecordBatch.from_arrays([b.column("id"), _binary(unit)], names=["id", "vec"])

    rows = df.filter(is_usable(F.col(vector), dims)).select(F.col(row_id).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"))
    return rows.mapInArrow(pack, "id long, vec binary")


def _binary(unit: np.ndarray) -> pa.Array:
    width = unit.shape[1] * 4 if unit.ndim == 2 else 0
    ends = np.arange(len(unit) + 1, dtype=np.int32) * width
    return pa.Array.from_buffers(pa.binary(), len(unit), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(unit))])


def matrix(column, dims: int) -> np.ndarray:
    """Packed vectors as rows of a float32 matrix."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not len(column):
        return np.zeros((0, dims), np.float32)
    ends = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(column.buffers()[2], np.uint8)[ends[0] : ends[-1]].view(np.float32).reshape(-1, dims)


def classes_of(vectors: DataFrame) -> tuple[DataFrame, DataFrame]:
    """One row per direction (``id``: its smallest id, ``vec``), and ``rep, id`` of every class of several."""
    groups = cut(vectors.groupBy("vec").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("n")))
    several = groups.filter("n > 1").select("vec", "rep")
    return groups.select(F.col("rep").alias("id"), "vec"), vectors.join(several, "vec").select("rep", "id")


@dataclass(frozen=True)
class Index:
    """A fitted forest, leaves searched per query, blocks a leaf is salted into, leaves that travel together."""

    forest: list[Tree]
    probes: int
    blocks: int
    together: int


def fit(vectors: DataFrame, plan: ForestPlan, dims: int) -> Index:
    rows = vectors.count()
    share = min(1.0, plan.sample_rows / max(rows, 1))
    # hashes spread evenly over 2^62, so that the sample keeps its size at any number of rows
    chosen = vectors if share == 1 else vectors.filter(F.pmod(F.xxhash64("id", F.lit(plan.seed)), F.lit(1 << 62)) < int(share * (1 << 62)))
    packed = chosen.select("vec").limit(2 * plan.sample_rows).toArrow()  # a guard: the share makes it about sample_rows
    sample = matrix(packed["vec"], dims)
    points = max(plan.least_points, int(plan.leaf_rows * len(sample) / max(rows, 1)))
    forest = [grow(sample, points, np.random.default_rng((plan.seed, i))) for i in range(plan.trees)]
    in_leaf = max(1, int(rows * points / max(len(sample), 1)))
    return Index(forest, plan.leaves_for(rows), max(1, -(-in_leaf // plan.block)), max(1, plan.range_rows // in_leaf))


def encode(x: np.ndarray) -> np.ndarray:
    """Rows as bytes: one signed byte per dimension, then scale and length of the rounding error (float32)."""
    scale = np.maximum(np.abs(x).max(1, keepdims=True), 1e-30) / 127
    code = np.rint(x / scale).astype(np.int8)
    scale = scale.astype(np.float32)
    error = np.linalg.norm(x.astype(np.float64) - code * scale.astype(np.float64), axis=1, keepdims=True).astype(np.float32) * np.float32(1.0001) + np.float32(1e-6)
    return np.concatenate([code.view(np.uint8), scale.view(np.uint8), error.view(np.uint8)], axis=1)


def decode(column, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """Approximate rows and the lengths of their errors."""
    raw = np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, dims + 8)
    tail = np.ascontiguousarray(raw[:, dims:]).view(np.float32)
    return np.ascontiguousarray(raw[:, :dims]).view(np.int8) * tail[:, :1], tail[:, 1]


def slack(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How far the product of two coded unit vectors with errors ``a`` and ``b`` may lie from the exact one."""
    return a[:, None] + (1 + a[:, None]) * b[None]


def _spread(vectors: DataFrame, index: Index, dims: int, every: int, indexing: bool = True) -> DataFrame:
    """Each vector's code once per range of leaves that it lies in or asks: ``tree, part, block, leaf, asks, id, code``.

    ``leaf`` is the leaf it is indexed in (-1: it only asks), ``asks`` the packed
    numbers of the leaves it asks.  Only ids divisible by ``every`` ask.
    """
    # bounded by the sample
    shared = vectors.sparkSession.sparkContext.broadcast([(t.normals, t.offsets, t.children, t.leaves) for t in index.forest])
    probes, together = index.probes, index.together
    names = ["tree", "part", "leaf", "asks", "id", "code"]

    def run(batches):
        trees = [Tree(*t) for t in shared.value]
        step = max(128, 2_000_000 // (probes * 12))
        for whole in batches:
            for lo in range(0, whole.num_rows, step):
                b = whole.slice(lo, step)
                x = matrix(b.column("vec"), dims)
                ids = b.column("id").to_numpy()
                n = len(x)
                row, tree, leaf, role = (np.zeros(0, np.int64) for _ in range(4))
                if indexing:
                    row, tree = np.tile(np.arange(n), len(trees)), np.repeat(np.arange(len(trees)), n)
                    leaf, role = np.concatenate([leaf_of(t, x) for t in trees]).astype(np.int64), np.ones(n * len(trees), np.int64)
                asking = np.flatnonzero(ids % every == 0)
                pt, pl = search(trees, x[asking], probes)
                some = pt.ravel() >= 0
                row = np.concatenate([row, np.repeat(asking, probes)[some]])
                tree, leaf = np.concatenate([tree, pt.ravel()[some]]), np.concatenate([leaf, pl.ravel()[some]])
                role = np.concatenate([role, np.zeros(some.sum(), np.int64)])
                order = np.lexsort((role, leaf, leaf // together, tree, row))
                row, tree, leaf, role = row[order], tree[order], leaf[order], role[order]
                part = leaf // together
                new = np.ones(len(row), bool)
                new[1:] = (row[1:] != row[:-1]) | (tree[1:] != tree[:-1]) | (part[1:] != part[:-1])
                group = np.cumsum(new) - 1
                first = np.flatnonzero(new)
                home = np.full(len(first), -1, np.int32)
                home[group[role == 1]] = leaf[role == 1]
                asked = leaf[role == 0].astype(np.int32)
                ends = np.concatenate([[0], np.cumsum(np.bincount(group[role == 0], minlength=len(first)))]).astype(np.int32) * 4
                asks = pa.Array.from_buffers(pa.binary(), len(first), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(asked))])
                code = encode(x)
                width = code.shape[1]
                codes = pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(np.arange(n + 1, dtype=np.int32) * width), pa.py_buffer(np.ascontiguousarray(code))])
                at = pa.array(row[first])
                yield pa.RecordBatch.from_arrays([pa.array(tree[first].astype(np.int32)), pa.array(part[first].astype(np.int32)), pa.array(home), asks, b.column("id").take(at), codes.take(at)], names=names)

    out = vectors.mapInArrow(run, "tree int, part int, leaf int, asks binary, id long, code binary")
    if index.blocks == 1:
        return out.withColumn("block", F.lit(0))
    own, every_block = F.pmod(F.xxhash64("id"), F.lit(index.blocks)).cast("int"), F.sequence(F.lit(0), F.lit(index.blocks - 1))
    spread = out.withColumn("own", own).withColumn("block", F.explode(F.when(F.length("asks") > 0, every_block).otherwise(F.array(own))))
    return spread.withColumn("leaf", F.when(F.col("block") == F.col("own"), F.col("leaf")).otherwise(-1)).drop("own").filter("leaf >= 0 or length(asks) > 0")


FOUND = "id long, other long, cosine double"


def _found(a: np.ndarray, b: np.ndarray, s: np.ndarray) -> pa.Table:
    return pa.table({"id": pa.array(a, pa.int64()), "other": pa.array(b, pa.int64()), "cosine": pa.array(s.astype(np.float64), pa.float64())})


def _leaves(t: pa.Table, dims: int):
    """Of every leaf that is asked: (rows that ask, rows indexed), and all ids, approximate vectors and errors."""
    ids, home = t["id"].to_numpy(), t["leaf"].to_numpy()
    x, error = decode(t["code"], dims)
    asks = t["asks"].to_pylist()
    asked = np.frombuffer(b"".join(asks), np.int32)
    by = np.repeat(np.arange(len(ids)), [len(a) // 4 for a in asks])
    pairs = []
    for leaf in np.unique(asked):
        inside = np.flatnonzero(home == leaf)
        if len(inside):
            pairs.append((by[asked == leaf], inside))
    return pairs, ids, x, error


def _candidates_above(dims: int, least: float):
    def run(t: pa.Table) -> pa.Table:
        pairs, ids, x, error = _leaves(t, dims)
        parts = []
        for q, i in pairs:
            for lo in range(0, len(q), 1024):
                r = q[lo : lo + 1024]
                s = x[r] @ x[i].T
                a, b = np.nonzero(s >= least - slack(error[r], error[i]))
                one, two = ids[r[a]], ids[i[b]]
                keep = one != two
                both = np.unique(np.stack([np.minimum(one, two)[keep], np.maximum(one, two)[keep]]), axis=1)
                parts.append(both)
        found = np.unique(np.concatenate(parts, axis=1), axis=1) if parts else np.zeros((2, 0), np.int64)
        return pa.table({"id": pa.array(found[0], pa.int64()), "other": pa.array(found[1], pa.int64())})

    return run


def _with_cosines(pairs: DataFrame, left: DataFrame, right: DataFrame, dims: int) -> DataFrame:
    """``id, other, cosine`` (exact) of ``id, other``."""

    def run(batches):
        for b in batches:
            s = np.einsum("ij,ij->i", matrix(b.column("x"), dims).astype(np.float64), matrix(b.column("y"), dims).astype(np.float64))
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("other"), pa.array(s)], names=["id", "other", "cosine"])

    both = pairs.join(left.select("id", F.col("vec").alias("x")), "id").join(right.select(F.col("id").alias("other"), F.col("vec").alias("y")), "other")
    return both.select("id", "other", "x", "y").mapInArrow(run, FOUND)


def _best(qi: np.ndarray, q: np.ndarray, ii: np.ndarray, i: np.ndarray, k: int) -> pa.Table:
    parts = []
    for lo in range(0, len(q), 1024):
        s = q[lo : lo + 1024] @ i.T
        s[qi[lo : lo + 1024, None] == ii[None, :]] = -3
        top = np.argpartition(-s, k - 1, axis=1)[:, :k] if s.shape[1] > k else np.tile(np.arange(s.shape[1]), (len(s), 1))
        val = np.take_along_axis(s, top, 1).ravel()
        a, b = np.repeat(qi[lo : lo + 1024], top.shape[1]), ii[top.ravel()]
        parts.append((a[val > -2], b[val > -2], val[val > -2]))
    return _found(*(np.concatenate(p) for p in zip(*parts))) if parts else _found(qi[:0], qi[:0], np.zeros(0))


LIKELY = "id long, other long, least double, most double"


def _likely(dims: int, k: int):
    """Per query the rows that may be among its ``k`` best of these leaves, with bounds of their cosines; and how many it saw."""

    def best(a, b, low, high):
        """Of each query those whose upper bound reaches its ``k``-th lower bound."""
        order = np.lexsort((-low, a))
        a, b, low, high = a[order], b[order], low[order], high[order]
        start = np.flatnonzero(np.r_[True, a[1:] != a[:-1]])
        size = np.diff(np.r_[start, len(a)])
        floor = np.where(size >= k, low[np.minimum(start + k - 1, len(a) - 1)], -2.5)
        keep = high >= np.repeat(floor, size)
        return a[keep], b[keep], low[keep], high[keep]

    def run(t: pa.Table) -> pa.Table:
        pairs, ids, x, error = _leaves(t, dims)
        parts, seen = [], np.zeros(len(ids))
        for q, i in pairs:
            seen[q] += len(i)
            for lo in range(0, len(q), 512):
                r = q[lo : lo + 512]
                s, w = x[r] @ x[i].T, slack(error[r], error[i])
                s[ids[r][:, None] == ids[i][None]] = -3
                low = s - w
                floor = np.partition(low, len(i) - k, axis=1)[:, len(i) - k] if len(i) > k else np.full(len(r), -2.5)
                a, b = np.nonzero((s + w >= floor[:, None]) & (s > -2.5))
                parts.append((ids[r[a]], ids[i[b]], low[a, b], (s + w)[a, b]))
        found = tuple(np.concatenate(c) for c in zip(*parts)) if parts else (np.zeros(0, np.int64),) * 2 + (np.zeros(0),) * 2
        found = best(*found) if len(found[0]) else found
        saw = np.flatnonzero(seen)
        a, b, low, high = (np.concatenate(c) for c in zip(found, (ids[saw], np.full(len(saw), -1), seen[saw], np.zeros(len(saw)))))
        return pa.table({"id": pa.array(a.astype(np.int64)), "other": pa.array(b.astype(np.int64)), "least": pa.array(low.astype(np.float64)), "most": pa.array(high.astype(np.float64))})

    return run


def pairs_above(df: DataFrame, row_id: str, vector: str, dims: int, least: float, plan: ForestPlan = ForestPlan()) -> DataFrame:
    """Pairs of usable vectors with a cosine of at least ``least``: ``id_a < id_b, cosine``, each once.

    Unusable vectors take no part.  Vectors of the same direction are indexed
    once; their pairs, and those of each with the class's partners, all come
    out.  An empty table gives an empty result.
    """
    reps, members = classes_of(unit_vectors(df, row_id, vector, dims))
    index = fit(reps, plan, dims)
    spread = _spread(reps, index, dims, 1)
    pairs = spread.groupBy("tree", "part", "block").applyInArrow(_candidates_above(dims, least), "id long, other long").distinct()
    links = _with_cosines(pairs, reps, reps, dims).filter(F.col("cosine") >= least)
    all_members = lambda rep, name: members.select(F.col("rep").alias(rep), F.col("id").alias(name))
    links = links.join(all_members("id", "a"), "id", "left").join(all_members("other", "b"), "other", "left")
    a, b = F.coalesce("a", "id"), F.coalesce("b", "other")
    between = links.select(F.least(a, b).alias("id_a"), F.greatest(a, b).alias("id_b"), "cosine")
    within = all_members("rep", "id_a").join(all_members("rep", "id_b"), "rep").filter("id_a < id_b").select("id_a", "id_b", F.lit(1.0).alias("cosine"))
    return between.unionByName(within)


def _first_members(reps: DataFrame, members: DataFrame, n: int) -> DataFrame:
    """``rep, id``: the ``n`` smallest ids of each class (all that a top-k can need)."""
    salted = members.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(64)))
    first = salted.withColumn("r", F.row_number().over(Window.partitionBy("rep", "salt").orderBy("id"))).filter(F.col("r") <= n)
    first = first.withColumn("r", F.row_number().over(Window.partitionBy("rep").orderBy("id"))).filter(F.col("r") <= n).select("rep", "id")
    single = reps.select(F.col("id").alias("rep")).join(first.select("rep").distinct(), "rep", "left_anti")
    return first.unionByName(single.select("rep", F.col("rep").alias("id")))


def _top(found: DataFrame, k: int) -> DataFrame:
    best = found.groupBy("id", "other").agg(F.max("cosine").alias("cosine"))
    order = Window.partitionBy("id").orderBy(F.col("cosine").desc(), "other")
    return best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _search(reps: DataFrame, queries: DataFrame, index: Index, dims: int, k: int) -> DataFrame:
    """``id, other, least, most``: bounded cosines of the likely best; ``other`` = -1: ``least`` rows of a leaf were compared."""
    spread = _spread(reps, index, dims, 1 << 62).filter("leaf >= 0").unionByName(_spread(queries, index, dims, 1, indexing=False))
    return spread.groupBy("tree", "part", "block").applyInArrow(_likely(dims, k), LIKELY)


def nearest(df: DataFrame, row_id: str, vector: str, dims: int, k: int, plan: ForestPlan, every: int = 1) -> DataFrame:
    """The ``k`` most similar other vectors: ``id, other, cosine, rank, compared``.

    Queries are the usable rows whose id is divisible by ``every``; every usable
    row is indexed.  Ties go to the smaller id.  Copies of a query are its
    nearest neighbours, with cosine 1.  With fewer than ``k`` other usable rows
    all of them come out.  ``compared`` is the number of indexed vectors that
    the query was compared with, counted once per tree.
    """
    vectors = unit_vectors(df, row_id, vector, dims)
    reps, members = classes_of(vectors)
    members = cut(members)
    index = fit(reps, plan, dims)
    # a class asks, through its representative, if any of its members does
    asking = vectors.filter(F.col("id") % every == 0)
    grouped = members.filter(F.col("id") % every == 0).select(F.col("id").alias("asker"), "rep")
    queries = cut(asking.join(members.select("id"), "id", "left_anti").unionByName(reps.join(grouped.select(F.col("rep").alias("id")).distinct(), "id")))
    seen = cut(_search(reps, queries, index, dims, k))
    compared = seen.filter("other = -1").groupBy("id").agg(F.sum("least").cast("long").alias("compared"))
    likely = seen.filter("other <> -1").groupBy("id", "other").agg(F.max("least").alias("least"), F.max("most").alias("most"))
    place = F.row_number().over(Window.partitionBy("id").orderBy(F.col("least").desc()))
    floor = likely.withColumn("r", place).filter(F.col("r") == k).select("id", F.col("least").alias("floor"))
    likely = likely.join(floor, "id", "left").filter("floor is null or most >= floor").select("id", "other")
    top = _top(_with_cosines(likely, queries, reps, dims), k).drop("rank")
    # back from classes to rows
    own = queries.select("id", F.col("id").alias("other"), F.lit(1.0).alias("cosine"))
    first = _first_members(reps, members, k + 1)
    expanded = top.unionByName(own).join(first.select(F.col("rep").alias("other"), F.col("id").alias("row")), "other").select("id", F.col("row").alias("other"), "cosine")
    expanded = expanded.join(compared, "id", "left").fillna(0, ["compared"])
    askers = expanded.join(grouped.select(F.col("rep").alias("id"), "asker"), "id", "left").select(F.coalesce("asker", "id").alias("id"), "other", "cosine", "compared")
    askers = askers.filter((F.col("id") != F.col("other")) & (F.col("id") % every == 0))
    return _top(askers, k).join(askers.groupBy("id").agg(F.max("compared").alias("compared")), "id")


def nearest_exact(df: DataFrame, row_id: str, vector: str, dims: int, k: int, every: int, block: int = 8_192) -> DataFrame:
    """The same by comparing the query set with all rows in blocks; the yardstick for recall."""
    vectors = cut(unit_vectors(df, row_id, vector, dims))
    rows = vectors.count()
    wide, high = max(1, -(-rows // block)), max(1, -(-rows // (every * block)))
    side = lambda n: F.pmod(F.xxhash64("id"), F.lit(n)).cast("int")
    index = vectors.withColumn("col", side(wide)).withColumn("row", F.explode(F.sequence(F.lit(0), F.lit(high - 1))))
    queries = vectors.filter(F.col("id") % every == 0).withColumn("row", side(high)).withColumn("col", F.explode(F.sequence(F.lit(0), F.lit(wide - 1))))

    def compare(q: pa.Table, i: pa.Table) -> pa.Table:
        return _best(q["id"].to_numpy(), matrix(q["vec"], dims), i["id"].to_numpy(), matrix(i["vec"], dims), k)

    found = queries.groupBy("row", "col").cogroup(index.groupBy("row", "col")).applyInArrow(compare, FOUND)
    return _top(found, k)
