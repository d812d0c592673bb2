"""Grouping vectors into clusters of mutually similar ones.

Every partition summarises its rows in a cluster-feature tree; the trees' leaves
are merged in a tree of tasks down to a bounded number, Ward agglomeration joins
the leaves, and one pass over all rows assigns each to its nearest clusters.
These are cells of about a thousand rows.  For clusters defined by links (a least
cosine), links are checked exactly among the rows that share a cell.  For the
division into clusters of mutually similar rows, the same trees and Ward's
agglomeration are applied within every cell and cut by similarity.  Clusters are
described by size and centroid-nearest members.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wellspring.llm.cftree import CFTree, pair_cosine, ward, ward_mutual
from wellspring.llm.neighbours import classes_of, matrix, unit_vectors
from wellspring.session import cut


@dataclass(frozen=True)
class ClusterPlan:
    radius: float = 0.45  # of a cluster feature, to begin with
    leaves: int = 2_048  # of a summary; more in large collections
    most_leaves: int = 8_192  # bound of a summary
    rows_per_leaf: int = 500
    part_rows: int = 20_000
    fan_in: int = 8  # summaries merged by one task
    rows_per_cluster: int = 1_000
    overlap: int = 4  # nearest clusters each row is compared in
    block: int = 8_192  # rows of a cluster in one task
    mutual: float = 0.5  # least mean cosine over the pairs of a cluster of the division

    def leaves_for(self, rows: int) -> int:
        return max(self.leaves, min(self.most_leaves, rows // self.rows_per_leaf))

    def clusters_for(self, rows: int) -> int:
        return max(1, min(self.leaves_for(rows) // 2, rows // self.rows_per_cluster))


FEATURE = "seq int, n double, ls binary, ss double"


def _as_table(tree: CFTree, extra: dict) -> pa.Table:
    n, ls, ss = tree.features() if tree.leaves else (np.zeros(0), np.zeros((0, tree.d)), np.zeros(0))
    cols = {"seq": pa.array(np.arange(len(n), dtype=np.int32)), "n": pa.array(n), "ls": pa.array([row.tobytes() for row in ls], pa.binary()), "ss": pa.array(ss)}
    return pa.table({k: pa.array(np.full(len(n), v, np.int32)) for k, v in extra.items()} | cols)


def _features(t: pa.Table, dims: int, order: tuple[str, ...]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``n, ls, ss`` in a fixed order, whatever the order of arrival."""
    at = np.lexsort([t[c].to_numpy() for c in reversed(order)])
    ls = np.frombuffer(b"".join(t["ls"].to_pylist()), np.float64).reshape(-1, dims)
    return t["n"].to_numpy()[at], ls[at], t["ss"].to_numpy()[at]


def summarise(vectors: DataFrame, plan: ClusterPlan, dims: int, rows: int) -> DataFrame:
    """Cluster features of all ``rows`` rows, a bounded number of them: ``part, seq, n, ls, ss``.

    Rows are taken in the order of their ids and features in a fixed order, so
    that equal tables give equal features.
    """
    parts, most = max(1, -(-rows // plan.part_rows)), plan.leaves_for(rows)

    def build(batches):
        tree = CFTree(dims, plan.radius, most)
        part = 0
        for b in batches:
            if b.num_rows:
                part = b.column("part")[0].as_py()
            tree.insert_rows(matrix(b.column("vec"), dims).astype(np.float64))
        yield from _as_table(tree, {"part": part}).to_batches()

    def merge(t: pa.Table) -> pa.Table:
        tree = CFTree(dims, plan.radius, most)
        n, ls, ss = _features(t, dims, ("part", "seq"))
        for i in np.argsort(-n, kind="stable"):
            tree.insert(n[i], ls[i], ss[i])
        return _as_table(tree, {"part": t["up"][0].as_py()})

    spread = vectors.select("id", "vec").repartition(parts, "id").sortWithinPartitions("id").withColumn("part", F.spark_partition_id())
    features = spread.mapInArrow(build, f"part int, {FEATURE}")
    while parts > 1:
        parts = -(-parts // plan.fan_in)
        features = cut(features).withColumn("up", F.floor(F.col("part") / plan.fan_in).cast("int")).groupBy("up").applyInArrow(merge, f"part int, {FEATURE}")
    return features


def ward_centres(features: DataFrame, clusters: int, dims: int) -> np.ndarray:
    """Unit centroids of the agglomerated leaves; the leaves are of bounded number."""

    def join(t: pa.Table) -> pa.Table:
        n, ls, _ = _features(t, dims, ("part", "seq"))
        label = ward(n, ls, clusters)
        total = np.zeros((label.max() + 1, dims))
        np.add.at(total, label, ls)
        return pa.table({"ls": pa.array([r.tobytes() for r in total], pa.binary())})

    rows = features.groupBy(F.lit(0).alias("all")).applyInArrow(join, "ls binary").toArrow()
    centres = np.frombuffer(b"".join(rows["ls"].to_pylist()), np.float64).reshape(-1, dims)
    size = np.linalg.norm(centres, axis=1, keepdims=True)
    return (centres / np.where(size > 0, size, 1)).astype(np.float32)


def assign(vectors: DataFrame, centres: np.ndarray, overlap: int, dims: int) -> DataFrame:
    """Each row with its ``overlap`` nearest centres: ``cluster, place`` (0 nearest), ``cosine, id, vec``."""
    shared = vectors.sparkSession.sparkContext.broadcast(centres)  # bounded by the summary's leaves
    near = min(overlap, len(centres))

    def run(batches):
        for whole in batches:
            for lo in range(0, whole.num_rows, 2_000):
                b = whole.slice(lo, 2_000)
                s = matrix(b.column("vec"), dims) @ shared.value.T
                top = np.argsort(-s, axis=1, kind="stable")[:, :near].astype(np.int32)
                rows = b.take(pa.array(np.repeat(np.arange(len(s)), near)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(top.ravel()), pa.array(np.tile(np.arange(near, dtype=np.int32), len(s))), pa.array(np.take_along_axis(s, top, 1).ravel().astype(np.float64)), rows.column("id"), rows.column("vec")],
                    names=["cluster", "place", "cosine", "id", "vec"],
                )

    return vectors.mapInArrow(run, "cluster int, place int, cosine double, id long, vec binary")


def _components(ids: np.ndarray, x: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Rows with at least one link and the smallest id of their component among these rows."""

    def links(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        s = a @ b.T
        linked = s >= least
        for r, c in zip(*np.nonzero(np.abs(s - least) < 2e-6)):  # too close for single precision
            linked[r, c] = a[r].astype(np.float64) @ b[c].astype(np.float64) >= least
        return linked

    degree = np.concatenate([links(x[lo : lo + 512], x).sum(1) for lo in range(0, len(x), 512)]) if len(x) else np.zeros(0)
    some = np.flatnonzero(degree > 1)
    ids, x = ids[some], x[some]
    order = np.argsort(ids)
    ids, x = ids[order], x[order]
    root = np.full(len(ids), -1, np.int64)
    rest = np.arange(len(ids))
    while len(rest):
        first, front = rest[0], rest[:1]
        root[first] = ids[first]
        rest = rest[1:]
        while len(front) and len(rest):
            hit = np.zeros(len(rest), bool)
            for lo in range(0, len(front), 512):
                hit |= links(x[front[lo : lo + 512]], x[rest]).any(0)
            front, rest = rest[hit], rest[~hit]
            root[front] = ids[first]
    return ids, root


def _settle(edges: DataFrame) -> DataFrame:
    """``id, label``: the smallest id connected over ``id, group`` memberships."""
    edges = cut(edges)
    labels = cut(edges.select("id").distinct().withColumn("label", F.col("id")))
    while True:
        low = edges.join(labels, "id").groupBy("group").agg(F.min("label").alias("low"))
        stepped = edges.join(low, "group").groupBy("id").agg(F.min("low").alias("step"))
        jump = stepped.select(F.col("id").alias("step"), F.col("step").alias("jump"))
        moved = labels.join(stepped, "id").join(jump, "step", "left").select("id", "label", F.least("label", "step", F.coalesce("jump", "step")).alias("next"))
        moved = cut(moved, looping=True)
        changed = not moved.filter("next < label").isEmpty()
        labels = moved.select("id", F.col("next").alias("label"))
        if not changed:
            return labels


def linked_clusters(df: DataFrame, row_id: str, vector: str, dims: int, least: float, least_size: int, plan: ClusterPlan = ClusterPlan()) -> DataFrame:
    """``id, cluster_key``: members of the sets that cosines of at least ``least`` connect.

    Sets of fewer than ``least_size`` rows are left out; copies of a row count
    as rows.  ``cluster_key`` is a set's smallest id.  Unusable vectors take no
    part; an empty table gives an empty result.  Only links that were checked
    count, so no sets are joined wrongly; links are looked for among the rows
    that share one of their ``overlap`` nearest clusters.
    """
    vectors = unit_vectors(df, row_id, vector, dims)
    reps, members = classes_of(vectors)
    rows = reps.count()
    if not rows:
        return vectors.select("id", F.col("id").alias("cluster_key")).limit(0)
    centres = ward_centres(summarise(reps, plan, dims, rows), plan.clusters_for(rows), dims)
    near = assign(reps, centres, plan.overlap, dims)
    sizes = near.groupBy("cluster").count().collect()  # one number per cluster, of which there is a bounded number
    most = max(r["count"] for r in sizes)
    if most > plan.block:
        pieces = F.broadcast(df.sparkSession.createDataFrame([(r["cluster"], -(-r["count"] // plan.block)) for r in sizes], "cluster int, pieces long"))
        own = F.pmod(F.xxhash64("id"), F.col("pieces")).cast("int")
        near = near.join(pieces, "cluster").withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("pieces").cast("int") - 1)))
        near = near.withColumn("a", F.least("own", "other")).withColumn("b", F.greatest("own", "other"))
    else:
        near = near.withColumn("a", F.lit(0)).withColumn("b", F.lit(0))

    def check(t: pa.Table) -> pa.Table:
        ids, root = _components(t["id"].to_numpy(), matrix(t["vec"], dims), least)
        where = f"{t['cluster'][0]}/{t['a'][0]}/{t['b'][0]}/"
        return pa.table({"id": pa.array(ids, pa.int64()), "group": pa.array([where + str(r) for r in root], pa.string())})

    edges = near.select("cluster", "a", "b", "id", "vec").groupBy("cluster", "a", "b").applyInArrow(check, "id long, group string")
    labels = _settle(edges)
    copies = members.join(labels.withColumnRenamed("id", "rep"), "rep", "left").select("id", F.coalesce("label", "rep").alias("cluster_key"))
    single = labels.join(members.select("id"), "id", "left_anti").select("id", F.col("label").alias("cluster_key"))
    all_rows = cut(single.unionByName(copies))
    large = all_rows.groupBy("cluster_key").count().filter(F.col("count") >= least_size).select("cluster_key")
    return all_rows.join(large, "cluster_key").select("id", "cluster_key")


def describe(vectors: DataFrame, membership: DataFrame, dims: int, typical: int = 5) -> DataFrame:
    """Per cluster its size and the members nearest its centroid.

    ``cluster_key, size, typical_ids, mean_cosine, least_cosine`` (with the
    centroid) and ``pair_cosine`` (mean over all pairs of members; 1 if alone).

    ``membership`` is ``id, cluster_key``.  Sums are formed per batch before the
    shuffle, so a cluster of any size is never gathered.  Ties go to smaller ids.
    """
    both = cut(membership.join(vectors, "id"))

    def partial(batches):
        for b in batches:
            if b.num_rows:
                key, of = np.unique(b.column("cluster_key").to_numpy(), return_inverse=True)
                total = np.zeros((len(key), dims))
                np.add.at(total, of, matrix(b.column("vec"), dims).astype(np.float64))
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(np.bincount(of)), pa.array(list(total), pa.list_(pa.float64()))], names=["cluster_key", "n", "ls"])

    sums = both.select("cluster_key", "vec").mapInArrow(partial, "cluster_key long, n long, ls array<double>")
    centre = sums.groupBy("cluster_key").agg(F.sum("n").alias("size"), *[F.sum(F.col("ls")[i]).alias(f"d{i}") for i in range(dims)])
    centre = centre.select("cluster_key", "size", F.array(*[F.col(f"d{i}") for i in range(dims)]).alias("ls"))

    def cosine(batches):
        for b in batches:
            c = np.asarray(b.column("ls").flatten()).reshape(-1, dims)
            x = matrix(b.column("vec"), dims)
            s = np.einsum("ij,ij->i", x, c) / np.maximum(np.linalg.norm(c, axis=1), 1e-300)
            mutual = pair_cosine(b.column("size").to_numpy().astype(float), c)
            yield pa.RecordBatch.from_arrays([b.column("cluster_key"), b.column("size"), b.column("id"), pa.array(s), pa.array(mutual)], names=["cluster_key", "size", "id", "cosine", "mutual"])

    near = both.join(centre, "cluster_key").select("cluster_key", "size", "id", "vec", "ls").mapInArrow(cosine, "cluster_key long, size long, id long, cosine double, mutual double")
    # the best few of every salt, then of the cluster
    from pyspark.sql.window import Window

    order = [F.col("cosine").desc(), F.col("id")]
    salted = near.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(32)))
    few = salted.withColumn("r", F.row_number().over(Window.partitionBy("cluster_key", "salt").orderBy(*order))).filter(F.col("r") <= typical)
    few = few.withColumn("r", F.row_number().over(Window.partitionBy("cluster_key").orderBy(*order))).filter(F.col("r") <= typical)
    names = few.groupBy("cluster_key", "size").agg(F.transform(F.array_sort(F.collect_list(F.struct("r", "id"))), lambda s: s["id"]).alias("typical_ids"))
    shape = near.groupBy("cluster_key").agg(*[F.round(f("cosine"), 6).alias(name) for f, name in ((F.avg, "mean_cosine"), (F.min, "least_cosine"))], F.round(F.max("mutual"), 6).alias("pair_cosine"))
    return names.join(shape, "cluster_key")


def _in_pieces(near: DataFrame, plan: ClusterPlan) -> DataFrame:
    """``piece`` of each row: cells of more than ``plan.block`` rows are cut by a hash."""
    sizes = near.groupBy("cluster").agg(F.ceil(F.count(F.lit(1)) / plan.block).cast("int").alias("pieces"))  # one row per cell
    return near.join(F.broadcast(sizes), "cluster").withColumn("piece", F.pmod(F.xxhash64("id"), F.col("pieces")).cast("int"))


def _smallest(ids: np.ndarray, label: np.ndarray) -> np.ndarray:
    """Of each row the smallest id with its label."""
    first = np.full(label.max() + 1, np.iinfo(np.int64).max)
    np.minimum.at(first, label, ids)
    return first[label]


def _clusters_of_cell(x: np.ndarray, plan: ClusterPlan) -> np.ndarray:
    """The division of one cell: each row's cluster, by a cluster-feature tree and Ward's agglomeration of its leaves."""
    tree = CFTree(x.shape[1], plan.radius, 1 << 60)
    tree.insert_rows(x)
    n, ls, _ = tree.features()
    label = ward_mutual(n, ls, plan.mutual)
    centre = ls / np.maximum(np.linalg.norm(ls, axis=1, keepdims=True), 1e-300)
    leaf = np.concatenate([(x[lo : lo + 1_024] @ centre.T).argmax(1) for lo in range(0, len(x), 1_024)])
    return label[leaf]


def ward_division(df: DataFrame, row_id: str, vector: str, dims: int, plan: ClusterPlan = ClusterPlan()) -> DataFrame:
    """Every usable row in a cluster of mutually similar rows: ``id, cluster_key`` (key: the cluster's smallest id).

    Within each cell Ward's agglomeration joins leaves as long as the mean cosine
    over a cluster's pairs stays at least ``plan.mutual``; rows that resemble no
    others are clusters of one.  Copies of a direction are divided once and stay
    together.  Then the clusters of all cells are agglomerated once more in cells
    four times as wide.  Cells of more than ``plan.block`` directions are divided
    in pieces.
    """
    vectors = unit_vectors(df, row_id, vector, dims)
    reps, members = classes_of(vectors)
    rows = reps.count()
    if not rows:
        return vectors.select("id", F.col("id").alias("cluster_key"))
    centres = ward_centres(summarise(reps, plan, dims, rows), plan.clusters_for(rows), dims)
    near = cut(_in_pieces(assign(reps, centres, 1, dims), plan))

    def divide(t: pa.Table) -> pa.Table:
        order = np.argsort(t["id"].to_numpy())
        ids, x = t["id"].to_numpy()[order], matrix(t["vec"], dims)[order].astype(np.float64)
        label = _clusters_of_cell(x, plan)
        return pa.table({"id": pa.array(ids), "key": pa.array(_smallest(ids, label)), "vec": t["vec"].combine_chunks().take(pa.array(order))})

    parts = cut(near.select("cluster", "piece", "id", "vec").groupBy("cluster", "piece").applyInArrow(divide, "id long, key long, vec binary"))

    def sums(batches):
        for b in batches:
            if b.num_rows:
                key, of = np.unique(b.column("key").to_numpy(), return_inverse=True)
                total = np.zeros((len(key), dims))
                np.add.at(total, of, matrix(b.column("vec"), dims).astype(np.float64))
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(np.bincount(of)), pa.array(list(total), pa.list_(pa.float64()))], names=["key", "n", "ls"])

    found = parts.select("key", "vec").mapInArrow(sums, "key long, n long, ls array<double>")
    found = found.groupBy("key").agg(F.sum("n").alias("n"), F.array(*[F.sum(F.col("ls")[i]) for i in range(dims)]).alias("ls"))
    # once more over cells four times as wide, where clusters that lay on both sides of a border meet
    wider = ward(np.ones(len(centres)), centres.astype(np.float64), max(1, len(centres) // 4))
    wide = np.zeros((wider.max() + 1, dims))
    np.add.at(wide, wider, centres)
    wide = (wide / np.maximum(np.linalg.norm(wide, axis=1, keepdims=True), 1e-12)).astype(np.float32)

    def pack(batches):
        for b in batches:
            x = np.asarray(b.column("ls").flatten()).reshape(-1, dims)
            unit = (x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-300)).astype(np.float32)
            yield pa.RecordBatch.from_arrays([b.column("key"), pa.array([r.tobytes() for r in unit], pa.binary())], names=["id", "vec"])

    def rejoin(t: pa.Table) -> pa.Table:
        order = np.argsort(t["id"].to_numpy())
        key, n = t["id"].to_numpy()[order], t["n"].to_numpy()[order].astype(float)
        ls = np.asarray(t["ls"].combine_chunks().flatten()).reshape(-1, dims)[order]
        return pa.table({"key": pa.array(key), "whole": pa.array(_smallest(key, ward_mutual(n, ls, plan.mutual)))})

    found = cut(found)
    met = _in_pieces(assign(found.select("key", "ls").mapInArrow(pack, "id long, vec binary"), wide, 1, dims), plan).select("cluster", "piece", "id")
    whole = met.join(found.withColumnRenamed("key", "id"), "id").groupBy("cluster", "piece").applyInArrow(rejoin, "key long, whole long")
    keyed = cut(parts.join(whole, "key").select("id", F.col("whole").alias("cluster_key")))
    copies = members.join(keyed.withColumnRenamed("id", "rep"), "rep").select("id", "cluster_key")
    return keyed.join(members.select("id"), "id", "left_anti").unionByName(copies)
