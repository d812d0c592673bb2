"""Similarity of profiles: pair statistics per label, label-to-label medians, replicate statistics.

Means and deviations over all pairs of a label follow from sums of unit vectors
and of their products, so no pairs are formed for them.  Where every similarity
counts, blocks of bounded size are multiplied inside a task and only counts of
similarities, rounded to ``DIGITS``, or medians leave it.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wellspring.session import cut

BLOCK = 2_048
DIGITS = 4


def row_ranks(x: np.ndarray, ordinal: bool = False) -> np.ndarray:
    """Ranks within each row from 1; ties get their average, or their order if ``ordinal``."""
    order = np.argsort(x, axis=1, kind="stable")
    n = x.shape[1]
    place = np.broadcast_to(np.arange(n), x.shape)
    if not ordinal:
        s = np.take_along_axis(x, order, 1)
        new = np.concatenate([np.ones((len(x), 1), bool), s[:, 1:] != s[:, :-1]], 1)
        first = np.maximum.accumulate(np.where(new, place, 0), axis=1)
        end = np.concatenate([new[:, 1:], np.ones((len(x), 1), bool)], 1)
        last = np.minimum.accumulate(np.where(end, place, n)[:, ::-1], axis=1)[:, ::-1]
        place = (first + last) / 2
    out = np.empty(x.shape)
    np.put_along_axis(out, order, place + 1, 1)
    return out


def unit_rows(x: np.ndarray, kind: str, limit: float = 25.0) -> np.ndarray:
    """Rows whose dot products are the similarities of ``kind``; degenerate rows become zero.

    cosine, pearson (values held within +-``limit``), spearman (average ranks),
    ordinal (Pearson on ordinal ranks).
    """
    if kind == "pearson":
        x = np.clip(x, -limit, limit)
    elif kind in ("spearman", "ordinal"):
        x = row_ranks(x, kind == "ordinal")
    if kind != "cosine":
        x = x - x.mean(1, keepdims=True)
    size = np.sqrt((x * x).sum(1, keepdims=True))
    return np.where(size > 1e-12, x / np.where(size > 0, size, 1), 0.0)


def prepared(df: DataFrame, row_id: str, group: str, label: str, vector: str, dims: int, kind: str) -> DataFrame:
    """``id, grp, label, vec`` of rows with a label and ``dims`` finite values."""

    def run(batches):
        for b in batches:
            x = np.asarray(b.column("v").flatten().to_numpy(zero_copy_only=False), np.float64).reshape(-1, dims)
            u = np.ascontiguousarray(unit_rows(x, kind)) if len(x) else x
            ends = np.arange(len(u) + 1, dtype=np.int32) * dims * 8
            vec = pa.Array.from_buffers(pa.binary(), len(u), [None, pa.py_buffer(ends), pa.py_buffer(u)])
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in ("id", "grp", "label")), vec], names=["id", "grp", "label", "vec"])

    finite = F.forall(F.col(vector), lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    rows = df.filter((F.size(vector) == dims) & finite & F.col(label).isNotNull() & F.col(group).isNotNull())
    rows = rows.select(F.col(row_id).cast("long").alias("id"), F.col(group).cast("string").alias("grp"), F.col(label).cast("string").alias("label"), F.col(vector).cast("array<double>").alias("v"))
    return rows.mapInArrow(run, "id long, grp string, label string, vec binary")


def _matrix(column, dims: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.float64).reshape(-1, dims)


def label_moments(rows: DataFrame, keys: list[str], dims: int) -> DataFrame:
    """``*keys, n, n_pairs, total, squares``: over all unordered pairs with equal keys, sums of s and s*s.

    sum s = (|sum u|^2 - sum |u|^2) / 2 and sum s*s = (|sum u u'|^2 - sum |u|^4) / 2.
    Hot keys are cut into chunks whose sums are added up by Spark.
    """
    sizes = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    salted = rows.join(sizes, keys).withColumn("salt", F.pmod(F.xxhash64("id"), F.ceil(F.col("n") / BLOCK)).cast("int"))

    def sums(t: pa.Table) -> pa.Table:
        u = _matrix(t["vec"], dims)
        s, g = u.sum(0), u.T @ u
        own, own2 = float((u * u).sum()), float(((u * u).sum(1) ** 2).sum())
        many = t["n"][0].as_py() > BLOCK
        cols = {k: [t[k][0].as_py()] for k in keys}
        cols |= {"n": [len(u)], "own": [own], "own2": [own2], "total": [None if many else float(s @ s - own) / 2], "squares": [None if many else float((g * g).sum() - own2) / 2]}
        cols |= {"s": pa.array([s.tolist() if many else None], pa.list_(pa.float64())), "g": pa.array([g.ravel().tolist() if many else None], pa.list_(pa.float64()))}
        return pa.table({k: (v if isinstance(v, pa.Array) else pa.array(v, pa.string() if k in keys else pa.int64() if k == "n" else pa.float64())) for k, v in cols.items()})

    head = ", ".join(f"{k} string" for k in keys)
    parts = cut(salted.select(*keys, "salt", "n", "vec").groupBy(*keys, "salt").applyInArrow(sums, f"{head}, n long, own double, own2 double, total double, squares double, s array<double>, g array<double>"))
    whole = parts.filter("total is not null").select(*keys, "n", "total", "squares")
    split = parts.filter("total is null")
    base = split.groupBy(*keys).agg(F.sum("n").alias("n"), F.sum("own").alias("own"), F.sum("own2").alias("own2"))
    norm = lambda c, name: split.select(*keys, F.posexplode(c)).groupBy(*keys, "pos").agg(F.sum("col").alias("x")).groupBy(*keys).agg(F.sum(F.col("x") * F.col("x")).alias(name))
    hot = base.join(norm("s", "ss"), keys).join(norm("g", "gg"), keys)
    hot = hot.select(*keys, "n", ((F.col("ss") - F.col("own")) / 2).alias("total"), ((F.col("gg") - F.col("own2")) / 2).alias("squares"))
    both = whole.unionByName(hot)
    return both.select(*keys, "n", (F.col("n") * (F.col("n") - 1) / 2).cast("long").alias("n_pairs"), "total", "squares")


def replicate_similarity(rows: DataFrame, dims: int) -> DataFrame:
    """``label, n, mean_sim, std_sim`` over each label's pairs (population deviation; null without pairs)."""
    m = label_moments(rows, ["label"], dims)
    mean = F.try_divide("total", "n_pairs")
    spread = F.when(F.col("n_pairs") > 0, F.sqrt(F.greatest(F.lit(0.0), F.try_divide("squares", "n_pairs") - mean * mean)))
    return m.select("label", "n", F.round(mean, 6).alias("mean_sim"), F.round(spread, 6).alias("std_sim"))


def cohens_d(rows: DataFrame, dims: int) -> DataFrame:
    """Signal (pairs of one label) against noise (pairs of two), every pair counted in both directions."""
    same = label_moments(rows, ["label"], dims).agg(F.sum("n_pairs").alias("n1"), F.sum("total").alias("t1"), F.sum("squares").alias("q1"))
    every = label_moments(rows.withColumn("everything", F.lit("all")), ["everything"], dims).select(F.col("n_pairs").alias("n"), F.col("total").alias("t"), F.col("squares").alias("q"))
    m = same.join(every)  # one row each
    n1, t1, q1 = 2 * F.col("n1"), 2 * F.col("t1"), 2 * F.col("q1")
    n0, t0, q0 = 2 * (F.col("n") - F.col("n1")), 2 * (F.col("t") - F.col("t1")), 2 * (F.col("q") - F.col("q1"))
    mean1, mean0 = F.try_divide(t1, n1), F.try_divide(t0, n0)
    var = lambda n, t, q: F.try_divide(q - F.try_divide(t * t, n), n - 1)
    pooled = F.sqrt(F.try_divide((n1 - 1) * var(n1, t1, q1) + (n0 - 1) * var(n0, t0, q0), n1 + n0 - 2))
    d = F.when(pooled == 0, 0.0).otherwise((mean1 - mean0) / pooled)
    return m.select(F.round(mean1, 6).alias("mean_signal"), F.round(mean0, 6).alias("mean_noise"), F.round(pooled, 6).alias("pooled_std"), F.round(d, 6).alias("cohens_d"))


def _grid(rows: DataFrame, by_label: bool) -> DataFrame:
    """Rows of a group spread over pairs of blocks (a <= b), each row with its own block's number."""
    sizes = rows.groupBy("grp").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    key = F.xxhash64("label") if by_label else F.xxhash64("id")
    placed = rows.join(sizes, "grp").withColumn("own", F.pmod(key, F.col("blocks")).cast("int"))
    return placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).withColumn("a", F.least("own", "other")).withColumn("b", F.greatest("own", "other")).drop("blocks", "other")


def _sides(t: pa.Table, dims: int):
    x, own = _matrix(t["vec"], dims), t["own"].to_numpy()
    label = np.array(t["label"].to_pylist(), object)
    ids = t["id"].to_numpy()
    a, b = t["a"][0].as_py(), t["b"][0].as_py()
    return x, label, ids, np.flatnonzero(own == a), np.flatnonzero(own == b), a == b


def similarity_counts(rows: DataFrame, dims: int) -> DataFrame:
    """``grp, same, sim, n``: pairs of a group by similarity (held within 0 and 1, ``DIGITS`` digits)."""

    def count(t: pa.Table) -> pa.Table:
        x, label, ids, left, right, diagonal = _sides(t, dims)
        names, code = np.unique(label.astype(str), return_inverse=True)
        tally: dict[int, np.ndarray] = {0: np.zeros(10**DIGITS + 1, np.int64), 1: np.zeros(10**DIGITS + 1, np.int64)}
        for lo in range(0, len(left), 256):
            rows_ = left[lo : lo + 256]
            s = np.floor(np.clip(x[rows_] @ x[right].T, 0, 1) * 10**DIGITS + 0.5).astype(int)
            keep = ids[rows_][:, None] < ids[right][None] if diagonal else np.ones(s.shape, bool)
            equal = code[rows_][:, None] == code[right][None]
            for k in (0, 1):
                tally[k] += np.bincount(s[keep & (equal == bool(k))], minlength=10**DIGITS + 1)
        same, sim, n = [], [], []
        for k, c in tally.items():
            at = np.flatnonzero(c)
            same += [bool(k)] * len(at)
            sim += (at / 10**DIGITS).tolist()
            n += c[at].tolist()
        return pa.table({"grp": pa.array([t["grp"][0].as_py()] * len(n), pa.string()), "same": pa.array(same, pa.bool_()), "sim": pa.array(sim, pa.float64()), "n": pa.array(n, pa.int64())})

    cells = _grid(rows, False).select("grp", "a", "b", "own", "id", "label", "vec")
    return cells.groupBy("grp", "a", "b").applyInArrow(count, "grp string, same boolean, sim double, n long").groupBy("grp", "same", "sim").agg(F.sum("n").alias("n"))


def fdr_threshold(counts: DataFrame, alpha: float = 0.05, n_null: int = 1_000) -> DataFrame:
    """``grp, threshold, n_rejected``: the least same-label similarity that survives false-discovery control.

    The null is ``min(n_null, cross pairs)`` cross-label similarities, drawn with
    replacement at places that a golden-ratio sequence fixes.  A pair's p is the
    share of the null at or above it, at least 1/n.  If none survives, the 95th
    percentile of the null; 0 without same-label pairs.
    """
    counts = cut(counts)
    cross = counts.filter("not same")
    total = cross.groupBy("grp").agg(F.sum("n").alias("m"))
    upto = F.sum("n").over(Window.partitionBy("grp").orderBy("sim"))
    ranked = cross.withColumn("upto", upto).withColumn("from", F.col("upto") - F.col("n"))
    draws = total.withColumn("n_null", F.least(F.lit(n_null), F.col("m")).cast("int")).withColumn("k", F.explode(F.sequence(F.lit(0), F.col("n_null") - 1)))
    part = (F.col("k") + 0.5) * 0.6180339887498949
    draws = draws.withColumn("at", F.least(F.floor((part - F.floor(part)) * F.col("m")), F.col("m") - 1))
    null = cut(draws.join(ranked, "grp").filter("at >= from and at < upto").groupBy("grp", "n_null", "sim").agg(F.count(F.lit(1)).alias("c")))
    same = counts.filter("same").select("grp", "sim", "n")
    # nulls at or above each similarity: one running sum over both kinds
    merged = same.select("grp", "sim", "n", F.lit(0).cast("long").alias("c")).unionByName(null.select("grp", "sim", F.lit(0).cast("long").alias("n"), "c"))
    above = F.sum("c").over(Window.partitionBy("grp").orderBy(F.col("sim").desc()))
    sizes = null.select("grp", "n_null").distinct()
    p = F.greatest(F.col("above") / F.col("n_null"), 1 / F.col("n_null"))
    scored = merged.withColumn("above", above).filter("n > 0").join(sizes, "grp").withColumn("p", p)
    k = F.sum("n").over(Window.partitionBy("grp").orderBy("p"))
    m = scored.groupBy("grp").agg(F.sum("n").alias("tests"))
    stepped = scored.withColumn("k", k).join(m, "grp").withColumn("ok", F.col("p") <= F.col("k") / F.col("tests") * alpha)
    limit = stepped.groupBy("grp").agg(F.max(F.when(F.col("ok"), F.col("p"))).alias("p_limit"), F.coalesce(F.max(F.when(F.col("ok"), F.col("k"))), F.lit(0)).alias("n_rejected"))
    survivors = stepped.join(limit, "grp").filter("p <= p_limit").groupBy("grp").agg(F.min("sim").alias("survivor"))
    ahead = F.sum("c").over(Window.partitionBy("grp").orderBy("sim"))
    p95 = null.withColumn("upto", ahead).filter(F.col("upto") >= F.col("n_null") * 0.95).groupBy("grp").agg(F.min("sim").alias("p95"))
    out = counts.select("grp").distinct().join(limit, "grp", "left").join(survivors, "grp", "left").join(p95, "grp", "left")
    none = F.col("n_rejected").isNull()
    return out.select("grp", F.when(none, 0.0).otherwise(F.coalesce("survivor", "p95")).alias("threshold"), F.coalesce("n_rejected", F.lit(0)).alias("n_rejected"))


def label_pairs(rows: DataFrame, dims: int, least: float | DataFrame, same_only: bool = False) -> DataFrame:
    """``grp, label_a, label_b, similarity, n_pairs``: medians over all replicate pairs of two labels, where at least ``least``.

    ``least`` is one value or a table ``grp, threshold`` with a value for each
    group.  Labels equal to themselves come out too (``label_a = label_b``)
    where they have two rows, whatever their median (only they with
    ``same_only``).  Rows are hashed by label into blocks; a label with more rows
    than a block is cut, and its medians follow from counts of similarities at
    ``DIGITS`` digits.
    """
    cap = BLOCK
    rows = rows.join(F.broadcast(least.select("grp", F.col("threshold").alias("least"))), "grp") if isinstance(least, DataFrame) else rows.withColumn("least", F.lit(float(least)))
    heavy = rows.groupBy("grp", "label").agg(F.count(F.lit(1)).alias("c")).filter(F.col("c") > cap)
    marked = rows.join(heavy, ["grp", "label"], "left").withColumn("pieces", F.ceil(F.coalesce("c", F.lit(1)) / cap).cast("int"))
    sizes = rows.groupBy("grp").agg(F.ceil(F.count(F.lit(1)) / cap).cast("int").alias("blocks"))
    own = F.pmod(F.xxhash64("label", F.when(F.col("pieces") > 1, F.pmod(F.xxhash64("id"), F.col("pieces")))), F.col("blocks")).cast("int")
    placed = marked.join(sizes, "grp").withColumn("own", own).withColumn("split", F.col("pieces") > 1)
    placed = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).withColumn("a", F.least("own", "other")).withColumn("b", F.greatest("own", "other"))

    def medians(t: pa.Table) -> pa.Table:
        x, label, ids, left, right, diagonal = _sides(t, dims)
        names, code = np.unique(label.astype(str), return_inverse=True)
        split = np.zeros(len(names), bool)
        np.logical_or.at(split, code, t["split"].to_numpy(zero_copy_only=False))
        low = t["least"][0].as_py()
        out: list[tuple] = []
        left = left[np.argsort(code[left], kind="stable")]
        right = right[np.argsort(code[right], kind="stable")]
        starts = np.flatnonzero(np.r_[True, np.diff(code[right]) != 0]) if len(right) else np.array([], int)
        ends = np.r_[starts[1:], len(right)]
        lone = ends - starts == 1
        single = starts[lone]
        many = [(lo, hi) for lo, hi, one in zip(starts, ends, lone) if not one or split[code[right[lo]]]]
        for i in np.unique(code[left]):
            mine = left[code[left] == i]
            s = np.clip(x[mine] @ x[right].T, 0, 1)
            # labels with one row on the right: their medians at once
            j = code[right[single]]
            bulk = np.median(s[:, single], axis=0) if len(single) else np.zeros(0)
            good = (bulk >= low) & (j != i) & ~split[j] & (not split[i]) & (not same_only) & ((j > i) | (not diagonal))
            at = j[good]
            out.append((np.minimum(at, i), np.maximum(at, i), bulk[good], np.full(len(at), len(mine)), np.zeros(len(at), bool)))
            for lo, hi in many if not split[i] else zip(starts, ends):
                j = code[right[lo]]
                if diagonal and j < i or same_only and names[i] != names[j]:
                    continue
                v = s[:, lo:hi]
                v = v[ids[mine][:, None] < ids[right[lo:hi]][None]] if diagonal and i == j else v.ravel()
                if not len(v):
                    continue
                pair = min(i, j), max(i, j)
                if split[i] or split[j]:
                    at, n = np.unique(np.floor(v * 10**DIGITS + 0.5) / 10**DIGITS, return_counts=True)
                    out.append((np.full(len(at), pair[0]), np.full(len(at), pair[1]), at, n, np.ones(len(at), bool)))
                else:
                    m = float(np.median(v))
                    if m >= low or i == j:
                        out.append(([pair[0]], [pair[1]], [m], [len(v)], [False]))
        cols = [np.concatenate(c) for c in zip(*out)] if out else [np.zeros(0, int)] * 5
        kinds = (np.int64, np.int64, np.float64, np.int64, bool)
        a, b, similarity, n_pairs, counted = (pa.array(c.astype(k)) for c, k in zip(cols, kinds))
        known = pa.array(names.tolist(), pa.string())
        grp = pa.array([t["grp"][0].as_py()], pa.string()).take(pa.array(np.zeros(len(a), np.int64)))
        return pa.table({"grp": grp, "label_a": known.take(a), "label_b": known.take(b), "similarity": similarity, "n_pairs": n_pairs, "counted": counted, "least": pa.array(np.full(len(a), low))})

    found = cut(placed.select("grp", "a", "b", "own", "id", "label", "split", "least", "vec").groupBy("grp", "a", "b").applyInArrow(medians, "grp string, label_a string, label_b string, similarity double, n_pairs long, counted boolean, least double"))
    keys = ["grp", "label_a", "label_b"]
    counts = found.filter("counted").groupBy(*keys, "least", "similarity").agg(F.sum("n_pairs").alias("n"))
    window = Window.partitionBy(*keys)
    upto = F.sum("n").over(window.orderBy("similarity"))
    hot = counts.withColumn("upto", upto).withColumn("total", F.sum("n").over(window))
    middle = [F.floor((F.col("total") - 1) / 2), F.floor(F.col("total") / 2)]
    holds = [F.when((F.col("upto") > m) & (F.col("upto") - F.col("n") <= m), F.col("similarity")) for m in middle]
    hot = hot.groupBy(*keys, "least", "total").agg(*[F.max(h).alias(f"m{i}") for i, h in enumerate(holds)])
    hot = hot.withColumn("similarity", (F.col("m0") + F.col("m1")) / 2).filter("similarity >= least or label_a = label_b").select(*keys, "similarity", F.col("total").alias("n_pairs"))
    return found.filter("not counted").drop("counted", "least").unionByName(hot)


def average_precision(rows: DataFrame, dims: int) -> DataFrame:
    """``id, label, ap, n_positive``: average precision of finding a row's label among its group by similarity.

    Ties in similarity go to the smaller id.  Rows without another row of their
    label have no ap.  Queries stand in blocks of at most about ``BLOCK`` rows by
    label (hot labels by row).  A task first reads the rows of its block's labels,
    then all rows of the group batch by batch, and counts how many stand before
    each positive, so it never holds a group.
    """
    size = F.ceil(F.count(F.lit(1)) / BLOCK).cast("int")
    pieces = rows.groupBy("grp", "label").agg(size.alias("pieces"))
    blocks = rows.groupBy("grp").agg(size.alias("blocks"))
    placed = rows.join(pieces, ["grp", "label"]).join(blocks, "grp")
    home = lambda piece: F.pmod(F.xxhash64("label", piece), F.col("blocks")).cast("int")
    own = F.pmod(F.xxhash64("id"), F.col("pieces")).cast("int")
    homes = F.array_distinct(F.transform(F.sequence(F.lit(0), F.col("pieces") - 1), home))
    every = F.sequence(F.lit(0), F.col("blocks") - 1)
    role = lambda n, block: placed.select("grp", block.alias("block"), F.lit(n).alias("role"), "id", "label", "vec")
    asked = role(0, home(own)).unionByName(role(1, F.explode(homes))).unionByName(role(2, F.explode(every)))
    asked = asked.repartition("grp", "block").sortWithinPartitions("grp", "block", "role", "id")

    def run(batches):
        block = _RankBlock(dims)
        for b in batches:
            key = list(zip(b.column("grp").to_pylist(), b.column("block").to_pylist(), b.column("role").to_pylist()))
            edges = [0, *[i for i in range(1, len(key)) if key[i] != key[i - 1]], len(key)]
            for lo, hi in zip(edges, edges[1:]):
                if hi == lo:
                    continue
                if key[lo][:2] != block.key:
                    yield from block.result()
                    block = _RankBlock(dims, key[lo][:2])
                part = b.slice(lo, hi - lo)
                block.take(key[lo][2], part.column("id").to_numpy(), np.array(part.column("label").to_pylist(), object).astype(str), _matrix(part.column("vec"), dims))
        yield from block.result()

    return asked.mapInArrow(run, "id long, label string, ap double, n_positive long")


class _RankBlock:
    """The queries of one block, the similarities of their positives, and how many rows stand before each."""

    def __init__(self, dims: int, key: tuple | None = None):
        self.dims, self.key = dims, key
        self.parts: dict[int, list] = {0: [], 1: []}
        self.places: list[tuple[np.ndarray, np.ndarray]] | None = None

    def take(self, role: int, ids: np.ndarray, labels: np.ndarray, x: np.ndarray) -> None:
        if role < 2:
            self.parts[role].append((ids, labels, x))
        elif self.parts[0]:  # a block may have no queries
            self._prepare()
            self._count(ids, x)

    def _prepare(self) -> None:
        if self.places is not None:
            return
        self.ids, self.labels, self.x = (np.concatenate(c) for c in zip(*self.parts[0]))
        ids, labels, x = (np.concatenate(c) for c in zip(*self.parts[1]))
        self.places, self.before = [], []
        of = {name: np.flatnonzero(labels == name) for name in np.unique(self.labels)}
        for i, name, q in zip(self.ids, self.labels, self.x):
            at = of[name][ids[of[name]] != i]
            s = np.round(x[at] @ q, 9)
            order = np.lexsort((ids[at], -s))
            self.places.append((-s[order], ids[at][order]))
            self.before.append(np.zeros(len(at) + 1, np.int64))

    def _count(self, ids: np.ndarray, x: np.ndarray) -> None:
        for lo in range(0, len(self.ids), 256):
            s = -np.round(x @ self.x[lo : lo + 256].T, 9)
            for k in range(s.shape[1]):
                far, names = self.places[lo + k]
                if not len(far):
                    continue
                mine = ids != self.ids[lo + k]
                v, who = s[mine, k], ids[mine]
                first, past = np.searchsorted(far, v, "left"), np.searchsorted(far, v, "right")
                if (tied := np.flatnonzero(past > first)).size:  # among equal similarities the ids decide
                    keys = np.concatenate([far, v[tied]]), np.concatenate([names, who[tied]])
                    kind = np.concatenate([np.zeros(len(far), int), np.ones(len(tied), int)])
                    order = np.lexsort((kind, keys[1], keys[0]))
                    past = past.copy()
                    upto = np.cumsum(kind[order] == 0)
                    past[tied[order[kind[order] == 1] - len(far)]] = upto[kind[order] == 1]
                self.before[lo + k] += np.bincount(past, minlength=len(far) + 1)

    def result(self):
        if not self.parts[0]:
            return
        self._prepare()
        ap = [float((np.arange(1, len(far) + 1) / (np.cumsum(b)[: len(far)] + 1)).mean()) if len(far) else None for (far, _), b in zip(self.places, self.before)]
        yield pa.RecordBatch.from_arrays([pa.array(self.ids, pa.int64()), pa.array(self.labels.tolist(), pa.string()), pa.array(ap, pa.float64()), pa.array([len(f) for f, _ in self.places], pa.int64())], names=["id", "label", "ap", "n_positive"])


def chance_sets(rows: DataFrame, dims: int, n_null: int, seed: int) -> DataFrame:
    """``grp, draw, labels, median``: sets of rows of different labels and the median similarity of their pairs.

    A set has ``max(2, fewest replicates)`` labels of the group, drawn without
    replacement, and any one row of each.  A group gets as many sets as leave
    about ``n_null`` without any one label; none if it has too few labels.
    """
    counts = cut(rows.groupBy("grp", "label").agg(F.count(F.lit(1)).alias("n")))
    shape = counts.groupBy("grp").agg(F.count(F.lit(1)).alias("labels"), F.greatest(F.lit(2), F.coalesce(F.min(F.when(F.col("n") > 1, F.col("n"))), F.lit(2))).cast("long").alias("reps"))
    shape = shape.filter("labels > reps").withColumn("draws", F.ceil(1.1 * n_null * F.col("labels") / (F.col("labels") - F.col("reps"))).cast("long") + 50)

    def draw(batches):
        for b in batches:
            for grp, labels, reps, draws in zip(*(b.column(c).to_pylist() for c in ("grp", "labels", "reps", "draws"))):
                rng = np.random.default_rng((seed, *grp.encode()))
                step = max(1, 100_000 // max(labels, reps))
                for lo in range(0, draws, step):
                    n = min(step, draws - lo)
                    if 4 * reps > labels:
                        pick = np.argsort(rng.random((n, labels)), axis=1)[:, :reps]
                    else:  # few of many labels: draw again where one came twice
                        pick = rng.integers(labels, size=(n, reps))
                        while len(twice := np.flatnonzero((np.diff(np.sort(pick, 1), axis=1) == 0).any(1))):
                            pick[twice] = rng.integers(labels, size=(len(twice), reps))
                    yield pa.RecordBatch.from_arrays([pa.array([grp] * pick.size, pa.string()), pa.array(np.repeat(np.arange(lo, lo + n), reps)), pa.array(pick.ravel()), pa.array(rng.random(pick.size))], names=["grp", "draw", "label_no", "u"])

    picks = shape.select("grp", "labels", "reps", "draws").mapInArrow(draw, "grp string, draw long, label_no long, u double")
    # rows are numbered within salts of a label, salts by running counts, so that hot labels are not sorted as one
    numbered = counts.withColumn("label_no", F.row_number().over(Window.partitionBy("grp").orderBy("label")) - 1)
    salted = rows.join(counts, ["grp", "label"]).withColumn("salt", F.pmod(F.xxhash64("id", F.lit(seed)), F.ceil(F.col("n") / BLOCK)).cast("int"))
    placed = salted.withColumn("place", F.row_number().over(Window.partitionBy("grp", "label", "salt").orderBy("id")) - 1).select("grp", "label", "salt", "place", "id", "vec")
    sizes = salted.groupBy("grp", "label", "salt").agg(F.count(F.lit(1)).alias("size"))
    ahead = F.sum("size").over(Window.partitionBy("grp", "label").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1))
    sizes = sizes.withColumn("start", F.coalesce(ahead, F.lit(0)))
    at = F.least(F.floor(F.col("u") * F.col("n")), F.col("n") - 1)
    wanted = picks.join(numbered, ["grp", "label_no"]).withColumn("at", at).join(sizes, ["grp", "label"]).filter("at >= start and at < start + size")
    drawn = wanted.select("grp", "draw", "label", "salt", (F.col("at") - F.col("start")).cast("int").alias("place")).join(placed, ["grp", "label", "salt", "place"])
    sets = drawn.groupBy("grp", "draw").agg(F.collect_list("label").alias("labels"), F.collect_list("vec").alias("vecs"))

    def middle(batches):
        for b in batches:
            out = []
            for vecs in b.column("vecs").to_pylist():
                u = np.frombuffer(b"".join(vecs), np.float64).reshape(-1, dims)
                out.append(float(np.median((u @ u.T)[np.triu_indices(len(u), 1)])))
            yield pa.RecordBatch.from_arrays([b.column("grp"), b.column("draw"), b.column("labels"), pa.array(out, pa.float64())], names=["grp", "draw", "labels", "median"])

    return sets.mapInArrow(middle, "grp string, draw long, labels array<string>, median double")


def percent_replicating(rows: DataFrame, dims: int, n_null: int = 5_000, seed: int = 3) -> DataFrame:
    """``grp, label, n, observed, null_95, replicates``: a label's median pair similarity against chance.

    The null of a label are ``n_null`` sets of rows of other labels
    (:func:`chance_sets`): of the group's sets the first that do not hold the
    label, which is the same as drawing from the others only.  Any row can be
    drawn.  Labels with one row have no observed value and the flag 0; without
    enough other labels there is no null and the flag is 0.
    """
    observed = label_pairs(rows, dims, -1.0, same_only=True).filter("label_a = label_b").select("grp", F.col("label_a").alias("label"), F.col("similarity").alias("observed"))
    counts = rows.groupBy("grp", "label").agg(F.count(F.lit(1)).alias("n"))

    def limits(t: pa.Table) -> pa.Table:  # the sets of a group are bounded by n_null
        order = np.argsort(t["draw"].to_numpy())
        med = t["median"].to_numpy()[order]
        held: dict[str | None, list[int]] = {None: []}
        sets = t["labels"].to_pylist()
        for k, i in enumerate(order):
            for label in sets[i]:
                held.setdefault(label, []).append(k)
        q = [float(np.quantile(np.delete(med, at)[:n_null], 0.95)) for at in held.values()]
        return pa.table({"grp": pa.array([t["grp"][0].as_py()] * len(q), pa.string()), "label": pa.array(list(held), pa.string()), "null_95": pa.array(q, pa.float64())})

    found = cut(chance_sets(rows, dims, n_null, seed).groupBy("grp").applyInArrow(limits, "grp string, label string, null_95 double"))
    usual = found.filter("label is null").select("grp", F.col("null_95").alias("usual"))  # of labels in no set
    out = counts.join(observed, ["grp", "label"], "left").join(found.filter("label is not null"), ["grp", "label"], "left").join(usual, "grp", "left").withColumn("null_95", F.coalesce("null_95", "usual"))
    return out.select("grp", "label", "n", F.round("observed", 6).alias("observed"), F.round("null_95", 6).alias("null_95"), F.coalesce((F.col("observed") > F.col("null_95")).cast("int"), F.lit(0)).alias("replicates"))
