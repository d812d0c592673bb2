"""Principal components, silhouettes and cross-validated classification."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wellspring.operators.similarity import _matrix
from wellspring.session import cut


def packed(df: DataFrame, row_id: str, label: str, vector: str, dims: int) -> DataFrame:
    """``id, label, vec`` (packed doubles) of rows with ``dims`` finite values."""
    finite = F.forall(F.col(vector), lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    rows = df.filter((F.size(vector) == dims) & finite).select(F.col(row_id).cast("long").alias("id"), F.col(label).cast("string").alias("label"), F.col(vector).cast("array<double>").alias("v"))

    def run(batches):
        for b in batches:
            x = np.asarray(b.column("v").flatten().to_numpy(zero_copy_only=False), np.float64).reshape(-1, dims)
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("label"), pa.array([r.tobytes() for r in x], pa.binary())], names=["id", "label", "vec"])

    return rows.mapInArrow(run, "id long, label string, vec binary")


def principal_components(rows: DataFrame, dims: int, k: int = 3) -> DataFrame:
    """``id, label, pc1..pck``: centred scores; the largest loading of each component is positive.

    Sums of products are formed per partition; only ``dims`` by ``dims`` numbers
    reach the driver.
    """

    def sums(batches):
        n, s, g = 0, np.zeros(dims), np.zeros((dims, dims))
        for b in batches:
            x = _matrix(b.column("vec"), dims)
            n, s, g = n + len(x), s + x.sum(0), g + x.T @ x
        flat = np.concatenate([[n], s, g.ravel()])
        yield pa.RecordBatch.from_pydict({"pos": pa.array(np.arange(len(flat), dtype=np.int32)), "x": pa.array(flat)})

    total = rows.select("vec").mapInArrow(sums, "pos int, x double").groupBy("pos").agg(F.sum("x").alias("x")).orderBy("pos").toArrow()["x"].to_numpy()
    n, s, g = total[0], total[1 : dims + 1], total[dims + 1 :].reshape(dims, dims)
    mean = s / max(n, 1)
    _, vectors = np.linalg.eigh(g / max(n, 1) - np.outer(mean, mean))
    load = vectors[:, ::-1][:, :k]
    load = load * np.sign(load[np.abs(load).argmax(0), np.arange(k)])

    def project(batches):
        for b in batches:
            y = (_matrix(b.column("vec"), dims) - mean) @ load
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("label"), *[pa.array(np.ascontiguousarray(y[:, i])) for i in range(k)]], names=["id", "label", *[f"pc{i + 1}" for i in range(k)]])

    return rows.mapInArrow(project, "id long, label string, " + ", ".join(f"pc{i + 1} double" for i in range(k)))


def silhouettes(rows: DataFrame, dims: int, every: int = 1, block: int = 32_768) -> DataFrame:
    """``id, label, silhouette`` (Euclidean) of the rows whose id is divisible by ``every``, against all rows in blocks.

    Rows alone in their label score 0; null labels take no part.  A block is one
    record of whole labels (labels larger than a block are cut); every two blocks
    meet in one task, which reads both from the shared folder, takes each distance
    once for its two rows and returns, for each row, the total to its own label,
    the least mean over the other block's whole labels, and the totals to its cut
    labels.  So rows are shuffled once and a row gets a few numbers per block,
    however many labels there are.
    """
    rows = rows.filter("label is not null").mapInArrow(lambda batches: map(lambda b: _narrow(b, dims), batches), "id long, label string, vec binary")
    sizes = cut(rows.groupBy("label").agg(F.count(F.lit(1)).alias("whole")))
    n = sizes.agg(F.coalesce(F.sum("whole"), F.lit(0))).first()[0]
    size = min(block, max(1_024, -(-n // 12)))
    count = max(1, -(-n // size))
    cut_labels = F.broadcast(sizes.filter(F.col("whole") > size))  # fewer than blocks
    piece = F.pmod(F.xxhash64("id"), F.ceil(F.col("whole") / size))
    placed = rows.join(cut_labels, "label", "left").withColumn("block", F.pmod(F.xxhash64("label", piece), F.lit(count)).cast("int"))
    placed = placed.repartitionById(count, F.col("block")).sortWithinPartitions("block", "label", "id").select("block", "label", "whole", "id", "vec")
    blocks = cut(placed.mapInArrow(lambda batches: _blocks(batches, dims), "block int, labels array<string>, sizes array<long>, wholes array<long>, ids binary, vec binary, wide boolean"))

    def met(batches):
        for b in batches:
            for i in range(len(b)):
                left, right = ({c[2:]: b.column(c)[i] for c in b.schema.names if c.startswith(side)} for side in ("a_", "b_"))
                yield from _meet(left, right, dims)

    side = lambda name: blocks.select(*[F.col(c).alias(f"{name}_{c}") for c in blocks.columns])
    pairs = side("a").join(side("b").hint("shuffle_replicate_nl"), F.col("a_block") <= F.col("b_block"))
    found = pairs.mapInArrow(met, "block int, kind int, other string, whole long, value binary")
    named = blocks.select("block", "labels", "sizes", "wholes", "ids").groupBy("block")
    near = named.cogroup(found.groupBy("block")).applyInArrow(_nearest, "id long, label string, a double, b double").filter(F.col("id") % every == 0)
    score = F.coalesce(F.try_divide(F.col("b") - F.col("a"), F.greatest("a", "b")), F.lit(0.0))
    return near.select("id", "label", F.round(score, 6).alias("silhouette"))


def _narrow(b: pa.RecordBatch, dims: int) -> pa.RecordBatch:
    """Vectors whose values are floats take four bytes a value."""
    x = _matrix(b.column("vec"), dims)
    with np.errstate(over="ignore"):
        f = x.astype(np.float32)
    fits = (f == x).all(1)
    vec = [(f if fit else x)[i].tobytes() for i, fit in enumerate(fits)]
    return pa.RecordBatch.from_arrays([b.column("id"), b.column("label"), pa.array(vec, pa.binary())], names=["id", "label", "vec"])


def _blocks(batches, dims: int):
    """One record per block of a partition's sorted rows."""
    table = pa.Table.from_batches([*batches], pa.schema([("block", pa.int32()), ("label", pa.string()), ("whole", pa.int64()), ("id", pa.int64()), ("vec", pa.binary())]))
    number = table["block"].to_numpy()
    edges = np.flatnonzero(np.r_[True, number[1:] != number[:-1], True]) if len(number) else np.zeros(1, int)
    for lo, hi in zip(edges, edges[1:]):
        t = table.slice(lo, hi - lo)
        label, vec = np.array(t["label"].to_pylist(), object), t["vec"].to_pylist()
        at = np.flatnonzero(np.r_[True, label[1:] != label[:-1]])
        wide = any(len(v) == 8 * dims for v in vec)
        if wide:
            vec = [v if len(v) == 8 * dims else np.frombuffer(v, np.float32).astype(np.float64).tobytes() for v in vec]
        whole = t["whole"].fill_null(0).to_numpy()[at]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([int(number[lo])], pa.int32()), pa.array([label[at].tolist()], pa.list_(pa.string())), pa.array([np.diff(np.r_[at, hi - lo]).tolist()], pa.list_(pa.int64())),
                pa.array([whole.tolist()], pa.list_(pa.int64())), pa.array([t["id"].to_numpy().tobytes()], pa.binary()), pa.array([b"".join(vec)], pa.binary()), pa.array([wide], pa.bool_()),
            ],
            names=["block", "labels", "sizes", "wholes", "ids", "vec", "wide"],
        )


class _Named:
    """Rows of a block by label; those of one id and label are a unit, for which the result has one row."""

    def __init__(self, labels, sizes, wholes, ids):
        self.labels, self.sizes, self.wholes = labels.as_py(), np.array(sizes.as_py()), np.array(wholes.as_py())
        self.starts = np.r_[0, np.cumsum(self.sizes)]
        self.ids = np.frombuffer(ids.as_py(), np.int64)
        new = np.r_[True, self.ids[1:] != self.ids[:-1]]
        new[self.starts[:-1]] = True
        self.first = np.flatnonzero(new)
        self.copies = np.diff(np.r_[self.first, len(self.ids)])
        self.label_of = np.searchsorted(self.starts, self.first, "right") - 1


class _Side(_Named):
    """A block in a task: its centred vectors, and per unit the total to its own label, the least mean, the totals to cut labels."""

    def __init__(self, block: dict, dims: int):
        super().__init__(*(block[c] for c in ("labels", "sizes", "wholes", "ids")))
        self.block = block["block"].as_py()
        self.x = np.frombuffer(block["vec"].as_buffer(), np.float64 if block["wide"].as_py() else np.float32).reshape(-1, dims).astype(np.float64)
        self.own, self.near, self.cut = np.zeros(len(self.first)), np.full(len(self.first), np.inf), {}

    def centred(self, at: np.ndarray) -> None:
        self.x -= at
        self.square = (self.x**2).sum(1)

    def groups(self, most: int = 256) -> list[tuple[int, int]]:
        """Runs of labels: as many as have ``most`` rows together, or one larger label."""
        out, i = [], 0
        while i < len(self.sizes):
            j = max(i + 1, int(np.searchsorted(self.starts, self.starts[i] + most, "right")) - 1)
            out.append((i, j))
            i = j
        return out

    def add(self, group: tuple[int, int], totals: np.ndarray, other: "_Side", theirs: tuple[int, int], code: np.ndarray, their_code: np.ndarray) -> None:
        """Take the totals of a group's rows to labels of the other block."""
        lo, hi = np.searchsorted(self.first, self.starts[[*group]])
        if hi - lo < len(totals):
            totals = np.add.reduceat(totals, self.first[lo:hi] - self.starts[group[0]], axis=0)
        at = slice(*theirs)
        same = code[self.label_of[lo:hi]][:, None] == their_code[at][None]
        self.own[lo:hi] += np.where(same, totals, 0).sum(1)
        mean = np.where(same | (other.wholes[at] > 0)[None], np.inf, totals / (self.copies[lo:hi, None] * other.sizes[at][None]))
        self.near[lo:hi] = np.minimum(self.near[lo:hi], mean.min(1))
        for j in np.flatnonzero(other.wholes[at]):
            self.cut.setdefault(theirs[0] + j, np.zeros(len(self.first)))[lo:hi] += totals[:, j]

    def found(self, other: "_Side"):
        kinds = [(0, None, None, self.own)] if self.own.any() else []
        kinds += [(1, None, None, self.near)] if np.isfinite(self.near).any() else []
        kinds += [(2, other.labels[j], int(other.wholes[j]), v) for j, v in self.cut.items()]
        for kind, label, whole, value in kinds:
            yield pa.RecordBatch.from_arrays([pa.array([self.block], pa.int32()), pa.array([kind], pa.int32()), pa.array([label], pa.string()), pa.array([whole], pa.int64()), pa.array([value.tobytes()], pa.binary())], names=["block", "kind", "other", "whole", "value"])


def _meet(left: dict, right: dict, dims: int):
    """Results of two blocks' rows from the distances between them; of equal blocks, of one block's."""
    a = _Side(left, dims)
    equal = left["block"].as_py() == right["block"].as_py()
    b = a if equal else _Side(right, dims)
    center = np.median(a.x, axis=0)  # a mean would follow vectors of another magnitude
    a.centred(center)
    if not equal:
        b.centred(center)
    codes = {name: i for i, name in enumerate({*a.labels, *b.labels})}
    code_a, code_b = (np.array([codes[name] for name in side.labels]) for side in (a, b))
    left_x = np.c_[-2 * a.x, a.square, np.ones(len(a.x))]
    right_x = np.ascontiguousarray(np.c_[b.x, np.ones(len(b.x)), b.square].T)
    groups = b.groups()
    for i, g in enumerate(a.groups()):
        for h in groups[i if equal else 0 :]:
            apart = not (equal and g == h)
            to_b, to_a = _totals(a, b, g, h, left_x, right_x, apart)
            a.add(g, to_b, b, h, code_a, code_b)
            if apart:
                b.add(h, to_a.T, a, g, code_b, code_a)
    yield from a.found(b)
    if not equal:
        yield from b.found(a)


def _totals(a: _Side, b: _Side, g: tuple[int, int], h: tuple[int, int], left: np.ndarray, right: np.ndarray, both: bool) -> tuple[np.ndarray, np.ndarray]:
    """Total distances of the rows of ``g`` to each label of ``h`` and, if ``both``, of each label of ``g`` to the rows of ``h``.

    Squares that are small against the vectors' own lose digits and are taken from the differences.
    """
    g0, g1, h0, h1 = a.starts[g[0]], a.starts[g[1]], b.starts[h[0]], b.starts[h[1]]
    to_b, to_a = np.zeros((g1 - g0, h[1] - h[0])), np.zeros((g[1] - g[0], h1 - h0))
    for lo in range(g0, g1, 256):
        up = min(lo + 256, g1)
        for col in range(h0, h1, 512):
            end = min(col + 512, h1)
            d = left[lo:up] @ right[:, col:end]
            close = d <= 2e-6 * a.square[lo:up, None]
            if close.any():
                p, q = np.nonzero(close)
                for k in range(0, len(p), 16_384):
                    pk, qk = p[k : k + 16_384], q[k : k + 16_384]
                    d[pk, qk] = ((a.x[lo + pk] - b.x[col + qk]) ** 2).sum(1)
            np.sqrt(d, out=d)
            to_b[lo - g0 : up - g0] += d.sum(1)[:, None] if h[1] - h[0] == 1 else np.add.reduceat(d, b.starts[h[0] : h[1]] - h0, axis=1)
            if both:
                to_a[:, col - h0 : end - h0] += d.sum(0)[None] if g[1] - g[0] == 1 else np.add.reduceat(d, a.starts[g[0] : g[1]] - g0, axis=0)
    return to_b, to_a


def _nearest(block: pa.Table, found: pa.Table) -> pa.Table:
    """Mean distance of a block's units to their own label (``a``) and to the nearest other (``b``)."""
    rows = _Named(*(block[c][0] for c in ("labels", "sizes", "wholes", "ids")))
    own, near, parts = np.zeros(len(rows.first)), np.full(len(rows.first), np.inf), {}
    for kind, other, whole, value in zip(*(found[c].to_pylist() for c in ("kind", "other", "whole", "value"))):
        v = np.frombuffer(value)
        if kind == 0:
            own += v
        elif kind == 1:
            near = np.minimum(near, v)
        else:
            parts[other] = whole, parts.get(other, (whole, 0))[1] + v
    names = np.array(rows.labels, object)
    for other, (whole, total) in parts.items():
        near = np.minimum(near, np.where((names != other)[rows.label_of], total / (rows.copies * whole), np.inf))
    n = rows.copies * np.where(rows.wholes > 0, rows.wholes, rows.sizes)[rows.label_of] - 1
    a = pa.array(own / np.maximum(n, 1), mask=n == 0)
    return pa.table({"id": pa.array(rows.ids[rows.first]), "label": pa.array(rows.labels, pa.string()).take(pa.array(rows.label_of)), "a": a, "b": pa.array(near, mask=np.isinf(near))})


def label_codes(df: DataFrame, label: str) -> DataFrame:
    """``label, code``: labels numbered from 0 in their order (one row per distinct label)."""
    from wellspring.operators.stats import number_rows

    return number_rows(df.select(F.col(label).cast("string").alias("label")).filter("label is not null").distinct(), ["label"], "code").select("label", "code")


#: forest that a prediction takes by default; deeper and larger ones are parameters
TREES, DEPTH = 100, 20


def _weighted(df: DataFrame, label: str, vector: str, *more) -> tuple[DataFrame, DataFrame]:
    """Rows with ``label, features, code, weight`` (n / (k n_c)) and the codes of the labels."""
    codes = label_codes(df, label).withColumn("code", F.col("code").cast("double"))
    vectors = array_to_vector(F.col(vector).cast("array<double>")).alias("features")
    rows = df.select(*more, F.col(label).cast("string").alias("label"), vectors).join(F.broadcast(codes), "label")
    classes = rows.groupBy("label").agg(F.count(F.lit(1)).alias("n_c"))
    shape = classes.agg(F.sum("n_c").alias("n"), F.count(F.lit(1)).alias("k"))
    weights = classes.join(shape).select("label", (F.col("n") / (F.col("k") * F.col("n_c"))).alias("weight"))  # shape has one row
    return rows.join(F.broadcast(weights), "label"), codes


def _forest(trees: int, depth: int, seed: int) -> RandomForestClassifier:
    return RandomForestClassifier(numTrees=trees, maxDepth=depth, minInstancesPerNode=1, featureSubsetStrategy="sqrt", weightCol="weight", labelCol="code", seed=seed)


def forest_predictions(df: DataFrame, row_id: str, label: str, vector: str, folds: int = 5, trees: int = TREES, depth: int = DEPTH, seed: int = 42) -> DataFrame:
    """``id, label, predicted``: every row predicted by a random forest that did not see its fold.

    Classes are weighted by n / (k n_c); folds follow a hash of the id.  A forest
    per left-out row, as on a few hundred rows, is ``folds`` = number of rows.  A
    label with rows in one fold only is never predicted there.  Rows whose
    vectors or labels are null take no part.
    """
    rows, codes = _weighted(df.filter(F.col(vector).isNotNull()), label, vector, F.col(row_id).cast("long").alias("id"))
    rows = cut(rows.withColumn("fold", F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(folds))))
    out = None
    for fold in range(folds):
        model = _forest(trees, depth, seed).fit(rows.filter(F.col("fold") != fold))
        part = model.transform(rows.filter(F.col("fold") == fold)).select("id", "label", "prediction")
        out = part if out is None else out.unionByName(part)
    return out.join(F.broadcast(codes.select(F.col("label").alias("predicted"), F.col("code").alias("prediction"))), "prediction").select("id", "label", "predicted")


def feature_importances(df: DataFrame, label: str, vector: str, top: int, trees: int = TREES, depth: int = DEPTH, seed: int = 42) -> DataFrame:
    """``rank, feature, importance``: the ``top`` features of one forest over all rows; ties go to the smaller place."""
    rows, _ = _weighted(df.filter(F.col(vector).isNotNull()), label, vector)
    found = enumerate(_forest(trees, depth, seed).fit(cut(rows)).featureImportances.toArray().tolist())
    best = sorted(found, key=lambda f: (-f[1], f[0]))[:top]
    return df.sparkSession.createDataFrame([(i + 1, f, float(w)) for i, (f, w) in enumerate(best)], "rank int, feature int, importance double")


def classification_report(predictions: DataFrame) -> DataFrame:
    """``label, precision, recall, f1, support`` and the share of rows predicted right (``accuracy``, in every row)."""
    cells = cut(predictions.groupBy("label", "predicted").agg(F.count(F.lit(1)).alias("n")))
    hit = F.sum(F.when(F.col("label") == F.col("predicted"), F.col("n")).otherwise(0))
    by_true = cells.groupBy("label").agg(F.sum("n").alias("support"), hit.alias("hits"))
    by_pred = cells.groupBy(F.col("predicted").alias("label")).agg(F.sum("n").alias("named"))
    p, r = F.coalesce(F.try_divide("hits", "named"), F.lit(0.0)), F.coalesce(F.try_divide("hits", "support"), F.lit(0.0))
    all_rows = Window.partitionBy()  # one row per label
    out = by_true.join(by_pred, "label", "left").withColumn("precision", p).withColumn("recall", r).withColumn("f1", F.coalesce(F.try_divide(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")), F.lit(0.0)))
    return out.select("label", "precision", "recall", "f1", "support", (F.sum("hits").over(all_rows) / F.sum("support").over(all_rows)).alias("accuracy"))
