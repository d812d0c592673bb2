import dataclasses

import numpy as np
import pytest

from wellspring.llm.forest import grow, leaf_of, search
from wellspring.llm.neighbours import ForestPlan, nearest, nearest_exact, pairs_above, unit_vectors

SCHEMA = "id long, v array<float>, vec string"
D = 8


def points(seed=0, n=300, copies=6):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, D)).astype(np.float32)
    near = x[:20] + rng.normal(scale=0.05, size=(20, D)).astype(np.float32)
    same = np.repeat(x[:1], copies, 0) * np.array([[1], [2], [4], [0.5], [8], [1]], np.float32)[:copies]  # one direction
    return np.concatenate([x, near, same])


def frame(spark, x, extra=()):
    rows = [(i, [float(a) for a in r], "clash") for i, r in enumerate(x)]
    return spark.createDataFrame(rows + list(extra), SCHEMA)


BAD = [(900, None, ""), (901, [1.0] * 7, ""), (902, [0.0] * D, ""), (903, [float("nan")] + [1.0] * 7, ""), (904, [float("inf")] + [1.0] * 7, ""), (905, [None] + [1.0] * 7, "")]


def cosines(x):
    u = x.astype(np.float64)
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    return u @ u.T


def test_pairs_equal_brute_force(spark):
    x = points()
    s = cosines(x)
    true = {(i, j) for i in range(len(x)) for j in range(i + 1, len(x)) if s[i, j] >= 0.96}
    plan = ForestPlan(trees=6, leaf_rows=64, probes=12, least_points=4)
    rows = [(r.id_a, r.id_b) for r in pairs_above(frame(spark, x, BAD), "id", "v", D, 0.96, plan).collect()]
    assert len(rows) == len(set(rows)) and set(rows) == true


def test_pairs_with_salted_leaves(spark):
    x = points(1, 400)
    plan = ForestPlan(trees=4, leaf_rows=200, probes=8, block=40)
    s = cosines(x)
    true = {(i, j) for i in range(len(x)) for j in range(i + 1, len(x)) if s[i, j] >= 0.96}
    assert {(r.id_a, r.id_b) for r in pairs_above(frame(spark, x), "id", "v", D, 0.96, plan).collect()} == true


def test_nearest_with_copies_against_blocks(spark):
    x = points(2)
    df = frame(spark, x, BAD)
    plan = ForestPlan(trees=6, leaf_rows=64, probes=60)
    found = {(r.id, r.other) for r in nearest(df, "id", "v", D, 5, plan, 3).collect()}
    exact = nearest_exact(df, "id", "v", D, 5, 3, block=50).collect()
    s = cosines(x)
    np.fill_diagonal(s, -2)
    for r in exact:
        assert s[r.id, r.other] >= np.sort(s[r.id])[-5] - 1e-6
    true = {(r.id, r.other) for r in exact}
    assert {i for i, _ in found} == {i for i in range(len(x)) if i % 3 == 0}
    assert len(true & found) / len(true) > 0.97
    assert all(len([1 for a, _ in found if a == i]) == 5 for i in range(0, len(x), 3))


def test_empty_and_few(spark):
    none = spark.createDataFrame([], SCHEMA)
    plan = ForestPlan(leaf_rows=16)
    assert unit_vectors(none, "id", "v", D).count() == 0
    assert pairs_above(none, "id", "v", D, 0.9, plan).count() == 0
    assert nearest(none, "id", "v", D, 3, plan).count() == 0
    assert nearest(frame(spark, points(3)[:2]), "id", "v", D, 3, plan).count() == 2


def test_search_takes_nearest_leaf_first_and_each_once():
    x = np.random.default_rng(5).normal(size=(500, D)).astype(np.float32)
    forest = [grow(x, 20, np.random.default_rng(i)) for i in range(3)]
    tree, leaf = search(forest, x[:50], 10)
    for t in range(3):
        own = leaf_of(forest[t], x[:50])
        assert all(((tree[i] == t) & (leaf[i] == own[i])).any() for i in range(50))
    assert all(len(set(zip(tree[i], leaf[i]))) == 10 for i in range(50))


@pytest.mark.parametrize("points_per_leaf", [1, 1000])
def test_trees_over_equal_points(points_per_leaf):
    tree = grow(np.ones((40, D), np.float32), points_per_leaf, np.random.default_rng(0))
    assert tree.leaves == 1 and dataclasses.is_dataclass(tree)
