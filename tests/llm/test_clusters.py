import numpy as np
import pytest

from wellspring.llm.cftree import CFTree, ward
from wellspring.llm.clusters import ClusterPlan, describe, linked_clusters, ward_division
from wellspring.llm.neighbours import unit_vectors

D = 16
SCHEMA = "id long, v array<double>, cluster string"


def groups(seed=0):
    rng = np.random.default_rng(seed)
    parts = [rng.normal(size=(80, D))]
    for n in (40, 25, 12, 9):
        c = rng.normal(size=D)
        c /= np.linalg.norm(c)
        parts.append((c + rng.normal(scale=0.09, size=(n, D))) * rng.uniform(0.5, 20, (n, 1)))
    parts.append(np.repeat(rng.normal(size=(1, D)), 11, 0))  # copies alone make a set
    x = np.concatenate(parts)
    return x[rng.permutation(len(x))]


def brute(x, t, least):
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    s = u @ u.T >= t
    label = np.arange(len(x))
    while True:
        new = np.array([label[row].min() for row in s])
        if (new == label).all():
            break
        label = new
    return {i: int(k) for i, k in enumerate(label) if (label == k).sum() >= least}


def frame(spark, x):
    rows = [(i, [float(a) for a in r], "clash") for i, r in enumerate(x)]
    return spark.createDataFrame(rows + [(990, None, ""), (991, [0.0] * D, "")], SCHEMA)


@pytest.mark.parametrize("plan", [ClusterPlan(rows_per_cluster=40), ClusterPlan(rows_per_cluster=20, leaves=30, part_rows=40, fan_in=2, overlap=4, block=30)])
def test_linked_sets_equal_brute_force(spark, plan):
    x = groups()
    got = {r.id: r.cluster_key for r in linked_clusters(frame(spark, x), "id", "v", D, 0.8, 10, plan).collect()}
    assert got == brute(x, 0.8, 10)


def test_empty_table(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert linked_clusters(none, "id", "v", D, 0.8, 10).count() == 0
    assert ward_division(none, "id", "v", D).count() == 0


@pytest.mark.parametrize("block", [8_192, 25])
def test_division_into_mutually_similar_clusters(spark, block):
    """Planted groups come out whole and similar, noise alone; twice the same; also where cells are divided in pieces."""
    x = groups(2)
    df = frame(spark, x)
    plan = ClusterPlan(rows_per_cluster=60, block=block)
    run = lambda: {r.id: r.cluster_key for r in ward_division(df, "id", "v", D, plan).collect()}
    got = run()
    assert got == run() and len(got) == len(x)
    rows = describe(unit_vectors(df, "id", "v", D), ward_division(df, "id", "v", D, plan), D).collect()
    assert all(r.pair_cosine >= 0.499 for r in rows if block > 1_000) and sorted(r.cluster_key for r in rows) == sorted(set(got.values()))
    linked = brute(x, 0.8, 9)
    for key in set(linked.values()):
        inside = [got[i] for i, k in linked.items() if k == key]
        assert block < 1_000 or len(set(inside)) == 1
        assert max(map(inside.count, set(inside))) >= 0.3 * len(inside)


def test_division_and_description_cover_every_row(spark):
    x = groups(1)
    df = frame(spark, x)
    member = ward_division(df, "id", "v", D, ClusterPlan(rows_per_cluster=30))
    rows = describe(unit_vectors(df, "id", "v", D), member, D, 3).collect()
    assert sum(r.size for r in rows) == len(x) and len(rows) > 1
    own = {r.id: r.cluster_key for r in member.collect()}
    assert all(own[i] == r.cluster_key for r in rows for i in r.typical_ids) and all(len(r.typical_ids) == min(3, r.size) for r in rows)


def test_cluster_features_add_up_and_merge():
    x = np.random.default_rng(3).normal(size=(3000, 6))
    trees = [CFTree(6, 0.5, 200) for _ in range(2)]
    for i, row in enumerate(x):
        trees[i % 2].insert(1.0, row, float(row @ row))
    whole = CFTree(6, 0.5, 150)
    for t in trees:
        assert t.leaves <= 200
        for n, ls, ss in zip(*t.features()):
            whole.insert(n, ls, ss)
    n, ls, ss = whole.features()
    assert whole.leaves == len(n) <= 150 and n.sum() == 3000
    assert np.allclose(ls.sum(0), x.sum(0)) and np.isclose(ss.sum(), (x**2).sum())


def test_rows_inserted_together_add_up():
    rng = np.random.default_rng(4)
    x = np.concatenate([rng.normal(size=(40, 6)), np.repeat(rng.normal(size=(30, 6)), 40, 0) + rng.normal(scale=0.02, size=(1200, 6))])
    tree = CFTree(6, 0.5, 150)
    tree.insert_rows(x, 64)
    n, ls, ss = tree.features()
    assert tree.leaves == len(n) <= 150 and n.sum() == len(x) and np.allclose(ls.sum(0), x.sum(0)) and np.isclose(ss.sum(), (x**2).sum())
    for node in [tree.root]:
        assert node.leaf or np.allclose(node.total()[1], x.sum(0))
    assert (ss / n - (ls * ls).sum(1) / n**2 <= tree.radius**2 + 1e-9).all()


def test_ward_separates_and_stops():
    centres = np.array([[0, 0], [0, 0.1], [5, 5], [5, 5.1], [9, 0.0]])
    label = ward(np.array([3, 1, 2, 2, 1.0]), centres * np.array([[3], [1], [2], [2], [1]]), 3)
    assert label[0] == label[1] and label[2] == label[3] and len(set(label)) == 3
    assert len(set(ward(np.ones(5), centres, 1))) == 1 and len(set(ward(np.ones(5), centres, 9))) == 5
