import numpy as np

from wellspring.operators import graph as G
from wellspring.operators import similarity as S
from wellspring.operators.design import Layout, plate_layout

EDGE = "grp string, label_a string, label_b string, similarity double"


def two_triangles(spark):
    pairs = [("a", "b"), ("b", "c"), ("a", "c"), ("d", "e"), ("e", "f"), ("d", "f"), ("c", "d")]
    nodes = spark.createDataFrame([("g", x) for x in "abcdefz"], "grp string, label string")
    return nodes, spark.createDataFrame([("g", a, b, 0.9 if (a, b) != ("c", "d") else 0.5) for a, b in pairs], EDGE)


def test_components_degrees_communities(spark):
    nodes, edges = two_triangles(spark)
    assert {r.label: r.component for r in G.components(nodes, edges).collect()} == {**dict.fromkeys("abcdef", "a"), "z": "z"}
    assert {r.label: r.degree for r in G.degrees(nodes, edges).collect()} == {"a": 2, "b": 2, "c": 3, "d": 3, "e": 2, "f": 2, "z": 0}
    want = {**dict.fromkeys("abc", "a"), **dict.fromkeys("def", "d"), "z": "z"}
    assert {r.label: r.community for r in G.communities(nodes, edges).collect()} == want
    good = G.modularity(edges, G.communities(nodes, edges)).first().modularity
    assert good > G.modularity(edges, G.components(nodes, edges).withColumnRenamed("component", "community")).first().modularity


def test_communities_of_planted_groups(spark):
    """Twelve dense groups with few links between them are found, in each of two graphs at once; no edges, no communities."""
    rng = np.random.default_rng(3)
    names = [f"v{i:03}" for i in range(96)]
    edges = [(g, a, b, 1.0) for g in ("g", "h") for i, a in enumerate(names) for j, b in enumerate(names) if i < j and rng.random() < (0.9 if i // 8 == j // 8 else 0.01)]
    nodes = spark.createDataFrame([(g, x) for g in ("g", "h") for x in names], "grp string, label string")
    found = {(r.grp, r.label): r.community for r in G.communities(nodes, spark.createDataFrame(edges, EDGE)).collect()}
    assert all(found[g, x] == names[i // 8 * 8] for g in ("g", "h") for i, x in enumerate(names))
    assert {r.community == r.label for r in G.communities(nodes, spark.createDataFrame([], EDGE)).collect()} == {True}


def test_long_chain_is_one_component(spark):
    names = [f"n{i:03}" for i in range(70)]
    nodes = spark.createDataFrame([("g", x) for x in names], "grp string, label string")
    edges = spark.createDataFrame([("g", a, b, 1.0) for a, b in zip(names, names[1:])], EDGE)
    assert {r.component for r in G.components(nodes, edges).collect()} == {"n000"}


def test_dominant_features_by_sign_and_size(spark):
    rows = [("x", 0, v) for v in [1.0] * 6 + [-1.0]] + [("x", 1, v) for v in [1.0] * 5 + [-1.0] * 2] + [("x", 2, 0.4)] * 7
    df = spark.createDataFrame(rows, "label string, pos int, x double")
    assert [(r.pos, r.median) for r in G.dominant_features(df, ["label"]).collect()] == [(0, 1.0)]


def test_confidence(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(1, 0.9), (1, 0.1), (0, 0.9), (0, 0.1), (None, None)], "r int, s double")
    assert [x[0] for x in df.select(G.confidence(F.col("r"), F.col("s"), F.lit(0.5))).collect()] == ["high", "medium", "medium", "low", "low"]


def rows_of(spark, x, labels, kind="cosine"):
    df = spark.createDataFrame([(i, "g", lab, [float(v) for v in r]) for i, (r, lab) in enumerate(zip(x, labels))], "id long, cohort string, label string, f array<double>")
    return S.prepared(df, "id", "cohort", "label", "f", x.shape[1], kind)


def test_pair_statistics_in_blocks(spark, monkeypatch):
    """Hot labels, cut into chunks, give what all pairs give."""
    rng = np.random.default_rng(2)
    x, labels = rng.normal(size=(60, 5)), ["hot"] * 30 + ["b"] * 15 + [f"s{i}" for i in range(15)]
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    s = u @ u.T
    monkeypatch.setattr(S, "BLOCK", 8)
    rows = rows_of(spark, x, labels)
    got = {r.label: r for r in S.replicate_similarity(rows, 5).collect()}
    for label in ("hot", "b"):
        at = [i for i, y in enumerate(labels) if y == label]
        v = s[np.ix_(at, at)][np.triu_indices(len(at), 1)]
        assert abs(got[label].mean_sim - v.mean()) < 1e-6 and abs(got[label].std_sim - v.std()) < 1e-6
    assert got["s0"].mean_sim is None
    pairs = {(r.label_a, r.label_b): r for r in S.label_pairs(rows, 5, 0.0).collect()}
    names = sorted(set(labels))
    for i, a in enumerate(names):
        for b in names[i:]:
            p, q = [k for k, y in enumerate(labels) if y == a], [k for k, y in enumerate(labels) if y == b]
            v = s[np.ix_(p, q)][np.triu_indices(len(p), 1)] if a == b else s[np.ix_(p, q)].ravel()
            if len(v):
                assert pairs[a, b].n_pairs == len(v) and abs(pairs[a, b].similarity - np.median(np.clip(v, 0, 1))) < 1e-4
    assert sum(r.n for r in S.similarity_counts(rows, 5).collect()) == 60 * 59 // 2


def test_edges_follow_the_threshold_of_their_own_group(spark, tmp_path):
    """Weak edges above a group's own threshold stay, and so do weak replicate medians."""
    from wellspring.plans import relations as R

    rng = np.random.default_rng(4)
    labels = [f"L{k:02}" for k in range(40) for _ in range(2 if k < 8 else 1)]
    x = rng.normal(size=(len(labels), 64))
    rows = [(i, lab, "g", v.tolist()) for i, (lab, v) in enumerate(zip(labels, x))]
    spark.createDataFrame(rows, "profile_id long, Metadata_Perturbation string, cohort string, features array<double>").write.parquet(f"{tmp_path}/profiles.parquet")
    limit = R.fdr_threshold(spark, str(tmp_path)).first().threshold
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    s, own = np.clip(u @ u.T, 0, 1), np.array(labels)
    names = sorted(set(labels))
    med = {(a, b): np.median(s[np.ix_(own == a, own == b)]) for i, a in enumerate(names) for b in names[i + 1 :]}
    assert sum(limit <= m < 0.3 for m in med.values()) > 0
    assert {(r.label_a, r.label_b) for r in R.similarity_graph_edges(spark, str(tmp_path)).collect()} == {k for k, m in med.items() if m >= limit}
    assert {(r.label_a, r.label_b) for r in R.compound_similarity(spark, str(tmp_path)).collect()} == set(med)
    assert all((r.median_replicate_sim is not None) == (r.label < "L08") for r in R.node_confidence(spark, str(tmp_path)).collect())


def test_average_precision_first_last_none(spark):
    x = np.array([[1, 0.0], [1, 0.1], [0, 1], [0.2, 1], [-1, 0]])
    got = {r.id: (r.ap, r.n_positive) for r in S.average_precision(rows_of(spark, x, ["a", "a", "b", "a", "c"]), 2).collect()}
    assert got[0][0] == 1.0 and got[4] == (None, 0) and got[2] == (None, 0)


def test_average_precision_with_ties_hot_labels_and_small_blocks(spark, monkeypatch):
    """Blocks, split labels and copies give what one sorted list per row gives."""
    monkeypatch.setattr(S, "BLOCK", 8)
    rng = np.random.default_rng(5)
    x = rng.normal(size=(50, 4))
    x[10:30] = x[rng.integers(0, 10, size=20)]
    labels = ["hot"] * 25 + [f"s{i % 8}" for i in range(25)]
    got = {r.id: (r.ap, r.n_positive) for r in S.average_precision(rows_of(spark, x, labels), 4).collect()}
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    s = np.round(u @ u.T, 9)
    for i in range(50):
        order = sorted((j for j in range(50) if j != i), key=lambda j: (-s[i, j], j))
        hit = np.array([labels[j] == labels[i] for j in order])
        want = (np.cumsum(hit) / np.arange(1, 50))[hit].mean() if hit.any() else None
        assert got[i][1] == hit.sum() and (want is None or abs(got[i][0] - want) < 1e-9)


def test_null_of_a_label_leaves_it_out_and_reaches_all_rows(spark, monkeypatch):
    monkeypatch.setattr(S, "BLOCK", 16)
    rng = np.random.default_rng(6)
    x = rng.normal(size=(120, 6))
    labels = ["hot"] * 60 + [f"s{i % 12}" for i in range(60)]
    rows = rows_of(spark, x, labels, "ordinal")
    sets = S.chance_sets(rows, 6, 400, 3).collect()
    assert all(len(set(r.labels)) == len(r.labels) == 5 for r in sets)
    assert all(sum(name not in r.labels for r in sets) >= 400 for name in set(labels))
    got = {r.label: r for r in S.percent_replicating(rows, 6, n_null=400).collect()}
    u = S.unit_rows(x, "ordinal")
    of = {name: np.flatnonzero(np.array(labels) == name) for name in set(labels)}
    draws = []
    for _ in range(4_000):
        pick = [rng.choice(of[name]) for name in rng.choice([n for n in of if n != "hot"], 5, replace=False)]
        draws.append(np.median((u[pick] @ u[pick].T)[np.triu_indices(5, 1)]))
    assert abs(got["hot"].null_95 - np.quantile(draws, 0.95)) < 0.06
    few = S.percent_replicating(rows.filter("label in ('hot', 's1')"), 6, n_null=50).collect()
    assert all(r.null_95 is None and r.replicates == 0 for r in few)


def test_plate_layout_fills_wells_once(spark):
    layout = Layout()
    names = spark.createDataFrame([(f"C{i:03}",) for i in range(50)] + [("C000",), (None,)], "c string")
    rows = plate_layout(names, "c", layout).collect()
    assert len(rows) == 2 * 96 and len({(r.plate, r.well) for r in rows}) == len(rows)
    assert sum(r.type == "cmpd" for r in rows) == 100 and sum(r.type == "neg" for r in rows) == 20
    assert plate_layout(names.limit(0), "c", layout).count() == 0
