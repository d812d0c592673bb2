import numpy as np

from wellspring.operators import graph as G
from wellspring.operators import ml as M
from wellspring.operators import similarity as S

SCHEMA = "id long, label string, cohort string, f array<double>"


def separated(seed=0, per=25, d=6):
    rng = np.random.default_rng(seed)
    rows = []
    for k in range(3):
        centre = np.zeros(d)
        centre[k] = 4
        rows += [(len(rows) + i, f"L{k}", "g", (centre + rng.normal(size=d)).tolist()) for i in range(per)]
    return rows


def test_principal_components_equal_numpy(spark):
    rows = separated()
    got = {r.id: (r.pc1, r.pc2, r.pc3) for r in M.principal_components(M.packed(spark.createDataFrame(rows, SCHEMA), "id", "label", "f", 6), 6).collect()}
    x = np.array([r[3] for r in rows])
    x -= x.mean(0)
    load = np.linalg.svd(x, full_matrices=False)[2][:3].T
    load *= np.sign(load[np.abs(load).argmax(0), range(3)])
    assert np.allclose(np.array([got[i] for i in range(len(rows))]), x @ load, atol=1e-8)


def test_forest_beats_the_majority_and_predicts_every_row_once(spark):
    df = spark.createDataFrame(separated(1), SCHEMA)
    rows = M.forest_predictions(df, "id", "label", "f", folds=3, trees=10).collect()
    assert sorted(r.id for r in rows) == list(range(75)) and np.mean([r.label == r.predicted for r in rows]) > 0.8
    report = {r.label: r for r in M.classification_report(spark.createDataFrame([("a", "a"), ("a", "b"), ("b", "b")], "label string, predicted string")).collect()}
    assert report["a"].precision == 1 and report["a"].recall == 0.5 and report["b"].precision == 0.5 and abs(report["a"].accuracy - 2 / 3) < 1e-9


def test_silhouette_in_blocks(spark):
    rows = separated(2, 8)
    packed = M.packed(spark.createDataFrame(rows + [(900, "alone", "g", [50.0] * 6)], SCHEMA), "id", "label", "f", 6)
    a = {r.id: r.silhouette for r in M.silhouettes(packed, 6, 1).collect()}
    assert a == {r.id: r.silhouette for r in M.silhouettes(packed, 6, 1, block=5).collect()}
    assert a[900] == 0 and np.mean([v for k, v in a.items() if k != 900]) > 0.3


def test_silhouette_query_scores_every_profile(spark, tmp_path):
    from wellspring.plans import relations as R

    rng = np.random.default_rng(8)
    rows = [(i, f"P{i % 7}", f"c{i % 3}", (rng.normal(size=64) + i % 3).tolist()) for i in range(120)]
    spark.createDataFrame(rows, "profile_id long, Metadata_Perturbation string, cohort string, features array<double>").write.parquet(f"{tmp_path}/profiles.parquet")
    got = {r.id: r.silhouette for r in R.silhouette(spark, str(tmp_path)).collect()}
    x, c = np.array([r[3] for r in rows]), np.arange(120) % 3
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(2))
    for i in range(120):
        a, b = d[i, c == c[i]].sum() / 39, min(d[i, c == k].mean() for k in range(3) if k != c[i])
        assert abs(got[i] - (b - a) / max(a, b)) < 1e-5


def silhouette_of(rows):
    """By all distances; rows of one id and label count together, as in the SQL."""
    x, c = np.array([r[3] for r in rows]), np.array([r[1] for r in rows])
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(2))
    out = {}
    for key in {(r[0], r[1]) for r in rows}:
        mine = [i for i, r in enumerate(rows) if (r[0], r[1]) == key]
        total = {k: d[np.ix_(mine, c == k)] for k in {*c}}
        n = total[key[1]].size - 1
        a, b = total[key[1]].sum() / n if n else None, min(v.mean() for k, v in total.items() if k != key[1])
        out[key] = 0 if a is None or not max(a, b) else (b - a) / max(a, b)
    return out


def test_silhouette_of_cut_labels_equal_rows_and_equal_ids(spark):
    rng = np.random.default_rng(11)
    rows = [(i, f"L{min(i % 23, 9)}", "g", (rng.normal(size=6) + i % 3).tolist()) for i in range(400)]  # L9 has most rows
    rows += [(3, "L3", "g", rng.normal(size=6).tolist()), (3, "L9", "g", rng.normal(size=6).tolist()), (5, "L5", "g", rng.normal(size=6).tolist())]
    rows += [(1_000 + i, "L9" if i % 2 else "L1", "g", rows[7][3]) for i in range(6)] + [(2_000 + i, f"only{i}", "g", rng.normal(size=6).tolist()) for i in range(20)]
    rows += [(3_000 + i, f"far{i % 2}", "g", (1e7 + (i % 2) * 1e-3 + 1e-3 * rng.normal(size=6)).tolist()) for i in range(12)]
    rows += [(4_000 + i, f"L{i}", "g", [float(i)] * 6) for i in range(6)]  # floats among doubles
    packed = M.packed(spark.createDataFrame(rows, SCHEMA), "id", "label", "f", 6)
    want = silhouette_of(rows)
    for block in (16, 100, 32_768):
        got = {(r.id, r.label): r.silhouette for r in M.silhouettes(packed, 6, block=block).collect()}
        assert got.keys() == want.keys() and max(abs(got[k] - want[k]) for k in want) < 2e-6


def test_silhouette_shuffles_rows_once(spark):
    rng = np.random.default_rng(12)
    df = spark.createDataFrame([(i, f"L{i % 40}", "g", rng.normal(size=32).tolist()) for i in range(2_000)], SCHEMA)
    packed = M.packed(df, "id", "label", "f", 32)

    def written():
        context = spark._jsc.sc()
        context.listenerBus().waitUntilEmpty(30_000)
        return sum(e.totalShuffleWrite() for e in [context.statusStore().executorSummary("driver")])

    before = written()
    assert M.silhouettes(packed, 32, block=100).count() == 2_000
    assert written() - before < 2_000 * 32 * 8 * 3  # 20 blocks; a copy for each would be 20 times the rows


def test_percent_replicating_tells_replicates_from_noise(spark):
    rng = np.random.default_rng(5)
    rows = []
    for k in range(12):
        base = rng.normal(size=20)
        for _ in range(4):
            x = base + rng.normal(scale=0.2, size=20) if k < 4 else rng.normal(size=20)
            rows.append((len(rows), f"L{k:02}", "g", x.tolist()))
    rows.append((99, "one", "g", rng.normal(size=20).tolist()))
    prepared = S.prepared(spark.createDataFrame(rows, SCHEMA), "id", "cohort", "label", "f", 20, "ordinal")
    got = {r.label: r for r in S.percent_replicating(prepared, 20, n_null=400).collect()}
    assert all(got[f"L{k:02}"].replicates == 1 for k in range(4)) and got["one"].observed is None and got["one"].replicates == 0
    assert sum(r.replicates for r in got.values()) <= 6 and -1 <= got["L00"].null_95 <= 1


def test_threshold_is_an_observed_similarity(spark):
    rng = np.random.default_rng(6)
    rows = []
    for k in range(8):
        base = rng.normal(size=20)
        rows += [(10 * k + i, f"L{k}", "g", (base + rng.normal(scale=0.3, size=20)).tolist()) for i in range(4)]
    rows += [(500 + i, f"S{i}", "lonely", rng.normal(size=20).tolist()) for i in range(5)]
    prepared = S.prepared(spark.createDataFrame(rows, SCHEMA), "id", "cohort", "label", "f", 20, "cosine")
    counts = S.similarity_counts(prepared, 20)
    same = {r.sim for r in counts.filter("same").collect()}
    got = {r.grp: r for r in S.fdr_threshold(counts).collect()}
    assert got["g"].threshold in same and got["g"].n_rejected > 0
    assert got["lonely"].threshold == 0.0 and got["lonely"].n_rejected == 0


def test_memberships_on_own_features(spark):
    values = spark.createDataFrame([("g", "a", 0, 1.0), ("g", "a", 1, -1.0), ("g", "b", 0, -1.0), ("g", "b", 1, 1.0)], "grp string, label string, pos int, x double")
    sub = spark.createDataFrame([("g", "c1", 0, 2.0), ("g", "c1", 1, -2.0), ("g", "c2", 1, 3.0)], "grp string, community string, pos int, median double")
    found = {(r.label, r.community): r.similarity for r in G.memberships(values, sub, ["grp", "label"]).collect()}
    assert {k: round(v, 9) for k, v in found.items()} == {("a", "c1"): 1.0, ("b", "c2"): 1.0}
    text = {r.label: r.memberships for r in G.membership_text(G.memberships(values, sub, ["grp", "label"]), ["grp", "label"]).collect()}
    assert text["a"] == ["c1: 1.0"]
