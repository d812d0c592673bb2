"""Queries over profiles: similarity, replicates, graphs, learning."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wellspring.functions.keys import perturbation_key
from wellspring.operators import graph as G
from wellspring.operators import ml as M
from wellspring.operators import similarity as S
from wellspring.operators.stats import medians
from wellspring.plans.tables import table
from wellspring.session import cut

DIMS = 64


def _profiles(spark, folder) -> DataFrame:
    return table(spark, folder, "profiles").select("profile_id", perturbation_key(F.col("Metadata_Perturbation")).alias("label"), F.trim("cohort").alias("cohort"), "features")


def _vectors(spark, folder, kind: str) -> DataFrame:
    return cut(S.prepared(_profiles(spark, folder), "profile_id", "cohort", "label", "features", DIMS, kind))


def cosine_by_label(spark, folder):
    return S.replicate_similarity(_vectors(spark, folder, "cosine"), DIMS)


def pearson_by_label(spark, folder):
    return S.replicate_similarity(_vectors(spark, folder, "pearson"), DIMS)


def spearman_by_label(spark, folder):
    return S.replicate_similarity(_vectors(spark, folder, "spearman"), DIMS)


def ordinal_rank_by_label(spark, folder):
    """Pearson's correlation of ordinal ranks, ties in the order of the features."""
    return S.replicate_similarity(_vectors(spark, folder, "ordinal"), DIMS)


def same_label_similarity(spark, folder):
    """Mean similarity over all pairs of one label."""
    m = S.label_moments(_vectors(spark, folder, "cosine"), ["label"], DIMS)
    return m.agg(F.sum("n_pairs").alias("n_pairs"), F.round(F.sum("total") / F.sum("n_pairs"), 6).alias("mean_sim"))


def cohens_d(spark, folder):
    return S.cohens_d(_vectors(spark, folder, "spearman"), DIMS)


def _pairs(spark, folder) -> DataFrame:
    return S.label_pairs(_vectors(spark, folder, "cosine"), DIMS, -1.0)


def compound_similarity(spark, folder):
    """Medians over replicate pairs of every two perturbations of a cohort."""
    return _pairs(spark, folder).filter("label_a <> label_b").withColumn("similarity", F.round("similarity", 6))


def average_precision(spark, folder):
    return S.average_precision(_vectors(spark, folder, "cosine"), DIMS).select("id", "label", F.round("ap", 6).alias("ap"), "n_positive")


def map_by_label(spark, folder):
    """Mean average precision per perturbation."""
    ap = S.average_precision(_vectors(spark, folder, "cosine"), DIMS).filter("ap is not null")
    return ap.groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("ap"), 6).alias("mean_ap"))


def similarity_counts(spark, folder):
    """Pairs of a cohort by rounded similarity, same and different label."""
    counts = S.similarity_counts(_vectors(spark, folder, "cosine"), DIMS)
    return counts.groupBy("grp", "same").agg(F.sum("n").alias("n_pairs"), F.round(F.sum(F.col("n") * F.col("sim")) / F.sum("n"), 4).alias("mean_sim"))


def _thresholds(rows: DataFrame) -> DataFrame:
    return cut(S.fdr_threshold(S.similarity_counts(rows, DIMS)))


def fdr_threshold(spark, folder):
    return _thresholds(_vectors(spark, folder, "cosine"))


def percent_replicating(spark, folder):
    """Replicating perturbations and their share per cohort."""
    found = S.percent_replicating(_vectors(spark, folder, "ordinal"), DIMS)
    return found.groupBy("grp").agg(F.count(F.lit(1)).alias("n_labels"), F.sum("replicates").alias("n_replicating"), F.round(F.avg("replicates"), 6).alias("share"), F.max("null_95").alias("null_95"))


def _graph(spark, folder) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    rows = _vectors(spark, folder, "cosine")
    limits = _thresholds(rows)
    pairs = cut(S.label_pairs(rows, DIMS, limits))
    return cut(rows.select("grp", "label").distinct()), cut(G.threshold_edges(pairs, limits)), pairs, limits


def similarity_graph_edges(spark, folder):
    return _graph(spark, folder)[1].withColumn("similarity", F.round("similarity", 6))


def node_degree(spark, folder):
    nodes, edges, _, _ = _graph(spark, folder)
    return G.degrees(nodes, edges)


def connected_components(spark, folder):
    nodes, edges, _, _ = _graph(spark, folder)
    return G.components(nodes, edges)


def communities(spark, folder):
    nodes, edges, _, _ = _graph(spark, folder)
    return G.communities(nodes, edges)


def community_modularity(spark, folder):
    """Modularity of the communities and of the plain components per cohort."""
    nodes, edges, _, _ = _graph(spark, folder)
    a = G.modularity(edges, cut(G.communities(nodes, edges))).withColumnRenamed("modularity", "communities")
    b = G.modularity(edges, G.components(nodes, edges).withColumnRenamed("component", "community")).withColumnRenamed("modularity", "components")
    return a.join(b, "grp")


def _values(spark, folder) -> DataFrame:
    """Array elements of the usable profiles."""
    p = _profiles(spark, folder).filter("label is not null and cohort is not null").select(F.col("cohort").alias("grp"), "label", "features")
    return G.feature_values(p.filter(F.size("features") == DIMS), ["grp", "label"], "features")


def dominant_features(spark, folder):
    """Dominant features of every perturbation of a cohort."""
    found = G.dominant_features(cut(_values(spark, folder)), ["grp", "label"])
    return found.withColumn("median", F.round("median", 6)).withColumn("share", F.round("share", 6))


def subprofile_median(spark, folder):
    """Median profile of every perturbation of a cohort."""
    return medians(_values(spark, folder), ["grp", "label", "pos"], "x", "median").withColumn("median", F.round("median", 6) + 0.0)


def _communities(spark, folder):
    nodes, edges, pairs, limits = _graph(spark, folder)
    member = cut(G.communities(nodes, edges))
    values = cut(_values(spark, folder).join(member, ["grp", "label"]))
    return member, values, cut(G.dominant_features(values, ["grp", "community"])), pairs, limits, edges, nodes


def community_report(spark, folder):
    """Every community with its members' number, dominant features and whether it is a singleton."""
    member, _, dominant, *_ = _communities(spark, folder)
    sizes = member.groupBy("grp", "community").agg(F.count(F.lit(1)).alias("n_members"))
    feats = dominant.groupBy("grp", "community").agg(F.count(F.lit(1)).alias("n_dominant"), F.array_join(F.transform(F.sort_array(F.collect_list("pos")), lambda p: p.cast("string")), "|").alias("dominant"))
    return sizes.join(feats, ["grp", "community"], "left").fillna(0, ["n_dominant"]).withColumn("singleton", F.col("n_members") == 1)


def _memberships(spark, folder):
    member, values, dominant, pairs, limits, edges, nodes = _communities(spark, folder)
    wide = cut(medians(values, ["grp", "label", "pos"], "x", "x").drop("n"))
    large = member.groupBy("grp", "community").count().filter("count > 1").select("grp", "community")
    return G.memberships(wide, dominant.join(large, ["grp", "community"]).select("grp", "community", "pos", "median"), ["grp", "label"]), member, pairs, limits, edges, nodes


def soft_memberships(spark, folder):
    """Communities of two or more that a perturbation resembles on their own dominant features."""
    return _memberships(spark, folder)[0].withColumn("similarity", F.round("similarity", 6))


def reference_validation(spark, folder):
    """Reference perturbations with their community and memberships."""
    found, member, *_ = _memberships(spark, folder)
    known = table(spark, folder, "perturbations").filter("Metadata_Reference").select(perturbation_key(F.col("Metadata_Perturbation")).alias("label")).filter("label is not null").distinct()
    text = G.membership_text(found, ["grp", "label"])
    return member.join(known, "label", "left_semi").join(text, ["grp", "label"], "left").fillna(0, ["n_memberships"])


def node_confidence(spark, folder):
    """Nodes with degree, median replicate similarity, replication and confidence."""
    nodes, edges, pairs, limits = _graph(spark, folder)
    own = pairs.filter("label_a = label_b").select("grp", F.col("label_a").alias("label"), F.col("similarity").alias("median_replicate_sim"))
    reps = S.percent_replicating(_vectors(spark, folder, "ordinal"), DIMS).select("grp", "label", "replicates")
    out = G.degrees(nodes, edges).join(own, ["grp", "label"], "left").join(reps, ["grp", "label"], "left").join(limits.select("grp", "threshold"), "grp")
    level = G.confidence(F.col("replicates"), F.col("median_replicate_sim"), F.col("threshold"))
    return out.select("grp", "label", "degree", F.round("median_replicate_sim", 6).alias("median_replicate_sim"), F.coalesce("replicates", F.lit(0)).alias("replicates"), level.alias("confidence"))


def graph_layout(spark, folder):
    return G.circular_layout(_graph(spark, folder)[0])


def _packed(spark, folder) -> DataFrame:
    return M.packed(table(spark, folder, "profiles"), "profile_id", "cohort", "features", DIMS)


def pca_scores(spark, folder):
    found = M.principal_components(cut(_packed(spark, folder)), DIMS)
    return found.select("id", *[F.round(f"pc{i}", 6).alias(f"pc{i}") for i in (1, 2, 3)])


def silhouette(spark, folder):
    """Of all profiles, with their cohorts as labels."""
    return M.silhouettes(_packed(spark, folder), DIMS)


def label_codes(spark, folder):
    return M.label_codes(_profiles(spark, folder), "label")


def _predictions(spark, folder) -> DataFrame:
    return M.forest_predictions(table(spark, folder, "embeddings"), "vec_id", "label", "embedding")


def rf_confusion(spark, folder):
    return _predictions(spark, folder).groupBy("label", "predicted").agg(F.count(F.lit(1)).alias("n"))


def rf_report(spark, folder):
    return M.classification_report(_predictions(spark, folder))


QUERIES = {f.__name__: f for f in (
    cosine_by_label, pearson_by_label, spearman_by_label, ordinal_rank_by_label, same_label_similarity, cohens_d, compound_similarity, average_precision, map_by_label, similarity_counts,
    fdr_threshold, percent_replicating, similarity_graph_edges, node_degree, connected_components, communities, community_modularity, dominant_features, subprofile_median, community_report,
    soft_memberships, reference_validation, node_confidence, graph_layout, pca_scores, silhouette, label_codes, rf_confusion, rf_report)}

_USABLE = "len(features) = 64 AND len(list_filter(features, lambda v: v IS NULL OR NOT isfinite(v))) = 0"
_V = f"""v AS (SELECT profile_id AS id, upper(trim(Metadata_Perturbation)) AS label, trim(cohort) AS grp, features::DOUBLE[] AS f FROM profiles WHERE {_USABLE} AND Metadata_Perturbation IS NOT NULL AND cohort IS NOT NULL)"""
_COS = f"{_V}, u AS (SELECT id, label, grp, list_transform(f, lambda x: x / coalesce(nullif(sqrt(list_dot_product(f, f)), 0), 1)) AS u FROM v)"


def _centred(source: str) -> str:
    return f"c AS (SELECT id, label, grp, list_transform(f, lambda x: x - list_avg(f)) AS c FROM {source}), u AS (SELECT id, label, grp, list_transform(c, lambda x: x / coalesce(nullif(sqrt(list_dot_product(c, c)), 0), 1)) AS u FROM c)"


def _ranked(expression: str) -> str:
    return f"""{_V}, e AS (SELECT id, label, grp, unnest(f) AS x, generate_subscripts(f, 1) AS pos FROM v),
r AS (SELECT id, label, grp, pos, ({expression})::DOUBLE AS r FROM e), w AS (SELECT id, label, grp, list(r ORDER BY pos) AS f FROM r GROUP BY 1, 2, 3), {_centred('w')}"""


_PEARSON = f"{_V}, w AS (SELECT id, label, grp, list_transform(f, lambda x: greatest(-25, least(25, x))) AS f FROM v), {_centred('w')}"
_SPEARMAN = _ranked("rank() OVER (PARTITION BY id ORDER BY x) + (count(*) OVER (PARTITION BY id, x) - 1) / 2.0")
_ORDINAL = _ranked("row_number() OVER (PARTITION BY id ORDER BY x, pos)")
_BY_LABEL = """, p AS (SELECT a.label, list_dot_product(a.u, b.u) AS s FROM u a JOIN u b ON a.label = b.label AND a.id < b.id), n AS (SELECT label, count(*) AS n FROM u GROUP BY 1)
SELECT label, n, round(m, 6) AS mean_sim, round(d, 6) AS std_sim FROM n LEFT JOIN (SELECT label, avg(s) AS m, stddev_pop(s) AS d FROM p GROUP BY 1) USING (label)"""
_PAIRS = f"""{_COS}, s AS (SELECT a.grp, least(a.label, b.label) AS label_a, greatest(a.label, b.label) AS label_b, greatest(0, least(1, list_dot_product(a.u, b.u))) AS s FROM u a JOIN u b ON a.grp = b.grp AND a.id < b.id),
pairs AS (SELECT grp, label_a, label_b, median(s) AS similarity, count(*) AS n_pairs FROM s GROUP BY 1, 2, 3)"""
_FDR = f"""k AS (SELECT grp, label_a = label_b AS same, floor(s * 10000 + 0.5) / 10000 AS sim FROM s),
cross_ AS (SELECT grp, sim, row_number() OVER (PARTITION BY grp ORDER BY sim) - 1 AS ix, count(*) OVER (PARTITION BY grp) AS m FROM k WHERE NOT same),
draws AS (SELECT grp, least(1000, m) AS n_null, least(m - 1, floor(((i + 0.5) * 0.6180339887498949 - floor((i + 0.5) * 0.6180339887498949)) * m))::BIGINT AS ix FROM (SELECT DISTINCT grp, m FROM cross_), (SELECT unnest(range(1000)) AS i) WHERE i < least(1000, m)),
nul AS (SELECT grp, n_null, sim FROM draws JOIN cross_ USING (grp, ix)),
sims AS (SELECT grp, sim, count(*) AS n FROM k WHERE same GROUP BY 1, 2),
pv AS (SELECT grp, sim, n, greatest((SELECT count(*) FROM nul WHERE nul.grp = sims.grp AND nul.sim >= sims.sim), 1) / (SELECT min(n_null) FROM nul WHERE nul.grp = sims.grp) AS p FROM sims),
kk AS (SELECT *, sum(n) OVER (PARTITION BY grp ORDER BY p) AS k, sum(n) OVER (PARTITION BY grp) AS tests FROM pv),
lim AS (SELECT grp, max(p) FILTER (p <= k / tests * 0.05) AS pl, coalesce(max(k) FILTER (p <= k / tests * 0.05), 0)::BIGINT AS n_rejected FROM kk GROUP BY 1),
p95 AS (SELECT grp, min(sim) AS p95 FROM (SELECT grp, sim, n_null, count(*) OVER (PARTITION BY grp ORDER BY sim) AS upto FROM nul) WHERE upto >= n_null * 0.95 GROUP BY 1),
thr AS (SELECT g.grp, CASE WHEN lim.grp IS NULL THEN 0.0 ELSE coalesce((SELECT min(sim) FROM kk WHERE kk.grp = g.grp AND kk.p <= lim.pl), p95) END AS threshold, coalesce(n_rejected, 0) AS n_rejected FROM (SELECT DISTINCT grp FROM k) g LEFT JOIN lim USING (grp) LEFT JOIN p95 USING (grp))"""
_GRAPH = f"{_PAIRS}, {_FDR}, edges AS (SELECT p.* FROM pairs p JOIN thr USING (grp) WHERE label_a <> label_b AND similarity >= threshold), nodes AS (SELECT DISTINCT grp, label FROM u), both_ AS (SELECT grp, label_a AS a, label_b AS b FROM edges UNION ALL SELECT grp, label_b, label_a FROM edges)"
_VALUES = "e AS (SELECT trim(cohort) AS grp, upper(trim(Metadata_Perturbation)) AS label, unnest(features)::DOUBLE AS x, generate_subscripts(features, 1) - 1 AS pos FROM profiles WHERE len(features) = 64 AND Metadata_Perturbation IS NOT NULL AND cohort IS NOT NULL), x AS (SELECT * FROM e WHERE x IS NOT NULL AND NOT isnan(x))"

ORACLES = {
    "cosine_by_label": f"WITH {_COS}{_BY_LABEL}",
    "pearson_by_label": f"WITH {_PEARSON}{_BY_LABEL}",
    "spearman_by_label": f"WITH {_SPEARMAN}{_BY_LABEL}",
    "ordinal_rank_by_label": f"WITH {_ORDINAL}{_BY_LABEL}",
    "same_label_similarity": f"WITH {_COS} SELECT count(*) AS n_pairs, round(avg(list_dot_product(a.u, b.u)), 6) AS mean_sim FROM u a JOIN u b ON a.label = b.label AND a.id < b.id",
    "cohens_d": f"""WITH {_SPEARMAN}, p AS (SELECT a.label = b.label AS same, list_dot_product(a.u, b.u) AS s FROM u a JOIN u b ON a.id <> b.id),
m AS (SELECT avg(s) FILTER (same) AS m1, avg(s) FILTER (NOT same) AS m0, var_samp(s) FILTER (same) AS v1, var_samp(s) FILTER (NOT same) AS v0, count(*) FILTER (same) AS n1, count(*) FILTER (NOT same) AS n0 FROM p),
d AS (SELECT *, sqrt(((n1 - 1) * v1 + (n0 - 1) * v0) / (n1 + n0 - 2)) AS sd FROM m) SELECT round(m1, 6) AS mean_signal, round(m0, 6) AS mean_noise, round(sd, 6) AS pooled_std, round(CASE WHEN sd = 0 THEN 0 ELSE (m1 - m0) / sd END, 6) AS cohens_d FROM d""",
    "compound_similarity": f"WITH {_PAIRS} SELECT grp, label_a, label_b, round(similarity, 6) AS similarity, n_pairs FROM pairs WHERE label_a <> label_b",
    "average_precision": f"""WITH {_COS}, s AS (SELECT a.id, a.label, a.label = b.label AS hit, row_number() OVER (PARTITION BY a.id ORDER BY round(list_dot_product(a.u, b.u), 9) DESC, b.id) AS k FROM u a JOIN u b ON a.grp = b.grp AND a.id <> b.id),
h AS (SELECT *, sum(hit::INT) OVER (PARTITION BY id ORDER BY k) AS hits FROM s) SELECT u.id, u.label, round(avg(hits / k) FILTER (hit), 6) AS ap, count(*) FILTER (hit) AS n_positive FROM u LEFT JOIN h ON u.id = h.id GROUP BY 1, 2""",
    "map_by_label": f"""WITH {_COS}, s AS (SELECT a.id, a.label, a.label = b.label AS hit, row_number() OVER (PARTITION BY a.id ORDER BY round(list_dot_product(a.u, b.u), 9) DESC, b.id) AS k FROM u a JOIN u b ON a.grp = b.grp AND a.id <> b.id),
h AS (SELECT *, sum(hit::INT) OVER (PARTITION BY id ORDER BY k) AS hits FROM s), p AS (SELECT id, label, avg(hits / k) AS ap FROM h WHERE hit GROUP BY 1, 2) SELECT label, count(*) AS n, round(avg(ap), 6) AS mean_ap FROM p GROUP BY 1""",
    "similarity_counts": f"WITH {_PAIRS} SELECT grp, label_a = label_b AS same, count(*) AS n_pairs, round(avg(floor(s * 10000 + 0.5) / 10000), 4) AS mean_sim FROM s GROUP BY 1, 2",
    "fdr_threshold": f"WITH {_PAIRS}, {_FDR} SELECT grp, threshold, n_rejected FROM thr",
    "similarity_graph_edges": f"WITH {_GRAPH} SELECT grp, label_a, label_b, round(similarity, 6) AS similarity, n_pairs FROM edges",
    "node_degree": f"WITH {_GRAPH} SELECT n.grp, label, count(b) AS degree FROM nodes n LEFT JOIN both_ ON n.grp = both_.grp AND n.label = both_.a GROUP BY 1, 2",
    "connected_components": f"WITH RECURSIVE {_GRAPH}, walk(grp, label, reach) AS (SELECT grp, label, label FROM nodes UNION SELECT w.grp, w.label, both_.b FROM walk w JOIN both_ ON w.grp = both_.grp AND w.reach = both_.a) SELECT grp, label, min(reach) AS component FROM walk GROUP BY 1, 2",
    "dominant_features": f"""WITH {_VALUES}, d AS (SELECT grp, label, pos, median(x) AS m, median(abs(x)) AS a, greatest(avg((x >= 0)::INT), avg((x < 0)::INT)) AS share FROM x GROUP BY 1, 2, 3)
SELECT grp, label, pos::INT AS pos, round(m, 6) AS median, round(share, 6) AS share FROM d WHERE share >= 0.85 AND a >= 0.5""",
    "subprofile_median": f"WITH {_VALUES} SELECT grp, label, pos::INT AS pos, count(*) AS n, round(median(x), 6) + 0.0 AS median FROM x GROUP BY 1, 2, 3",
    "graph_layout": f"WITH {_V}, n AS (SELECT DISTINCT grp, label FROM v), o AS (SELECT grp, label, 2 * 3.141592653589793 * (row_number() OVER (PARTITION BY grp ORDER BY label) - 1) / count(*) OVER (PARTITION BY grp) AS a FROM n) SELECT grp, label, round(cos(a), 6) AS x, round(sin(a), 6) AS y FROM o",
    "silhouette": f"""WITH v AS (SELECT profile_id AS id, cohort AS label, features::DOUBLE[] AS f FROM profiles WHERE {_USABLE} AND cohort IS NOT NULL),
d AS (SELECT a.id, a.label, b.label AS other, sum(list_distance(a.f, b.f)) AS t, count(*) AS n FROM v a, v b GROUP BY 1, 2, 3),
s AS (SELECT id, label, max(t / nullif(n - 1, 0)) FILTER (other = label) AS a, min(t / n) FILTER (other <> label) AS b FROM d GROUP BY 1, 2) SELECT id, label, round(coalesce((b - a) / nullif(greatest(a, b), 0), 0), 6) AS silhouette FROM s""",
    "label_codes": "SELECT label, row_number() OVER (ORDER BY label) - 1 AS code FROM (SELECT DISTINCT upper(trim(Metadata_Perturbation)) AS label FROM profiles WHERE Metadata_Perturbation IS NOT NULL)",
}
