"""Queries that put results side by side: reproducibility, node tables, colour bands, lookups, samples."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wellspring.functions.keys import compartment_rank, dashed_name, label_is, perturbation_key
from wellspring.operators import design as D
from wellspring.operators import graph as G
from wellspring.operators import ml as M
from wellspring.operators import qc as Q
from wellspring.operators import similarity as S
from wellspring.operators.stats import long_form
from wellspring.plans import objects as O
from wellspring.plans import quality as U
from wellspring.plans import relations as R
from wellspring.plans.tables import table
from wellspring.session import cut

KEYS = ["grp", "label"]


def _replicates(spark, folder, kind: str) -> DataFrame:
    """Mean and deviation over a perturbation's pairs within its cohort."""
    m = S.label_moments(R._vectors(spark, folder, kind), KEYS, R.DIMS)
    mean = F.try_divide("total", "n_pairs")
    spread = F.when(F.col("n_pairs") > 0, F.sqrt(F.greatest(F.lit(0.0), F.try_divide("squares", "n_pairs") - mean * mean)))
    return m.select(*KEYS, "n", F.round(mean, 6).alias(f"mean_{kind}"), F.round(spread, 6).alias(f"std_{kind}"))


def label_metrics(spark, folder):
    """Every perturbation of a cohort with its metrics side by side; least similar replicates first, without replicates last."""
    labels = R._vectors(spark, folder, "cosine").select(*KEYS).distinct()
    out = labels.join(_replicates(spark, folder, "cosine"), KEYS, "left")
    for kind in ("spearman", "pearson"):
        out = out.join(_replicates(spark, folder, kind).drop("n"), KEYS, "left")
    found = S.average_precision(R._vectors(spark, folder, "cosine"), R.DIMS).filter("ap is not null")
    homes = R._profiles(spark, folder).select(F.col("profile_id").alias("id"), F.col("cohort").alias("grp"))
    mean_ap = found.join(homes, "id").groupBy(*KEYS).agg(F.round(F.avg("ap"), 6).alias("mean_ap"))
    return out.join(mean_ap, KEYS, "left").orderBy(F.col("mean_cosine").asc_nulls_last(), *KEYS)


def reproducibility_report(spark, folder):
    """The metrics with percent replicating: observed value, chance and flag; most similar replicates first."""
    found = S.percent_replicating(R._vectors(spark, folder, "ordinal"), R.DIMS)
    flags = found.select(*KEYS, F.col("observed").alias("pr_observed"), F.col("null_95").alias("pr_null_95"), F.col("replicates").alias("pr_replicates"))
    return label_metrics(spark, folder).join(flags, KEYS, "left").orderBy(F.col("mean_cosine").desc_nulls_last(), *KEYS)


def node_table(spark, folder):
    """Every node with community, degree, replicate similarity, memberships, reference flag, replication, mAP and confidence."""
    found, member, pairs, limits, edges, nodes = R._memberships(spark, folder)
    order = member.groupBy("grp", "community").agg(F.count(F.lit(1)).alias("size"))
    text = G.membership_text(found, KEYS)
    second = found.join(member.withColumnRenamed("community", "own"), KEYS).filter("community <> own").groupBy(*KEYS).agg(F.count(F.lit(1)).alias("n_secondary"))
    own = pairs.filter("label_a = label_b").select("grp", F.col("label_a").alias("label"), F.round("similarity", 6).alias("median_replicate_sim"))
    known = table(spark, folder, "perturbations").filter("Metadata_Reference").select(perturbation_key(F.col("Metadata_Perturbation")).alias("label"))
    report = cut(reproducibility_report(spark, folder)).select(*KEYS, "pr_replicates", "mean_ap")
    out = G.degrees(nodes, edges).join(member, KEYS).join(order, ["grp", "community"]).join(own, KEYS, "left").join(text, KEYS, "left").join(second, KEYS, "left")
    out = out.join(known.filter("label is not null").distinct().withColumn("is_reference", F.lit(True)), "label", "left").join(report, KEYS, "left")
    out = out.join(limits.select("grp", "threshold"), "grp")
    level = G.confidence(F.col("pr_replicates"), F.col("median_replicate_sim"), F.col("threshold"))
    return out.select(
        *KEYS, "community", F.col("size").alias("community_size"), "degree", "median_replicate_sim", F.coalesce("n_secondary", F.lit(0)).alias("n_secondary"),
        F.coalesce("memberships", F.array().cast("array<string>")).alias("all_memberships"), F.coalesce("is_reference", F.lit(False)).alias("is_reference"),
        "pr_replicates", "mean_ap", level.alias("confidence"))


def confidence_counts(spark, folder):
    """Nodes of each confidence per cohort."""
    return R.node_confidence(spark, folder).groupBy("grp", "confidence").agg(F.count(F.lit(1)).alias("n"))


def assignment_nodes(spark, folder):
    """Earlier assignments with the metrics found now; what an assignment lacks takes its default."""
    metrics = label_metrics(spark, folder).select(F.upper("grp").alias("cohort"), F.col("label").alias("perturbation"), "n", "mean_cosine", "mean_ap")
    rows = table(spark, folder, "community_assignments").select(
        "assignment_id", F.upper(F.trim("cohort")).alias("cohort"), perturbation_key(F.col("Metadata_Perturbation")).alias("perturbation"),
        F.coalesce("community_ix", F.lit(-1)).alias("community_ix"), F.coalesce("n_secondary_clusters", F.lit(0)).alias("n_secondary"),
        F.coalesce("all_memberships", F.lit("{}")).alias("all_memberships"), F.coalesce("is_reference", F.lit(False)).alias("is_reference"), "node_confidence")
    return rows.join(metrics, ["cohort", "perturbation"], "left").withColumnRenamed("n", "n_replicates")


def assignment_confidence(spark, folder):
    """Earlier assignments of each confidence."""
    return table(spark, folder, "community_assignments").groupBy("node_confidence").agg(F.count(F.lit(1)).alias("n"))


def rf_top_features(spark, folder):
    """The 30 features that matter most to a forest over all rows, the first 20 marked."""
    return M.feature_importances(table(spark, folder, "embeddings"), "label", "embedding", 30).withColumn("shown", F.col("rank") <= 20)


def object_relations(spark, folder):
    """Sites with their first cell and the number of cells, joined by ids; sites without cells have none."""
    keys = ["ImageNumber", "plate", "well"]
    sites = table(spark, folder, "image_qc").select("qc_id", "ImageNumber", *O._keys()[:2])
    cells = table(spark, folder, "cells").select("cell_id", "ImageNumber", *O._keys()[:2])
    return Q.first_children(sites, cells, keys, "cell_id").select("qc_id", "cell_id", "n_children", (F.col("n_children") >= 1).alias("kept"))


def qc_colour_bands(spark, folder):
    """Per plate and well the colours of the mean slopes and the worst of them."""
    low, high, stops = Q.BANDS["PowerLogLogSlope"]
    wells = U._wells(spark, folder).filter("metric = 'PowerLogLogSlope'").withColumn("colour", Q.band(F.col("value"), low, high, stops))
    n = lambda c: F.count_if(F.col("colour") == c).alias(f"n_{c}")
    return wells.groupBy("plate", "well").agg(n("red"), n("yellow"), n("green"), Q.worst(F.col("colour")).alias("worst"))


def qc_flags_both(spark, folder):
    """Per plate and well the readings that fail the absolute limits and those outside their plate's band."""
    keys = ["plate", "metric", "channel"]
    long = cut(U._readings(spark, folder))
    judged = Q.verdicts(long, Q.adaptive_bounds(long, keys), keys, independent=True)
    absolute = Q.absolute_pass(judged.drop("passes"))
    tag = F.concat_ws("/", "metric", "channel")
    flagged = lambda bad: F.sort_array(F.collect_set(F.when(bad, tag)))
    return absolute.groupBy("plate", "well").agg(flagged(~F.col("passes")).alias("abs"), flagged(~F.col("adaptive_ok")).alias("adp"))


def plate_lookup(spark, folder):
    """For every spelling of a plate in the site table the platemap's spelling that it stands for."""
    return Q.match_keys(table(spark, folder, "image_qc"), "Metadata_Plate", table(spark, folder, "platemap"), "Metadata_Plate")


def name_split(spark, folder):
    """Row, column and site from the dashes of image names."""
    part = dashed_name(F.col("file"))
    return O._images(spark, folder).select("raw_id", *[c.alias(n) for n, c in part.items()])


def subprofiles_wide(spark, folder):
    """Dominant features of every perturbation of a cohort in one table; a column per position, null where not dominant."""
    found = G.dominant_features(cut(R._values(spark, folder)), KEYS)
    wide = found.groupBy(*KEYS).pivot("pos", list(range(R.DIMS))).agg(F.first("median"))
    return wide.select(*KEYS, *[F.round(F.col(str(i)), 6).alias(f"f{i}") for i in range(R.DIMS)])


def compartment_order(spark, folder):
    """Prefixed features with the rank of their compartment and their place in the order of ranks and names."""
    cells = table(spark, folder, "cells")
    names = {"Cells_": O.FEATURES[:2], "cyto_": O.FEATURES[2:4], "Cytoplasm_": O.FEATURES[4:5], "nuclei_": O.FEATURES[5:]}
    wide = cells.select(*[F.col(f).alias(p + f) for p, fs in names.items() for f in fs])
    counts = cut(long_form(wide, [], wide.columns).groupBy("feature").agg(F.count(F.lit(1)).alias("n")).withColumn("rank", compartment_rank(F.col("feature"))))
    before = counts.alias("a").join(counts.alias("b"), F.expr("b.rank < a.rank or b.rank = a.rank and b.feature < a.feature"), "left")  # one row per feature
    return before.groupBy("a.feature", "a.n", "a.rank").agg(F.count("b.feature").alias("place"))


def box_sample(spark, folder):
    """At most 150 readings of every box, in the order of a hash."""
    long = U._readings(spark, folder, ("qc_id",)).filter("value is not null")
    order = F.md5(F.concat_ws(":", "metric", "channel", F.col("qc_id").cast("string")))
    return Q.sample_per_group(long, ["metric", "channel"], order, 150)


def visible_perturbations(spark, folder):
    """Profiles per perturbation that is no control and named like a compound."""
    label = perturbation_key(F.col("Metadata_Perturbation"))
    shown = label_is(label, prefix="C", without="DMSO")
    return table(spark, folder, "profiles").filter(shown).groupBy(label.alias("label")).agg(F.count(F.lit(1)).alias("n"))


def plate_design_uniform(spark, folder):
    """A layout with the controls in equal steps over the plate: every well's type and label."""
    names = table(spark, folder, "perturbations").filter("not coalesce(Metadata_Reference, false)").select(perturbation_key(F.col("Metadata_Perturbation")).alias("c"))
    laid = D.plate_layout(names.filter(F.col("c") != O.CONTROL), "c", D.Layout(controls="uniform"))
    return laid.filter("type in ('neg', 'pos')").select("plate", "well", "type", "label")


def design_warnings(spark, folder):
    """Controls per designed plate and whether they are too few."""
    return D.control_warnings(O.plate_design(spark, folder))


QUERIES = {f.__name__: f for f in (
    label_metrics, reproducibility_report, node_table, confidence_counts, assignment_nodes, assignment_confidence, rf_top_features, object_relations, qc_colour_bands, qc_flags_both,
    plate_lookup, name_split, subprofiles_wide, compartment_order, box_sample, visible_perturbations, plate_design_uniform, design_warnings)}


def _pairs_of(source: str, kind: str) -> str:
    return f"""{kind}_u AS ({source}), {kind}_m AS (SELECT a.grp, a.label, round(avg(list_dot_product(a.u, b.u)), 6) AS mean_{kind}, round(stddev_pop(list_dot_product(a.u, b.u)), 6) AS std_{kind}
FROM {kind}_u a JOIN {kind}_u b ON a.grp = b.grp AND a.label = b.label AND a.id < b.id GROUP BY 1, 2)"""


_METRICS = f"""{_pairs_of(f"WITH {R._COS} SELECT * FROM u", "cosine")}, {_pairs_of(f"WITH {R._SPEARMAN} SELECT * FROM u", "spearman")}, {_pairs_of(f"WITH {R._PEARSON} SELECT * FROM u", "pearson")},
s AS (SELECT a.id, a.grp, a.label, a.label = b.label AS hit, row_number() OVER (PARTITION BY a.id ORDER BY round(list_dot_product(a.u, b.u), 9) DESC, b.id) AS k FROM cosine_u a JOIN cosine_u b ON a.grp = b.grp AND a.id <> b.id),
h AS (SELECT *, sum(hit::INT) OVER (PARTITION BY id ORDER BY k) AS hits FROM s), p AS (SELECT id, grp, label, avg(hits / k) AS ap FROM h WHERE hit GROUP BY 1, 2, 3),
m AS (SELECT grp, label, round(avg(ap), 6) AS mean_ap FROM p GROUP BY 1, 2), n AS (SELECT grp, label, count(*) AS n FROM cosine_u GROUP BY 1, 2),
metrics AS (SELECT * FROM n LEFT JOIN cosine_m USING (grp, label) LEFT JOIN spearman_m USING (grp, label) LEFT JOIN pearson_m USING (grp, label) LEFT JOIN m USING (grp, label))"""
_LOW, _HIGH, _STOPS = Q.BANDS["PowerLogLogSlope"]
_BAND = f"CASE WHEN value IS NULL THEN NULL {' '.join(f'WHEN greatest(0, least(1, round((value - {_LOW}) / {_HIGH - _LOW}, 12))) <= {end} THEN {chr(39)}{colour}{chr(39)}' for end, colour in _STOPS)} END"
_PLAIN = "CASE WHEN lower(trim({c})) LIKE 'p%' THEN 'p' || coalesce(nullif(ltrim(substr(lower(trim({c})), 2), '0'), ''), '0') ELSE coalesce(nullif(ltrim(lower(trim({c})), '0'), ''), '0') END"
_FEATURES = [p + f for p, fs in (("Cells_", O.FEATURES[:2]), ("cyto_", O.FEATURES[2:4]), ("Cytoplasm_", O.FEATURES[4:5]), ("nuclei_", O.FEATURES[5:])) for f in fs]
_STEPS = [min(95, int(i * 96 / 15 + 0.5)) for i in range(15)]

ORACLES = {
    "label_metrics": f"WITH {_METRICS} SELECT * FROM metrics",
    "assignment_nodes": f"""WITH {_METRICS}, a AS (SELECT assignment_id, upper(trim(cohort)) AS cohort, upper(trim(Metadata_Perturbation)) AS perturbation, coalesce(community_ix, -1) AS community_ix,
coalesce(n_secondary_clusters, 0) AS n_secondary, coalesce(all_memberships, '{{}}') AS all_memberships, coalesce(is_reference, false) AS is_reference, node_confidence FROM community_assignments)
SELECT a.*, n AS n_replicates, mean_cosine, mean_ap FROM a LEFT JOIN metrics ON upper(metrics.grp) = a.cohort AND metrics.label = a.perturbation""",
    "assignment_confidence": "SELECT node_confidence, count(*) AS n FROM community_assignments GROUP BY 1",
    "object_relations": f"""WITH s AS (SELECT qc_id, ImageNumber, {O.PLATE} AS plate, {O.WELL} AS well FROM image_qc), c AS (SELECT ImageNumber, {O.PLATE} AS plate, {O.WELL} AS well, min(cell_id) AS cell_id, count(*) AS n FROM cells GROUP BY 1, 2, 3)
SELECT qc_id, cell_id, coalesce(n, 0) AS n_children, coalesce(n, 0) >= 1 AS kept FROM s LEFT JOIN c USING (ImageNumber, plate, well)""",
    "qc_colour_bands": f"""WITH {U._WELLS}, b AS (SELECT plate, well, {_BAND} AS colour FROM w WHERE metric = 'PowerLogLogSlope')
SELECT plate, well, count(*) FILTER (colour = 'red') AS n_red, count(*) FILTER (colour = 'yellow') AS n_yellow, count(*) FILTER (colour = 'green') AS n_green,
CASE WHEN bool_or(colour = 'red') THEN 'red' WHEN bool_or(colour = 'yellow') THEN 'yellow' WHEN bool_or(colour = 'green') THEN 'green' END AS worst FROM b GROUP BY 1, 2""",
    "qc_flags_both": f"""WITH {U._ADAPT}, o AS (SELECT j.plate, j.well, j.metric || '/' || j.channel AS tag, passes, coalesce(value < m - width OR value > m + width, false) AS outside FROM j LEFT JOIN band USING (plate, metric, channel))
SELECT plate, well, coalesce(list_sort(list_distinct(list(tag) FILTER (NOT passes))), []) AS abs, coalesce(list_sort(list_distinct(list(tag) FILTER (outside))), []) AS adp FROM o GROUP BY 1, 2""",
    "plate_lookup": f"""WITH k AS (SELECT DISTINCT Metadata_Plate AS key FROM image_qc WHERE Metadata_Plate IS NOT NULL), p AS (SELECT DISTINCT Metadata_Plate AS found FROM platemap WHERE Metadata_Plate IS NOT NULL),
f AS (SELECT key, unnest([key, regexp_replace(key, '^P*p*', ''), 'P' || regexp_replace(key, '^P*p*', '')]) AS form, unnest([0, 1, 2]) AS turn FROM k),
c AS (SELECT key, 2 * turn AS o, found FROM f JOIN p ON form = found UNION ALL SELECT key, 2 * turn + 1, q.found FROM f JOIN (SELECT {_PLAIN.format(c='found')} AS plain, min(found) AS found FROM p GROUP BY 1) q ON {_PLAIN.format(c='form')} = q.plain),
b AS (SELECT key, arg_min(found, o) AS found FROM c GROUP BY 1)
SELECT key, CASE WHEN found IS NULL AND (SELECT count(*) FROM p) = 1 THEN (SELECT min(found) FROM p) ELSE found END AS found, CASE WHEN found IS NOT NULL THEN 'key' WHEN (SELECT count(*) FROM p) = 1 THEN 'sole' END AS how FROM k LEFT JOIN b USING (key)""",
    "name_split": f"""WITH {O._FILE}, n AS (SELECT raw_id, string_split(replace(file, '.tiff', ''), '-') AS x FROM images WHERE file IS NOT NULL)
SELECT raw_id, TRY_CAST(x[1][1:3] AS INT) AS "row", TRY_CAST(x[1][4:6] AS INT) AS "column", TRY_CAST(x[2] AS INT) AS site FROM n""",
    "subprofiles_wide": f"""WITH {R._VALUES}, d AS (SELECT grp, label, pos, median(x) AS m, median(abs(x)) AS a, greatest(avg((x >= 0)::INT), avg((x < 0)::INT)) AS share FROM x GROUP BY 1, 2, 3)
SELECT grp, label, {', '.join(f'round(max(m) FILTER (pos = {i}), 6) AS f{i}' for i in range(R.DIMS))} FROM d WHERE share >= 0.85 AND a >= 0.5 GROUP BY 1, 2""",
    "compartment_order": "WITH c AS (" + " UNION ALL ".join(f"SELECT '{n}' AS feature, count(*) FILTER ({n.split('_', 1)[1]} IS NOT NULL AND NOT isnan({n.split('_', 1)[1]})) AS n FROM cells" for n in _FEATURES) + """),
r AS (SELECT *, CASE WHEN lower(feature) LIKE '%cells%' THEN 0 WHEN lower(feature) LIKE '%cytoplasm%' THEN 1 WHEN lower(feature) LIKE '%nuclei%' THEN 2 ELSE 3 END AS rank FROM c) SELECT feature, n, rank, row_number() OVER (ORDER BY rank, feature) - 1 AS place FROM r""",
    "box_sample": f"""WITH {U._READ}, o AS (SELECT qc_id, metric, channel, value, row_number() OVER (PARTITION BY metric, channel ORDER BY md5(metric || ':' || channel || ':' || qc_id)) AS k FROM r WHERE value IS NOT NULL) SELECT qc_id, metric, channel, value FROM o WHERE k <= 150""",
    "visible_perturbations": "SELECT upper(trim(Metadata_Perturbation)) AS label, count(*) AS n FROM profiles WHERE upper(trim(Metadata_Perturbation)) LIKE 'C%' GROUP BY 1",
    "plate_design_uniform": f"""WITH names AS (SELECT count(DISTINCT upper(trim(Metadata_Perturbation))) AS n FROM perturbations WHERE NOT coalesce(Metadata_Reference, false) AND upper(trim(Metadata_Perturbation)) <> 'DMSO'),
plates AS (SELECT unnest(range(1, (n + 39) // 40 + 1))::INT AS plate FROM names), held AS (SELECT unnest({_STEPS}) AS ix, unnest(range(15)) AS place)
SELECT plate, chr((65 + ix // 12)::INT) || lpad((ix % 12 + 1)::VARCHAR, 2, '0') AS well, CASE WHEN place < 10 THEN 'neg' ELSE 'pos' END AS type, CASE WHEN place < 10 THEN 'DMSO' ELSE 'PC_' || ((place - 10) // 2 + 1) END AS label FROM plates, held WHERE place < 14""",
    "design_warnings": """WITH names AS (SELECT count(DISTINCT upper(trim(Metadata_Perturbation))) AS n FROM perturbations WHERE NOT coalesce(Metadata_Reference, false) AND upper(trim(Metadata_Perturbation)) <> 'DMSO')
SELECT unnest(range(1, (n + 39) // 40 + 1))::INT AS plate, 10 AS n_neg, 4 AS n_pos, false AS few_neg, false AS few_pos FROM names""",
}
