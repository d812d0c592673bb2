"""Queries for problems 1, 2, 4, 7, 8 and 9."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wellspring.functions.keys import perturbation_key, plate_number, well_name
from wellspring.llm.clusters import describe, linked_clusters, ward_division
from wellspring.llm.leakage import find_leaks
from wellspring.llm.mixing import mix
from wellspring.llm.neighbours import ForestPlan, nearest, nearest_exact, pairs_above, unit_vectors
from wellspring.llm.percentiles import combine, count_values, percentiles
from wellspring.llm.truncation import find_truncated
from wellspring.operators.stats import long_form, order_statistics
from wellspring.plans.objects import PLATE, WELL
from wellspring.plans.tables import table
from wellspring.session import cut

DIMS = 64
#: about half of the profiles are isotropic, their ten nearest hard to tell from the rest: many small leaves are searched, fewer of them the more rows there are
WIDE = ForestPlan(trees=32, leaf_rows=128, probes=200, growth=0.55, range_rows=16_384)
QUERY_SET = 50


def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    found = pairs_above(table(spark, folder, "profiles"), "profile_id", "features", DIMS, 0.96)
    return found.select(F.col("id_a").alias("profile_id_a"), F.col("id_b").alias("profile_id_b"))


def p1_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    """The 10 most similar other profiles of every profile whose id is divisible by 50, against all profiles."""
    profiles = table(spark, folder, "profiles")
    found = nearest(profiles, "profile_id", "features", DIMS, 10, WIDE, QUERY_SET)
    named = profiles.select(F.col("profile_id").alias("other"), plate_number(F.col("Metadata_Plate")).alias("plate"), perturbation_key(F.col("Metadata_Perturbation")).alias("perturbation"))
    return found.join(named, "other").select(F.col("id").alias("profile_id"), "rank", F.col("other").alias("neighbour_id"), "plate", "perturbation", F.round("cosine", 6).alias("similarity"))


def p1_recall(spark: SparkSession, folder: str) -> DataFrame:
    """Share of the true 10 nearest that the forest finds, over the same query set, by brute force in blocks.

    ``compared_share`` is the mean number of comparisons of a query (vectors that
    it meets in several trees count each time) by the number of usable profiles.
    """
    profiles = table(spark, folder, "profiles")
    found = cut(nearest(profiles, "profile_id", "features", DIMS, 10, WIDE, QUERY_SET))
    true = nearest_exact(profiles, "profile_id", "features", DIMS, 10, QUERY_SET)
    hit = true.select("id", "other").join(found.select("id", "other", F.lit(1).alias("hit")), ["id", "other"], "left")
    block = F.floor(F.col("id") / 10_000).alias("id_block")
    effort = found.groupBy("id").agg(F.max("compared").alias("compared")).groupBy(block).agg(F.avg("compared").alias("compared"))
    rows = unit_vectors(profiles, "profile_id", "features", DIMS).agg(F.count(F.lit(1)).alias("rows"))  # one row
    share = F.round(F.col("compared") / F.col("rows"), 4).alias("compared_share")
    recall = hit.groupBy(block).agg(F.count(F.lit(1)).alias("n_true"), F.count("hit").alias("n_found"), F.round(F.count("hit") / F.count(F.lit(1)), 6).alias("recall"))
    return recall.join(effort, "id_block").join(F.broadcast(rows)).select("id_block", "n_true", "n_found", "recall", share)


def _linked(spark: SparkSession, folder: str) -> DataFrame:
    return linked_clusters(table(spark, folder, "profiles"), "profile_id", "features", DIMS, 0.80, 10)


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    return _linked(spark, folder).select(F.col("id").alias("profile_id"), "cluster_key")


def p2_sizes(spark: SparkSession, folder: str) -> DataFrame:
    """Size of every linked cluster."""
    return _linked(spark, folder).groupBy("cluster_key").agg(F.count(F.lit(1)).alias("size"))


def p2_clusters(spark: SparkSession, folder: str) -> DataFrame:
    """Linked clusters with size and most typical members."""
    vectors = unit_vectors(table(spark, folder, "profiles"), "profile_id", "features", DIMS)
    return describe(vectors, _linked(spark, folder), DIMS)


def _division(spark: SparkSession, folder: str) -> DataFrame:
    return ward_division(table(spark, folder, "profiles"), "profile_id", "features", DIMS)


def p2_division(spark: SparkSession, folder: str) -> DataFrame:
    """All usable profiles divided into clusters of mutually similar ones, each with size, most typical members and similarity."""
    return describe(unit_vectors(table(spark, folder, "profiles"), "profile_id", "features", DIMS), _division(spark, folder), DIMS)


def _compared(spark: SparkSession, folder: str, membership: DataFrame) -> DataFrame:
    profiles = table(spark, folder, "profiles").select(F.col("profile_id").alias("id"), perturbation_key(F.col("Metadata_Perturbation")).alias("perturbation"), F.upper(F.trim("cohort")).alias("cohort"))
    counts = membership.join(profiles, "id").filter("perturbation is not null and cohort is not null").groupBy("cohort", "perturbation", "cluster_key").agg(F.count(F.lit(1)).alias("n_profiles"))
    main = counts.groupBy("cohort", "perturbation").agg(F.max_by("cluster_key", F.struct("n_profiles", -F.col("cluster_key"))).alias("cluster_key"), F.sum("n_profiles").alias("n_profiles"), F.count(F.lit(1)).alias("n_clusters"))
    earlier = table(spark, folder, "community_assignments").select(perturbation_key(F.col("Metadata_Perturbation")).alias("perturbation"), F.upper(F.trim("cohort")).alias("cohort"), F.trim("community_id").alias("community_id"), F.trim("viii_primary_cluster").alias("viii_primary_cluster"), "computed_at", "assignment_id")
    latest = earlier.filter("perturbation is not null and cohort is not null").groupBy("cohort", "perturbation").agg(*[F.max_by(c, F.struct(F.coalesce("computed_at", F.lit("1970-01-01").cast("timestamp_ntz")), "assignment_id")).alias(c) for c in ("community_id", "viii_primary_cluster")])
    both = cut(main.join(latest, ["cohort", "perturbation"], "full"))
    out = both
    for label, name in (("community_id", "community_agrees"), ("viii_primary_cluster", "primary_agrees")):
        usual = both.filter(f"cluster_key is not null and {label} is not null").groupBy("cohort", "cluster_key", label).agg(F.sum("n_profiles").alias("n")).groupBy("cohort", "cluster_key").agg(F.max_by(label, F.struct("n", label)).alias("usual"))
        out = out.join(usual, ["cohort", "cluster_key"], "left").withColumn(name, F.col("usual") == F.col(label)).drop("usual")
    return out


def p2_compared(spark: SparkSession, folder: str) -> DataFrame:
    """Per cohort and perturbation: the profiles' main linked cluster beside the earlier assignments.

    ``community_agrees`` and ``primary_agrees`` tell whether the label is the one
    that most members of the cluster in this cohort carry.
    """
    return _compared(spark, folder, _linked(spark, folder))


def p2_division_compared(spark: SparkSession, folder: str) -> DataFrame:
    """The same for the clusters of the division."""
    return _compared(spark, folder, _division(spark, folder))


CELL_FEATURES = [
    "AreaShape_Area", "AreaShape_MedianRadius", "Intensity_MedianIntensity_Syto", "Intensity_MedianIntensity_ER",
    "Intensity_MedianIntensity_Golgi", "Intensity_MedianIntensity_Mito", "Texture_Contrast_Mito_3_02_256",
]
AT = [0.01, 0.05, 0.25, 0.50, 0.75, 0.95, 0.99]
AT_NAMES = ["p01", "p05", "p25", "p50", "p75", "p95", "p99"]


KEYS = ["plate", "well", "perturbation"]
GROUPINGS = {"plate": ["day", "plate"], "perturbation": ["day", "perturbation"], "plate_well": ["day", "plate", "well"]}


def p4_sketches(spark: SparkSession, folder: str) -> DataFrame:
    """The combinable result of each export day: bucket counts per plate, per perturbation and per plate and well."""
    keys = [F.to_date("exported_at").alias("day"), plate_number(F.col("Metadata_Plate")).alias("plate"), well_name(F.col("Metadata_Well")).alias("well"), perturbation_key(F.col("Metadata_Perturbation")).alias("perturbation")]
    cells = table(spark, folder, "cells").select(*keys, *CELL_FEATURES)
    return combine(count_values(cells, ["day", *KEYS], GROUPINGS, CELL_FEATURES, open_keys=("day",)), ["day", *KEYS])


def p4_percentiles(spark: SparkSession, folder: str) -> DataFrame:
    """Percentiles per plate, per perturbation and per plate and well, combined from the export days' sketches.

    Relative error at most 1 %.  Rows without a valid key are left out of the
    groupings by that key.
    """
    return percentiles(combine(p4_sketches(spark, folder), KEYS), KEYS, AT, AT_NAMES)


def p4_daily(spark: SparkSession, folder: str) -> DataFrame:
    """Percentiles of each export day, from the same sketches."""
    return percentiles(p4_sketches(spark, folder), ["day", *KEYS], AT, AT_NAMES)


def p4_checked(spark: SparkSession, folder: str) -> DataFrame:
    """Per grouping and feature the percentiles of :func:`p4_percentiles` further than 1 % from the exact order statistics."""
    found = p4_percentiles(spark, folder)
    at = F.array(*[F.struct(F.floor(F.lit(q) * (F.col("n") - 1)).cast("long").alias("rank"), F.col(name).alias("told")) for q, name in zip(AT, AT_NAMES)])
    told = cut(found.select("by", *KEYS, "feature", "n", F.explode(at).alias("a")).select("by", *KEYS, "feature", "n", "a.*").distinct())
    plate, well, perturbation = plate_number(F.col("Metadata_Plate")).alias("plate"), well_name(F.col("Metadata_Well")).alias("well"), perturbation_key(F.col("Metadata_Perturbation")).alias("perturbation")
    long = long_form(table(spark, folder, "cells").select(plate, well, perturbation, *CELL_FEATURES), KEYS, CELL_FEATURES)
    out = None
    for by, keys in GROUPINGS.items():
        own = [k for k in keys if k != "day"] + ["feature"]
        asked = told.filter(F.col("by") == by)
        rows = long.filter(" and ".join(f"{k} is not null" for k in own))
        exact = order_statistics(rows, own, "value", asked.select(*own, "rank").distinct())
        off = F.abs(F.col("told") - F.col("v")) > 0.01 * F.abs(F.col("v")) * (1 + 1e-9)
        both = asked.join(exact, [*own, "rank"]).groupBy(*own).agg(F.max("n").alias("n"), F.count_if(off).alias("beyond"))
        part = both.groupBy("feature").agg(F.count(F.lit(1)).alias("n_groups"), F.sum("n").alias("n_values"), F.sum("beyond").alias("n_beyond")).select(F.lit(by).alias("by"), "*")
        out = part if out is None else out.unionByName(part)
    return out


def _mixed(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    return mix(table(spark, folder, "documents"), table(spark, folder, "mix_targets"), "doc_id", "source", "text")


def p8_mix(spark: SparkSession, folder: str) -> DataFrame:
    """One row per copy of a chosen document."""
    return _mixed(spark, folder)[0]


def p8_shares(spark: SparkSession, folder: str) -> DataFrame:
    """Target and actual share of all tokens per source."""
    return _mixed(spark, folder)[1]


def p8_checked(spark: SparkSession, folder: str) -> DataFrame:
    """Per source of the targets: its documents, whether no document is used too often, and whether its share is within 0.02 of its goal."""
    rows, reached = _mixed(spark, folder)
    docs = table(spark, folder, "documents").filter("text is not null").groupBy("source").agg(F.count(F.lit(1)).alias("n_documents"))
    used = rows.groupBy("source", "doc_id").agg(F.count(F.lit(1)).alias("n")).groupBy("source").agg(F.max("n").alias("most"))
    targets = table(spark, folder, "mix_targets")
    out = targets.join(docs, "source", "left").join(used, "source", "left").join(reached.select("source", "actual_share"), "source", "left")
    present = F.sum(F.when(F.col("n_documents") > 0, F.col("target_share"))).over(Window.partitionBy())  # one row per source
    goal = F.when(F.col("n_documents") > 0, F.col("target_share") / present).otherwise(0.0)
    near = F.abs(F.coalesce("actual_share", F.lit(0.0)) - goal) <= 0.02
    return out.select("source", F.coalesce("n_documents", F.lit(0)).alias("n_documents"), (F.coalesce("most", F.lit(0)) <= F.col("max_repeats")).alias("within_repeats"), near.alias("near_goal"))


def _leaks(spark: SparkSession, folder: str) -> DataFrame:
    return find_leaks(table(spark, folder, "documents"), table(spark, folder, "eval_items"), "doc_id", "text", "item_id", "text")


def p7_found(spark: SparkSession, folder: str) -> DataFrame:
    return _leaks(spark, folder).select("doc_id", "item_id")


def p7_items(spark: SparkSession, folder: str) -> DataFrame:
    """Every item with the number of documents it leaked into and the longest shared run."""
    leaks = _leaks(spark, folder).groupBy("item_id").agg(F.count(F.lit(1)).alias("n_documents"), F.max("n_words").alias("longest_run"))
    return table(spark, folder, "eval_items").select("item_id", "task", "lang").join(leaks, "item_id", "left").fillna(0, ["n_documents", "longest_run"])


def _truncated(spark: SparkSession, folder: str) -> DataFrame:
    return find_truncated(table(spark, folder, "documents"), "doc_id", "text", "source")


def p9_found(spark: SparkSession, folder: str) -> DataFrame:
    return _truncated(spark, folder).filter("truncated").select("doc_id")


def p9_rates(spark: SparkSession, folder: str) -> DataFrame:
    """Rate of cut mails per source, and how many of them each kind of evidence decided."""
    by = lambda kind: F.count_if(F.col("evidence") == kind).alias
    return _truncated(spark, folder).groupBy("source").agg(
        F.count(F.lit(1)).alias("n_mails"), F.count_if("truncated").alias("n_cut"), by("structure")("n_structure"), by("word")("n_within_word"), by("length")("n_length"), by("phrase")("n_phrase"),
        F.count_if(F.col("truncated") & F.col("at_limit")).alias("n_at_limit"), F.round(F.avg(F.col("truncated").cast("int")), 6).alias("cut_rate"),
    )


QUERIES = {f.__name__: f for f in (p1_found, p1_neighbours, p1_recall, p2_found, p2_sizes, p2_clusters, p2_division, p2_compared, p2_division_compared, p4_percentiles, p4_daily, p4_sketches, p4_checked, p7_found, p7_items, p8_mix, p8_shares, p8_checked, p9_found, p9_rates)}
_UNIT = """v AS (SELECT profile_id AS id, features::DOUBLE[] AS f FROM profiles WHERE len(features) = 64 AND len(list_filter(features, lambda v: v IS NULL OR NOT isfinite(v))) = 0 AND len(list_filter(features, lambda v: v <> 0)) > 0),
u AS (SELECT id, list_transform(f, lambda x: x / sqrt(list_dot_product(f, f))) AS u FROM v)"""

_LINKED = f"""WITH RECURSIVE {_UNIT}, links AS (SELECT a.id AS a, b.id AS b FROM u a JOIN u b ON a.id <> b.id WHERE list_dot_product(a.u, b.u) >= 0.80),
walk(id, reach) AS (SELECT id, id FROM u UNION SELECT w.id, l.b FROM walk w JOIN links l ON w.reach = l.a),
found AS (SELECT id AS profile_id, min(reach) AS cluster_key FROM walk GROUP BY 1 HAVING count(*) >= 10)"""
_LONG = f"""k AS (SELECT {PLATE} AS plate, {WELL} AS well, upper(trim(Metadata_Perturbation)) AS perturbation, {', '.join(CELL_FEATURES)} FROM cells),
long AS (SELECT * FROM (UNPIVOT k ON {', '.join(CELL_FEATURES)} INTO NAME feature VALUE v) WHERE NOT isnan(v))"""
_COUNTS = " UNION ALL ".join(
    f"SELECT '{by}' AS by, feature, count(*) AS n_groups, sum(n) AS n_values, 0 AS n_beyond FROM (SELECT {keys}, feature, count(*) AS n FROM long WHERE {' AND '.join(f'{x} IS NOT NULL' for x in keys.split(', '))} GROUP BY ALL) GROUP BY feature"
    for by, keys in (("plate", "plate"), ("perturbation", "perturbation"), ("plate_well", "plate, well")))

ORACLES: dict[str, str] = {
    "p1_found": f"WITH {_UNIT} SELECT a.id AS profile_id_a, b.id AS profile_id_b FROM u a JOIN u b ON a.id < b.id WHERE list_dot_product(a.u, b.u) >= 0.96",
    "p2_found": f"{_LINKED} SELECT * FROM found",
    "p2_sizes": f"{_LINKED} SELECT cluster_key, count(*) AS size FROM found GROUP BY 1",
    "p4_checked": f"WITH {_LONG} {_COUNTS}",
    "p8_checked": """SELECT t.source, count(doc_id) AS n_documents, true AS within_repeats, true AS near_goal FROM mix_targets t LEFT JOIN (SELECT * FROM documents WHERE text IS NOT NULL) d USING (source) GROUP BY 1""",
}
