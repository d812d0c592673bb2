"""Queries over object tables, platemaps and manifests: joins, outliers, profiles, normalisation, selection, layout."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wellspring.functions.keys import (
    channel_name, image_name_part, mask_name, perturbation_key, plate_from_path, plate_number, plate_text, safe_name, well_label, well_name,
)
from wellspring.operators import profiles as P
from wellspring.operators.design import Layout, as_platemap, plate_layout
from wellspring.operators.stats import long_form, quantiles
from wellspring.plans.tables import table
from wellspring.session import cut

FEATURES = [
    "AreaShape_Area", "AreaShape_MedianRadius", "Intensity_MedianIntensity_Syto", "Intensity_MedianIntensity_ER",
    "Intensity_MedianIntensity_Golgi", "Intensity_MedianIntensity_Mito", "Texture_Contrast_Mito_3_02_256",
]
CONTROL = "DMSO"


def _keys():
    return plate_number(F.col("Metadata_Plate")).alias("plate"), well_name(F.col("Metadata_Well")).alias("well"), perturbation_key(F.col("Metadata_Perturbation")).alias("perturbation")


def cells_long(spark: SparkSession, folder: str) -> DataFrame:
    """Measurements of all cells as rows, keys cleaned."""
    cells = table(spark, folder, "cells").select("cell_id", *_keys(), *FEATURES)
    return long_form(cells, ["plate", "well", "perturbation"], FEATURES)


def profiles_long(spark: SparkSession, folder: str) -> DataFrame:
    return P.profile(cells_long(spark, folder).filter("plate is not null and perturbation is not null"), ["plate", "perturbation"])


def _rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    return df.withColumn("value", F.round("value", digits))


def profile_median_by_strata(spark, folder):
    return _rounded(profiles_long(spark, folder))


def mad_robustize_controls(spark, folder):
    return _rounded(P.mad_robustize(cut(profiles_long(spark, folder)), f"perturbation = '{CONTROL}'"))


def robust_z_mean_controls(spark, folder):
    return _rounded(P.robust_z(cut(profiles_long(spark, folder)), f"perturbation = '{CONTROL}'"))


def standard_scaled(spark, folder):
    return _rounded(P.standardise(cut(profiles_long(spark, folder))))


def outlier_mask_counts(spark, folder):
    scored = P.outlier_scores(cells_long(spark, folder))
    return scored.groupBy("feature").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.abs("score") > 5).alias("n_outliers"))


def outlier_report_top20(spark, folder):
    return P.outlier_report(cells_long(spark, folder).filter("plate is not null and well is not null"), ["plate", "well"])


def winsorize_bounds(spark, folder):
    found = quantiles(cells_long(spark, folder), ["feature"], "value", {"lo": 0.05, "hi": 0.95})
    return found.withColumn("lo", F.round("lo", 9)).withColumn("hi", F.round("hi", 9))


def winsorized_means(spark, folder):
    return P.winsorised(cells_long(spark, folder)).groupBy("feature").agg(F.round(F.avg("value"), 6).alias("mean"), F.round(F.min("value"), 6).alias("lo"), F.round(F.max("value"), 6).alias("hi"))


def variance_threshold(spark, folder):
    return P.low_variance(cells_long(spark, folder))


def feature_correlations(spark, folder):
    return P.rank_correlations(table(spark, folder, "cells"), FEATURES).withColumn("r", F.round("r", 6))


def correlation_threshold(spark, folder):
    """Selected features after dropping one of each strongly correlated pair, with their distinct values."""
    cells = table(spark, folder, "cells")
    gone = P.drop_correlated(P.rank_correlations(cells, FEATURES), 0.5)
    kept = [f for f in FEATURES if f not in gone]
    return long_form(cells, [], kept).groupBy("feature").agg(F.count(F.lit(1)).alias("n"))


def profile_vectors(spark, folder):
    """Normalised profiles as arrays, the form in which similarities are computed."""
    scaled = P.mad_robustize(cut(profiles_long(spark, folder)), f"perturbation = '{CONTROL}'")
    return P.to_vectors(scaled, ["plate", "perturbation"], FEATURES).select("plate", "perturbation", F.transform("features", lambda v: F.round(v, 6)).alias("features"))


def object_join_prefixed(spark, folder):
    """Cells with cytoplasm and nuclei of the same object on five keys, shared names prefixed, counted per plate."""
    keys = ["ImageNumber", "ObjectNumber", "Metadata_Field", "Metadata_Plate", "Metadata_Well"]
    cells = table(spark, folder, "cells")
    part = lambda prefix, names: cells.select(*keys, *[F.col(n).alias(f"{prefix}_{n}") for n in names])
    joined = part("cells", FEATURES[:2]).join(part("cyto", FEATURES[2:5]), keys).join(part("nuclei", FEATURES[5:]), keys)
    number = lambda c: F.nanvl(F.col(c), F.lit(None).cast("double"))
    return joined.groupBy(plate_number(F.col("Metadata_Plate")).alias("plate")).agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg(number("cells_AreaShape_Area")), 4).alias("mean_area"),
        F.round(F.avg(number("cyto_Intensity_MedianIntensity_ER")), 6).alias("mean_er"), F.round(F.avg(number("nuclei_Intensity_MedianIntensity_Mito")), 6).alias("mean_mito"))


def platemap_left_join(spark, folder):
    """Sites per perturbation by the wells' first current platemap row; sites of unknown wells under null."""
    plates = table(spark, folder, "platemap").filter("deleted_at is null").select(*_keys(), "platemap_id").filter("plate is not null and well is not null")
    current = plates.groupBy("plate", "well").agg(F.min_by("perturbation", "platemap_id").alias("perturbation"))
    sites = table(spark, folder, "image_qc").select(*_keys()[:2])
    return sites.join(current, ["plate", "well"], "left").groupBy("perturbation").agg(F.count(F.lit(1)).alias("n_sites"))


def _images(spark, folder):
    """Image names of all manifest lines, read without parsing the JSON."""
    text = lambda key: F.nullif(F.regexp_extract("record", f'"{key}": ?"([^"]*)"', 1), F.lit(""))
    return table(spark, folder, "manifest_files").select("raw_id", text("Image_FileName").alias("file"), text("Image_PathName").alias("path")).filter("file is not null")


def filename_parse(spark, folder):
    """Row, column, field, plane and channel from image names of plane 2, with well label, channel name and derived names."""
    part = lambda p: image_name_part(F.col("file"), p)
    images = _images(spark, folder).select("raw_id", "file", plate_from_path(F.col("path")).alias("plate"), *[part(p).alias(p) for p in ("row", "column", "field", "plane", "channel")])
    return images.filter("plane = 2").select(
        "raw_id", "plate", well_label(F.col("row"), F.col("column")).alias("well"), "field", "channel", channel_name(F.col("channel")).alias("channel_name"),
        mask_name(F.lit(None).cast("string"), F.col("file")).alias("mask"), F.concat(F.lit("Illum_"), channel_name(F.col("channel")), F.lit(".npy")).alias("illum"))


def pivot_channels(spark, folder):
    """The wide manifest: one row per plate, well and field, the first file of every channel in its column."""
    part = lambda p: image_name_part(F.col("file"), p)
    images = _images(spark, folder).select("file", plate_from_path(F.col("path")).alias("plate"), well_label(part("row"), part("column")).alias("well"), part("field").alias("field"), part("channel").alias("channel"), part("plane").alias("plane"))
    wide = images.filter("plane = 2 and plate is not null").groupBy("plate", "well", "field").pivot("channel", list(range(1, 7))).agg(F.min("file"))
    return wide.select("plate", "well", "field", *[F.col(str(i)).alias(f"file_{i}") for i in range(1, 7)])


def plate_names(spark, folder):
    """Every spelling of a plate with its plain forms and the number of its platemap rows."""
    p = F.col("Metadata_Plate")
    return table(spark, folder, "platemap").filter(p.isNotNull()).groupBy(p.alias("spelling")).agg(F.count(F.lit(1)).alias("n")).select(
        "spelling", plate_text(F.upper("spelling")).alias("plain"), safe_name(F.trim("spelling")).alias("safe"), "n")


def diagonal_union(spark, folder):
    """Two tables of different columns under each other by name, counted by where values are missing."""
    a = table(spark, folder, "customer").select(F.col("c_custkey").alias("key"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment"))
    b = table(spark, folder, "supplier").select(F.col("s_suppkey").alias("key"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance"))
    return a.unionByName(b, allowMissingColumns=True)


def replicate_numbers(spark, folder):
    """Replicates of each perturbation on a plate numbered in the order of their wells."""
    from pyspark.sql.window import Window

    rows = table(spark, folder, "platemap").select("platemap_id", *_keys()).filter("plate is not null and well is not null and perturbation is not null")
    return rows.withColumn("replicate", F.row_number().over(Window.partitionBy("plate", "perturbation").orderBy("well", "platemap_id")))


def plate_design(spark, folder):
    """A layout for all registered perturbations that are no references."""
    compounds = table(spark, folder, "perturbations").filter("not coalesce(Metadata_Reference, false)").select(perturbation_key(F.col("Metadata_Perturbation")).alias("c")).filter(F.col("c") != CONTROL)
    return plate_layout(compounds, "c", Layout())


def design_platemap(spark, folder):
    return as_platemap(plate_design(spark, folder)).groupBy("Metadata_Plate", "well_type").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("Metadata_Perturbation").alias("n_perturbations"))


QUERIES = {f.__name__: f for f in (
    mad_robustize_controls, profile_median_by_strata, robust_z_mean_controls, standard_scaled, outlier_mask_counts, outlier_report_top20, winsorize_bounds, winsorized_means,
    variance_threshold, feature_correlations, correlation_threshold, profile_vectors, object_join_prefixed, platemap_left_join, filename_parse, pivot_channels, plate_names,
    diagonal_union, replicate_numbers, plate_design, design_platemap)}

PLATE = "TRY_CAST(NULLIF(regexp_extract(upper(trim(Metadata_Plate)), '^P?0*([0-9]{1,18})$', 1), '') AS BIGINT)"
WELL = "NULLIF(regexp_extract(upper(trim(Metadata_Well)), '^[A-H](0[1-9]|1[0-2])$', 0), '')"
_LONG = f"""keyed AS (SELECT {PLATE} AS plate, {WELL} AS well, upper(trim(Metadata_Perturbation)) AS perturbation, {', '.join(FEATURES)} FROM cells),
long AS (SELECT * FROM (UNPIVOT keyed ON {', '.join(FEATURES)} INTO NAME feature VALUE value) WHERE NOT isnan(value))"""
_PROFILES = f"""{_LONG}, prof AS (SELECT plate, perturbation, feature, median(value) AS value FROM long WHERE plate IS NOT NULL AND perturbation IS NOT NULL GROUP BY ALL)"""
_SD = "coalesce(nullif(stddev_pop(value), 0), 1)"
_FILE = """images AS (SELECT raw_id, NULLIF(regexp_extract(record, '"Image_FileName": ?"([^"]*)"', 1), '') AS file, NULLIF(regexp_extract(NULLIF(regexp_extract(record, '"Image_PathName": ?"([^"]*)"', 1), ''), '_P([0-9]+)', 1), '') AS plate FROM manifest_files),
parsed AS (SELECT *, regexp_extract(file, '^\\d(\\d{2})\\d(\\d{2})-(\\d)-\\d{3}(\\d{3})(\\d{3})\\.tif', ['r', 'c', 'f', 'p', 'ch']) AS m FROM images WHERE file IS NOT NULL),
named AS (SELECT raw_id, file, plate, chr(64 + m.r::INT) || m.c AS well, m.f::INT AS field, m.ch::INT AS channel FROM parsed WHERE m.p = '002')"""
_CHANNEL = "CASE channel WHEN 1 THEN 'Mito' WHEN 2 THEN 'Golgi' WHEN 3 THEN 'Brightfield' WHEN 4 THEN 'Syto' WHEN 5 THEN 'ER' WHEN 6 THEN 'Hoechst' ELSE channel::VARCHAR END"
_OUTLIERS = f"""{_LONG}, med AS (SELECT feature, median(value) AS m FROM long GROUP BY 1), mad AS (SELECT feature, m, median(abs(value - m)) AS d FROM long JOIN med USING (feature) GROUP BY 1, 2),
scored AS (SELECT l.*, (value - m) / (d + 1e-8) AS score FROM long l JOIN mad USING (feature))"""

_DESIGN = """WITH names AS (SELECT label, row_number() OVER (ORDER BY label) - 1 AS k FROM (SELECT DISTINCT upper(trim(Metadata_Perturbation)) AS label FROM perturbations WHERE NOT coalesce(Metadata_Reference, false) AND upper(trim(Metadata_Perturbation)) <> 'DMSO')),
plates AS (SELECT unnest(range(1, (SELECT (count(*) + 39) // 40 + 1 FROM names))) AS plate),
grid AS (SELECT plate::INT AS plate, ix, (ix // 12 + 1)::INT AS "row", (ix % 12 + 1)::INT AS "column" FROM plates, (SELECT unnest(range(96)) AS ix)),
wells AS (SELECT *, chr(64 + "row") || lpad("column"::VARCHAR, 2, '0') AS well, row_number() OVER (PARTITION BY plate ORDER BY CASE WHEN "row" IN (1, 8) OR "column" IN (1, 12) THEN 0 ELSE 1 END, md5('1:' || plate || ':' || ix), ix) - 1 AS place FROM grid),
free AS (SELECT *, row_number() OVER (PARTITION BY plate ORDER BY md5('1:slot:' || plate || ':' || ix), ix) - 1 AS slot FROM wells WHERE place >= 15),
placed AS (SELECT (k // 40 + 1)::INT AS plate, r AS replicate, (k % 40) * 2 + r - 1 AS slot, label FROM names, (SELECT unnest([1, 2]) AS r))
SELECT plate, well, "row", "column", CASE WHEN label IS NULL THEN 'empty' ELSE 'cmpd' END AS type, label, replicate FROM free LEFT JOIN placed USING (plate, slot)
UNION ALL SELECT plate, well, "row", "column", 'neg', 'DMSO', place + 1 FROM wells WHERE place < 10
UNION ALL SELECT plate, well, "row", "column", CASE WHEN place < 14 THEN 'pos' ELSE 'empty' END, CASE WHEN place < 14 THEN 'PC_' || ((place - 10) // 2 + 1) END, CASE WHEN place < 14 THEN (place - 10) % 2 + 1 END FROM wells WHERE place BETWEEN 10 AND 14"""

ORACLES = {
    "profile_median_by_strata": f"WITH {_PROFILES} SELECT plate, perturbation, feature, round(value, 6) AS value FROM prof",
    "mad_robustize_controls": f"""WITH {_PROFILES}, med AS (SELECT feature, median(value) AS m FROM prof WHERE perturbation = '{CONTROL}' GROUP BY 1),
mad AS (SELECT feature, m, median(abs(value - m)) AS d FROM prof JOIN med USING (feature) WHERE perturbation = '{CONTROL}' GROUP BY 1, 2)
SELECT plate, perturbation, feature, round((value - m) / (d * 1.4826 + 1e-18), 6) AS value FROM prof JOIN mad USING (feature)""",
    "robust_z_mean_controls": f"""WITH {_PROFILES}, a AS (SELECT feature, avg(value) AS m, count(*) AS n FROM prof WHERE perturbation = '{CONTROL}' GROUP BY 1),
b AS (SELECT feature, m, n, median(abs(value - m)) AS d FROM prof JOIN a USING (feature) WHERE perturbation = '{CONTROL}' GROUP BY 1, 2, 3),
s AS (SELECT feature, avg(value) AS mean, {_SD} AS sd FROM prof GROUP BY 1)
SELECT plate, perturbation, feature, round(CASE WHEN n >= 2 THEN 0.6745 * (value - m) / CASE WHEN d > 1e-8 THEN d ELSE exp(-d) END ELSE (value - mean) / sd END, 6) AS value FROM prof JOIN s USING (feature) LEFT JOIN b USING (feature)""",
    "standard_scaled": f"WITH {_PROFILES}, s AS (SELECT feature, avg(value) AS mean, {_SD} AS sd FROM prof GROUP BY 1) SELECT plate, perturbation, feature, round((value - mean) / sd, 6) AS value FROM prof JOIN s USING (feature)",
    "outlier_mask_counts": f"WITH {_OUTLIERS} SELECT feature, count(*) AS n, count(*) FILTER (abs(score) > 5) AS n_outliers FROM scored GROUP BY 1",
    "outlier_report_top20": f"""WITH {_OUTLIERS} SELECT plate, well, count(*) AS n_outliers, round(avg(abs(score)), 6) AS mean_score, round(max(abs(score)), 6) AS max_score FROM
(SELECT s.* FROM (SELECT l.plate, l.well, l.feature, (value - m) / (d + 1e-8) AS score FROM (SELECT * FROM long WHERE plate IS NOT NULL AND well IS NOT NULL) l JOIN
(SELECT feature, m, median(abs(value - m)) AS d FROM (SELECT * FROM long WHERE plate IS NOT NULL AND well IS NOT NULL) JOIN (SELECT feature, median(value) AS m FROM long WHERE plate IS NOT NULL AND well IS NOT NULL GROUP BY 1) USING (feature) GROUP BY 1, 2) USING (feature)) s WHERE abs(score) > 5)
GROUP BY 1, 2 ORDER BY n_outliers DESC, plate, well LIMIT 20""",
    "winsorize_bounds": f"WITH {_LONG} SELECT feature, count(*) AS n, round(quantile_cont(value, 0.05), 9) AS lo, round(quantile_cont(value, 0.95), 9) AS hi FROM long GROUP BY 1",
    "winsorized_means": f"WITH {_LONG}, q AS (SELECT feature, quantile_cont(value, 0.05) AS a, quantile_cont(value, 0.95) AS b FROM long GROUP BY 1) SELECT feature, round(avg(greatest(least(value, b), a)), 6) AS mean, round(min(greatest(least(value, b), a)), 6) AS lo, round(max(greatest(least(value, b), a)), 6) AS hi FROM long JOIN q USING (feature) GROUP BY 1",
    "variance_threshold": f"""WITH {_LONG}, c AS (SELECT feature, value, count(*) AS n FROM long GROUP BY ALL), r AS (SELECT *, row_number() OVER (PARTITION BY feature ORDER BY n DESC, value) AS k FROM c),
t AS (SELECT feature, coalesce(max(n) FILTER (k = 2), 0) / max(n) FILTER (k = 1) AS freq_ratio, count(*) / sum(n) AS unique_ratio FROM r GROUP BY 1)
SELECT feature, round(freq_ratio, 6) AS freq_ratio, round(unique_ratio, 6) AS unique_ratio, freq_ratio >= 0.05 AND unique_ratio >= 0.01 AS keep FROM t""",
    "feature_correlations": "WITH w AS (SELECT row_number() OVER () AS i, * FROM (SELECT " + ", ".join(FEATURES) + " FROM cells) WHERE " + " AND ".join(f"{f} IS NOT NULL AND NOT isnan({f})" for f in FEATURES) + "), "
    + "r AS (SELECT " + ", ".join(f"(rank() OVER (ORDER BY {f}) + (count(*) OVER (PARTITION BY {f}) - 1) / 2.0)::DOUBLE AS r{i}" for i, f in enumerate(FEATURES)) + " FROM w) "
    + " UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, round(corr(r{i}, r{j}), 6) AS r FROM r" for i, a in enumerate(FEATURES) for j, b in enumerate(FEATURES) if i < j),
    "profile_vectors": f"""WITH {_PROFILES}, med AS (SELECT feature, median(value) AS m FROM prof WHERE perturbation = '{CONTROL}' GROUP BY 1),
mad AS (SELECT feature, m, median(abs(value - m)) AS d FROM prof JOIN med USING (feature) WHERE perturbation = '{CONTROL}' GROUP BY 1, 2),
z AS (SELECT plate, perturbation, feature, round((value - m) / (d * 1.4826 + 1e-18), 6) AS value FROM prof JOIN mad USING (feature))
SELECT plate, perturbation, [{', '.join(f"max(value) FILTER (feature = '{f}')" for f in FEATURES)}] AS features FROM z GROUP BY 1, 2""",
    "object_join_prefixed": f"""WITH k AS (SELECT *, {PLATE} AS plate FROM cells) SELECT a.plate, count(*) AS n, round(avg(CASE WHEN isnan(a.AreaShape_Area) THEN NULL ELSE a.AreaShape_Area END), 4) AS mean_area,
round(avg(CASE WHEN isnan(b.Intensity_MedianIntensity_ER) THEN NULL ELSE b.Intensity_MedianIntensity_ER END), 6) AS mean_er, round(avg(CASE WHEN isnan(c.Intensity_MedianIntensity_Mito) THEN NULL ELSE c.Intensity_MedianIntensity_Mito END), 6) AS mean_mito
FROM k a JOIN k b USING (ImageNumber, ObjectNumber, Metadata_Field, Metadata_Plate, Metadata_Well) JOIN k c USING (ImageNumber, ObjectNumber, Metadata_Field, Metadata_Plate, Metadata_Well) GROUP BY 1""",
    "platemap_left_join": f"""WITH p AS (SELECT {PLATE} AS plate, {WELL} AS well, upper(trim(Metadata_Perturbation)) AS perturbation, platemap_id FROM platemap WHERE deleted_at IS NULL),
c AS (SELECT plate, well, arg_min(perturbation, platemap_id) FILTER (perturbation IS NOT NULL) AS perturbation FROM p WHERE plate IS NOT NULL AND well IS NOT NULL GROUP BY 1, 2),
s AS (SELECT {PLATE} AS plate, {WELL} AS well FROM image_qc) SELECT perturbation, count(*) AS n_sites FROM s LEFT JOIN c USING (plate, well) GROUP BY 1""",
    "filename_parse": f"WITH {_FILE} SELECT raw_id, plate, well, field, channel, {_CHANNEL} AS channel_name, regexp_replace(file, '\\.tiff?$', '.png') AS mask, 'Illum_' || {_CHANNEL} || '.npy' AS illum FROM named",
    "pivot_channels": f"WITH {_FILE} SELECT plate, well, field, " + ", ".join(f"min(file) FILTER (channel = {i}) AS file_{i}" for i in range(1, 7)) + " FROM named WHERE plate IS NOT NULL GROUP BY 1, 2, 3",
    "plate_names": "SELECT Metadata_Plate AS spelling, coalesce(nullif(regexp_replace(trim(upper(Metadata_Plate)), '^P*0*', ''), ''), '0') AS plain, regexp_replace(trim(Metadata_Plate), '[^a-zA-Z0-9_\\-]', '_', 'g') AS safe, count(*) AS n FROM platemap WHERE Metadata_Plate IS NOT NULL GROUP BY 1",
    "diagonal_union": "SELECT c_custkey AS key, c_name AS name, c_acctbal AS balance, c_mktsegment AS segment FROM customer UNION ALL BY NAME SELECT s_suppkey AS key, s_name AS name, s_acctbal AS balance FROM supplier",
    "replicate_numbers": f"""WITH p AS (SELECT platemap_id, {PLATE} AS plate, {WELL} AS well, upper(trim(Metadata_Perturbation)) AS perturbation FROM platemap)
SELECT *, row_number() OVER (PARTITION BY plate, perturbation ORDER BY well, platemap_id) AS replicate FROM p WHERE plate IS NOT NULL AND well IS NOT NULL AND perturbation IS NOT NULL""",
    "plate_design": _DESIGN,
    "design_platemap": f"""WITH d AS ({_DESIGN}) SELECT 'P' || lpad(plate::VARCHAR, 2, '0') AS Metadata_Plate, type AS well_type, count(*) AS n, count(DISTINCT label) AS n_perturbations FROM d WHERE type <> 'empty' GROUP BY 1, 2""",
}
