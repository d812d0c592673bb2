"""Queries over imaging sites: thresholds, flags, scores, positional effects, distributions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wellspring.functions.keys import plate_number, well_name
from wellspring.operators import qc as Q
from wellspring.operators.stats import clip, half_away, long_form, medians
from wellspring.plans.objects import PLATE, WELL
from wellspring.plans.tables import table
from wellspring.session import cut

METRICS = ["PowerLogLogSlope", "MedianIntensity", "FocusScore"]
COUNTS = ["Count_Raw_nuclei", "Count_Nuclei", "Count_Cells", "Count_Illum_artifacts"]
COLUMNS = [f"ImageQuality_{m}_{c}" for m in METRICS for c in Q.CHANNELS]


def _sites(spark, folder) -> DataFrame:
    return table(spark, folder, "image_qc").select("qc_id", "ImageNumber", plate_number(F.col("Metadata_Plate")).alias("plate"), well_name(F.col("Metadata_Well")).alias("well"), *COUNTS, *COLUMNS).filter("plate is not null and well is not null")


def _readings(spark, folder, keys=("qc_id", "plate", "well")) -> DataFrame:
    long = Q.readings(_sites(spark, folder), list(keys), METRICS)
    return long.withColumn("value", F.when(F.abs("value") < float("inf"), F.col("value")))


def _wells(spark, folder) -> DataFrame:
    """Mean reading per plate and well."""
    return _readings(spark, folder).groupBy("plate", "well", "metric", "channel").agg(F.round(F.avg("value"), 9).alias("value"))


def qc_aggregate(spark, folder):
    """Means of readings and sums of counts per plate and well in one aggregation; a sum of nothing is 0.

    Readings are added in the order of their ids, row by row and without partial
    sums: means of few readings often lie half way between two results, where the
    last bit of the sum decides.
    """
    number = lambda c: F.nanvl(F.col(c), F.lit(None).cast("double"))
    finite = lambda c: F.when(F.abs(number(c)) < float("inf"), number(c))
    sites = _sites(spark, folder).repartition("plate", "well").sortWithinPartitions("plate", "well", "qc_id")
    return sites.groupBy("plate", "well").agg(*[half_away(F.avg(finite(c)), 6).alias(c) for c in COLUMNS], *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in COUNTS])


def qc_verdicts(spark, folder):
    """Tri-state verdict counts per metric and channel."""
    judged = Q.absolute_pass(_readings(spark, folder))
    return judged.groupBy("metric", "channel").agg(F.count_if("passes").alias("n_pass"), F.count_if(~F.col("passes")).alias("n_fail"), F.count_if(F.col("passes").isNull()).alias("n_none"))


def qc_adaptive_bounds(spark, folder):
    found = Q.adaptive_bounds(_readings(spark, folder), ["plate", "metric", "channel"])
    return found.withColumn("lo", F.round("lo", 6)).withColumn("hi", F.round("hi", 6))


def qc_adaptive_verdicts(spark, folder):
    """Sites failing the absolute test alone, and failing either test."""
    keys = ["plate", "metric", "channel"]
    long = cut(_readings(spark, folder))
    bounds = Q.adaptive_bounds(long, keys)
    either = Q.verdicts(long, bounds, keys, independent=True)
    return either.groupBy("plate").agg(F.count_if(~F.col("passes")).alias("n_fail_either"), F.count_if(~F.col("adaptive_ok")).alias("n_outside_band"))


def qc_pass_rate(spark, folder):
    """Per plate: share of wells whose readings all pass, with its badge."""
    wells = Q.group_pass(Q.absolute_pass(_readings(spark, folder)), ["plate", "well"])
    rate = lambda c: F.round(F.avg(F.col(c).cast("int")) * 100, 4)
    out = wells.groupBy("plate").agg(F.count(F.lit(1)).alias("n_wells"), rate("all_pass").alias("pass_rate"), rate("illum_pass").alias("illum_rate"), rate("focus_pass").alias("focus_rate"))
    return out.withColumn("badge", Q.badge(F.col("focus_rate")))


def qc_flags(spark, folder):
    return Q.flags(Q.absolute_pass(_readings(spark, folder)), ["plate", "well"])


def qc_borders(spark, folder):
    return Q.border(Q.absolute_pass(_readings(spark, folder)), ["qc_id"])


def qc_red_wells(spark, folder):
    """Wells per plate whose mean slope leaves the narrow band in any channel."""
    red = Q.red_wells(_wells(spark, folder), ["plate", "well"])
    return red.groupBy("plate").agg(F.count_if("red").alias("n_red"), F.count(F.lit(1)).alias("n_wells"))


def mad_scores_plate_cohort(spark, folder):
    """Wells' scores in MADs within their plate and within the cohort."""
    wells = cut(_wells(spark, folder))
    both = Q.mad_scores(wells, ["plate"]).withColumnRenamed("score", "plate_score")
    return Q.mad_scores(both, []).withColumnRenamed("score", "cohort_score")


def qc_red_scores(spark, folder):
    scored = Q.mad_scores(cut(_wells(spark, folder)), [])
    red = scored.groupBy("plate", "well").agg(F.bool_or(F.abs("score") > 3).alias("red"))
    return red.groupBy("plate").agg(F.count_if("red").alias("n_red"))


def cohort_range_p2_p98(spark, folder):
    found = Q.cohort_range(_readings(spark, folder).filter("value is not null"), ["metric", "channel"])
    return found.withColumn("lo", F.round("lo", 9)).withColumn("hi", F.round("hi", 9))


MFI = {"Syto": "Intensity_MedianIntensity_Syto", "ER": "Intensity_MedianIntensity_ER", "Golgi": "Intensity_MedianIntensity_Golgi", "Mito": "Intensity_MedianIntensity_Mito"}


def _intensities(spark, folder) -> DataFrame:
    cells = table(spark, folder, "cells").select("ImageNumber", plate_number(F.col("Metadata_Plate")).alias("plate"), well_name(F.col("Metadata_Well")).alias("well"), *[F.col(c).alias(n) for n, c in MFI.items()])
    return long_form(cells.filter("plate is not null and well is not null"), ["plate", "well", "ImageNumber"], list(MFI)).withColumnRenamed("feature", "channel")


def per_image_median_list(spark, folder):
    """Per plate, well and channel the sorted medians of its images (a well has a few)."""
    images = medians(_intensities(spark, folder), ["plate", "well", "ImageNumber", "channel"], "value", "m")
    return images.groupBy("plate", "well", "channel").agg(F.sort_array(F.collect_list("m")).alias("medians"))


def well_medians(spark, folder):
    return medians(_intensities(spark, folder), ["plate", "well", "channel"], "value", "median")


def eta_squared_position(spark, folder):
    """Share of variance between plate rows and between plate columns, with its verdict against the Hoechst channel."""
    long = _readings(spark, folder).filter("metric = 'MedianIntensity'").withColumn("row", F.substring("well", 1, 1)).withColumn("column", F.substring("well", 2, 2))
    long = cut(long.select("plate", "channel", "row", "column", "value"))
    keys = ["plate", "channel"]
    both = Q.eta_squared(long, keys, "row").withColumnRenamed("eta2", "eta2_row").join(Q.eta_squared(long, keys, "column").withColumnRenamed("eta2", "eta2_column"), keys)
    base = both.filter("channel = 'Hoechst'").select("plate", F.col("eta2_row").alias("base_row"))
    out = both.join(base, "plate", "left").withColumn("verdict_row", Q.position_verdict(F.col("eta2_row"), F.col("base_row"), F.col("channel") == "Hoechst"))
    return out.select("plate", "channel", F.round("eta2_row", 6).alias("eta2_row"), F.round("eta2_column", 6).alias("eta2_column"), "verdict_row")


def box_stats(spark, folder):
    found = Q.box_stats(cut(_readings(spark, folder).filter("value is not null")), ["metric", "channel"])
    return found.select("metric", "channel", "n", *[F.round(c, 9).alias(c) for c in ("q1", "med", "q3", "whisker_low", "whisker_high")])


def reading_histogram(spark, folder):
    return Q.histogram(cut(_readings(spark, folder).filter("value is not null")), ["metric", "channel"])


def radius_range(spark, folder):
    cells = table(spark, folder, "cells").select(plate_number(F.col("Metadata_Plate")).alias("plate"), "AreaShape_MedianRadius").filter("plate is not null")
    return Q.floor_percentiles(long_form(cells, ["plate"], ["AreaShape_MedianRadius"]), ["plate"], {"p2": 0.02, "p98": 0.98})


def metric_summary(spark, folder):
    """Mean, population deviation, range and pass share per metric and channel."""
    judged = Q.absolute_pass(_readings(spark, folder))
    r = lambda c: F.round(c, 6)
    return judged.groupBy("metric", "channel").agg(r(F.avg("value")).alias("mean"), r(F.stddev_pop("value")).alias("sd"), F.min("value").alias("lo"), F.max("value").alias("hi"), r(F.avg(F.col("passes").cast("int"))).alias("pass_share"))


def snr_proxy(spark, folder):
    """Object against image median intensity per plate and channel."""
    objects = _intensities(spark, folder).select("plate", "channel", "value")
    images = _readings(spark, folder).filter("metric = 'MedianIntensity' and value is not null").select("plate", "channel", "value")
    return Q.signal_to_background(objects, images, ["plate"]).withColumn("snr", F.round("snr", 6))


def cell_counts(spark, folder):
    """Cells per nucleus (capped and not), low counts and artifact density per plate and well."""
    wells = _sites(spark, folder).groupBy("plate", "well").agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in COUNTS], F.count(F.lit(1)).alias("n_sites"))
    ratio = F.try_divide("Count_Cells", F.nullif(F.col("Count_Nuclei"), F.lit(0)))
    density = Q.artifact_density(F.col("Count_Illum_artifacts"), F.col("n_sites") * 1_166_400)
    colour = F.when(density > 0.05, "red").when(density > 0.02, "orange").otherwise("green")
    return wells.select("plate", "well", F.round(ratio, 6).alias("ratio"), F.round(clip(ratio, 0.0, 1.0), 6).alias("ratio_capped"), (F.col("Count_Cells") < 700).alias("few_cells"), F.round(density, 9).alias("density"), colour.alias("density_colour"))


def object_filter(spark, folder):
    """Cells within the limits of those object columns that the table has, per plate."""
    cells = table(spark, folder, "cells")
    ok = Q.within(Q.OBJECT_LIMITS, cells.columns)
    return cells.groupBy(plate_number(F.col("Metadata_Plate")).alias("plate")).agg(F.count_if(ok).alias("n_kept"), F.count(F.lit(1)).alias("n"))


QUERIES = {f.__name__: f for f in (
    qc_aggregate, qc_verdicts, qc_adaptive_bounds, qc_adaptive_verdicts, qc_pass_rate, qc_flags, qc_borders, qc_red_wells, mad_scores_plate_cohort, qc_red_scores, cohort_range_p2_p98,
    per_image_median_list, well_medians, eta_squared_position, box_stats, reading_histogram, radius_range, metric_summary, snr_proxy, cell_counts, object_filter)}

_SITES = f"sites AS (SELECT qc_id, {PLATE} AS plate, {WELL} AS well, {', '.join(COUNTS)}, {', '.join(COLUMNS)} FROM image_qc WHERE {PLATE} IS NOT NULL AND {WELL} IS NOT NULL)"
_CELLS = ", ".join(f"{{'metric': '{m}', 'channel': '{c}', 'v': ImageQuality_{m}_{c}}}" for m in METRICS for c in Q.CHANNELS)
_READ = f"""{_SITES}, u AS (SELECT qc_id, plate, well, unnest([{_CELLS}]) AS u FROM sites),
r AS (SELECT qc_id, plate, well, u.metric AS metric, u.channel AS channel, CASE WHEN isfinite(u.v) THEN u.v END AS value FROM u)"""
_FAIL = """(metric = 'PowerLogLogSlope' AND (value < -2.5 OR value > -1.0) OR metric = 'MedianIntensity' AND value > 0.95 OR metric = 'FocusScore' AND
value < CASE channel WHEN 'Hoechst' THEN 0.80 WHEN 'Syto' THEN 0.05 WHEN 'Golgi' THEN 0.03 WHEN 'ER' THEN 0.08 WHEN 'Mito' THEN 0.005 ELSE 0.001 END)"""
_JUDGED = f"{_READ}, j AS (SELECT *, CASE WHEN value IS NOT NULL THEN NOT {_FAIL} END AS passes FROM r)"
_WELLS = f"{_READ}, w AS (SELECT plate, well, metric, channel, round(avg(value), 9) AS value FROM r GROUP BY plate, well, metric, channel)"
_ADAPT = f"""{_JUDGED}, med AS (SELECT plate, metric, channel, median(value) AS m, count(value) AS n FROM r GROUP BY ALL),
band AS (SELECT r.plate, r.metric, r.channel, m, n, median(abs(value - m)) / 0.6744897501960817 * 3 AS width FROM r JOIN med USING (plate, metric, channel) GROUP BY ALL HAVING n >= 5)"""
_INT = f"""k AS (SELECT ImageNumber, {PLATE} AS plate, {WELL} AS well, {', '.join(f'{c} AS {n}' for n, c in MFI.items())} FROM cells),
i AS (SELECT * FROM (UNPIVOT (SELECT * FROM k WHERE plate IS NOT NULL AND well IS NOT NULL) ON {', '.join(MFI)} INTO NAME channel VALUE value) WHERE NOT isnan(value))"""
_SCORE = """SELECT w.*, round((value - m) / coalesce(nullif(d, 0), 1), 2) + 0.0 AS score FROM w LEFT JOIN (SELECT {k} m, n, median(abs(value - m)) AS d FROM w JOIN (SELECT {k} median(value) AS m, count(value) AS n FROM w GROUP BY {g}) USING ({g}) GROUP BY ALL HAVING n >= 4) s USING ({g})"""
_PSCORE, _CSCORE = _SCORE.format(k="plate, metric, channel,", g="plate, metric, channel"), _SCORE.format(k="metric, channel,", g="metric, channel")


def _eta(by: str) -> str:
    return f"""SELECT plate, channel, CASE WHEN sum(n) >= 2 AND sum(q) - sum(s) * sum(s) / sum(n) > 1e-12 * sum(q) THEN greatest(0, (sum(s * s / n) - sum(s) * sum(s) / sum(n)) / (sum(q) - sum(s) * sum(s) / sum(n))) END AS eta
FROM (SELECT plate, channel, {by} AS g, count(value) AS n, sum(value) AS s, sum(value * value) AS q FROM r WHERE metric = 'MedianIntensity' AND value IS NOT NULL GROUP BY ALL) GROUP BY 1, 2"""


ORACLES = {
    "qc_aggregate": f"WITH {_SITES} SELECT plate, well, " + ", ".join(f"round(avg(CASE WHEN isfinite({c}) THEN {c} END), 6) AS {c}" for c in COLUMNS) + ", " + ", ".join(f"coalesce(sum({c}), 0)::BIGINT AS {c}" for c in COUNTS) + " FROM sites GROUP BY 1, 2",
    "qc_verdicts": f"WITH {_JUDGED} SELECT metric, channel, count(*) FILTER (passes) AS n_pass, count(*) FILTER (NOT passes) AS n_fail, count(*) FILTER (passes IS NULL) AS n_none FROM j GROUP BY 1, 2",
    "qc_adaptive_bounds": f"WITH {_ADAPT} SELECT plate, metric, channel, n, round(m - width, 6) AS lo, round(m + width, 6) AS hi FROM band",
    "qc_adaptive_verdicts": f"""WITH {_ADAPT}, o AS (SELECT j.*, coalesce(value < m - width OR value > m + width, false) AS outside FROM j LEFT JOIN band USING (plate, metric, channel))
SELECT plate, count(*) FILTER (value IS NOT NULL AND (NOT passes OR outside)) AS n_fail_either, count(*) FILTER (outside) AS n_outside_band FROM o GROUP BY 1""",
    "qc_pass_rate": f"""WITH {_JUDGED}, w AS (SELECT plate, well, bool_and(coalesce(passes, true)) AS a, bool_and(coalesce(passes, true)) FILTER (metric <> 'FocusScore') AS i, bool_and(coalesce(passes, true)) FILTER (metric = 'FocusScore') AS f FROM j GROUP BY 1, 2),
p AS (SELECT plate, count(*) AS n_wells, round(avg(a::INT) * 100, 4) AS pass_rate, round(avg(i::INT) * 100, 4) AS illum_rate, round(avg(f::INT) * 100, 4) AS focus_rate FROM w GROUP BY 1)
SELECT *, CASE WHEN focus_rate >= 80 THEN 'pass' WHEN focus_rate >= 50 THEN 'warn' ELSE 'fail' END AS badge FROM p""",
    "qc_flags": f"WITH {_JUDGED} SELECT plate, well, coalesce(list_sort(list_distinct(list(metric || '/' || channel) FILTER (NOT passes))), []) AS failed FROM j GROUP BY 1, 2",
    "qc_borders": f"""WITH {_JUDGED} SELECT qc_id, CASE WHEN count(passes) = 0 THEN 'grey' WHEN count(*) FILTER (passes) = count(passes) THEN 'green' WHEN count(*) FILTER (passes) = 0 THEN 'red' ELSE 'orange' END AS border FROM j WHERE metric = 'PowerLogLogSlope' GROUP BY 1""",
    "qc_red_wells": f"WITH {_WELLS}, x AS (SELECT plate, well, bool_or(value < -2.7 OR value > -1.3) AS red FROM w WHERE metric = 'PowerLogLogSlope' GROUP BY 1, 2) SELECT plate, count(*) FILTER (red) AS n_red, count(*) AS n_wells FROM x GROUP BY 1",
    "mad_scores_plate_cohort": f"WITH {_WELLS}, a AS ({_PSCORE}), b AS ({_CSCORE}) SELECT a.plate, a.well, metric, channel, a.value, a.score AS plate_score, b.score AS cohort_score FROM a JOIN b USING (plate, well, metric, channel)",
    "qc_red_scores": f"WITH {_WELLS}, b AS ({_CSCORE}), x AS (SELECT plate, well, bool_or(abs(score) > 3) AS red FROM b GROUP BY 1, 2) SELECT plate, count(*) FILTER (red) AS n_red FROM x GROUP BY 1",
    "cohort_range_p2_p98": f"WITH {_READ} SELECT metric, channel, round(quantile_cont(value, 0.02), 9) AS lo, round(quantile_cont(value, 0.98), 9) AS hi FROM r GROUP BY 1, 2 HAVING count(value) >= 10",
    "per_image_median_list": f"WITH {_INT}, m AS (SELECT plate, well, ImageNumber, channel, median(value) AS m FROM i GROUP BY ALL) SELECT plate, well, channel, list_sort(list(m)) AS medians FROM m GROUP BY ALL",
    "well_medians": f"WITH {_INT} SELECT plate, well, channel, count(*) AS n, median(value) AS median FROM i GROUP BY ALL",
    "eta_squared_position": f"""WITH {_READ}, a AS ({_eta("well[1]")}), b AS ({_eta("well[2:3]")}), h AS (SELECT plate, eta AS base FROM a WHERE channel = 'Hoechst'),
j AS (SELECT a.plate, a.channel, a.eta AS e, b.eta AS c, h.base AS base FROM a JOIN b USING (plate, channel) LEFT JOIN h USING (plate))
SELECT plate, channel, round(e, 6) AS eta2_row, round(c, 6) AS eta2_column, CASE WHEN e IS NULL THEN NULL WHEN channel = 'Hoechst' THEN CASE WHEN e >= 0.14 THEN 'bad' WHEN e >= 0.06 THEN 'warn' ELSE 'good' END
WHEN e >= 0.14 OR (e / nullif(base, 0) >= 4 AND e >= 0.06) THEN 'bad' WHEN e >= 0.06 AND coalesce(e / nullif(base, 0), 2) >= 2 THEN 'warn' ELSE 'good' END AS verdict_row FROM j""",
    "box_stats": f"""WITH {_READ}, q AS (SELECT metric, channel, count(value) AS n, quantile_cont(value, 0.25) AS q1, median(value) AS med, quantile_cont(value, 0.75) AS q3 FROM r WHERE value IS NOT NULL GROUP BY 1, 2)
SELECT metric, channel, n, round(q1, 9) AS q1, round(med, 9) AS med, round(q3, 9) AS q3, round(min(value) FILTER (value >= q1 - 1.5 * (q3 - q1)), 9) AS whisker_low, round(max(value) FILTER (value <= q3 + 1.5 * (q3 - q1)), 9) AS whisker_high FROM r JOIN q USING (metric, channel) GROUP BY metric, channel, n, q1, med, q3""",
    "reading_histogram": f"""WITH {_READ}, e AS (SELECT metric, channel, min(value) AS lo, max(value) AS hi FROM r GROUP BY 1, 2)
SELECT metric, channel, least(29, floor(coalesce((value - lo) / nullif(hi - lo, 0), 0) * 30))::INT AS bin, count(*) AS n FROM r JOIN e USING (metric, channel) WHERE value IS NOT NULL GROUP BY ALL""",
    "radius_range": f"""WITH c AS (SELECT {PLATE} AS plate, AreaShape_MedianRadius AS v FROM cells WHERE NOT isnan(AreaShape_MedianRadius)), o AS (SELECT plate, list_sort(list(v)) AS l, count(*) AS n FROM c WHERE plate IS NOT NULL GROUP BY 1)
SELECT plate, n, l[least(n - 1, floor(n * 0.02))::BIGINT + 1] AS p2, l[least(n - 1, floor(n * 0.98))::BIGINT + 1] AS p98 FROM o""",
    "metric_summary": f"WITH {_JUDGED} SELECT metric, channel, round(avg(value), 6) AS mean, round(stddev_pop(value), 6) AS sd, min(value) AS lo, max(value) AS hi, round(avg(passes::INT), 6) AS pass_share FROM j GROUP BY 1, 2",
    "snr_proxy": f"""WITH {_INT}, {_READ}, a AS (SELECT plate, channel, median(value) AS object_median FROM i GROUP BY 1, 2), b AS (SELECT plate, channel, median(value) AS image_median FROM r WHERE metric = 'MedianIntensity' GROUP BY 1, 2),
s AS (SELECT plate, channel, object_median, image_median, (object_median - image_median) / nullif(image_median, 0) AS x FROM a JOIN b USING (plate, channel))
SELECT plate, channel, object_median, image_median, round(x, 6) AS snr, CASE WHEN x < 0.2 THEN 'bad' WHEN x < 0.5 THEN 'warn' WHEN x IS NOT NULL THEN 'good' END AS verdict FROM s""",
    "cell_counts": f"""WITH {_SITES}, w AS (SELECT plate, well, coalesce(sum(Count_Cells), 0) AS c, coalesce(sum(Count_Nuclei), 0) AS n, coalesce(sum(Count_Illum_artifacts), 0) AS a, count(*) AS s FROM sites GROUP BY 1, 2),
d AS (SELECT *, c / nullif(n, 0) AS ratio, a / (s * 1166400) * 1000 AS density FROM w)
SELECT plate, well, round(ratio, 6) AS ratio, round(CASE WHEN ratio IS NOT NULL THEN least(1.0, ratio) END, 6) AS ratio_capped, c < 700 AS few_cells, round(density, 9) AS density, CASE WHEN density > 0.05 THEN 'red' WHEN density > 0.02 THEN 'orange' ELSE 'green' END AS density_colour FROM d""",
    "object_filter": f"SELECT {PLATE} AS plate, count(*) FILTER (AreaShape_Area >= 2000 AND NOT isnan(AreaShape_Area)) AS n_kept, count(*) AS n FROM cells GROUP BY 1",
}
