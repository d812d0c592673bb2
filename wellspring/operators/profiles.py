"""From object tables to normalised, selected profiles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wellspring.operators.stats import clip, median_and_mad, medians, quantiles
from wellspring.session import cut


def outlier_scores(long: DataFrame, eps: float = 1e-8) -> DataFrame:
    """``long`` with ``score``: distance from the feature's median in MADs."""
    stats = median_and_mad(long, ["feature"], "value").select("feature", "med", "mad")
    return long.join(F.broadcast(stats), "feature").withColumn("score", (F.col("value") - F.col("med")) / (F.col("mad") + eps)).drop("med", "mad")  # one row per feature


def outlier_report(long: DataFrame, keys: list[str], limit: float = 5.0, top: int = 20) -> DataFrame:
    """The ``top`` groups with most readings beyond ``limit``, with their mean and largest score."""
    beyond = outlier_scores(long).filter(F.abs("score") > limit)
    report = beyond.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_outliers"), F.round(F.avg(F.abs("score")), 6).alias("mean_score"), F.round(F.max(F.abs("score")), 6).alias("max_score"))
    return report.orderBy(F.col("n_outliers").desc(), *keys).limit(top)


def winsorised(long: DataFrame, lo: float = 0.05, hi: float = 0.95) -> DataFrame:
    """Values held within the feature's ``lo`` and ``hi`` quantiles."""
    bounds = quantiles(long, ["feature"], "value", {"lo": lo, "hi": hi}).drop("n")
    return long.join(F.broadcast(bounds), "feature").withColumn("value", clip(F.col("value"), F.col("lo"), F.col("hi")))  # one row per feature


def profile(long: DataFrame, strata: list[str]) -> DataFrame:
    """Median of every feature per stratum: ``*strata, feature, value``."""
    return medians(long, [*strata, "feature"], "value", "value").drop("n")


def mad_robustize(profiles: DataFrame, control: str, factor: float = 1.4826, eps: float = 1e-18) -> DataFrame:
    """Profiles relative to the median and MAD of the rows that meet ``control``, over all of them."""
    stats = median_and_mad(profiles.filter(control), ["feature"], "value").select("feature", "med", "mad")
    return profiles.join(F.broadcast(stats), "feature").withColumn("value", (F.col("value") - F.col("med")) / (F.col("mad") * factor + eps)).drop("med", "mad")


def standardise(profiles: DataFrame) -> DataFrame:
    """Mean 0 and population standard deviation 1 per feature; constant features only lose their mean."""
    stats = profiles.groupBy("feature").agg(F.avg("value").alias("mean"), F.coalesce(F.nullif(F.stddev_pop("value"), F.lit(0.0)), F.lit(1.0)).alias("sd"))
    return profiles.join(F.broadcast(stats), "feature").withColumn("value", (F.col("value") - F.col("mean")) / F.col("sd")).drop("mean", "sd")


def robust_z(profiles: DataFrame, control: str) -> DataFrame:
    """0.6745 (x - A) / B with A the controls' mean and B their median distance from it.

    B of at most 1e-8 becomes exp(-B).  Features with fewer than two control
    values are standardised instead.
    """
    controls = profiles.filter(control)
    mean = cut(controls.groupBy("feature").agg(F.avg("value").alias("a"), F.count(F.lit(1)).alias("n_control")))
    off = controls.join(F.broadcast(mean), "feature").withColumn("off", F.abs(F.col("value") - F.col("a")))
    stats = mean.join(medians(off, ["feature"], "off", "b").drop("n"), "feature")
    scale = F.when(F.col("b") > 1e-8, F.col("b")).otherwise(F.exp(-F.col("b")))
    z = F.when(F.col("n_control") >= 2, 0.6745 * (F.col("value") - F.col("a")) / scale)
    plain = profiles.groupBy("feature").agg(F.avg("value").alias("mean"), F.coalesce(F.nullif(F.stddev_pop("value"), F.lit(0.0)), F.lit(1.0)).alias("sd"))
    joined = profiles.join(F.broadcast(stats), "feature", "left").join(F.broadcast(plain), "feature")
    return joined.withColumn("value", F.coalesce(z, (F.col("value") - F.col("mean")) / F.col("sd"))).drop("a", "b", "n_control", "mean", "sd")


def low_variance(long: DataFrame, freq_cut: float = 0.05, unique_cut: float = 0.01) -> DataFrame:
    """``feature, freq_ratio, unique_ratio, keep``: second to first most frequent value, distinct share."""
    counts = long.groupBy("feature", "value").count()
    order = Window.partitionBy("feature").orderBy(F.col("count").desc(), "value")
    top = counts.withColumn("r", F.row_number().over(order)).filter("r <= 2").groupBy("feature").agg(F.max(F.when(F.col("r") == 1, F.col("count"))).alias("first"), F.max(F.when(F.col("r") == 2, F.col("count"))).alias("second"))
    shape = counts.groupBy("feature").agg(F.count(F.lit(1)).alias("distinct"), F.sum("count").alias("n"))
    ratio = F.coalesce(F.col("second"), F.lit(0)) / F.col("first")
    both = top.join(shape, "feature").withColumn("freq_ratio", ratio).withColumn("unique_ratio", F.col("distinct") / F.col("n"))
    keep = (F.col("freq_ratio") >= freq_cut) & (F.col("unique_ratio") >= unique_cut)
    return both.select("feature", F.round("freq_ratio", 6).alias("freq_ratio"), F.round("unique_ratio", 6).alias("unique_ratio"), keep.alias("keep"))


def average_ranks(df: DataFrame, features: list[str]) -> DataFrame:
    """Each column replaced by its values' average ranks (null stays null).

    Values are counted first; running counts go over the buckets of a column and
    over the distinct values inside one bucket.
    """
    from wellspring.operators.stats import long_form, value_bucket

    counted = long_form(df, [], features).withColumn("b", value_bucket("value")).groupBy("feature", "b", "value").count()
    counted = cut(counted)
    before_bucket = counted.groupBy("feature", "b").agg(F.sum("count").alias("n")).withColumn("base", F.coalesce(F.sum("n").over(Window.partitionBy("feature").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("n")
    inside = F.sum("count").over(Window.partitionBy("feature", "b").orderBy("value"))
    ranks = counted.withColumn("upto", inside).join(before_bucket, ["feature", "b"]).withColumn("rank", F.col("base") + F.col("upto") - (F.col("count") - 1) / 2.0).select("feature", "value", "rank")
    ranks = cut(ranks)
    out = df
    for f in features:
        one = ranks.filter(F.col("feature") == f).select(F.col("value").alias(f), F.col("rank").alias(f"{f}__rank"))
        out = out.join(one, f, "left").drop(f).withColumnRenamed(f"{f}__rank", f)
    return out


def rank_correlations(df: DataFrame, features: list[str]) -> DataFrame:
    """``a, b, r``: Spearman's correlation of every two columns, over rows without nulls, in one aggregation."""
    whole = df.select(*[F.nanvl(F.col(f).cast("double"), F.lit(None).cast("double")).alias(f) for f in features]).dropna()
    ranked = average_ranks(whole, features)
    pairs = [(a, b) for i, a in enumerate(features) for b in features[i + 1 :]]
    row = ranked.agg(*[F.corr(a, b).alias(f"c{i}") for i, (a, b) in enumerate(pairs)])
    cells = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"c{i}").alias("r")) for i, (a, b) in enumerate(pairs)])
    return row.select(F.explode(cells).alias("p")).select("p.*")


def drop_correlated(correlations: DataFrame, limit: float = 0.9) -> list[str]:
    """Features to drop: of each pair above ``limit``, in order of its names, the one with the larger sum of \\|r\\|.

    The correlations are one number per pair of columns of the table's schema.
    """
    rows = [(r.a, r.b, abs(r.r)) for r in correlations.filter("r is not null").collect()]
    total: dict[str, float] = {}
    for a, b, r in rows:
        total[a], total[b] = total.get(a, 0) + r, total.get(b, 0) + r
    gone: set[str] = set()
    for a, b, r in sorted(rows):
        if r > limit and not {a, b} & gone:
            gone.add(a if total[a] > total[b] else b)
    return sorted(gone)


def to_vectors(long: DataFrame, keys: list[str], features: list[str]) -> DataFrame:
    """``*keys, features``: one array per profile in the order of ``features`` (null where missing)."""
    m = F.map_from_entries(F.collect_list(F.struct("feature", "value")))
    return long.groupBy(*keys).agg(m.alias("m")).select(*keys, F.array(*[F.try_element_at("m", F.lit(f)) for f in features]).alias("features"))
