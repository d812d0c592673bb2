"""Quality control of imaging sites, wells and plates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wellspring.functions.keys import plain_plate
from wellspring.operators.stats import median_and_mad, medians, quantiles
from wellspring.session import cut

# Absolute limits by measurement and channel (null: no limit).
LIMITS = [
    ("PowerLogLogSlope", None, -2.5, -1.0),
    ("MedianIntensity", None, None, 0.95),
    ("FocusScore", "Hoechst", 0.80, None),
    ("FocusScore", "Syto", 0.05, None),
    ("FocusScore", "Golgi", 0.03, None),
    ("FocusScore", "ER", 0.08, None),
    ("FocusScore", "Mito", 0.005, None),
    ("FocusScore", "Brightfield", 0.001, None),
]
# Limits of the red-well count by measurement.
RED = [("PowerLogLogSlope", None, -2.7, -1.3), ("PercentMaximal", None, None, 1.0), ("PercentMinimal", None, None, 5.0)]
# Colour bands of a measurement, as upper ends on its scale from low to high.
BANDS = {
    "PowerLogLogSlope": (-3.0, -1.0, [(0.15, "red"), (0.35, "yellow"), (0.65, "green"), (0.85, "yellow"), (1.0, "red")]),
    "PercentMaximal": (0.0, None, [(0.05, "green"), (0.25, "yellow"), (1.0, "red")]),
    "PercentMinimal": (0.0, None, [(0.2, "green"), (0.5, "yellow"), (1.0, "red")]),
}
# Limits of objects by column.
OBJECT_LIMITS = {"Intensity_MinIntensity_Hoechst": (0.25, None), "Nuclei_AreaShape_Area": (None, 1500.0), "AreaShape_Area": (2000.0, None)}
CHANNELS = ("Hoechst", "Syto", "Golgi", "ER", "Mito", "Brightfield")


def readings(df: DataFrame, keys: list[str], measurements: list[str], channels=CHANNELS) -> DataFrame:
    """``*keys, metric, channel, value`` (null where missing or NaN) from ``ImageQuality_<metric>_<channel>`` columns."""
    number = lambda m, c: F.nanvl(F.col(f"ImageQuality_{m}_{c}"), F.lit(None).cast("double"))
    cells = [F.struct(F.lit(m).alias("metric"), F.lit(c).alias("channel"), number(m, c).alias("value")) for m in measurements for c in channels]
    return df.select(*keys, F.explode(F.array(*cells)).alias("c")).select(*keys, "c.*")


def _limit(limits, side: int) -> Column:
    out = F.lit(None).cast("double")
    for row in limits:
        where = (F.col("metric") == row[0]) & (F.lit(True) if row[1] is None else F.col("channel") == row[1])
        out = F.when(where, F.lit(row[side]).cast("double")).otherwise(out)
    return out


def absolute_pass(long: DataFrame, limits=LIMITS) -> DataFrame:
    """``passes``: null without a value, else whether it lies within the limits."""
    lo, hi = _limit(limits, 2), _limit(limits, 3)
    fails = F.coalesce(F.col("value") < lo, F.lit(False)) | F.coalesce(F.col("value") > hi, F.lit(False))
    return long.withColumn("passes", F.when(F.col("value").isNotNull(), ~fails))


def adaptive_bounds(long: DataFrame, keys: list[str], deviations: float = 3.0, least: int = 5) -> DataFrame:
    """``*keys, n, lo, hi``: median -/+ ``deviations`` normal-scaled MADs, where a group has ``least`` values."""
    stats = median_and_mad(long.filter("value is not null"), keys, "value").filter(F.col("n") >= least)
    width = F.col("mad") / 0.6744897501960817 * deviations
    return stats.select(*keys, "n", (F.col("med") - width).alias("lo"), (F.col("med") + width).alias("hi"))


def verdicts(long: DataFrame, bounds: DataFrame, keys: list[str], independent: bool = False) -> DataFrame:
    """Tri-state ``passes`` with adaptive bounds.

    By default an adaptive failure counts only together with an absolute one, so
    the verdict equals the absolute test; ``independent`` lets either fail it.
    """
    both = absolute_pass(long).join(bounds.select(*keys, "lo", "hi"), keys, "left")
    outside = F.coalesce((F.col("value") < F.col("lo")) | (F.col("value") > F.col("hi")), F.lit(False))
    failed = ~F.col("passes") | outside if independent else ~F.col("passes") & (outside | ~F.col("passes"))
    return both.withColumn("adaptive_ok", ~outside).withColumn("passes", F.when(F.col("value").isNotNull(), ~failed)).drop("lo", "hi")


def group_pass(judged: DataFrame, keys: list[str]) -> DataFrame:
    """Per key whether all readings pass, all of the illumination group, all of the focus group; null passes."""
    ok = F.coalesce("passes", F.lit(True))
    return judged.groupBy(*keys).agg(
        F.bool_and(ok).alias("all_pass"),
        F.bool_and(F.when(F.col("metric").isin("PowerLogLogSlope", "MedianIntensity"), ok)).alias("illum_pass"),
        F.bool_and(F.when(F.col("metric") == "FocusScore", ok)).alias("focus_pass"),
    )


def border(judged: DataFrame, keys: list[str]) -> DataFrame:
    """Colour by the slope verdicts over all channels: green all pass, red none, orange some, grey no data."""
    slope = judged.filter("metric = 'PowerLogLogSlope'").groupBy(*keys).agg(F.count_if(F.col("passes")).alias("good"), F.count("passes").alias("n"))
    colour = F.when(F.col("n") == 0, "grey").when(F.col("good") == F.col("n"), "green").when(F.col("good") == 0, "red").otherwise("orange")
    return slope.select(*keys, colour.alias("border"))


def flags(judged: DataFrame, keys: list[str]) -> DataFrame:
    """Per key the failed readings as sorted ``metric/channel`` tags."""
    tag = F.concat_ws("/", "metric", "channel")
    return judged.groupBy(*keys).agg(F.sort_array(F.collect_set(F.when(~F.col("passes"), tag))).alias("failed"))


def mad_scores(wells: DataFrame, group: list[str], least: int = 4) -> DataFrame:
    """``wells`` (…, metric, channel, value) with ``score`` in raw MADs of the group; a MAD of 0 counts as 1."""
    keys = [*group, "metric", "channel"]
    stats = median_and_mad(wells.filter("value is not null"), keys, "value").filter(F.col("n") >= least)
    scored = wells.join(stats.select(*keys, "med", "mad"), keys, "left")
    return scored.withColumn("score", F.round((F.col("value") - F.col("med")) / F.coalesce(F.nullif(F.col("mad"), F.lit(0.0)), F.lit(1.0)), 2) + 0.0).drop("med", "mad")


def cohort_range(long: DataFrame, keys: list[str], floor: float | None = None, ceiling: float | None = None) -> DataFrame:
    """2nd and 98th percentile per key with at least ten values, widened to ``floor`` and ``ceiling``."""
    found = quantiles(long, keys, "value", {"p2": 0.02, "p98": 0.98}).filter("n >= 10")
    lo = F.col("p2") if floor is None else F.least("p2", F.lit(floor))
    hi = F.col("p98") if ceiling is None else F.greatest("p98", F.lit(ceiling))
    return found.select(*keys, lo.alias("lo"), hi.alias("hi"))


def eta_squared(long: DataFrame, keys: list[str], by: str) -> DataFrame:
    """Share of the variance of ``value`` between the groups of ``by``; null with fewer than two values or no variance."""
    cells = long.groupBy(*keys, by).agg(F.count("value").alias("n"), F.sum("value").alias("s"), F.sum(F.col("value") * F.col("value")).alias("q"))
    total = cells.groupBy(*keys).agg(F.sum("n").alias("n"), F.sum("s").alias("s"), F.sum("q").alias("q"), F.sum(F.try_divide(F.col("s") * F.col("s"), F.col("n"))).alias("between"))
    mean = F.col("s") * F.col("s") / F.col("n")
    all_squares = F.col("q") - mean
    flat = all_squares <= 1e-12 * F.col("q")
    return total.filter("n > 0").select(*keys, F.when((F.col("n") >= 2) & ~flat, F.greatest(F.lit(0.0), F.try_divide(F.col("between") - mean, all_squares))).alias("eta2"))


def position_verdict(eta: Column, baseline: Column, is_baseline: Column) -> Column:
    """Positional effect: good, warn or bad; other channels are set against the baseline channel's effect."""
    ratio = F.try_divide(eta, baseline)
    own = F.when(eta >= 0.14, "bad").when(eta >= 0.06, "warn").otherwise("good")
    other = F.when((eta >= 0.20) | (eta >= 0.14) | (ratio >= 4) & (eta >= 0.06), "bad").when((eta >= 0.06) & (F.coalesce(ratio, F.lit(2.0)) >= 2), "warn").otherwise("good")
    return F.when(eta.isNotNull(), F.when(is_baseline, own).otherwise(other))


def box_stats(long: DataFrame, keys: list[str]) -> DataFrame:
    """Quartiles and whiskers: the outermost values within 1.5 interquartile ranges of the box."""
    quart = cut(quantiles(long, keys, "value", {"q1": 0.25, "med": 0.5, "q3": 0.75}))
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    joined = long.join(quart, keys)
    ends = joined.groupBy(*keys).agg(F.min(F.when(F.col("value") >= F.col("q1") - reach, F.col("value"))).alias("whisker_low"), F.max(F.when(F.col("value") <= F.col("q3") + reach, F.col("value"))).alias("whisker_high"))
    return quart.join(ends, keys)


def histogram(long: DataFrame, keys: list[str], bins: int = 30) -> DataFrame:
    """Counts in ``bins`` equal bins from the smallest to the largest value of each key."""
    ends = long.groupBy(*keys).agg(F.min("value").alias("lo"), F.max("value").alias("hi"))
    place = F.least(F.lit(bins - 1), F.floor(F.coalesce(F.try_divide(F.col("value") - F.col("lo"), F.col("hi") - F.col("lo")), F.lit(0.0)) * bins)).cast("int")
    return long.join(ends, keys).groupBy(*keys, place.alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def floor_percentiles(long: DataFrame, keys: list[str], wanted: dict[str, float]) -> DataFrame:
    """The sorted values at index floor(n q), not interpolated."""
    from wellspring.operators.stats import order_statistics

    sizes = cut(long.groupBy(*keys).agg(F.count("value").alias("n")))
    at = lambda q: F.least(F.col("n") - 1, F.floor(F.col("n") * F.lit(q))).cast("long")
    ranks = sizes.select(*keys, F.explode(F.array_distinct(F.array(*[at(q) for q in wanted.values()]))).alias("rank"))
    found = order_statistics(long, keys, "value", ranks).groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("rank", "v"))).alias("m")).join(sizes, keys)
    return found.select(*keys, "n", *[F.element_at("m", at(q)).alias(name) for name, q in wanted.items()])


def signal_to_background(objects: DataFrame, images: DataFrame, keys: list[str]) -> DataFrame:
    """(object median - image median) / image median per key and channel with a verdict; null if the image median is null or 0."""
    a, b = medians(objects, [*keys, "channel"], "value", "object_median").drop("n"), medians(images, [*keys, "channel"], "value", "image_median").drop("n")
    both = a.join(b, [*keys, "channel"]).withColumn("snr", F.try_divide(F.col("object_median") - F.col("image_median"), F.col("image_median")))
    return both.withColumn("verdict", F.when(F.col("snr") < 0.2, "bad").when(F.col("snr") < 0.5, "warn").when(F.col("snr").isNotNull(), "good"))


def artifact_density(n: Column, area: Column) -> Column:
    """Artifacts per 1000 pixels; an area of null or 0 counts as a full image."""
    return F.try_divide(n, F.coalesce(F.nullif(area, F.lit(0)), F.lit(1_166_400))) * 1000


def badge(rate: Column) -> Column:
    return F.when(rate >= 80, "pass").when(rate >= 50, "warn").otherwise("fail")


def red_wells(wells: DataFrame, keys: list[str], limits=RED) -> DataFrame:
    """``*keys, metric, red``: whether any channel's value leaves the limits of its measurement (null values do not)."""
    judged = absolute_pass(wells.filter(F.col("metric").isin([m for m, *_ in limits])), limits)
    return judged.groupBy(*keys, "metric").agg(F.bool_or(F.coalesce(~F.col("passes"), F.lit(False))).alias("red"))


def band(value: Column, low: float, high: float, stops: list[tuple[float, str]]) -> Column:
    """Colour of a value on a stepped scale from ``low`` to ``high``; values beyond it take the outer colours, null none."""
    at = F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.round((value - low) / (high - low), 12)))
    out = F.lit(stops[-1][1])
    for end, colour in reversed(stops[:-1]):
        out = F.when(at <= end, colour).otherwise(out)
    return F.when(value.isNotNull(), out)


def worst(colour: Column) -> Column:
    """The worst colour of a group: red before yellow before green; null without any."""
    rank = F.max(F.when(colour == "red", 3).when(colour == "yellow", 2).when(colour == "green", 1))
    return F.when(rank == 3, "red").when(rank == 2, "yellow").when(rank == 1, "green")


def within(limits: dict[str, tuple[float | None, float | None]], columns: list[str]) -> Column:
    """Whether the columns that are present lie within their limits (both ends allowed; null and NaN do not)."""
    ok = F.lit(True)
    for name, (lo, hi) in limits.items():
        if name in columns:
            v = F.nanvl(F.col(name), F.lit(None).cast("double"))
            ok = ok & v.isNotNull() & (F.lit(True) if lo is None else v >= lo) & (F.lit(True) if hi is None else v <= hi)
    return F.coalesce(ok, F.lit(False))


def first_children(parents: DataFrame, children: DataFrame, keys: list[str], child: str) -> DataFrame:
    """Parents with ``child`` (the smallest one with equal keys, null if none) and ``n_children``; null keys have none."""
    own = children.groupBy(*keys).agg(F.min(child).alias(child), F.count(child).alias("n_children"))
    return parents.join(own, keys, "left").fillna(0, ["n_children"])


def sample_per_group(df: DataFrame, keys: list[str], order: Column, n: int, salts: int = 64) -> DataFrame:
    """At most ``n`` rows of each group, the first by ``order`` (a hash makes it random); groups are thinned by salts first."""
    marked = df.withColumn("_o", order).withColumn("_s", F.pmod(F.xxhash64("_o"), F.lit(salts)))
    for by in ([*keys, "_s"], keys):
        marked = marked.withColumn("_r", F.row_number().over(Window.partitionBy(*by).orderBy("_o"))).filter(F.col("_r") <= n)
    return marked.drop("_o", "_s", "_r")


def match_keys(left: DataFrame, key: str, right: DataFrame, right_key: str) -> DataFrame:
    """``key, found, how``: for every distinct key of ``left`` the key of ``right`` it stands for.

    In turn: the key itself, without its leading P, with one, each first exactly
    and then without regard to case, blanks and leading zeros.  Where none fits
    and ``right`` has only one key, that one (``how`` = sole).  Else null.
    """
    names = left.select(F.col(key).alias("key")).filter("key is not null").distinct()
    known = right.select(F.col(right_key).alias("found")).filter("found is not null").distinct()
    bare = F.regexp_replace("key", "^P*p*", "")
    forms = F.array("key", bare, F.concat(F.lit("P"), bare))
    asked = names.select("key", F.posexplode(forms).alias("turn", "form"))
    exact = asked.join(known.withColumn("form", F.col("found")), "form").select("key", (2 * F.col("turn")).alias("o"), "found")
    loose = known.groupBy(plain_plate(F.col("found")).alias("plain")).agg(F.min("found").alias("found"))
    alike = asked.withColumn("plain", plain_plate(F.col("form"))).join(loose, "plain").select("key", (2 * F.col("turn") + 1).alias("o"), "found")
    best = exact.unionByName(alike).groupBy("key").agg(F.min_by("found", F.struct("o", "found")).alias("found"))
    sole = known.agg(F.count(F.lit(1)).alias("n"), F.min("found").alias("only"))  # one row
    both = names.join(best, "key", "left").join(F.broadcast(sole))
    alone = F.col("found").isNull() & (F.col("n") == 1)
    return both.select("key", F.when(alone, F.col("only")).otherwise(F.col("found")).alias("found"), F.when(alone, "sole").when(F.col("found").isNotNull(), "key").alias("how"))
