"""Distributed statistics on long tables: order statistics, ranks, steps of multiple testing.

No function gathers a group in one task: values are counted by bucket before
any ordering, and windows run over buckets or distinct values of one bucket.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wellspring.functions.keys import clean_number
from wellspring.session import cut


#: groups up to this many values fit one task's value counts; larger ones are never gathered
DIRECT_ROWS = 200_000


def long_form(df: DataFrame, keys: list[str], features: list[str]) -> DataFrame:
    """``*keys, feature, value``; null and NaN values are left out."""
    named = F.array(*[F.lit(f) for f in features])
    cells = F.array(*[F.struct(F.lit(i).alias("i"), clean_number(F.col(f)).alias("value")) for i, f in enumerate(features)])
    rows = df.select(*keys, F.explode(cells).alias("c")).filter("c.value is not null")
    return rows.select(*keys, F.element_at(named, F.col("c.i") + 1).alias("feature"), F.col("c.value").alias("value"))


def value_bucket(value: str) -> Column:
    """A bucket number that does not decrease with the value (0.4 % of the value wide, at any magnitude)."""
    size = F.floor(F.ln(F.greatest(F.abs(F.col(value)), F.lit(1e-300))) * 256) + 180_000  # positive for every double
    return F.when(F.col(value) == 0, F.lit(0)).otherwise(F.signum(value) * size).cast("int")


#: rows of a table that is broadcast after they are counted
BROADCAST_ROWS = 200_000
#: parts that an interval of values is divided into
FINER = 4_096


def _small(df: DataFrame) -> DataFrame:
    """``df`` marked for broadcast if it is found to be small."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def order_statistics(df: DataFrame, keys: list[str], value: str, ranks: DataFrame) -> DataFrame:
    """``*keys, rank, v``: the values of given ranks (from 0) per group, exactly.

    ``ranks`` has ``*keys, rank``.  Rows are counted by bucket in one pass without
    being moved; then only the values of the buckets that hold a rank are looked
    at, in ever finer intervals until one holds at most ``DIRECT_ROWS`` rows, and
    these are ordered by distinct value.
    """
    here = [*keys, "rank"]
    shape = [F.count(F.lit(1)).alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")]
    values = df.select(*keys, F.col(value).alias("v"))
    ahead = lambda w: F.coalesce(F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    coarse = values.groupBy(*keys, value_bucket("v").alias("b")).agg(*shape).withColumn("before", ahead(Window.partitionBy(*keys).orderBy("b")))
    target = coarse.join(ranks, keys).filter("rank >= before and rank < before + n").select(*here, "n", "lo", "hi", (F.col("rank") - F.col("before")).alias("within"))
    target = cut(target)
    while not target.filter((F.col("n") > DIRECT_ROWS) & (F.col("lo") < F.col("hi"))).isEmpty():
        near = values.join(_small(target), keys).filter("v >= lo and v <= hi")
        part = F.floor(F.coalesce(F.try_divide(F.col("v") - F.col("lo"), F.col("hi") - F.col("lo")), F.lit(0.0)) * FINER).cast("int")
        fine = near.groupBy(*here, "within", part.alias("b")).agg(*shape).withColumn("before", ahead(Window.partitionBy(*here).orderBy("b")))
        narrower = cut(fine.filter("within >= before and within < before + n").select(*here, "n", "lo", "hi", (F.col("within") - F.col("before")).alias("within")), looping=True)
        if narrower.join(target.select(*here, F.col("n").alias("was")), here).filter("n < was").isEmpty():
            break  # equal or adjacent values only
        target = narrower
    counted = values.join(_small(target), keys).filter("v >= lo and v <= hi").groupBy(*here, "within", "v").count()
    upto = F.sum("count").over(Window.partitionBy(*here).orderBy("v"))
    return counted.withColumn("upto", upto).filter("within < upto and within >= upto - count").select(*here, "v")


def quantiles(df: DataFrame, keys: list[str], value: str, wanted: dict[str, float]) -> DataFrame:
    """``*keys, n, *wanted``: exact quantiles with linear interpolation, null values left out.

    For groups of any size; an empty table gives an empty result.
    """
    df = df.filter(F.col(value).isNotNull())
    sizes = cut(df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")))
    hot = sizes.filter(F.col("n") > DIRECT_ROWS)
    every, many = sizes.count(), hot.count()
    if not many:
        return _direct_quantiles(df, keys, value, wanted)
    if many == every:
        return _ordered_quantiles(df, keys, value, wanted, sizes)
    some = F.broadcast(hot.select(*keys)) if many <= BROADCAST_ROWS else hot.select(*keys)
    cool = _direct_quantiles(df.join(some, keys, "left_anti"), keys, value, wanted)
    return cool.unionByName(_ordered_quantiles(df.join(some, keys, "left_semi"), keys, value, wanted, hot))


def _direct_quantiles(df: DataFrame, keys: list[str], value: str, wanted: dict[str, float]) -> DataFrame:
    found = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.percentile(F.col(value), list(wanted.values())).alias("q"))
    return found.select(*keys, "n", *[F.col("q")[i].alias(name) for i, name in enumerate(wanted)])


def _ordered_quantiles(df: DataFrame, keys: list[str], value: str, wanted: dict[str, float], sizes: DataFrame) -> DataFrame:
    low = lambda q: F.floor(F.round(F.lit(q) * (F.col("n") - 1), 9)).cast("long")
    high = lambda q: F.ceil(F.round(F.lit(q) * (F.col("n") - 1), 9)).cast("long")
    needed = F.array_distinct(F.array(*[f(q) for q in wanted.values() for f in (low, high)]))
    found = order_statistics(df, keys, value, sizes.select(*keys, F.explode(needed).alias("rank")))
    at = found.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("rank", "v"))).alias("m")).join(sizes, keys)
    out = []
    for name, q in wanted.items():
        a, b = F.element_at("m", low(q)), F.element_at("m", high(q))
        out.append((a + (b - a) * (F.lit(q) * (F.col("n") - 1) - low(q))).alias(name))
    return at.select(*keys, "n", *out)


def medians(df: DataFrame, keys: list[str], value: str, name: str) -> DataFrame:
    return quantiles(df, keys, value, {name: 0.5})


def median_and_mad(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """``*keys, n, med, mad``: median and raw median absolute deviation."""
    center = cut(medians(df, keys, value, "med"))
    off = df.join(_small(center.select(*keys, "med")), keys).withColumn("off", F.abs(F.col(value) - F.col("med")))
    return center.join(medians(off, keys, "off", "mad").drop("n"), keys)


def clip(c: Column, lo: Column | float, hi: Column | float) -> Column:
    """``c`` held within bounds; null stays null."""
    low, high = (x if isinstance(x, Column) else F.lit(x) for x in (lo, hi))
    return F.when(c.isNotNull(), F.greatest(F.least(c, high), low))


def half_away(c: Column, digits: int) -> Column:
    """``c`` rounded to ``digits`` as SQL's doubles are: scaled, rounded half away from zero, scaled back.

    ``F.round`` rounds the shortest decimal form instead: 0.0002465, whose double
    times a million is 246.49999999999997, becomes 0.000247 there and 0.000246 here.
    """
    r = F.round(c * 10.0**digits) / 10.0**digits
    return F.when(F.abs(r) < float("inf"), r).otherwise(c)


def stepup_threshold(p_values: DataFrame, keys: list[str], p: str, alpha: float) -> DataFrame:
    """``*keys, m, n_rejected, p_limit`` of the Benjamini-Hochberg step-up procedure.

    p-values are counted before they are ranked, so ties cost nothing.
    ``p_limit`` is null where nothing is rejected.
    """
    counts = p_values.groupBy(*keys, p).count()
    upto = F.sum("count").over(Window.partitionBy(*keys).orderBy(p))
    total = p_values.groupBy(*keys).agg(F.count(F.lit(1)).alias("m"))
    ranked = counts.withColumn("k", upto).join(total, keys) if keys else counts.withColumn("k", upto).crossJoin(total)
    passing = F.col(p) <= F.col("k") / F.col("m") * alpha
    return ranked.groupBy(*keys, "m").agg(F.coalesce(F.max(F.when(passing, F.col("k"))), F.lit(0)).alias("n_rejected"), F.max(F.when(passing, F.col(p))).alias("p_limit"))


def number_rows(df: DataFrame, order: list[str], name: str = "row_no") -> DataFrame:
    """``df`` with the rows' places (from 0) in the whole order, without a single-task window."""
    spark = df.sparkSession
    ordered = cut(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_mark", F.monotonically_increasing_id()))
    ordered = ordered.withColumn("_part", F.shiftright("_mark", 33))
    total, starts = 0, []
    for part, n in sorted((r["_part"], r["count"]) for r in ordered.groupBy("_part").count().collect()):  # one row per partition
        starts.append((part, total))
        total += n
    offsets = F.broadcast(spark.createDataFrame(starts or [(0, 0)], "_part long, _offset long"))
    place = F.col("_offset") + F.col("_mark").bitwiseAND(F.lit((1 << 33) - 1))
    return ordered.join(offsets, "_part").withColumn(name, place).drop("_mark", "_part", "_offset")
