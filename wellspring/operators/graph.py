"""Similarity graphs as DataFrames: edges, degrees, components, communities, subprofiles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wellspring.operators.stats import medians
from wellspring.session import cut


def threshold_edges(pairs: DataFrame, thresholds: DataFrame) -> DataFrame:
    """Pairs of different labels whose similarity reaches their group's threshold."""
    return pairs.filter("label_a <> label_b").join(thresholds.select("grp", "threshold"), "grp").filter("similarity >= threshold").drop("threshold")


def _both_ways(edges: DataFrame) -> DataFrame:
    one = edges.select("grp", F.col("label_a").alias("src"), F.col("label_b").alias("dst"), F.col("similarity").alias("weight"))
    return one.unionByName(one.select("grp", F.col("dst").alias("src"), F.col("src").alias("dst"), "weight"))


def degrees(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """``grp, label, degree``; nodes without edges have 0."""
    n = _both_ways(edges).groupBy("grp", F.col("src").alias("label")).agg(F.count(F.lit(1)).alias("degree"))
    return nodes.select("grp", "label").join(n, ["grp", "label"], "left").fillna(0, ["degree"])


def components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """``grp, label, component``: the smallest label connected with each node.

    Smallest labels spread over edges and are then looked up for their own
    smallest label, so the number of rounds grows with the logarithm of a
    chain's length.
    """
    links = cut(_both_ways(edges).select("grp", "src", "dst").distinct())
    state = cut(nodes.select("grp", "label", F.col("label").alias("component")).distinct())
    while True:
        low = links.join(state.select("grp", F.col("label").alias("dst"), F.col("component").alias("near")), ["grp", "dst"]).groupBy("grp", F.col("src").alias("label")).agg(F.min("near").alias("near"))
        stepped = state.join(low, ["grp", "label"], "left").withColumn("step", F.least("component", F.coalesce("near", "component")))
        jump = state.select("grp", F.col("label").alias("step"), F.col("component").alias("jump"))
        moved = cut(stepped.join(jump, ["grp", "step"], "left").select("grp", "label", "component", F.least("step", F.coalesce("jump", "step")).alias("next")), looping=True)
        state = moved.select("grp", "label", F.col("next").alias("component"))
        if moved.filter("next < component").isEmpty():
            return state


#: rounds in which a hashed half of the nodes moves; afterwards one node per community does
HALVES = 6


def _moved(links: DataFrame, state: DataFrame) -> DataFrame:
    """``state`` (``grp, node, home, deg, total``) after nodes have moved to the neighbouring homes of largest modularity gain.

    First a hashed half of the nodes moves at a time.  Then those nodes move that
    gain most among all that want to leave or enter their old or their new home:
    such moves do not touch each other, so each round gains and the rounds end.
    Stops when no node wants to move.
    """
    keep = ["grp", "node", "home", "deg", "total"]
    turn = 0
    while True:
        mass = state.groupBy("grp", "home").agg(F.sum("deg").alias("mass"))
        here = state.join(mass, ["grp", "home"]).select("grp", "node", F.col("home").alias("own"), "deg", "total", (F.col("mass") - F.col("deg")).alias("rest"))
        homes = state.select("grp", F.col("node").alias("dst"), "home")
        toward = links.join(homes, ["grp", "dst"]).groupBy("grp", F.col("src").alias("node"), "home").agg(F.sum("weight").alias("w"))
        options = here.join(toward.join(mass, ["grp", "home"]), ["grp", "node"], "left")
        at_home = F.coalesce(F.col("home") == F.col("own"), F.lit(False))
        gain = lambda w, rest: F.round(w - F.col("deg") * rest / F.col("total"), 9)
        leave = F.when(F.col("home").isNotNull() & ~at_home, gain(F.col("w"), F.col("mass")))
        best = options.withColumn("gain", leave).groupBy("grp", "node", "own", "deg", "total").agg(
            F.min_by("home", F.when(F.col("gain").isNotNull(), F.struct(-F.col("gain"), "home"))).alias("best"), F.max("gain").alias("there"),
            gain(F.coalesce(F.max(F.when(at_home, F.col("w"))), F.lit(0.0)), F.max("rest")).alias("stay"))
        best = best.select("grp", "node", "own", "deg", "total", "best", (F.col("there") - F.col("stay")).alias("gain"), F.coalesce(F.col("there") > F.col("stay"), F.lit(False)).alias("wants"))
        if turn < HALVES:
            free = F.pmod(F.xxhash64("node", F.lit(turn)), F.lit(2)) == 0
        else:
            touched = best.filter("wants").select("grp", "node", "gain", F.explode(F.array("own", "best")).alias("home"))
            first = touched.groupBy("grp", "home").agg(F.max_by("node", F.struct("gain", "node")).alias("node")).groupBy("grp", "node").agg((F.count(F.lit(1)) == 2).alias("free"))
            best, free = best.join(first, ["grp", "node"], "left"), F.coalesce("free", F.lit(False))
        after = cut(best.withColumn("home", F.when(F.col("wants") & free, F.col("best")).otherwise(F.col("own"))).select(*keep, "wants"), looping=True)
        state = after.select(*keep)
        if after.filter("wants").isEmpty():
            return state
        turn += 1


def communities(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """``grp, label, community``: modularity optimisation by moving, refining and joining nodes; singletons keep their own label.

    On every level nodes move between communities until none gains; every
    community is refined by the same moves among its own nodes alone; the refined
    parts become the nodes of the next level and start in the communities found.
    Ends when every community is one node.  All steps are joins and sums, the
    same at every size.  Communities are named after their smallest label.
    """
    both = _both_ways(edges)
    deg = both.groupBy("grp", F.col("src").alias("node")).agg(F.sum("weight").alias("deg"))
    sums = deg.groupBy("grp").agg(F.sum("deg").alias("total"))
    links = cut(both.groupBy("grp", "src", "dst").agg(F.max("weight").alias("weight")))
    state = cut(deg.join(sums, "grp").select("grp", "node", F.col("node").alias("home"), "deg", "total"))
    where = state.select("grp", F.col("node").alias("label"), "node")
    while True:
        state = _moved(links, state)
        if state.groupBy("grp", "home").count().filter("count > 1").isEmpty():
            break
        home = lambda end: state.select("grp", F.col("node").alias(end), F.col("home").alias(f"{end}_home"))
        inside = links.join(home("src"), ["grp", "src"]).join(home("dst"), ["grp", "dst"]).filter("src_home = dst_home").select("grp", "src", "dst", "weight")
        parts = _moved(cut(inside, looping=True), state.withColumn("home", F.col("node"))).select("grp", "node", F.col("home").alias("part"))
        if parts.groupBy("grp", "part").count().filter("count > 1").isEmpty():  # nothing to refine: join the communities as they are
            parts = state.select("grp", "node", F.col("home").alias("part"))
        parts = cut(parts, looping=True)
        of = lambda end: parts.select("grp", F.col("node").alias(end), F.col("part").alias(f"{end}_part"))
        joined = links.join(of("src"), ["grp", "src"]).join(of("dst"), ["grp", "dst"]).filter("src_part <> dst_part")
        links = cut(joined.groupBy("grp", F.col("src_part").alias("src"), F.col("dst_part").alias("dst")).agg(F.sum("weight").alias("weight")), looping=True)
        state = cut(state.join(parts, ["grp", "node"]).groupBy("grp", F.col("part").alias("node")).agg(F.min("home").alias("home"), F.sum("deg").alias("deg"), F.first("total").alias("total")), looping=True)
        where = cut(where.join(parts, ["grp", "node"]).select("grp", "label", F.col("part").alias("node")), looping=True)
    found = where.join(state.select("grp", "node", "home"), ["grp", "node"])
    name = found.groupBy("grp", "home").agg(F.min("label").alias("community"))
    named = found.join(name, ["grp", "home"]).select("grp", "label", "community")
    return nodes.select("grp", "label").join(named, ["grp", "label"], "left").withColumn("community", F.coalesce("community", "label"))


def modularity(edges: DataFrame, membership: DataFrame) -> DataFrame:
    """``grp, modularity`` of a weighted graph under ``grp, label, community``."""
    both = _both_ways(edges)
    total = both.groupBy("grp").agg(F.sum("weight").alias("m2"))
    inside = both.join(membership.select("grp", F.col("label").alias("src"), F.col("community").alias("c1")), ["grp", "src"]).join(membership.select("grp", F.col("label").alias("dst"), F.col("community").alias("c2")), ["grp", "dst"])
    held = inside.groupBy("grp", F.col("c1").alias("community")).agg(F.sum(F.when(F.col("c1") == F.col("c2"), F.col("weight")).otherwise(0.0)).alias("inner"), F.sum("weight").alias("deg"))
    return held.join(total, "grp").groupBy("grp").agg(F.round(F.sum(F.col("inner") / F.col("m2") - (F.col("deg") / F.col("m2")) ** 2), 6).alias("modularity"))


def feature_values(df: DataFrame, keys: list[str], vector: str) -> DataFrame:
    """``*keys, pos, x``: array elements as rows (null and NaN left out)."""
    return df.select(*keys, F.posexplode(vector).alias("pos", "x")).withColumn("x", F.col("x").cast("double")).filter("x is not null and not isnan(x)")


def dominant_features(values: DataFrame, keys: list[str], sign_share: float = 0.85, least: float = 0.5) -> DataFrame:
    """``*keys, pos, median, share``: features of one sign in most rows and with a median size of at least ``least``."""
    long = values.withColumn("size", F.abs("x"))
    med, size = medians(long, [*keys, "pos"], "x", "median").drop("n"), medians(long, [*keys, "pos"], "size", "median_size").drop("n")
    share = long.groupBy(*keys, "pos").agg(F.greatest(F.avg((F.col("x") >= 0).cast("int")), F.avg((F.col("x") < 0).cast("int"))).alias("share"))
    return share.join(med, [*keys, "pos"]).join(size, [*keys, "pos"]).filter((F.col("share") >= sign_share) & (F.col("median_size") >= least)).select(*keys, "pos", "median", "share")


def memberships(values: DataFrame, subprofiles: DataFrame, keys: list[str], least: float = 0.6) -> DataFrame:
    """``*keys, community, similarity``: cosine of each row with a community's subprofile on its own features, held within [0, 1].

    ``values`` is ``*keys, pos, x``; ``subprofiles`` is ``grp, community, pos, median`` (``keys`` hold ``grp``).
    """
    joined = values.join(subprofiles, ["grp", "pos"])
    dots = joined.groupBy(*keys, "community").agg(F.sum(F.col("x") * F.col("median")).alias("d"), F.sum(F.col("x") ** 2).alias("a"), F.sum(F.col("median") ** 2).alias("b"))
    s = F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.coalesce(F.try_divide("d", F.sqrt(F.col("a") * F.col("b"))), F.lit(0.0))))
    return dots.withColumn("similarity", s).filter(F.col("similarity") >= least).select(*keys, "community", "similarity")


def membership_text(found: DataFrame, keys: list[str], digits: int = 3) -> DataFrame:
    """Per key the memberships as sorted ``community: similarity`` texts and their number."""
    pair = F.struct((-F.round("similarity", digits)).alias("o"), "community")
    listed = F.transform(F.array_sort(F.collect_list(pair)), lambda s: F.concat_ws(": ", s["community"], (-s["o"]).cast("string")))
    return found.groupBy(*keys).agg(listed.alias("memberships"), F.count(F.lit(1)).alias("n_memberships"))


def confidence(replicates: Column, similarity: Column, threshold: Column) -> Column:
    """high: replicating and similar; medium: one of both; low: neither (missing counts as no)."""
    a, b = F.coalesce(replicates == 1, F.lit(False)), F.coalesce(similarity >= threshold, F.lit(False))
    return F.when(a & b, "high").when(a | b, "medium").otherwise("low")


def circular_layout(nodes: DataFrame) -> DataFrame:
    """Nodes of a group evenly on a circle, in the order of their labels."""
    place = F.row_number().over(Window.partitionBy("grp").orderBy("label")) - 1
    n = F.count(F.lit(1)).over(Window.partitionBy("grp"))
    angle = 2 * 3.141592653589793 * place / n
    return nodes.select("grp", "label", F.round(F.cos(angle), 6).alias("x"), F.round(F.sin(angle), 6).alias("y"))
