"""Small cases of the report and lookup operators."""

from pyspark.sql import functions as F

from wellspring.functions import keys as K
from wellspring.operators import qc as Q
from wellspring.operators.design import Layout, control_warnings, plate_layout


def test_red_wells_of_every_measurement(spark):
    rows = [("a", "PowerLogLogSlope", -2.8), ("a", "PercentMaximal", 1.0), ("a", "PercentMinimal", None), ("b", "PowerLogLogSlope", -1.3), ("b", "PercentMaximal", 1.01), ("b", "PercentMinimal", 5.1)]
    df = spark.createDataFrame([(*r[:2], "ER", r[2]) for r in rows], "well string, metric string, channel string, value double")
    got = {(r.well, r.metric): r.red for r in Q.red_wells(df, ["well"]).collect()}
    assert [got[r[:2]] for r in rows] == [True, False, False, False, True, True]


def test_bands_and_worst_of_a_group(spark):
    low, high, stops = Q.BANDS["PowerLogLogSlope"]
    values = [-9.0, -2.7, -2.69, -2.3, -2.0, -1.7, -1.69, -1.3, -1.29, None]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double").select("i", Q.band(F.col("v"), low, high, stops).alias("c"))
    colours = [r.c for r in df.orderBy("i").collect()]
    assert colours == ["red", "red", "yellow", "yellow", "green", "green", "yellow", "yellow", "red", None]
    worst = lambda rows: df.filter(F.col("i").isin(rows)).agg(Q.worst(F.col("c")).alias("w")).first().w
    assert (worst([4, 2, 0]), worst([4, 2]), worst([4]), worst([9])) == ("red", "yellow", "green", None)


def test_keys_are_matched_in_turn_and_a_sole_key_serves_all(spark):
    left = spark.createDataFrame([("P4",), ("04",), ("p004",), ("x",), (None,)], "plate string")
    right = spark.createDataFrame([("4",), ("P4",), ("9",), (None,)], "plate string")
    got = {r.key: (r.found, r.how) for r in Q.match_keys(left, "plate", right, "plate").collect()}
    assert got == {"P4": ("P4", "key"), "04": ("4", "key"), "p004": ("P4", "key"), "x": (None, None)}
    alone = {r.key: (r.found, r.how) for r in Q.match_keys(left, "plate", right.filter("plate = '9'"), "plate").collect()}
    assert set(alone.values()) == {("9", "sole")}
    assert Q.match_keys(left.limit(0), "plate", right, "plate").count() == 0


def test_object_limits_children_and_samples(spark):
    df = spark.createDataFrame([(1, 1000.0, 0.3), (2, 2000.0, 0.25), (3, None, 0.3), (4, float("nan"), 0.3), (5, 3000.0, 0.2)], "k int, AreaShape_Area double, Intensity_MinIntensity_Hoechst double")
    assert [r.k for r in df.filter(Q.within(Q.OBJECT_LIMITS, df.columns)).collect()] == [2]
    parents = spark.createDataFrame([(1, "a"), (2, "a"), (3, None)], "p int, x string")
    children = spark.createDataFrame([(1, "a", 9), (1, "a", 7), (3, None, 5)], "p int, x string, c int")
    got = {r.p: (r.c, r.n_children) for r in Q.first_children(parents, children, ["p", "x"], "c").collect()}
    assert got == {1: (7, 2), 2: (None, 0), 3: (None, 0)}
    many = spark.range(5000).select((F.col("id") % 2).alias("g"), "id")
    few = Q.sample_per_group(many, ["g"], F.md5(F.col("id").cast("string")), 150).groupBy("g").count().collect()
    assert [r["count"] for r in few] == [150, 150]


def test_names_ranks_and_labels(spark):
    part = K.dashed_name(F.col("n"))
    df = spark.createDataFrame([("001003-2-001002004.tiff",), ("no",), (None,)], "n string").select(*[c.alias(k) for k, c in part.items()])
    assert [tuple(r) for r in df.collect()] == [(1, 3, 2), (None, None, None), (None, None, None)]
    ranks = spark.createDataFrame([("Cells_x",), ("cyto_x",), ("CYTOPLASM_x",), ("nuclei_x",)], "f string").select(K.compartment_rank(F.col("f")).alias("r"))
    assert [r.r for r in ranks.collect()] == [0, 3, 1, 2]
    labels = spark.createDataFrame([("DMSO",), ("DMSO_2",), ("C1",), (None,)], "x string")
    pick = lambda **how: [r.x for r in labels.filter(K.label_is(F.col("x"), **how)).collect()]
    assert pick(exact="DMSO") == ["DMSO"] and pick(prefix="DMSO") == ["DMSO", "DMSO_2"] and pick(without="DMSO") == ["C1"] and pick(names=["C1"]) == ["C1"] and len(pick()) == 3


def test_uniform_controls_and_warnings(spark):
    names = spark.createDataFrame([("C1",), ("C2",)], "c string")
    laid = plate_layout(names, "c", Layout(controls="uniform", negative_share=0.05))
    held = sorted((r.row - 1) * 12 + r.column - 1 for r in laid.filter("type in ('neg', 'pos')").collect())
    assert held == [int(i * 96 / 10 + 0.5) for i in range(9)]
    row = control_warnings(laid).first()
    assert (row.n_neg, row.n_pos, row.few_neg, row.few_pos) == (5, 4, True, False)
