import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from wellspring.operators import profiles as P
from wellspring.operators import qc as Q
from wellspring.operators import stats
from wellspring.operators.similarity import row_ranks, unit_rows


def long(spark, rows):
    return spark.createDataFrame(rows, "feature string, value double")


@pytest.mark.parametrize("limit", [1, 200_000])
def test_quantiles_on_both_ways(spark, monkeypatch, limit):
    monkeypatch.setattr(stats, "DIRECT_ROWS", limit)
    rng = np.random.default_rng(1)
    data = {"a": rng.normal(0, 100, 301).round(1), "b": np.r_[rng.integers(-3, 3, 400), [1e300, -1e300]].astype(float), "c": np.array([5.0]), "d": np.array([1, 2, 3, 10.0])}
    rows = [(k, float(v)) for k, x in data.items() for v in x] + [("a", None)]
    got = {r.feature: r for r in stats.quantiles(long(spark, rows), ["feature"], "value", {"m": 0.5, "p95": 0.95, "p05": 0.05}).collect()}
    for k, x in data.items():
        assert got[k].n == len(x)
        assert np.allclose([got[k].m, got[k].p95, got[k].p05], np.quantile(x, [0.5, 0.95, 0.05]))
    assert math.isclose(got["d"].p95, 8.95)


def test_long_form_leaves_out_nan_and_null(spark):
    df = spark.createDataFrame([(1, 1.0), (1, 2.0), (1, float("nan")), (1, None)], "k int, x double")
    assert stats.medians(stats.long_form(df, ["k"], ["x"]), ["k"], "value", "m").first().m == 1.5


def test_clip_keeps_null(spark):
    df = spark.createDataFrame([(None,), (50.0,), (-50.0,), (1.0,)], "x double")
    assert [r[0] for r in df.select(stats.clip(F.col("x"), -25, 25)).collect()] == [None, 25.0, -25.0, 1.0]


@pytest.mark.parametrize("p, rejected", [([0.001, 0.008, 0.039, 0.041, 0.042, 0.06, 0.074, 0.205], 2), ([0.9, 0.8], 0), ([0.01, 0.01, 0.01], 3)])
def test_step_up(spark, p, rejected):
    df = spark.createDataFrame([("g", x) for x in p], "g string, p double")
    assert stats.stepup_threshold(df, ["g"], "p", 0.05).first().n_rejected == rejected


def test_number_rows(spark):
    df = spark.range(500).select((F.col("id") * 7 % 501).alias("x"))
    rows = sorted((r.x, r.row_no) for r in stats.number_rows(df, ["x"]).collect())
    assert [n for _, n in rows] == list(range(500))


@settings(max_examples=50, deadline=None)
@given(st.lists(st.integers(-3, 3), min_size=1, max_size=12))
def test_average_ranks_of_rows(x):
    got = row_ranks(np.array([x], float))[0]
    assert all(got[i] == sum(v < x[i] for v in x) + (sum(v == x[i] for v in x) + 1) / 2 for i in range(len(x)))
    assert sorted(row_ranks(np.array([x], float), True)[0]) == list(range(1, len(x) + 1))


def test_degenerate_rows_become_zero():
    assert not unit_rows(np.zeros((1, 4)), "cosine").any() and not unit_rows(np.full((1, 4), 3.0), "spearman").any()


def test_normalisations(spark):
    rows = [("f", float(v), "DMSO") for v in (1, 2, 3, 4, 100)] + [("f", 7.0, "x"), ("g", 1.0, "DMSO"), ("g", 3.0, "x"), ("z", 5.0, "DMSO"), ("z", 5.0, "DMSO"), ("z", 6.0, "x")]
    df = spark.createDataFrame(rows, "feature string, value double, p string")
    robust = {(r.feature, r.p): r.value for r in P.mad_robustize(df.filter("p = 'x' or p = 'DMSO'"), "p = 'DMSO'").filter("p = 'x'").collect()}
    assert math.isclose(robust["f", "x"], (7 - 3) / 1.4826)
    z = {(r.feature, r.p): r.value for r in P.robust_z(df, "p = 'DMSO'").filter("p = 'x'").collect()}
    assert math.isclose(z["f", "x"], 0.6745 * (7 - 22) / 20)
    assert math.isclose(z["z", "x"], 0.6745)  # exp(-0)
    assert math.isclose(z["g", "x"], 1.0)  # one control: standardised


def test_limits_and_tri_state(spark):
    rows = [("FocusScore", "Syto", v) for v in (0.05, 0.0499, None)] + [("PowerLogLogSlope", "ER", v) for v in (-1.0, -0.99, -2.5)]
    df = spark.createDataFrame(rows, "metric string, channel string, value double")
    assert [r.passes for r in Q.absolute_pass(df).collect()] == [True, False, None, True, False, True]


def test_eta_squared_extremes(spark):
    df = spark.createDataFrame([("all", "r1", 1.0), ("all", "r1", 1.0), ("all", "r2", 2.0), ("all", "r2", 2.0), ("none", "r1", 1.0), ("none", "r1", 2.0), ("none", "r2", 1.0), ("none", "r2", 2.0), ("flat", "r1", 3.0), ("flat", "r2", 3.0), ("one", "r1", 3.0)], "k string, g string, value double")
    got = {r.k: r.eta2 for r in Q.eta_squared(df, ["k"], "g").collect()}
    assert math.isclose(got["all"], 1.0) and abs(got["none"]) < 1e-9 and got["flat"] is None and got["one"] is None
