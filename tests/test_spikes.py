import dataclasses
import datetime as dt
import math

import numpy as np
from pyspark.sql import functions as F

from wellspring.operators import stats
from wellspring.operators.spikes import SpikeRule, abnormal_probability, flag_readings

BOUNDS = {"slope": (-math.inf, 0.0), "level": (0.0, 1.0)}
SCHEMA = "id long, plate string, t timestamp_ntz, slope double, level double, row_id string"
T0 = dt.datetime(2024, 1, 1)


def table(n, seed, plate="p"):
    rng = np.random.default_rng(seed)
    slope, level = rng.normal(-2, 0.1, n).round(3), rng.uniform(0.3, 0.5, n).round(3)
    slope[5], slope[9], level[3] = -9.0, 0.5, 1.7
    if n > 40:
        level[20:28] = 0.4  # eight equal readings
        slope[30:37] = -2.0  # only seven
        slope[38] = np.inf
        slope[12] = np.nan
    t = rng.integers(0, n, n)  # ties in time
    return [(int(i), plate, T0 + dt.timedelta(minutes=int(x)), float(a), None if i % 17 == 0 else float(b), "x") for i, x, a, b in zip(rng.permutation(n), np.sort(t), slope, level)]


def brute(rows, rule=SpikeRule()):
    found = set()
    for name, at in (("slope", 3), ("level", 4)):
        lo, hi = BOUNDS[name]
        value = lambda r: r[at]
        real = [r for r in rows if value(r) is not None and not math.isnan(value(r))]
        found |= {(r[0], name) for r in real if math.isinf(value(r)) or value(r) < lo or value(r) > hi}
        for plate in {r[1] for r in real if r[1] is not None}:
            own = sorted((r for r in real if r[1] == plate), key=lambda r: (r[2], r[0]))
            finite = np.array([value(r) for r in own if math.isfinite(value(r))])
            if len(finite) < rule.least:
                continue
            m = np.median(finite)
            mad = np.median(np.abs(finite - m))
            found |= {(r[0], name) for r in own if abs(value(r) - m) > 6 * 1.4826 * mad}
            run = []
            for r in [*own, None]:
                if run and (r is None or value(r) != value(run[-1])):
                    if len(run) >= 8:
                        found |= {(x[0], name) for x in run}
                    run = []
                run.append(r)
    return found


def flags(spark, rows, rule=SpikeRule()):
    df = spark.createDataFrame(rows, SCHEMA)
    got = [(r.row_id, r.measurement) for r in flag_readings(df, "id", F.col("plate"), "t", BOUNDS, rule).collect()]
    assert len(got) == len(set(got))
    return set(got)


def unique_ids(rows):
    return [(i, *r[1:]) for i, r in enumerate(rows)]


def test_small_sources_against_brute_force(spark):
    rows = unique_ids(table(120, 1, "a") + table(90, 2, "b") + table(19, 3, "c") + table(60, 4, None))
    assert flags(spark, rows) == brute(rows)


def test_hot_source_in_chunks_gives_the_same(spark, monkeypatch):
    monkeypatch.setattr(stats, "DIRECT_ROWS", 10)
    rows = unique_ids(table(700, 5, "hot") + table(50, 6, "b"))
    rule = dataclasses.replace(SpikeRule(), source_rows=100, chunk=64, context=16)
    assert flags(spark, rows, rule) == brute(rows)


def test_constant_series_empty_table_and_nulls(spark):
    rows = [(i, "p", T0, -2.0, None, "x") for i in range(25)] + [(99, "p", T0, -2.1, None, "x")]
    assert flags(spark, rows) == brute(rows)
    assert flags(spark, []) == set()


def test_probability_separates_states():
    x = np.r_[np.random.default_rng(0).normal(0, 1, 50), [30.0], np.full(10, 0.3), np.random.default_rng(1).normal(0, 1, 20)]
    p = abnormal_probability([x], np.array([0.0]), np.array([1.0]), [np.zeros(len(x), bool)], SpikeRule())[0]
    assert p[50] > 0.99 and p[51:61].min() > 0.8 and p[:50].max() < 0.5
