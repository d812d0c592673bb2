import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from wellspring.llm import percentiles as Q

AT, NAMES = [0.01, 0.5, 0.99], ["lo", "mid", "hi"]
SCHEMA = "day string, plate long, well string, x double, y double, n long, feature string"


def rows(seed=0, n=600):
    rng = np.random.default_rng(seed)
    x = np.exp(rng.normal(0, 3, n)) * rng.choice([-1, 1], n)
    x[:20], x[20], x[21], x[22] = 0.0, np.inf, -np.inf, np.nan
    return [(f"d{i % 3}", None if i % 50 == 0 else i % 2, "A01" if i % 3 else None, float(v), None if i % 7 == 0 else 1.0, 5, "clash") for i, v in enumerate(x)]


def exact(values, q):
    v = sorted(values)
    return v[math.floor(q * (len(v) - 1))]


@pytest.mark.parametrize("limits", [(Q.TASK_ROWS, Q.MERGE_ENTRIES), (37, 50)])
def test_combined_days_keep_the_error(spark, monkeypatch, limits):
    monkeypatch.setattr(Q, "TASK_ROWS", limits[0])
    monkeypatch.setattr(Q, "MERGE_ENTRIES", limits[1])
    data = rows()
    df = spark.createDataFrame(data, SCHEMA)
    daily = Q.combine(Q.count_values(df, ["day", "plate", "well"], {"p": ["day", "plate"], "pw": ["day", "plate", "well"]}, ["x", "y"]), ["day", "plate", "well"])
    got = {(r.by, r.plate, r.well, r.feature): r for r in Q.percentiles(Q.combine(daily, ["plate", "well"]), ["plate", "well"], AT, NAMES).collect()}
    want = {}
    for _, plate, well, x, y, _, _ in data:
        for f, v in (("x", x), ("y", y)):
            if plate is not None and v is not None and not math.isnan(v):
                want.setdefault(("p", plate, None, f), []).append(v)
                if well is not None:
                    want.setdefault(("pw", plate, well, f), []).append(v)
    assert set(got) == set(want)
    for k, values in want.items():
        assert got[k].n == len(values)
        for q, name in zip(AT, NAMES):
            t = exact(values, q)
            assert got[k][name] == t or abs(got[k][name] - t) <= 0.01 * abs(t) * (1 + 1e-9)


def test_empty_table(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert Q.percentiles(Q.combine(Q.count_values(none, ["plate"], {"p": ["plate"]}, ["x"]), ["plate"]), ["plate"], AT, NAMES).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.floats(allow_nan=False, allow_infinity=False), st.sampled_from([0.001, 0.01, 0.2]))
def test_any_double_is_within_the_error(v, error):
    back = Q.value_of(Q.bucket_of(np.array([v]), error), error)[0]
    assert back == v or abs(back - v) <= error * abs(v) * (1 + 1e-9) + 5e-324


def test_buckets_increase_with_the_value():
    v = np.array([-np.inf, -1e300, -2.0, -1e-300, 0.0, 1e-300, 1.0, 1e308, np.inf])
    assert (np.diff(Q.bucket_of(v, 0.01)) > 0).all()
