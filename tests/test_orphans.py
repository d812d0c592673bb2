import datetime as dt
import random

from wellspring.operators import orphans as O

T0 = dt.datetime(2024, 1, 1)
PARENT = "key string, a timestamp_ntz, b timestamp_ntz, row_id long"
REF = "id long, key string, t timestamp_ntz, extra string"


def day(n):
    return None if n is None else T0 + dt.timedelta(days=n)


def brute(refs, parents):
    return sorted(i for i, k, t, _ in refs if k is not None and t is not None and not any(p[0] == k and p[1] is not None and p[1] <= t and (p[2] is None or t < p[2]) for p in parents))


def run(spark, refs, parents):
    found = O.find_orphans(spark.createDataFrame(refs, REF), spark.createDataFrame(parents, PARENT), "id", "key", "t", "a", "b")
    return sorted(r.row_id for r in found.collect())


def test_against_brute_force_with_hot_key_and_small_limits(spark, monkeypatch):
    rng = random.Random(4)
    keys = ["P1|A01"] * 10 + [f"P{i}|B{i:02}" for i in range(20)] + ["ÄÖ", ""]
    parents = [(rng.choice(keys), day(rng.randint(0, 30)), day(rng.choice([None, *range(5, 60)])), 1) for _ in range(120)]
    parents += [(None, day(1), None, 2), ("P3|B03", None, None, 3), ("P1|A01", day(5), day(2), 4)]
    refs = [(i, rng.choice([*keys, "none", None]), day(rng.choice([None, *range(-3, 70)])), "x") for i in range(900)]
    refs += refs[:10]
    monkeypatch.setattr(O, "PARENTS_PER_RANGE", 25)
    monkeypatch.setattr(O, "REFERENCES_PER_TASK", 60)
    assert run(spark, refs, parents) == brute(refs, parents)


def test_boundaries_of_an_interval(spark):
    parents = [("k", day(1), day(3), 0), ("k", day(3), day(4), 0)]
    refs = [(n, "k", day(n), "") for n in (0, 1, 2, 3, 4)]
    assert run(spark, refs, parents) == [0, 4]


def test_empty_tables(spark):
    assert run(spark, [], [("k", day(1), None, 0)]) == []
    assert run(spark, [(1, "k", day(1), ""), (2, None, day(1), "")], []) == [1]


def test_counts_by_month(spark):
    refs = spark.createDataFrame([(1, "k", day(0), "x"), (2, "q", day(0), "x"), (3, "q", day(40), "y")], REF)
    bad = spark.createDataFrame([(2, "q", day(0), "x")], REF)
    rows = {(r.extra, r.month): (r.n_rows, r.n_orphans, r.orphan_rate) for r in O.count_by_month(bad, refs, ["extra"], "t").collect()}
    assert rows == {("x", "2024-01"): (2, 1, 0.5), ("y", "2024-02"): (1, 0, 0.0)}
