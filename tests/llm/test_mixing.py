from wellspring.llm.mixing import TOKENIZER, count_tokens, draw, mix, plan_rates, shares

DOCS = "id long, source string, text string, copies int"
TARGETS = "source string, target_share double, max_repeats int"


def sizes(spark, counts):
    rows, k = [], 0
    for source, lengths in counts.items():
        for n in lengths:
            k += 1
            rows.append((k, source, n))
    return spark.createDataFrame(rows, "doc_id long, source string, n_tokens long")


def test_shares_are_reached_and_repeats_held(spark, monkeypatch):
    from wellspring.llm import mixing

    monkeypatch.setattr(mixing, "BLOCK_ROWS", 100)
    s = sizes(spark, {"big": [10 + i % 90 for i in range(4000)], "mid": [50] * 600, "small": [40 + i for i in range(30)], "other": [5] * 10})
    targets = spark.createDataFrame([("big", 0.5, 1), ("mid", 0.3, 2), ("small", 0.1, 4), ("absent", 0.1, 3)], TARGETS)
    plan = plan_rates(s, targets)
    drawn = draw(s, plan)
    report = {r.source: r for r in shares(plan, drawn).collect()}
    assert abs(report["small"].rate - 4) < 1e-6 and report["small"].most_copies == 4 and report["small"].n_used == 30
    assert report["absent"].tokens == 0 and report["absent"].rate == 0
    for source, share in (("big", 0.5), ("mid", 0.3), ("small", 0.1)):
        assert abs(report[source].actual_share - share / 0.9) < 0.01
    assert report["big"].most_copies == 1 and {r.source for r in drawn.select("source").distinct().collect()} == {"big", "mid", "small"}
    rates = {r.source: r.rate for r in plan.collect()}
    counts = {r.source: r.n_copies for r in report.values()}
    for source, n in (("big", 4000), ("mid", 600), ("small", 30)):
        assert abs(counts[source] - rates[source] * n) <= 1  # systematic: rounded once


def test_given_total_is_held_at_the_cap(spark):
    s = sizes(spark, {"a": [10] * 10, "b": [10] * 100})
    plan = plan_rates(s, spark.createDataFrame([("a", 0.5, 2), ("b", 0.5, 3)], TARGETS), 1_000)
    assert {r.source: round(r.rate, 6) for r in plan.collect()} == {"a": 2.0, "b": 0.5}


def test_nulls_empty_texts_and_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a", "one two"), (2, "a", ""), (3, "a", None), (4, None, "x"), (5, "b", "the end " * 3000)], "id long, source string, text string").selectExpr("*", "1 as copies", "2 as rate")
    assert {r.doc_id: r.n_tokens for r in count_tokens(docs, "id", "source", "text", TOKENIZER).collect()} == {1: 2, 2: 0, 3: 0, 4: 1, 5: 6001}
    targets = spark.createDataFrame([("a", 1.0, 1), (None, 0.5, 1), ("b", None, 1)], TARGETS)
    rows, report = mix(docs, targets, "id", "source", "text")
    assert {r.doc_id for r in rows.collect()} == {1, 2, 3} and {r.source: r.tokens for r in report.collect()} == {"a": 2, "b": 0}
    assert mix(docs.limit(0), targets, "id", "source", "text")[0].count() == 0


def test_same_draw_again(spark):
    s = sizes(spark, {"a": list(range(1, 500))})
    plan = plan_rates(s, spark.createDataFrame([("a", 1.0, 1)], TARGETS), 30_000)
    assert sorted(draw(s, plan).collect()) == sorted(draw(s.repartition(7), plan).collect())
