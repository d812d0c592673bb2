import random

import duckdb
from pyspark.sql import functions as F

from wellspring.operators.stats import half_away
from wellspring.plans import quality as Q


def test_aggregate_has_every_reading(spark, tmp_path):
    head = ["qc_id", "ImageNumber", "Metadata_Plate", "Metadata_Well", *Q.COUNTS, *Q.COLUMNS]
    kinds = ["long", "long", "string", "string", *["long"] * len(Q.COUNTS), *["double"] * len(Q.COLUMNS)]
    rows = [(i, i, "1", "A01", *[i] * len(Q.COUNTS), *[float(i * (k + 1)) for k in range(len(Q.COLUMNS))]) for i in (1, 3)]
    spark.createDataFrame(rows, ", ".join(f"{n} {k}" for n, k in zip(head, kinds))).write.parquet(f"{tmp_path}/image_qc.parquet")
    (got,) = Q.qc_aggregate(spark, str(tmp_path)).collect()
    assert [got[c] for c in Q.COLUMNS] == [2.0 * (k + 1) for k in range(len(Q.COLUMNS))] and all(got[c] == 4 for c in Q.COUNTS)


def test_aggregate_equals_its_sql_to_the_last_digit_in_any_order_of_rows(spark, tmp_path):
    head = ["qc_id", "ImageNumber", "Metadata_Plate", "Metadata_Well", *Q.COUNTS, *Q.COLUMNS]
    kinds = ["long", "long", "string", "string", *["long"] * len(Q.COUNTS), *["double"] * len(Q.COLUMNS)]
    draw = random.Random(4)
    # four readings of five digits: a quarter of the means lie half way between two results
    rows = [(i, i, "1", f"{'ABCDEFGH'[i % 8]}{i // 8 % 12 + 1:02}", *[1] * len(Q.COUNTS), *[round(draw.uniform(-3, 3), 5) for _ in Q.COLUMNS]) for i in range(4 * 96)]
    write = lambda name, some: spark.createDataFrame(some, ", ".join(f"{n} {k}" for n, k in zip(head, kinds))).coalesce(1).write.parquet(f"{tmp_path}/{name}/image_qc.parquet")
    write("sorted", rows)
    draw.shuffle(rows)
    write("mixed", rows)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW image_qc AS SELECT * FROM '{tmp_path}/sorted/image_qc.parquet/*.parquet'")
    told = con.execute(Q.ORACLES["qc_aggregate"])
    names = [d[0] for d in told.description]
    want = {r[:2]: r for r in told.fetchall()}
    for name in ("sorted", "mixed"):
        assert {(r.plate, r.well): tuple(r[n] for n in names) for r in Q.qc_aggregate(spark, f"{tmp_path}/{name}").collect()} == want


def test_half_away_keeps_what_cannot_be_scaled(spark):
    x = [0.0002465, -0.0002465, 1e300, 1.7e308, None]
    got = [r[0] for r in spark.createDataFrame([(v,) for v in x], "x double").coalesce(1).select(half_away(F.col("x"), 6)).collect()]
    assert got == [0.000246, -0.000246, 1e300, 1.7e308, None]
