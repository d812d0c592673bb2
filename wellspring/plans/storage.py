"""Queries that write given tables in each format and read them back."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wellspring.plans.objects import FEATURES, PLATE, WELL
from wellspring.plans.quality import COLUMNS, COUNTS
from wellspring.plans.tables import table
from wellspring.session import shared_folder
from wellspring.sources import scan, sink

OBJECT_KEYS = ["ImageNumber", "ObjectNumber", "Metadata_Field", "Metadata_Plate", "Metadata_Well"]
SLOPES = COLUMNS[:6]


def _place(spark) -> str:
    """A new folder that all executors share."""
    return f"{shared_folder(spark)}/out-{uuid.uuid4().hex}"


def _number(c: str):
    return F.nanvl(F.col(c), F.lit(None).cast("double"))


def csv_by_group(spark, folder):
    """Orders as delimited text, a folder per status, read back and summed."""
    at = _place(spark)
    sink.write_csv(table(spark, folder, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice"), at, digits=2, by=["o_orderstatus"])
    back = spark.read.csv(at, header=True, schema="o_orderkey long, o_totalprice double, o_orderstatus string")
    return back.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))


def csv_of_arrays(spark, folder):
    """Embeddings as delimited text with joined arrays, read back."""
    at = _place(spark)
    sink.write_csv(table(spark, folder, "embeddings"), at)
    back = spark.read.csv(at, header=True, schema="vec_id long, embedding string, label int")
    return back.select("vec_id", "label", F.size(F.split("embedding", r"\|")).alias("n_values"))


def json_lines(spark, folder):
    """Readings of sites as JSON lines with every field, NaN as null, read back."""
    at = _place(spark)
    sink.write_json(table(spark, folder, "image_qc").select("qc_id", *SLOPES[:2]), at)
    back = spark.read.json(at, schema=f"qc_id long, {SLOPES[0]} double, {SLOPES[1]} double")
    return back.agg(F.count(F.lit(1)).alias("n"), F.count(SLOPES[0]).alias("n_first"), F.count(SLOPES[1]).alias("n_second"))


def parquet_by_group(spark, folder):
    """Events as Parquet, a folder per type; one type is read back from its folder alone."""
    at = _place(spark)
    sink.write_parquet(table(spark, folder, "events").select("event_id", "event_type", "value"), at, by=["event_type"])
    back = spark.read.parquet(at)
    return back.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 4).alias("total"))


def split_groups(spark, folder):
    """Cells split into eight parts that keep a plate together: plates in more than one part."""
    parts = sink.split_by_group(table(spark, folder, "cells").filter("Metadata_Plate is not null"), "Metadata_Plate", 8)
    places = parts.groupBy("Metadata_Plate").agg(F.count_distinct("part").alias("n_parts"), F.count(F.lit(1)).alias("n"))
    return places


def object_tables(spark, folder):
    """Cells as tab-separated tables of several batches, the columns in another order in each, read back by name."""
    at, cells = _place(spark), table(spark, folder, "cells")
    for batch, names in enumerate((OBJECT_KEYS + FEATURES, FEATURES[::-1] + OBJECT_KEYS)):
        part = cells.filter(F.pmod("cell_id", F.lit(2)) == batch).select(*names)
        part.write.option("sep", "\t").option("header", True).option("nullValue", "NaN").csv(f"{at}/batch_{batch}")
    back = scan.object_table(spark, at, FEATURES)
    return back.groupBy("Metadata_Well").agg(F.count(F.lit(1)).alias("n"), *[F.count(f).alias(f) for f in FEATURES])


def site_table(spark, folder):
    """Sites as a tab-separated table, read back with cleaned wells."""
    at = _place(spark)
    sites = table(spark, folder, "image_qc").select("Metadata_Plate", "Metadata_Well", "Metadata_Site", *COUNTS, *SLOPES)
    sites.write.option("sep", "\t").option("header", True).option("nullValue", "NaN").csv(at)
    back = scan.image_table(spark, at)
    return back.groupBy("Metadata_Well").agg(F.count(F.lit(1)).alias("n"), *[F.sum(c).cast("long").alias(c) for c in COUNTS], *[F.count(c).alias(c) for c in SLOPES])


def platemap_table(spark, folder):
    """The platemap as delimited text with free column names, read back: plates with a P, wells in capitals."""
    at = _place(spark)
    rows = table(spark, folder, "platemap").select(F.trim("Metadata_Plate").alias("Plate name"), F.trim("Metadata_Well").alias("well"), F.trim("Metadata_Perturbation").alias("Compound"))
    rows.filter(" and ".join(f"`{c}` is not null" for c in rows.columns)).write.option("header", True).csv(at)
    return scan.platemap(spark, at).groupBy("Metadata_Plate").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("Metadata_Well").alias("n_wells"), F.count_distinct("Metadata_Perturbation").alias("n_labels"))


def profile_tables(spark, folder):
    """Profiles as delimited tables of two cohorts with different columns, read back as one."""
    at, p = _place(spark), table(spark, folder, "profiles")
    known = p.filter("Metadata_Plate is not null and size(features) = 64").select(F.trim("Metadata_Plate").alias("Metadata_Plate"), "profile_id", *[F.nanvl(F.col("features")[i].cast("double"), F.lit(None).cast("double")).alias(f"f{i}") for i in range(3)])
    for k, names in enumerate((["f0", "f1"], ["f2", "f1"])):
        known.filter(F.pmod("profile_id", F.lit(2)) == k).select("Metadata_Plate", *names).write.option("header", True).csv(f"{at}/cohort_{k}_normalized.csv")
    back = scan.profiles(spark, at, ("*.csv",))
    return back.groupBy("Metadata_Plate").agg(F.count(F.lit(1)).alias("n"), *[F.count(f"f{i}").alias(f"f{i}") for i in range(3)])


QUERIES = {f.__name__: f for f in (csv_by_group, csv_of_arrays, json_lines, parquet_by_group, split_groups, object_tables, site_table, platemap_table, profile_tables)}

_OK = "count(*) FILTER ({c} IS NOT NULL AND NOT isnan({c}))"
_P = "trim(Metadata_Plate)"
ORACLES = {
    "csv_by_group": "SELECT o_orderstatus, count(*) AS n, round(sum(round(o_totalprice, 2)), 2) AS total FROM orders GROUP BY 1",
    "csv_of_arrays": "SELECT vec_id, label, len(embedding)::INT AS n_values FROM embeddings",
    "json_lines": f"SELECT count(*) AS n, {_OK.format(c=SLOPES[0])} AS n_first, {_OK.format(c=SLOPES[1])} AS n_second FROM image_qc",
    "parquet_by_group": "SELECT event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1",
    "split_groups": "SELECT Metadata_Plate, 1 AS n_parts, count(*) AS n FROM cells WHERE Metadata_Plate IS NOT NULL GROUP BY 1",
    "object_tables": "SELECT upper(trim(Metadata_Well)) AS Metadata_Well, count(*) AS n, " + ", ".join(f"{_OK.format(c=f)} AS {f}" for f in FEATURES) + " FROM cells GROUP BY 1",
    "site_table": f"SELECT {WELL} AS Metadata_Well, count(*) AS n, " + ", ".join(f"sum({c})::BIGINT AS {c}" for c in COUNTS) + ", " + ", ".join(f"{_OK.format(c=c)} AS {c}" for c in SLOPES) + " FROM image_qc GROUP BY 1",
    "platemap_table": f"SELECT CASE WHEN {_P} LIKE 'P%' THEN {_P} ELSE 'P' || {_P} END AS Metadata_Plate, count(*) AS n, count(DISTINCT upper(trim(Metadata_Well))) AS n_wells, count(DISTINCT trim(Metadata_Perturbation)) AS n_labels FROM platemap WHERE Metadata_Plate IS NOT NULL AND Metadata_Well IS NOT NULL AND Metadata_Perturbation IS NOT NULL GROUP BY 1",
    "profile_tables": f"""WITH p AS (SELECT {_P} AS Metadata_Plate, profile_id % 2 AS k, features AS f FROM profiles WHERE Metadata_Plate IS NOT NULL AND len(features) = 64)
SELECT Metadata_Plate, count(*) AS n, count(*) FILTER (k = 0 AND f[1] IS NOT NULL AND NOT isnan(f[1])) AS f0, count(*) FILTER (f[2] IS NOT NULL AND NOT isnan(f[2])) AS f1, count(*) FILTER (k = 1 AND f[3] IS NOT NULL AND NOT isnan(f[3])) AS f2 FROM p GROUP BY 1""",
}
