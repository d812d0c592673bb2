"""Registered queries against their SQL equivalents on the smallest given tables."""

import glob
import math
import os

import duckdb
import pytest

import __spark_entry__ as entry

FOLDER = "/root/testdata/sf0.001"
LLM = "wellspring.llm"
#: quick ones of every module; the others are compared by the driver
NAMES = [
    "profile_median_by_strata", "winsorize_bounds", "outlier_mask_counts", "object_join_prefixed", "plate_design", "design_platemap", "qc_aggregate", "qc_flags_both", "qc_colour_bands",
    "box_sample", "object_filter", "object_relations", "plate_lookup", "name_split", "compartment_order", "visible_perturbations", "plate_design_uniform", "compound_similarity",
    "similarity_graph_edges", "average_precision", "label_metrics", "assignment_nodes", "subprofiles_wide", "silhouette", "object_tables", "profile_tables", "json_lines", "p3_found", "p5_types",
    "p5_lines", "p6_found",
]
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no given tables")


def plain(v):
    if isinstance(v, (list, tuple)):
        return tuple(map(plain, v))
    if v is None or isinstance(v, (str, bool, int)):
        return str(v)
    return "nan" if math.isnan(v) else repr(round(float(v), 5) + 0.0)


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    for path in glob.glob(f"{FOLDER}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_its_sql(spark, sql, name):
    found = entry.queries()[name](spark, FOLDER)
    columns = sorted(found.columns)
    told = sql.execute(entry.oracle_sql()[name])
    names = [d[0] for d in told.description]
    assert sorted(names) == columns
    want = sorted(tuple(plain(row[names.index(c)]) for c in columns) for row in told.fetchall())
    assert sorted(tuple(plain(row[c]) for c in columns) for row in found.collect()) == want


def test_every_sql_belongs_to_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
